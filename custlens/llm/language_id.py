"""Language identification with segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary (a sentencepiece file) get a probability per
language.  A word may be cut into pieces in many ways; its probability is the sum over
all of them, which the forward algorithm gives in one pass over its characters.  A text
is as likely as its words are together, and the language with the highest probability,
prior included, is predicted.

Pieces never join across words (the mark of a word's beginning stands only in front), so
the sum over all segmentations of a text is the product of its words' sums, and each
distinct word of a slice of texts is worked out once.  The piece probabilities are
learned by expectation maximisation over the counts of all learning words: each round
sums the expected uses of a piece over all segmentations, by the forward and backward
algorithms, in Spark tasks.  The model has a number for each piece and language, which
doesn't grow with the documents.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import drop_staged, importable, slices, stage, strings, word_arrays

#: Documents whose crc32(doc_id as text) has this remainder are held out of learning.
FOLDS, HELD_OUT = 3, 1
#: Rounds of expectation maximisation, and what is added to each expected count.
ROUNDS, SMOOTH = 3, 0.05
#: What stands between words; words are runs of letters in lower case.
LETTER_GAP = r"[^\p{L}]+"
#: The mark of a word's beginning in the vocabulary.
MARK = "▁"
UNKNOWN = "und"
#: Forward sums below this are scaled up (a double holds 1e-308; a step multiplies by 1e-12 or more).
LOW, LIFT = 1e-100, 1e100
LEAST_P = 1e-12

#: Bytes of a slice of texts, and of words: a slice's distinct words are worked out once.
TEXT_BYTES, WORD_BYTES = 24 << 20, 1 << 19

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


# -- vocabulary -------------------------------------------------------------------

def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def vocabulary(path: str | None = None) -> tuple[str, ...]:
    """Pieces of lower-case letters, with or without the mark in front."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path or default_vocabulary())
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return tuple(p for p in pieces if p == p.lower() and (p == MARK or p.removeprefix(MARK).isalpha()))


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(points: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the rows' prefixes: (rows, n) code points to (n + 1, rows)."""
    out = np.zeros((points.shape[1] + 1, len(points)), np.uint64)
    for j in range(points.shape[1]):
        out[j + 1] = out[j] * _BASE + points[:, j].astype(np.uint64) + np.uint64(1)
    return out


class Pieces:
    """Finds pieces in words: by the hash of a span, with the length, in a sorted table.
    The last number stands for any character that the vocabulary lacks."""

    def __init__(self, pieces: tuple[str, ...]):
        self.n = len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        self.power = np.append(np.uint64(1), np.cumprod(np.full(self.longest, _BASE)))
        hashes = np.zeros(len(pieces), np.uint64)
        for size in range(1, self.longest + 1):
            some = [i for i, p in enumerate(pieces) if len(p) == size]
            if some:
                hashes[some] = _hashes(_points([pieces[i] for i in some], size))[-1]
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) & np.uint64((1 << 20) - 1)).astype(np.int64)

    def matches(self, prefix: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose characters from ``start`` to ``end`` are a piece, and which."""
        h = prefix[end] - prefix[start] * self.power[end - start]
        rows = np.flatnonzero(self.bits[self._slot(h)])
        h = h[rows]
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
        hit = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        if end - start > 1:
            return rows[hit], self.ids[at[hit]]
        ids = np.full(prefix.shape[1], self.n - 1)
        ids[rows[hit]] = self.ids[at[hit]]
        return np.arange(len(ids)), ids


def _points(words: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n)


def by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their code points with the mark in front."""
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    order = np.argsort(size, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(rows):
            n = int(size[rows[0]])
            yield rows, _points([MARK + w for w in words.take(pa.array(rows)).to_pylist()], n + 1)


# -- forward and backward ---------------------------------------------------------

def forward(points: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log probability of each word (row of code points) under each column of ``p``
    (pieces by languages): the sum over all segmentations."""
    w, n = points.shape
    prefix = _hashes(points)
    # Only the last sums are needed, as many as the longest piece has characters.
    ring = np.zeros((pieces.longest + 1, w, p.shape[1]))
    ring[0] = 1
    scale = np.zeros((w, p.shape[1]))
    size = len(ring)
    for end in range(1, n + 1):
        total = np.zeros((w, p.shape[1]))
        for start in range(max(0, end - pieces.longest), end):
            rows, ids = pieces.matches(prefix, start, end)
            if len(rows) == w:
                total += ring[start % size] * p[ids]
            elif len(rows):
                total[rows] += ring[start % size][rows] * p[ids]
        ring[end % size] = total
        low = total < LOW
        if low.any():
            ring[:, low] *= LIFT
            scale[low] -= np.log(LIFT)
    return np.log(ring[n % size]) + scale


def word_scores(words: pa.Array, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Log probability of each word (rows) in each language (columns)."""
    out = np.zeros((len(words), p.shape[1]))
    for rows, points in by_length(words):
        out[rows] = forward(points, pieces, p)
    return out


def _sums(spans: list[tuple], n: int, w: int, back: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward (or backward) sums at each place of a word, and the logarithm of what
    they are to be multiplied by (None: one).  ``spans``: start, end, rows and weights."""
    sums, scale = np.zeros((n + 1, w)), None
    sums[n if back else 0] = 1
    shift = np.zeros(w)
    place = 0 if back else 1
    for here, some in itertools.groupby(spans, key=lambda x: x[place]):
        for start, end, rows, _, weight in some:
            term = sums[end if back else start, rows] * weight
            if scale is not None:
                term *= np.exp(shift[rows] - scale[end if back else start, rows])
            sums[here, rows] += term
        low = (sums[here] < LOW) & (sums[here] > 0)
        if low.any() and scale is None:
            scale = np.zeros((n + 1, w))
        if scale is not None:
            sums[here, low] *= LIFT
            shift[low] += np.log(LIFT)
            scale[here] = shift
    return sums, None if scale is None else -scale


def expected_uses(points: np.ndarray, lang: np.ndarray, n: np.ndarray, pieces: Pieces,
                  p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (rows) in each language (columns) over all
    segmentations of words of one length with their counts ``n``."""
    prefix, (w, last) = _hashes(points), points.shape
    spans = []
    for end in range(1, last + 1):
        for start in range(max(0, end - pieces.longest), end):
            rows, ids = pieces.matches(prefix, start, end)
            if len(rows):
                cell = ids * p.shape[1] + lang[rows]
                spans.append((start, end, slice(None) if len(rows) == w else rows, cell, p.ravel()[cell]))
    ahead, log_ahead = _sums(spans, last, w, False)
    behind, log_behind = _sums(sorted(spans, key=lambda x: -x[0]), last, w, True)
    part, scaled = n / ahead[last], log_ahead is not None or log_behind is not None
    if scaled:
        zero = np.zeros_like(ahead)
        log_ahead, log_behind = (zero if x is None else x for x in (log_ahead, log_behind))
    cells, shares = [], []
    for start, end, rows, cell, weight in spans:
        share = ahead[start, rows] * weight * behind[end, rows] * part[rows]
        if scaled:
            share *= np.exp(log_ahead[start, rows] + log_behind[end, rows] - log_ahead[last, rows])
        cells.append(cell)
        shares.append(share)
    return np.bincount(np.concatenate(cells), np.concatenate(shares), minlength=p.size).reshape(p.shape)


# -- learning ---------------------------------------------------------------------

@dataclass
class Model:
    langs: list[str]
    log_prior: np.ndarray
    p: np.ndarray  # pieces by languages
    pieces: tuple[str, ...]


@functools.cache
def _finder(pieces: tuple[str, ...]) -> Pieces:
    return Pieces(pieces)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of texts the count of each (language, word)."""
    for part in slices(batches, max_bytes=TEXT_BYTES):
        lang = strings(part.column("lang")).dictionary_encode()
        words, code, off = letter_words(part.column("text"))
        if not len(words):
            continue
        owner = np.repeat(np.asarray(lang.indices).astype(np.int64), np.diff(off))
        key, n = np.unique(owner * len(words) + code, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(key // len(words))), words.take(pa.array(key % len(words))),
             pa.array(n)], ["lang", "word", "n"])


def letter_words(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    return word_arrays(pc.utf8_lower(strings(text)), gap=LETTER_GAP)


def learn(rows: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> Model:
    """The model of ``rows`` (text, lang), all of them: priors by documents, piece
    probabilities by expectation maximisation.  Null languages and texts teach nothing."""
    spark = rows.sparkSession
    importable(spark)
    pieces = vocabulary(path)
    known = rows.where("lang is not null and text is not null")
    priors = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    langs = sorted(priors)
    log_prior = np.log(np.array([priors[x] for x in langs], float) / max(1, sum(priors.values())))
    model = Model(langs, log_prior, np.full((len(pieces) + 1, len(langs)), 1 / (len(pieces) + 1)), pieces)
    if not langs:
        return model
    # The words are little data and much work: they are dealt to all tasks.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = stage(known.mapInArrow(_word_counts, "lang string, word string, n long")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition(parts), "language-words")
    words = spark.read.parquet(counted)
    for _ in range(rounds):
        def uses(batches: Iterator[pa.RecordBatch], m: Model = model) -> Iterator[pa.RecordBatch]:
            finder, total = _finder(m.pieces), np.zeros(m.p.shape)
            number = pa.array(m.langs, pa.string())
            for part in slices(batches, "word", WORD_BYTES):
                lang = pc.index_in(part.column("lang"), number).to_numpy(zero_copy_only=False)
                n = part.column("n").to_numpy().astype(float)
                for at, points in by_length(part.column("word")):
                    total += expected_uses(points, lang[at], n[at], finder, m.p)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)),
                 pa.array(total[piece, lang])], ["piece", "lang", "uses"])

        sums = (words.mapInArrow(uses, "piece int, lang int, uses double")
                .groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow())
        total = np.full(model.p.shape, SMOOTH)
        total[np.asarray(sums["piece"]), np.asarray(sums["lang"])] += np.asarray(sums["uses"])
        p = np.maximum(total / total.sum(0), LEAST_P)
        model = Model(langs, log_prior, p, pieces)
    drop_staged(spark, counted)
    return model


def predict(text: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Predicted language and its posterior probability for each text."""
    words, code, off = letter_words(text)
    n_words = np.diff(off)
    logs = np.tile(model.log_prior, (len(n_words), 1))
    if len(words) and model.langs:
        # Sums by text over its words: running sums would lose digits in long slices.
        use = np.flatnonzero(n_words)
        logs[use] += np.add.reduceat(word_scores(words, _finder(model.pieces), model.p)[code],
                                     off[:-1][use], axis=0)
    if not model.langs:
        return [UNKNOWN] * len(n_words), np.zeros(len(n_words))
    best = logs.argmax(1)
    score = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
    return ([model.langs[b] if n else UNKNOWN for b, n in zip(best, n_words, strict=True)],
            np.where(n_words > 0, score, 0.0))


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``.

    Learns from the rows that are not held out.  Null texts and texts without a letter
    are ``und`` with score 0, and so is every text where nothing was learned; a null
    doc_id stays null and counts as the empty text for the fold; repeated rows give
    repeated results; ties go to the first language in code-point order.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).withColumn(
        "held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT)
    model = learn(rows.where(~F.col("held_out")).select("text", "lang"), path)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, max_bytes=TEXT_BYTES):
            lang, p = predict(part.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(p)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(score, SCHEMA)
