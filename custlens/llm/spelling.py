"""Spelling variants by pivotal grams.

Two words one edit apart share most of their bigrams.  With the bigrams in one order of
rarity, a word's *prefix* is its three rarest (and those that tie with the third): an
edit breaks two at most, so near words share a prefix gram.  Its *pivots* are two
bigrams of the prefix that don't overlap, chosen by dynamic programming so that they
are the rarest together: an edit breaks one of them at most, so the other stands in the
near word too.  If the last prefix gram of r comes no later in the order than that of s,
an unbroken pivot of r is in the prefix of s; if later, the roles change.  It is
therefore enough to look up the pivots of every word among the prefixes of the others,
and few pivots meet as they are rare.

Position limits cut the keys further: with equal lengths an unbroken gram keeps its
place, and in a word that is longer (shorter) by one it keeps its place or moves on
(back) by one.  So a pivot meets prefix grams in five (length, place) cells.  What meets
is verified exactly, after a test on the letters that occur.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import drop_staged, importable, slices, stage, strings, word_arrays

#: What stands between runs of letters.
LETTER_GAP = "[^A-Za-zÀ-ÿ]+"
#: Words have so many code points and occurrences at least.
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form has so many times a word's occurrences.
FORM_RATIO = 5
#: A run whose checksum this divides loses a letter.
DAMAGE = 199
#: The prefix: edits * gram length + 1.
PREFIX = 3


# -- words ------------------------------------------------------------------------

@functools.lru_cache(4096)
def _shift_tables(n: int) -> np.ndarray:
    """Tables by byte of a checksum: what it becomes through ``n`` more zero bytes.
    The map is linear, so the checksum of a joined text is that of its front, moved so,
    with the checksum of its end."""
    def moved(x: int) -> int:
        # zlib's checksum of front + zeros is moved(front) ^ checksum(zeros).
        return zlib.crc32(bytes(n), x) ^ zlib.crc32(bytes(n), 0)

    return np.array([[moved(b << (8 * k)) for b in range(256)] for k in range(4)], np.uint32)


def joined_crc(front: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of joined byte strings from those of their parts and the end's size."""
    out = end.copy()
    order = np.argsort(size, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(rows):
            table, x = _shift_tables(int(size[rows[0]])), front[rows]
            for k in range(4):
                out[rows] ^= table[k][(x >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of texts the count of each word, after the damage."""
    for part in slices(batches):
        runs, code, off = word_arrays(part.column("text"), lower=True, gap=LETTER_GAP)
        size = pc.utf8_length(runs).to_numpy(zero_copy_only=False)
        long = size >= LEAST_LENGTH
        owner = np.repeat(np.arange(part.num_rows), np.diff(off))
        use = long[code]
        cell, n = np.unique(owner[use] * max(1, len(runs)) + code[use], return_counts=True)
        if not len(cell):
            continue
        doc, run = cell // len(runs), cell % len(runs)
        ids = [b"" if d is None else str(d).encode() for d in part.column("doc_id").to_pylist()]
        front = np.array([zlib.crc32(d + b":") for d in ids], np.uint32)
        plain = runs.to_pylist()
        whole = [x.encode() if k else b"" for x, k in zip(plain, long, strict=True)]
        crc = joined_crc(front[doc], np.array([zlib.crc32(x) for x in whole], np.uint32)[run],
                         np.array([len(x) for x in whole])[run])
        hit = crc % DAMAGE == 0
        words, counts = [], []
        for r, h, k in zip(run[hit].tolist(), crc[hit].tolist(), n[hit].tolist(), strict=True):
            at = h % len(plain[r])
            word = plain[r][:at] + plain[r][at + 1:]
            if len(word) >= LEAST_LENGTH:
                words.append(word)
                counts.append(k)
        total = np.bincount(run[~hit], n[~hit], minlength=len(runs)).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([runs.take(pa.array(some)), pa.array(total[some])], ["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])


# -- grams ------------------------------------------------------------------------

def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their code points."""
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    order = np.argsort(size, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(rows):
            text = "".join(words.take(pa.array(rows)).to_pylist())
            yield rows, np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(rows), -1).astype(np.int64)


def grams(points: np.ndarray) -> np.ndarray:
    """Number of the bigram at each place; the code points are below 256."""
    return points[:, :-1] * 256 + points[:, 1:]


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of bigrams in words, a row for each bigram and task."""
    total = np.zeros(1 << 16, np.int64)
    for part in slices(batches, "word"):
        for _, points in _by_length(strings(part.column("word"))):
            total += np.bincount(grams(points).ravel(), minlength=1 << 16)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])


def pivots(rank: np.ndarray, weight: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Places of the two prefix grams that don't overlap and weigh least together, for
    each row: the best single gram up to each place, then the best pair that ends there."""
    w = np.where(prefix, weight, np.inf)
    rows, n = rank.shape
    best, best_at = np.full(rows, np.inf), np.zeros(rows, np.int64)
    pair, out = np.full(rows, np.inf), np.zeros((rows, 2), np.int64)
    for j in range(2, n):
        # Grams of two letters overlap where their places differ by one.
        better = w[:, j - 2] < best
        best, best_at = np.where(better, w[:, j - 2], best), np.where(better, j - 2, best_at)
        better = best + w[:, j] < pair
        pair = np.where(better, best + w[:, j], pair)
        out[better] = np.stack([best_at, np.full(rows, j)], 1)[better]
    return out


def word_keys(words: pa.Array, count: np.ndarray) -> Iterator[tuple]:
    """Of the words of each length: their places among ``words``, the rank of the last
    prefix gram, the prefix (row, place, gram) and the pivots (row, place, gram).
    ``count``: occurrences of each bigram."""
    rank_of = np.empty(len(count), np.int64)
    rank_of[np.argsort(count, kind="stable")] = np.arange(len(count))
    for rows, points in _by_length(words):
        gram = grams(points)
        rank = rank_of[gram]
        last = np.partition(rank, PREFIX - 1, axis=1)[:, PREFIX - 1]
        # Places of equal grams tie and are all in.
        prefix = rank <= last[:, None]
        at = pivots(rank, count[gram].astype(float), prefix)
        row, place = np.nonzero(prefix)
        pivot_row = np.repeat(np.arange(len(rows)), 2)
        yield (rows, last, (row, place, gram[row, place]), (pivot_row, at.ravel(), gram[pivot_row, at.ravel()]))


def _bits(values: np.ndarray) -> np.ndarray:
    """Which values modulo 64 occur in each row, as bits of one number."""
    return np.bitwise_or.reduce(np.uint64(1) << (values % 64).astype(np.uint64), axis=1).view(np.int64)


def masks(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which letters and which (hashed) bigrams a word has.  An edit changes two bits of
    the first at most, and four of the second: it takes two bigrams away and brings two."""
    letters, pairs = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for rows, points in _by_length(words):
        letters[rows] = _bits(points)
        pairs[rows] = _bits((grams(points) * 0x9E3779B1) >> 16)
    return letters, pairs


_KEYS = "gram int, size int, place int, id long, last int, letters long, pairs long"


def key_rows(batches: Iterator[pa.RecordBatch], count: np.ndarray, pivot: bool) -> Iterator[pa.RecordBatch]:
    """Prefix grams at their own place, or pivots at all places they can have in a near word."""
    for part in slices(batches, "word", 1 << 20):
        words, ids = strings(part.column("word")), part.column("id").to_numpy()
        letters, pairs = masks(words)
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        for rows, last, prefix, pivots_ in word_keys(words, count):
            row, place, gram = pivots_ if pivot else prefix
            at = rows[row]
            # (length, place) against the word's own: replaced; inserted before or after; deleted so.
            for more, move in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)) if pivot else ((0, 0),):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.astype(np.int32)) for x in (gram, size[at] + more, place + move)), pa.array(ids[at]),
                     pa.array(last[row].astype(np.int32)), pa.array(letters[at]), pa.array(pairs[at])],
                    ["gram", "size", "place", "id", "last", "letters", "pairs"])


# -- near words -------------------------------------------------------------------

def near_words(words: DataFrame) -> DataFrame:
    """Pairs (a, b), a before b, of ``words`` (distinct word and id) with one edit
    between them.  Keys carry the id alone, so that a long word with many equal grams
    costs no more than its length."""
    importable(words.sparkSession)
    count = np.zeros(1 << 16, np.int64)
    # At most one row for each bigram of the alphabet's 90 lower-case letters and letter-like signs.
    sums = (words.select("word").mapInArrow(count_grams, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    count[np.asarray(sums["gram"])] = np.asarray(sums["n"])

    def keys(pivot: bool) -> DataFrame:
        return words.select("id", "word").mapInArrow(lambda b: key_rows(b, count, pivot), _KEYS)

    place = ["gram", "size", "place"]
    index = keys(False).select(*place, *[F.col(c).alias(f"{c}_s") for c in ("id", "last", "letters", "pairs")])

    def changed(mask: str) -> F.Column:
        return F.bit_count(F.col(mask).bitwiseXOR(F.col(f"{mask}_s")))

    # Of two words with the same last gram either is looked up: once is enough.
    met = (keys(True).hint("merge").join(index, place)
           .where((F.col("last") < F.col("last_s")) | ((F.col("last") == F.col("last_s")) & (F.col("id") < F.col("id_s"))))
           .where((changed("letters") <= 2) & (changed("pairs") <= 4))
           .select("id", "id_s").distinct())
    first, second = (words.select(F.col("id").alias(i), F.col("word").alias(w)) for i, w in (("id", "x"), ("id_s", "y")))
    return (met.join(first, "id").join(second, "id_s").where(F.levenshtein("x", "y", 1) == 1)
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of ``forms`` (word, form): the last of a word's chain of forms, itself
    without one.  Each form has FORM_RATIO times the occurrences, so chains end; a round
    doubles the links that are followed."""
    spark = forms.sparkSession
    path = stage(forms.select("word", F.coalesce("form", "word").alias("root"),
                              F.col("form").isNotNull().alias("open")), "spelling-roots")
    while True:
        now = spark.read.parquet(path)
        if not now.where("open").limit(1).count():
            return now.select("word", "root")
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        done = path
        path = stage(now.join(then, "root").select(
            "word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("open")), "spelling-roots")
        drop_staged(spark, done)


def words_of(docs: DataFrame) -> DataFrame:
    """word, n of the distinct words of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.mapInArrow(count_words, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


def group(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    Null texts have no words; a null doc_id is the empty text before the colon; repeated
    rows count each; ties go to the first word in code-point order; without words there
    are no rows; other columns play no part.
    """
    spark = docs.sparkSession
    importable(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Few bytes and much work per word: dealt to all tasks.
    words = spark.read.parquet(stage(words_of(docs).repartition(parts, "word").withColumn(
        "id", F.monotonically_increasing_id()), "spelling-words"))
    pairs = spark.read.parquet(stage(near_words(words), "spelling-pairs"))
    links = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # The largest count, then the first name.
    best = links.join(known, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    forms = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.minus") >= FORM_RATIO * F.col("n"), F.col("best")).alias("best")).select(
        "word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n"))
    forms = spark.read.parquet(stage(forms, "spelling-forms"))
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
