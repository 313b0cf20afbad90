"""Quality classifier by co-training.

Two logistic models see a document from two sides: its words (presence of hashed word
forms) and its metadata (source, language, lengths and layout counts).  In each round
either model labels the unlabelled documents that it is surest of for the other one.
At the end each view is calibrated on labelled documents that neither learned from, a
combination of both is fitted on them, and all documents are scored in one pass.
The same is done for the label ``toxic``.

All documents take part: their features are staged once, the bins of the numbers and
the choice of word features are counted over all of them (all labelled ones, all that a
view labels), and in each round all unlabelled ones are scored and the surest share of
them is found by counts.  Bounded are the rows that the weights are then fitted on:
LABELLED labelled ones, and of those that a view labels HELD per class, even by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import (documents, drop_staged, hash_words, mix, pack, slices, stage, strings, trim, unpack,
                                 word_arrays)

#: Rows that the models are fitted on: labelled ones, at most, and about so many of those
#: that a view labels, for either class.
LABELLED, HELD = 12_000, 1_200
ROUNDS = 3
#: Share of the unlabelled documents that a view may label in a round, for either class,
#: and the least confidence.
GIVEN, SURE = 0.1, 0.95
#: Bins of the logits beyond that confidence, up to TOP.
TAIL, TOP = 4096, 30.0
#: Blocks of word features in which counts are summed.
BLOCKS = 16
#: Buckets of the hashed word forms and of the hashed metadata values.
WORD_BUCKETS, META_BUCKETS = 1 << 17, 64
BINS = 10
#: One labelled row of so many, by hash, is kept for calibration.
KEPT_APART = 4
RIDGE = 1e-3
#: Word features are used whose share differs by so many standard errors, in so many rows.
LEAST_Z, LEAST_ROWS = 4.5, 5

TARGETS = ("quality", "toxic")
NUMBERS = 11
SCHEMA = ("doc_id long, p_text double, p_meta double, score double, toxic double, kept boolean")


# -- features ---------------------------------------------------------------------

def _buckets(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed forms of words: as they are, and in lower case letters only."""
    plain = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}]+", "")
    return tuple((hash_words(w) % np.uint64(WORD_BUCKETS)).astype(np.int64)
                 for w in (words, pc.binary_join_element_wise("~", plain, "")))


def numbers(text: pa.Array) -> np.ndarray:
    """Layout counts of each text: lengths as logarithms, kinds of characters as shares."""
    text = strings(text)
    words, code, off = word_arrays(text)
    chars = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(float)
    n_words = np.diff(off).astype(float)
    owner = np.repeat(np.arange(len(n_words)), np.diff(off))
    distinct = np.bincount(np.unique(owner * max(1, len(words)) + code) // max(1, len(words)),
                           minlength=len(n_words)) if len(code) else np.zeros(len(n_words))

    def share(pattern):
        return pc.count_substring_regex(text, pattern).to_numpy(zero_copy_only=False) / np.maximum(chars, 1)

    lines = pc.count_substring(text, "\n").to_numpy(zero_copy_only=False) + 1.0
    return np.stack([
        np.log1p(chars), np.log1p(n_words), np.log1p(lines), chars / np.maximum(n_words, 1),
        distinct / np.maximum(n_words, 1), share(r"\p{Lu}"), share(r"[0-9]"), share(r"[#*$%&|<>]"),
        share(r"[.,;:]"), share(r"[!?]"), n_words / lines], axis=1)


def meta_values(source: pa.Array, lang: pa.Array) -> np.ndarray:
    """Hashed source and language of each row."""
    out = [hash_words(pc.binary_join_element_wise(k, strings(v), ":")) % np.uint64(META_BUCKETS)
           for k, v in (("s", source), ("l", lang))]
    return np.stack(out, axis=1).astype(np.int64)


def meta_features(values: np.ndarray, nums: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the metadata view: hashed values and the bins of the numbers."""
    bins = np.stack([np.searchsorted(edges[j], nums[:, j]) for j in range(nums.shape[1])], axis=1)
    bins += META_BUCKETS * 2 + np.arange(nums.shape[1]) * (BINS + 1)
    row = np.concatenate([values + np.array([0, META_BUCKETS]), bins], axis=1)
    return row.ravel(), np.arange(len(row) + 1) * row.shape[1]


META_SIZE = META_BUCKETS * 2 + NUMBERS * (BINS + 1)


# -- models -----------------------------------------------------------------------

def _take(feats: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = (at[1:] - at[:-1])[rows]
    ends = np.cumsum(size)
    place = np.repeat((at[rows] - (ends - size)).astype(np.int32), size)
    place += np.arange(len(place), dtype=np.int32)
    return feats[place], np.concatenate([[0], ends])


def logits(feats: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of the features' weights, plus the bias (the last weight)."""
    some = np.flatnonzero(weights[:-1])
    if len(some) * 4 < len(weights):
        # Few features weigh anything: sum those alone.
        use = (weights != 0)[feats]
        at, feats = np.concatenate([[0], np.cumsum(use)])[at], feats[use]
    total = np.concatenate([[0.0], np.cumsum(weights[feats])])
    return total[at[1:]] - total[at[:-1]] + weights[-1]


def telling(have: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Features whose share of rows differs between the labels by more than chance.
    ``have``: rows by label and feature; ``n``: rows by label."""
    if not n.all():
        return np.zeros(have.shape[1], bool)
    # Rows are taken as at most one occurrence each; hash collisions may exceed that.
    have = np.minimum(have, n[:, None])
    share = (have.sum(0) + 1) / (n.sum() + 2)
    z = (have[1] / n[1] - have[0] / n[0]) / np.sqrt(share * (1 - share) * (1 / n).sum())
    return (np.abs(z) >= LEAST_Z) & (have.sum(0) >= LEAST_ROWS)


def fit(feats: np.ndarray, at: np.ndarray, y: np.ndarray, size: int, steps: int = 150) -> np.ndarray:
    """Logistic regression with a ridge, by full-batch Adam: the same on every run."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    if not len(y):
        return w
    owner = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(at))
    for t in range(1, steps + 1):
        err = (1 / (1 + np.exp(-np.clip(logits(feats, at, w), -30, 30))) - y) / len(y)
        grad = np.concatenate([np.bincount(feats, err[owner], size), [err.sum()]])
        grad[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return w


def _platt(columns: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Weights of the columns and a bias that fit the labels, by Newton's method."""
    x = np.stack([*columns, np.ones(len(y))], axis=1)
    w = np.zeros(x.shape[1])
    w[:-1] = 1 / len(columns)
    # A pull to the starting slopes, as strong as a few rows; none on the bias.
    start, pull = w.copy(), np.array([*[1.0] * len(columns), 1e-3])
    if not len(y) or y.min() == y.max():
        return w
    # Labels drawn in a little, as is usual for calibration, keep the weights finite.
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hess, x.T @ (p - target) + pull * (w - start))
        w = w - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
    return w


@dataclass
class Views:
    """Both views' weights, their calibrations and their combination."""

    text: np.ndarray
    meta: np.ndarray
    cal_text: np.ndarray
    cal_meta: np.ndarray
    both: np.ndarray

    def probabilities(self, text: tuple, meta: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated p by text, by metadata and by both."""
        a, b = logits(*text, self.text), logits(*meta, self.meta)
        x = self.cal_text[0] * a + self.cal_text[1], self.cal_meta[0] * b + self.cal_meta[1]
        z = self.both[0] * x[0] + self.both[1] * x[1] + self.both[2]
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (*x, z))


# -- the exchange -----------------------------------------------------------------
# Rows come in slices: ids, labels by target (1, 0, -1 none, -2 not to be used), the text
# view and the metadata view.

_LEAST = float(np.log(SURE / (1 - SURE)))


def _even(ids: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) that ids fall on evenly."""
    return mix(mix(ids.astype(np.uint64)) + np.uint64(salt)) / 2.0 ** 64


def is_apart(ids: np.ndarray) -> np.ndarray:
    return _even(ids, 1) < 1 / KEPT_APART


def _bins(z: np.ndarray) -> np.ndarray:
    """Bin of each logit beyond the least confidence; -1 for the others."""
    return np.where(z < _LEAST, -1, np.minimum((z - _LEAST) * (TAIL / (TOP - _LEAST)), TAIL - 1)).astype(np.int64)


def tails(part: tuple, weights: list) -> np.ndarray:
    """Unlabelled rows by target, view, class and bin; of each target all in the last place."""
    _, y, *views = part
    out = np.zeros((y.shape[1], 2, 2, TAIL + 1), np.int64)
    for t in range(y.shape[1]):
        free = y[:, t] == -1
        out[t, :, :, TAIL] = free.sum()
        for v, view in enumerate(views):
            z = logits(*view, weights[t][v])[free]
            for k in (0, 1):
                got = _bins(z if k else -z)
                out[t, v, k, :TAIL] = np.bincount(got[got >= 0], minlength=TAIL)
    return out


def cut(count: np.ndarray) -> tuple[int, float, float]:
    """The first bin that is labelled whole, the share of the one before it, and the rows:
    at most GIVEN of all unlabelled ones, the surest first."""
    most, count = int(GIVEN * count[TAIL]), count[:TAIL]
    above = np.concatenate([[0], np.cumsum(count[::-1])])
    whole = int(np.searchsorted(above, most, side="right")) - 1
    first, rest = TAIL - whole, most - int(above[whole])
    share = rest / count[first - 1] if first else 0.0
    return first, float(share), float(above[whole] + (rest if first else 0))


def given(z: np.ndarray, free: np.ndarray, ids: np.ndarray, cuts: list) -> np.ndarray:
    """Labels that a view gives: 0, 1, or -1 for none."""
    out, u = np.full(len(z), -1), _even(ids, 2)
    for k in (0, 1):
        first, share, _ = cuts[k]
        at = _bins(z if k else -z)
        out[free & (at >= 0) & ((at >= first) | ((at == first - 1) & (u < share)))] = k
    return out


def _word_counts(text: tuple, rows: np.ndarray) -> np.ndarray:
    return np.bincount(_take(*text, np.flatnonzero(rows))[0], minlength=WORD_BUCKETS)


def picks(part: tuple, weights: list, cuts: list) -> tuple[np.ndarray, np.ndarray, list]:
    """Of the rows that views label: word counts by target and label and their numbers
    (labels by the metadata view, which the text view learns from), and the rows to hold as
    (target, view, label, row)."""
    ids, y, *views = part
    n_t = y.shape[1]
    have, n, held = np.zeros((n_t, 2, WORD_BUCKETS), np.int64), np.zeros((n_t, 2), np.int64), []
    u = _even(ids, 3)
    for t in range(n_t):
        for v, view in enumerate(views):
            label = given(logits(*view, weights[t][v]), y[:, t] == -1, ids, cuts[t][v])
            for k in (0, 1):
                if v == 1:
                    n[t, k] = (label == k).sum()
                    if n[t, k]:
                        have[t, k] = _word_counts(views[0], label == k)
                some = (label == k) & (u * max(1.0, cuts[t][v][k][2]) < HELD)
                held += [(t, v, k, r) for r in np.flatnonzero(some).tolist()]
    return have, n, held


def labelled(part: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Word counts by target and label of the labelled rows, but those kept apart."""
    ids, y, text, _ = part
    have, n = np.zeros((y.shape[1], 2, WORD_BUCKETS), np.int64), np.zeros((y.shape[1], 2), np.int64)
    for t in range(y.shape[1]):
        for k in (0, 1):
            rows = (y[:, t] == k) & ~is_apart(ids)
            n[t, k] = rows.sum()
            if n[t, k]:
                have[t, k] = _word_counts(text, rows)
    return have, n


def _rows(feats: list, size: list) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([*feats, np.zeros(0, np.int32)]).astype(np.int32),
            np.concatenate([[0], np.cumsum(size, dtype=np.int64)]).astype(np.int64))


def _only(view: tuple, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A view's rows with the features to ``use`` alone."""
    keep = use[view[0]]
    return view[0][keep], np.concatenate([[0], np.cumsum(keep, dtype=np.int32)])[view[1]]


def _joined(view: tuple, rows: np.ndarray, more: list, use: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a view and ``more`` of them, with the features to ``use`` alone."""
    if use is not None:
        view, more = _only(view, use), [x[use[x]] for x in more]
    feats, at = _take(*view, rows)
    extra, ends = _rows(more, [len(x) for x in more])
    return np.concatenate([feats, extra]), np.concatenate([at, at[-1] + ends[1:]])


def teach(sample: tuple, have: np.ndarray, n: np.ndarray, pool, rounds: int = ROUNDS) -> list[Views]:
    """The views of each target.  ``sample``: labelled rows; ``have``, ``n``: counts of all
    labelled rows; ``pool``: gives ``tails`` and ``picks`` of all unlabelled ones."""
    ids, y, text, meta = sample
    apart, n_t = is_apart(ids), y.shape[1]
    extra: list = [[[], []] for _ in range(n_t)]
    more, more_n = np.zeros_like(have), np.zeros_like(n)
    for r in range(rounds + 1):
        weights = []
        for t in range(n_t):
            learn = np.flatnonzero((y[:, t] >= 0) & ~apart)
            use = telling((have[t] + more[t]).astype(float), (n[t] + more_n[t]).astype(float))
            own = []
            for v, (view, size) in enumerate(((text, WORD_BUCKETS), (meta, META_SIZE))):
                rows = _joined(view, learn, [x[1] for x in extra[t][v]], None if v else use)
                label = np.concatenate([y[learn, t], np.array([x[0] for x in extra[t][v]], int)])
                own.append(fit(*rows, label, size))
            weights.append(own)
        if r == rounds:
            break
        count = pool.tails(weights)
        cuts = [[[cut(count[t, v, k]) for k in (0, 1)] for v in (0, 1)] for t in range(n_t)]
        more, more_n, held = pool.picks(weights, cuts)
        # The surest of one view become labels of the other.
        extra = [[[x[2:] for x in held if x[:2] == (t, 1 - v)] for v in (0, 1)] for t in range(n_t)]
    out = []
    for t in range(n_t):
        rows = np.flatnonzero((y[:, t] >= 0) & apart)
        a, b = (logits(*_take(*_only(v, w[:-1] != 0), rows), w) for v, w in zip((text, meta), weights[t], strict=True))
        cal = [_platt([x], y[rows, t]) for x in (a, b)]
        both = _platt([c[0] * x + c[1] for c, x in zip(cal, (a, b), strict=True)], y[rows, t])
        out.append(Views(*weights[t], *cal, both))
    return out


def _held_rows(part: tuple, held: list) -> list[tuple]:
    """(target, view, label, features in the other view) of rows to hold."""
    views = part[2:]
    return [(t, v, k, views[1 - v][0][views[1 - v][1][r]:views[1 - v][1][r + 1]]) for t, v, k, r in held]


@dataclass
class ArrayPool:
    """Unlabelled rows in memory."""

    part: tuple

    def tails(self, weights):
        return tails(self.part, weights)

    def picks(self, weights, cuts):
        have, n, held = picks(self.part, weights, cuts)
        return have, n, _held_rows(self.part, held)


def co_train(text: tuple, meta: tuple, y: np.ndarray, rounds: int = ROUNDS) -> Views:
    """Fit the views on rows in memory.  ``y``: 1, 0, or -1 for unlabelled rows."""
    part = np.arange(len(y)), np.asarray(y)[:, None], text, meta
    return teach(part, *labelled(part), ArrayPool(part), rounds)[0]


# -- Spark ------------------------------------------------------------------------

_PACKED = "ids binary, nulls binary, raw binary, low binary, codes binary, sizes binary, nums binary, vals binary"
_PARTS = [f.split()[0] for f in _PACKED.split(", ")]
#: Groups in which tasks' sums are added up, before those are.
SUMS = 64
_FOUND = "block int, counts binary, t int, v int, label int, id long, words binary, meta binary, toxic int"
_FOUND_ARROW = pa.schema([("block", pa.int32()), ("counts", pa.binary()), ("t", pa.int32()), ("v", pa.int32()),
                          ("label", pa.int32()), ("id", pa.int64()), ("words", pa.binary()), ("meta", pa.binary()),
                          ("toxic", pa.int32())])


def _planes(code: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Differences of each text's ascending word places, byte plane by byte plane."""
    step = np.diff(code, prepend=0)
    first = (np.cumsum(size) - size)[size > 0]
    step[first] = code[first]
    return np.ascontiguousarray(step.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()


def _places(planes: np.ndarray, size: np.ndarray) -> np.ndarray:
    step = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    total = np.concatenate([[0], np.cumsum(step)])
    return total[1:] - np.repeat(total[np.cumsum(size, dtype=np.int64) - size], size)


def _stage_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of packed features for each slice: words as distinct places in the slice's.
    Slices are numbered within their partition."""
    first = TaskContext.get().partitionId() << 32
    for number, part in enumerate(slices(batches)):
        words, code, off = word_arrays(part.column("text"))
        size = max(1, len(words))
        pair = np.unique(np.repeat(np.arange(len(off) - 1), np.diff(off)) * size + code)
        at = np.searchsorted(pair, np.arange(len(off)) * size)
        raw, low = _buckets(words)
        ids = part.column("doc_id")
        cols = [ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), raw, low,
                _planes(pair % size, np.diff(at)), np.diff(at), numbers(part.column("text")).ravel(),
                meta_values(part.column("source"), part.column("lang")).ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([first + number], pa.int64()),
                                          *(pa.array([pack(c)], pa.binary()) for c in cols)], names=["slice", *_PARTS])


def _stage_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, slice and place in it of the rows of staged slices that have an id."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, nulls = (unpack(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "nulls"))
            at = np.flatnonzero(nulls == 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(np.full(len(at), batch.column("slice")[i].as_py())),
                                              pa.array(at)], names=["id", "slice", "place"])


def _stage_labels(key: tuple, rows: pa.Table) -> pa.Table:
    """A slice's labelled places, labels (plus 1) and marks of sampled rows, packed as one."""
    table = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("place", *TARGETS, "inside")])
    table[1:1 + len(TARGETS)] += 1
    return pa.table({"slice": [key[0].as_py()], "labels": [pack(table.ravel())]})


def _staged(batches: Iterator[pa.RecordBatch], edges: np.ndarray | None) -> Iterator[tuple]:
    """(null ids, sampled, numbers, slice) of each staged slice; a slice is as above."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, nulls, raw, low, code, size, nums, vals = (unpack(batch.column(c)[i].as_py()) for c in _PARTS)
            ids, nulls, nums = ids.astype(np.int64), nulls.astype(bool), nums.reshape(-1, NUMBERS)
            if edges is None:
                yield nulls, None, nums, None
                continue
            size = size.astype(np.int64)
            code = _places(code, size)
            y, inside = np.full((len(ids), len(TARGETS)), -1), np.zeros(len(ids), bool)
            known = batch.column("labels")[i].as_py()
            if known is not None:
                place, *got, sampled = unpack(known, np.int64).reshape(len(TARGETS) + 2, -1)
                y[place], inside[place] = np.stack(got, axis=1) - 1, sampled > 0
            y[nulls] = -2
            both = np.stack([raw.astype(np.int32)[code], low.astype(np.int32)[code]], axis=1).ravel()
            text = both, np.concatenate([[0], np.cumsum(size, dtype=np.int64)]) * 2
            meta = meta_features(vals.astype(np.int64).reshape(-1, 2), nums, edges)
            yield nulls, inside, nums, (ids, y, text, meta)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND_ARROW, strict=True)],
                                      schema=_FOUND_ARROW)


def _count_rows(have: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Counts of a task, in blocks of features; the numbers of rows are the last block."""
    parts = [*np.split(have, BLOCKS, axis=2), n]
    return _found([(k, pack(np.ascontiguousarray(x).ravel()), *[None] * 7) for k, x in enumerate(parts)])


def _added(rows: DataFrame) -> DataFrame:
    """Sums of the packed ``counts`` of each ``block``, made in tasks: in groups of rows
    first, then over the groups, so that no task adds up more as tasks get more."""
    def add(found):
        total = None
        for b in found["counts"]:
            x = unpack(b, np.int64)
            total = x if total is None else total + x
        return found.iloc[:1].assign(counts=[pack(total)])[["block", "counts"]]

    kind = "block int, counts binary"
    part = rows.select("block", "counts", F.pmod(F.xxhash64("counts"), F.lit(SUMS)).alias("part"))
    return (part.groupBy("block", "part").applyInPandas(add, kind).groupBy("block").applyInPandas(add, kind))


def _gathered(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts over all tasks."""
    got = {r["block"]: unpack(r["counts"], np.int64) for r in _added(found.where("block >= 0")).collect()}
    n_t = len(TARGETS)
    if not got:
        return np.zeros((n_t, 2, WORD_BUCKETS), np.int64), np.zeros((n_t, 2), np.int64)
    return (np.concatenate([got[k].reshape(n_t, 2, -1) for k in range(BLOCKS)], axis=2), got[BLOCKS].reshape(n_t, 2))


@dataclass
class SparkPool:
    """Unlabelled rows of the staged slices."""

    staged: DataFrame
    edges: np.ndarray

    def tails(self, weights):
        edges = self.edges

        def count(batches):
            total = sum((tails(part, weights) for *_, part in _staged(batches, edges)), np.zeros(1, np.int64))
            if total.ndim > 1:
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([pack(total.ravel())], pa.binary())],
                                                 names=["block", "counts"])

        out = np.zeros((len(TARGETS), 2, 2, TAIL + 1), np.int64)
        for r in _added(self.staged.mapInArrow(count, "block int, counts binary")).collect():
            out += unpack(r["counts"], np.int64).reshape(out.shape)
        return out

    def picks(self, weights, cuts):
        edges = self.edges

        def pick(batches):
            have = n = None
            for *_, part in _staged(batches, edges):
                h, m, held = picks(part, weights, cuts)
                have, n = (h, m) if have is None else (have + h, n + m)
                rows = [(-1, None, t, v, k, None, pack(x), None, None) for t, v, k, x in _held_rows(part, held)]
                if rows:
                    yield _found(rows)
            if have is not None:
                yield _count_rows(have, n)

        found = self.staged.sparkSession.read.parquet(stage(self.staged.mapInArrow(pick, _FOUND), "picks"))
        held = [(r["t"], r["v"], r["label"], unpack(r["words"], np.int32))
                for r in found.where("block < 0").select("t", "v", "label", "words").orderBy(
                    "t", "v", "label", "words").toLocalIterator()]
        return *_gathered(found), held


def _edges(staged: DataFrame) -> np.ndarray:
    """Edges of the numbers' bins over all documents, from counts of the numbers cut to ten
    binary places."""
    def count(batches):
        for _, _, nums, _ in _staged(batches, None):
            key = nums.astype(np.float32).view(np.uint32) >> np.uint32(13)
            for j in range(NUMBERS):
                k, n = np.unique(key[:, j], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), j)), pa.array(k.astype(np.int64)), pa.array(n)],
                                                 names=["j", "key", "n"])

    got = staged.mapInArrow(count, "j long, key long, n long").groupBy("j", "key").agg(
        F.sum("n").alias("n")).orderBy("j", "key").toPandas()
    cuts, out = np.arange(1, BINS + 1) / (BINS + 1), np.zeros((NUMBERS, BINS))
    for j, rows in got.groupby("j"):
        below = np.cumsum(rows["n"].to_numpy())
        key = rows["key"].to_numpy()[np.searchsorted(below, cuts * below[-1])]
        out[int(j)] = (key.astype(np.uint32) << np.uint32(13)).view(np.float32)
    return out


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[Views], np.ndarray, DataFrame]:
    """The views of both targets, the bins of the numbers and the staged features.  Rows
    without a label, and ids that are null, are not sampled as labelled; repeated labels
    count once."""
    rows = documents(docs, "source", "lang").select(
        "doc_id", "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"))
    own = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"),
                        F.col("toxic").cast("int").alias("toxic")).dropna(subset=["id"])
    own = own.groupBy("id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    spark = docs.sparkSession
    own = spark.read.parquet(stage(own.withColumn("h", F.xxhash64("id")), "labels"))
    last = own.orderBy("h", "id").limit(LABELLED).agg(F.max(F.struct("h", "id")).alias("last")).first()["last"]
    inside = F.lit(False) if last is None else F.coalesce(
        (F.col("h") < last["h"]) | ((F.col("h") == last["h"]) & (F.col("id") <= last["id"])), F.lit(False))
    # Texts stay where they are read.  Only ids meet the labels, by a merge at every size;
    # the labels then go to their slices of features.
    plain = stage(rows.mapInArrow(_stage_features, f"slice long, {_PACKED}"), "features")
    slices_ = spark.read.parquet(plain)
    known = (slices_.select("slice", "ids", "nulls").mapInArrow(_stage_ids, "id long, slice long, place long").hint("merge")
             .join(own, "id").select("slice", "place", *[F.coalesce(t, F.lit(-1)).alias(t) for t in TARGETS],
                                     inside.cast("int").alias("inside"))
             .groupBy("slice").applyInArrow(_stage_labels, "slice long, labels binary"))
    staged = spark.read.parquet(stage(slices_.hint("merge").join(known, "slice", "left"), "labelled-features"))
    drop_staged(spark, plain)
    edges = _edges(staged)

    def count(batches):
        have = n = None
        for _, sampled, _, part in _staged(batches, edges):
            h, m = labelled(part)
            have, n = (h, m) if have is None else (have + h, n + m)
            ids, y = part[:2]
            (words, at), (meta, m_at) = part[2:]
            rows = [(-1, None, 0, 0, int(y[r, 0]), int(ids[r]), pack(words[at[r]:at[r + 1]]),
                     pack(meta[m_at[r]:m_at[r + 1]]), int(y[r, 1])) for r in np.flatnonzero(sampled).tolist()]
            if rows:
                yield _found(rows)
        if have is not None:
            yield _count_rows(have, n)

    found = spark.read.parquet(stage(staged.mapInArrow(count, _FOUND), "labelled"))
    got = found.where("block < 0").select("id", "label", "toxic", "words", "meta").dropDuplicates(["id"]).toArrow()
    got = got.sort_by("id")
    have, n = _gathered(found)
    views = []
    for c in ("words", "meta"):
        feats = [unpack(b.as_py(), np.int32) for b in got.column(c)]
        views.append(_rows(feats, [len(f) for f in feats]))
        del feats
    y = np.stack([got.column(c).to_numpy() for c in ("label", "toxic")], axis=1).astype(int).reshape(-1, 2)
    sample = got.column("id").to_numpy().astype(np.int64), y, *views
    del got
    trim()
    return teach(sample, have, n, SparkPool(staged, edges)), edges, staged


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, p_text, p_meta, score, toxic, kept per row: calibrated probabilities of
    good quality by either view and both, that of toxicity, and whether the first
    reaches ``threshold`` and the second does not.

    Null texts count as empty, null sources and languages as empty names; null ids stay;
    repeated rows give repeated results.  Without labels every probability is 0.5, and
    all rows are kept.
    """
    views, edges, staged = train(docs, labels)
    quality, toxicity = views
    nothing = all(not v.text.any() for v in views)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nulls, _, _, (ids, _, text, meta) in _staged(batches, edges):
            pt, pm, p = quality.probabilities(text, meta)
            toxic = toxicity.probabilities(text, meta)[2]
            kept = (p >= threshold) & ((toxic < threshold) | nothing)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=nulls), *(pa.array(x) for x in (pt, pm, p, toxic, kept))],
                names=["doc_id", "p_text", "p_meta", "score", "toxic", "kept"])

    return staged.mapInArrow(score, SCHEMA)
