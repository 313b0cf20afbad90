"""Benchmark decontamination with spaced seeds.

Fixed masks choose token positions and ignore the others, so a seed still hits
where a substitution falls on an ignored one.  The hashes of all benchmark windows
form a table of bounded size that travels with the tasks; benchmarks beyond the
bound are taken in blocks, each against all documents.  Around every hit the two
texts are compared token by token along its diagonal; a row is given where any stretch
of it meets the rule.  Every such stretch holds a seed: one with at least six equal
tokens, and three for each substitution, has three equal tokens in a row, or is two,
two and two of them with single substitutions between (the last two masks).
Documents are read in place: no shuffle, no join, so hot sources don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import documents, hash_words, importable, mix, slices, word_arrays

#: Positions that a seed compares (1) and ignores (0).
MASKS = ("1111011", "11010010111", "1100101011001", "1010110001011", "111", "11011011")
#: A stretch counts from this many equal tokens on, or the whole of a shorter item,
LEAST_EQUAL = 13
#: but not below this many, and with at most this share of substitutions.
SHORTEST = 6
MOST_DIFFERENT = 0.25
#: Tokens of diagonals that are compared at once.
COMPARED = 1 << 21
#: Tokens of the benchmark that one pass holds.
BLOCK_TOKENS = 1 << 20

SCHEMA = ("doc_id long, item_id long, n_equal long, n_compared long, doc_start long, "
          "item_start long, item_tokens long")
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def token_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words in compatibility form, lower case, letters and
    digits only (words without any are left out), and where each text starts."""
    words, code, off = word_arrays(text)
    plain = pc.replace_substring_regex(
        pc.utf8_lower(pc.utf8_normalize(words, form="NFKC")), r"[^\p{L}\p{N}\p{M}]+", "")
    keep = np.asarray(pc.not_equal(plain, ""))[code] if len(code) else np.zeros(0, bool)
    off = np.concatenate([[0], np.cumsum(keep)])[off]
    return hash_words(plain)[code[keep]] if len(code) else np.zeros(0, np.uint64), off


def _seeds(tokens: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Seed hashes of all windows of a row of tokens."""
    n = len(tokens) - len(mask) + 1
    out = np.full(max(n, 0), np.uint64(salt + 1))
    for k, bit in enumerate(mask):
        if bit == "1" and n > 0:
            out = out * np.uint64(0x9E3779B97F4A7C15) + tokens[k:k + n]
    return mix(out)


@dataclass
class SeedTable:
    """Tokens of a benchmark block and the places of its seeds, by hash."""

    item_ids: list
    tokens: np.ndarray
    starts: np.ndarray
    keys: np.ndarray
    places: np.ndarray
    filter: np.ndarray

    @staticmethod
    def build(item_ids: list, texts: pa.Array) -> SeedTable:
        tokens, starts = token_hashes(texts)
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        keys, places = [], []
        for salt, mask in enumerate(MASKS):
            got = _seeds(tokens, mask, salt)
            at = np.arange(len(got))
            # Windows within one item only.
            own = owner[at] == owner[at + len(mask) - 1]
            keys.append(got[own])
            places.append(at[own])
        keys, places = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(keys, kind="stable")
        bits = np.zeros(1 << 22, bool)
        bits[(keys >> np.uint64(42)).astype(np.int64)] = True
        return SeedTable(item_ids, tokens, starts, keys[order], places[order], bits)

    def hits(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``tokens``, place in the benchmark) of all seed hits."""
        here, there = [], []
        for salt, mask in enumerate(MASKS):
            got = _seeds(tokens, mask, salt)
            at = np.flatnonzero(self.filter[(got >> np.uint64(42)).astype(np.int64)])
            lo = np.searchsorted(self.keys, got[at], side="left")
            n = np.searchsorted(self.keys, got[at], side="right") - lo
            here.append(np.repeat(at, n))
            there.append(self.places[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        return np.concatenate(here), np.concatenate(there)


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """Start and end of the stretch with the most equal tokens less three times the
    others (so at most a quarter differs); the first among equals."""
    gain = np.concatenate([[0], np.cumsum(np.where(equal, 1, -3))])
    floor = np.minimum.accumulate(gain)
    end = int(np.argmax(gain - floor))
    return int(np.argmin(gain[:end + 1])), end


def widest_stretch(equal: np.ndarray) -> tuple[int, int]:
    """Start and end of the stretch with the most equal tokens of which at most a quarter
    differs; the first among equals, without differing ends."""
    gain = np.concatenate([[0], np.cumsum(np.where(equal, 1, -3))])
    # The earliest start from which the gain up to an end is not negative.
    start = np.searchsorted(-np.minimum.accumulate(gain), -gain, side="left")
    have = np.concatenate([[0], np.cumsum(equal)])
    end = int(np.argmax(have - have[start]))
    inside = np.flatnonzero(equal[start[end]:end])
    if not len(inside):
        return 0, 0
    return int(start[end] + inside[0]), int(start[end] + inside[-1]) + 1


def _enough(tokens: np.ndarray, table: SeedTable, a: np.ndarray, n: np.ndarray, shift: np.ndarray,
            least: np.ndarray) -> np.ndarray:
    """Diagonals (``n`` tokens from ``a`` on) with at least so many equal tokens in all."""
    out = np.flatnonzero(n >= least)
    ends = np.cumsum(n[out])
    keep, at = [], 0
    while at < len(out):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARED, side="right")))
        some = out[at:to]
        first = np.cumsum(n[some]) - n[some]
        here = np.repeat(a[some] - first, n[some]) + np.arange(n[some].sum())
        same = tokens[here] == table.tokens[here - np.repeat(shift[some], n[some])]
        keep.append(some[np.add.reduceat(same.astype(np.int64), first) >= least[some]])
        at = to
    return np.concatenate(keep) if keep else out


def overlaps(text: pa.Array, table: SeedTable) -> list[tuple]:
    """(row, item, equal, compared, doc_start, item_start, item tokens) for each
    text and item that share a long enough stretch; the best one of each pair."""
    tokens, off = token_hashes(text)
    here, there = table.hits(tokens)
    if not len(here):
        return []
    row = np.searchsorted(off, here, side="right") - 1
    item = np.searchsorted(table.starts, there, side="right") - 1
    # One comparison for each text, item and diagonal.
    order = np.lexsort((here - there, item, row))
    row, item, shift = row[order], item[order], (here - there)[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(shift) != 0)
    row, item, shift = row[new], item[new], shift[new]
    size = np.diff(table.starts)[item]
    least = np.maximum(SHORTEST, np.minimum(LEAST_EQUAL, np.ceil(size * (1 - MOST_DIFFERENT)))).astype(np.int64)
    a = np.maximum(off[row], table.starts[item] + shift)
    n = np.minimum(off[row + 1], table.starts[item + 1] + shift) - a
    use = _enough(tokens, table, a, n, shift, least)
    best: dict[tuple, tuple] = {}
    for r, i, d, s, length, whole, enough in zip(*(x[use].tolist() for x in (row, item, shift, a, n, size, least)),
                                                 strict=True):
        same = tokens[s:s + length] == table.tokens[s - d:s - d + length]
        for stretch in (best_stretch, widest_stretch):
            x, y = stretch(same)
            equal = int(same[x:y].sum())
            if equal >= enough and y - x - equal <= MOST_DIFFERENT * (y - x):
                one = (equal, y - x, s + x - int(off[r]), s + x - d - int(table.starts[i]), whole)
                if (r, i) not in best or (-one[0], *one[1:]) < (-best[r, i][0], *best[r, i][1:]):
                    best[r, i] = one
                break
    return [(r, i, *v) for (r, i), v in best.items()]


def seed_tables(benchmark: DataFrame) -> list[SeedTable]:
    """Tables of the benchmark in blocks of about BLOCK_TOKENS tokens; each block is
    bounded, however large the benchmark.  Null texts are empty and match nothing."""
    importable(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # A token and its gap take two characters or more.
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / (2 * BLOCK_TOKENS)))
    out = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy(
            "item_id", "text").collect()
        if rows:
            out.append(SeedTable.build([r[0] for r in rows], pa.array([r[1] for r in rows])))
    return out


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each row of ``docs`` and benchmark item that overlap: doc_id, item_id,
    n_equal, n_compared, doc_start, item_start, item_tokens (token places).

    Null and empty texts overlap nothing; null ids stay null; repeated rows give
    repeated results; without documents or items there are none.
    """
    def scan(batches: Iterator[pa.RecordBatch], table: SeedTable) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            got = overlaps(part.column("text"), table)
            if got:
                ids = part.column("doc_id").to_pylist()
                cols = [[ids[g[0]] for g in got], [table.item_ids[g[1]] for g in got],
                        *zip(*[g[2:] for g in got], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _NAMES)

    rows = documents(docs)
    out = None
    for table in seed_tables(benchmark):
        some = rows.mapInArrow(lambda b, t=table: scan(b, t), SCHEMA)
        out = some if out is None else out.unionAll(some)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all their columns."""
    importable(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch], table: SeedTable) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            bad = {g[0] for g in overlaps(part.column("text"), table)}
            yield part.filter(pa.array([i not in bad for i in range(part.num_rows)]))

    for table in seed_tables(benchmark):
        docs = docs.mapInArrow(lambda b, t=table: scan(b, t), docs.schema)
    return docs
