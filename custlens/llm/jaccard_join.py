"""N-gram Jaccard join by universe partition and pigeonhole.

A document is the set of its distinct 5-word shingles; two link at a Jaccard
similarity of 0.75 or more.  Steps, all of them exact:

1. Shingles that no other document has bound a set's similarity to anything from
   above; sets with too many of them cannot link and drop out.  Shingle hashes
   travel sorted, cut to few bits and delta-coded; a collision only keeps a set.
2. The universe is partitioned by hash into segments, in a table for each size band
   and its upper neighbour.  If two sets differ in at most H tokens, the pigeonhole
   gives a segment in which they differ in at most its allotted number, 0 or 1,
   as long as the allotments plus one add up to more than H.  Segment subsets, and
   one-deletion neighbourhoods where 1 is allotted, are the index keys.  Allotments
   follow the measured cost of each segment's keys.
3. Sets that share a key become candidates in stars, whose components are verified
   exactly: each group in memory by its inverted lists, visiting only sets that
   aren't reached yet; larger groups in pairs of blocks.
4. The components of the verified links are the result.

Copies are one set from the start and are never paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.llm.common import (documents, hash_words, mix, pack, slices, stage, trim, unpack, unused,
                                 word_arrays)
from custlens.llm.components import components, stars

WORDS = 5
#: Least similarity, as a fraction of integers.
NUMERATOR, DENOMINATOR = 3, 4
#: Shingles of a shard and tokens of a group that one task verifies, about.
SHARD_SHINGLES = 2_500_000
GROUP_TOKENS = 4_000_000
#: Index keys of sets that are taken together, and bytes of a slice of texts.
CHUNK_KEYS = 400_000
SLICE_BYTES = 6 << 20
#: Spare bits of cut shingle hashes: a collision's chance is 2 to the power of minus these.
SPARE_BITS = 6
#: Contents of segments are keys from at most this many tokens on.
MOST_LEAST = 3
#: One of so many index keys is counted to estimate costs.
COST_SAMPLE = 32

_U = np.uint64
_STEPS = mix(np.arange(1, WORDS + 1, dtype=np.uint64))


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, in a row, and where each starts.

    Fewer than five words make one shingle of the whole sequence; no words, none.
    """
    words, code, off = word_arrays(text, lower=True)
    hashed = hash_words(words)[code] if len(code) else np.zeros(0, np.uint64)
    n_words = np.diff(off)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    long = np.zeros(0, np.uint64)
    whose = np.zeros(0, np.int64)
    if len(hashed) >= WORDS:
        n = len(hashed) - WORDS + 1
        long = np.zeros(n, np.uint64)
        for k in range(WORDS):
            long += mix(hashed[k:k + n] + _STEPS[k])
        own = owner[:n] == owner[WORDS - 1:]
        long, whose = mix(long[own]), owner[:n][own]
    short, of = [], []
    for i in np.flatnonzero((n_words > 0) & (n_words < WORDS)):
        w = hashed[off[i]:off[i + 1]]
        short.append(mix(mix(w + _STEPS[:len(w)]).sum(dtype=np.uint64).reshape(1) + _U(len(w)))[0])
        of.append(i)
    if short:
        long = np.concatenate([long, np.array(short, np.uint64)])
        whose = np.concatenate([whose, np.array(of)])
    order = np.lexsort((long, whose))
    long, whose = long[order], whose[order]
    first = np.ones(len(long), bool)
    first[1:] = (long[1:] != long[:-1]) | (whose[1:] != whose[:-1])
    long, whose = long[first], whose[first]
    return long, np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(n_words)))])


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums (mod 2^64) of the stretches of ``values``."""
    total = np.concatenate([[_U(0)], np.cumsum(values, dtype=np.uint64)])
    return total[starts[1:]] - total[starts[:-1]]


def digests(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 63-bit content hash of each set: the set's node."""
    return (mix(_sums(mix(tokens ^ _U(0x5851F42D4C957F2D)), starts)
                + _U(0x9E3779B97F4A7C15) * np.diff(starts).astype(np.uint64)) >> _U(1)).astype(np.int64)


# -- step 1: shingles that only one set has ----------------------------------

_MESSAGE = "shard int, slice long, n_sets int, values binary, owners binary, docs binary"
_COUNTS = "slice long, counts binary, docs binary"


def _messages(batches: Iterator[pa.RecordBatch], shards: int, bits: int) -> Iterator[pa.RecordBatch]:
    base, serial = TaskContext.get().partitionId() << 32, 0
    for part in slices(batches, max_bytes=SLICE_BYTES):
        tokens, starts = shingle_sets(part.column("text"))
        node = digests(tokens, starts)
        # Copies in a slice send their shingles once.
        _, first, same = np.unique(node, return_index=True, return_inverse=True)
        place = np.full(len(node), -1, np.int64)
        place[first] = np.arange(len(first))
        owner = np.repeat(place, np.diff(starts))
        keep = owner >= 0
        cut, owner = tokens[keep] >> _U(64 - bits), owner[keep]
        order = np.argsort(cut)
        cut, owner = cut[order], owner[order]
        shard = ((cut * _U(shards)) >> _U(bits)).astype(np.int64)
        edge = np.searchsorted(shard, np.arange(shards + 1))
        ids = part.column("doc_id")
        docs = pa.BufferOutputStream()
        table = pa.record_batch([ids, pa.array(np.diff(starts)), pa.array(node), pa.array(same)],
                                names=["doc_id", "n", "node", "place"])
        with pa.ipc.new_stream(docs, table.schema) as out:
            out.write_batch(table)
        number = base + serial
        serial += 1
        rows = [(-1 - number % shards, number, len(first), None, None, docs.getvalue().to_pybytes())]
        for s in np.flatnonzero(np.diff(edge)):
            a, b = edge[s], edge[s + 1]
            rows.append((int(s), number, len(first), pack(np.diff(cut[a:b], prepend=_U(0))),
                         pack(owner[a:b]), None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()),
                strict=True)], names=[f.split()[0] for f in _MESSAGE.split(", ")])


def _count_private(messages: pd.DataFrame) -> pd.DataFrame:
    """For each message of a shard, how many of each set's shingles no other message
    or set of the shard has."""
    if messages["shard"].iloc[0] < 0:
        return pd.DataFrame({"slice": messages["slice"], "counts": None, "docs": messages["docs"]})
    values = [np.cumsum(unpack(v, np.uint64)) for v in messages["values"]]
    size = [len(v) for v in values]
    value = np.concatenate(values)
    order = np.argsort(value)
    value = value[order]
    edge = np.concatenate([[True], value[1:] != value[:-1], [True]])
    alone = np.zeros(len(value), bool)
    alone[order] = edge[1:] & edge[:-1]
    out, at = [], 0
    for n_sets, owners, n in zip(messages["n_sets"], messages["owners"], size, strict=True):
        own = unpack(owners, np.int64)[alone[at:at + n]]
        out.append(pack(np.bincount(own, minlength=n_sets)))
        at += n
    del values, value, order, edge, alone
    trim()
    return pd.DataFrame({"slice": messages["slice"], "counts": out, "docs": None})


def _per_document(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of one slice to a row per document."""
    docs = rows["docs"].dropna().iloc[0]
    table = pa.ipc.open_stream(docs).read_all().to_pandas(integer_object_nulls=True)
    counts = [unpack(c, np.int64) for c in rows["counts"] if c is not None]
    private = sum(counts) if counts else np.zeros(int(table["place"].max()) + 1, np.int64)
    return pd.DataFrame({"doc_id": table["doc_id"].astype("Int64"), "n": table["n"],
                         "node": table["node"], "private": private[table["place"]]})


def _document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, node, private of every row: set size, content hash, and how many
    of its shingles no other set has (copies in other slices count as others)."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*")).first()
    expected = max(2, (size["b"] or 0) // 5)
    shards = max(1, math.ceil(expected / SHARD_SHINGLES))
    bits = min(56, expected.bit_length() + SPARE_BITS)
    return (docs.mapInArrow(lambda b: _messages(b, shards, bits), _MESSAGE)
            .groupBy("shard").applyInPandas(_count_private, _COUNTS)
            .groupBy("slice").applyInPandas(
                _per_document, "doc_id long, n long, node long, private long"))


# -- step 2: tables, allotments and keys -------------------------------------

def band_edges(top: int) -> list[int]:
    """Least sizes of the bands: a set's partners lie in its own band or a neighbour."""
    edges = [1]
    while edges[-1] <= top:
        edges.append(edges[-1] * DENOMINATOR // NUMERATOR + 1)
    return edges


def most_different(edges: list[int], k: int) -> int:
    """Most tokens in which linked sets of table ``k`` differ: those of band k with
    others of bands k and k + 1."""
    r = edges[k + 1] - 1
    return (r + r * DENOMINATOR // NUMERATOR) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def segment_count(h: int) -> int:
    return max(1, math.ceil(0.75 * (h + 1)))


def _segments(tokens: np.ndarray, table: int, m: int) -> tuple[np.ndarray, ...]:
    """Tokens' segments and contents in order of segment, the segments that have
    tokens, where each starts, and the subset's hash in each."""
    mixed = mix(tokens + _U((table + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
    segment = ((mixed >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    segment, mixed = segment[order], mixed[order]
    at = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    return segment, mixed, segment[at], at, np.add.reduceat(mixed, at)


def _key(table: int, segment: np.ndarray, content: np.ndarray) -> np.ndarray:
    return mix(content + mix(segment.astype(np.uint64) + _U((table + 1) << 40)))


def keys(tokens: np.ndarray, table: int, m: int, level: np.ndarray, least: int) -> np.ndarray:
    """Index keys of a set in a table.  ``level`` allots each segment -1 (none), 0 (its
    subset) or 1 (also the subsets less one token).  Contents of fewer tokens than
    ``least`` are no keys."""
    segment, mixed, have, at, whole = _segments(tokens, table, m)
    size = np.diff(np.concatenate([at, [len(segment)]]))
    used = (level[have] >= 0) & (size >= least)
    out = [_key(table, have[used], whole[used])]
    near = (level[segment] == 1) & (np.repeat(size, size) > least)
    if near.any():
        less = np.repeat(whole, size) - mixed
        out.append(_key(table, segment[near], less[near]))
    if least == 0:
        none = np.setdiff1d(np.flatnonzero(level >= 0), have)
        out.append(_key(table, none, np.zeros(len(none), np.uint64)))
    return np.concatenate(out)


def _tables_of(n: int, edges: list[int]) -> list[int]:
    band = int(np.searchsorted(edges, n, side="right")) - 1
    return [k for k in (band, band - 1) if k >= 0]


def _cost_rows(batches: Iterator[pa.RecordBatch], edges: list[int]) -> Iterator[pa.RecordBatch]:
    """Sampled keys by table, segment and level, and the most scarce segments by table."""
    for batch in batches:
        cols: list[list[np.ndarray]] = [[], [], [], []]
        scarce: dict[tuple[int, int], int] = {}
        for b in batch.column("tokens").to_pylist():
            tokens = unpack(b)
            for k in _tables_of(len(tokens), edges):
                m = segment_count(most_different(edges, k))
                segment, mixed, have, at, whole = _segments(tokens, k, m)
                size = np.diff(np.concatenate([at, [len(segment)]]))
                for least in range(1, MOST_LEAST + 1):
                    few = m - int((size >= least).sum())
                    scarce[k, least] = max(scarce.get((k, least), 0), few)
                for lvl, seg, key in ((0, have, _key(k, have, whole)),
                                      (1, segment, _key(k, segment, np.repeat(whole, size) - mixed))):
                    pick = key % _U(COST_SAMPLE) == 0
                    for c, v in zip(cols, (np.full(pick.sum(), k), seg[pick],
                                           np.full(pick.sum(), lvl), key[pick].astype(np.int64)),
                                    strict=True):
                        c.append(v)
        # The most segments below each least size ride along as rows of level 1 + size.
        extra = np.array([(k, z, 1 + least, 0) for (k, least), z in scarce.items()], np.int64).reshape(-1, 4)
        arrays = [np.concatenate([*c, extra[:, i]]) for i, c in enumerate(cols)]
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays],
                                         names=["table", "segment", "level", "key"])


def allot(h: int, m: int, scarce: dict[int, int], cost: dict[tuple[int, int], float]) -> tuple[np.ndarray, int]:
    """Levels of a table's segments at least cost, and the least content of a key.

    Contents of few tokens are shared by chance, so they are no keys where that can be
    afforded: a segment in which either set has too few tokens hides at most one credit
    for each such set, so the needed sum of (level + 1) grows by twice the most such
    segments of any set (``scarce``, by least content).
    """
    least = max([t for t, z in scarce.items() if h + 1 + 2 * z <= 2 * m], default=0)
    need = h + 1 + 2 * scarce.get(least, 0)
    level = np.full(m, -1, np.int64)
    subset = np.array([cost.get((i, 0), 0.0) + 1e-9 for i in range(m)])
    nearby = np.array([cost.get((i, 1), 0.0) + 1e-6 for i in range(m)])
    # Cheapest next credit: a first one costs the subset's keys, a second the deletions'.
    steps = np.concatenate([subset, np.maximum(nearby, subset)])
    for s in np.argsort(steps, kind="stable")[:need]:
        level[s % m] += 1
    return level, least


def _plan(sets: DataFrame, edges: list[int]) -> dict[int, tuple[int, np.ndarray, int]]:
    """Segments, levels and the least content of every table in use, from the keys' costs."""
    rows = sets.select("tokens").mapInArrow(
        lambda b: _cost_rows(b, edges), "table long, segment long, level long, key long")
    counted = rows.groupBy("table", "segment", "level", "key").count()
    cost = counted.groupBy("table", "segment", "level").agg(
        F.sum(F.col("count").cast("double") * F.col("count")).alias("c")).collect()
    out = {}
    for k in {r["table"] for r in cost}:
        h = most_different(edges, k)
        m = segment_count(h)
        own = [r for r in cost if r["table"] == k]
        scarce = {t: max([r["segment"] for r in own if r["level"] == 1 + t], default=0)
                  for t in range(1, MOST_LEAST + 1)}
        level, least = allot(h, m, scarce, {(r["segment"], r["level"]): r["c"] for r in own if r["level"] < 2})
        out[k] = (m, level, least)
    return out


def _index(batches: Iterator[pa.RecordBatch], edges: list[int], plan: dict) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, other, low).  Sets taken together (up to CHUNK_KEYS keys) that
    share a key are linked here, in a star, and send the key once; ``other`` marks such
    links."""
    key: list[np.ndarray] = []
    node: list[np.ndarray] = []
    low: list[np.ndarray] = []
    for batch in batches:
        for b, d in zip(batch.column("tokens"), batch.column("node").to_pylist(), strict=True):
            tokens = unpack(b.as_py())
            for k in _tables_of(len(tokens), edges):
                some = np.unique(keys(tokens, k, *plan[k]))
                key.append(some)
                node.append(np.full(len(some), d))
                # In table k, sets of band k meet all; those of band k + 1 meet only the former.
                low.append(np.full(len(some), len(tokens) < edges[k + 1]))
            if sum(map(len, key)) >= CHUNK_KEYS:
                yield _linked(*map(np.concatenate, (key, node, low)))
                key, node, low = [], [], []
                trim()
    if key:
        yield _linked(*map(np.concatenate, (key, node, low)))


def _linked(key: np.ndarray, node: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    """Stars of the nodes that share a key here, and one row for each key."""
    order = np.lexsort((node, ~low, key))
    key, node, low = key[order], node[order], low[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    center = node[first][np.cumsum(first) - 1]
    link = ~first & (node != center)
    pairs = np.unique(np.stack([node[link], center[link]]), axis=1)
    n = pairs.shape[1]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([key[first], mix(pairs[0].astype(np.uint64) ^ mix(
            pairs[1].astype(np.uint64)))]).astype(np.int64)),
         pa.array(np.concatenate([node[first], pairs[0]])),
         pa.array(np.concatenate([np.zeros(first.sum(), np.int64), pairs[1]]),
                  mask=np.arange(first.sum() + n) < first.sum()),
         pa.array(np.concatenate([low[first], np.zeros(n, bool)]))],
        names=["key", "node", "other", "low"])


def _candidates(sets: DataFrame, edges: list[int]) -> DataFrame:
    """Edges (u, v) whose components hold every pair that shares a key."""
    plan = _plan(sets, edges)
    rows = sets.select("node", "tokens").mapInArrow(
        lambda b: _index(b, edges, plan), "key long, node long, other long, low boolean")
    same = Window.partitionBy("key")
    rows = rows.withColumn("center", F.min("node").over(same)).withColumn(
        "meet", F.max("low").over(same))
    linked = F.when(F.col("other").isNotNull(), F.col("other")).when(F.col("meet"), F.col("center"))
    return rows.select(F.col("node").alias("u"), linked.alias("v")).where(F.col("u") != F.col("v"))


# -- step 3: exact verification ----------------------------------------------

def links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Verified links that span the components of a group of sets.

    Sets are visited breadth first; the inverted lists hold only sets that aren't
    reached yet and are rebuilt as those halve, so copies of one text are
    compared once each.
    """
    n = np.array([len(s) for s in sets], np.int64)
    if len(sets) == 2:
        same = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if DENOMINATOR * same >= NUMERATOR * (n.sum() - same) else []
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(sets)), n)
    top = int(token.max()) + 1 if len(token) else 0
    left = np.ones(len(sets), bool)

    def lists():
        keep = left[owner]
        t, o = token[keep], owner[keep]
        order = np.argsort(t, kind="stable")
        return o[order], np.concatenate([[0], np.cumsum(np.bincount(t, minlength=top))])

    posting, at = lists()
    built, out = int(left.sum()), []
    for seed in range(len(sets)):
        if not left[seed]:
            continue
        left[seed] = False
        queue = [seed]
        while queue and left.any():
            x = queue.pop()
            t = token[starts[x]:starts[x + 1]]
            size = at[t + 1] - at[t]
            total = int(size.sum())
            place = np.repeat(at[t] - (np.cumsum(size) - size), size) + np.arange(total)
            same = np.bincount(posting[place], minlength=len(sets))
            near = np.flatnonzero((same > 0) & left)
            near = near[DENOMINATOR * same[near] >= NUMERATOR * (n[x] + n[near] - same[near])]
            out += [(x, int(y)) for y in near]
            left[near] = False
            queue += near.tolist()
            rest = int(left.sum())
            if rest * 2 < built:
                posting, at = lists()
                built = max(1, rest)
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group to the components of its verified links, as stars; holds one
    group at a time."""
    group, nodes, sets, found = None, [], [], []

    def close():
        found.extend(stars((nodes[a], nodes[b]) for a, b in links(sets)))

    for batch in batches:
        for g, d, b in zip(*(batch.column(c).to_pylist() for c in ("grp", "node", "tokens")), strict=True):
            if g != group:
                if len(sets) > 1:
                    close()
                group, nodes, sets = g, [], []
            nodes.append(d)
            sets.append(unpack(b))
        if found:
            yield _pairs(found)
            found.clear()
        trim()
    if len(sets) > 1:
        close()
    if found:
        yield _pairs(found)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _verified(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (u, v) that span the true components, inside candidate groups.

    A group beyond GROUP_TOKENS is split into blocks by hash and every pair of blocks
    is verified on its own, so no task holds more than two blocks."""
    rows = sets.join(groups, "node")
    size = rows.groupBy("component").agg(F.sum("n").alias("total"))
    blocks = F.greatest(F.lit(1), F.ceil(2 * F.col("total") / GROUP_TOKENS)).cast("int")
    rows = rows.join(size, "component").withColumn("blocks", F.when(
        F.col("total") <= GROUP_TOKENS, 1).otherwise(blocks))
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks").cast("long")).cast("int")
    # A set goes to the groups of its block with each block, its own included.
    others = F.when(F.col("blocks") <= 2, F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    name = F.when(F.col("blocks") <= 2, F.concat_ws(":", "component")).otherwise(F.concat_ws(
        ":", "component", F.least("own", "other"), F.greatest("own", "other")))
    rows = rows.select(name.alias("grp"), "node", "tokens")
    # Blocks of their own are inside each of their pairs.
    return rows.repartition("grp").sortWithinPartitions("grp", "node").mapInArrow(
        _verify, "u long, v long")


# -- the join -----------------------------------------------------------------

def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        tokens, starts = shingle_sets(part.column("text"))
        node = digests(tokens, starts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(np.diff(starts).astype(np.int64)),
             pa.array([pack(tokens[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())],
            names=["node", "n", "tokens"])


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row.

    component_id is the smallest doc_id of the rows that links reach, the row's own
    included.  Null texts and texts without words have an empty set, link with
    nothing, and are their own component.  A null doc_id stays null and is never a
    component's id unless all its ids are null.  Rows are documents each, also
    where they repeat a doc_id.
    """
    spark = docs.sparkSession
    rows = documents(docs)
    every = spark.read.parquet(stage(_document_sets(rows), "sets"))
    real = every.where(F.col("n") > 0)
    reps = real.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"),
                                    F.min("private").alias("private"))
    # A partner shares at most the shingles that aren't private, of a union no smaller
    # than the set; sets of one or two shingles link only with their copies.
    can = (DENOMINATOR * (F.col("n") - F.col("private")) >= NUMERATOR * F.col("n")) & (F.col("n") > 2)
    # A bearer of each surviving set; null ids bear where no other does.
    bearers = reps.where(can).select("rep").distinct()
    bearing = rows.join(bearers.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(bearers["rep"]), "left_semi")
    sets = spark.read.parquet(stage(
        bearing.select("text").mapInArrow(_sets, "node long, n long, tokens binary")
        .where("n > 2").dropDuplicates(["node"]), "shingles"))
    top = sets.agg(F.max("n")).first()[0]
    if top is None:
        label = reps.select("node", F.col("rep").alias("component_id"))
    else:
        groups = components(_candidates(sets, band_edges(top)))
        groups = spark.read.parquet(stage(groups, "groups"))
        found = components(_verified(sets, groups))
        label = reps.join(found, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        least = label.groupBy("component").agg(F.min("rep").alias("component_id"))
        label = label.join(least, "component").select("node", "component_id")
    linked = real.join(label, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionAll(every.where(F.col("n") == 0).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less all but one of each group of linked documents: the row
    of the smallest doc_id, and of several texts with that id the one of the smallest
    hash (of repeated rows one stays).  Null ids come last.  Rows without words link with
    nothing and stay, once for each distinct doc_id and text."""
    # Rows are told apart by id and text, as an id may have several texts.
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id")).distinct()
    groups = join(docs.select(key.alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id").distinct()
    firsts = groups.join(ids, "key").groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("first"))
    name, = unused(docs.columns, "row_key")
    rows = docs.withColumn(name, key)
    return (rows.join(firsts.select(F.col("first.key").alias(name)).hint("shuffle_hash"), name, "left_semi")
            .drop(name).dropDuplicates(["doc_id", "text"]))
