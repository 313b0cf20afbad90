"""Language-model scoring with Elias-Fano n-gram tries.

The model is an interpolated trigram model.  It is sharded by the middle word b of
each trigram (a, b, c): a shard has all successors of b, all contexts (a, b) and all
trigrams, so every count and total that it needs is its own.  A word so frequent that
its trigrams would swamp a shard is split by the word before it into classes, each
a context node of its own.  A split places work and changes no count: shards count
their pairs (b, c) of split words, these are added up over all classes, and each shard
gets the whole counts of the pairs that it holds; the word's total is its corpus count.

A shard's trie has four levels: words (by number), nodes (b, class), their successors c, their
contexts a and, under each context, the successors seen after it, written as places
within the node's successors (context-relative).  Every level is Elias-Fano coded, has
monotone pointers to its children, and 16-bit codes of smoothed probabilities or
back-off weights on a fixed logarithmic grid.  The levels stand in one memory map,
without a file, and are searched by successor queries.

Texts are read once; what moves are words' counts, packed slices of word numbers and
packed n-grams.  A document's score is summed from its shards' parts.
"""

from __future__ import annotations

import math
import mmap
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import (documents, hash_words, mix, pack, ranks, scratch_root, slices,
                                 stage, trim, unpack, word_arrays)
from custlens.llm.elias_fano import EliasFano, encode

#: Documents whose crc32(doc_id as text) has this remainder are held out of learning.
FOLDS, HELD_OUT = 5, 1
#: Strength, in counts, of the next shorter context's distribution.
STRENGTH_2, STRENGTH_3 = 5000.0, 10.0
#: Tokens of a shard, occurrences of a word's class, bytes of a slice of texts.
SHARD_TOKENS = 2_000_000
CLASS_TOKENS = 500_000
SLICE_BYTES = 12 << 20
#: Shards whose pairs of split words are added up in one group.
SHARDS_A_GROUP = 16
#: Tokens of a piece of a slice whose n-grams are sorted together.
PIECE_TOKENS = 1 << 21

#: Codes are steps of log10 probability below 0.
STEP = 1 / 4096

_U = np.uint64
END = _U(0x0E4D0E4D0E4D0E4D)
#: Number of the begin of a text; words of the corpus are numbered from 1 on.
BEGIN = _U(0)


def is_held_out(doc_id: int | None) -> bool:
    """A null id counts as an empty text (remainder 0): it is learned from."""
    text = b"" if doc_id is None else str(doc_id).encode()
    return zlib.crc32(text) % FOLDS == HELD_OUT


def to_code(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(p) / STEP), 0, 65535).astype(np.uint16)


def from_code(code: np.ndarray) -> np.ndarray:
    """log10 of the probability."""
    return code.astype(np.float64) * -STEP


# -- the trie -----------------------------------------------------------------

def build_trie(words: np.ndarray, unigram: np.ndarray, node: np.ndarray, c: np.ndarray,
               a: np.ndarray, mu2: float = STRENGTH_2, mu3: float = STRENGTH_3,
               whole: tuple[np.ndarray, ...] | None = None) -> bytes:
    """Bytes of a shard's trie from its training trigrams.

    ``words``: sorted numbers; ``unigram``: their probabilities.  Of each trigram
    occurrence: ``node``, its context node's key, and places of ``c`` and ``a`` in words.
    ``whole``: of each pair of a split word's node, the node's key, the place of c, the
    pair's count in all classes, and the word's total.
    """
    n_words = max(1, len(words))
    node_w, c_w, count_w, total_w = whole or [np.zeros(0, np.int64)] * 4
    n = len(node)
    keys, node = ranks(np.concatenate([node, node_w]))
    node, node_w = node[:n], node[n:]
    total = np.bincount(node, minlength=len(keys)).astype(np.float64)
    total[node_w] = total_w

    seen = count_w > 0
    pair, of_pair = ranks(np.concatenate([node * n_words + c, node_w[seen] * n_words + c_w[seen]]))
    of_pair, of_whole = of_pair[:n], of_pair[n:]
    count2 = np.bincount(of_pair, minlength=len(pair))
    count2[of_whole] = count_w[seen]
    first2 = np.searchsorted(pair, np.arange(len(keys) + 1) * n_words)
    p2 = (count2 + mu2 * unigram[pair % n_words]) / (total[pair // n_words] + mu2)

    context, of_context = ranks(node * n_words + a)
    total3 = np.bincount(of_context, minlength=len(context)).astype(np.float64)

    # A trigram's last word is its place among the successors of the node.
    width = int(np.diff(first2).max()) if len(keys) else 1
    place = of_pair - first2[node]
    triple, of_triple = ranks(of_context * width + place)
    count3 = np.bincount(of_triple, minlength=len(triple))
    at = np.empty(len(triple), np.int64)
    at[of_triple] = np.arange(len(of_triple))
    p3 = (count3 + mu3 * p2[of_pair[at]]) / (total3[of_context[at]] + mu3)
    first3 = np.searchsorted(triple, np.arange(len(context) + 1) * width)

    head = np.array([len(words), len(keys), len(pair), len(context), len(triple), width], "<u8").tobytes()
    parts = [encode(x) for x in (words, keys, pair, first2, context, first3, triple)]
    codes = [to_code(x).tobytes() for x in (
        p2, mu2 / (total + mu2), p3, mu3 / (total3 + mu3))]
    return b"".join([head, *parts, *(x + bytes(-len(x) % 8) for x in codes)])


class Trie:
    """A shard's trie, read in place."""

    def __init__(self, buffer):
        head = np.frombuffer(buffer, "<u8", 6).astype(np.int64).tolist()
        self.n_words, n_keys, n_pairs, n_contexts, n_triples, self.width = head
        at = 48
        levels = []
        for _ in range(7):
            levels.append(EliasFano(buffer, at))
            at = levels[-1].end
        (self.words, self.nodes, self.pairs, self.first_pair, self.contexts, self.first_triple,
         self.triples) = levels
        codes = []
        for n in (n_pairs, n_keys, n_triples, n_contexts):
            codes.append(np.frombuffer(buffer, "<u2", n, at))
            at += -(-n * 2 // 8) * 8
        self.p2, self.back2, self.p3, self.back3 = codes

    def log10(self, node: np.ndarray, c: np.ndarray, a: np.ndarray, log1: np.ndarray) -> np.ndarray:
        """log10 probability of word ``c`` after (a, node); words as places in the words
        level, -1 for words that it lacks; ``log1``: log10 of c's own probability."""
        k = self.nodes.index(node.astype(np.uint64))
        c, a = c.astype(np.int64), a.astype(np.int64)
        base = np.maximum(k, 0) * max(1, self.n_words)

        def child(level, word):
            got = level.index((base + np.maximum(word, 0)).astype(np.uint64))
            return np.where((k >= 0) & (word >= 0), got, -1)

        pair, context = child(self.pairs, c), child(self.contexts, a)
        out = log1.copy()
        known = k >= 0
        out[known] += from_code(self.back2[k[known]])
        seen = pair >= 0
        out[seen] = from_code(self.p2[pair[seen]])
        follow = context >= 0
        # Search the context's successors by place within the node's.
        both = np.flatnonzero(follow & seen)
        place = pair[both] - self.first_pair.get(k[both]).astype(np.int64)
        triple = self.triples.index((context[both] * self.width + place).astype(np.uint64))
        out[follow] += from_code(self.back3[context[follow]])
        hit = triple >= 0
        out[both[hit]] = from_code(self.p3[triple[hit]])
        return out


# -- slices of texts ----------------------------------------------------------

_SLICE = "slice long, docs binary, words binary, codes binary"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices as numbers of distinct words; the end of a text is a word of its own."""
    base, serial = TaskContext.get().partitionId() << 32, 0
    for part in slices(batches, max_bytes=SLICE_BYTES):
        words, code, off = word_arrays(part.column("text"), lower=True)
        words = np.concatenate([hash_words(words), [END]])
        n = len(off) - 1
        starts = off + np.arange(n + 1)
        full = np.full(len(code) + n, len(words) - 1, np.int64)
        body = np.ones(len(full), bool)
        body[starts[1:] - 1] = False
        full[body] = code
        # Words in order of their hashes.
        order = np.argsort(words)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids = part.column("doc_id").to_pylist()
        out = pa.BufferOutputStream()
        table = pa.record_batch([pa.array(ids, pa.int64()), pa.array(np.diff(starts)),
                                 pa.array([is_held_out(i) for i in ids])], names=["doc_id", "n", "held"])
        with pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_batch(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([base + serial], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary()),
             pa.array([pack(np.diff(words[order], prepend=_U(0)))], pa.binary()),
             pa.array([pack(rank[full])], pa.binary())],
            names=["slice", "docs", "words", "codes"])
        serial += 1


def _docs(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(blob).read_all().to_pandas(integer_object_nulls=True)


def _words(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def _cuts(words: np.ndarray, shards: int) -> np.ndarray:
    """Where sorted words fall into shards, by ranges of the hash."""
    return np.searchsorted(((words >> _U(32)) * _U(shards)) >> _U(32), np.arange(shards + 1))


# -- round 1: counts of words --------------------------------------------------

_ASK = "shard int, slice long, words binary, counts binary"
_TOLD = "shard int, slice long, counts binary, numbers binary, distinct long, total long"


def _ask(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            docs, words = _docs(batch.column("docs")[i].as_py()), _words(batch.column("words")[i].as_py())
            codes = unpack(batch.column("codes")[i].as_py(), np.int64)
            learned = np.repeat(~docs["held"].to_numpy(bool), docs["n"])
            count = np.bincount(codes[learned], minlength=len(words))
            cut = _cuts(words, shards)
            rows = [(s, batch.column("slice")[i].as_py(),
                     pack(np.diff(words[cut[s]:cut[s + 1]], prepend=_U(0))), pack(count[cut[s]:cut[s + 1]]))
                    for s in np.flatnonzero(np.diff(cut)).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                    pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                names=["shard", "slice", "words", "counts"])


def _tell(rows: pd.DataFrame, shards: int) -> pd.DataFrame:
    """For each slice of a shard, the corpus counts of its words and their numbers: from
    1 on, by rank within the shard, interleaved over shards."""
    words = [_words(w) for w in rows["words"]]
    every, place = ranks(np.concatenate(words))
    total = np.bincount(place, np.concatenate([unpack(c, np.float64) for c in rows["counts"]]),
                        len(every)).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])
    out = [pack(total[place[b - len(w):b]]) for w, b in zip(words, ends, strict=True)]
    number = 1 + np.arange(len(every)) * shards + int(rows["shard"].iloc[0])
    numbers = [pack(np.diff(number[place[b - len(w):b]], prepend=0)) for w, b in zip(words, ends, strict=True)]
    first = np.arange(len(rows)) == 0
    return pd.DataFrame({"shard": rows["shard"], "slice": rows["slice"], "counts": out, "numbers": numbers,
                         "distinct": np.where(first, (total > 0).sum(), 0),
                         "total": np.where(first, total.sum(), 0)})


# -- round 2: n-grams ----------------------------------------------------------

_GRAMS = "shard int, slice long, words binary, counts binary, a binary, b binary, c binary, docs binary, done binary"


def _classes(count_b: np.ndarray) -> np.ndarray:
    return (count_b // CLASS_TOKENS + 1).astype(np.uint64)


def _node(word_b: np.ndarray, classes: np.ndarray, word_a: np.ndarray) -> np.ndarray:
    """Class of each context's middle word by the word before it."""
    return (mix(word_a ^ _U(0xA5A5A5A5A5A5A5A5)) % classes).astype(np.int64)


def _grams(state: pd.DataFrame, told: pd.DataFrame, shards: int, total: int, distinct: int) -> pd.DataFrame:
    """A slice's trigrams for each shard, and its documents' base scores."""
    if not len(state):
        return pd.DataFrame({f.split()[0]: [] for f in _GRAMS.split(", ")})
    one = state.iloc[0]
    docs, codes = _docs(one["docs"]), unpack(one["codes"], np.int32)
    end = np.searchsorted(_words(one["words"]), END)
    # Shards are ranges of the hash: in their order, the slice's words are in theirs.
    told = told.sort_values("shard")
    count = np.concatenate([unpack(c, np.int64) for c in told["counts"]])
    words = np.concatenate([_words(c) for c in told["numbers"]])
    n_docs, size = len(docs), docs["n"].to_numpy()
    owner = np.repeat(np.arange(n_docs, dtype=np.int32), size)
    log_base = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
    trim()
    docs["base"] = np.bincount(owner, log_base[codes], n_docs)
    docs["known"] = np.bincount(owner, count[codes] > 0, n_docs).astype(np.int64)
    blob = pa.BufferOutputStream()
    table = pa.record_batch([pa.array(docs["doc_id"].astype("Int64")), pa.array(docs["held"].astype(bool)),
                             pa.array(size), pa.array(docs["known"]), pa.array(docs["base"])],
                            names=["doc_id", "held", "n", "known", "base"])
    with pa.ipc.new_stream(blob, table.schema) as writer:
        writer.write_batch(table)
    number = int(one["slice"])
    rows = [(-1 - number % shards, number, *[None] * 6, blob.getvalue().to_pybytes())]

    # The begin of a text stands before its first word; it is as frequent as the end.
    words = np.concatenate([words, [BEGIN]])
    count = np.concatenate([count, [count[end]]])
    begin, starts = len(words) - 1, np.cumsum(size) - size
    b = np.roll(codes, 1)
    b[starts] = begin
    a = np.roll(b, 1)
    a[starts] = begin
    mark = owner * 2 + np.repeat(docs["held"].to_numpy(bool), size)
    del owner
    classes = _classes(count)
    for at in range(0, len(codes), PIECE_TOKENS):
        pa_, pb, pc_, pm = (x[at:at + PIECE_TOKENS] for x in (a, b, codes, mark))
        kind = _node(words[pb], classes[pb], words[pa_])
        shard = (mix(words[pb] + kind.astype(np.uint64)) % _U(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
        order = np.argsort(pb.astype(np.int64) * len(words) + pc_)
        order = order[np.argsort(shard[order], kind="stable")]
        pa_, pb, pc_, pm = pa_[order], pb[order], pc_[order], pm[order]
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cut)).tolist():
            x = slice(cut[s], cut[s + 1])
            used, place = ranks(np.concatenate([pa_[x], pb[x], pc_[x]]))
            value = words[used]
            rank = np.argsort(value)
            back = np.empty(len(rank), np.int64)
            back[rank] = np.arange(len(rank))
            ia, ib, ic = np.split(back[place], 3)
            rows.append((s, number, pack(np.diff(value[rank], prepend=_U(0))), pack(count[used][rank]),
                         pack(ia), pack(ib), pack(ic), pack(pm[x]), None))
    del a, b, codes, mark
    trim()
    return pd.DataFrame(rows, columns=[f.split()[0] for f in _GRAMS.split(", ")])


_PAIRS = "grp int, shard int, b binary, c binary, counts binary"


def _pair_keys(b: np.ndarray, c: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs of numbers in order, the sums of their counts, and the place of each."""
    if not len(b):
        return b, c, counts, np.zeros(0, np.int64)
    wide = int(c.max()) + 1
    if int(b.max()) < (1 << 63) // wide:
        keys, back = ranks(b * wide + c)
        pairs = keys // wide, keys % wide
    else:
        back = _distinct_rows(c, b)
        pairs = np.empty(int(back.max()) + 1, np.int64), np.empty(int(back.max()) + 1, np.int64)
        pairs[0][back], pairs[1][back] = b, c
    return *pairs, np.bincount(back, counts, len(pairs[0])).astype(np.int64), back


def _split_pairs(rows: pd.DataFrame, groups: int) -> pd.DataFrame:
    """A shard's pairs (b, c) whose b is split, with their learned counts here (0: only
    held-out texts have it), dealt to groups by the pair."""
    found = [(np.zeros(0, np.int64),) * 3]
    for words, counts, b, c, marks in zip(*(rows[x] for x in ("words", "counts", "b", "c", "docs")), strict=True):
        if words is None or not (split := unpack(counts, np.int64) >= CLASS_TOKENS).any():
            continue
        words, b, c = _words(words).astype(np.int64), unpack(b), unpack(c)
        at = np.flatnonzero(split[b])
        pair, back = ranks(b[at].astype(np.int64) * len(words) + c[at])
        learned = np.bincount(back, unpack(marks)[at] % 2 == 0, len(pair)).astype(np.int64)
        found.append((words[pair // len(words)], words[pair % len(words)], learned))
    b, c, n, _ = _pair_keys(*(np.concatenate(x) for x in zip(*found, strict=True)))
    group = mix(mix(b.astype(np.uint64)) ^ c.astype(np.uint64)) % _U(groups)
    out = []
    for g in np.unique(group).tolist():
        x = group == g
        out.append((g, int(rows["shard"].iloc[0]), pack(b[x]), pack(c[x]), pack(n[x])))
    trim()
    return pd.DataFrame(out, columns=[f.split()[0] for f in _PAIRS.split(", ")])


def _add_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Each shard's pairs of a group with their counts over all shards."""
    sizes = np.cumsum([0, *(len(unpack(x)) for x in rows["counts"])])
    *_, total, back = _pair_keys(*(np.concatenate([unpack(x, np.int64) for x in rows[k]]) for k in ("b", "c", "counts")))
    rows["counts"] = [pack(total[back[i:j]]) for i, j in zip(sizes[:-1], sizes[1:], strict=True)]
    return rows


_PARTS = "slice long, docs binary, scores binary, done binary"


def _whole(told: pd.DataFrame, words: np.ndarray, count: np.ndarray, node: np.ndarray, c: np.ndarray,
           most: int) -> tuple[np.ndarray, ...] | None:
    """The pairs of split words' nodes with their counts and totals in the whole corpus."""
    split = np.flatnonzero(count[node // most] >= CLASS_TOKENS)
    if not len(split):
        return None
    pair = ranks(node[split] * len(words) + c[split])[0]
    node, c = pair // len(words), pair % len(words)
    b_t, c_t, n_t = (np.concatenate([unpack(x, np.int64) for x in told[k]]) for k in ("b", "c", "counts"))
    b_t, c_t = (np.searchsorted(words, x.astype(np.uint64)) for x in (b_t, c_t))
    known = b_t * len(words) + c_t
    order = np.argsort(known)
    at = order[np.searchsorted(known[order], node // most * len(words) + c)]
    return node, c, n_t[at], count[node // most]


def _score(rows: pd.DataFrame, told: pd.DataFrame, total: int, distinct: int) -> pd.DataFrame:
    """Learn a shard's trie from its learned trigrams, and the whole counts of its split
    words' pairs, and score all of them."""
    if rows["shard"].iloc[0] < 0:
        return pd.DataFrame({"slice": rows["slice"], "docs": None, "scores": None, "done": rows["done"]})
    own = [_words(w) for w in rows["words"]]
    words, place = ranks(np.concatenate(own))
    count = np.zeros(len(words), np.int64)
    count[place] = np.concatenate([unpack(c, np.int64) for c in rows["counts"]])
    shift = np.cumsum([len(w) for w in own]) - [len(w) for w in own]

    place = place.astype(np.int32)

    def gather(column):
        # Four bytes a place; they are widened where they are multiplied.
        return np.concatenate([place[s:][unpack(x)] for x, s in zip(rows[column], shift, strict=True)])

    a, b, c = gather("a"), gather("b"), gather("c")
    marks = [unpack(m) for m in rows["docs"]]
    learned = np.concatenate([m % 2 == 0 for m in marks])
    unigram = (count + 0.5) / (total + 0.5 * (distinct + 1))
    most = int(_classes(count).max())
    node = b.astype(np.int64) * most + _node(words[b], _classes(count)[b], words[a])
    del b, place, own
    whole = _whole(told, words, count, node, c, most)
    data = build_trie(words, unigram, node[learned], c[learned], a[learned], whole=whole)
    del whole
    trim()

    # Each distinct trigram is searched once.
    nodes, at = ranks(node)
    pairs, at = ranks(at * len(words) + c)
    if len(pairs) * len(words) < 1 << 62:
        _, back = ranks(at * len(words) + a)
    else:
        back = _distinct_rows(at, a)
    first = np.empty(int(back.max()) + 1, np.int64)
    first[back] = np.arange(len(back))
    del nodes, pairs, at, learned
    with mmap.mmap(-1, len(data)) as view:
        view.write(data)
        del data
        trie = Trie(view)
        log1 = from_code(to_code(unigram))
        score = trie.log10(node[first], c[first], a[first], log1[c[first]])[back]
        del trie
    out, start = [], 0
    for m in marks:
        doc, where = np.unique(m >> 1, return_inverse=True)
        out.append((pack(doc), pack(np.bincount(where, score[start:start + len(m)]))))
        start += len(m)
    del node, a, c, back, score
    trim()
    return pd.DataFrame({"slice": rows["slice"], "docs": [d for d, _ in out],
                         "scores": [s for _, s in out], "done": None})


def _distinct_rows(*columns: np.ndarray) -> np.ndarray:
    """The place of each row among the distinct ones."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in columns], axis=0)
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    return back


def _sum(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of a slice with the sum of their shards' parts."""
    docs = _docs(rows["done"].dropna().iloc[0])
    score = np.zeros(len(docs))
    parts = rows[rows["docs"].notna()].sort_values("scores")
    for d, s in zip(parts["docs"], parts["scores"], strict=True):
        score[unpack(d, np.int64)] += unpack(s)
    return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "held_out": docs["held"].astype(bool),
                         "n_tokens": docs["n"], "n_known": docs["known"], "base_score": docs["base"],
                         "score": score})


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    A null text counts as empty: one token, its end.  A null doc_id is learned from.
    Repeated rows count, and are scored, each.  With nothing to learn from, all
    probabilities are that of an unknown word.  No rows give no rows.
    """
    spark = docs.sparkSession
    # Bucketed by slice, so that the slices stay where they are when their words' counts come.
    name = f"custlens_slices_{uuid.uuid4().hex}"
    (documents(docs).mapInArrow(_read, _SLICE).write.format("parquet")
     .option("path", f"{scratch_root(spark)}/{name}")
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "slice").saveAsTable(name))
    state = spark.table(name)
    # The plan knows the files and their buckets; the catalog keeps no entry.
    spark.sql(f"DROP TABLE {name}")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("b")).first()["b"] or 0
    # Words and gaps of six bytes, about; only the number of shards depends on it.
    shards = max(1, math.ceil(size / 6 / SHARD_TOKENS))
    told = spark.read.parquet(stage(
        state.mapInArrow(lambda b: _ask(b, shards), _ASK)
        .groupBy("shard").applyInPandas(lambda r: _tell(r, shards), _TOLD), "counts"))
    sums = told.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"] or 0)
    grams = state.groupBy("slice").cogroup(told.select("shard", "slice", "counts", "numbers").groupBy("slice")).applyInPandas(
        lambda s, t: _grams(s, t, shards, total, distinct), _GRAMS)
    # Both uses of the n-grams deal them by shard, so Spark moves them once.
    groups = math.ceil(shards / SHARDS_A_GROUP)
    pairs = (grams.groupBy("shard").applyInPandas(lambda r: _split_pairs(r, groups), _PAIRS)
             .groupBy("grp").applyInPandas(_add_pairs, _PAIRS))
    parts = grams.groupBy("shard").cogroup(pairs.groupBy("shard")).applyInPandas(
        lambda r, t: _score(r, t, total, distinct), _PARTS)
    out = parts.groupBy("slice").applyInPandas(
        _sum, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                      "base_score", "score")
