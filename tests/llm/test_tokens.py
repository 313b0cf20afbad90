"""Packing and token files against encoding every text on its own."""
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from custlens.llm import packing, token_files
from custlens.llm.tokens import ChunkEncoder, public_path
from tests.llm.cases import hard_docs, hard_rows, no_docs, same_rows


def ids_of(name, text, end):
    t = Tokenizer.from_file(public_path(name))
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunk_encoder_gives_the_tokenizers_own_ids(name):
    texts = [r[1] for r in hard_rows()] + ["a  b \n\n c", "don't I'LL  's", "é ́x", " x", "x ", "\x1f\x1f a",
                                           "a　\n b", "'s's 12345 ##%% a.b", "​ ᠎"]
    ids, starts = ChunkEncoder(public_path(name)).encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[starts[i]:starts[i + 1]].tolist() == ids_of(name, t, 0)[:-1].tolist(), t


def check_pieces(rows, docs, window=4096):
    want = defaultdict(list)
    for r in docs:
        want[r[0]].append(ids_of("word_bpe_49k.json", r[1], 2))
    got, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, texts in want.items():
        for ids in {t.tobytes() for t in texts}:
            ids = np.frombuffer(ids, "<u4")
            own = [r for r in got[doc] if r["doc_tokens"] == len(ids)]
            for r in own:
                assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        assert sum(r["length"] for r in got[doc]) == sum(map(len, texts))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or at & (at - 1) == 0 and at < window


def test_packing_covers_every_id_once(spark):
    rows = packing.pack_documents(hard_docs(spark)).collect()
    check_pieces(rows, hard_rows())
    assert packing.pack_documents(no_docs(spark)).collect() == []


def test_level_packer_minimises_the_squared_counts():
    rng = np.random.default_rng(0)
    p = packing.LevelPacker(16)
    for _ in range(300):
        size = int(rng.integers(1, 16))
        best = {}
        for h in [0, *[h for h in range(1, 17 - size) if p.count[h]]]:
            n = p.count.copy()
            if h:
                n[h] -= 1
            if h + size < 16:
                n[h + size] += 1
            best[h] = int((n[1:16] ** 2).sum())
        level = p.level_for(size)
        assert best[level] == min(best.values()) and level == max(h for h in best if best[h] == best[level])
        p.place((0, 0, np.zeros(size, np.uint32), size))
        assert all(len(p.open[h]) == p.count[h] for h in range(1, 16))


def test_the_level_rule_places_nearly_all_ids():
    rng = np.random.default_rng(3)
    sizes = np.clip(rng.lognormal(6, 1, 1000).astype(int), 1, 4095)
    ids = [np.full(n, i, np.uint32) for i, n in enumerate(sizes)]
    p = packing.LevelPacker()
    closed = [w for i, x in enumerate(ids) for w in [p.place((i, 0, x, len(x)))] if w]
    placed = {id(x[2]): len(x[2]) for level in p.open for w in level for x in w}
    rest = list(p.rest())
    kept = sum(placed.get(id(x[2]), 0) for w in rest if sum(len(y[2]) for y in w) == 4096 for x in w)
    kept += sum(len(x[2]) for w in closed for x in w)
    assert kept >= 0.95 * sizes.sum()
    # Every id once, in full windows and powers of two.
    got = defaultdict(list)
    for w in closed + rest:
        size = sum(len(x[2]) for x in w)
        assert size == 4096 or size & (size - 1) == 0
        for doc, start, x, n in w:
            assert (x == doc).all() and n == sizes[doc]
            got[doc].append((start, len(x)))
    for doc, n in enumerate(sizes):
        at = 0
        for start, length in sorted(got[doc]):
            assert start == at and length > 0
            at += length
        assert at == n
    assert list(packing.LevelPacker().rest()) == []


def test_token_files_read_back(spark):
    folder = token_files.write_files(hard_docs(spark))
    got = token_files.read_files(spark, folder).collect()
    order = sorted(hard_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = {}, 0
    got = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    size = defaultdict(list)
    for r in hard_rows():
        ids = ids_of("byte_bpe_50k.json", r[1], 0)
        size[r[0]].append((len(ids), zlib.crc32(ids.tobytes())))
    for doc, want in size.items():
        assert sorted((r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] == doc) == sorted(want)
    same_rows(token_files.read_files(spark, token_files.write_files(no_docs(spark))).collect(), [])


def test_exported_segment_is_read_from_a_memory_map(spark, tmp_path):
    import mmap
    folder = token_files.write_files(hard_docs(spark))
    token_files.export_segments(spark, folder, str(tmp_path))
    (path,) = tmp_path.glob("*.bin")
    with open(path, "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as m:
        seg = token_files.Segment(m)
        assert seg.n_docs == len(hard_rows()) and seg.n_nulls == 2
        assert seg.document(seg.find(8)).tolist() == ids_of("byte_bpe_50k.json", "ONE Two three", 0).tolist()
        assert seg.find(12345) == -1 and seg.find(-6) == -1
        del seg
