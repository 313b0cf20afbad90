"""Token-id files with Elias-Fano document boundaries.

A segment is one concatenated id array and two coded sequences: where each
document's ids start, and the document ids themselves.  Select queries on the
first return offsets; no table of 64-bit offsets exists.  Segments are the rows
of a Parquet table, written and committed by Spark under the shared folder, so
lost tasks leave nothing behind; ``export_segments`` gives the same bytes as
plain files, which ``Segment`` also reads from a memory map.

Texts are encoded where they are read; only ids move, to ranges of doc_id.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custlens.llm.common import documents, slices, stage
from custlens.llm.elias_fano import EliasFano, encode
from custlens.llm.tokens import encoder, forget, public_path, with_end

END_ID = 0
#: Ids of a segment, at most (a longer document has its own).
SEGMENT_IDS = 1 << 20
#: Bytes of documents' columns that a range of doc_ids holds, about.
RANGE_ROWS = 5000
#: Most ranges; also the most rows of the table of their totals.
MAX_RANGES = 20_000

_MAGIC = b"EFTOKEN1"
_HEAD = struct.Struct("<8sQQQq B7x")
SEGMENT_SCHEMA = "part int, place int, n_docs long, n_ids long, segment binary"


def write_segment(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a segment.  Documents come in ascending order, null ids first."""
    nulls = sum(d is None for d in doc_ids)
    own = np.array(doc_ids[nulls:], np.int64)
    least = int(own[0]) if len(own) else 0
    wide = len(ids) and int(ids.max()) >= 1 << 16
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = ids.astype("<u4" if wide else "<u2").tobytes()
    data += bytes(-len(data) % 8)
    return b"".join([_HEAD.pack(_MAGIC, len(doc_ids), len(ids), nulls, least, 4 if wide else 2),
                     data, encode(starts, len(ids) + 1),
                     encode((own - least).astype(np.uint64))])


class Segment:
    """A segment read in place from bytes or a memory map."""

    def __init__(self, buffer):
        magic, self.n_docs, self.n_ids, self.n_nulls, self._least, width = _HEAD.unpack_from(buffer)
        if magic != _MAGIC:
            raise ValueError("not a segment of token ids")
        self.ids = np.frombuffer(buffer, f"<u{width}", self.n_ids, _HEAD.size)
        at = _HEAD.size + -(-self.n_ids * width // 8) * 8
        self._starts = EliasFano(buffer, at)
        self._docs = EliasFano(buffer, self._starts.end)

    def starts(self, i: np.ndarray) -> np.ndarray:
        """Offsets of documents ``i`` by select; ``n_docs`` gives the end."""
        return self._starts.get(i).astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        a, b = self.starts(np.array([i, i + 1]))
        return self.ids[a:b]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_nulls + (
            self._docs.all().astype(np.int64) + self._least).tolist()

    def find(self, doc_id: int) -> int:
        """Place of the first document with this id, or -1."""
        if doc_id < self._least:
            return -1
        at = int(self._docs.index(np.array([doc_id - self._least], np.uint64))[0])
        return at + self.n_nulls if at >= 0 else -1


def _encode(batches: Iterator[pa.RecordBatch], path: str, end: int,
            bounds: list[int]) -> Iterator[pa.RecordBatch]:
    edge = np.array(bounds, np.int64)
    for part in slices(batches, max_bytes=4 << 20):
        ids, starts = with_end(*encoder(path).encode(part.column("text")), end)
        # Two bytes an id where all ids fit; the first byte tells.
        ids = ids.astype("<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4")
        doc = part.column("doc_id")
        # Null ids go to the first range and sort first in it.
        where = np.searchsorted(edge, pc.fill_null(doc, np.iinfo(np.int64).min).to_numpy(),
                                side="right")
        mark = bytes([ids.itemsize])
        packed = [mark + ids[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(where, pa.int32()), doc, pa.array(packed, pa.binary())],
            names=["part", "doc_id", "ids"])


def _segments(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, doc_id) to segments; holds one segment at a time."""
    forget()
    docs, held, total, part, place = [], [], 0, None, 0

    def flush():
        sizes = np.array([len(x) for x in held], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([place], pa.int32()),
             pa.array([len(docs)], pa.int64()), pa.array([total], pa.int64()),
             pa.array([write_segment(docs, sizes, np.concatenate(held))], pa.binary())],
            names=["part", "place", "n_docs", "n_ids", "segment"])

    for batch in batches:
        for p, d, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            ids = np.frombuffer(b[1:], "<u2" if b[0] == 2 else "<u4")
            if docs and (p != part or total + len(ids) > most):
                yield flush()
                place = place + 1 if p == part else 0
                docs, held, total = [], [], 0
            if p != part:
                part, place = p, 0
            docs.append(d)
            held.append(ids)
            total += len(ids)
    if docs:
        yield flush()


def write_files(docs: DataFrame, path: str | None = None, end: int = END_ID) -> str:
    """Write the segments of all documents, in ascending doc_id order over
    (part, place); return the table's folder under the shared one.

    A null text counts as empty and has ``end`` alone; rows that repeat a doc_id
    stand side by side, ordered by their ids' bytes; null doc_ids come first.
    """
    path = path or public_path("byte_bpe_50k.json")
    rows = documents(docs)
    n = rows.count()
    ranges = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    bounds = []
    if ranges > 1:
        bounds = rows.select(F.percentile_approx(
            "doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges).alias("q")).first()["q"] or []
    coded = rows.mapInArrow(lambda b: _encode(b, path, end, sorted(set(bounds))),
                            "part int, doc_id long, ids binary")
    placed = coded.repartition(ranges, "part").sortWithinPartitions("part", "doc_id", "ids")
    return stage(placed.mapInArrow(lambda b: _segments(b, SEGMENT_IDS), SEGMENT_SCHEMA), "tokens")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            seg = Segment(batch.column("segment")[i].as_buffer())
            starts = seg.starts(np.arange(seg.n_docs + 1))
            ids = seg.ids.astype("<u4")
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seg.doc_ids(), pa.int64()),
                 pa.array(starts[:-1] + batch.column("before")[i].as_py(), pa.int64()),
                 pa.array(np.diff(starts), pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the written files."""
    segments = spark.read.parquet(folder)
    # A row per range of doc_ids, at most MAX_RANGES, is summed in one task.
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.select("part", "place", F.coalesce(
        F.sum("n_ids").over(inside), F.lit(0)).alias("inner"))
    before = sizes.join(F.broadcast(totals), "part").select(
        "part", "place", (F.col("first") + F.col("inner")).alias("before"))
    rows = segments.select("part", "place", "segment").join(before, ["part", "place"])
    return rows.select("segment", "before").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def export_segments(spark: SparkSession, folder: str, target: str) -> None:
    """Copy the segments to plain files ``target``/part-place.bin, from the tasks;
    ``target`` must be a folder that all executors share."""
    def copy(rows):
        for r in rows:
            name = os.path.join(target, f"{r['part']:08d}-{r['place']:05d}.bin")
            with open(f"{name}.{os.getpid()}", "wb") as f:
                f.write(r["segment"])
            os.replace(f.name, name)
    os.makedirs(target, exist_ok=True)
    spark.read.parquet(folder).foreachPartition(copy)
