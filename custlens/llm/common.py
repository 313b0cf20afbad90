"""Helpers shared by the operators of this subpackage.

Inside tasks, texts are handled as Arrow string arrays in slices of bounded
bytes, so the memory of a Python worker does not depend on how many rows a
partition has; only a single text is ever held whole.
"""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.session import ensure_checkpoint_dir
from custlens.sources.materialize import stage
from custlens.sources.tables import read_table

__all__ = ["DOC_COLUMNS", "SPACE", "WORD_GAP", "documents", "drop_staged", "hash_words",
           "importable",            "mix", "pack", "no_text", "read_table", "scratch_root", "slices", "stage", "strings", "unpack",
           "unused", "word_arrays"]

#: White space of the contracts: blank and the controls 0x09 to 0x0D.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD_GAP = r"[\x20\x09-\x0D]+"
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, for
    sessions whose PYTHONPATH lacks it."""
    env = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (and ``more``) only, so that further columns,
    whatever their names, cannot clash with an operator's own."""
    importable(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"),
                       *[F.col(c) for c in more])


def no_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def scratch_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/")


def drop_staged(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables of this run that no later plan reads."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each lengthened until no column has it in any case of letters."""
    taken = {c.lower() for c in columns}
    return [name + "_" * next(k for k in range(len(taken) + 1) if name + "_" * k not in taken) for name in names]


def strings(column: pa.Array) -> pa.Array:
    """A plain string array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a slice hold at most
    ``max_bytes`` (a longer single text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to
            trim()


def word_arrays(text: pa.Array, lower: bool = False,
                gap: str = WORD_GAP) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words (what stands between ``gap``, by default ``[^\\x20\\x09-\\x0D]+``) of
    every text: the distinct words, the words of all texts as positions in them, and
    where each text starts."""
    text = strings(text)
    if lower:
        text = pc.ascii_lower(text)
    parts = pc.split_pattern_regex(text, gap)
    flat, off = parts.flatten(), np.asarray(parts.offsets)
    keep = np.asarray(pc.not_equal(flat, ""))
    off = np.concatenate([[0], np.cumsum(keep)])[off - off[0]]
    coded = flat.filter(pa.array(keep)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), off


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words, the same in every process."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object),
                              categorize=False).astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


@functools.cache
def _malloc_trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def trim() -> None:
    """Hand freed memory back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    _malloc_trim()(0)


def ranks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and the place of each element among them."""
    order = np.argsort(x)
    s = x[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return s[new], back


def pack(a: np.ndarray) -> bytes:
    """An integer array in the narrowest unsigned type that holds it, or any
    other array as it is, compressed."""
    if a.dtype.kind in "iu":
        top = int(a.max()) if a.size else 0
        if not a.size or int(a.min()) >= 0:
            a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16
                         else np.uint32 if top < 1 << 32 else np.uint64)
    return a.dtype.char.encode() + _zstd()[0].compress(np.ascontiguousarray(a).tobytes())


def unpack(b: bytes, dtype=None) -> np.ndarray:
    a = np.frombuffer(_zstd()[1].decompress(b[1:]), np.dtype(chr(b[0])))
    return a if dtype is None else a.astype(dtype)
