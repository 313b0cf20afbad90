"""Sum-of-squares online packing into fixed windows.

A level array counts the partially filled windows of every fill level.  Each
document (its rest, after whole windows are cut off) goes to the level that
leaves the sum of squared counts smallest, as it arrives.  Every input
partition packs its own rows, so nothing is shuffled and no hot source matters;
at a partition's end the fullest open windows keep what the rule gave them and their
gaps are filled exactly with documents of the emptiest ones; the last tokens form
sequences of powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from custlens.llm.common import documents, slices
from custlens.llm.tokens import encoder, public_path, with_end

WINDOW = 4096
END_ID = 2
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])

#: Sequence ids are the partition's number, shifted, plus the place within it.
PARTITION_SHIFT = 40


class LevelPacker:
    """Windows of one stream.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def level_for(self, size: int) -> int:
        """Fill level (0: a new window) that minimises the squared counts after
        the placement; the fullest among equals."""
        room = self.window - size
        here = self.count[:room + 1]
        there = self.count[size:].copy()
        # One window leaves level h (unless new) and enters h + size (unless full).
        change = 2 * there + 1
        change[room] = 0
        change[1:] -= 2 * here[1:] - 1
        change[1:][here[1:] == 0] = np.iinfo(np.int64).max
        return room - int(np.argmin(change[::-1]))

    def place(self, piece: tuple) -> list | None:
        """Add a piece smaller than a window; the window's pieces once it is full."""
        size = len(piece[2])
        level = self.level_for(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.open[level + size].append(pieces)
        self.count[level + size] += 1
        return None

    def rest(self) -> Iterator[list]:
        """The open windows' pieces: as many of the fullest windows as all their ids fill
        stay whole, and only their gaps are filled from the emptiest ones, whose documents
        are cut; the last ids go into powers of two."""
        kept = [(level, w) for level in range(self.window, 0, -1) for w in self.open[level]]
        todo = sum(level for level, _ in kept)
        whole = todo // self.window
        # The last is taken from first: the emptiest window's latest piece.
        left = [p for _, w in kept[whole:] for p in w]

        def take(room: int, pieces: list) -> list:
            while room:
                doc, start, ids, n = left.pop()
                if len(ids) > room:
                    left.append((doc, start + room, ids[room:], n))
                    ids = ids[:room]
                pieces.append((doc, start, ids, n))
                room -= len(ids)
            return pieces

        for level, pieces in kept[:whole]:
            yield take(self.window - level, pieces)
        todo -= whole * self.window
        while todo:
            size = 1 << (todo.bit_length() - 1)
            todo -= size
            yield take(size, [])


def _rows(sequence: int, pieces: list) -> Iterator[tuple]:
    offset = 0
    for doc, start, ids, n in pieces:
        yield doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, sequence, offset
        offset += len(ids)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_ARROW)


def _pack(batches: Iterator[pa.RecordBatch], path: str, end: int,
          window: int) -> Iterator[pa.RecordBatch]:
    packer, rows = LevelPacker(window), []
    sequence = TaskContext.get().partitionId() << PARTITION_SHIFT

    def close(pieces):
        nonlocal sequence
        rows.extend(_rows(sequence, pieces))
        sequence += 1

    for part in slices(batches):
        ids, starts = with_end(*encoder(path).encode(part.column("text")), end)
        for i, doc in enumerate(part.column("doc_id").to_pylist()):
            own = ids[starts[i]:starts[i + 1]]
            whole = len(own) // window * window
            for at in range(0, whole, window):
                close([(doc, at, own[at:at + window], len(own))])
            if whole < len(own):
                # A copy, so that an open window doesn't hold the whole slice.
                full = packer.place((doc, whole, own[whole:].copy(), len(own)))
                if full:
                    close(full)
        if rows:
            yield _batch(rows)
            rows = []
    for pieces in packer.rest():
        close(pieces)
    if rows:
        yield _batch(rows)


def pack_documents(docs: DataFrame, path: str | None = None, end: int = END_ID,
                   window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its text's ids and ``end``; a null or empty text is ``end`` alone.
    Longer ones are cut into whole windows and a rest.  Rows that repeat a doc_id
    are packed each on its own; a null doc_id stays null; no rows give no rows.
    ``window`` is a power of two.
    """
    path = path or public_path("word_bpe_49k.json")
    return documents(docs).mapInArrow(lambda b: _pack(b, path, end, window), SCHEMA)
