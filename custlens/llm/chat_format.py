"""Chat formatting by token-level assembly.

Texts are encoded on their own and reserved ids are spliced around them, so no
text can ever produce a reserved id.  Control strings that occur in a text are
escaped (one more backslash after their first character), which is reversible.
The loss mask is the prefix sum of +1 where an assistant's text begins and -1
where it ends.  Turns are formatted where they are read; conversations are only
put together by a sort, and digests are updated turn by turn, so a conversation of
any length needs the memory of one batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import importable, pack, slices, strings, unpack
from custlens.llm.tokens import encoder, public_path

#: Reserved ids follow the tokenizer's own 50,257, in this order.
CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>",
            "<|role|>", "<|text|>", "<|end|>")
FIRST_RESERVED = 50257
RESERVED = {c: FIRST_RESERVED + i for i, c in enumerate(CONTROLS)}
#: Opening and closing control of the known roles; others are written out.
ROLES = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"),
         "assistant": ("<s>", "</s>")}
LEARNED = "assistant"
#: Strings that other templates use are escaped as well.
FOREIGN = ("<|endoftext|>", "<|im_start|>", "<|im_end|>")

_ALL = CONTROLS + FOREIGN
_ESCAPE = re.compile("|".join(f"({re.escape(a)})(\\\\*)({'|'.join(re.escape(c[1:]) for c in _ALL if c[0] == a)})"
                              for a in "<["))
_UNESCAPE = re.compile("|".join(f"({re.escape(a)})\\\\(\\\\*)({'|'.join(re.escape(c[1:]) for c in _ALL if c[0] == a)})"
                                for a in "<["))

FORMAT_SCHEMA = "conv_id long, turn long, ids binary, mask binary, n_ids long"
DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                 "loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: (m[1] or m[4]) + (m[2] or m[5] or "") + "\\" + (m[3] or m[6]), text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: (m[1] or m[4]) + (m[2] or m[5] or "") + (m[3] or m[6]), text)


def assemble(path: str, roles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all turns in a row, their loss mask, and where each turn starts."""
    segments, plan = [], []
    for role, text in zip(roles, texts, strict=True):
        # Reserved ids are given as negative numbers, segments as places in the list.
        segments.append(escape(text))
        place = len(segments) - 1
        if role in ROLES:
            open_, close = ROLES[role]
            plan.append([-RESERVED[open_], place, -RESERVED[close]])
        else:
            segments.append(escape(role))
            plan.append([-RESERVED["<|role|>"], place + 1, -RESERVED["<|text|>"], place,
                         -RESERVED["<|end|>"]])
    ids, starts = encoder(path, literal=True).encode(pa.array(segments, pa.string()))
    out, at, turns, step = [], 0, [0], []
    for role, parts in zip(roles, plan, strict=True):
        for p in parts:
            some = np.array([-p], np.uint32) if p < 0 else ids[starts[p]:starts[p + 1]]
            if p >= 0 and role == LEARNED:
                step += [(at, 1), (at + len(some), -1)]
            out.append(some)
            at += len(some)
        turns.append(at)
    delta = np.zeros(at + 1, np.int8)
    for where, by in step:
        delta[where] += by
    mask = np.cumsum(delta[:-1], dtype=np.int8).astype(np.uint8)
    return np.concatenate(out) if out else np.zeros(0, np.uint32), mask, np.array(turns)


def _format(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        roles = strings(part.column("role")).to_pylist()
        ids, mask, at = assemble(path, roles, strings(part.column("text")).to_pylist())
        cut = list(zip(at[:-1], at[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [part.column("conv_id"), part.column("turn"),
             pa.array([pack(ids[a:b]) for a, b in cut], pa.binary()),
             pa.array([pack(mask[a:b]) for a, b in cut], pa.binary()),
             pa.array([b - a for a, b in cut], pa.int64())],
            names=["conv_id", "turn", "ids", "mask", "n_ids"])


def format_turns(turns: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, turn, ids, mask, n_ids of every turn (arrays as packed bytes).

    A null text or role is empty; a role beyond the three known ones is kept
    as text of its own.  Null ids and turns stay; repeated rows are turns each.
    """
    importable(turns.sparkSession)
    path = path or public_path("byte_bpe_50k.json")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                        F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _format(b, path), FORMAT_SCHEMA)


def read_turn(path: str, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, str]:
    """Role, text, learned text and formatted text of one turn, from its ids."""
    names = {i: c for c, i in RESERVED.items()}
    edges = np.flatnonzero(ids >= FIRST_RESERVED)
    decode = lambda x: encoder(path, literal=True).tokenizer.decode(
        x.tolist(), skip_special_tokens=False)
    marks = [names[int(ids[e])] for e in edges]
    parts = [decode(ids[a + 1:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    if marks[0] == "<|role|>":
        role, text = unescape(parts[0]), unescape(parts[1])
    else:
        role = next(r for r, (o, _) in ROLES.items() if o == marks[0])
        text = unescape(parts[0])
    learned = unescape(decode(ids[mask.astype(bool)])) if mask.any() else ""
    formatted = "".join(x for pair in zip(marks, [*parts, ""], strict=True) for x in pair)
    return role, text, learned, formatted


def _digest(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn to a row per conversation."""
    state, rows = None, []

    def close():
        rows.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

    for batch in batches:
        for conv, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "mask")),
                                   strict=True):
            if state is None or state[0] != conv:
                if state:
                    close()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text, learned, formatted = read_turn(path, unpack(ids), unpack(mask))
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[3] += len(learned)
            state[4].update(learned.encode())
            state[5] += len(formatted)
        if len(rows) >= 1000:
            yield _rows(rows)
            rows = []
    if state:
        close()
    if rows:
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string() if "sha" in f else pa.int64() for f in DIGEST_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=[f.split()[0] for f in DIGEST_SCHEMA.split(", ")])


def digest(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """One row per conversation, read back from the ids and masks alone."""
    path = path or public_path("byte_bpe_50k.json")
    # Turns with the same number keep a fixed order through their own bytes.
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return rows.select("conv_id", "ids", "mask").mapInArrow(lambda b: _digest(b, path), DIGEST_SCHEMA)
