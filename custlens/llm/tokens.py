"""Encoding of texts with a public tokenizer, by distinct chunks.

A text is cut before each run of white space; the tokenizers' own rules never
join across such a cut, so a text's ids are its chunks' ids in a row.  Each
distinct chunk of a slice of texts is encoded once and the ids are gathered with
array operations, which costs a fraction of encoding every text.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from custlens.llm.common import strings

#: White space as the tokenizers' patterns see it (Unicode White_Space).
WHITE = r"\t\n\x0B\f\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

#: Distinct chunks whose ids a worker remembers between slices (some 40 bytes each);
#: beyond that it starts anew.
REMEMBERED = 2_000_000
#: Chunks of one running text.
RUN = 500


class ChunkEncoder:
    """Ids of many texts at once.  ``path`` names a tokenizers file; special
    tokens are not added.  ``literal`` reads their strings as ordinary text."""

    def __init__(self, path: str, literal: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.decoders import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = literal
        # Without a normaliser, the tokens of a byte-level vocabulary spell the text's
        # bytes, one character each: their lengths tell where they stand.
        self._bytes = None
        if self.tokenizer.normalizer is None and isinstance(self.tokenizer.decoder, ByteLevel):
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self._bytes = np.zeros(max(vocab.values()) + 1, np.int64)
            self._bytes[list(vocab.values())] = [len(t) for t in vocab]
        self._forget()

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's ids start
        (one entry more than texts)."""
        text = strings(text)
        # An unused control mark goes before each run of white space, then texts are cut at it.
        marked = pc.replace_substring_regex(text, f"([{WHITE}]+)", "\x1e\\1")
        parts = pc.split_pattern(marked, "\x1e")
        flat, off = parts.flatten(), np.asarray(parts.offsets).astype(np.int64)
        off -= off[0]
        # A text may hold the mark itself; such texts are encoded whole.
        odd = np.flatnonzero(np.asarray(pc.match_substring(text, "\x1e")))
        coded = flat.dictionary_encode()
        pool, at, size = self._distinct(coded.dictionary)
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        each = size[code]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        # Position in the pool of every id: its chunk's start plus its place in the chunk.
        place = np.arange(total)
        place += np.repeat(at[code] - (ends - each), each)
        out = pool[place]
        starts = np.concatenate([[0], ends])[off]
        if len(odd):
            out, starts = self._whole(text, odd, out, starts)
        return out, starts

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where in it each chunk's ids start and how many they are."""
        if len(self._chunks) + len(chunks) > REMEMBERED:
            self._forget()
        found = pc.index_in(chunks, value_set=self._chunks)
        new = chunks.filter(pc.is_null(found))
        if len(new):
            ids, size = self._encode_new(new)
            at = len(self._pool) + np.cumsum(size) - size
            self._pool = np.concatenate([self._pool, ids])
            self._at = np.concatenate([self._at, at.astype(np.int32)])
            self._size = np.concatenate([self._size, size.astype(np.int32)])
            self._chunks = pa.concat_arrays([self._chunks, new])
            known = found.to_numpy(zero_copy_only=False)
            where = np.where(np.isnan(known), 0, known).astype(np.int64)
            where[np.isnan(known)] = np.arange(len(self._chunks) - len(new), len(self._chunks))
        else:
            where = found.to_numpy(zero_copy_only=False).astype(np.int64)
        return self._pool, self._at[where].astype(np.int64), self._size[where].astype(np.int64)

    def _encode_new(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in a row, and how many each has.  Chunks of one blank and a
        word are encoded as one running text, whose tokens' places tell the chunk."""
        plain = np.asarray(pc.match_substring_regex(chunks, f"^ [^{WHITE}]"))
        names = chunks.to_pylist()
        ids: list[np.ndarray] = []
        size = np.zeros(len(names), np.int64)
        rest = np.flatnonzero(~plain)
        run = np.flatnonzero(plain)
        length = np.asarray(pc.binary_length(chunks) if self._bytes is not None
                            else pc.utf8_length(chunks)).astype(np.int64)
        for k in range(0, len(run), RUN):
            own = run[k:k + RUN]
            text = "".join([names[i] for i in own])
            if self._bytes is not None:
                got = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                first = self._bytes[got].cumsum() - self._bytes[got]
            else:
                done = self.tokenizer.encode(text, add_special_tokens=False)
                got = np.array(done.ids, np.uint32)
                first = np.array(done.offsets, np.int64).reshape(-1, 2)[:, 0]
            ids.append(got)
            size[own] = np.bincount(np.searchsorted(np.cumsum(length[own]), first, side="right"),
                                    minlength=len(own))
        done = self.tokenizer.encode_batch_fast([names[i] for i in rest], add_special_tokens=False)
        ids += [np.array(e.ids, np.uint32) for e in done]
        size[rest] = [len(e.ids) for e in done]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        # From the order of encoding to the chunks' own.
        order = np.concatenate([run, rest])
        begin = np.empty(len(names), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(flat))
        return flat[place], size

    def _forget(self):
        self._chunks = pa.array([], pa.string())
        self._pool, self._at, self._size = np.zeros(0, np.uint32), *np.zeros((2, 0), np.int32)

    def _whole(self, text, odd, out, starts):
        pieces, sizes = [], np.diff(starts)
        for i in range(len(sizes)):
            pieces.append(out[starts[i]:starts[i + 1]])
        for i in odd:
            e = self.tokenizer.encode(text[int(i)].as_py(), add_special_tokens=False)
            pieces[i] = np.array(e.ids, np.uint32)
            sizes[i] = len(pieces[i])
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum(sizes)])


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, literal: bool = False) -> ChunkEncoder:
    """One encoder per worker process and file."""
    key = path, literal
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, literal)
    return _ENCODERS[key]


def forget() -> None:
    """Free what encoders remember, where a worker goes on to stages without them."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def with_end(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` appended to every text's ids."""
    n = len(starts) - 1
    out = np.full(len(ids) + n, end, np.uint32)
    new = starts + np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new
