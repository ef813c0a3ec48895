"""Whole texts to token ids, a batch at a time.

Byte-level vocabularies split a text by a fixed pattern and encode each match on
its own, so a piece seen before needs no second encoding. A batch is split as
arrays of code points, its pieces are looked up by a 64-bit hash and their length
in a bounded table, and only unknown pieces go to the encoder (the ``tokenizers``
library, or the tree encoder of ``bpe``). Tables live as long as a worker's tasks of one stage.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from siglake.llm.common import U, per_stage, span_hashes

END = array("I", [0]).tobytes()   # id 0 ends a document
SLOTS = 1 << 21                   # pieces a worker remembers: 40 MB of table, and their ids
POOL_IDS = 12_000_000             # ids of remembered pieces before the table starts afresh

#: Fixed value: the split pattern that ``split`` computes with arrays.
ARRAY_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, name in ((_LETTER, "L"), (_NUMBER, "N"), (_SPACE, "White_Space")):
        for m in regex.finditer(rf"\p{{{name}}}+", every):
            found = np.frombuffer(m[0].encode("utf-32-le"), np.uint32)
            out[found] = kind
    return out


def split(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the matches of ARRAY_PATTERN start in rows of code points laid end to end.

    ``rows`` holds the start of each row. Every code point belongs to a match.
    """
    n = len(points)
    kind = _classes()[points]
    row_start = np.zeros(n + 3, bool)
    row_start[rows[rows < n]] = True
    row_start[n:] = True
    start = np.empty(n + 3, bool)
    start[0] = True
    start[1:n] = kind[1:] != kind[:-1]
    start[n:] = True
    start |= row_start
    # the last white space before another character starts a match; a blank takes that character's run along
    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~row_start[1:n])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    # an apostrophe alone, at the start of a match, takes a contraction's letters along
    q = np.flatnonzero((points == 39) & start[:n])
    q = q[(q + 1 < n) & ~row_start[q + 1]]
    q = q[kind[q + 1] == _LETTER]
    if len(q):
        a = points[q + 1]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        inside = (q + 2 < n) & ~row_start[q + 2]
        b = np.where(inside, points[np.minimum(q + 2, n - 1)], 0)
        two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
        start[q[one | two] + 1] = False
        start[q[one] + 2] = True
        start[q[two] + 3] = True
    return np.flatnonzero(start[:n])


def splitter(pattern: str) -> Callable[[str], list[str]]:
    r"""All matches of any split pattern; its ``\s`` is Unicode white space, as in the tokenizers' own engines."""
    pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}")
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall


class BatchEncoder:
    """Ids of batches of texts; ``encode`` gives the ids of one piece of UTF-8."""

    def __init__(self, pattern: str, encode: Callable[[bytes], list[int]]):
        self.encode = encode
        self.find = None if pattern == ARRAY_PATTERN else splitter(pattern)
        self._clear()

    def _clear(self) -> None:
        self.key, self.at = np.zeros(SLOTS, U), np.zeros(SLOTS, np.int32)
        self.n, self.size = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _pieces(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """First bytes of all pieces."""
        raw = data.tobytes()
        if self.find is not None:
            out = []
            for a, b in zip(off.tolist(), off[1:].tolist()):
                for piece in self.find(raw[a:b].decode()):
                    out.append(a)
                    a += len(piece.encode())
            return np.array(out, np.int64)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        return heads[split(points, np.searchsorted(heads, off[:-1]))]

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows end to end, where each row's ids start and the last one's end)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if self.used > POOL_IDS:
            self._clear()
        start = self._pieces(data, off)
        size = np.diff(np.append(start, len(data)))
        h = span_hashes(data, start, start + size)
        slot = (h >> U(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        at, n = self.at[slot], self.n[slot]
        miss = np.flatnonzero((self.key[slot] != h) | (self.size[slot] != size))
        if len(miss):
            _, first, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            new = miss[first]
            found = [self.encode(data[a:a + s].tobytes()) for a, s in zip(start[new].tolist(), size[new].tolist())]
            new_n = np.array([len(f) for f in found], np.int32)
            new_at = self.used + np.cumsum(new_n) - new_n
            total = self.used + int(new_n.sum())
            if total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(max(total, len(self.pool)), np.uint32)])
            self.pool[self.used:total] = np.fromiter((i for f in found for i in f), np.uint32, total - self.used)
            self.used = total
            at[miss], n[miss] = new_at[inverse], new_n[inverse]
            s = slot[new]
            self.key[s], self.at[s], self.n[s], self.size[s] = h[new], new_at, new_n, size[new]
        ends = np.cumsum(n, dtype=np.int64)
        ids = self.pool[np.repeat(at - (ends - n), n) + np.arange(int(ends[-1]))]
        row = np.concatenate([[0], ends])[np.searchsorted(start, off)]
        return ids, row


@per_stage
def library_encoder(path: str, pattern: str) -> BatchEncoder:
    """The ``tokenizers`` library's ids without special tokens, for the vocabulary file at ``path``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # the task owns one core
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    return BatchEncoder(pattern, lambda piece: model.encode(piece.decode(), add_special_tokens=False).ids)
