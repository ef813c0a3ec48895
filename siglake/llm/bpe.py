"""Byte-level BPE by a monoid tree reduction.

Encodings of byte strings form a monoid: ``join(encode(a), encode(b))`` equals
``encode(a + b)``. A string is encoded by halves, recursively, and two
neighbours are joined by encoding a window around their border anew. The window
grows until the tokens outside it provably do not change: a token sequence is
the encoding of its bytes exactly when each two neighbouring tokens are the
encoding of their own bytes, so it is enough that the tokens at both window
edges are compatible with what lies beside them. The leaves are single bytes, at
every length of the string; decoding concatenates the tokens' bytes in pairs, up
the same kind of tree.

Text is first split by the vocabulary's pattern; each match is a string of its
own, and matches and short halves seen before keep their tokens. A match that is a
token itself is that token.

Defined cases: a null or empty text has no tokens; texts of any length and
pieces of any length work (a long piece costs O(n log^2 n)); other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import chunked, per_stage, string_buffers
from siglake.llm.tokens import BatchEncoder

HEAP_BYTES = 64          # windows beyond this length are re-encoded with a heap
KNOWN_BYTES = 12         # halves up to this length are remembered
KNOWN = 300_000          # of them before the memory starts afresh


class TreeBpe:
    """Encoder and decoder over a rank table (token bytes -> id, lower ids merge first)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, list[int]] = {}
        self.batch = BatchEncoder(pattern, self.encode_bytes)

    @classmethod
    def load(cls, path: str, pattern: str) -> "TreeBpe":
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}, pattern)

    # -- the monoid -------------------------------------------------------
    def _merge(self, text: bytes) -> list[int]:
        """Tokens of a border window by merging its lowest-ranked pair, leftmost first, until none is left."""
        if len(text) > HEAP_BYTES:
            return self._merge_long(text)
        parts = [text[i:i + 1] for i in range(len(text))]
        get = self.ranks.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _merge_long(self, text: bytes) -> list[int]:
        """The same merges with a heap over linked parts, for long windows."""
        n = len(text)
        part: list[bytes | None] = [text[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.ranks.get
        heap = [(r, i, 2) for i in range(n - 1) if (r := get(text[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if j >= n or part[i] is None or len(part[i]) + len(part[j]) != size:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    r = get(part[a] + part[after[a]])
                    if r is not None:
                        heapq.heappush(heap, (r, a, len(part[a]) + len(part[after[a]])))
        return [self.ranks[p] for p in part if p is not None]

    def _compatible(self, a: int, b: int) -> bool:
        got = self.fits.get((a, b))
        if got is None:
            if len(self.fits) > 500_000:
                self.fits.clear()
            got = self.fits[a, b] = self._merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return got

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of two neighbouring strings together, from the tokens of each."""
        if not left or not right:
            return left or right
        reach = 1
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            window = self._merge(b"".join(map(self.tokens.__getitem__, left[a:] + right[:b])))
            if (a == 0 or self._compatible(left[a - 1], window[0])) and \
                    (b == len(right) or self._compatible(window[-1], right[b])):
                return left[:a] + window + right[b:]
            reach *= 2

    def encode_bytes(self, text: bytes) -> list[int]:
        """Tokens of one piece: halves, recursively, joined up the tree."""
        if text in self.ranks:
            return [self.ranks[text]]
        if not text:
            return []
        half = len(text) // 2
        return self.join(self._half(text[:half]), self._half(text[half:]))

    def _half(self, text: bytes) -> list[int]:
        if len(text) == 1:
            return [self.ranks[text]]
        got = self.known.get(text)
        if got is None:
            half = len(text) // 2
            got = self.join(self._half(text[:half]), self._half(text[half:]))
            if len(text) <= KNOWN_BYTES:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[text] = got
        return got

    # -- texts ------------------------------------------------------------
    def encode(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return self.batch(raw, np.array([0, len(raw)]))[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids: neighbours are put together, level by level, until one string is left."""
        parts = [self.tokens[i] for i in ids.tolist()]
        while len(parts) > 1:
            last = parts[-1:] if len(parts) % 2 else []
            parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + last
        return parts[0] if parts else b""


@per_stage
def tree_encoder(path: str, pattern: str) -> TreeBpe:
    return TreeBpe.load(path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ``ids``, 32-bit little-endian) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, "
              "decoded_sha256 string" + ", ids binary" * keep_ids)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tree_encoder(path, pattern)
        for b in chunked(batches, 1 << 20):
            ids, row = bpe.batch(*string_buffers(b.column(1)))
            n, sha, back, kept = np.diff(row), [], [], []
            for lo, hi in zip(row.tolist(), row[1:].tolist()):
                own = ids[lo:hi]
                raw = own.astype("<u4").tobytes()
                sha.append(hashlib.sha256(raw).hexdigest())
                back.append(hashlib.sha256(bpe.decode(own)).hexdigest())
                if keep_ids:
                    kept.append(raw)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array(kept, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(apply, schema)
