"""Token files: patched frame-of-reference blocks.

Documents are dealt by ranges of their id; each task sorts its range and writes
segments. A segment is one binary value:

    magic, number of documents, number of ids, number of blocks
    document ids (int64) and document ends within the segment (uint64)
    per block: minimum (uint32), width (uint8), start of its packed ids (uint32),
               end of its exceptions in the exception list (uint32)
    exception places within the block (uint8) and their values (uint32)
    packed ids of each block

A block holds 256 ids (the last one is padded). Its minimum is subtracted and
the rest is packed at the width of one of the percentiles below, whichever makes
the block smallest; larger values keep their low bits there and stand whole in
the exception list. Segments are rows of a Parquet table in the order of ids, so
any store that Spark reads can hold them; ``Segment.ids`` finds a range of ids
by the block index and unpacks only the blocks it touches.

Defined cases: null and empty texts are documents of the end id alone; rows that
repeat an id follow each other in the order of their texts; a null id sorts
first; an empty table gives a table without segments; a very long document is
one segment; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import chunked, string_buffers
from siglake.llm.tokens import END, library_encoder
from siglake.session import shared_path

MAGIC = b"PFR1"
BLOCK = 256
PERCENTILES = (90, 96, 100)
SEGMENT_IDS = 1 << 18
NO_ID = -(1 << 63)       # stands for a null document id
_HEAD = struct.Struct("<4sIQI")
_U64 = np.uint64


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """(n, 256) values packed at ``width`` bits: (n, 32 * width) bytes."""
    v = np.ascontiguousarray(rows.reshape(-1, 64).T.astype(_U64))
    out = np.zeros((width, v.shape[1]), _U64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= v[i] << _U64(shift)
        if shift + width > 64:
            out[word + 1] |= v[i] >> _U64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8).reshape(len(rows), 32 * width)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").astype(_U64).reshape(-1, width).T)
    out = np.empty((64, words.shape[1]), _U64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[i] = words[word] >> _U64(shift)
        if shift + width > 64:
            out[i] |= words[word + 1] << _U64(64 - shift)
    out &= _U64((1 << width) - 1)
    return np.ascontiguousarray(out.T).astype(np.uint32).reshape(-1, BLOCK)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def encode_segment(doc_ids: list[int | None], docs: list[bytes]) -> bytes:
    """One segment of whole documents, each given as its ids (unsigned 32-bit, little-endian)."""
    ids = np.frombuffer(b"".join(docs), "<u4")
    ends = np.cumsum([len(d) // 4 for d in docs]).astype("<u8")
    n_blocks = -(-len(ids) // BLOCK)
    padded = np.concatenate([ids, np.full(n_blocks * BLOCK - len(ids), ids[-1] if len(ids) else 0, ids.dtype)])
    blocks = padded.reshape(n_blocks, BLOCK)
    low = blocks.min(1) if n_blocks else np.zeros(0, np.uint32)
    rest = blocks - low[:, None]
    best = np.full(n_blocks, np.iinfo(np.int64).max)
    width = np.zeros(n_blocks, np.int64)
    ordered = np.sort(rest, 1)
    for p in PERCENTILES:
        w = _bits(ordered[:, (BLOCK - 1) * p // 100])
        cost = 32 * w + 5 * (rest >> w.astype(np.uint32)[:, None] > 0).sum(1)
        better = cost < best
        best[better], width[better] = cost[better], w[better]
    odd = (rest >> width.astype(np.uint32)[:, None]) > 0
    starts = np.concatenate([[0], np.cumsum(32 * width)])
    data = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        packed = _pack(rest[at] & np.uint32((1 << w) - 1), w)
        data[starts[at][:, None] + np.arange(32 * w)] = packed
    names = np.array([NO_ID if d is None else d for d in doc_ids], "<i8")
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in (
        _HEAD.pack(MAGIC, len(docs), len(ids), n_blocks), names, ends,
        low.astype("<u4"), width.astype(np.uint8), starts[:-1].astype("<u4"), np.cumsum(odd.sum(1)).astype("<u4"),
        np.nonzero(odd)[1].astype(np.uint8), rest[odd].astype("<u4"), data))


class Segment:
    """Reader of one segment: document index, block index, exceptions, blocks."""

    def __init__(self, raw: bytes):
        magic, n, self.n_ids, n_blocks = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self._raw, self._at = raw, _HEAD.size
        self.doc_ids = self._take("<i8", n)
        self.ends = self._take("<u8", n).astype(np.int64)
        self.low, self.width = self._take("<u4", n_blocks), self._take("u1", n_blocks).astype(np.int64)
        self.starts = self._take("<u4", n_blocks).astype(np.int64)
        self.odd_ends = self._take("<u4", n_blocks).astype(np.int64)
        n_odd = int(self.odd_ends[-1]) if n_blocks else 0
        self.places, self.values = self._take("u1", n_odd), self._take("<u4", n_odd)
        self.data = np.frombuffer(raw, np.uint8, offset=self._at)

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self._raw, kind, n, self._at)
        self._at += out.nbytes
        return out

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi`` of the segment; unpacks only the blocks that hold them."""
        first, last = lo // BLOCK, -(-hi // BLOCK)
        width, starts = self.width[first:last], self.starts[first:last]
        rest = np.zeros((len(width), BLOCK), np.uint32)
        for w in np.unique(width[width > 0]).tolist():
            at = np.flatnonzero(width == w)
            rest[at] = _unpack(self.data[starts[at][:, None] + np.arange(32 * w)], w)
        a = int(self.odd_ends[first - 1]) if first else 0
        b = int(self.odd_ends[last - 1]) if last else 0
        per_block = np.diff(np.concatenate([[a], self.odd_ends[first:last]]))
        rest[np.repeat(np.arange(len(width)), per_block), self.places[a:b]] = self.values[a:b]
        return (rest + self.low[first:last, None]).ravel()[lo - first * BLOCK:hi - first * BLOCK]

    def all_ids(self) -> np.ndarray:
        return self.ids(0, self.n_ids)


def new_path(spark) -> str:
    """A new place for token files in the shared folder."""
    return shared_path(spark, "llm", f"tokens-{uuid.uuid4().hex}")


_SCHEMA = "part int, segment int, n_docs bigint, first_id bigint, n_ids bigint, payload binary"


def write_tokens(docs: DataFrame, out: str, tokenizer: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Tokenise ``docs`` and write the segment table to ``out`` in ascending order of ids."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, pattern)
        part = TaskContext.get().partitionId()
        names: list[int | None] = []
        held: list[bytes] = []
        count = seq = first = 0

        def segment():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held)], pa.int64()),
                 pa.array([first], pa.int64()), pa.array([count], pa.int64()),
                 pa.array([encode_segment(names, held)], pa.binary())],
                names=["part", "segment", "n_docs", "first_id", "n_ids", "payload"])

        for b in chunked(batches, 1 << 20):
            ids, row = encoder(*string_buffers(b.column(1)))
            ids = ids.astype("<u4")
            for name, lo, hi in zip(b.column(0).to_pylist(), row.tolist(), row[1:].tolist()):
                names.append(name)
                held.append(ids[lo:hi].tobytes() + END)
                count += hi - lo + 1
                if count >= SEGMENT_IDS:
                    yield segment()
                    names, held, count, seq, first = [], [], 0, seq + 1, first + count
        if held:
            yield segment()

    (dealt.mapInArrow(write, _SCHEMA).write.option("compression", "uncompressed").parquet(out))


def read_tokens(spark, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ``ids``) of every document, from the files."""
    table = spark.read.schema(_SCHEMA).parquet(path)
    # ids before each part: a row per write task comes to the driver, as its task results did
    before, seen = {}, 0
    for r in table.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        before[r["part"]] = seen
        seen += r["n"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, first, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
                seg = Segment(raw)
                ids = seg.all_ids().astype("<u4").tobytes()
                ends = seg.ends
                begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                own = [ids[4 * i:4 * j] for i, j in zip(begins.tolist(), ends.tolist())]
                cols = [pa.array([None if d == NO_ID else d for d in seg.doc_ids.tolist()], pa.int64()),
                        pa.array(begins + (before[part] + first)), pa.array(ends - begins),
                        pa.array([zlib.crc32(x) for x in own], pa.int64())]
                out = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array(own, pa.binary()))
                    out.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=out)

    return table.select("part", "first_id", "payload").mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * keep_ids)
