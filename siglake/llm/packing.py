"""Best-fit packing after Martello-Toth dominance reduction.

Only piece lengths matter, and there are at most ``capacity`` of them, so the
instance is a histogram of at most ``capacity`` counts however many documents
there are. The driver plans on this histogram with whole runs of equal bins:

1. dominance reduction: for each length, longest first, a set of pieces that
   provably dominates every other set with such a piece is fixed for good:
   alone if nothing fits beside it; with its exact complement; with the longest
   piece that fits if no two others fit, or if no three fit and no two that fit
   are longer together;
2. best fit of what remains, longest first, into runs of bins of equal rest.

The plan is a list of runs ``(length, first rank, n, first sequence, offset)``,
bounded by the capacity, not by the data. Pieces are ranked within their length
(large lengths are split into bounded buckets first) and joined to their run.

Defined cases: an empty text is the end id alone; documents longer than a
sequence are cut, the first piece being the shorter one; an empty table has no
pieces; equal lengths are ranked by a hash, then id and piece, and rows that
repeat an id are pieces of their own in any order; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siglake.llm.common import chunked, local_rows, staged, string_buffers
from siglake.llm.tokens import END, library_encoder

CAPACITY = 2048
BUCKET_ROWS = 1_000_000    # most pieces of one length ranked together, on average
LEAST_BUCKET = 256         # and the fewest worth a bucket of their own


class Run(NamedTuple):
    """``n`` pieces of ``length`` from ``rank`` on go to sequences from ``sequence`` on, at ``offset``."""
    length: int
    rank: int
    n: int
    sequence: int
    offset: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = {s: n for s, n in counts.items() if n}
        self.capacity, self.runs, self.sequences = capacity, [], 0
        self.rank = dict.fromkeys(self.left, 0)

    def put(self, size: int, n: int, sequence: int, offset: int) -> None:
        self.runs.append(Run(size, self.rank[size], n, sequence, offset))
        self.rank[size] += n
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]

    def fix(self, sizes: tuple[int, ...], n: int) -> None:
        """``n`` full sequences, each of the given sizes, for good."""
        at = 0
        for s in sizes:
            self.put(s, n, self.sequences, at)
            at += s
        self.sequences += n

    def _others(self, j: int) -> list[int]:
        """Sizes still there besides one piece of size j, ascending, each up to three times."""
        out = []
        for s in sorted(self.left):
            out += [s] * min(3, self.left[s] - (s == j))
        return out

    def reduce(self) -> None:
        for j in sorted(self.left, reverse=True):
            while self.left.get(j):
                room, others = self.capacity - j, self._others(j)
                fit = bisect_left(others, room + 1)
                if not fit:
                    self.fix((j,), self.left[j] if not others or others[0] > room else 1)
                    continue
                k = others[fit - 1]
                least = others[:3]
                dominated = k == room or len(least) < 2 or sum(least[:2]) > room
                if not dominated and (len(least) < 3 or sum(least) > room):
                    dominated = _best_pair(others[:fit], room) <= k
                if not dominated:
                    break
                self.fix((j, k), self.left[j] // 2 if j == k else min(self.left[j], self.left[k]))

    def best_fit(self) -> None:
        open_runs: dict[int, list[tuple[int, int]]] = {}     # rest -> [(first sequence, bins)]
        rests: list[int] = []

        def push(rest: int, sequence: int, n: int) -> None:
            if rest and n:
                if not open_runs.setdefault(rest, []):
                    insort(rests, rest)
                open_runs[rest].append((sequence, n))

        for size in sorted(self.left, reverse=True):
            while n := self.left.get(size, 0):
                i = bisect_left(rests, size)
                if i < len(rests):
                    rest = rests[i]
                    sequence, bins = open_runs[rest].pop()
                    if not open_runs[rest]:
                        rests.pop(i)
                    m = min(n, bins)
                    self.put(size, m, sequence, self.capacity - rest)
                    push(rest, sequence + m, bins - m)
                    push(rest - size, sequence, m)
                    continue
                each = min(self.capacity // size, n)
                bins = n // each
                for i in range(each):
                    self.put(size, bins, self.sequences, i * size)
                push(self.capacity - each * size, self.sequences, bins)
                self.sequences += bins


def _best_pair(sizes: list[int], room: int) -> int:
    """Largest sum of two of the ascending sizes that is at most ``room``."""
    best, lo, hi = 0, 0, len(sizes) - 1
    while lo < hi:
        both = sizes[lo] + sizes[hi]
        if both > room:
            hi -= 1
        else:
            best, lo = max(best, both), lo + 1
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that place every piece of the histogram ``length -> count``."""
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    p = _Plan(counts, capacity)
    p.reduce()
    p.best_fit()
    return p.runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged: doc_id, piece, length, ...) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}   # <= capacity rows
    runs = plan(counts, capacity)
    table = F.broadcast(local_rows(
        spark, [tuple(r) for r in runs], "r_length bigint, r_rank bigint, r_n bigint, r_sequence bigint, offset bigint"))
    # a length that many pieces have is dealt to several tasks
    even = sum(counts.values()) // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    per_bucket = min(BUCKET_ROWS, max(LEAST_BUCKET, even))
    buckets = F.broadcast(local_rows(
        spark, [(s, -(-n // per_bucket)) for s, n in counts.items()], "length bigint, r_buckets bigint"))
    rows = pieces.join(buckets, "length").withColumn("r_bucket", F.pmod(F.xxhash64("doc_id", "piece"), "r_buckets"))
    # ranks within (length, bucket); the buckets of a length follow each other
    sizes = rows.groupBy("length", "r_bucket").count()
    before = Window.partitionBy("length").orderBy("r_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "r_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("r_before"))
    own = Window.partitionBy("length", "r_bucket").orderBy("doc_id", "piece")
    ranked = (rows.withColumn("r_own", F.row_number().over(own) - 1).join(starts, ["length", "r_bucket"])
              .withColumn("r_at", F.col("r_own") + F.col("r_before")))
    placed = ranked.join(table, (F.col("length") == F.col("r_length")) & (F.col("r_at") >= F.col("r_rank"))
                         & (F.col("r_at") < F.col("r_rank") + F.col("r_n")))
    return placed.select(*pieces.columns, (F.col("r_sequence") + F.col("r_at") - F.col("r_rank")).alias("sequence_id"),
                         "offset")


def pieces_of(docs: DataFrame, tokenizer: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
              capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ``ids``) of the tokenised documents."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, "
              "ids_crc32 bigint" + ", ids binary" * keep_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, pattern)
        for b in chunked(batches, 1 << 20):
            out: list[list] = [[], [], [], [], [], []]
            every, row = encoder(*string_buffers(b.column(1)))
            every = every.astype("<u4")
            for doc, lo, hi in zip(b.column(0).to_pylist(), row.tolist(), row[1:].tolist()):
                ids = every[lo:hi].tobytes() + END
                n = len(ids) // 4
                first = n % capacity or capacity
                ends = [first, *range(first + capacity, n + 1, capacity)]
                for i, end in enumerate(ends):
                    start = ends[i - 1] if i else 0
                    own = ids[4 * start:4 * end]
                    for column, value in zip(out, (doc, i, start, end - start, zlib.crc32(own), own)):
                        column.append(value)
            kinds = (b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + keep_ids]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)][:len(names)], names=names)

    return rows.mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(staged(pieces_of(docs, tokenizer, pattern, capacity=capacity), "pieces"), capacity)
