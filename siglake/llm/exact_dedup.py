"""Exact de-duplication by a heavy-hitter split.

1. Every text is normalised (white space deleted) and digested once into a
   thin table ``(doc_id, n_points, digest)``; no later step reads a text.
2. A Misra-Gries summary of ``k`` counters per partition, merged with the same
   rule, names every digest held by more than ``rows / (k + 1)`` rows.
3. Those at most ``k`` candidates are counted exactly; the verified ones get
   their winner, and this table of at most ``k`` rows is broadcast: rows of
   heavy groups are settled where they are, without a shuffle.
4. The remaining digests, none of them frequent, are grouped by an ordinary
   shuffle.

Defined cases: a null text counts as empty; an empty table gives an empty
result; equal lengths go to the smallest id; a null id loses to any other id
and its group may have ``keep_id`` null only if it holds no other id; every row
is a row of its own, also one that repeats an id: of rows that repeat id and text
one is kept; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import _SPACE, chunked, local_rows, staged, string_buffers, text_hash, without

#: Counters of a Misra-Gries summary: the bound on the broadcast table.
COUNTERS = 1024

_THIN = "doc_id bigint, h bigint, n_points bigint, digest binary"


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunked(batches, 4 << 20):
        data, off = string_buffers(b.column(2))
        keep = ~_SPACE[data]
        left = np.zeros(len(data) + 1, np.int64)
        np.cumsum(keep, out=left[1:])
        heads = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
        packed, cut = data[keep].tobytes(), left[off].tolist()
        view = memoryview(packed)
        digests = [hashlib.sha256(view[i:j]).digest() for i, j in zip(cut, cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(np.diff(heads[off])), pa.array(digests, pa.binary())],
            names=["doc_id", "h", "n_points", "digest"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, n_points, digest): hash of each text, its code points, and its SHA-256 without white space."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_hash(text_col).alias("h"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(_digest_batches, _THIN)


def _summarise(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """Misra-Gries reduction to at most ``k`` counters: the (k+1)-th largest count is taken off all."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {d: c - cut for d, c in counts.items() if c > cut}


def frequent(keys: DataFrame, key: str, k: int = COUNTERS) -> DataFrame:
    """At most ``k`` candidate values of ``key``; every value of more than rows/(k+1) rows is among them."""
    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for b in batches:
            for d in b.column(0).to_pylist():
                counts[d] = counts.get(d, 0) + 1
            if len(counts) > 8 * k:
                counts = _summarise(counts, k)
        counts = _summarise(counts, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["key", "n"])

    parts = keys.select(F.col(key).alias("key")).mapInArrow(summary, "key binary, n bigint")
    merged = parts.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(k + 1)
    # at most k+1 rows reach the driver; the same reduction merges the summaries
    rows = {r["key"]: r["n"] for r in merged.collect()}
    kept = _summarise(rows, k)
    return local_rows(keys.sparkSession, [(bytes(d),) for d in kept], f"{key} binary")


def _groups(rows: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no"), "doc_id", "h", "row"))
    return (rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))
            .select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.h").alias("keep_h"),
                    F.col("best.row").alias("keep_row"), "group_size"))


def _decided(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """The thin table with the row that stays of each row's group."""
    # rows are numbered once and stored, so that those that repeat id and text can be told apart
    thin = staged(digests(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests")
    total = thin.count()
    candidates = F.broadcast(frequent(thin, "digest", k))
    winners = staged(_groups(thin.join(candidates, "digest")).where(F.col("group_size") * (k + 1) > F.lit(total)),
                     "winners")
    winners = F.broadcast(winners)                                   # at most k rows, each verified
    heavy = thin.join(winners, "digest")
    light = thin.join(winners.select("digest"), "digest", "left_anti")
    return heavy.unionByName(light.join(_groups(light), "digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return _decided(docs, id_col, text_col, k).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns stay."""
    rows = staged(_decided(docs.select("doc_id", "text"), "doc_id", "text", k), "decided")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("h") == F.col("keep_h"))
    gone = staged(rows.where(~same).select("doc_id", "h").distinct(), "dropped")
    return without(docs, gone, rows)
