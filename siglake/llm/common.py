"""Shared helpers: staged tables, size-checked joins, vectorised word hashing.

Word hashing works on the raw UTF-8 buffer of an Arrow string column, so no
Python string per word is ever built. The white-space bytes are
``[\\x20\\x09-\\x0D]``, which never occur inside a multi-byte UTF-8 character.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from siglake.session import shared_path

#: Largest thin table (ids, spans) that is broadcast, as stored, and most rows of
#: one that is not stored. Beyond them the same join runs as a shuffle join.
BROADCAST_BYTES = 12 << 20
BROADCAST_ROWS = 200_000
#: Bins that ``value_at`` counts at a time.
BINS = 4096
#: Session settings for tables of long texts, changed only where they stand at Spark's default: rows and
#: bytes that go to a Python worker at once, rows that a Parquet reader decodes at once, and plain reads
#: instead of vectored ones, which keep a column chunk of direct memory for each reading thread.
SESSION = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b"),
    "spark.sql.parquet.columnarReaderBatchSize": ("4096", "512"),
    "parquet.hadoop.vectored.io.enabled": (None, "false"),
}
#: What makes a worker give freed memory back: it lives on between stages beside the executor's heap.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": "8388608",
              "MALLOC_TRIM_THRESHOLD_": "16777216", "MALLOC_ARENA_MAX": "2"}

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U(pow(int(_BASE), -1, 1 << 64))
_PIECE = 1 << 18


# ----------------------------------------------------------------- tables

def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (as ``--py-files`` would),
    and hand them rows in batches that suit long texts."""
    import siglake

    root = os.path.dirname(os.path.dirname(os.path.abspath(siglake.__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    for name, value in WORKER_ENV.items():
        env.setdefault(name, value)
    for name, (usual, own) in SESSION.items():
        if spark.conf.get(name, None) == usual:          # the session's own choice stands
            spark.conf.set(name, own)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: the copy survives lost executors. Call ``discard`` on
    the result once nothing reads it any more.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in tables:
        path = getattr(df, "staged_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame) -> DataFrame:
    """Mark a thin table for broadcast if it is small: a staged one by its bytes, another by its counted rows."""
    path = getattr(df, "staged_path", None)
    if path is None:
        return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of the driver's few rows, handed over as Arrow: from plain rows Spark would make a Python RDD,
    for which each executor starts a daemon and workers of their own and keeps them."""
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), kind)


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df``, staged, with the number ``name`` of each row from 0 without gaps, in the order of its tasks and rows.

    Only one count for each task comes to the driver, and goes back as a broadcast.
    """
    kept = staged(df.withColumn(name, F.monotonically_increasing_id()), f"{label}-rows")
    # a task's rows are numbered in the low 33 bits
    task = F.shiftrightunsigned(name, 33)
    counts = {r["task"]: r["n"] for r in kept.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()}
    total, offsets = 0, []
    for t in sorted(counts):
        offsets.append((t, total))
        total += counts[t]
    before = local_rows(df.sparkSession, offsets, "task bigint, before bigint")
    low = F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    out = kept.withColumn("task", task).join(F.broadcast(before), "task").withColumn(name, F.col("before") + low)
    out = staged(out.select(*df.columns, name), label)
    discard(kept)
    return out


def columns_of(docs: DataFrame) -> list[Column]:
    """All columns of ``docs`` in order, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def text_hash(text: str) -> Column:
    """What tells apart the texts of rows that repeat an id."""
    return F.xxhash64(text)


def without(docs: DataFrame, gone: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose id and text are not in ``gone``; all columns as they were.

    ``gone`` is staged and holds ``doc_id`` and ``h`` (``text_hash``). With ``rows``, which holds
    them for every row of ``docs``, one of those that repeat both stays.
    """
    own, n = "h", 0
    while own in docs.columns:                       # a name that the documents do not have
        own, n = f"h{n}", n + 1
    hashed = docs.withColumn(own, text_hash("text"))

    def same(other: DataFrame, names: str) -> Column:
        return hashed["doc_id"].eqNullSafe(other[f"{names}_id"]) & (hashed[own] == other[f"{names}_h"])

    out = gone.select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h"))
    kept = hashed.join(_sized_as(out, gone), same(out, "gone"), "left_anti")
    if rows is None:
        return kept.select(*columns_of(docs))
    twice = staged(rows.groupBy("doc_id", "h").count().where("count > 1").select("doc_id", "h"), "twice")
    if twice.limit(1).count():
        two = twice.select(F.col("doc_id").alias("two_id"), F.col("h").alias("two_h"))
        once = kept.join(_sized_as(two, twice), same(two, "two"), "left_semi").dropDuplicates(["doc_id", own])
        kept = kept.join(_sized_as(two, twice), same(two, "two"), "left_anti").unionByName(once)
    return kept.select(*columns_of(docs))


def _sized_as(df: DataFrame, stored: DataFrame) -> DataFrame:
    """``df``, a projection of a staged table, marked for broadcast as that table would be."""
    df.staged_path = stored.staged_path
    return small(df)


_kept = {"stage": None, "tables": []}


def begin_stage() -> None:
    """In a worker's first task of a stage: drop the tables of other stages, give freed memory back to the system."""
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if stage != _kept["stage"]:
        _kept["stage"] = stage
        for made in _kept["tables"]:
            made.cache_clear()
        pa.default_memory_pool().release_unused()


def per_stage(make: Callable) -> Callable:
    """``make`` with its results kept in a worker for the tasks of one stage; the worker outlives it."""
    made = lru_cache(maxsize=2)(make)
    _kept["tables"].append(made)

    @wraps(make)
    def get(*args):
        begin_stage()
        return made(*args)

    return get


def chunked(batches: Iterator[pa.RecordBatch], max_bytes: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Re-cut batches so that each holds about ``max_bytes`` of text (one row at least).

    Gives back to the system what other stages left in the worker before them, and freed memory after them.
    """
    begin_stage()
    for b in batches:
        if not b.num_rows:
            continue
        _, off = string_buffers(b.column(b.schema.get_field_index(text)))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(off, off[at] + max_bytes, "right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()


def string_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; a null row has no bytes."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[off[0]:off[-1]]
    return raw, off - off[0]


# ---------------------------------------------------------------- hashing

def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), vectorised."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        n = max(n, _PIECE)
        up, down = np.full(n, _BASE), np.full(n, _BASE_INV)
        up[0] = down[0] = U(1)
        _powers.update(n=n, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the ascending, disjoint byte spans."""
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + _PIECE, "right")))
        size = int(ends[to - 1] - base)
        up, down = _power_tables(size + 1)
        prefix = np.zeros(size + 1, U)
        np.cumsum((data[base:base + size].astype(U) + U(1)) * up[:size], out=prefix[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (prefix[e] - prefix[s]) * down[s] + (e - s).astype(U) * U(0xA24BAED4963EE407)
        at = to
    return mix(out)


def words_of(data: np.ndarray, off: np.ndarray, lower: bool = False
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row: (hashes, first bytes, end bytes, words per row)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, U), z, z, np.zeros(len(off) - 1, np.int64)
    if lower:
        data = _LOWER[data]
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    o = off[:-1][off[:-1] < n]
    first[o] = word[o]
    o = off[1:][off[1:] > 0] - 1
    last[o] = word[o]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    per_row = np.diff(np.searchsorted(starts, off))
    return span_hashes(data, starts, ends), starts, ends, per_row


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (runs may cross rows)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    acc = words[:m] * U(0xD6E8FEB86659FD93)
    for k in range(1, n):
        acc = (acc ^ (acc >> U(32))) * U(0xD6E8FEB86659FD93) + words[k:k + m]
    return mix(acc)


def shingle_rows(words: np.ndarray, per_row: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Per row: its ``n``-word shingles in order; fewer words give one shingle of all; none gives none."""
    grams = ngram_hashes(words, n)
    ends = np.cumsum(per_row)
    out = []
    for end, c in zip(ends.tolist(), per_row.tolist()):
        if c >= n:
            out.append(grams[end - c:end - n + 1])
        elif c:
            out.append(ngram_hashes(words[end - c:end], c) ^ U(c))
        else:
            out.append(grams[:0])
    return out


# ------------------------------------------------------------- components

def components(links: DataFrame, label: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``links(a, b)``: (id, component), component the smallest id.

    Alternates the large-star and small-star steps. Each step is a minimum per
    vertex (combined before the shuffle) joined back to the edges, so a vertex
    with very many neighbours is never gathered; AQE splits its join. A round is
    one job that writes its edges to the shared folder, and only a count and a
    checksum, observed while they are written, come to the driver. Ids must not
    be null; self-links are ignored.
    """
    def stars(edges: DataFrame, large: bool) -> DataFrame:
        # edges hold (u, v) with v < u; the large star looks at them from both ends
        near = edges.union(edges.select("v", "u")).toDF("u", "v") if large else edges
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = near.join(low, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            out = out.union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def stored(df: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        out = staged(df.observe(seen, F.count(F.lit(1)).alias("n"),
                                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("check")), label)
        return out, (seen.get["n"], seen.get["check"])

    edges, seen = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .distinct())
    for _ in range(max_rounds if seen[0] else 0):
        after, now = stored(stars(stars(edges, True), False))
        discard(edges)
        edges = after
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"{label}: components did not settle in {max_rounds} rounds")
    low = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return low.union(low.select(F.col("component").alias("id"), "component").distinct())


def hash_sample(rows: DataFrame, key: Column, bound: int) -> DataFrame:
    """Rows whose key hash lies under a threshold, about 1.3 times ``bound`` of them, with the hash as ``h``.

    The threshold is a place among all 64-bit hashes and comes from a count, so no
    task gathers more than its own share at any size. Keys that repeat come whole
    or not at all: who collects the rows bounds them with ``bounded``.
    """
    return rows.withColumn("h", F.xxhash64(key)).where(F.col("h") <= hash_threshold(bound, rows.count()))


def hash_threshold(bound: int, n: int) -> int:
    """The signed 64-bit value under which the hashes of about 1.3 times ``bound`` of ``n`` keys lie."""
    return min((1 << 63) - 1, (13 * bound << 64) // (10 * n) - (1 << 63)) if n else (1 << 63) - 1


def bounded(rows: DataFrame, bound: int) -> DataFrame:
    """The ``bound`` rows of smallest ``h``: each task keeps at most that many, and so does the driver."""
    return rows.orderBy("h").limit(bound)


def value_at(rows: DataFrame, column: str, place: int) -> float:
    """The number at ``place`` (from 0) of ``column`` in ascending order, over all rows of a staged table.

    Rows are counted in bins between the least and the largest value, then in bins of
    the one that holds the place, until one value is left: exact, and no task
    or driver holds more than the counts of one pass. Nulls have no place.
    """
    at = F.col(column)
    low, high = rows.agg(F.min(at), F.max(at)).first()
    while low < high:
        share = (at - F.lit(low)) / F.lit(high - low)
        bins = (rows.where(at.between(low, high)).groupBy(F.floor(share * BINS).alias("bin"))
                .agg(F.count("*").alias("n"), F.min(at).alias("low"), F.max(at).alias("high")).orderBy("bin").collect())
        for b in bins:
            if place < b["n"]:
                low, high = b["low"], b["high"]
                break
            place -= b["n"]
    return low


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


ArrowFn = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
