"""File-directory sources, batch and streaming.

Every reader takes an explicit schema: nothing is inferred when a stream
starts, so an empty directory, a missing one, or a first file of a different
shape cannot fix a table's columns. Broken JSON lands in
``_corrupt_record`` instead of failing the read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.schemas import REST_ENVELOPE, UNIFIED_EVENT

CORRUPT = "_corrupt_record"
MAX_FILES_PER_TRIGGER = 50


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def _json_reader(reader, schema: T.StructType, multiline: bool = True, recursive: bool = True):
    return (reader.schema(with_corrupt_column(schema))
            .option("multiline", multiline)
            .option("recursiveFileLookup", recursive)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def with_file_info(df: DataFrame) -> DataFrame:
    """Add ``ingest_file`` and ``file_modified_at`` from the hidden file metadata."""
    return df.withColumns({
        "ingest_file": F.col("_metadata.file_path"),
        "file_modified_at": F.col("_metadata.file_modification_time"),
    })


def read_json(spark: SparkSession, path: str, schema: T.StructType = UNIFIED_EVENT,
              multiline: bool = True) -> DataFrame:
    """A4: batch JSON (one document per file when ``multiline``; array = rows)."""
    return with_file_info(_json_reader(spark.read, schema, multiline).json(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A5: batch CSV with header. Without a schema, types are inferred (one
    extra pass over the files - acceptable for ad-hoc reads, not for jobs)."""
    r = spark.read.option("header", True).option("recursiveFileLookup", True) \
        .option("nullValue", "").option("nanValue", "NaN")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return with_file_info(r.csv(path))


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


_GRACEFUL = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "Path does not exist")


def read_or_empty(spark: SparkSession, read_fn, path: str, schema: T.StructType) -> DataFrame:
    """A missing or empty directory yields an empty frame of ``schema``;
    any other analysis error propagates."""
    try:
        df = read_fn(spark, path, schema)
        df.schema  # force analysis (path resolution) now
        return df
    except AnalysisException as e:
        if any(tag in str(e) for tag in _GRACEFUL):
            out = empty_frame(spark, with_corrupt_column(schema))
            return out.withColumns({"ingest_file": F.lit(None).cast("string"),
                                    "file_modified_at": F.lit(None).cast("timestamp")})
        raise


def stream_json(spark: SparkSession, path: str, schema: T.StructType = UNIFIED_EVENT,
                max_files: int = MAX_FILES_PER_TRIGGER, multiline: bool = True) -> DataFrame:
    """A1: streaming JSON directory (recursive, rate-limited).

    ``multiline=True`` reads one document per file (a pretty-printed object
    or array); ``False`` reads JSON lines, where a line holding an array
    still yields one row per element. Reading JSON lines in multiline mode
    would keep only each file's first record, so the mode is per source.
    """
    r = _json_reader(spark.readStream, schema, multiline).option("maxFilesPerTrigger", max_files)
    return with_file_info(r.json(path))


def stream_csv(spark: SparkSession, path: str, schema: T.StructType,
               max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """A2: streaming CSV directory with header.

    The columns are those of ``schema``, in its order; files of other headers go to the upload folders.
    """
    r = (spark.readStream.schema(schema).option("header", True)
         .option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files))
    return with_file_info(r.csv(path))


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """REST collector envelopes; ``data`` holds each record as JSON text."""
    return read_json(spark, path, REST_ENVELOPE)


def read_binary(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Uploaded files as bytes (path, modificationTime, length, content)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def stream_binary(spark: SparkSession, path: str, glob: str | None = None,
                  max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Uploaded files as a stream of (path, modificationTime, length, content)."""
    from pyspark.sql import types as T2
    schema = T2.StructType([
        T2.StructField("path", T2.StringType()), T2.StructField("modificationTime", T2.TimestampType()),
        T2.StructField("length", T2.LongType()), T2.StructField("content", T2.BinaryType())])
    r = (spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True)
         .option("maxFilesPerTrigger", max_files))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


@dataclass(frozen=True)
class SourceSpec:
    """A3: one landing directory feeding one serving table."""
    path: str          # relative to the landing root
    category: str
    table: str
    fmt: str           # "json" | "csv"; of uploads also "excel" | "pdf", which are typed, sized and hashed
    multiline: bool = True   # JSON: one document per file (True) or JSON lines (False)
    kind: str = "events"     # "events" (unified rows) | "envelopes" (REST collector files)
                             # | "uploads" (uploaded files, any columns)


# Landing directory -> category -> serving table. Message
# folders are the ingest writer's output (``streaming.ingest`` lands JSON
# lines under raw/kafka/category=<c>/); REST envelopes and uploaded JSON
# files are whole documents. A legacy layout is read with its own SourceSpec.
SOURCES = (
    SourceSpec("raw/kafka/category=alarms", "alarms", "alarms", "json", False),
    SourceSpec("raw/kafka/category=tickets", "tickets", "tickets", "json", False),
    SourceSpec("raw/kafka/category=network", "network", "network_events", "json", False),
    SourceSpec("raw/kafka/category=security", "security", "security_events", "json", False),
    SourceSpec("raw/kafka/category=performance", "performance", "performance_metrics", "json", False),
    SourceSpec("raw/rest", "rest", "network_events", "json", True, "envelopes"),
    SourceSpec("raw/uploads/csv", "uploads_csv", "network_events", "csv", True, "uploads"),
    SourceSpec("raw/uploads/json", "uploads_json", "network_events", "json", True, "uploads"),
    SourceSpec("raw/uploads/excel", "uploads_excel", "network_events", "excel", True, "uploads"),
    SourceSpec("raw/uploads/pdf", "uploads_pdf", "network_events", "pdf", True, "uploads"),
    SourceSpec("raw/csv", "events_csv", "network_events", "csv"),
)


def open_source(spark: SparkSession, spec: SourceSpec, root: str, schema: T.StructType,
                streaming: bool = True, max_files: int = MAX_FILES_PER_TRIGGER,
                multiline: bool | None = None) -> DataFrame:
    """Open one registry source. An unknown format is an error, not a warning.

    ``multiline`` overrides the spec (e.g. to read legacy landings written as
    one pretty-printed document per file)."""
    path = f"{root.rstrip('/')}/{spec.path}"
    ml = spec.multiline if multiline is None else multiline
    if spec.fmt == "json":
        return stream_json(spark, path, schema, max_files, ml) if streaming else \
            read_or_empty(spark, lambda s, p, sc: read_json(s, p, sc, ml), path, schema)
    if spec.fmt == "csv":
        return stream_csv(spark, path, schema, max_files) if streaming else \
            read_or_empty(spark, lambda s, p, sc: read_csv(s, p, sc), path, schema)
    raise ValueError(f"unsupported source format {spec.fmt!r} for {spec.category}")
