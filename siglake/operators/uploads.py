"""Uploaded-file inspection and ingestion.

Every figure comes from one scan of ``binaryFile``: size and hash, and the records of a
file as an array cut from its text, the first of a CSV file being its header. So header
and rows need no join, files of any number of headers share one plan, and a record's
place is its place in the array: nothing is shuffled. A file is a row here, as its hash
needs it to be (Spark's limit is 2 GB), and its records are an array in one task; Spark's
multi-line CSV reader gives a file to one task as well. A file that does not parse is
reported with a reason and gives no records; it never fails the job. Workbooks and PDFs
are typed, sized and hashed, not read. ``binaryFile`` gives no row for a 0-byte file.

CSV: a cell that starts with a quote runs to its closing quote, line breaks and commas
included, a doubled quote being one; a quote elsewhere is a character; one that never
closes takes the rest of the file. Empty lines are no records, and nothing before the first
visible character is; cells beyond the header are dropped, missing ones are NULL; CR LF counts as LF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.functions.files import content_type_of, file_type_of, sha256_hex
from siglake.operators.normalize import upload_events

UPLOAD_TOPIC = "network-events"
# Tokens read as missing in uploaded CSV cells (the default NA
# strings of the pandas CSV reader the platform parsed uploads with).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# possessive throughout, so a long text is matched in a loop, without backtracking
_CELL = r'(?:"(?:[^"]++|"")*+(?:"|\z)[^,\n]*+|[^,\n]*+)'
_RECORD = f"{_CELL}(?:,{_CELL})*+"
_QUOTED = r'^"(?:[^"]++|"")*+"\z'


def _path(col) -> F.Column:
    """File readers write a local path as ``file:/x`` or ``file:///x``; paths of other stores keep bucket and host."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"^file:/+", "file:/")


def unique_names(names: Column) -> Column:
    """Column names made distinct: a repeat gets the first free ``.1``, ``.2`` ...; case does not tell them apart."""
    low = F.transform(names, F.lower)

    def name(n, i):
        before = F.size(F.filter(F.slice(low, 1, i), lambda x: x == F.lower(n)))
        free = F.filter(F.sequence(F.lit(1), 2 * F.size(names)),
                        lambda k: ~F.array_contains(low, F.concat(F.lower(n), F.lit("."), k.cast("string"))))
        return F.when(before == 0, n).otherwise(F.concat(n, F.lit("."), F.get(free, before - 1).cast("string")))
    return F.transform(names, name)


def csv_lines(text: Column) -> Column:
    """The records of a CSV text as text, header first."""
    plain = F.replace(F.regexp_replace(text, "^\ufeff", ""), F.lit("\r\n"), F.lit("\n"))
    headed = F.regexp_replace(plain, r"^\s*(?:\n|\z)", "")
    return F.filter(F.regexp_extract_all(headed, F.lit(_RECORD), F.lit(0)), lambda r: r != "")


def csv_cells(record: Column) -> Column:
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({_CELL})"), F.lit(1))
    return F.transform(raw, lambda c: F.when(
        c.rlike(_QUOTED), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def csv_object(names: Column, record: Column) -> Column:
    """A record as a JSON object under its file's header; cells read as missing are NULL."""
    cells = F.slice(csv_cells(record), F.lit(1), F.size(names))
    values = F.zip_with(names, cells, lambda n, c: F.when(~c.isin(*NA_TOKENS), c))
    return F.to_json(F.map_from_arrays(names, values), {"ignoreNullFields": "false"})


def _json(text: F.Column) -> tuple[F.Column, F.Column]:
    """(structure, records) of a JSON text: its elements, itself, or NULL."""
    array, obj = text.rlike(r"^\s*\["), text.rlike(r"^\s*\{")
    n, keys = F.json_array_length(text), F.json_object_keys(text)
    structure = F.when(array & n.isNotNull(), "array").when(obj & keys.isNotNull(), "object")
    elements = F.from_json(text, T.ArrayType(T.StringType()))
    return structure, F.when(structure == "array", elements).when(structure == "object", F.array(text))


class Uploads:
    """The files of one upload batch (a static ``binaryFile`` frame): metadata, records, events, history."""

    def __init__(self, files: DataFrame):
        named = files.withColumn("path", _path("path"))
        self.files = named.withColumn("filename", F.element_at(F.split("path", "/"), -1))

    def _parsed(self) -> DataFrame:
        """One row per file: facts of its bytes, ``names`` and ``lines`` of CSV, ``text`` of JSON."""
        kind, text = file_type_of("filename"), F.col("content").cast("string")
        typed = self.files.select(
            "path", "filename", kind.alias("file_type"), "length", "modificationTime", sha256_hex("content").alias("sha256_hash"),
            F.when(kind == "csv", csv_lines(text)).alias("lines"), F.when(kind == "json", text).alias("text"))
        heads = F.transform(csv_cells(F.get("lines", F.lit(0))), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
        typed = typed.withColumn("heads", F.transform(heads, lambda c: F.when(c == "", "column").otherwise(c)))
        return typed.withColumn("names", unique_names(F.col("heads"))).drop("heads")

    def records(self, keep: list[str] | None = None) -> DataFrame:
        """(path, row_idx, record) of every parsed file, the record as JSON text; ``keep``: facts of its file."""
        items = F.when(F.col("file_type") == "csv", F.filter("lines", lambda r, i: i > 0)).otherwise(_json(F.col("text"))[1])
        rows = self._parsed().select("path", *(keep or []), "names", F.posexplode(items).alias("row_idx", "item"))
        record = F.when(F.col("names").isNotNull(), csv_object(F.col("names"), F.col("item"))).otherwise(F.col("item"))
        return rows.select("path", *(keep or []), F.col("row_idx").cast("bigint").alias("row_idx"), record.alias("record"))

    def metadata(self) -> DataFrame:
        """E12 + D4: one row per file: type, size, hash, row count, columns or JSON structure, status, reason."""
        text = F.col("text")
        structure, _ = _json(text)
        count = (F.when(F.col("lines").isNotNull(), F.greatest(F.size("lines") - 1, F.lit(0)))
                 .when(F.col("structure") == "array", F.json_array_length(text)).when(F.col("structure") == "object", 1))
        out = self._parsed().withColumn("structure", structure).select(
            "path", "filename", "file_type", content_type_of(F.col("file_type")).alias("content_type"),
            F.col("length").alias("file_size_bytes"), "sha256_hash", F.col("modificationTime").alias("uploaded_at"),
            "structure", F.when(F.col("structure") == "object", F.json_object_keys(text)).alias("json_keys"),
            count.cast("bigint").alias("row_count"), F.col("names").alias("columns"))
        reason = (F.when(F.col("file_size_bytes") == 0, "empty file")
                  .when(F.col("file_type").isNull(), "unsupported extension")
                  .when((F.col("file_type") == "json") & F.col("structure").isNull(), "invalid JSON")
                  .when((F.col("file_type") == "csv") & F.col("columns").isNull(), "no CSV header"))
        parsed = F.col("file_type").isin("csv", "json")
        return out.withColumns({
            "row_count": F.when(parsed, F.coalesce("row_count", F.lit(0).cast("bigint"))),
            "reason": reason, "status": F.when(reason.isNull(), "ACCEPTED").otherwise("REJECTED")})

    def events(self, cap: int | None = None) -> DataFrame:
        """C14: an upload event for every record (D5: the first ``cap`` of each file, if a cap is given)."""
        recs = self.records(["filename", "file_type", "sha256_hash", "modificationTime"])
        if cap is not None:
            recs = recs.where(F.col("row_idx") < cap)
        out = upload_events(recs, F.col("file_type"), F.col("sha256_hash"), F.col("modificationTime").cast("string"),
                            F.col("filename"), F.col("row_idx"), ["record"], path=F.col("path"))
        return out.withColumn("payload", F.get_json_object("payload", "$.record"))

    def history(self, topic: str = UPLOAD_TOPIC, metadata: DataFrame | None = None) -> DataFrame:
        """One history row per file, from its ``metadata`` row. ``id`` is the digest of the path (the
        platform used a database sequence, which a distributed writer cannot share)."""
        m = self.metadata() if metadata is None else metadata
        ok = F.col("status") == "ACCEPTED"
        return m.select(
            F.sha2("path", 256).alias("id"), "filename",
            F.coalesce("file_type", F.lit("unsupported")).alias("file_type"), "file_size_bytes",
            F.col("path").alias("minio_path"),
            F.when(ok & (F.coalesce("row_count", F.lit(0)) > 0), F.lit(topic)).alias("kafka_topic"),
            F.coalesce("row_count", F.lit(0)).cast("long").alias("records_count"),
            F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
            F.col("reason").alias("error_message"),
            F.to_json(F.struct("sha256_hash", "structure", "json_keys", "columns", "content_type")).alias("metadata_json"),
            F.col("uploaded_at").cast("timestamp_ntz").alias("created_at"))
