"""File and identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siglake.schemas import CONTENT_TYPES, FILE_EXTENSIONS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def source_slug(source) -> Column:
    """Lower-case, spaces to underscores."""
    return F.regexp_replace(F.lower(_c(source).cast("string")), " ", "_")


def file_extension(filename) -> Column:
    """Lower-cased ``.ext`` after the last dot; NULL when there is no dot."""
    name = _c(filename)
    ext = F.regexp_extract(name, r"\.([^.]*)$", 1)
    return F.when(name.contains("."), F.concat(F.lit("."), F.lower(ext)))


def file_type_of(filename) -> Column:
    """Csv / json / excel / pdf, NULL for an unsupported or missing extension."""
    m = F.create_map(*[F.lit(x) for kv in FILE_EXTENSIONS.items() for x in kv])
    return F.try_element_at(m, file_extension(filename))


def content_type_of(file_type) -> Column:
    m = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(file_type)), F.lit("application/octet-stream"))


def sha256_hex(content) -> Column:
    """C17: SHA-256 hex digest of binary or string content."""
    return F.sha2(_c(content), 256)


# Fixed value: landing object key layout raw/{category}/{YYYY}/{MM}/{DD}/{stamp}_{uuid8}_{name}
OBJECT_KEY_PATTERN = r"raw/(.+)/(\d{4})/(\d{2})/(\d{2})/(\d{8}_\d{6}_\d{6})_([0-9a-f]{8})_(.+)$"


def object_key_parts(path) -> dict[str, Column]:
    """Category, date, stamp, uuid and name parsed back from an object path."""
    p = _c(path)

    def g(i):
        return F.nullif(F.regexp_extract(p, OBJECT_KEY_PATTERN, i), F.lit(""))

    return {
        "key_category": g(1),
        "key_date": F.concat_ws("-", g(2), g(3), g(4)),
        "key_stamp": g(5),
        "key_uuid": g(6),
        "key_name": g(7),
    }


def health_score(packet_loss_pct, latency_ms) -> Column:
    """max(0, min(100, int(100 - loss*15 - latency/5))), truncating toward zero."""
    raw = F.lit(100.0) - _c(packet_loss_pct) * F.lit(15) - _c(latency_ms) / F.lit(5)
    return F.greatest(F.lit(0), F.least(F.lit(100), raw.try_cast("int")))
