"""Column expressions. Each returns a ``pyspark.sql.Column`` built only from
built-in functions, so everything stays inside whole-stage codegen."""

from siglake.functions.common import first_truthy, truthy
from siglake.functions.files import (content_type_of, file_type_of, health_score,
                                     object_key_parts, sha256_hex, source_slug)
from siglake.functions.payload import bind_payload_fields, payload_field
from siglake.functions.routing import category_route
from siglake.functions.severity import connector_severity, lake_severity
from siglake.functions.timeparse import (event_date, hour_bucket, parse_event_time,
                                         resolve_event_time, wall_clock)

__all__ = [
    "truthy", "first_truthy", "lake_severity", "connector_severity",
    "parse_event_time", "resolve_event_time", "event_date", "hour_bucket", "wall_clock",
    "payload_field", "bind_payload_fields", "category_route",
    "file_type_of", "content_type_of", "sha256_hex", "source_slug", "object_key_parts",
    "health_score",
]
