"""Text, name and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleward.settings import IDENTIFIER_LENGTH, JSON_SUFFIX

BLANK = r"[\s\x1c-\x1f]+"
ISO_SECONDS = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}$"


def quoted_name(*parts: str) -> str:
    """A name of several parts for SQL, whatever characters they hold."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def strip(text: Column) -> Column:
    """Drop white space, tabs and line breaks at both ends."""
    left = F.regexp_replace(text, f"(?U)^{BLANK}", "")
    return F.regexp_replace(left, f"(?U){BLANK}$", "")


def not_blank(text: Column) -> Column:
    return text.isNotNull() & (F.length(strip(text)) > 0)


def parse_table_ref(text: Column) -> Column:
    """`project.dataset.table[@location]` as a struct, null when it does not have that shape."""
    pattern = r"^([^.@]+)\.([^.@]+)\.([^.@]+)(?:@([^@]*))?$"
    parts = [strip(F.regexp_extract(text, pattern, i)) for i in range(1, 5)]
    valid = text.rlike(pattern)
    for part in parts[:3]:
        valid = valid & (F.length(part) > 0)
    location = F.when(F.length(parts[3]) > 0, parts[3])
    return F.when(
        valid,
        F.struct(
            parts[0].alias("project_id"),
            parts[1].alias("dataset_id"),
            parts[2].alias("table_id"),
            location.alias("location"),
        ),
    )


def format_table_ref(
    project: Column, dataset: Column, table: Column, location: Column | None = None
) -> Column:
    """`project.dataset.table`, with `@location` when one is given and not blank."""
    name = F.concat_ws(".", strip(project), strip(dataset), strip(table))
    if location is None:
        return name
    return F.when(not_blank(location), F.concat(name, F.lit("@"), strip(location))).otherwise(name)


def config_object_path(project: Column, dataset: Column, table: Column) -> Column:
    return F.concat(F.concat_ws("/", project, dataset, table), F.lit(JSON_SUFFIX))


def valid_identifier(text: Column) -> Column:
    """Name usable for a schema: ASCII letters, digits and `_`, in lower case."""
    cleaned = F.regexp_replace(text, "[^A-Za-z0-9_]", "_")
    return F.lower(F.substring(cleaned, 1, IDENTIFIER_LENGTH))


def with_trailing_slash(prefix: Column) -> Column:
    return F.when(prefix.endswith("/"), prefix).otherwise(F.concat(prefix, F.lit("/")))


def object_uri_parts(uri: Column) -> Column:
    """`gs://bucket/path` as (bucket, path), null for any other text."""
    pattern = r"^gs://(.*?)/(.*)"
    return F.when(
        uri.rlike(pattern),
        F.struct(
            F.regexp_extract(uri, pattern, 1).alias("bucket"),
            F.regexp_extract(uri, pattern, 2).alias("path"),
        ),
    )


def iso_to_epoch(text: Column) -> Column:
    """UTC seconds of an ISO date-time; a fraction and a final `Z` are ignored."""
    seconds = F.regexp_replace(text, r"(\.[^.]*)?Z?$", "")
    parsed = F.try_to_timestamp(F.concat(seconds, F.lit("+00:00")))
    return F.when(seconds.rlike(ISO_SECONDS), F.unix_timestamp(parsed))
