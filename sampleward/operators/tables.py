"""Sample tables in the catalog: create, label, replace, append, copy, drop."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleward.functions.text import quoted_name, valid_identifier
from sampleward.settings import KEEP_SECONDS, LEASE_PROPERTY, LEASE_SECONDS, SAMPLE_LABELS, STAGING_PART_LENGTH
from sampleward.sources.catalog import label_match, list_schemas, schema_properties, table_names, version_time

LOG = logging.getLogger(__name__)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """All columns but one, which must exist."""
    if name.lower() not in (column.lower() for column in df.columns):
        raise ValueError(f"Unknown column <{name}>")
    return df.drop(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pairs(labels: Mapping[str, str]) -> str:
    return ", ".join(f"{_quoted(key)} = {_quoted(value)}" for key, value in labels.items())


def sample_labels(
    labels: Mapping[str, str] | None, source_project: str, source_location: str | None
) -> dict[str, str]:
    """Caller's labels, then where the rows come from, then the mark of a sample table."""
    origin = {"source_project_id": source_project, "source_location": source_location or ""}
    return {**(labels or {}), **origin, **SAMPLE_LABELS}


def create_schema(
    spark: SparkSession, schema: str, root: str, labels: Mapping[str, str]
) -> None:
    """Create the schema below `root` if it is absent, then set its labels."""
    location = f"{root.rstrip('/')}/{schema}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name(schema)} LOCATION {_quoted(location)}")
    spark.sql(f"ALTER DATABASE {quoted_name(schema)} SET DBPROPERTIES ({_pairs(labels)})")


def apply_labels(spark: SparkSession, table: str, labels: Mapping[str, str]) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_pairs(labels)})")


def write_sample(
    df: DataFrame,
    schema: str,
    table: str,
    labels: Mapping[str, str],
    recreate: bool = True,
    written: Observation | None = None,
    keep_seconds: int = KEEP_SECONDS,
) -> DataFrame:
    """Write a sample as `schema.table` and return the written table.

    With `recreate` a new version of the table is written beside it, and the table then moves to it; without,
    rows are appended. `written` sees the number of `rows` written.
    """
    spark = df.sparkSession
    if written is not None:
        df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    target = quoted_name(schema, table)
    if not recreate and spark.catalog.tableExists(target):
        df.write.mode("append").saveAsTable(target)
        apply_labels(spark, target, labels)
        return spark.table(target)
    version = new_version(table)
    df.write.saveAsTable(quoted_name(schema, version))
    switch_version(spark, schema, table, version, labels, keep_seconds)
    spark.catalog.refreshTable(target)
    return spark.table(target)


def new_version(table: str) -> str:
    """Name of a table beside `table` that no other run takes, with the time it was made at."""
    return f"{table.lower()}__v{int(time.time())}_{uuid.uuid4().hex}"


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0]
    return json.loads(described)["location"]


def switch_version(
    spark: SparkSession, schema: str, table: str, version: str, labels: Mapping[str, str], keep_seconds: int
) -> None:
    """Make a version the table; the version's name then holds what the table was, for those who still read it.

    A table of the same columns, or with columns added at the end, moves by one change of its location, so that
    readers find the old or the new sample at any time. Other changes of columns take two renames. Versions made
    more than `keep_seconds` ago are dropped.
    """
    target, new = quoted_name(schema, table), quoted_name(schema, version)
    there = spark.catalog.tableExists(target)
    old_fields, new_fields = spark.table(target).schema.fields if there else [], spark.table(new).schema.fields
    if there and new_fields[: len(old_fields)] == old_fields:
        drop_versions(spark, schema, table, time.time() - keep_seconds, but=version)
        added = new_fields[len(old_fields) :]
        if added:
            spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({T.StructType(added).toDDL()})")
        old, live = table_location(spark, target), table_location(spark, new)
        spark.sql(f"ALTER TABLE {target} SET LOCATION {_quoted(live)}")
        spark.sql(f"ALTER TABLE {new} SET LOCATION {_quoted(old)}")
        apply_labels(spark, target, labels)
        return
    apply_labels(spark, new, labels)
    # A renamed table lies where its name says, and an older version may lie there still.
    drop_versions(spark, schema, table, but=version)
    if there:
        spark.sql(f"ALTER TABLE {target} RENAME TO {quoted_name(schema, new_version(table))}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {target}")


def drop_versions(
    spark: SparkSession, schema: str, table: str, before: float | None = None, but: str | None = None
) -> None:
    """Drop versions of a table, all or those made before a time.

    A version whose switch was cut short may still name the place of the live sample, which stays.
    """
    made = {name: version_time(table, name) for name in table_names(spark, schema, f"{table.lower()}__v*")}
    old = [name for name, at in made.items() if at is not None and name != but and (before is None or at < before)]
    if not old:
        return
    target = quoted_name(schema, table)
    live = table_location(spark, target) if spark.catalog.tableExists(target) else None
    for version in old:
        name = quoted_name(schema, version)
        if table_location(spark, name) == live:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(f'{live}__{uuid.uuid4().hex}')}")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def staging_schema_name(
    spark: SparkSession, prefix: str, dataset: str, table: str, location: str, run: str
) -> str:
    """Name of the schema that holds one sample on its way to another location."""
    cut = (part[:STAGING_PART_LENGTH] for part in (dataset, table, location))
    text = prefix + "_".join([*cut, run])
    return spark.range(1).select(valid_identifier(F.lit(text))).first()[0]


def cross_location_copy(
    df: DataFrame,
    staging_schema: str,
    staging_root: str,
    schema: str,
    table: str,
    labels: Mapping[str, str],
    recreate: bool = True,
    written: Observation | None = None,
    lease_seconds: int = LEASE_SECONDS,
    keep_seconds: int = KEEP_SECONDS,
) -> DataFrame:
    """Sample next to the source first, then move only the sample to the target location.

    The staging schema goes away once the copy is complete and is kept when it fails. Its lease, renewed before
    each of the two steps, tells other cycles not to sweep it.
    """
    spark = df.sparkSession
    create_schema(spark, staging_schema, staging_root, leased(labels, lease_seconds))
    staged = write_sample(df, staging_schema, table, labels)
    create_schema(spark, staging_schema, staging_root, leased(labels, lease_seconds))
    copied = write_sample(staged, schema, table, labels, recreate, written, keep_seconds)
    drop_schema_cascade(spark, staging_schema)
    return copied


def leased(labels: Mapping[str, str], seconds: int) -> dict[str, str]:
    """Labels of a schema that is in use for so many seconds from now."""
    return {**labels, LEASE_PROPERTY: str(int(time.time()) + seconds)}


def drop_schema_cascade(spark: SparkSession, schema: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {quoted_name(schema)} CASCADE")


def full_refresh_targets(
    existing: DataFrame, current: DataFrame, labels: Mapping[str, str] = SAMPLE_LABELS
) -> DataFrame:
    """Labelled sample tables that the current cycle no longer provides."""
    key = ["project_id", "dataset_id", "table_id"]
    samples = existing.filter(label_match(F.col("labels"), labels))
    return samples.join(current.select(*key), key, "left_anti")


def drop_tables(spark: SparkSession, tables: DataFrame) -> tuple[list[str], list[str]]:
    """Drop each (dataset_id, table_id) and its versions. A failure does not stop the others.

    Returns the dropped names and the error texts.
    """
    dropped, errors = [], []
    for row in tables.select("dataset_id", "table_id").toLocalIterator():
        name = f"{row.dataset_id}.{row.table_id}"
        try:
            spark.sql(f"DROP TABLE IF EXISTS {quoted_name(row.dataset_id, row.table_id)}")
            drop_versions(spark, row.dataset_id, row.table_id)
            dropped.append(name)
        except Exception as error:  # noqa: BLE001 - reported once for all tables
            errors.append(f"Could not drop {name}: {error}")
    return dropped, errors


def drop_empty_schemas(
    spark: SparkSession, prefix: str, labels: Mapping[str, str] = SAMPLE_LABELS
) -> list[str]:
    """Drop labelled schemas without tables; returns their names. Versions of tables that are gone count for nothing."""
    dropped = []
    for schema in list_schemas(spark, prefix):
        properties = schema_properties(spark, schema)
        if any(properties.get(key) != value for key, value in labels.items()):
            continue
        # Temporary views belong to the session, not to the schema.
        names = table_names(spark, schema)
        if all(version_time(None, name) is not None for name in names):
            for table in {name.rpartition("__v")[0] for name in names}:
                drop_versions(spark, schema, table)
            spark.sql(f"DROP DATABASE IF EXISTS {quoted_name(schema)} RESTRICT")
            dropped.append(schema)
    return dropped


def drop_orphan_staging(spark: SparkSession, prefix: str) -> list[str]:
    """Drop staging schemas that an earlier cycle left behind: those without a lease, or whose lease is over."""
    dropped = []
    for schema in list_schemas(spark, prefix):
        try:
            until = schema_properties(spark, schema).get(LEASE_PROPERTY)
            if until is None or int(until) <= time.time():
                drop_schema_cascade(spark, schema)
                dropped.append(schema)
        except AnalysisException as error:  # another cycle has dropped it meanwhile
            LOG.warning("Staging schema %s cannot be swept: %s", schema, error)
    return dropped


def replace_batch(df: DataFrame, schema: str, table: str, batch: str) -> None:
    """Write the records of a batch in place of those that an earlier attempt of it left."""
    spark = df.sparkSession
    name = quoted_name(schema, table)
    columns = ", ".join([df.schema.toDDL(), "batch STRING"])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (batch)")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (batch = {_quoted(batch)}) SELECT * FROM {{rows}}", rows=df)
