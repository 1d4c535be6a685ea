"""What the catalog knows: tables, schemas, labels, locations and row counts."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleward.functions.text import quoted_name
from sampleward.schemas import CATALOG_TABLE, LOCATION, ROW_COUNT, SOURCE_COLUMN
from sampleward.settings import LOCATION_PROPERTY
from sampleward.sources.shared import small_table

LOG = logging.getLogger(__name__)

TableKey = tuple[str, str, str]

# Catalog calls made at the same time.
METADATA_CALLS = 8
UNORDERABLE = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def scan_source(spark: SparkSession, name: str) -> DataFrame:
    """All columns of a table or view; pruning is left to the optimizer."""
    return spark.table(name)


def is_orderable(data_type: T.DataType) -> bool:
    """Whether a sample may be sorted by a column of this type."""
    return not isinstance(data_type, UNORDERABLE)


def column_paths(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Every column with its type, and the fields nested in struct columns as `a.b`."""
    for field in schema.fields:
        yield prefix + field.name, field.dataType
        if isinstance(field.dataType, T.StructType):
            yield from column_paths(field.dataType, f"{prefix}{field.name}.")


def source_schema(spark: SparkSession, tables: Mapping[TableKey, DataFrame]) -> DataFrame:
    """One row per column of each table, nested struct fields included."""
    rows = [
        (*key, name, ordinal, data_type.simpleString(), is_orderable(data_type))
        for key, df in tables.items()
        for ordinal, (name, data_type) in enumerate(column_paths(df.schema), 1)
    ]
    return small_table(spark, rows, SOURCE_COLUMN)


def row_count(spark: SparkSession, tables: Mapping[TableKey, DataFrame]) -> DataFrame:
    """Exact row count of each table: one job over all of them that reads no column."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            *(F.lit(part).alias(name) for part, name in zip(key, ROW_COUNT.fieldNames())),
            "row_count",
        )
        for key, df in tables.items()
    ]
    if not counts:
        return small_table(spark, [], ROW_COUNT)
    return reduce(DataFrame.unionAll, counts)


def resolve_location(tables: DataFrame, datasets: DataFrame) -> DataFrame:
    """Add the location of each table's dataset, null when the dataset is unknown."""
    known = datasets.select("project_id", "dataset_id", "location")
    return tables.join(known, ["project_id", "dataset_id"], "left")


def label_match(labels: Column, wanted: Mapping[str, str]) -> Column:
    """True when every wanted label is present with the wanted value."""
    matches = F.lit(True)
    for key, value in wanted.items():
        matches = matches & F.coalesce(labels[key] == F.lit(value), F.lit(False))
    return matches


def schema_properties(spark: SparkSession, schema: str, catalog: str | None = None) -> dict[str, str]:
    """Properties set on a schema, read from its description."""
    name = quoted_name(*(part for part in (catalog, schema) if part))
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {name}").collect()
    text = next((row.info_value for row in rows if row.info_name == "Properties"), "")
    inner = text.removeprefix("((").removesuffix("))")
    pairs = (pair.partition(",") for pair in inner.split("), (") if inner)
    return {key.strip(): value.strip() for key, _, value in pairs}


def table_labels(spark: SparkSession, schema: str, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted_name(schema, table)}").collect()
    return {row.key: row.value for row in rows}


def list_schemas(spark: SparkSession, prefix: str = "") -> list[str]:
    names = (database.name for database in spark.catalog.listDatabases())
    return [name for name in names if name.startswith(prefix)]


def table_names(spark: SparkSession, schema: str, pattern: str = "*") -> list[str]:
    """Permanent tables and views of a schema; the pattern knows * only."""
    rows = spark.sql(f"SHOW TABLES IN {quoted_name(schema)} LIKE '{pattern}'").collect()
    return [row.tableName for row in rows if not row.isTemporary]


def version_time(table: str | None, name: str) -> int | None:
    """When the version of a sample (of any one if `table` is None) was made; None if the name is no version's."""
    base = r".+" if table is None else re.escape(table.lower())
    match = re.fullmatch(base + r"__v(\d+)_[0-9a-f]{32}", name)
    return int(match[1]) if match else None


def list_tables(
    spark: SparkSession, project: str, schema_prefix: str = "", condition: Column | None = None
) -> DataFrame:
    """Permanent tables of the schemas with a prefix, each with its labels; versions of samples are none."""
    names = [
        (schema, name)
        for schema in list_schemas(spark, schema_prefix)
        for name in table_names(spark, schema)
        if version_time(None, name) is None
    ]

    def describe(name: tuple[str, str]) -> tuple:
        return project, *name, list(table_labels(spark, *name).items())

    with ThreadPoolExecutor(METADATA_CALLS) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(describe), names))
    found = small_table(spark, rows, CATALOG_TABLE)
    return found if condition is None else found.filter(condition)


def dataset_locations(
    spark: SparkSession, datasets: Mapping[tuple[str, str], str], catalogs: Mapping[str, str] | None = None
) -> DataFrame:
    """Location of each (project, dataset), read from a property of its schema in the project's catalog.

    A dataset that cannot be described has no location, and does not stop the others.
    """

    def locate(item: tuple[tuple[str, str], str]) -> tuple:
        key, schema = item
        try:
            found = schema_properties(spark, schema, (catalogs or {}).get(key[0]))
        except Exception as error:  # noqa: BLE001 - its tables may be readable all the same
            LOG.warning("Dataset %s has no description: %s", ".".join(key), error)
            found = {}
        return *key, found.get(LOCATION_PROPERTY)

    with ThreadPoolExecutor(METADATA_CALLS) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(locate), datasets.items()))
    return small_table(spark, rows, LOCATION)
