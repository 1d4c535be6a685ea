"""From effective requests to sampling jobs, each one executable or with an error code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleward.functions.compliance import granted_rows, limit_rows, wanted_rows
from sampleward.functions.text import format_table_ref, not_blank, strip
from sampleward.schemas import TABLE_KEY
from sampleward.settings import DIRECTIONS, SAMPLE_TYPES


# Stands for the row count of a table that could not be counted.
COUNT_FAILED = -(1 << 62)


def compliant_plan(requests: DataFrame, row_counts: DataFrame) -> DataFrame:
    """Cap each request by its policy at the live row count of the source table.

    A table without a row count stays in the plan as an error, the others go on.
    """
    counted = requests.join(row_counts.select(*TABLE_KEY, "row_count"), TABLE_KEY, "left")
    rows = F.col("row_count")
    usable = rows >= 0
    properties = F.col("spec")["properties"]
    return (
        counted.withColumn("sample_type", F.lower(strip(F.col("spec")["type"])))
        .withColumn("sort_by", F.when(F.col("sample_type") == "sorted", properties["by"]))
        .withColumn(
            "direction",
            F.when(F.col("sample_type") == "sorted", F.upper(strip(properties["direction"]))),
        )
        .withColumn("limit_rows", F.when(usable, limit_rows(rows, F.col("limit"))))
        .withColumn("wanted_rows", F.when(usable, wanted_rows(rows, F.col("size"))))
        .withColumn(
            "granted", F.when(usable, granted_rows(rows, F.col("limit"), F.col("size")))
        )
        .withColumn("error_code", _plan_error(rows, properties))
    )


def _plan_error(rows: Column, properties: Column) -> Column:
    sample_type = F.col("sample_type")
    return (
        F.when(rows.isNull(), "MISSING_SOURCE")
        .when(rows == COUNT_FAILED, "COUNT_FAILED")
        .when(rows < 0, "BAD_ROW_COUNT")
        .when(~F.coalesce(sample_type.isin(SAMPLE_TYPES), F.lit(False)), "BAD_SPEC_TYPE")
        .when((sample_type == "sorted") & properties.isNull(), "MISSING_SORT_PROPERTIES")
    )


def target_mapping(
    plan: DataFrame, target_project: str, target_location: str | None = None
) -> DataFrame:
    """Add source and target names: same dataset and table, in the target project and location.

    A plan may name other targets by target_dataset, target_id and target_location, of which a location that is
    null stands for the given one.
    """
    location = F.lit(target_location).cast("string")
    dataset, table = F.col("dataset_id"), F.col("table_id")
    if "target_dataset" in plan.columns:
        dataset, table = F.col("target_dataset"), F.col("target_id")
        location = F.coalesce("target_location", location)
    return (
        plan.withColumn(
            "source_table",
            format_table_ref(
                F.col("project_id"), F.col("dataset_id"), F.col("table_id"), F.col("location")
            ),
        )
        .withColumn(
            "target_table",
            format_table_ref(
                F.lit(target_project), dataset, table, location
            ),
        )
        .withColumn("crosses_location", ~F.col("location").eqNullSafe(location))
    )


def removed_sources(policies: DataFrame, catalog_tables: DataFrame) -> DataFrame:
    """Policies whose source table is gone, as error rows."""
    return policies.join(catalog_tables.select(*TABLE_KEY), TABLE_KEY, "left_anti").withColumn(
        "error_code", F.lit("MISSING_SOURCE")
    )


def validate_job(jobs: DataFrame, source_columns: DataFrame | None = None) -> DataFrame:
    """Add `job_error`, null for a job that can run.

    Needs source_table, target_table, amount, sample_type, sort_by, direction; with
    `source_columns`, also the table key, and the sort column must exist there and have an order.
    """
    by, order = strip(F.col("sort_by")), F.upper(strip(F.col("direction")))
    is_sorted = F.col("sample_type") == "sorted"
    error = (
        F.when(F.col("source_table").isNull(), "MISSING_SOURCE_REF")
        .when(F.col("target_table").isNull(), "MISSING_TARGET_REF")
        .when(F.col("amount").isNull() | (F.col("amount") < 0), "BAD_AMOUNT")
        .when(is_sorted & ~F.coalesce(not_blank(by), F.lit(False)), "BAD_COLUMN")
        .when(is_sorted & ~F.coalesce(order.isin(DIRECTIONS), F.lit(False)), "BAD_ORDER")
    )
    if source_columns is None:
        return jobs.withColumn("job_error", error)
    known = source_columns.select(
        *TABLE_KEY, F.lower("column_name").alias("__by"), F.col("orderable").alias("__orderable")
    ).dropDuplicates([*TABLE_KEY, "__by"])
    joined = jobs.withColumn("__by", F.lower(by)).join(known, [*TABLE_KEY, "__by"], "left")
    error = error.when(is_sorted & F.col("__orderable").isNull(), "UNKNOWN_COLUMN").when(
        is_sorted & ~F.col("__orderable"), "UNORDERABLE_COLUMN"
    )
    return joined.withColumn("job_error", error).drop("__by", "__orderable")


def target_collisions(jobs: DataFrame) -> DataFrame:
    """Jobs whose target another one has too get a `job_error`, whatever the case of its letters.

    Characters that no table name may hold are alike, since all become `_`.
    """
    target = F.lower(F.regexp_replace("target_table", "[^A-Za-z0-9_.@]", "_"))
    several = jobs.groupBy(target.alias("__target")).agg(F.count("*").alias("__jobs")).where("__jobs > 1")
    joined = jobs.join(several, target == F.col("__target"), "left")
    error = F.coalesce("job_error", F.when(F.col("__jobs").isNotNull(), "TARGET_COLLISION"))
    return joined.withColumn("job_error", error).drop("__target", "__jobs")


def errors_per_cycle(errors: DataFrame) -> DataFrame:
    """One row per error: its table, text, position among the table's errors, and `n_errors` of the dataset.

    Needs project_id, dataset_id, table_id, error; rows without an error are left out.
    """
    dataset = ["project_id", "dataset_id"]
    failed = errors.filter(F.col("error").isNotNull()).select(*TABLE_KEY, "error")
    sizes = failed.groupBy(*dataset).agg(F.count("*").alias("n_errors"))
    position = F.row_number().over(Window.partitionBy(*TABLE_KEY).orderBy("error"))
    same = [failed[c].eqNullSafe(sizes[c]) for c in dataset]
    joined = failed.join(sizes, same).select(failed["*"], "n_errors")
    return joined.select(*TABLE_KEY, "error", position.alias("position"), "n_errors")
