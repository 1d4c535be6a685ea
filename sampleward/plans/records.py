"""Records a cycle leaves behind: the run log and the dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleward.settings import ERROR_TEXT


def run_log(
    jobs: DataFrame, inserted: DataFrame, cycle_ts: int | Column, start: Column, end: Column
) -> DataFrame:
    """One SAMPLE_DONE record per job.

    `jobs` has source_table, target_table, sample_type, granted, error_code; `inserted` has
    source_table, target_table if tables have several, and `row_count`, the rows now in the sample. A failed
    job has no amount.
    """
    keys = [name for name in ("source_table", "target_table") if name in inserted.columns]
    counts = inserted.select(*keys, F.col("row_count").alias("__inserted"))
    stamp = F.lit(cycle_ts) if isinstance(cycle_ts, int) else cycle_ts
    failed = F.col("error_code").isNotNull()
    return jobs.join(counts, keys, "left").select(
        stamp.cast("bigint").alias("cycle_ts"),
        "source_table",
        "target_table",
        "sample_type",
        F.col("granted").alias("requested"),
        start.cast("bigint").alias("start_timestamp"),
        end.cast("bigint").alias("end_timestamp"),
        F.coalesce("error_code", F.lit("")).alias("error_message"),
        F.when(~failed, F.coalesce("__inserted", F.lit(0).cast("bigint"))).alias(
            "amount_inserted"
        ),
    )


def dead_letter(
    failed: DataFrame, fields: list[str], error: str = "error", others: list[str] = ()
) -> DataFrame:
    """Each failed command as a JSON object with all its fields, nulls included, and its error; then other columns."""
    command = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return failed.filter(F.col(error).isNotNull()).select(
        command.alias("command"),
        F.col(error).alias("error"),
        F.format_string(ERROR_TEXT, F.col(error)).alias("message"),
        *others,
    )
