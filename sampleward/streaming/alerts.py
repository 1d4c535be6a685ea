"""Alerts on errors and on missed cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALERT_WINDOW = "1 hour"


def error_alert(
    events: DataFrame, ts: str, is_error: Column, window: str = ALERT_WINDOW, delay: str = "1 hour"
) -> DataFrame:
    """At most one alert per window: each window with errors, how many, and the first of them."""
    errors = events.filter(is_error)
    if events.isStreaming:
        errors = errors.withWatermark(ts, delay)
    return (
        errors.groupBy(F.window(ts, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_errors"), F.min(ts).alias("first_error"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n_errors",
            "first_error",
        )
    )


def missed_cycle_alert(
    runs: DataFrame,
    ts: str,
    by: list[str],
    first_day: Column | None = None,
    last_day: Column | None = None,
) -> DataFrame:
    """Days without a run for each `by`, between the first and last day of all runs.

    One aggregate per key gives its days, no more than the calendar has; the rest of the calendar is missed.
    """
    day = F.to_date(ts)
    seen = runs.groupBy(*by).agg(F.collect_set(day).alias("__seen"))
    bounds = runs.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()
    low = bounds["lo"] if first_day is None else first_day
    high = bounds["hi"] if last_day is None else last_day
    missed = F.array_except(F.sequence(low, high), F.col("__seen"))
    return seen.select(*by, F.explode(missed).alias("day"))
