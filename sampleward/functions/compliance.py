"""Merge rules and row arithmetic. All percentages are computed in double, in a fixed order."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleward.settings import DEFAULT_SAMPLE_TYPE, FALLBACK_COUNT


def is_empty(struct: Column, fields: list[str]) -> Column:
    """True when the struct is null or each of its fields is."""
    return reduce(lambda a, b: a & b, (struct.getField(name).isNull() for name in fields))


def first_given(fields: list[str], *structs: Column) -> Column:
    """The first struct that is not empty, taken as a whole."""
    return F.coalesce(*(F.when(~is_empty(struct, fields), struct) for struct in structs))


SIZE_FIELDS = ["count", "percentage"]
SPEC_FIELDS = ["type", "properties"]


def fallback_size() -> Column:
    return F.struct(
        F.lit(FALLBACK_COUNT).cast("bigint").alias("count"),
        F.lit(None).cast("double").alias("percentage"),
    )


def fallback_spec() -> Column:
    return F.struct(
        F.lit(DEFAULT_SAMPLE_TYPE).alias("type"),
        F.lit(None).cast("struct<by:string,direction:string>").alias("properties"),
    )


def limit_rows(row_count: Column, limit: Column) -> Column:
    """Most rows that the policy allows."""
    share = F.floor(row_count.cast("double") * limit["percentage"] / F.lit(100.0))
    count = F.coalesce(limit["count"], row_count)
    return F.when(limit["percentage"].isNull(), count).otherwise(F.least(share, count))


def wanted_rows(row_count: Column, size: Column) -> Column:
    """Rows asked for: the larger of the count and the percentage."""
    share = F.ceil(row_count.cast("double") * size["percentage"] / F.lit(100.0))
    count = F.coalesce(size["count"], F.lit(0).cast("bigint"))
    return F.when(size["percentage"].isNull(), count).otherwise(F.greatest(share, count))


def granted_rows(row_count: Column, limit: Column, size: Column) -> Column:
    return F.least(limit_rows(row_count, limit), wanted_rows(row_count, size))


def block_percent(row_count: Column, amount: Column) -> Column:
    """Whole percent of a table to read for `amount` rows: 0 for no rows, else 1 to 100."""
    whole = F.ceil(amount.cast("double") / F.nullif(row_count, F.lit(0)) * F.lit(100.0))
    return F.when(row_count == 0, F.lit(0).cast("bigint")).otherwise(
        F.least(F.lit(100).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), whole))
    )


def block_percent_of(row_count: int, amount: int) -> int:
    """The same for one table whose count is already known on the driver."""
    return 0 if row_count == 0 else min(100, max(1, math.ceil(amount / row_count * 100.0)))


def oversample_share(amount: int, row_count: int) -> float:
    """Share of rows to keep so that at least `amount` of them stay, but for a chance below 1e-12."""
    if row_count <= 0:
        return 1.0
    return min(1.0, (amount + 10.0 * math.sqrt(amount) + 64.0) / row_count)
