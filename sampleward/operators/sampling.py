"""Samples of one table. Each takes (table, n, ...) and gives a table of the same columns.

`total` is the table's row count; where it is absent it is counted first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleward.functions.compliance import block_percent_of, oversample_share
from sampleward.operators.first_rows import FILE, PLACE, compact, first_rows, has_columns
from sampleward.operators.ordering import Mark, OrderKey, sample_order, tie_breakers
from sampleward.sources.shared import stage

KEY = "__sample_key"


def zero_sample(df: DataFrame) -> DataFrame:
    """No rows, all columns."""
    return df.limit(0)


def sorted_sample(
    df: DataFrame,
    n: int,
    by: str,
    direction: str,
    total: int | None = None,
    single_task_rows: int | None = None,
) -> DataFrame:
    """First `n` rows by one column, ties broken by all other orderable columns."""
    return first_rows(df, sample_order(df, by, direction), n, total, single_task_rows, ordered=True)


def random_sample(
    df: DataFrame,
    n: int,
    seed: int,
    total: int | None = None,
    single_task_rows: int | None = None,
) -> DataFrame:
    """Exactly `n` rows, each row with the same chance: those whose places have the least hashes.

    Hashes need no column, and the rows of a seed are the same at all sizes and in every run over the
    same files. Relations whose rows have no place are drawn once instead.
    """
    if n <= 0:
        return zero_sample(df)
    if total is None:
        total = df.count()
    if n >= total:
        return df
    if not has_columns(df, FILE, PLACE):
        return _drawn_sample(df, n, seed, total, single_task_rows)
    key = OrderKey(F.xxhash64(F.lit(seed), F.col(FILE), F.col(PLACE)), T.LongType())
    marks = (Mark("value", str(min(max(int((q - 0.5) * 2**64), -(2**63)), 2**63 - 1))) for q in _around(n, total))
    return first_rows(df, [key], n, total, single_task_rows, bracket=tuple(marks))


def random_sample_scaled(
    df: DataFrame,
    n: int,
    seed: int,
    total: int | None = None,
    single_task_rows: int | None = None,
) -> DataFrame:
    """Exactly `n` random rows for a large n: the same rows, which need not be written before they are taken."""
    return random_sample(df, n, seed, total, single_task_rows)


def _around(n: int, total: int) -> tuple[float, float]:
    """Shares of a uniform key's range between which its n-th of `total` values lies but for a negligible chance."""
    spread = 6.0 * math.sqrt(n) + 8.0
    return max(0.0, (n - spread) / total), min(1.0, (n + spread) / total)


def _drawn_sample(
    df: DataFrame, n: int, seed: int, total: int, single_task_rows: int | None
) -> DataFrame:
    """Slightly more than `n` rows are drawn and written with their random number, then cut to `n`.

    The cut sees fixed values even after an executor is lost. A draw that falls short is repeated with a
    larger share.
    """
    share = oversample_share(n, total)
    while True:
        drawn = df.withColumn(KEY, F.rand(seed))
        kept = drawn if share >= 1.0 else drawn.filter(F.col(KEY) < share)
        staged = stage(compact(kept, n, total))
        rows = staged.count()
        if rows >= n or share >= 1.0:
            break
        share = min(1.0, 4.0 * share)
    if rows <= n:
        return staged.drop(KEY)
    keys = [OrderKey(F.col(KEY), T.DoubleType())]
    marks = tuple(Mark("value", repr(share * q)) for q in _around(n, rows))
    return first_rows(staged, keys, n, rows, single_task_rows, bracket=marks).drop(KEY)


def _unmixed(column: Column) -> Column:
    """A value as text that no other value, nor null, shares, also beside other values and colons."""
    text = F.replace(F.replace(column.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:"))
    return F.coalesce(text, F.lit("\\null"))


def hash_sample(
    df: DataFrame,
    n: int,
    key: list[str],
    seed: int,
    total: int | None = None,
    single_task_rows: int | None = None,
) -> DataFrame:
    """`n` rows that look random but are the same in every run: ordered by a hash of the key, of which alone phase 1 reads."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(_unmixed(F.col(k)) for k in key)))
    used = {name.lower() for name in key}
    fields = {field.name.lower(): field.dataType for field in df.schema.fields}
    keys = [
        OrderKey(digest, T.StringType()),
        *(OrderKey(F.col(name), fields[name.lower()]) for name in key),
        *tie_breakers(df, used),
    ]
    if total is None:
        total = df.count()
    if n <= 0 or n >= total:
        return first_rows(df, keys, n, total)
    # Keys of many rows may put the n-th hash anywhere; the marks are only where it lies if they do not.
    marks = tuple(Mark("value", f"{min(int(q * 2**64), 2**64 - 1):016x}") for q in _around(n, total))
    return first_rows(df, keys, n, total, single_task_rows, bracket=marks)


def block_sample(
    df: DataFrame,
    n: int,
    seed: int,
    total: int | None = None,
    single_task_rows: int | None = None,
) -> DataFrame:
    """At most `n` rows from a random percentage of the table, taken file by file.

    Files are put in the order of a hash; the first ones that hold the percentage of all rows are
    chosen, at least one. Others are skipped at planning. A relation without files is sampled by row.
    """
    if total is None:
        total = df.count()
    percent = block_percent_of(total, n)
    if n <= 0 or percent == 0:
        return zero_sample(df)
    if not has_columns(df, FILE):
        return random_sample(df, n, seed, total, single_task_rows)
    order = F.xxhash64(F.lit(seed), F.col(FILE))
    # One row per file, counted without reading a column.
    files = df.groupBy(order.alias("hash")).count()
    before = Window.orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    held = files.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    chosen = held.filter(F.col("before") < F.lit(total * percent / 100.0))
    last, rows = chosen.agg(F.max("hash"), F.sum("count")).first()
    if last is None:
        return zero_sample(df)
    return random_sample(df.filter(order <= last), n, seed, rows, single_task_rows)
