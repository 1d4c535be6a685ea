"""The first n rows of an order, in two phases and without gathering them in one task.

Phase 1 reads the sort column alone and finds the value at rank n, its mark: by ORDER BY ... LIMIT of that
narrow column where few values move, else by closing in on it: a bounded sample gives two values around
the mark, one counting pass tells between which of them it lies, and only that part is looked at again. Phase 2
reads whole rows: those before the mark by a pushed filter, and only from the files that hold
any where phase 1 has seen them. Rows at the mark are cut by the next sort column in the same way, or by
ORDER BY ... LIMIT where they are few. The last sort columns are a row's file and its place there, so no two rows
are alike and the same rows are found at all sizes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleward.functions.compliance import oversample_share
from sampleward.operators.ordering import (
    UNBOUNDED_LENGTH,
    VARIABLE_LENGTH,
    Mark,
    OrderKey,
    sort_columns,
)
from sampleward.settings import (
    BRACKET_ROWS,
    SCAN_TASK_ROWS,
    SINGLE_TASK_ROWS,
    SINGLE_TASK_WIDE_ROWS,
    SMALL_TABLE_ROWS,
    WRITE_TASK_ROWS,
)
from sampleward.sources.shared import stage

FILE, PLACE = "_metadata.file_path", "_metadata.row_index"
# Files named in a filter at most.
NAMED_FILES = 10_000


def has_columns(df: DataFrame, *names: str) -> bool:
    """Whether rows still carry such columns; those of their file are gone in views and derived tables."""
    try:
        return bool(df.select(*names).columns)
    except AnalysisException:
        return False


def scan_tasks(total: int) -> int:
    return math.ceil(total / SCAN_TASK_ROWS)


def fits_one_task(df: DataFrame, n: int, total: int, single_task_rows: int | None) -> bool:
    """Whether ORDER BY ... LIMIT n moves few enough rows into its last task.

    Without a bound from the caller, the bound depends on whether rows hold text or nested values.
    """
    if single_task_rows is None:
        wide = any(isinstance(f.dataType, UNBOUNDED_LENGTH) for f in df.schema.fields)
        single_task_rows = SINGLE_TASK_WIDE_ROWS if wide else SINGLE_TASK_ROWS
    return min(total, n * scan_tasks(total)) <= single_task_rows


def compact(df: DataFrame, rows: int, total: int) -> DataFrame:
    """Gather the few rows that each of many scan tasks keeps, so that no tiny files are written."""
    tasks = scan_tasks(total)
    return df.hint("rebalance") if tasks > 1 and rows < tasks * WRITE_TASK_ROWS else df


@dataclass(frozen=True)
class Nth:
    """The value at a rank: how many rows come before it and share it, and the files that hold the rows before it.

    Where exactly so many rows as the rank lie up to the mark, `before` may count all of them.
    """

    mark: Mark
    before: int
    same: int
    files: list[str] | None = None


def first_rows(
    df: DataFrame,
    keys: list[OrderKey],
    n: int,
    total: int | None = None,
    single_task_rows: int | None = None,
    bracket_rows: int = BRACKET_ROWS,
    bracket: tuple[Mark, Mark] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Exactly the first `n` rows by `keys`, in that order if asked and they are few. `total` is the row count of `df`, counted if absent.

    `bracket` may give two marks that very likely lie around the n-th row, where the distribution of the
    first key is known. Of rows without a file that agree in all keys, any are taken.
    """
    if n <= 0:
        return df.limit(0)
    if total is None:
        total = df.count()
    if n >= total:
        return df
    located, columns = has_columns(df, FILE, PLACE), sort_columns(keys)
    if located:
        keys = [*keys, OrderKey(F.col(FILE), T.StringType()), OrderKey(F.col(PLACE), T.LongType())]
    small = SMALL_TABLE_ROWS if single_task_rows is None else single_task_rows
    if total <= small and fits_one_task(df, n, total, single_task_rows):
        # A few scan tasks, for which a second job takes longer than reading whole rows. No two rows are
        # alike in the order, so these are the same rows.
        return df.orderBy(*sort_columns(keys)).limit(n)
    pieces: list[DataFrame] = []
    ties, need, size = F.lit(True), n, total
    for level, key in enumerate(keys):
        rest = df.filter(ties)
        if level and fits_one_task(df, need, size, single_task_rows):
            pieces.append(rest.orderBy(*sort_columns(keys[level:])).limit(need))
            break
        at = nth(rest, key, need, size, single_task_rows, bracket_rows, None if level else bracket, located)
        if at is None:
            # Fewer rows than `total` said: all of them are taken.
            return df
        whole = at.before + at.same == need
        wanted = rest.filter(key.until(at.mark) if whole else key.before(at.mark))
        if at.files is not None:
            wanted = wanted.filter(F.col(FILE).isin(at.files))
        pieces.append(wanted)
        if whole:
            break
        need -= at.before
        ties, size = ties & key.same(at.mark), at.same
    else:
        pieces.append(any_rows(df.filter(ties), need, size, single_task_rows))
    found = reduce(DataFrame.unionAll, pieces)
    if ordered and fits_one_task(df, n, n, single_task_rows):
        return found.orderBy(*columns).limit(n)
    return compact(found, n, total)


def nth(
    df: DataFrame,
    key: OrderKey,
    need: int,
    size: int,
    single_task_rows: int | None = None,
    bracket_rows: int = BRACKET_ROWS,
    bracket: tuple[Mark, Mark] | None = None,
    located: bool = False,
) -> Nth | None:
    """The value at rank `need` of about `size` rows; None if there are fewer rows."""
    bound = SINGLE_TASK_ROWS if single_task_rows is None else single_task_rows
    low = high = None
    before, draw, wider = 0, 0, 1
    if bracket is not None and need <= bound:
        # Few rows come before the upper mark, so their keys can be put in order at once.
        if found := _nth_of_few(df, df.filter(key.until(bracket[1])), key, need, 0, located):
            return found
        bracket = None
    while min(size, (need - before) * scan_tasks(size)) > bound:
        inside = df.filter(_inside(key, low, high))
        drawn = min(bracket_rows, max(1000, size // 20)) * wider
        marks = bracket or _bracket(inside, key, need - before, size, drawn, seed=draw)
        bracket, draw, size_before = None, draw + 1, size
        for part, rows in _counted(inside, key, _split(low, high, *marks)):
            if need - before > rows:
                before += rows
                continue
            if part.tie is not None:
                return Nth(part.tie, before, rows)
            low, high, size = part.low, part.high, rows
            # A bracket that leaves nearly everything inside is drawn anew, with twice the values.
            wider = 1 if size < 0.9 * size_before else 2 * wider
            break
        else:
            return None
    return _nth_of_few(df, df.filter(_inside(key, low, high)), key, need, before, located and low is None)


def first_keys(df: DataFrame, key: OrderKey, need: int, located: bool) -> DataFrame:
    """(kind, text, file, rank) of the first rows, of which nothing but the sort column is read."""
    file = F.col(FILE) if located else F.lit(None).cast("string")
    narrow = df.select(key.column.alias("value"), file.alias("file"))
    value = OrderKey(F.col("value"), key.data_type, key.ascending)
    order = value.sort_columns()
    kind, text = value.mark_columns()
    # The limit has put these rows into one task already.
    rank = F.row_number().over(Window.orderBy(*order))
    return narrow.orderBy(*order).limit(need).select(
        kind.alias("kind"), text.alias("text"), "file", rank.alias("rank")
    )


def _nth_of_few(
    df: DataFrame, inside: DataFrame, key: OrderKey, need: int, before: int, located: bool
) -> Nth | None:
    """The value at rank `need` of df, which lies among the first of `inside`, where `before` rows are passed."""
    rank = need - before
    located = located and need <= NAMED_FILES
    top = first_keys(inside, key, rank + 1, located)
    mark = F.struct("kind", "text")
    at, after, files = top.agg(
        F.max(F.when(F.col("rank") == rank, mark)),
        F.max(F.when(F.col("rank") == rank + 1, mark)),
        F.collect_set(F.when(F.col("rank") <= rank, F.col("file"))),
    ).first()
    if at is None:
        return None
    files = files if located else None
    found = Mark(at["kind"], at["text"])
    if after is not None and after != at:
        # All rows that share the mark are among the first, so rank `need` ends with them.
        return Nth(found, need, 0, files)
    before, same = df.filter(key.until(found)).agg(
        F.count(F.when(key.before(found), 1)), F.count(F.when(key.same(found), 1))
    ).first()
    return Nth(found, before, same, files)


def _bracket(
    df: DataFrame, key: OrderKey, need: int, size: int, bracket_rows: int, seed: int
) -> tuple[Mark | None, Mark | None]:
    """Two values that very likely enclose the value at rank `need`, from a bounded sample."""
    wanted = bracket_rows
    if isinstance(key.data_type, VARIABLE_LENGTH):
        wanted = max(wanted // 10, 100)
    share = min(1.0, wanted / size)
    center = need * share
    # With all values drawn, the one at the rank itself is known.
    spread = 4.0 * math.sqrt(center * (1.0 - need / size)) + 8.0 if share < 1.0 else 0.0
    low_rank, high_rank = math.floor(center - spread), math.ceil(center + spread)
    values = df.select(key.column.alias("value")).sample(share, seed)
    drawn = OrderKey(F.col("value"), key.data_type, key.ascending)
    kind, text = drawn.mark_columns()
    # The window sees `wanted` values of one column at most.
    rank = F.row_number().over(Window.orderBy(*drawn.sort_columns()))
    found = (
        values.select(rank.alias("rank"), kind.alias("kind"), text.alias("text"))
        .filter(F.col("rank").isin(low_rank, high_rank))
        .collect()
    )
    marks = {row["rank"]: Mark(row["kind"], row["text"]) for row in found}
    return marks.get(low_rank), marks.get(high_rank)


@dataclass(frozen=True)
class Part:
    """Rows strictly between two marks, or rows that share one."""

    low: Mark | None = None
    high: Mark | None = None
    tie: Mark | None = None

    def condition(self, key: OrderKey) -> Column:
        return key.same(self.tie) if self.tie else _inside(key, self.low, self.high)


def _inside(key: OrderKey, low: Mark | None, high: Mark | None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & key.after(low)
    if high is not None:
        inside = inside & key.before(high)
    return inside


def _split(low: Mark | None, high: Mark | None, *marks: Mark | None) -> list[Part]:
    """Parts of the rows between `low` and `high`, cut at the marks, in sort order."""
    parts = []
    for mark in dict.fromkeys(mark for mark in marks if mark is not None):
        parts += [Part(low, mark), Part(tie=mark)]
        low = mark
    return [*parts, Part(low, high)]


def _counted(df: DataFrame, key: OrderKey, parts: list[Part]) -> list[tuple[Part, int]]:
    counts = df.agg(
        *(F.count(F.when(part.condition(key), 1)).alias(f"c{i}") for i, part in enumerate(parts))
    ).first()
    return list(zip(parts, counts))


def any_rows(
    df: DataFrame, n: int, total: int, single_task_rows: int | None = None, seed: int = 0
) -> DataFrame:
    """`n` rows, no matter which: LIMIT n that stays spread over many tasks when n is large."""
    if fits_one_task(df, n, total, single_task_rows):
        return df.limit(n)
    share = oversample_share(n, total)
    while True:
        drawn = df if share >= 1.0 else df.sample(share, seed)
        staged = stage(compact(drawn, n, total))
        rows = staged.count()
        if rows >= n or share >= 1.0:
            break
        share = min(1.0, 4.0 * share)
    if rows <= n:
        return staged
    # Each staged file gives its first rows until n are reached; the window has one row per file.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = staged.groupBy(F.col("_metadata.file_path").alias("file")).count()
    quotas = files.select(
        "file", (F.lit(n) - F.coalesce(F.sum("count").over(earlier), F.lit(0))).alias("quota")
    )
    located = staged.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    return located.join(
        quotas, (F.col("__file") == F.col("file")) & (F.col("__row") < F.col("quota")), "left_semi"
    ).drop("__file", "__row")
