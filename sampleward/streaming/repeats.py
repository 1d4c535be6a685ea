"""Repeated deliveries in a table: the same rule as on a stream, without gathering a key in one task.

A row is a repeat if it lies within the delay of the delivery of its key that was kept before it. Which
rows are kept thus depends on all earlier ones. Most keys were delivered once or over no longer than the
delay, so their first delivery is all that is kept, which an aggregate tells. The times of the others, and nothing
else of their rows, are dealt into ranges of (key, time) of a bounded number, however often a key occurs. A range
tells for every kept delivery that it may begin with, which one it ends with: a short step function, as chains
of kept rows soon meet. These functions are chained over the ranges, a row each, and then each range is gone
through again from the delivery it really begins with. Whole rows are found by key and time.

Of rows with one key and time, the least by the other columns is kept, those without an order being compared as
JSON. Rows without a time are no repeats of others: one is kept for each key. Null keys are a key. Columns may have any
type, keys any that can be grouped by.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sampleward.sources.catalog import is_orderable
from sampleward.sources.shared import stage

# Times in a range at most, or about that.
RANGE_ROWS = 1_000_000
BATCH_ROWS = 10_000
NEVER = -(1 << 62)

# The functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _map_rows(df: DataFrame, function: Callable, fields: list[T.StructField]) -> DataFrame:
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(waiting: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*waiting), arrow)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        waiting: list[tuple] = []
        for row in function(rows(batches)):
            waiting.append(row)
            if len(waiting) == BATCH_ROWS:
                yield batch(waiting)
                waiting = []
        if waiting:
            yield batch(waiting)

    return df.mapInArrow(run, schema)


def step_function(times: list[int], delay: int) -> tuple[list[int], list[int]]:
    """(bounds, ends): a range entered with `kept` ends with ends[i], i the first bound > kept + delay.

    Without such a bound it keeps nothing. `times` are ascending and distinct, and all after `kept`.
    """
    at = np.array(times, dtype=np.int64)
    following = np.searchsorted(at, at + delay, side="right").tolist()
    last = list(times)
    for i in range(len(times) - 1, -1, -1):
        if following[i] < len(times):
            last[i] = last[following[i]]
    # What was kept before reaches no further than a delay beyond the first time.
    reach = min(len(times), bisect_right(times, times[0] + delay) + 1)
    bounds, ends = [], []
    for i in range(reach):
        if ends and ends[-1] == last[i]:
            bounds[-1] = times[i]
        else:
            bounds.append(times[i])
            ends.append(last[i])
    return bounds, ends


def _kept_times(times: list[int], kept: int, delay: int) -> Iterator[int]:
    i = bisect_right(times, kept + delay)
    while i < len(times):
        yield times[i]
        i = bisect_right(times, times[i] + delay, i + 1)


def _identity(row: tuple) -> str:
    return repr(row[1])


def _parts(rows: Iterator[tuple]) -> Iterator[tuple[int, Iterator[tuple[dict, list[int]]]]]:
    """(range, its keys and their times) of rows (range, key, time) in order."""

    def keys(part: Iterator[tuple]) -> Iterator[tuple[dict, list[int]]]:
        for _, of_key in groupby(part, key=_identity):
            of_key = list(of_key)
            yield of_key[0][1], [row[2] for row in of_key]

    for number, part in groupby(rows, key=itemgetter(0)):
        yield number, keys(part)


def chained(times: DataFrame, total: int, delay: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(__key, __at) of the kept deliveries among the distinct ones `times`."""
    key, at = times.schema["__key"], times.schema["__at"]
    # Two ranges a row each: the first key's step function, and what the last key ends with.
    part = T.StructField("__part", T.IntegerType())
    entry = T.StructField("__entered", T.LongType())
    summary = [
        part, key, T.StructField("__bounds", T.ArrayType(T.LongType())), T.StructField("__ends", T.ArrayType(T.LongType())),
        T.StructField("__last_key", key.dataType), T.StructField("__last", T.LongType()),
    ]

    def summaries(rows: Iterator[tuple]) -> Iterator[tuple]:
        for number, keys in _parts(rows):
            first, own = next(keys)
            bounds, ends = step_function(own, delay)
            last, kept = None, None
            for last, own in keys:  # each but the last ends within the range
                kept = None
                for kept in _kept_times(own, NEVER, delay):
                    pass
            yield number, first, bounds, ends, last, kept

    def chain(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, kept = None, NEVER
        for number, first, bounds, ends, last, last_kept in rows:
            entered = kept if held == repr(first) else NEVER
            yield number, entered
            if last_kept is not None:
                held, kept = repr(last), last_kept
            else:
                i = bisect_right(bounds, entered + delay)
                held, kept = repr(first), ends[i] if i < len(ends) else entered

    def keep(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, part_rows in groupby(rows, key=itemgetter(0)):
            entered = None
            for _, of_key in groupby(part_rows, key=_identity):
                of_key = list(of_key)
                kept = of_key[0][3] if entered is None else NEVER
                entered = kept
                for time in _kept_times([row[2] for row in of_key], kept, delay):
                    yield of_key[0][1], time

    ranges = max(1, math.ceil(total / range_rows))
    if ranges == 1:
        ordered = times.select(F.lit(0).alias("__part"), "__key", "__at", F.lit(NEVER).alias("__entered"))
        return _map_rows(ordered.repartition(1).sortWithinPartitions("__key", "__at"), keep, [key, at])
    dealt = times.repartitionByRange(ranges, "__key", "__at").withColumn("__part", F.spark_partition_id())
    # Written, so that both passes see the same ranges.
    dealt = stage(dealt.select("__part", "__key", "__at"), "ranges").repartition(ranges, "__part")
    steps = _map_rows(dealt.sortWithinPartitions("__part", "__key", "__at"), summaries, summary)
    entered = _map_rows(steps.repartition(1).sortWithinPartitions("__part"), chain, [part, entry])
    again = dealt.join(F.broadcast(entered), "__part").select("__part", "__key", "__at", "__entered")  # a row a range
    return _map_rows(again.sortWithinPartitions("__part", "__key", "__at"), keep, [key, at])


def first_deliveries(
    df: DataFrame, keys: list[str], ts: str, delay: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """The rows that are kept, with their columns as they are."""
    length = df.sparkSession.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL {delay})").first()[0]
    others = [f for f in df.schema.fields if f.name not in keys and f.name != ts]
    order = [F.col(f.name) for f in others if is_orderable(f.dataType)]
    if unordered := [f.name for f in others if not is_orderable(f.dataType)]:
        order.append(F.to_json(F.struct(*unordered)))
    at = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(NEVER))
    keyed = df.withColumns({"__key": F.struct(*keys), "__at": at})
    timed = F.when(F.col("__at") != NEVER, F.col("__at"))
    spans = keyed.groupBy("__key").agg(
        F.min(timed).alias("first"), F.max(timed).alias("last"), F.min("__at").alias("least")
    )
    # The first delivery of each key, and one without a time if there is any.
    firsts = spans.select("__key", F.explode(F.array("first", "least")).alias("__at")).where("__at IS NOT NULL")
    longer = spans.where(F.col("last") - F.col("first") > length).select("__key")
    times = keyed.where(F.col("__at") != NEVER).select("__key", "__at").distinct()
    times = stage(times.join(longer, "__key", "left_semi"), "times")
    total = times.count()
    kept = firsts.unionAll(chained(times, total, length, range_rows)) if total else firsts
    row = F.min_by(F.struct(*df.columns), F.struct(F.lit(0), *order)).alias("__row")
    rows = keyed.groupBy("__key", "__at").agg(row)
    return rows.join(kept, ["__key", "__at"], "left_semi").select("__row.*")
