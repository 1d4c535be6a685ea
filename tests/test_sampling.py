"""Samples against brute force on whole small tables."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleward.operators import first_rows as first_rows_module
from sampleward.operators import sampling
from sampleward.operators.first_rows import any_rows, first_rows
from sampleward.operators.ordering import OrderKey, sample_order, tie_breakers


def rank(value):
    if value is None:
        return (0, 0)
    if isinstance(value, float) and math.isnan(value):
        return (1, 0)
    return (2, value)


def brute(rows, by, descending, n, others):
    rows = sorted(rows, key=lambda r: [rank(r[c]) for c in others])
    rows = sorted(rows, key=lambda r: rank(r[by]), reverse=descending)
    return rows[:n]


def bag(rows):
    return Counter(tuple(repr(v) for v in row) for row in rows)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, some are null or NaN, some are exact copies."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        value = rng.choice([None, float("nan"), float("-inf"), float("inf"), 5.0, 5.0, 5.0])
        value = rng.uniform(-10, 10) if rng.random() < 0.5 else value
        rows.append((value, i % 7 if rng.random() < 0.6 else None, f"t{rng.randrange(40)}"))
    rows += [(5.0, 3, "copy")] * 700
    df = spark.createDataFrame(rows, "v double, k int, s string").repartition(6)
    return sampling.stage(df)


@pytest.mark.parametrize(
    "by,direction,n",
    [
        ("v", "ASC", 40), ("v", "desc", 40), ("v", "ASC", 1900), ("v", "desc", 1900),
        ("v", "ASC", 3690), ("k", "ASC", 1900), ("k", "desc", 3690), ("s", "desc", 1900),
    ],
)
def test_narrowing_equals_brute_force(skewed, by, direction, n):
    keys = sample_order(skewed, by, direction)
    got = first_rows(skewed, keys, n, single_task_rows=50, bracket_rows=300).collect()
    others = [c for c in ["v", "k", "s"] if c != by]
    want = brute(skewed.collect(), by, direction.upper() == "DESC", n, others)
    assert bag(got) == bag(want)


@pytest.mark.parametrize("n", [65, 5000, 6000, 9000])
def test_sorted_sample_small_and_scaled_agree(table, n):
    lineitem = table("lineitem")
    plain = sampling.sorted_sample(lineitem, n, "l_shipdate", "DESC")
    scaled = sampling.sorted_sample(lineitem, n, "l_shipdate", "DESC", single_task_rows=100)
    assert bag(plain.collect()) == bag(scaled.collect())
    assert plain.count() == min(n, lineitem.count())


def test_typed_thresholds(spark):
    df = spark.range(2000).select(
        F.expr("timestamp_micros(id * 1234567)").alias("ts"),
        F.expr("cast(timestamp_micros(id * 7654321) as timestamp_ntz)").alias("ntz"),
        F.expr("date_add(date'2020-01-01', cast(id % 700 as int))").alias("d"),
        F.expr("cast(id as decimal(20,3)) / 7").alias("dec"),
        F.expr("unhex(md5(cast(id as string)))").alias("bin"),
        F.expr("id % 2 = 0").alias("b"),
        F.expr("cast(id / 3 as float)").alias("f"),
    )
    df = sampling.stage(df)
    for i, by in enumerate(df.columns):
        keys = sample_order(df, by, ["ASC", "DESC"][i % 2])
        got = first_rows(df, keys, 777, single_task_rows=100, bracket_rows=1000)
        want = first_rows(df, keys, 777, single_task_rows=10**6)
        assert bag(got.collect()) == bag(want.collect()), by


def test_any_rows_is_exact_and_distributed(skewed):
    for n in (1, 400, 3000):
        got = any_rows(skewed, n, skewed.count(), single_task_rows=10).collect()
        assert len(got) == n
        assert not bag(got) - bag(skewed.collect())


@pytest.mark.parametrize("n", [0, 500, 5999, 7000])
def test_random_samples_have_exactly_n_rows(table, n):
    lineitem = table("lineitem")
    source = bag(lineitem.collect())
    for got in (
        sampling.random_sample(lineitem, n, seed=3),
        sampling.random_sample(lineitem, n, seed=3, single_task_rows=50),
        sampling.random_sample_scaled(lineitem, n, seed=3, single_task_rows=50),
    ):
        rows = got.collect()
        assert len(rows) == min(n, 6000)
        assert not bag(rows) - source


def test_scaled_sample_survives_a_stale_total(table):
    orders = table("orders")
    got = sampling.random_sample_scaled(orders, 700, seed=1, total=10_000_000)
    assert got.count() == 700


def test_hash_sample_repeats(table):
    orders = table("orders")
    first = sampling.hash_sample(orders, 65, ["o_orderkey"], 42)
    again = sampling.hash_sample(
        orders.repartition(7), 65, ["o_orderkey"], 42, single_task_rows=20
    )
    assert bag(first.collect()) == bag(again.collect())


def test_block_sample_has_at_most_n_rows(spark, table):
    lineitem = table("lineitem")
    assert 0 < sampling.block_sample(lineitem, 300, seed=5).count() <= 300
    assert sampling.block_sample(lineitem, 0, seed=5).count() == 0
    assert sampling.block_sample(lineitem, 10_000, seed=5).count() == 6000
    many = sampling.stage(lineitem.repartition(120))
    got = sampling.block_sample(many, 2500, seed=5)
    files = many.select("_metadata.file_path").distinct().count()
    assert files == 120
    assert 0 < got.count() <= 2500
    # About the percentage of the files, and each one sampled over its whole length.
    held = got.select(F.col("_metadata.file_path").alias("f")).groupBy("f").count().collect()
    assert 120 * 42 // 100 - 2 <= len(held) <= 120 * 42 // 100 + 2 and min(r["count"] for r in held) > 20
    view = lineitem.groupBy("l_orderkey").count()
    assert sampling.block_sample(view, 5, seed=5).count() <= 5


def test_block_sample_skips_files(spark, table):
    many = sampling.stage(table("lineitem").repartition(120))
    chosen = many.filter(
        F.pmod(F.xxhash64(F.lit(5), F.col("_metadata.file_path")), F.lit(100)) < 30
    )
    files = chosen.select("_metadata.file_path").distinct().count()
    assert 5 < files < 80


def test_zero_sample_keeps_columns(table):
    orders = table("orders")
    assert sampling.zero_sample(orders).schema == orders.schema
    assert sampling.sorted_sample(orders, 0, "o_orderkey", "ASC").count() == 0


def test_unorderable_and_unknown_columns_are_refused(table):
    embeddings = table("embeddings")
    with pytest.raises(ValueError):
        sampling.sorted_sample(embeddings, 5, "embedding", "ASC")
    with pytest.raises(ValueError):
        sampling.sorted_sample(embeddings, 5, "no_such", "ASC")
    assert len(tie_breakers(embeddings)) == 2


def test_null_and_nan_order(spark):
    df = spark.createDataFrame(
        [(2.0,), (float("nan"),), (None,), (1.0,), (float("-inf"),)], "v double"
    )
    up = [r.v for r in sampling.sorted_sample(df, 4, "v", "ASC").collect()]
    assert up[0] is None and math.isnan(up[1]) and up[2:] == [float("-inf"), 1.0]
    down = [r.v for r in sampling.sorted_sample(df, 4, "v", "DESC").collect()]
    assert down[:3] == [2.0, 1.0, float("-inf")] and math.isnan(down[3])


def test_scattered_rows_are_gathered(table, monkeypatch):
    monkeypatch.setattr(first_rows_module, "SCAN_TASK_ROWS", 50)
    orders = sampling.stage(table("orders").repartition(30))
    few = sampling.sorted_sample(orders, 100, "o_totalprice", "ASC", single_task_rows=20)
    want = sampling.sorted_sample(orders, 100, "o_totalprice", "ASC", single_task_rows=10**6)
    assert bag(few.collect()) == bag(want.collect())
    assert few.rdd.getNumPartitions() < 5
    assert sampling.random_sample(orders, 100, seed=1, single_task_rows=20).count() == 100


def test_wide_rows_have_a_smaller_bound(table):
    assert first_rows_module.fits_one_task(table("labels"), 100_000, 400_000, None)
    assert not first_rows_module.fits_one_task(table("documents"), 100_000, 400_000, None)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_plans_stay_pruned(table):
    plan = sampling.sorted_sample(table("lineitem"), 10, "l_shipdate", "DESC")
    assert "TakeOrderedAndProject" in plan_of(plan)


def test_phase_one_reads_the_sort_column_alone(table):
    lineitem = table("lineitem")
    for key, schema in [
        (sample_order(lineitem, "l_shipdate", "DESC")[0], "ReadSchema: struct<l_shipdate:"),
        (OrderKey(F.xxhash64(F.col(first_rows_module.FILE)), T.LongType()), "ReadSchema: struct<>"),
    ]:
        text = plan_of(first_rows_module.first_keys(lineitem, key, 10, True))
        assert schema in text and text.count("ReadSchema") == 1, text
        assert "," not in text.split("ReadSchema: struct<")[1].split(">")[0]


def test_phase_two_pushes_the_mark_and_skips_files(spark, table):
    parts = sampling.stage(table("lineitem").repartitionByRange(40, "l_shipdate"))
    got = sampling.sorted_sample(parts, 65, "l_shipdate", "DESC", single_task_rows=100)
    text = plan_of(got)
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert scans and all("l_shipdate" in s.split("PushedFilters: ")[1] for s in scans), scans
    assert sampling.random_sample(parts, 20, 3, single_task_rows=100).select(F.col("_metadata.file_path")).distinct().count() <= 20
    for sample in (got, sampling.random_sample(parts, 5, 3, single_task_rows=100), sampling.hash_sample(parts, 5, ["l_orderkey", "l_linenumber"], 3, single_task_rows=100)):
        named = plan_of(sample).split("file_path")[1:]
        assert named, "no file is named"
    # Of 40 files by date, the last ones hold the latest rows.
    assert len({*re.findall(r"part-\d+", text)}) < 6


@pytest.mark.parametrize("sample", ["random", "hash", "sorted"])
def test_rows_are_the_same_at_all_sizes(table, sample):
    """On either side of each bound, and where the first key has few values or nulls."""
    lineitem = sampling.stage(table("lineitem").repartition(12))
    draw = {
        "random": lambda n, bound: sampling.random_sample(lineitem, n, 3, single_task_rows=bound),
        "hash": lambda n, bound: sampling.hash_sample(lineitem, n, ["l_returnflag", "l_linenumber"], 3, single_task_rows=bound),
        "sorted": lambda n, bound: sampling.sorted_sample(lineitem, n, "l_returnflag", "ASC", single_task_rows=bound),
    }[sample]
    for n in (50, 2999):
        want = bag(draw(n, None).collect())
        assert sum(want.values()) == n
        for bound in (10, 3000):
            assert bag(draw(n, bound).collect()) == want, (n, bound)


def test_rows_alike_in_all_columns_are_cut_by_their_place(spark):
    same = sampling.stage(spark.range(900).selectExpr("1 AS a", "map(1, id % 4) AS m").repartition(5))
    for n in (450,):
        want = sorted(str(r) for r in sampling.sorted_sample(same, n, "a", "ASC").collect())
        assert len(want) == n
        again = sampling.sorted_sample(same, n, "a", "ASC", single_task_rows=20)
        assert sorted(str(r) for r in again.collect()) == want


def test_hash_keys_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([("a", "b:c"), ("a:b", "c"), ("a", None), (None, "a"), ("\\null", "a")], "x string, y string")
    hashed = df.select(F.concat_ws(":", sampling._unmixed(F.col("x")), sampling._unmixed(F.col("y"))).alias("k"))
    assert hashed.distinct().count() == 5
    assert sampling.hash_sample(df, 4, ["x", "y"], 1).count() == 4


def test_random_rows_are_even(table):
    """Over many seeds, each row is drawn about equally often, wherever it lies."""
    orders = sampling.stage(table("orders").repartition(6).select("o_orderkey"))
    total, times = orders.count(), Counter()
    for seed in range(6):
        times.update(r[0] for r in sampling.random_sample(orders, 300, seed, total).collect())
    share = 6 * 300 / total
    counts = Counter(min(n, 8) for n in times.values())
    assert abs(total - len(times) - total * (1 - 300 / total) ** 6) < 6 * math.sqrt(total) and counts[8] < 10
