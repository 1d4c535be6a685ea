"""The commands of a batch as one relation: which tables they cover, and one job per table and target."""

from __future__ import annotations

import os.path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleward.functions.text import config_object_path
from sampleward.schemas import ORDER, TABLE_KEY
from sampleward.sources.shared import small_table

# Routes of commands that cover all tables below a prefix of the config's paths.
WIDE = ["START", "SAMPLE_POLICY_PREFIX"]
TARGET = ["target_project", "target_dataset", "target_id", "target_location"]


def one_order(spark: SparkSession, timestamp: int, prefix: str = "") -> DataFrame:
    """The order of a cycle that no command asked for."""
    row = dict.fromkeys(ORDER.fieldNames()) | {
        "order_id": "cycle", "route": WIDE[bool(prefix)], "timestamp": timestamp, "prefix": prefix,
    }
    return small_table(spark, [tuple(row.values())], ORDER)


def common_prefix(orders: DataFrame) -> str:
    """What the paths of all tables that the orders may cover begin with."""
    path = config_object_path(*map(F.col, TABLE_KEY))
    reach = F.when(F.col("route").isin(WIDE), F.coalesce("prefix", F.lit(""))).otherwise(path)
    ends = orders.agg(F.min(reach), F.max(reach)).first()
    return os.path.commonprefix([end or "" for end in ends])


def covered_tables(tables: DataFrame, orders: DataFrame) -> DataFrame:
    """(table key, order_id, timestamp): each table with the orders whose prefix its path begins with.

    Paths are cut to the lengths that prefixes have, of which there are few, and joined as equal texts.
    """
    wide = orders.where(F.col("route").isin(WIDE)).select(
        "order_id", "timestamp", F.coalesce("prefix", F.lit("")).alias("prefix")
    )
    lengths = [row[0] for row in wide.select(F.char_length("prefix")).distinct().collect()]
    path = config_object_path(*map(F.col, TABLE_KEY))
    cuts = [F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in lengths]
    cut = tables.select(*TABLE_KEY, F.explode(F.array(*cuts) if cuts else F.array().cast("array<string>")).alias("prefix"))
    return cut.join(wide, "prefix").select(*TABLE_KEY, "order_id", "timestamp")


def covered_requests(requests: DataFrame, policies: DataFrame, orders: DataFrame) -> DataFrame:
    """A row per order and table it covers: the effective limit, and the size, spec and target to be sampled.

    Wide orders cover the tables of `policies` and take their effective request. SAMPLE_START takes the
    size, spec and target of its message, what it leaves open being that of the effective request.
    """
    wide = covered_tables(policies, orders).join(requests, TABLE_KEY).select(
        *TABLE_KEY, "limit", "size", "spec",
        F.lit(None).cast("string").alias("target_project"),
        F.col("dataset_id").alias("target_dataset"), F.col("table_id").alias("target_id"),
        F.lit(None).cast("string").alias("target_location"),
        "order_id", "timestamp", F.lit(False).alias("own"),
    )
    asked = orders.where("route = 'SAMPLE_START'").withColumnsRenamed({"size": "asked_size", "spec": "asked_spec"})
    own = asked.join(requests, TABLE_KEY).select(
        *TABLE_KEY, "limit", F.coalesce("asked_size", "size").alias("size"), F.coalesce("asked_spec", "spec").alias("spec"),
        *TARGET, "order_id", "timestamp", F.lit(True).alias("own"),
    )
    return wide.unionAll(own)


def latest_requests(covered: DataFrame) -> DataFrame:
    """One request per table and target: the latest, of equal times that of a SAMPLE_START."""
    what = F.struct("limit", "size", "spec", *TARGET, "timestamp")
    latest = F.max_by(what, F.struct("timestamp", "own", "order_id")).alias("latest")
    target = [F.lower(name).alias(f"__{name}") for name in ("target_project", "target_dataset", "target_id")]
    grouped = covered.groupBy(*TABLE_KEY, *target).agg(latest)
    return grouped.select(*TABLE_KEY, "latest.*")


def order_outcomes(orders: DataFrame, covered: DataFrame, finished: DataFrame) -> DataFrame:
    """order_id, route, timestamp, jobs, failed, error (the first one) per order; an order that covers nothing has no jobs."""
    jobs = finished.select(*TABLE_KEY, F.lower("target_dataset").alias("d"), F.lower("target_id").alias("t"), "error_code")
    of_order = covered.select(*TABLE_KEY, F.lower("target_dataset").alias("d"), F.lower("target_id").alias("t"), "order_id")
    counted = of_order.join(jobs, [*TABLE_KEY, "d", "t"]).groupBy("order_id").agg(
        F.count("*").alias("jobs"), F.count("error_code").alias("failed"), F.min("error_code").alias("error")
    )
    zero = F.lit(0).cast("long")
    return orders.select("order_id", "route", "timestamp").join(counted, "order_id", "left").select(
        "order_id", "route", "timestamp",
        F.coalesce("jobs", zero).alias("jobs"), F.coalesce("failed", zero).alias("failed"), "error",
    )
