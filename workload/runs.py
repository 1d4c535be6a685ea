"""The queries: one per operator, each over whole tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow.fs as pafs
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleward.functions import config_json, text
from sampleward.functions.compliance import granted_rows
from sampleward.operators import sampling, tables
from sampleward.plans import effective, jobs, records, reports
from sampleward.plans.cycle import run_cycle
from sampleward.schemas import TABLE_KEY
from sampleward.settings import CycleConfig
from sampleward.sources import catalog
from sampleward.sources.commands import command_stream
from sampleward.sources.config_objects import (
    list_dataset_prefixes,
    parse_table_path,
    scan_config_objects,
)
from sampleward.sources.shared import new_folder
from sampleward.streaming import alerts, commands
from workload import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Limit and size of the single-table samples: (count, percentage).
LIMIT, SIZE = (1200, 27.5), (14, 4.8)
SCALED_LIMIT, SCALED_SIZE = (250_000, 38.4), (2, 100.0)
SEED = 42
LOG_TS = 1_700_000_000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def derived(spark: SparkSession, sf: str, source: tuple[str, list[str]]) -> DataFrame:
    name, columns = source
    return read(spark, sf, name).selectExpr(*columns)


def flat(df: DataFrame, *keys: str, limit: bool = True) -> DataFrame:
    """Structs as plain columns, so that results can be compared by value."""
    columns = []
    for name in ["limit", "size"] if limit else ["size"]:
        columns += [
            F.col(name)["count"].alias(f"{name}_count"),
            F.col(name)["percentage"].alias(f"{name}_percentage"),
        ]
    return df.select(
        *keys,
        *columns,
        F.col("spec")["type"].alias("spec_type"),
        F.col("spec")["properties"]["by"].alias("spec_by"),
        F.col("spec")["properties"]["direction"].alias("spec_direction"),
    )


def grant(df: DataFrame, limit=LIMIT, size=SIZE) -> tuple[int, int]:
    """Row count of a table and the rows a policy grants of it."""

    def struct(value):
        return F.struct(
            F.lit(value[0]).cast("bigint").alias("count"),
            F.lit(value[1]).cast("double").alias("percentage"),
        )

    counted = df.agg(F.count(F.lit(1)).alias("n"))
    row = counted.select("n", granted_rows(F.col("n"), struct(limit), struct(size)).alias("g"))
    return tuple(row.first())


# Config objects


@query
def scan_config_objects_(spark, sf):
    root = new_folder(spark, "objects")
    objects = read(spark, sf, "supplier").selectExpr(
        f"{inputs.object_path('s_suppkey')} AS path", f"{inputs.policy_text('s_suppkey')} AS content"
    )

    def write(rows):
        filesystem, base = pafs.FileSystem.from_uri(root)
        for row in rows:
            full = f"{base}/{row.path}"
            filesystem.create_dir(full.rpartition("/")[0], recursive=True)
            with filesystem.open_output_stream(full) as out:
                out.write(row.content.encode())

    objects.foreachPartition(write)
    return scan_config_objects(spark, root)


@query
def parse_table_path_(spark, sf):
    paths = read(spark, sf, "part").selectExpr(f"{inputs.object_path('p_partkey')} AS path")
    return parse_table_path(paths)


@query
def list_dataset_prefixes_(spark, sf):
    paths = read(spark, sf, "part").selectExpr(f"{inputs.object_path('p_partkey')} AS path")
    return list_dataset_prefixes(paths)


@query
def json_to_policy(spark, sf):
    policies = config_json.parse_policies(derived(spark, sf, inputs.POLICIES))
    return flat(policies, *TABLE_KEY)


@query
def json_to_request(spark, sf):
    texts = read(spark, sf, "events").selectExpr(
        "event_id", f"{inputs.event_request_text()} AS content"
    )
    return flat(config_json.parse_requests(texts), "event_id", limit=False)


@query
def validate_size(spark, sf):
    rows = read(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", *inputs.SIZE_PARTS
    )
    size = config_json.valid_size(F.col("wanted_count"), F.col("wanted_percentage"))
    return rows.withColumn("size", size).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("size")["count"].alias("size_count"),
        F.col("size")["percentage"].alias("size_percentage"),
        F.col("size").isNotNull().alias("valid"),
    )


@query
def validate_spec(spark, sf):
    rows = read(spark, sf, "part").selectExpr("p_partkey", *inputs.SPEC_PARTS)
    properties = config_json.valid_properties(F.col("sort_by"), F.col("direction"))
    return (
        rows.withColumn("properties", properties)
        .withColumn("spec", config_json.valid_spec(F.col("sample_type"), F.col("properties")))
        .select(
            "p_partkey",
            F.col("spec")["type"].alias("spec_type"),
            F.col("spec")["properties"]["by"].alias("spec_by"),
            F.col("spec")["properties"]["direction"].alias("spec_direction"),
            F.col("spec").isNotNull().alias("valid"),
        )
    )


@query
def validate_table_ref(spark, sf):
    refs = read(spark, sf, "customer").selectExpr("c_custkey", f"{inputs.TABLE_REF_TEXT} AS ref")
    return refs.withColumn("r", text.parse_table_ref(F.col("ref"))).select(
        "c_custkey", "r.project_id", "r.dataset_id", "r.table_id", "r.location"
    )


# Catalog


@query
def resolve_location(spark, sf):
    regions = read(spark, sf, "region")
    datasets = (
        read(spark, sf, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "'p_' || CAST(n_regionkey AS STRING) AS project_id",
            "'d_' || CAST(n_nationkey AS STRING) AS dataset_id",
            "r_name AS location",
        )
    )
    return catalog.resolve_location(derived(spark, sf, inputs.LOCATED_TABLES), datasets)


@query
def scan_source(spark, sf):
    return read(spark, sf, "lineitem")


def _all_tables(spark, sf):
    return {("p", "d", name): read(spark, sf, name) for name in inputs.TABLES}


@query
def source_schema(spark, sf):
    return catalog.source_schema(spark, _all_tables(spark, sf)).select(
        "table_id", "column_name", "ordinal", "data_type", "orderable"
    )


@query
def row_count(spark, sf):
    return catalog.row_count(spark, _all_tables(spark, sf)).select("table_id", "row_count")


@query
def drop_column(spark, sf):
    return tables.drop_column(read(spark, sf, "orders"), "o_orderpriority")


@query
def label_match(spark, sf):
    wanted = {"sample_table": "true", "brand": "Brand#2"}
    labels = F.create_map(
        F.lit("sample_table"),
        F.when(F.col("p_size") > 25, "true").otherwise("false"),
        F.lit("brand"),
        F.col("p_brand"),
    )
    return read(spark, sf, "part").select(
        "p_partkey", catalog.label_match(labels, wanted).alias("matches")
    )


# Plan


def _config(spark, sf):
    policies = config_json.parse_policies(derived(spark, sf, inputs.POLICIES))
    requests = config_json.parse_requests(derived(spark, sf, inputs.REQUESTS))
    default = config_json.parse_policies(derived(spark, sf, inputs.DEFAULT_POLICY))
    return policies.drop("content"), requests.drop("content"), default.drop("content")


def _row_counts(spark, sf):
    key = "o_custkey"
    return (
        read(spark, sf, "orders")
        .groupBy(key)
        .agg(F.expr(inputs.ROW_COUNT).alias("row_count"))
        .selectExpr(
            f"{inputs.project(key)} AS project_id",
            f"{inputs.dataset(key)} AS dataset_id",
            f"{inputs.table(key)} AS table_id",
            "row_count",
        )
    )


def _requests(spark, sf):
    policies, requests, default = _config(spark, sf)
    return effective.effective_request(effective.effective_policy(policies, default), requests)


def _plan(spark, sf):
    return jobs.compliant_plan(_requests(spark, sf), _row_counts(spark, sf))


PLAN_COLUMNS = [
    *TABLE_KEY, "row_count", "sample_type", "sort_by", "direction", "limit_rows", "wanted_rows",
    "granted", "error_code",
]


@query
def effective_policy(spark, sf):
    policies, _, default = _config(spark, sf)
    return flat(effective.effective_policy(policies, default), *TABLE_KEY)


@query
def effective_request(spark, sf):
    return flat(_requests(spark, sf), *TABLE_KEY)


@query
def compliant_plan(spark, sf):
    return _plan(spark, sf).select(*PLAN_COLUMNS)


@query
def target_mapping(spark, sf):
    located = resolve_location(spark, sf)
    return jobs.target_mapping(located, "target", "EUROPE")


@query
def orphan_requests(spark, sf):
    policies, requests, _ = _config(spark, sf)
    return flat(effective.orphan_requests(requests, policies), *TABLE_KEY, limit=False)


@query
def removed_sources(spark, sf):
    policies = derived(spark, sf, inputs.POLICIES)
    gone = jobs.removed_sources(policies, derived(spark, sf, inputs.CATALOG_TABLES))
    return gone.select(*TABLE_KEY, "error_code")


@query
def validate_job(spark, sf):
    rows = read(spark, sf, "orders").selectExpr("o_orderkey", *inputs.JOB_PARTS)
    columns = catalog.source_schema(
        spark, {("p", "d", name): read(spark, sf, name) for name in ("orders", "embeddings")}
    )
    return jobs.validate_job(rows, columns).select("o_orderkey", "job_error")


@query
def policy_request_dry_run(spark, sf):
    report = reports.policy_request_dry_run(*_config(spark, sf))
    return flat(report, *TABLE_KEY, "has_policy")


@query
def sample_request_dry_run(spark, sf):
    plan = reports.sample_request_dry_run(*_config(spark, sf), _row_counts(spark, sf))
    return plan.select(*TABLE_KEY, "granted", "sample_type", "sort_by", "direction")


@query
def errors_per_cycle(spark, sf):
    failed = _plan(spark, sf).withColumn("error", F.concat_ws(" ", "table_id", "error_code"))
    failed = failed.filter(F.col("error_code").isNotNull())
    return jobs.errors_per_cycle(failed)


# Samples


@query
def sorted_sample(spark, sf):
    df = read(spark, sf, "lineitem")
    total, n = grant(df)
    return sampling.sorted_sample(df, n, "l_shipdate", "DESC", total)


@query
def random_sample(spark, sf):
    df = read(spark, sf, "lineitem")
    total, n = grant(df)
    return sampling.random_sample(df, n, SEED, total)


@query
def block_sample(spark, sf):
    df = read(spark, sf, "lineitem")
    total, n = grant(df)
    return sampling.block_sample(df, n, SEED, total)


@query
def random_sample_scaled(spark, sf):
    df = read(spark, sf, "lineitem")
    total, n = grant(df, SCALED_LIMIT, SCALED_SIZE)
    return sampling.random_sample_scaled(df, n, SEED, total)


def slices(column: str, parts: int, source: DataFrame) -> Column:
    """Number of the slice of a column's range, in the order in which the table is stored or sorted."""
    low, high = source.agg(F.min(column).cast("string"), F.max(column).cast("string")).first()
    kind = source.schema[column].dataType
    number = F.datediff if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else (lambda at, start: at - start)
    low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
    return F.floor(number(F.col(column), low) * F.lit(parts) / (number(high, low) + 1))


def sample_facts(sample: DataFrame, source: DataFrame, n: int) -> DataFrame:
    """(fact, holds): what must hold of any random sample of n rows, over all its rows.

    Strata are slices of the order in which rows are stored, slices of another column, and hashes: a prefix,
    a file or the first rows of an order have no even shares in all of them.
    """
    strata = {
        "fair_by_storage": slices("l_orderkey", 10, source),
        "fair_by_date": slices("l_shipdate", 10, source),
        "fair_by_hash": F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(10)),
    }
    rows = F.count("*")
    facts = {
        "has_n_rows": sample.agg((rows == n).alias("holds")),
        "at_most_n_rows": sample.agg((rows <= n).alias("holds")),
        "from_source": sample.exceptAll(source).agg((rows == 0).alias("holds")),
    }
    for name, stratum in strata.items():
        there = source.groupBy(stratum.alias("stratum")).agg(F.count("*").alias("all"))
        drawn = sample.groupBy(stratum.alias("stratum")).agg(F.count("*").alias("drawn"))
        # Within six standard deviations of what a stratum's share of the draw should be.
        expected = F.col("all") * F.lit(n) / F.sum("all").over(Window.partitionBy())
        off = F.abs(F.coalesce("drawn", F.lit(0)) - expected) - 6 * F.sqrt(expected) - 1
        fair = there.join(drawn, "stratum", "left").select((off <= 0).alias("fair"))
        facts[name] = fair.agg(F.bool_and("fair").alias("holds"))
    return reduce(
        DataFrame.unionAll, (df.select(F.lit(name).alias("fact"), "holds") for name, df in facts.items())
    )


@query
def random_sample_facts(spark, sf):
    df = read(spark, sf, "lineitem")
    total, n = grant(df)
    return sample_facts(sampling.random_sample(df, n, SEED, total), df, n)


@query
def random_sample_scaled_facts(spark, sf):
    df = read(spark, sf, "lineitem")
    total, n = grant(df, SCALED_LIMIT, SCALED_SIZE)
    return sample_facts(sampling.random_sample_scaled(df, n, SEED, total), df, n)


@query
def block_sample_facts(spark, sf):
    df = read(spark, sf, "lineitem")
    total, n = grant(df)
    facts = sample_facts(sampling.block_sample(df, n, SEED, total), df, n)
    return facts.filter(F.col("fact").isin("at_most_n_rows", "from_source"))


@query
def zero_sample(spark, sf):
    return sampling.zero_sample(read(spark, sf, "lineitem"))


@query
def hash_sample(spark, sf):
    df = read(spark, sf, "orders")
    total, n = grant(df)
    return sampling.hash_sample(df, n, ["o_orderkey"], SEED, total)


# Writing and refreshing


@query
def write_sample(spark, sf):
    df = read(spark, sf, "orders")
    total, n = grant(df)
    schema = f"written_{uuid.uuid4().hex}"
    labels = tables.sample_labels({"team": "a"}, "p", "EU")
    tables.create_schema(spark, schema, new_folder(spark, "written"), labels)
    sample = sampling.sorted_sample(df, n, "o_totalprice", "DESC", total)
    return tables.write_sample(sample, schema, "orders", labels)


@query
def cross_location_copy(spark, sf):
    df = read(spark, sf, "customer")
    total, n = grant(df)
    run = uuid.uuid4().hex
    labels = tables.sample_labels({}, "p", "EU")
    tables.create_schema(spark, f"copied_{run}", new_folder(spark, "copied"), labels)
    staging = tables.staging_schema_name(spark, "staging_", "d", "customer", "EU", run)
    sample = sampling.sorted_sample(df, n, "c_acctbal", "ASC", total)
    return tables.cross_location_copy(
        sample, staging, new_folder(spark, "staging"), f"copied_{run}", "customer", labels
    )


@query
def full_refresh_targets(spark, sf):
    labelled = F.when(F.col("c_acctbal") > 0, "true").otherwise("false")
    existing = (
        read(spark, sf, "customer")
        .selectExpr("c_acctbal", *inputs.CATALOG_TABLES[1])
        .withColumn("labels", F.create_map(F.lit("sample_table"), labelled))
        .drop("c_acctbal")
    )
    policies, _, _ = _config(spark, sf)
    kept = policies.filter("limit IS NOT NULL OR size IS NOT NULL OR spec IS NOT NULL")
    return tables.full_refresh_targets(existing, kept).select(*TABLE_KEY)


@query
def run_log(spark, sf):
    plan = jobs.target_mapping(
        _plan(spark, sf).withColumn("location", F.lit("EU")), "target", "EU"
    )
    inserted = (
        read(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .selectExpr(
            f"{inputs.project('l_partkey')} || '.' || {inputs.dataset('l_partkey')} || '.' || "
            f"{inputs.table('l_partkey')} || '@EU' AS source_table",
            "row_count",
        )
    )
    return records.run_log(plan, inserted, LOG_TS, F.lit(LOG_TS + 1), F.lit(LOG_TS + 9))


# Commands and alerts


def _commands(spark, sf):
    messages = (
        read(spark, sf, "events")
        .selectExpr("event_id", f"{inputs.MESSAGE_TEXT} AS body", f"{inputs.PUBLISH_TIME} AS publish_time")
        .select("event_id", F.base64(F.encode("body", "UTF-8")).alias("data"), "publish_time")
    )
    return command_stream(messages)


@query
def command_stream_(spark, sf):
    return _commands(spark, sf).select(
        "event_id", "payload", "timestamp", F.col("document").isNotNull().alias("is_json")
    )


@query
def route_commands(spark, sf):
    routed = commands.route_commands(_commands(spark, sf))
    return routed.select("event_id", "type", "timestamp", "error", "route")


@query
def dead_letter(spark, sf):
    routed = commands.route_commands(_commands(spark, sf))
    return records.dead_letter(routed, ["event_id", "payload", "timestamp", "type"])


@query
def transfer_notification(spark, sf):
    return commands.transfer_notification(_commands(spark, sf)).select(
        "event_id", "config_name", "state", "source_project_id", "source_dataset_id",
        "next_command", "error",
    )


@query
def idempotent_commands(spark, sf):
    deliveries = derived(spark, sf, inputs.DELIVERIES)
    return commands.idempotent_commands(deliveries, ["command_id"], "delivered")


@query
def error_alert(spark, sf):
    return alerts.error_alert(read(spark, sf, "events"), "ts", F.col("event_type") == "error")


@query
def missed_cycle_alert(spark, sf):
    return alerts.missed_cycle_alert(read(spark, sf, "events"), "ts", ["user_id"])


# The whole cycle

# Policy and request of each table: (limit, size, sort column, direction, requested size).
GOVERNED = {
    "region": ((4, None), (None, 60.0), "r_name", "DESC", None),
    "nation": ((12, 44.5), (6, None), "n_name", "ASC", None),
    "customer": ((900, 26.4), (15, 4.2), "c_acctbal", "DESC", (35, 12.6)),
    "supplier": ((None, 24.3), (8, 6.1), "s_acctbal", "ASC", (700, None)),
    "part": ((800, 18.2), (13, 8.4), "p_retailprice", "DESC", None),
    "orders": ((1300, 32.7), (5, 7.9), "o_orderdate", "DESC", None),
    "lineitem": ((1500, 28.6), (2500, 13.3), "l_shipdate", "DESC", None),
    "events": ((950, 37.2), (16, 5.9), "ts", "ASC", (21, 14.8)),
    "documents": ((260, 33.9), (None, 4.7), "n_chars", "DESC", None),
    "embeddings": ((850, 22.8), (30, None), "label", "ASC", None),
    "pages": ((640, 29.1), (0, None), "url", "ASC", None),
    "benchmark": ((720, 26.2), (None, 31), "text", "DESC", None),
    "labels": ((45, None), (None, 100.0), "quality", "ASC", (0, None)),
    "conversations": ((880, 25.7), (18, 3.6), "text", "ASC", (75, None)),
}
ROW_IDS = {
    "lineitem": ("l_orderkey", "l_linenumber"),
    "conversations": ("conv_id", "turn"),
}


def row_ids(name: str) -> tuple[str, str]:
    first = inputs.ORDERED_COLUMNS[name].split()[0]
    return ROW_IDS.get(name, (first, "0"))


def _size_json(size):
    count, percentage = size
    given = {"count": count, "percentage": percentage}
    return {key: value for key, value in given.items() if value is not None}


def _write_object(root: str, path: str, content: dict) -> None:
    filesystem, base = pafs.FileSystem.from_uri(root)
    full = f"{base}/{path}"
    filesystem.create_dir(full.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(full) as out:
        out.write(json.dumps(content).encode())


def governed_cycle(spark: SparkSession, sf: str) -> tuple[CycleConfig, str, DataFrame]:
    """Run a cycle over views on all tables; returns its config, dataset and run log."""
    run = uuid.uuid4().hex[:12]
    dataset = f"source_{run}"
    root = new_folder(spark, "cycle")
    tables.create_schema(spark, dataset, f"{root}/source", {"data_location": "EU"})

    def create_view(name: str) -> None:
        spark.sql(f"CREATE VIEW {dataset}.{name} AS SELECT * FROM parquet.`{sf}/{name}.parquet`")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(inheritable_thread_target(spark)(create_view), inputs.TABLES))
    _write_object(f"{root}/policies", "default_policy.json", {"limit": {"count": 1}})
    for name, (limit, size, by, direction, asked) in GOVERNED.items():
        spec = {"type": "sorted", "properties": {"by": by, "direction": direction}}
        policy = {
            "limit": _size_json(limit),
            "default_sample": {"size": _size_json(size), "spec": spec},
        }
        _write_object(f"{root}/policies", f"prod/{dataset}/{name}.json", policy)
        if asked:
            _write_object(
                f"{root}/requests", f"prod/{dataset}/{name}.json", {"size": _size_json(asked)}
            )
    _write_object(f"{root}/policies", f"prod/{dataset}/removed_table.json", {})
    config = CycleConfig(
        policy_root=f"{root}/policies",
        request_root=f"{root}/requests",
        target_project="target",
        target_root=f"{root}/target",
        target_location="EU",
        target_schema_prefix=f"sample{run}_",
        staging_prefix=f"staging{run}_",
        log_schema=f"log{run}",
        parallelism=8,
    )
    return config, dataset, run_cycle(spark, config, LOG_TS).log


@query
def governed_sample(spark, sf):
    config, dataset, _ = governed_cycle(spark, sf)
    schema = config.target_schema(dataset)
    samples = []
    for name in inputs.TABLES:
        first, second = row_ids(name)
        samples.append(
            spark.table(f"{schema}.{name}").selectExpr(
                f"'{name}' AS table_id",
                f"CAST({first} AS BIGINT) AS row_id",
                f"CAST({second} AS BIGINT) AS row_part",
                f"{inputs.row_digest(name, inputs.SPARK_TEXTS)} AS row_digest",
            )
        )
    return reduce(DataFrame.unionAll, samples)


def queries() -> dict[str, Query]:
    return {name.rstrip("_"): function for name, function in QUERIES.items()}
