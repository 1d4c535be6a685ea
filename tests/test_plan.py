"""Buckets to plan: the golden table, errors, reports and records."""

import os

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

import buckets
from sampleward.plans.effective import (
    default_policy,
    effective_policy,
    effective_request,
    orphan_requests,
    table_policies,
    table_requests,
)
from sampleward.plans.jobs import (
    compliant_plan,
    errors_per_cycle,
    removed_sources,
    target_mapping,
    validate_job,
)
from sampleward.plans.records import dead_letter, run_log
from sampleward.plans.reports import policy_request_dry_run, sample_request_dry_run
from sampleward.sources.catalog import source_schema
from sampleward.sources.config_objects import (
    entries_of,
    list_dataset_prefixes,
    list_objects,
    object_present,
    parse_table_path,
    scan_config_objects,
)


@pytest.fixture(scope="module")
def roots(tmp_path_factory):
    root = tmp_path_factory.mktemp("config")
    policies = buckets.write_all(root / "policies", buckets.POLICIES)
    requests = buckets.write_all(root / "requests", buckets.REQUESTS)
    return policies, requests


@pytest.fixture(scope="module")
def config(spark, roots):
    policies, requests = (scan_config_objects(spark, root) for root in roots)
    return (
        table_policies(policies),
        table_requests(requests),
        default_policy(policies, "default_policy.json"),
    )


def effective(config):
    policies, requests, default = config
    return effective_request(effective_policy(policies, default), requests)


def key_of(row):
    return f"{row.project_id}.{row.dataset_id}.{row.table_id}"


def counts_for(df, n):
    return df.select("project_id", "dataset_id", "table_id").withColumn(
        "row_count", F.lit(n).cast("bigint")
    )


BOOKED, KM = ("sorted", ("booked_at", "ASC")), ("sorted", ("km", "DESC"))
# Per table: limit, size, spec, rows granted of 200 and of 4000, error.
GOLDEN = {
    "shop.sales.receipts": ((640, 22.5), (25, 3.0), BOOKED, 25, 120, None),
    "shop.sales.refunds": ((640, 22.5), (None, 50.0), ("random", None), 45, 640, None),
    "shop.sales.baskets": ((640, 22.5), (31, None), BOOKED, 31, 31, None),
    "shop.stock.shelves": ((None, 12.5), (5000, None), BOOKED, 25, 500, None),
    "shop.stock.pallets": ((640, 22.5), (25, 3.0), ("sorted", ("weight", "DESC")), 25, 120, None),
    "fleet.trips.legs": ((75, 80.0), (12, 0.5), ("random", None), 12, 20, None),
    "fleet.trips.stops": ((75, 80.0), (12, 0.5), KM, 12, 20, None),
    "fleet.trips.fuel": ((640, 22.5), (25, 3.0), ("sorted", None), 25, 120, "MISSING_SORT_PROPERTIES"),
    "fleet.depots.bays": ((3, None), (25, 3.0), ("sorted", None), 3, 3, "MISSING_SORT_PROPERTIES"),
}


@pytest.mark.parametrize("rows,place", [(200, 3), (4000, 4)])
def test_golden_plan(config, rows, place):
    resolved = effective(config)
    plan = compliant_plan(resolved, counts_for(resolved, rows)).collect()
    assert {key_of(row) for row in plan} == set(GOLDEN)
    for row in plan:
        want = GOLDEN[key_of(row)]
        spec = row.spec.type, row.spec.properties and tuple(row.spec.properties)
        got = tuple(row.limit), tuple(row["size"]), spec, row.granted, row.error_code
        assert got == (want[0], want[1], want[2], want[place], want[5]), key_of(row)


def test_scan_keeps_empty_and_bad_objects(spark, roots, tmp_path):
    rows = {r.path: r.content for r in scan_config_objects(spark, roots[0]).collect()}
    assert set(rows) == set(buckets.POLICIES)
    assert rows["shop/sales/receipts.json"] == ""
    buckets.write(tmp_path, "x/y/z.json", b"\xff\xfe")
    assert scan_config_objects(spark, str(tmp_path)).first().content is None
    assert scan_config_objects(spark, str(tmp_path / "none")).count() == 0
    part = scan_config_objects(spark, roots[0], "fleet/trips/")
    assert part.count() == 3
    only = scan_config_objects(spark, roots[0], condition=F.col("path").endswith(".md"))
    assert only.count() == 1


class CountingFiles:
    """A file system that notes which folders are listed."""

    def __init__(self):
        self.files, self.listed = pafs.LocalFileSystem(), []

    def get_file_info(self, selector):
        self.listed.append((os.path.basename(selector.base_dir), selector.recursive))
        return self.files.get_file_info(selector)


def test_listings_are_dealt_over_tasks(spark, tmp_path):
    paths = [f"p{p}/d{d}/t{t}.json" for p in range(2) for d in range(12) for t in range(5)]
    paths += ["default.json", "p0/notes.md", "p1/d3/deep/er/x.json"]
    for path in paths:
        buckets.write(tmp_path, path, path)
    listed = list_objects(spark, str(tmp_path))
    assert sorted(r.path for r in listed.collect()) == sorted(paths)
    # No step but the listing of the root's own folder is left to one task.
    assert listed.select(F.spark_partition_id()).distinct().count() > 3
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == plan.count("RepartitionByExpression") == 3
    got = {r.path: r.content for r in scan_config_objects(spark, str(tmp_path)).collect()}
    assert got == {path: path for path in paths}
    for prefix in ("p1/d3/", "p1/d1", "p0/d2/t", "p0/", "p", "q/", "p1/d3/deep/", "p1/d3/deep/er/x"):
        got = [r.path for r in list_objects(spark, str(tmp_path), prefix).collect()]
        assert sorted(got) == sorted(path for path in paths if path.startswith(prefix)), prefix


def test_folders_are_listed_once_and_only_under_the_prefix(tmp_path):
    for path in ("p/a/x.json", "p/ab/y.json", "p/ab/z/w.json", "p/b/x.json", "q/a/x.json"):
        buckets.write(tmp_path, path, "")
    files, base = CountingFiles(), str(tmp_path)
    assert sorted(entries_of(files, base, "p", "p/a", False)) == [("p/a", True), ("p/ab", True)]
    assert sorted(entries_of(files, base, "p/ab", "p/a", True)) == [("p/ab/y.json", False), ("p/ab/z/w.json", False)]
    assert list(entries_of(files, base, "gone", "gone/", True)) == []
    assert sorted(entries_of(files, base, "", "", False)) == [("p", True), ("q", True)]
    assert files.listed == [("p", False), ("ab", True), ("gone", True), (os.path.basename(base), False)]


def test_paths_and_prefixes(spark, roots):
    objects = scan_config_objects(spark, roots[0])
    assert parse_table_path(objects).count() == 9
    prefixes = {r.prefix for r in list_dataset_prefixes(objects).collect()}
    assert prefixes == {"shop/sales/", "shop/stock/", "fleet/trips/", "fleet/depots/"}


def test_empty_lock_object_counts(spark, tmp_path):
    objects = scan_config_objects(spark, str(tmp_path))
    assert not object_present(objects, "lock")
    buckets.write(tmp_path, "lock", "")
    assert object_present(scan_config_objects(spark, str(tmp_path)), "lock")


def test_missing_default_means_fallback(config):
    policies, _, default = config
    rows = effective_policy(policies, default.limit(0)).collect()
    empty = next(r for r in rows if r.table_id == "receipts")
    assert tuple(empty.limit) == (1, None) and tuple(empty["size"]) == (1, None)
    assert empty.spec.type == "random"


def test_default_is_a_subquery_not_a_join(config):
    policies, _, default = config
    plan = effective_policy(policies, default)._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_orphans_and_removed(config):
    policies, requests, _ = config
    orphans = orphan_requests(requests, policies).collect()
    assert [r.table_id for r in orphans] == ["vouchers"]
    present = policies.filter(F.col("project_id") == "shop")
    gone = removed_sources(policies, present).collect()
    assert {r.project_id for r in gone} == {"fleet"}
    assert {r.error_code for r in gone} == {"MISSING_SOURCE"}


def test_missing_and_bad_counts_are_errors(config):
    resolved = effective(config)
    counts = counts_for(resolved.filter("project_id = 'fleet'"), -1)
    codes = {key_of(r): r.error_code for r in compliant_plan(resolved, counts).collect()}
    assert codes["shop.sales.refunds"] == "MISSING_SOURCE"
    assert codes["fleet.depots.bays"] == "BAD_ROW_COUNT"


def test_spec_without_type_is_an_error(spark, config):
    resolved = effective(config).withColumn(
        "spec", F.struct(F.lit(None).cast("string").alias("type"), F.col("spec.properties"))
    )
    codes = {r.error_code for r in compliant_plan(resolved, counts_for(resolved, 5)).collect()}
    assert codes == {"BAD_SPEC_TYPE"}


def test_target_mapping(config):
    resolved = effective(config).withColumn("location", F.lit("EU"))
    row = target_mapping(resolved, "target", "US").filter("table_id = 'legs'").first()
    assert row.source_table == "fleet.trips.legs@EU"
    assert row.target_table == "target.trips.legs@US"
    assert row.crosses_location
    row = target_mapping(resolved, "target", "EU").first()
    assert not row.crosses_location


JOBS = [
    (None, "t", 1, "random", None, None, "MISSING_SOURCE_REF"),
    ("s", None, 1, "random", None, None, "MISSING_TARGET_REF"),
    ("s", "t", None, "random", None, None, "BAD_AMOUNT"),
    ("s", "t", -1, "random", None, None, "BAD_AMOUNT"),
    ("s", "t", 1, "sorted", "", "ASC", "BAD_COLUMN"),
    ("s", "t", 1, "sorted", "\n", "ASC", "BAD_COLUMN"),
    ("s", "t", 1, "sorted", "c", "DESC_WRONG", "BAD_ORDER"),
    ("s", "t", 1, "sorted", "c", "INVALID", "BAD_ORDER"),
    ("s", "t", 1, "sorted", "c", "", "BAD_ORDER"),
    ("s", "t", 1, "sorted", " c ", " desc ", None),
    ("s", "t", 0, "random", None, None, None),
]


def test_validate_job(spark):
    df = spark.createDataFrame(
        JOBS,
        "source_table string, target_table string, amount bigint, sample_type string,"
        " sort_by string, direction string, want string",
    )
    bad = validate_job(df).filter(~F.col("want").eqNullSafe(F.col("job_error")))
    assert bad.count() == 0


def test_validate_job_against_columns(spark, table):
    nested = spark.range(1).select(F.struct(F.col("id").alias("x")).alias("n"))
    columns = source_schema(
        spark, {("p", "d", "e"): table("embeddings"), ("p", "d", "n"): nested}
    )
    jobs = [
        ("e", "VEC_ID", None),
        ("e", "embedding", "UNORDERABLE_COLUMN"),
        ("e", "nope", "UNKNOWN_COLUMN"),
        ("n", "n.x", None),
        ("n", "n", "UNORDERABLE_COLUMN"),
    ]
    df = spark.createDataFrame(jobs, "table_id string, sort_by string, want string").selectExpr(
        "'p' project_id", "'d' dataset_id", "table_id", "'s' source_table", "'t' target_table",
        "1L amount", "'sorted' sample_type", "sort_by", "'ASC' direction", "want",
    )
    bad = validate_job(df, columns).filter(~F.col("want").eqNullSafe(F.col("job_error")))
    assert bad.count() == 0


def test_errors_have_a_row_each(spark):
    rows = [("p", "hot", f"t{i}", f"e{i:04d}") for i in range(500)]
    rows += [("p", "cold", "t", "z"), ("p", "cold", "t", "a"), ("p", "fine", "v", None), (None, None, None, "lost")]
    df = spark.createDataFrame(rows, "project_id string, dataset_id string, table_id string, error string")
    got = errors_per_cycle(df).collect()
    cold = sorted((r.error, r.position, r.n_errors) for r in got if r.dataset_id == "cold")
    assert cold == [("a", 1, 2), ("z", 2, 2)]
    hot = [r for r in got if r.dataset_id == "hot"]
    assert {r.n_errors for r in hot} == {500} and sorted(r.error for r in hot) == [r[3] for r in rows[:500]]
    assert [(r.error, r.n_errors) for r in got if r.dataset_id is None] == [("lost", 1)]


def test_dry_runs(config):
    policies, requests, default = config
    report = {key_of(r): r for r in policy_request_dry_run(policies, requests, default).collect()}
    assert len(report) == 8
    assert not report["shop.sales.vouchers"].has_policy
    assert tuple(report["shop.sales.refunds"]["size"]) == (None, 50.0)
    plan = sample_request_dry_run(policies, requests, default, counts_for(requests, 40))
    granted = {key_of(r): r.granted for r in plan.collect()}
    assert granted["shop.sales.refunds"] == 9
    assert "shop.sales.vouchers" not in granted


def test_records(spark):
    jobs = spark.createDataFrame(
        [("s1", "t1", "random", 5, None), ("s2", "t2", "sorted", 6, "BAD_ORDER"),
         ("s3", "t3", "random", 0, None)],
        "source_table string, target_table string, sample_type string, granted bigint, error_code string",
    )
    inserted = spark.createDataFrame([("s1", 5)], "source_table string, row_count bigint")
    log = {r.source_table: r for r in run_log(jobs, inserted, 7, F.lit(1), F.lit(2)).collect()}
    assert (log["s1"].amount_inserted, log["s1"].error_message) == (5, "")
    assert (log["s2"].amount_inserted, log["s2"].error_message) == (None, "BAD_ORDER")
    assert log["s3"].amount_inserted == 0
    letters = dead_letter(jobs, ["source_table", "granted", "error_code"], "error_code").collect()
    assert [r.command for r in letters] == ['{"source_table":"s2","granted":6,"error_code":"BAD_ORDER"}']
    assert letters[0].message.endswith(" BAD_ORDER")
