"""Whole cycles on a local catalog: config and source changes and what becomes of the samples."""

import os
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

import buckets
from sampleward.functions.text import valid_identifier
from sampleward.operators.sampling import sorted_sample
from sampleward.operators.tables import (
    create_schema,
    cross_location_copy,
    drop_column,
    drop_empty_schemas,
    drop_orphan_staging,
    drop_versions,
    full_refresh_targets,
    leased,
    new_version,
    sample_labels,
    table_location,
    write_sample,
)
from sampleward.plans import cycle as cycle_module
from sampleward.plans.cycle import run_cycle, run_orders, sample_by_spec
from sampleward.schemas import ORDER
from sampleward.settings import CycleConfig
from sampleward.sources.config_objects import scan_config_objects
from sampleward.sources.catalog import (
    dataset_locations,
    list_schemas,
    list_tables,
    schema_properties,
    table_labels,
    table_names,
)

DEFAULT = {
    "limit": buckets.size(14, 2.75),
    "default_sample": {"size": buckets.size(6), "spec": buckets.spec("random")},
}
WIDE = {
    "limit": buckets.size(180_000, 45.5),
    "default_sample": {"size": buckets.size(210), "spec": buckets.spec("random")},
}


class World:
    """A source schema with two tables, its config and its targets."""

    def __init__(self, spark, table, root):
        name = uuid.uuid4().hex[:8]
        self.spark = spark
        self.dataset = f"src_{name}"
        self.root = root
        self.policies, self.requests = str(root / "policies"), str(root / "requests")
        create_schema(spark, self.dataset, str(root / "source"), {"data_location": "EU"})
        table("orders").write.saveAsTable(f"{self.dataset}.orders")
        table("customer").write.saveAsTable(f"{self.dataset}.customer")
        buckets.write(self.policies, "default_policy.json", DEFAULT)
        os.makedirs(self.requests, exist_ok=True)
        self.policy("orders", "")
        self.policy("customer", WIDE)
        self.config = CycleConfig(
            policy_root=self.policies,
            request_root=self.requests,
            target_project="target",
            target_root=str(root / "target"),
            target_location="EU",
            target_schema_prefix=f"smp{name}_",
            staging_prefix=f"stg{name}_",
            log_schema=f"log_{name}",
            attempts=2,
            retry_wait=(0.0, 0.0),
            parallelism=3,
        )

    def policy(self, table, content):
        buckets.write(self.policies, f"prod/{self.dataset}/{table}.json", content)

    def request(self, table, content):
        buckets.write(self.requests, f"prod/{self.dataset}/{table}.json", content)

    def remove_policy(self, table):
        os.remove(f"{self.policies}/prod/{self.dataset}/{table}.json")

    def run(self, **kwargs):
        return run_cycle(self.spark, kwargs.pop("config", self.config), 1000, **kwargs)

    def sample(self, table):
        name = f"{self.config.target_schema(self.dataset)}.{table}"
        return self.spark.table(name) if self.spark.catalog.tableExists(name) else None

    def rows(self, table):
        df = self.sample(table)
        return None if df is None else df.count()


@pytest.fixture
def world(spark, table, tmp_path):
    return World(spark, table, tmp_path)


def test_policy_and_request_changes(world):
    world.request("orders", {"size": buckets.size(1000)})
    result = world.run()
    assert result.status == "DONE"
    assert world.rows("orders") == 14  # capped by the default policy: min(14, 2.75 % of 1500)
    assert world.rows("customer") == 68  # 45.5 % of 150
    schema = world.config.target_schema(world.dataset)
    labels = table_labels(world.spark, schema, "orders")
    assert labels["sample_table"] == "true" and labels["source_project_id"] == "prod"
    assert labels["source_location"] == "EU"
    assert schema_properties(world.spark, schema)["sample_table"] == "true"

    # Specific policy widens; the request is sorted.
    world.policy("orders", WIDE)
    world.request(
        "orders",
        {"size": buckets.size(100), "spec": buckets.spec("sorted", "o_totalprice", "DESC")},
    )
    world.run()
    want = sorted_sample(
        world.spark.table(f"{world.dataset}.orders"), 100, "o_totalprice", "DESC"
    )
    assert world.sample("orders").exceptAll(want).count() == 0
    assert world.rows("orders") == 100

    # Invalid policy: default again. Invalid request: sample of the policy.
    world.policy("orders", "{limit: 3}")
    world.run()
    assert world.rows("orders") == 14
    world.policy("orders", WIDE)
    world.request("orders", "{size: 3}")
    world.run()
    assert world.rows("orders") == 210

    # Policy removed: the sample disappears, the other stays.
    world.remove_policy("orders")
    result = world.run()
    assert world.rows("orders") is None and world.rows("customer") == 68
    assert f"{schema}.orders" in result.dropped


def test_schema_changes_and_lock(world):
    spark = world.spark
    world.run()
    schema = world.config.target_schema(world.dataset)
    spark.sql(f"ALTER TABLE {schema}.orders ADD COLUMNS (extra STRING)")
    assert "extra" in spark.table(f"{schema}.orders").columns
    world.run()
    assert "extra" not in world.sample("orders").columns

    # Locked: nothing changes although the source and its policy did.
    buckets.write(world.requests, "sampling.lock", "")
    spark.sql(f"ALTER TABLE {world.dataset}.orders ADD COLUMNS (more STRING)")
    world.policy("orders", WIDE)
    assert world.run().status == "LOCKED"
    assert world.rows("orders") == 6 and "more" not in world.sample("orders").columns
    os.remove(f"{world.requests}/sampling.lock")
    world.run()
    assert world.rows("orders") == 210 and "more" in world.sample("orders").columns


def test_removed_source_and_bad_jobs_do_not_stop_others(world):
    world.run()
    assert world.rows("orders") == 6
    world.spark.sql(f"DROP TABLE {world.dataset}.orders")
    world.request(
        "customer", {"size": buckets.size(9), "spec": buckets.spec("sorted", "c_name", "ASC")}
    )
    world.policy("ghost", {"default_sample": {"spec": {"type": "sorted", "properties": 3}}})
    result = world.run()
    assert world.rows("orders") is None
    assert world.rows("customer") == 9
    log = {r.source_table.split(".")[-1].split("@")[0]: r for r in result.log.collect()}
    assert log["orders"].error_message == "MISSING_SOURCE"
    assert log["ghost"].error_message == "MISSING_SOURCE"
    assert log["customer"].amount_inserted == 9 and log["customer"].error_message == ""
    assert [(r.error, r.n_errors) for r in result.errors.collect()] == [("MISSING_SOURCE", 2)] * 2
    runs = world.spark.table(f"{world.config.log_schema}.sample_runs")
    assert runs.count() == 2 + 3
    assert world.spark.table(f"{world.config.log_schema}.sample_errors").count() == 2

    world.request(
        "customer", {"spec": buckets.spec("sorted", "no_such_column", "ASC")}
    )
    codes = {r.error_message for r in world.run().log.collect()}
    assert codes == {"MISSING_SOURCE", "UNKNOWN_COLUMN"}
    # Nothing was sampled: the labelled schema is empty and goes away too.
    assert not list_schemas(world.spark, world.config.target_schema_prefix)


def test_zero_request_leaves_an_empty_table(world):
    world.request("orders", {"size": buckets.size(0)})
    world.run()
    assert world.rows("orders") == 0
    source = world.spark.table(f"{world.dataset}.orders")
    assert world.sample("orders").schema == source.schema


def test_other_location_goes_through_staging(world):
    from dataclasses import replace

    config = replace(
        world.config,
        target_location="US",
        location_roots={"EU": str(world.root / "eu")},
    )
    create_schema(world.spark, f"{config.staging_prefix}old", str(world.root / "eu"), {"a": "b"})
    result = world.run(config=config)
    assert world.rows("customer") == 68
    assert {r.error_message for r in result.log.collect()} == {""}
    assert not list_schemas(world.spark, config.staging_prefix)


def test_prefix_run_touches_one_table(world):
    world.run()
    world.policy("orders", WIDE)
    world.policy("customer", "")
    world.run(prefix=f"prod/{world.dataset}/orders.json")
    assert world.rows("orders") == 210 and world.rows("customer") == 68


def test_failures_are_retried(world, monkeypatch):
    from sampleward.plans import cycle

    calls = []
    real = cycle._sample_table

    def flaky(config, df, row, seed):
        calls.append(row.table_id)
        if calls.count(row.table_id) == 1:
            raise RuntimeError("passing failure")
        return real(config, df, row, seed)

    monkeypatch.setattr(cycle, "_sample_table", flaky)
    world.run()
    assert world.rows("orders") == 6 and calls.count("orders") == 2

    def wrong(config, df, row, seed):
        calls.append("final")
        raise ValueError("wrong in itself")

    monkeypatch.setattr(cycle, "_sample_table", wrong)
    calls.clear()
    result = world.run()
    assert calls == ["final"] * 2
    assert all("wrong in itself" in r.error_message for r in result.log.collect())


def test_write_append_copy_and_labels(spark, table, tmp_path):
    schema = f"w{uuid.uuid4().hex[:8]}"
    create_schema(spark, schema, str(tmp_path), {"sample_table": "true"})
    labels = sample_labels({"team": "o'x", "sample_table": "no"}, "p", None)
    assert labels["sample_table"] == "true"
    nation = table("nation")
    write_sample(nation.limit(5), schema, "n", labels)
    assert write_sample(nation.limit(5), schema, "n", labels, recreate=False).count() == 10
    assert write_sample(nation.limit(3), schema, "n", labels).count() == 3
    assert table_labels(spark, schema, "n")["team"] == "o'x"
    copied = cross_location_copy(
        nation, f"{schema}_st", str(tmp_path / "st"), schema, "m", labels
    )
    assert copied.count() == 25 and not list_schemas(spark, f"{schema}_st")
    tables = list_tables(spark, "target", schema)
    assert {r.table_id for r in tables.collect()} == {"n", "m"}
    current = tables.filter("table_id = 'n'")
    assert [r.table_id for r in full_refresh_targets(tables, current).collect()] == ["m"]
    assert full_refresh_targets(tables, current, {"team": "other"}).count() == 0
    assert drop_empty_schemas(spark, schema) == []
    spark.sql(f"DROP TABLE {schema}.n")
    spark.sql(f"DROP TABLE {schema}.m")
    assert drop_empty_schemas(spark, schema) == [schema]
    create_schema(spark, f"{schema}_left", str(tmp_path), {"x": "y"})
    assert drop_orphan_staging(spark, schema) == [f"{schema}_left"]


def test_failed_copy_keeps_staging(spark, table, tmp_path):
    schema = f"f{uuid.uuid4().hex[:8]}"
    with pytest.raises(Exception):
        cross_location_copy(
            table("nation"), f"{schema}_st", str(tmp_path), f"{schema}_absent", "n", {"a": "b"}
        )
    assert list_schemas(spark, f"{schema}_st") == [f"{schema}_st"]


def test_sample_by_spec_and_drop_column(table):
    orders = table("orders")
    assert sample_by_spec(orders, "random", 7, 1500).count() == 7
    assert sample_by_spec(orders, "random", 7, 0).count() == 0
    assert 0 < sample_by_spec(orders, "random", 700, 1500, by_block=True).count() <= 700
    with pytest.raises(ValueError):
        sample_by_spec(orders, "other", 7, 1500)
    assert "o_custkey" not in drop_column(orders, "O_CUSTKEY").columns
    with pytest.raises(ValueError):
        drop_column(orders, "none")
    assert orders.select(F.count(F.lit(1))).first()[0] == 1500


def test_broken_table_and_colliding_targets_do_not_stop_others(world):
    spark, dataset = world.spark, world.dataset
    spark.sql(f"CREATE VIEW {dataset}.broken AS SELECT raise_error('no') AS a FROM {dataset}.orders")
    world.policy("broken", {})
    world.policy("ORDERS", {})
    log = {r.source_table.split(".")[-1].split("@")[0]: r for r in world.run().log.collect()}
    assert log["customer"].error_message == ""
    assert log["orders"].error_message == log["ORDERS"].error_message == "TARGET_COLLISION"
    assert log["broken"].error_message not in ("", "TARGET_COLLISION")


def test_seeds_differ_by_table_and_cycle():
    from sampleward.plans.cycle import draw_seed

    keys = [("p", "d", "a"), ("p", "d", "b")]
    assert len({draw_seed(7, ts, key) for ts in (1, 2) for key in keys}) == 4
    assert draw_seed(7, 1, keys[0]) == draw_seed(7, 1, keys[0])
    assert draw_seed(None, 1, keys[0]) != draw_seed(None, 1, keys[0])


def order(route, stamp, **fields):
    return tuple((dict.fromkeys(ORDER.fieldNames()) | {"order_id": f"{route}{stamp}{fields}", "route": route, "timestamp": stamp} | fields).values())


def test_orders_of_a_batch_are_one_plan(spark, world, monkeypatch):
    listed, read = [], cycle_module.scan_config_objects
    monkeypatch.setattr(
        cycle_module, "scan_config_objects",
        lambda s, root, prefix="", *a, **k: (listed.append((prefix, k.get("exact", False))), read(s, root, prefix, *a, **k))[1],
    )
    here = {"project_id": "prod", "dataset_id": world.dataset}
    target = {"target_project": "target", "target_dataset": world.dataset}
    folder = f"prod/{world.dataset}/"
    rows = [
        order("SAMPLE_POLICY_PREFIX", 100, prefix=f"{folder}cust"),
        order("SAMPLE_POLICY_PREFIX", 300, prefix=f"{folder}customer"),
        order("SAMPLE_POLICY_PREFIX", 400, prefix="prod/nowhere/"),
    ]
    for i in range(20):  # as sent, the latest of all
        size = {"count": 7 + i, "percentage": None}
        spec = {"type": "sorted", "properties": {"by": "o_totalprice", "direction": "DESC"}}
        rows.append(order("SAMPLE_START", 500 + i, **here, table_id="orders", size=size, spec=spec, **target, target_id="orders"))
    rows += [
        order("SAMPLE_START", 600, **here, table_id="orders", size={"count": 10**6, "percentage": None}, **target, target_id="other"),
        order("SAMPLE_START", 700, **here, table_id="customer", **target | {"target_project": "foreign"}, target_id="x"),
        order("SAMPLE_START", 800, **here, table_id="gone", **target, target_id="gone"),
    ]
    result = run_orders(spark, world.config, spark.createDataFrame(rows, ORDER))
    # The lock and the default policy are looked up, both roots are listed once.
    assert sorted(listed) == sorted([("sampling.lock", True), ("default_policy.json", True), ("prod/", False), ("prod/", False)])
    got = [r.o_totalprice for r in world.sample("orders").collect()]
    want = [r.o_totalprice for r in sorted_sample(spark.table(f"{world.dataset}.orders"), 14, "o_totalprice", "DESC").collect()]
    assert sorted(got) == sorted(want)  # 26 asked for, 14 granted by the default policy
    assert world.sample("other").count() == 14 and world.sample("customer").count() == 68
    log = {(r.cycle_ts, r.target_table.split(".")[2].split("@")[0]): r for r in result.log.collect()}
    assert set(log) == {(t, "customer") for t in (100, 300)} | {(500 + i, "orders") for i in range(20)} | {
        (600, "other"), (700, "x"), (800, "gone")
    }
    assert log[100, "customer"].amount_inserted == log[300, "customer"].amount_inserted == 68
    commands = {r.timestamp: r for r in result.commands.collect()}
    assert (commands[400].jobs, commands[100].jobs, commands[519].failed) == (0, 1, 0)
    assert (commands[700].error, commands[800].error) == ("FOREIGN_TARGET", "MISSING_SOURCE")
    assert spark.table(f"{world.config.log_schema}.command_runs").count() == len(rows)


def test_starts_of_one_batch_are_all_logged(spark, world):
    rows = [order("START", t) for t in (100, 200)] + [order("SAMPLE_POLICY_PREFIX", 50, prefix=f"prod/{world.dataset}/")]
    result = run_orders(spark, world.config, spark.createDataFrame(rows, ORDER))
    assert sorted((r.cycle_ts, r.target_table.split(".")[2]) for r in result.log.collect()) == [
        (t, f"{name}@EU") for t in (50, 100, 200) for name in ("customer", "orders")
    ]


def test_dataset_that_cannot_be_described_stops_no_other(spark, world):
    found = dataset_locations(spark, {("prod", world.dataset): world.dataset, ("else", "no`where"): "no`where"}, {"else": "nocat"})
    assert sorted(map(tuple, found.collect()), key=str) == [("else", "no`where", None), ("prod", world.dataset, "EU")]
    buckets.write(world.policies, "prod/odd`set/orders.json", "")
    errors = {r.table_id: r.error for r in world.run().errors.collect()}
    assert errors == {"orders": "MISSING_SOURCE"} and world.sample("orders").count() == 6


def test_ids_that_are_no_table_names(spark, world, monkeypatch):
    # In a catalog of its own, a table may be called or-ders; its sample lies in one that knows letters, digits and _ only.
    named = CycleConfig.source_name
    monkeypatch.setattr(CycleConfig, "source_name", lambda self, p, d, t: named(self, p, d, t.replace("-", "")))
    world.policy("or-ders", "")
    for _ in range(2):  # the second cycle finds it and keeps it
        result = world.run()
        assert result.errors.count() == 0 and result.dropped == ()
        assert world.rows("or_ders") == world.rows("orders") == 6
    assert {r.target_table for r in result.log.collect()} == {
        f"target.{world.dataset}.{name}@EU" for name in ("orders", "or-ders", "customer")
    }
    world.policy("Cust-omer", "")
    here = {"project_id": "prod", "dataset_id": world.dataset, "target_project": "target", "target_dataset": world.dataset}
    rows = [
        order("SAMPLE_START", 600, **here, table_id="orders", target_id="top-orders"),
        order("SAMPLE_START", 700, **here, table_id="customer", target_id="top_orders"),
        order("SAMPLE_START", 800, **here, table_id="customer", target_id="né-w", size={"count": 500, "percentage": None}),
    ]
    commands = run_orders(spark, world.config, spark.createDataFrame(rows, ORDER)).commands.collect()
    assert {r.timestamp: r.error for r in commands} == {600: "TARGET_COLLISION", 700: "TARGET_COLLISION", 800: None}
    assert world.sample("top_orders") is None and world.rows("n__w") == 68
    world.remove_policy("or-ders")
    dropped = world.run().dropped
    assert any(name.endswith(".or_ders") for name in dropped) and world.sample("or_ders") is None


def test_target_schemas_are_named_as_identifiers(spark, world):
    names = ["Sales", "my-set", "é.x", "K\u212a", "x" * 2000, "a`b"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(
        valid_identifier(F.concat(F.lit(world.config.target_schema_prefix), "n"))
    )
    assert [r[0] for r in got.collect()] == [world.config.target_schema(n) for n in names]


def test_whole_cycles_report_orphan_requests(spark, world):
    world.request("vouchers", {"size": buckets.size(4)})
    assert [(r.table_id, r.error) for r in world.run().errors.collect()] == [("vouchers", "ORPHAN_REQUEST")]
    assert world.run(prefix=f"prod/{world.dataset}/orders").errors.count() == 0


def test_one_object_is_looked_up_alone(spark, world):
    buckets.write(world.policies, "default_policy.json.bak", {})
    one = scan_config_objects(spark, world.policies, "default_policy.json", exact=True)
    assert [r.path for r in one.collect()] == ["default_policy.json"]
    assert scan_config_objects(spark, world.policies, "default_policy", exact=True).count() == 0
    assert scan_config_objects(spark, world.policies, "prod", exact=True).count() == 0


@pytest.fixture
def target(spark, tmp_path):
    schema = f"v{uuid.uuid4().hex[:8]}"
    create_schema(spark, schema, str(tmp_path / "target"), {"sample_table": "true"})
    return schema


def test_a_reader_never_misses_a_sample_that_is_refreshed(spark, table, target):
    orders = table("orders").limit(40)
    write_sample(orders, target, "o", {"a": "0"})
    held, counts, errors, stop = spark.table(f"{target}.o"), [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                counts.append(spark.table(f"{target}.o").count())
            except Exception as error:  # noqa: BLE001 - looked at below
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        df = orders.limit(40 + n).withColumn("more", F.lit(n)) if n > 2 else orders
        write_sample(df, target, "o", {"a": str(n)})
    stop.set()
    reader.join()
    assert not errors and counts and set(counts) == {40}
    # Who has held the table since before the refreshes can still read it.
    assert held.count() == 40 and "more" in spark.table(f"{target}.o").columns
    assert table_labels(spark, target, "o")["a"] == "5"
    assert [r.table_id for r in list_tables(spark, "p", target).collect()] == ["o"]


def test_old_versions_go_and_the_live_one_stays(spark, table, target):
    nation = table("nation")
    for n in (3, 4, 5):
        write_sample(nation.limit(n), target, "n", {"a": "b"}, keep_seconds=-10)
    assert len(table_names(spark, target)) == 2 and spark.table(f"{target}.n").count() == 5
    # A switch that was cut short: the version still names the place of the live sample.
    lost = new_version("n")
    nation.limit(1).write.saveAsTable(f"{target}.{lost}")
    spark.sql(f"ALTER TABLE {target}.{lost} SET LOCATION '{table_location(spark, f'{target}.n')}'")
    drop_versions(spark, target, "n")
    assert table_names(spark, target) == ["n"] and spark.table(f"{target}.n").count() == 5
    # Other columns, then a table that somebody has dropped.
    write_sample(table("region"), target, "n", {"a": "b"})
    assert spark.table(f"{target}.n").columns == table("region").columns
    write_sample(nation.limit(2), target, "n", {"a": "b"})
    spark.sql(f"DROP TABLE {target}.n")
    assert write_sample(nation.limit(6), target, "n", {"a": "b"}).count() == 6
    assert write_sample(nation.limit(2), target, "n", {"a": "b"}, recreate=False).count() == 8


def test_leased_staging_is_not_swept(spark, tmp_path):
    prefix = f"l{uuid.uuid4().hex[:8]}"
    for name, labels in (("busy", leased({"a": "b"}, 60)), ("over", leased({}, -1)), ("old", {"a": "b"})):
        create_schema(spark, f"{prefix}_{name}", str(tmp_path), labels)
    assert sorted(drop_orphan_staging(spark, prefix)) == [f"{prefix}_old", f"{prefix}_over"]
    assert list_schemas(spark, prefix) == [f"{prefix}_busy"]


def test_a_repeated_batch_replaces_its_records(spark, world):
    rows = [order("START", 100), order("SAMPLE_START", 200, project_id="prod", dataset_id="gone", table_id="t",
            target_project="target", target_dataset="gone", target_id="t")]
    orders = spark.createDataFrame(rows, ORDER)
    names = ("sample_runs", "sample_errors", "command_runs")

    def counts():
        return [spark.table(f"{world.config.log_schema}.{name}").count() for name in names]

    run_orders(spark, world.config, orders, "stream-7")
    assert counts() == [3, 1, 2]
    run_orders(spark, world.config, orders, "stream-7")
    assert counts() == [3, 1, 2]
    # The repeat has no error: what the first attempt left goes too.
    run_orders(spark, world.config, orders.filter("route = 'START'"), "stream-7")
    assert counts() == [2, 0, 1]
    run_orders(spark, world.config, orders, "stream-8")
    assert counts() == [5, 1, 3]
    run_log = {r.target_table.split(".")[2]: r.amount_inserted for r in spark.table(f"{world.config.log_schema}.sample_runs").collect() if r.error_message == ""}
    assert run_log == {"orders@EU": 6, "customer@EU": 68}
