"""Commands and alerts: streams give what the same call gives on a table."""

import base64
import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sampleward.plans.cycle import CycleResult
from sampleward.sources.commands import command_stream, read_messages
from sampleward.streaming import commands as commands_module
from sampleward.streaming.alerts import error_alert, missed_cycle_alert
from sampleward.streaming.commands import (
    idempotent_commands,
    route_commands,
    run_command_stream,
    transfer_notification,
)
from sampleward.streaming.repeats import first_deliveries, step_function

STAMP = "2022-10-07T11:01:38.5Z"
RUN = "projects/P/locations/L/transferConfigs/C/runs/R"
REF = {"project_id": "p", "dataset_id": "d", "table_id": "t"}
START = {"sample_request": {"table_reference": REF, "sample": {}}, "target_table": REF}
DONE = {**START, "start_timestamp": 1, "end_timestamp": 2, "error_message": ""}
NOTICE = {
    "name": RUN,
    "dataSourceId": "cross_region_copy",
    "params": {"source_project_id": "p", "source_dataset_id": "d"},
    "state": "SUCCEEDED",
}


def without(value, *keys):
    return {k: v for k, v in value.items() if k not in keys}


ROUTES = [
    ({"type": "START"}, "START", None),
    ({"type": " start "}, "START", None),
    ({"type": "SAMPLE_POLICY_PREFIX", "prefix": "a/b/"}, "SAMPLE_POLICY_PREFIX", None),
    ({"type": "SAMPLE_POLICY_PREFIX"}, None, "BAD_FIELDS"),
    ({"type": "SAMPLE_START", **START}, "SAMPLE_START", None),
    ({"type": "SAMPLE_START", **without(START, "target_table")}, None, "BAD_FIELDS"),
    (
        {"type": "SAMPLE_START", **START, "target_table": {**REF, "location": 5}},
        None,
        "BAD_FIELDS",
    ),
    ({"type": "SAMPLE_DONE", **DONE, "amount_inserted": 0}, "SAMPLE_DONE", None),
    ({"type": "SAMPLE_DONE", **DONE, "amount_inserted": -1}, None, "BAD_FIELDS"),
    ({"type": "SAMPLE_DONE", **without(DONE, "error_message")}, None, "BAD_FIELDS"),
    ({"type": "SAMPLE_DONE", **DONE, "end_timestamp": 0}, None, "BAD_FIELDS"),
    ({"type": "REMOVE_DATASET", "project_id": "p", "dataset_id": "d"}, "REMOVE_DATASET", None),
    ({"type": "REMOVE_DATASET", "project_id": "p"}, None, "BAD_FIELDS"),
    (
        {"type": "TRANSFER_RUN_DONE", "name": "c", "payload": NOTICE},
        "TRANSFER_RUN_DONE",
        None,
    ),
    ({"type": "TRANSFER_RUN_DONE", "name": "c"}, None, "BAD_FIELDS"),
    (NOTICE, "TRANSFER_RUN_DONE", None),
    ({**NOTICE, "type": "odd"}, "TRANSFER_RUN_DONE", None),
    ({**NOTICE, "type": 5}, None, "UNKNOWN_TYPE"),
    ({**NOTICE, "name": "projects/P/runs/R"}, None, "UNKNOWN_TYPE"),
    (without(NOTICE, "params"), None, "UNKNOWN_TYPE"),
    ({"type": "other"}, None, "UNKNOWN_TYPE"),
    ({}, None, "UNKNOWN_TYPE"),
    ([1], None, "NOT_AN_OBJECT"),
    ("text", None, "NOT_AN_OBJECT"),
]


def encode(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return base64.b64encode(text.encode()).decode()


def messages(spark, bodies, stamp=STAMP):
    rows = [(i, encode(json.dumps(b)), stamp) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "i int, data string, publish_time string")


def test_routes(spark):
    routed = route_commands(command_stream(messages(spark, [r[0] for r in ROUTES])))
    got = routed.orderBy("i").select("route", "error", "timestamp").collect()
    for row, (body, route, error) in zip(got, ROUTES, strict=True):
        assert (row.route, row.error) == (route or "DEAD_LETTER", error), body
        assert row.timestamp == 1665140498


def test_undecodable_messages(spark):
    bad = [("!!!", STAMP), (base64.b64encode(b"\xff").decode(), STAMP), (encode("{x"), STAMP)]
    bad += [(None, STAMP), (encode('{"type":"START"}'), "yesterday"), (encode('{"type":"START"}'), None)]
    df = spark.createDataFrame(bad, "data string, publish_time string")
    errors = [r.error for r in route_commands(command_stream(df)).collect()]
    assert errors == ["BAD_PAYLOAD"] * 4 + ["BAD_TIMESTAMP"] * 2


def test_transfer_notifications(spark):
    bodies = [NOTICE, {**NOTICE, "state": "FAILED"}, {"type": "START"}]
    bodies += [{"type": "transfer_run_done", "name": "cfg", "payload": NOTICE}]
    rows = transfer_notification(command_stream(messages(spark, bodies))).orderBy("i").collect()
    assert [r.i for r in rows] == [0, 1, 3]
    assert [r.config_name for r in rows] == [RUN.split("/runs/")[0]] * 2 + ["cfg"]
    assert [r.next_command for r in rows] == ["REMOVE_DATASET", None, "REMOVE_DATASET"]
    assert [r.error for r in rows] == [None, "TRANSFER_NOT_SUCCEEDED", None]
    assert {(r.source_project_id, r.source_dataset_id) for r in rows} == {("p", "d")}


def drain(stream, checkpoint, name, mode="append"):
    query = (
        stream.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert query.exception() is None
    return stream.sparkSession.table(name)


@pytest.fixture
def deliveries(spark, tmp_path):
    """Commands delivered up to three times within ten minutes, one of them very often."""
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(60):
        key = "hot" if i % 3 == 0 else f"t{i}"
        for repeat in range(1 + i % 3):
            ts = base + timedelta(seconds=0 if key == "hot" else i, minutes=3 * repeat)
            rows.append((1, key, ts, f"{i}-{repeat}"))
    df = spark.createDataFrame(rows, "cycle_ts bigint, table_id string, ts timestamp, note string")
    path = str(tmp_path / "deliveries")
    df.coalesce(1).write.parquet(path)
    return path, df


def test_repeats_stream_equals_batch(spark, deliveries, tmp_path):
    path, df = deliveries
    keys = ["cycle_ts", "table_id"]
    stream = spark.readStream.schema(df.schema).parquet(path)
    streamed = drain(idempotent_commands(stream, keys, "ts"), tmp_path / "c", "repeats")
    batch = idempotent_commands(df, keys, "ts")
    assert streamed.select(*keys).exceptAll(batch.select(*keys)).count() == 0
    assert streamed.count() == batch.count() == 41
    first = batch.filter("table_id = 'hot'").first()
    assert (first.ts, first.note) == (datetime(2024, 1, 1), "0-0")


def test_error_alert_stream_equals_batch(spark, table, tmp_path):
    events = table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = events.agg(F.max("ts") + F.expr("interval 3 hours")).first()[0]
    tail = events.limit(1).withColumn("ts", F.lit(late)).withColumn("event_type", F.lit("error"))
    path = str(tmp_path / "events")
    events.orderBy("ts").coalesce(1).write.parquet(path)
    tail.coalesce(1).write.mode("append").parquet(path)
    is_error = F.col("event_type") == "error"
    stream = spark.readStream.schema(events.schema).parquet(path)
    streamed = drain(error_alert(stream, "ts", is_error), tmp_path / "c", "alerts")
    batch = error_alert(events, "ts", is_error)
    assert batch.exceptAll(streamed).count() == 0
    assert streamed.exceptAll(batch).count() == 0
    hourly = {}
    for row in events.filter(is_error).collect():
        hour = row.ts.replace(minute=0, second=0, microsecond=0)
        hourly[hour] = hourly.get(hour, 0) + 1
    assert {r.window_start: r.n_errors for r in batch.collect()} == hourly


def test_missed_cycles(spark):
    days = [1, 2, 4, 8]
    rows = [("a", datetime(2024, 1, d, 23)) for d in days] + [("b", datetime(2024, 1, 5))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    missed = {(r.k, r.day.day) for r in missed_cycle_alert(df, "ts", ["k"]).collect()}
    assert missed == {("a", d) for d in (3, 5, 6, 7)} | {
        ("b", d) for d in range(1, 9) if d != 5
    }
    bounded = missed_cycle_alert(
        df, "ts", ["k"], F.lit("2024-01-08").cast("date"), F.lit("2024-01-09").cast("date")
    )
    assert bounded.count() == 3


def run_batch(spark, tmp_path, bodies, config, name):
    folder = tmp_path / name
    os.makedirs(folder)
    with open(folder / "a.json", "w") as out:
        for body in bodies:
            data = encode(body) if isinstance(body, dict) else body
            out.write(json.dumps({"data": data, "publish_time": STAMP}) + "\n")
    for _ in range(2):
        query = run_command_stream(
            spark, config, str(folder), str(tmp_path / f"{name}-c"), str(tmp_path / f"{name}-dead")
        )
        query.awaitTermination(120)
        assert query.exception() is None
    assert read_messages(spark, str(folder)).isStreaming
    return spark.read.json(str(tmp_path / f"{name}-dead"))


def test_command_stream_runs_each_command_once(spark, tmp_path, monkeypatch):
    calls, dropped, batches = [], [], []

    def run(session, config, orders, batch):
        batches.append(batch)
        calls.append(sorted((o.route, o.timestamp, o.prefix, o.table_id, o.target_dataset) for o in orders.collect()))
        commands = orders.selectExpr("order_id", "route", "timestamp", "1L AS jobs", "1L AS failed", "'BROKEN' AS error")
        return CycleResult("DONE", commands=commands)

    def drop(session, name):
        dropped.append(name)
        if name == "stg_stuck":
            raise RuntimeError("this one fails")

    monkeypatch.setattr(commands_module, "run_orders", run)
    monkeypatch.setattr(commands_module, "drop_schema_cascade", drop)
    config = type("Config", (), {"staging_prefix": "stg_"})()
    failed = {**NOTICE, "state": "FAILED"}
    bodies = [
        {"type": "SAMPLE_POLICY_PREFIX", "prefix": "p/d/"},
        {"type": "SAMPLE_POLICY_PREFIX", "prefix": "p/d/"},
        {"type": "SAMPLE_POLICY_PREFIX", "prefix": "p/e/"},
        {"type": "SAMPLE_START", **START},
        {"type": "REMOVE_DATASET", "project_id": "p", "dataset_id": "stg_one"},
        {"type": "REMOVE_DATASET", "project_id": "p", "dataset_id": "stg_stuck"},
        {"type": "REMOVE_DATASET", "project_id": "p", "dataset_id": "production"},
        {**NOTICE, "params": {"source_project_id": "p", "source_dataset_id": "stg_two"}},
        failed,
        {"type": "nonsense"},
        "???one", "???two", "???three",
    ]
    letters = run_batch(spark, tmp_path, bodies, config, "narrow").collect()
    stamp = 1665140498
    assert calls == [[
        ("SAMPLE_POLICY_PREFIX", stamp, "p/d/", None, None), ("SAMPLE_POLICY_PREFIX", stamp, "p/e/", None, None),
        ("SAMPLE_START", stamp, None, "t", "d"),
    ]]
    assert len(batches) == 1 and batches[0].endswith("-0")
    assert sorted(dropped) == ["stg_one", "stg_stuck", "stg_two"]
    errors = sorted(r.error for r in letters)
    # A wide command whose tables failed has their errors in the log, a single one is a dead letter.
    assert errors == ["BAD_PAYLOAD"] * 3 + ["BROKEN", "RuntimeError: this one fails", "TRANSFER_NOT_SUCCEEDED", "UNKNOWN_TYPE"]
    lost = {json.loads(r.command)["data"] for r in letters if r.error == "BAD_PAYLOAD"}
    assert lost == {"???one", "???two", "???three"}
    assert json.loads(json.loads(next(r.command for r in letters if r.error == "BROKEN"))["payload"])["type"] == "SAMPLE_START"

    def broken(session, config, orders, batch):
        raise RuntimeError("no storage")

    monkeypatch.setattr(commands_module, "run_orders", broken)
    letters = run_batch(spark, tmp_path, bodies[:4], config, "broken").collect()
    assert [r.error for r in letters] == ["RuntimeError: no storage"] * 3


def brute_deliveries(rows):
    """Rows (key, time, note): those kept one after the other; one without a time per key."""
    want, kept = [], {}
    for command, at, note in sorted(rows, key=lambda r: (r[1] is not None, r[1] or START_TIME, r[2])):
        place = (command, at is None)
        if place not in kept or (at is not None and at > kept[place] + timedelta(minutes=20)):
            kept[place] = at
            want.append((command, at, note))
    return want


START_TIME = datetime(2024, 1, 1)


def repeated_rows():
    draw = random.Random(4)
    rows = [(k, START_TIME + timedelta(seconds=draw.randrange(400_000)), i) for i, k in enumerate(["hot"] * 900 + ["a", None] * 60)]
    rows += [("b", START_TIME + timedelta(minutes=m), 1000 + m) for m in (0, 20, 21, 40, 41, 42, 300)]
    rows += [("once", START_TIME, 5000), ("soon", START_TIME, 5001), ("soon", START_TIME + timedelta(minutes=19), 5002)]
    rows += [("hot", None, 6001), ("hot", None, 6000), ("never", None, 6002), (None, None, 6003), ("once", START_TIME, 4999)]
    return rows


@pytest.mark.parametrize("range_rows", [10**6, 400, 37, 3])
def test_repeats_beyond_the_delay_count_anew(spark, range_rows):
    rows = repeated_rows()
    df = spark.createDataFrame(rows, "command string, ts timestamp, note long")
    got = [tuple(r) for r in first_deliveries(df, ["command"], "ts", "20 minutes", range_rows).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_deliveries(rows)))
    assert sorted(n - 1000 for c, _, n in got if c == "b") == [0, 21, 42, 300]
    assert first_deliveries(df.limit(0), ["command"], "ts", "20 minutes").count() == 0


def test_repeats_in_rows_of_any_type(spark):
    rows = repeated_rows()
    df = spark.createDataFrame(rows, "command string, ts timestamp, note long").selectExpr(
        "struct(command, 1 AS one) AS command", "ts", "map('note', note) AS by_name", "parse_json(to_json(struct(note))) AS document"
    )
    out = first_deliveries(df, ["command"], "ts", "20 minutes", 100)
    assert out.dtypes == df.dtypes
    got = out.selectExpr("command.command", "ts", "by_name['note']", "variant_get(document, '$.note', 'long')").collect()
    assert all(by_name == note for *_, by_name, note in got)
    assert sorted(str(tuple(r[:2])) for r in got) == sorted(str(r[:2]) for r in brute_deliveries(rows))


def test_steps_of_a_range_are_those_of_its_times():
    draw = random.Random(9)
    for _ in range(200):
        times = sorted(draw.sample(range(100, 400), draw.randrange(1, 60)))
        delay = draw.randrange(1, 80)
        bounds, ends = step_function(times, delay)
        for kept in [*range(20, times[0]), -(10**9)]:
            i = next((i for i, b in enumerate(bounds) if b > kept + delay), None)
            want = kept
            for t in times:
                want = t if t > want + delay else want
            assert (kept if i is None else ends[i]) == want


def test_repeated_commands_of_a_table_equal_the_stream(spark, tmp_path):
    base, folder = datetime(2024, 1, 1), str(tmp_path / "messages")
    rows = []
    for i, (body, _, _) in enumerate(ROUTES):
        for repeat in range(1 + i % 3):
            rows.append((encode(json.dumps(body)), STAMP, base + timedelta(seconds=i, minutes=4 * repeat)))
    spark.createDataFrame(rows, "data string, publish_time string, arrived timestamp").coalesce(1).write.parquet(folder)
    table = command_stream(spark.read.parquet(folder))
    stream = command_stream(spark.readStream.schema("data string, publish_time string, arrived timestamp").parquet(folder))
    keys = ["data", "publish_time"]
    batch = idempotent_commands(table, keys, "arrived")
    assert batch.dtypes == table.dtypes
    streamed = drain(idempotent_commands(stream, keys, "arrived").drop("document"), tmp_path / "c", "command_repeats")
    columns = ["data", "publish_time", "payload", "timestamp"]
    got = sorted(map(str, batch.select(*columns).collect()))
    assert got == sorted(map(str, streamed.select(*columns).collect())) and len(got) == len({r[0] for r in rows})
    assert batch.select("arrived").distinct().count() == len(got)
    assert route_commands(batch).where("error IS NULL").count() == 9
