"""Typed commands: routing, transfer notifications, duplicates, and the loop that acts on them."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sampleward.functions.config_json import (
    MISSING,
    NODES,
    kind,
    node,
    number,
    parse_requests,
    sealed,
    text,
    with_nodes,
)
from sampleward.functions.text import strip
from sampleward.operators.tables import drop_schema_cascade
from sampleward.plans.cycle import run_orders
from sampleward.plans.records import dead_letter
from sampleward.schemas import ORDER, TABLE_KEY
from sampleward.settings import (
    COMMAND_TYPES,
    TRANSFER_OK_STATE,
    CycleConfig,
)
from sampleward.sources.commands import command_stream, read_messages
from sampleward.sources.shared import stage
from sampleward.streaming.repeats import first_deliveries

LOG = logging.getLogger(__name__)

DEAD_LETTER = "DEAD_LETTER"
ORDERED = ["START", "SAMPLE_POLICY_PREFIX", "SAMPLE_START"]
REDELIVERY_WINDOW = "20 minutes"


# Segments of a transfer run's name; None stands for any text without white space.
RUN_SEGMENTS = ["projects", None, "locations", None, "transferConfigs", None, "runs", None]


def is_run_name(name: Column) -> Column:
    """Whether a name has the segments of a transfer run; the last one may hold further slashes."""
    parts = F.split(name, "/", len(RUN_SEGMENTS))
    right = F.size(parts) == len(RUN_SEGMENTS)
    for i, fixed in enumerate(RUN_SEGMENTS):
        part = F.get(parts, F.lit(i))
        right &= (part == fixed) if fixed else ((part != "") & ~part.rlike(r"\s"))
    return F.coalesce(right, F.lit(False))


def config_of_run(run_name: Column) -> Column:
    """Transfer config named in the name of one of its runs, null for any other text."""
    return F.when(is_run_name(run_name), F.substring_index(run_name, "/", 6))


REF_SHAPE = "struct<project_id:variant,dataset_id:variant,table_id:variant,location:variant>"
PARAMS_SHAPE = "struct<source_project_id:variant,source_dataset_id:variant>"
COMMAND_SHAPE = f"""struct<
    type: variant, prefix: variant, project_id: variant, dataset_id: variant,
    sample_request: struct<table_reference: {REF_SHAPE}, sample: variant>,
    target_table: {REF_SHAPE},
    start_timestamp: variant, end_timestamp: variant, error_message: variant,
    amount_inserted: variant, name: variant, dataSourceId: variant, state: variant,
    params: {PARAMS_SHAPE}, payload: struct<state: variant, params: {PARAMS_SHAPE}>
>"""


REF_PARTS = ["project_id", "dataset_id", "table_id", "location"]
COMMAND_LEAVES = [
    "type", "prefix", "project_id", "dataset_id", "sample_request.sample", "start_timestamp",
    "end_timestamp", "error_message", "amount_inserted", "name", "dataSourceId",
    *(f"sample_request.table_reference.{part}" for part in REF_PARTS),
    *(f"target_table.{part}" for part in REF_PARTS),
]
TRANSFER_PARTS = ["state", "params.source_project_id", "params.source_dataset_id"]
TRANSFER_LEAVES = [
    "type", "name", "dataSourceId", *TRANSFER_PARTS, *(f"payload.{part}" for part in TRANSFER_PARTS)
]


def _leaf(path: str) -> str:
    return path.replace(".", "_")


def command_nodes(commands: DataFrame, leaves: list[str]) -> DataFrame:
    """Commands with the nodes of their document; null nodes where it is no object."""
    nodes = F.try_variant_get(F.col("document"), "$", COMMAND_SHAPE)
    named = with_nodes(commands, nodes, {_leaf(path): path for path in leaves})
    return named.withColumn("__given_type", F.upper(strip(text("type")))).withColumn(
        "__type", _command_type()
    )


def _is_string(*paths: str) -> Column:
    return reduce(lambda a, b: a & b, (kind(_leaf(path)) == "STRING" for path in paths))


def _command_type() -> Column:
    """Type of a command in upper case; a transfer notification counts as TRANSFER_RUN_DONE."""
    given = F.col("__given_type")
    notification = (
        _is_string("dataSourceId")
        & node("params").isNotNull()
        & is_run_name(text("name"))
    )
    readable = kind("type").isin(MISSING, "STRING")
    return F.when(given.isin(COMMAND_TYPES), given).when(
        readable & notification, "TRANSFER_RUN_DONE"
    )


def _table_ref(path: str) -> Column:
    names = _is_string(f"{path}.project_id", f"{path}.dataset_id", f"{path}.table_id")
    return names & kind(_leaf(f"{path}.location")).isin(MISSING, "STRING")


def _positive(name: str) -> Column:
    return F.coalesce(number(name) > 0, F.lit(False))


def _fields_valid(command: Column) -> Column:
    sample = (
        _table_ref("sample_request.table_reference")
        & (kind("sample_request_sample") != MISSING)
        & _table_ref("target_table")
    )
    amount = F.coalesce(number("amount_inserted") >= 0, F.lit(False))
    done = (
        _positive("start_timestamp")
        & _positive("end_timestamp")
        & _is_string("error_message")
        & ((kind("amount_inserted") == MISSING) | amount)
    )
    # A notification without a type of its own is complete once it is recognised.
    transfer = ~F.col("__given_type").eqNullSafe(command) | (
        _is_string("name") & node("payload").isNotNull()
    )
    return (
        F.when(command == "SAMPLE_POLICY_PREFIX", _is_string("prefix"))
        .when(command.isin("SAMPLE_START", "SAMPLE_DONE"), sample)
        .when(command == "TRANSFER_RUN_DONE", transfer)
        .when(command == "REMOVE_DATASET", _is_string("project_id", "dataset_id"))
        .otherwise(F.lit(True))
    ) & ((command != "SAMPLE_DONE") | done)


def route_commands(commands: DataFrame) -> DataFrame:
    """Add `type`, `error` and `route`: the type of a valid command, else the dead letters."""
    command = F.col("__type")
    error = (
        F.when(F.col("document").isNull(), "BAD_PAYLOAD")
        .when(F.col(NODES).isNull(), "NOT_AN_OBJECT")
        .when(command.isNull(), "UNKNOWN_TYPE")
        .when(F.coalesce(F.col("timestamp") <= 0, F.lit(True)), "BAD_TIMESTAMP")
        .when(~_fields_valid(command), "BAD_FIELDS")
    )
    checked = command_nodes(commands, COMMAND_LEAVES).withColumn("__error", error)
    route = F.when(F.col("__error").isNull(), command).otherwise(DEAD_LETTER)
    return sealed(
        checked, commands.columns, {"type": command, "error": F.col("__error"), "route": route}
    )


def transfer_notification(commands: DataFrame) -> DataFrame:
    """Finished transfers: their config, state and staging dataset, and what to do next."""
    typed = F.coalesce(F.col("__given_type") == "TRANSFER_RUN_DONE", F.lit(False))

    def field(path: str) -> Column:
        return F.when(typed, text(_leaf(f"payload.{path}"))).otherwise(text(_leaf(path)))

    name = text("name")
    fields = {
        "__type": F.col("__type"),
        "config_name": F.when(typed, name).otherwise(config_of_run(name)),
        "state": field("state"),
        "source_project_id": field("params.source_project_id"),
        "source_dataset_id": field("params.source_dataset_id"),
    }
    succeeded = F.coalesce(F.col("state") == TRANSFER_OK_STATE, F.lit(False))
    return (
        sealed(command_nodes(commands, TRANSFER_LEAVES), commands.columns, fields)
        .filter(F.col("__type") == "TRANSFER_RUN_DONE")
        .drop("__type")
        .withColumn("next_command", F.when(succeeded, "REMOVE_DATASET"))
        .withColumn("error", F.when(~succeeded, "TRANSFER_NOT_SUCCEEDED"))
    )


def idempotent_commands(
    commands: DataFrame, keys: list[str], ts: str, delay: str = REDELIVERY_WINDOW
) -> DataFrame:
    """Rows that are no repeat although delivery is at least once.

    A row is a repeat if it lies within `delay` of the delivery of its key that was kept before it;
    later ones count anew. A stream forgets a delivery once the watermark has passed its delay,
    a table once the time is over.
    """
    if commands.isStreaming:
        return commands.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
    return first_deliveries(commands, keys, ts, delay)


LETTER_FIELDS = ["data", "payload", "publish_time", "timestamp"]


def command_orders(valid: DataFrame) -> DataFrame:
    """Orders of valid commands, equal ones once, with the fields of a dead letter.

    A SAMPLE_START has its table, and the size, spec and target of its message.
    """
    source, target = "sample_request_table_reference", "target_table"
    read = command_nodes(valid, COMMAND_LEAVES).filter(F.col("route").isin(ORDERED)).select(
        "route",
        "timestamp",
        text("prefix").alias("prefix"),
        *(text(f"{source}_{name}").alias(name) for name in TABLE_KEY),
        F.to_json(F.col("__node_sample_request_sample")).alias("__sample"),
        text(f"{target}_project_id").alias("target_project"),
        text(f"{target}_dataset_id").alias("target_dataset"),
        text(f"{target}_table_id").alias("target_id"),
        text(f"{target}_location").alias("target_location"),
        F.struct("publish_time", "data", "payload").alias("__letter"),
    )
    what = [name for name in read.columns if name != "__letter"]
    once = read.groupBy(*what).agg(F.min("__letter").alias("__letter"))
    once = once.withColumn("order_id", F.sha2(F.to_json(F.struct(*what)), 256))
    parsed = parse_requests(once, "__sample")
    return parsed.select(*ORDER.fieldNames(), "__letter.data", "__letter.payload", "__letter.publish_time")


def staging_removals(valid: DataFrame, transfers: DataFrame) -> DataFrame:
    """(dataset_id and the fields of a dead letter) of the schemas that commands and finished transfers are done with."""
    asked = command_nodes(valid, COMMAND_LEAVES).filter("route = 'REMOVE_DATASET'")
    asked = asked.select(text("dataset_id").alias("dataset_id"), *LETTER_FIELDS)
    finished = transfers.filter("next_command = 'REMOVE_DATASET' AND source_dataset_id IS NOT NULL")
    both = asked.unionAll(finished.select(F.col("source_dataset_id").alias("dataset_id"), *LETTER_FIELDS))
    return both.dropDuplicates(["dataset_id"])


def command_handler(spark: SparkSession, config: CycleConfig, dead_letters: str) -> Callable:
    """Function for foreachBatch that carries out the commands of a batch, all samplings as one plan.

    A table that several commands ask for is sampled once per target, for the latest of them, and each command
    is logged with its own time. A SAMPLE_START is carried out as sent, within the policy. A command that fails
    becomes a dead letter and does not stop the others, nor does a failed transfer. A repeated batch replaces
    its dead letters and its records; streams with dead letters in different folders have different batches.
    """
    stream = hashlib.sha256(dead_letters.encode()).hexdigest()[:16]

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = route_commands(batch).persist()
        folder = f"{dead_letters}/batch={batch_id}"

        def failures(failed: DataFrame) -> None:
            dead_letter(failed, LETTER_FIELDS).write.mode("append").json(folder)

        def text_of(error: Exception) -> Column:
            return F.lit(f"{type(error).__name__}: {error}")

        try:
            valid = routed.filter(F.col("error").isNull())
            transfers = transfer_notification(valid)
            # A repeated batch overwrites its own dead letters instead of adding to them.
            letters = dead_letter(routed, LETTER_FIELDS).unionAll(dead_letter(transfers, LETTER_FIELDS))
            letters.write.mode("overwrite").json(folder)
            removals = staging_removals(valid, transfers)
            # Other schemas than those of this config are left alone.
            own = F.lower("dataset_id").startswith(config.staging_prefix)
            removals = stage(removals.filter(own), "removals")
            for row in removals.select("dataset_id").toLocalIterator():
                try:
                    drop_schema_cascade(spark, row.dataset_id.lower())
                except Exception as error:  # noqa: BLE001 - one failed command must not stop the others
                    LOG.exception("Staging schema %s cannot be dropped", row.dataset_id)
                    same = removals.filter(F.col("dataset_id") == row.dataset_id)
                    failures(same.withColumn("error", text_of(error)))
            orders = stage(command_orders(valid), "batch_orders")
            if orders.isEmpty():
                return
            try:
                result = run_orders(spark, config, orders.select(*ORDER.fieldNames()), f"{stream}-{batch_id}")
            except Exception as error:  # noqa: BLE001 - the commands of this batch have failed, not the stream
                LOG.exception("The commands of batch %s failed", batch_id)
                failures(orders.withColumn("error", text_of(error)))
                return
            if result.commands is not None:
                failed = result.commands.filter("route = 'SAMPLE_START' AND error IS NOT NULL")
                failures(orders.join(failed.select("order_id", "error"), "order_id"))
        finally:
            routed.unpersist()

    return handle


def run_command_stream(
    spark: SparkSession, config: CycleConfig, messages: str, checkpoint: str, dead_letters: str
) -> StreamingQuery:
    """Carry out all commands waiting in the `messages` folder, each one once, then stop.

    Repeats are told apart by arrival time, so that a command published long ago is never late.
    """
    commands = command_stream(read_messages(spark, messages)).withColumn(
        "arrived", F.current_timestamp()
    )
    once = idempotent_commands(commands, ["data", "publish_time"], "arrived")
    return (
        once.writeStream.foreachBatch(command_handler(spark, config, dead_letters))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
