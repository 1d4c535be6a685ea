"""One sampling cycle: resolve every policy, sample every table, refresh the targets."""

from __future__ import annotations

import hashlib
import logging
import time
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from sampleward.functions.text import valid_identifier
from sampleward.operators.sampling import (
    block_sample,
    random_sample,
    sorted_sample,
    zero_sample,
)
from sampleward.operators.tables import (
    create_schema,
    cross_location_copy,
    drop_empty_schemas,
    drop_orphan_staging,
    drop_tables,
    full_refresh_targets,
    replace_batch,
    sample_labels,
    staging_schema_name,
    write_sample,
)
from sampleward.plans.effective import (
    default_policy,
    effective_policy,
    effective_request,
    orphan_requests,
    table_policies,
    table_requests,
)
from sampleward.plans.jobs import (
    COUNT_FAILED,
    compliant_plan,
    errors_per_cycle,
    target_collisions,
    target_mapping,
    validate_job,
)
from sampleward.plans.orders import (
    common_prefix,
    covered_requests,
    latest_requests,
    one_order,
    order_outcomes,
)
from sampleward.plans.records import dead_letter, run_log
from sampleward.schemas import OUTCOME, ROW_COUNT, TABLE_KEY
from sampleward.settings import ERROR_SEPARATOR, CycleConfig
from sampleward.sources.catalog import (
    TableKey,
    dataset_locations,
    list_tables,
    resolve_location,
    row_count,
    source_schema,
)
from sampleward.sources.config_objects import object_present, scan_config_objects
from sampleward.sources.shared import small_table, stage

LOG = logging.getLogger(__name__)

TABLES_PER_COUNT = 50
LOG_LABELS = {"sampling_log": "true"}


@dataclass(frozen=True)
class CycleResult:
    """`status` is DONE or LOCKED. `log` has one row per table and time, `errors` one per error, `commands` one per order."""

    status: str
    log: DataFrame | None = None
    errors: DataFrame | None = None
    dropped: tuple[str, ...] = ()
    commands: DataFrame | None = None


def sample_by_spec(
    df: DataFrame,
    sample_type: str,
    n: int,
    total: int,
    by: str | None = None,
    direction: str | None = None,
    seed: int = 42,
    single_task_rows: int | None = None,
    by_block: bool = False,
) -> DataFrame:
    """The sample that a plan row asks for.

    With `by_block`, a random sample reads only part of the files and may give fewer rows.
    """
    if n <= 0 or total == 0:
        return zero_sample(df)
    if sample_type == "random":
        sample = block_sample if by_block else random_sample
        return sample(df, n, seed, total, single_task_rows)
    if sample_type == "sorted":
        return sorted_sample(df, n, by, direction, total, single_task_rows)
    raise ValueError(f"Cannot sample by type <{sample_type}>")


def count_tables(
    spark: SparkSession, tables: Mapping[TableKey, DataFrame], parallelism: int
) -> DataFrame:
    """Row counts of all tables, a bounded number of tables per job; one small row per table.

    A table that cannot be counted gets COUNT_FAILED and does not stop the others.
    """

    def count(chunk: list[tuple[TableKey, DataFrame]]) -> list[tuple]:
        try:
            return [tuple(row) for row in row_count(spark, dict(chunk)).collect()]
        except Exception as error:  # noqa: BLE001 - the tables are then counted one by one
            if len(chunk) > 1:
                return [row for item in chunk for row in count([item])]
            LOG.warning("Source table %s cannot be counted: %s", ".".join(chunk[0][0]), error)
            return [(*chunk[0][0], COUNT_FAILED)]

    items = list(tables.items())
    chunks = [items[i : i + TABLES_PER_COUNT] for i in range(0, len(items), TABLES_PER_COUNT)]
    with ThreadPoolExecutor(parallelism) as pool:
        counted = pool.map(inheritable_thread_target(spark)(count), chunks)
        rows = [row for chunk in counted for row in chunk]
    return small_table(spark, rows, ROW_COUNT)


def resolve_orders(
    spark: SparkSession, config: CycleConfig, orders: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """A row per order and table it covers, with the effective limit and what is to be sampled; and orphan requests.

    Both config roots are listed once for all orders. A SAMPLE_START for a table without a policy is
    capped by the default policy.
    """
    prefix = common_prefix(orders)
    objects = scan_config_objects(spark, config.policy_root, config.default_policy_path, exact=True)
    default = default_policy(objects, config.default_policy_path)
    policies = stage(table_policies(scan_config_objects(spark, config.policy_root, prefix)), "policies")
    requests = stage(table_requests(scan_config_objects(spark, config.request_root, prefix)), "asked")
    asked = orders.where("route = 'SAMPLE_START'").select(*TABLE_KEY).distinct()
    unknown = asked.join(policies, TABLE_KEY, "left_anti")
    known = policies.unionByName(unknown, allowMissingColumns=True)
    effective = effective_request(effective_policy(known, default), requests)
    return covered_requests(effective, policies, orders), orphan_requests(requests, policies)


def plan_jobs(
    requests: DataFrame,
    counts: DataFrame,
    locations: DataFrame,
    columns: DataFrame,
    target_project: str,
    target_location: str | None,
) -> DataFrame:
    """Executable plan: one row per table, with `error_code` where it cannot be sampled."""
    plan = target_mapping(
        compliant_plan(resolve_location(requests, locations), counts),
        target_project,
        target_location,
    ).withColumn("amount", F.coalesce("granted", F.lit(0).cast("bigint")))
    plan = plan.withColumn("target_name", valid_identifier(F.col("target_id")))
    checked = target_collisions(validate_job(plan, columns))
    foreign = F.when(F.coalesce("target_project", F.lit(target_project)) != target_project, "FOREIGN_TARGET")
    return checked.withColumn("error_code", F.coalesce("error_code", foreign, "job_error")).drop("job_error")


def find_tables(
    spark: SparkSession, config: CycleConfig, keys: Iterator[TableKey]
) -> dict[TableKey, DataFrame]:
    """The source tables that exist. Count and sample use the same DataFrame, thus the same files."""

    def find(key: TableKey) -> tuple[TableKey, DataFrame | None]:
        try:
            return key, spark.table(config.source_name(*key))
        except Exception as error:  # noqa: BLE001 - one broken table must not stop the others
            LOG.warning("Source table %s cannot be read: %s", ".".join(key), error)
            return key, None

    with ThreadPoolExecutor(config.parallelism) as pool:
        found = pool.map(inheritable_thread_target(spark)(find), keys)
        return {key: df for key, df in found if df is not None}


def run_cycle(
    spark: SparkSession, config: CycleConfig, cycle_ts: int | None = None, prefix: str = ""
) -> CycleResult:
    """Run one cycle, or only the part of it under a config `prefix`."""
    return run_orders(spark, config, one_order(spark, int(time.time()) if cycle_ts is None else cycle_ts, prefix))


def run_orders(
    spark: SparkSession, config: CycleConfig, orders: DataFrame, batch: str | None = None
) -> CycleResult:
    """Run all orders of a batch as one plan: each table is sampled once per target, and every order is logged.

    The records of a batch that is run again replace those of its first run; without a name, a run is a batch of its own.
    """
    lock_objects = scan_config_objects(spark, config.request_root, config.lock_path, exact=True)
    if object_present(lock_objects, config.lock_path):
        LOG.warning("Sampling is locked by %s, nothing is changed", config.lock_path)
        return CycleResult("LOCKED")
    orders = stage(orders, "orders")
    whole = not orders.where("route = 'START'").isEmpty()
    if whole:
        drop_orphan_staging(spark, config.staging_prefix)

    covered, orphans = resolve_orders(spark, config, orders)
    covered = stage(covered, "requests")
    requests = stage(latest_requests(covered), "latest")
    keys = (tuple(row) for row in requests.select(*TABLE_KEY).distinct().toLocalIterator())
    tables = find_tables(spark, config, keys)
    datasets = {(project, dataset): dataset for project, dataset, _ in tables}
    for project, dataset, target in requests.select(*TABLE_KEY[:2], "target_dataset").distinct().toLocalIterator():
        if (project, dataset) not in datasets:
            continue
        labels = sample_labels(config.labels, project, None)
        try:
            create_schema(spark, config.target_schema(target), config.target_root, labels)
        except Exception:  # noqa: BLE001 - writing the samples of this dataset then fails, each on its own
            LOG.exception("Target schema of %s.%s cannot be created", project, dataset)
    plan = stage(
        plan_jobs(
            requests,
            count_tables(spark, tables, config.parallelism),
            dataset_locations(spark, datasets, config.source_catalogs),
            source_schema(spark, tables),
            config.target_project,
            config.target_location,
        ),
        "plan",
    )

    def run(row: Row) -> tuple:
        started = int(time.time())
        failure, inserted = None, None
        key = (row.project_id, row.dataset_id, row.table_id)
        try:
            seed = draw_seed(config.seed, row.timestamp, key)
            inserted = _with_retry(config, lambda: _sample_table(config, tables[key], row, seed))
        except Exception as error:  # noqa: BLE001 - one failed table must not stop the others
            LOG.exception("Sampling %s failed", row.source_table)
            failure = f"{type(error).__name__}: {error}"
        return row.source_table, row.target_table, inserted, started, int(time.time()), failure

    with ThreadPoolExecutor(config.parallelism) as pool:
        jobs = plan.filter(F.col("error_code").isNull()).toLocalIterator()
        outcomes = list(pool.map(inheritable_thread_target(spark)(run), jobs))

    outcome = small_table(spark, outcomes, OUTCOME)
    finished = plan.join(outcome.drop("row_count"), ["source_table", "target_table"], "left").withColumn(
        "error_code", F.coalesce("error_code", "failure")
    )
    now = F.lit(int(time.time()))
    # A record for each time at which a table was asked for, also if it was sampled only once.
    target = [F.lower(name).alias(f"__{name}") for name in ("target_dataset", "target_id")]
    stamps = covered.select(*TABLE_KEY, *target, F.col("timestamp").alias("stamp")).distinct()
    stamped = finished.select("*", *target).join(stamps, [*TABLE_KEY, "__target_dataset", "__target_id"])
    log = stage(
        run_log(
            stamped,
            outcome,
            F.col("stamp"),
            F.coalesce("started", now),
            F.coalesce("ended", now),
        ),
        "log",
    )
    failed = finished.filter(F.col("error_code").isNotNull()).withColumn("error", F.col("error_code"))
    commands = stage(order_outcomes(orders, covered, finished), "commands")
    _write_logs(spark, config, batch or uuid.uuid4().hex, log, failed, commands)

    dropped: list[str] = []
    if whole:
        dropped = _drop_obsolete(spark, config, finished.filter(F.col("error_code").isNull()))
    errors = failed.select(*TABLE_KEY, "error")
    if whole:
        # Requests that no policy allows are not sampled, which a whole cycle reports.
        errors = errors.unionAll(orphans.select(*TABLE_KEY, F.lit("ORPHAN_REQUEST")))
    return CycleResult("DONE", log, errors_per_cycle(errors), tuple(dropped), commands)


def _with_retry(config: CycleConfig, job) -> int:
    """Repeat a job after a passing failure; a job that is wrong in itself fails at once."""
    for attempt in range(1, config.attempts + 1):
        try:
            return job()
        except (ValueError, AnalysisException):
            raise
        except Exception:
            if attempt == config.attempts:
                raise
            shortest, longest = config.retry_wait
            time.sleep(min(max(2.0 ** (attempt - 1), shortest), longest))
    raise ValueError("No attempt was allowed")


def draw_seed(seed: int | None, cycle_ts: int, key: TableKey) -> int:
    """A seed of its own for each table and cycle, drawn anew unless the config fixes one."""
    source = uuid.uuid4().hex if seed is None else f"{seed}:{cycle_ts}"
    return int.from_bytes(hashlib.sha256(":".join([source, *key]).encode()).digest()[:4], "big")


def _sample_table(config: CycleConfig, df: DataFrame, row: Row, seed: int) -> int:
    """Sample and write one table; returns the rows now in the target, counted as they are written."""
    spark = df.sparkSession
    sample = sample_by_spec(
        df,
        row.sample_type,
        row.amount,
        row.row_count,
        row.sort_by,
        row.direction,
        seed,
        config.single_task_rows,
        config.random_by_block,
    )
    schema, table = config.target_schema(row.target_dataset), row.target_name
    labels = sample_labels(config.labels, row.project_id, row.location)
    source_root = config.location_roots.get(row.location or "")
    written = Observation()
    if row.crosses_location and source_root:
        staging = staging_schema_name(
            spark, config.staging_prefix, row.target_dataset, table, row.location, uuid.uuid4().hex
        )
        cross_location_copy(
            sample,
            staging,
            source_root,
            schema,
            table,
            labels,
            written=written,
            lease_seconds=config.lease_seconds,
            keep_seconds=config.keep_seconds,
        )
    else:
        write_sample(sample, schema, table, labels, written=written, keep_seconds=config.keep_seconds)
    return written.get["rows"]


def _write_logs(
    spark: SparkSession, config: CycleConfig, batch: str, log: DataFrame, failed: DataFrame, commands: DataFrame
) -> None:
    create_schema(spark, config.log_schema, config.target_root, LOG_LABELS)
    letters = dead_letter(failed, ["source_table", "target_table", "sample_type", "granted"], others=["timestamp"])
    replace_batch(log, config.log_schema, "sample_runs", batch)
    replace_batch(letters.withColumnRenamed("timestamp", "cycle_ts"), config.log_schema, "sample_errors", batch)
    replace_batch(commands, config.log_schema, "command_runs", batch)


def _drop_obsolete(spark: SparkSession, config: CycleConfig, sampled: DataFrame) -> list[str]:
    """Drop samples this cycle did not provide, then schemas left empty. New ones are in place."""
    current = sampled.select(
        F.lit(config.target_project).alias("project_id"),
        valid_identifier(F.concat(F.lit(config.target_schema_prefix), "target_dataset")).alias("dataset_id"),
        F.col("target_name").alias("table_id"),
    )
    existing = list_tables(spark, config.target_project, config.target_schema_prefix)
    dropped, errors = drop_tables(spark, full_refresh_targets(existing, current))
    if errors:
        LOG.error(ERROR_SEPARATOR.join(errors))
    return dropped + drop_empty_schemas(spark, config.target_schema_prefix)
