"""DuckDB SQL for the results of the queries, written apart from the Spark code."""

from __future__ import annotations

from workload import inputs
from workload.runs import (
    GOVERNED,
    LIMIT,
    LOG_TS,
    SEED,
    SIZE,
    row_ids,
)

KEY = "project_id, dataset_id, table_id"
MAX_LONG = 9223372036854775807


def source(pair: tuple[str, list[str]]) -> str:
    name, columns = pair
    return f"SELECT {', '.join(columns)} FROM {name}"


# JSON text to columns


def _type(path: str) -> str:
    return f"coalesce(json_type(j, '{path}'), 'NULL')"


def _text(path: str) -> str:
    return f"json_extract_string(j, '{path}')"


def _count_at(path: str) -> str:
    kind, value = _type(path), _text(path)
    return f"""CASE WHEN {kind} = 'NULL' THEN NULL
        WHEN {kind} IN ('UBIGINT', 'BIGINT') AND TRY_CAST({value} AS BIGINT) IS NOT NULL
            THEN TRY_CAST({value} AS BIGINT)
        WHEN {kind} <> 'VARCHAR' AND regexp_full_match({value}, '[0-9]{{19,38}}') THEN {MAX_LONG}
        ELSE -1 END"""


def _percentage_at(path: str) -> str:
    return f"""CASE WHEN {_type(path)} = 'NULL' THEN NULL
        WHEN {_type(path)} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN TRY_CAST({_text(path)} AS DOUBLE)
        ELSE -1e0 END"""


def _valid_size(count: str, percentage: str) -> str:
    return (
        f"coalesce({count} >= 0, true) AND coalesce({percentage} > 0 AND {percentage} <= 100, true)"
    )


def _direction_known(value: str) -> str:
    return f"coalesce(upper(trim({value})) IN ('ASC', 'DESC'), false)"


def _by_clean(value: str) -> str:
    return f"coalesce(length({value}) > 0 AND trim({value}) = {value}, false)"


def parsed(text: str, keys: str, policy: bool) -> str:
    """Columns of the config nodes found in `content`, one level of checks after the other."""
    roots = {"limit": "$.limit", "size": "$.default_sample.size"} if policy else {"size": "$.size"}
    spec = "$.default_sample.spec" if policy else "$.spec"
    raw = [
        f"{_count_at(path + '.count')} AS {name}_c, {_percentage_at(path + '.percentage')} AS {name}_p"
        for name, path in roots.items()
    ]
    sizes = [
        f"CASE WHEN {_valid_size(name + '_c', name + '_p')} THEN {name}_{short} END AS {name}_{long}"
        for name in roots
        for short, long in (("c", "count"), ("p", "percentage"))
    ]
    by, direction = f"{spec}.properties.by", f"{spec}.properties.direction"
    return f"""
        SELECT {keys}, {', '.join(sizes)},
            CASE WHEN kind = 'NULL' THEN NULL WHEN kind <> 'OBJECT' THEN 'random'
                WHEN type_ok THEN type_text END AS spec_type,
            CASE WHEN kind = 'OBJECT' AND type_ok AND properties_ok THEN by_text END AS spec_by,
            CASE WHEN kind = 'OBJECT' AND type_ok AND properties_ok THEN direction_text END
                AS spec_direction
        FROM (SELECT *,
                type_kind = 'NULL' OR (type_kind = 'VARCHAR'
                    AND lower(trim(type_text)) IN ('random', 'sorted')) AS type_ok,
                by_kind = 'VARCHAR' AND direction_kind = 'VARCHAR' AND {_by_clean('by_text')}
                    AND {_direction_known('direction_text')} AS properties_ok
            FROM (SELECT {keys}, {', '.join(raw)}, {_type(spec)} AS kind,
                    {_type(spec + '.type')} AS type_kind, {_text(spec + '.type')} AS type_text,
                    {_type(by)} AS by_kind, {_text(by)} AS by_text,
                    {_type(direction)} AS direction_kind, {_text(direction)} AS direction_text
                FROM (SELECT *, TRY_CAST(content AS JSON) AS j FROM ({text}))))"""


POLICIES = parsed(source(inputs.POLICIES), KEY, policy=True)
REQUESTS = parsed(source(inputs.REQUESTS), KEY, policy=False)
DEFAULT = parsed(
    f"SELECT 1 AS one, content FROM ({source(inputs.DEFAULT_POLICY)})", "one", policy=True
)


def _given(prefix: str, node: str) -> str:
    fields = ["type", "by", "direction"] if node == "spec" else ["count", "percentage"]
    return "(" + " OR ".join(f"{prefix}.{node}_{field} IS NOT NULL" for field in fields) + ")"


def _merged(node: str, *prefixes: str, fallback: dict[str, str] | None = None) -> str:
    fields = ["type", "by", "direction"] if node == "spec" else ["count", "percentage"]
    columns = []
    for field in fields:
        cases = " ".join(f"WHEN {_given(p, node)} THEN {p}.{node}_{field}" for p in prefixes)
        last = f" ELSE {fallback[field]}" if fallback else ""
        columns.append(f"CASE {cases}{last} END AS {node}_{field}")
    return ", ".join(columns)


ONE_ROW = {"count": "1", "percentage": "NULL"}
AT_RANDOM = {"type": "'random'", "by": "NULL", "direction": "NULL"}

EFFECTIVE_POLICY = f"""
    SELECT {KEY}, {_merged('limit', 'p', 'd', fallback=ONE_ROW)},
        {_merged('size', 'p', 'd', fallback=ONE_ROW)}, {_merged('spec', 'p', 'd', fallback=AT_RANDOM)}
    FROM ({POLICIES}) p CROSS JOIN ({DEFAULT}) d"""

EFFECTIVE_REQUEST = f"""
    SELECT {', '.join(f'p.{k}' for k in KEY.split(', '))}, p.limit_count, p.limit_percentage,
        {_merged('size', 'r', 'p')}, {_merged('spec', 'r', 'p')}
    FROM ({EFFECTIVE_POLICY}) p LEFT JOIN ({REQUESTS}) r USING ({KEY})"""

COUNTS = f"""
    SELECT {inputs.project('o_custkey')} AS project_id, {inputs.dataset('o_custkey')} AS dataset_id,
        {inputs.table('o_custkey')} AS table_id, {inputs.ROW_COUNT} AS row_count
    FROM orders GROUP BY o_custkey"""


def share(rounding: str, rows: str, percentage: str) -> str:
    return (
        f"CAST({rounding}(CAST({rows} AS DOUBLE) * CAST({percentage} AS DOUBLE) / 100::DOUBLE) AS BIGINT)"
    )


_LIMIT_ROWS = (
    f"CASE WHEN limit_percentage IS NULL THEN coalesce(limit_count, row_count) "
    f"ELSE least({share('floor', 'row_count', 'limit_percentage')}, coalesce(limit_count, row_count)) END"
)
_WANTED_ROWS = (
    f"CASE WHEN size_percentage IS NULL THEN coalesce(size_count, 0) "
    f"ELSE greatest({share('ceil', 'row_count', 'size_percentage')}, coalesce(size_count, 0)) END"
)

PLAN = f"""
    SELECT {KEY}, row_count, sample_type, sort_by, direction,
        CASE WHEN row_count IS NOT NULL THEN limit_rows END AS limit_rows,
        CASE WHEN row_count IS NOT NULL THEN wanted_rows END AS wanted_rows,
        CASE WHEN row_count IS NOT NULL THEN least(limit_rows, wanted_rows) END AS granted,
        CASE WHEN row_count IS NULL THEN 'MISSING_SOURCE'
            WHEN sample_type IS NULL THEN 'BAD_SPEC_TYPE'
            WHEN sample_type = 'sorted' AND sort_by IS NULL THEN 'MISSING_SORT_PROPERTIES'
        END AS error_code
    FROM (SELECT *, lower(trim(spec_type)) AS sample_type,
            CASE WHEN lower(trim(spec_type)) = 'sorted' THEN spec_by END AS sort_by,
            CASE WHEN lower(trim(spec_type)) = 'sorted' THEN upper(trim(spec_direction)) END
                AS direction,
            {_LIMIT_ROWS} AS limit_rows, {_WANTED_ROWS} AS wanted_rows
        FROM ({EFFECTIVE_REQUEST}) LEFT JOIN ({COUNTS}) USING ({KEY}))"""


# Samples


def granted(table: str, limit=LIMIT, size=SIZE) -> str:
    """Scalar subquery: the rows that a policy grants of a table."""
    n = "n"

    def bound(value, rounding, pick, default):
        count, percentage = value
        count = default if count is None else count
        return f"{pick}({share(rounding, n, percentage)}, {count})" if percentage is not None else count

    return (
        f"(SELECT least({bound(limit, 'floor', 'least', n)}, {bound(size, 'ceil', 'greatest', 0)})"
        f" FROM (SELECT count(*) AS n FROM {table}))"
    )


def order_by(table: str, by: str, direction: str) -> str:
    nulls = "FIRST" if direction == "ASC" else "LAST"
    others = [c for c in inputs.ORDERED_COLUMNS[table].split() if c != by]
    return ", ".join(
        [f"{by} {direction} NULLS {nulls}", *(f"{c} ASC NULLS FIRST" for c in others)]
    )


def first_rows(table: str, by: str, direction: str, n: str) -> str:
    return f"SELECT * FROM {table} ORDER BY {order_by(table, by, direction)} LIMIT {n}"


def _governed() -> str:
    parts = []
    for name, (limit, size, by, direction, asked) in GOVERNED.items():
        n = granted(name, limit, asked or size)
        first, second = row_ids(name)
        parts.append(
            f"SELECT '{name}' AS table_id, CAST({first} AS BIGINT) AS row_id, "
            f"CAST({second} AS BIGINT) AS row_part, "
            f"{inputs.row_digest(name, inputs.DUCKDB_TEXTS)} AS row_digest "
            f"FROM ({first_rows(name, by, direction, n)})"
        )
    return " UNION ALL ".join(f"({part})" for part in parts)


# Commands

MESSAGES = f"""
    SELECT event_id, body AS payload, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
        TRY_CAST(body AS JSON) AS j
    FROM (SELECT event_id, ts, {inputs.MESSAGE_TEXT} AS body FROM events)"""

KNOWN = (
    "'START', 'SAMPLE_POLICY_PREFIX', 'SAMPLE_START', 'SAMPLE_DONE', 'TRANSFER_RUN_DONE', "
    "'REMOVE_DATASET'"
)

def _is_run(name: str) -> str:
    """Whether a text is the name of a transfer run, by its segments."""
    part = f"string_split({name}, '/')"
    fixed = {1: "projects", 3: "locations", 5: "transferConfigs", 7: "runs"}
    return " AND ".join(
        [f"len({part}) >= 8", f"NOT regexp_matches({name}, '\\s')"]
        + [f"{part}[{i}] = '{text}'" for i, text in fixed.items()]
        + [f"{part}[{i}] <> ''" for i in (2, 4, 6)]
        + [f"array_to_string({part}[8:], '/') <> ''"]
    )


_GIVEN = f"upper(trim({_text('$.type')}))"
_NOTICE = (
    f"({_type('$.dataSourceId')} = 'VARCHAR' AND {_type('$.params')} = 'OBJECT' "
    f"AND {_type('$.name')} = 'VARCHAR' AND {_is_run(_text('$.name'))})"
)


def _is(kind: str, *paths: str) -> str:
    return " AND ".join(f"{_type(path)} = '{kind}'" for path in paths)


def _ref(path: str) -> str:
    return (
        _is("VARCHAR", f"{path}.project_id", f"{path}.dataset_id", f"{path}.table_id")
        + f" AND {_type(path + '.location')} IN ('NULL', 'VARCHAR')"
    )


def _positive(path: str) -> str:
    return f"coalesce(TRY_CAST({_text(path)} AS DOUBLE) > 0, false)"


_SAMPLE = (
    f"{_ref('$.sample_request.table_reference')} AND {_type('$.sample_request.sample')} <> 'NULL' "
    f"AND {_ref('$.target_table')}"
)

ROUTED = f"""
    SELECT *, CASE WHEN error IS NULL THEN type ELSE 'DEAD_LETTER' END AS route
    FROM (SELECT *, CASE
            WHEN j IS NULL THEN 'BAD_PAYLOAD'
            WHEN json_type(j) <> 'OBJECT' THEN 'NOT_AN_OBJECT'
            WHEN type IS NULL THEN 'UNKNOWN_TYPE'
            WHEN type = 'SAMPLE_POLICY_PREFIX' AND NOT ({_is('VARCHAR', '$.prefix')}) THEN 'BAD_FIELDS'
            WHEN type = 'SAMPLE_START' AND NOT ({_SAMPLE}) THEN 'BAD_FIELDS'
            WHEN type = 'SAMPLE_DONE' AND NOT ({_SAMPLE} AND {_positive('$.start_timestamp')}
                AND {_positive('$.end_timestamp')} AND {_is('VARCHAR', '$.error_message')}
                AND coalesce(TRY_CAST({_text('$.amount_inserted')} AS DOUBLE) >= 0, true))
                THEN 'BAD_FIELDS'
            WHEN type = 'REMOVE_DATASET'
                AND NOT ({_is('VARCHAR', '$.project_id', '$.dataset_id')}) THEN 'BAD_FIELDS'
            WHEN type = 'TRANSFER_RUN_DONE' AND {_GIVEN} = type
                AND NOT ({_is('VARCHAR', '$.name')} AND {_is('OBJECT', '$.payload')}) THEN 'BAD_FIELDS'
            END AS error
        FROM (SELECT *, CASE WHEN {_GIVEN} IN ({KNOWN}) THEN {_GIVEN}
                WHEN {_NOTICE} THEN 'TRANSFER_RUN_DONE' END AS type
            FROM ({MESSAGES})))"""


def _transfer_field(path: str) -> str:
    return (
        f"CASE WHEN {_GIVEN} = 'TRANSFER_RUN_DONE' THEN {_text('$.payload.' + path)} "
        f"ELSE {_text('$.' + path)} END"
    )


TRANSFERS = f"""
    SELECT *, CASE WHEN state = 'SUCCEEDED' THEN 'REMOVE_DATASET' END AS next_command,
        CASE WHEN state = 'SUCCEEDED' THEN NULL ELSE 'TRANSFER_NOT_SUCCEEDED' END AS error
    FROM (SELECT event_id,
            CASE WHEN {_GIVEN} = 'TRANSFER_RUN_DONE' THEN {_text('$.name')}
                WHEN {_is_run(_text('$.name'))}
                    THEN array_to_string(string_split({_text('$.name')}, '/')[1:6], '/') END AS config_name,
            {_transfer_field('state')} AS state,
            {_transfer_field('params.source_project_id')} AS source_project_id,
            {_transfer_field('params.source_dataset_id')} AS source_dataset_id
        FROM ({ROUTED}) WHERE type = 'TRANSFER_RUN_DONE')"""


# Tables and paths

PATHS = f"SELECT {inputs.object_path('p_partkey')} AS path FROM part"
PARSED_PATHS = f"""
    SELECT path, split_part(path, '/', 1) AS project_id, split_part(path, '/', 2) AS dataset_id,
        left(split_part(path, '/', 3), length(split_part(path, '/', 3)) - 5) AS table_id
    FROM ({PATHS}) WHERE path LIKE '%.json' AND len(string_split(path, '/')) = 3"""

LOCATED = f"""
    SELECT t.*, location
    FROM ({source(inputs.LOCATED_TABLES)}) t LEFT JOIN (
        SELECT 'p_' || CAST(n_regionkey AS VARCHAR) AS project_id,
            'd_' || CAST(n_nationkey AS VARCHAR) AS dataset_id, r_name AS location
        FROM nation JOIN region ON n_regionkey = r_regionkey) d USING (project_id, dataset_id)"""

_NAMES = ", ".join(f"'{name}'" for name in inputs.TABLES)

TABLE_REFS = f"""
    SELECT c_custkey, CASE WHEN ok THEN p END AS project_id, CASE WHEN ok THEN d END AS dataset_id,
        CASE WHEN ok THEN t END AS table_id,
        CASE WHEN ok AND length(l) > 0 THEN l END AS location
    FROM (SELECT *, len(halves) <= 2 AND len(dots) = 3 AND length(p) > 0 AND length(d) > 0
            AND length(t) > 0 AS ok
        FROM (SELECT c_custkey, halves, dots, trim(dots[1]) AS p, trim(dots[2]) AS d, trim(dots[3]) AS t,
                trim(halves[2]) AS l
            FROM (SELECT c_custkey, string_split(ref, '@') AS halves,
                    string_split(string_split(ref, '@')[1], '.') AS dots
                FROM (SELECT c_custkey, {inputs.TABLE_REF_TEXT} AS ref FROM customer))))"""

JOB_ERRORS = f"""
    SELECT o_orderkey, CASE
        WHEN source_table IS NULL THEN 'MISSING_SOURCE_REF'
        WHEN target_table IS NULL THEN 'MISSING_TARGET_REF'
        WHEN amount IS NULL OR amount < 0 THEN 'BAD_AMOUNT'
        WHEN sample_type <> 'sorted' THEN NULL
        WHEN coalesce(trim(sort_by), '') = '' THEN 'BAD_COLUMN'
        WHEN upper(trim(direction)) NOT IN ('ASC', 'DESC') THEN 'BAD_ORDER'
        WHEN c.column_name IS NULL THEN 'UNKNOWN_COLUMN'
        WHEN c.data_type LIKE '%[]' THEN 'UNORDERABLE_COLUMN' END AS job_error
    FROM (SELECT o_orderkey, {', '.join(inputs.JOB_PARTS)} FROM orders) j
    LEFT JOIN (SELECT DISTINCT table_name, lower(column_name) AS column_name, data_type
        FROM information_schema.columns WHERE table_name IN ('orders', 'embeddings')) c
        ON c.table_name = j.table_id AND c.column_name = lower(trim(j.sort_by))"""

PLAN_ERRORS = f"""
    SELECT project_id, dataset_id, table_id, table_id || ' ' || error_code AS error
    FROM ({PLAN}) WHERE error_code IS NOT NULL"""

ERRORS = f"""
    SELECT project_id, dataset_id, table_id, error, CAST(row_number() OVER (
            PARTITION BY project_id, dataset_id, table_id ORDER BY error) AS INTEGER) AS position,
        count(*) OVER (PARTITION BY project_id, dataset_id) AS n_errors
    FROM ({PLAN_ERRORS})"""

RUN_LOG = f"""
    SELECT CAST({LOG_TS} AS BIGINT) AS cycle_ts, source_table,
        'target.' || dataset_id || '.' || table_id || '@EU' AS target_table, sample_type,
        granted AS requested, CAST({LOG_TS + 1} AS BIGINT) AS start_timestamp,
        CAST({LOG_TS + 9} AS BIGINT) AS end_timestamp, coalesce(error_code, '') AS error_message,
        CASE WHEN error_code IS NULL THEN coalesce(n, 0) END AS amount_inserted
    FROM (SELECT *, project_id || '.' || dataset_id || '.' || table_id || '@EU' AS source_table
        FROM ({PLAN}))
    LEFT JOIN (SELECT {inputs.table('l_partkey')} AS table_id, count(*) AS n
        FROM lineitem GROUP BY l_partkey) USING (table_id)"""

# Random rows differ by design; what must hold of them does not.
FACTS = """
    SELECT unnest(['has_n_rows', 'at_most_n_rows', 'from_source', 'fair_by_storage', 'fair_by_date', 'fair_by_hash'])
        AS fact, n >= 0 AS holds
    FROM (SELECT count(*) AS n FROM lineitem)"""

# Kept deliveries, one after the other per command.
IDEMPOTENT = f"""
    WITH RECURSIVE d AS ({source(inputs.DELIVERIES)}), kept AS (
        SELECT command_id, min(delivered) AS delivered FROM d GROUP BY command_id
        UNION ALL
        SELECT d.command_id, min(d.delivered) FROM kept JOIN d ON d.command_id = kept.command_id
            AND d.delivered > kept.delivered + INTERVAL 20 MINUTE
        GROUP BY d.command_id, kept.delivered)
    SELECT command_id, delivered, min(delivery) AS delivery
    FROM (SELECT DISTINCT command_id, delivered FROM kept) JOIN d USING (command_id, delivered)
    GROUP BY command_id, delivered"""

MISSED = """
    SELECT user_id, CAST(day AS DATE) AS day
    FROM (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS day
        FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN
            (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events) b)
    WHERE (user_id, CAST(day AS DATE)) NOT IN (SELECT user_id, CAST(ts AS DATE) FROM events)"""

_SIZES = f"SELECT l_orderkey, l_linenumber, l_partkey, {', '.join(inputs.SIZE_PARTS)} FROM lineitem"
_SIZE_VALID = (
    f"({_valid_size('wanted_count', 'wanted_percentage')} "
    "AND (wanted_count IS NOT NULL OR wanted_percentage IS NOT NULL))"
)
_PROPERTIES_VALID = f"({_by_clean('sort_by')} AND {_direction_known('direction')})"
_SPEC_VALID = (
    "(coalesce(lower(trim(sample_type)) IN ('random', 'sorted'), true) "
    f"AND (sample_type IS NOT NULL OR {_PROPERTIES_VALID}))"
)

SQL = {
    "scan_config_objects": (
        f"SELECT {inputs.object_path('s_suppkey')} AS path, "
        f"{inputs.policy_text('s_suppkey')} AS content FROM supplier"
    ),
    "parse_table_path": PARSED_PATHS,
    "list_dataset_prefixes": (
        "SELECT DISTINCT project_id, dataset_id, project_id || '/' || dataset_id || '/' AS prefix "
        f"FROM ({PARSED_PATHS})"
    ),
    "json_to_policy": POLICIES,
    "json_to_request": parsed(
        f"SELECT event_id, {inputs.event_request_text()} AS content FROM events", "event_id", False
    ),
    "validate_size": f"""
        SELECT l_orderkey, l_linenumber, l_partkey,
            CASE WHEN {_SIZE_VALID} THEN wanted_count END AS size_count,
            CASE WHEN {_SIZE_VALID} THEN wanted_percentage END AS size_percentage,
            {_SIZE_VALID} AS valid FROM ({_SIZES})""",
    "validate_spec": f"""
        SELECT p_partkey, CASE WHEN {_SPEC_VALID} THEN sample_type END AS spec_type,
            CASE WHEN {_SPEC_VALID} AND {_PROPERTIES_VALID} THEN sort_by END AS spec_by,
            CASE WHEN {_SPEC_VALID} AND {_PROPERTIES_VALID} THEN direction END AS spec_direction,
            {_SPEC_VALID} AS valid
        FROM (SELECT p_partkey, {', '.join(inputs.SPEC_PARTS)} FROM part)""",
    "validate_table_ref": TABLE_REFS,
    "resolve_location": LOCATED,
    "scan_source": "SELECT * FROM lineitem",
    "source_schema": f"""
        SELECT DISTINCT table_name AS table_id, column_name, CAST(ordinal_position AS INTEGER) AS ordinal,
            CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
                END AS data_type,
            data_type NOT LIKE '%[]' AS orderable
        FROM information_schema.columns WHERE table_name IN ({_NAMES})""",
    "row_count": " UNION ALL ".join(
        f"SELECT '{name}' AS table_id, count(*) AS row_count FROM {name}" for name in inputs.TABLES
    ),
    "drop_column": "SELECT * EXCLUDE (o_orderpriority) FROM orders",
    "label_match": "SELECT p_partkey, p_size > 25 AND p_brand = 'Brand#2' AS matches FROM part",
    "effective_policy": EFFECTIVE_POLICY,
    "effective_request": EFFECTIVE_REQUEST,
    "compliant_plan": PLAN,
    "target_mapping": f"""
        SELECT *, project_id || '.' || dataset_id || '.' || table_id
                || coalesce('@' || location, '') AS source_table,
            'target.' || dataset_id || '.' || table_id || '@EUROPE' AS target_table,
            location IS DISTINCT FROM 'EUROPE' AS crosses_location
        FROM ({LOCATED})""",
    "orphan_requests": f"SELECT * FROM ({REQUESTS}) r ANTI JOIN ({POLICIES}) p USING ({KEY})",
    "removed_sources": (
        f"SELECT {KEY}, 'MISSING_SOURCE' AS error_code FROM ({POLICIES}) p "
        f"ANTI JOIN ({source(inputs.CATALOG_TABLES)}) c USING ({KEY})"
    ),
    "validate_job": JOB_ERRORS,
    "policy_request_dry_run": f"""
        SELECT r.project_id, r.dataset_id, r.table_id, e.size_count IS NOT NULL
            OR e.size_percentage IS NOT NULL AS has_policy, limit_count, limit_percentage,
            e.size_count, e.size_percentage, e.spec_type, e.spec_by, e.spec_direction
        FROM ({source(inputs.REQUESTS)}) r LEFT JOIN ({EFFECTIVE_REQUEST}) e USING ({KEY})""",
    "sample_request_dry_run": (
        f"SELECT {KEY}, granted, sample_type, sort_by, direction FROM ({PLAN}) p "
        f"SEMI JOIN ({source(inputs.REQUESTS)}) r USING ({KEY})"
    ),
    "errors_per_cycle": ERRORS,
    "sorted_sample": first_rows("lineitem", "l_shipdate", "DESC", granted("lineitem")),
    "random_sample_facts": FACTS,
    "random_sample_scaled_facts": FACTS,
    "block_sample_facts": f"SELECT * FROM ({FACTS}) WHERE fact IN ('at_most_n_rows', 'from_source')",
    "zero_sample": "SELECT * FROM lineitem LIMIT 0",
    "hash_sample": (
        f"SELECT * FROM orders ORDER BY md5(concat_ws(':', '{SEED}', CAST(o_orderkey AS VARCHAR))), "
        f"o_orderkey LIMIT {granted('orders')}"
    ),
    "write_sample": first_rows("orders", "o_totalprice", "DESC", granted("orders")),
    "cross_location_copy": first_rows("customer", "c_acctbal", "ASC", granted("customer")),
    "full_refresh_targets": f"""
        SELECT {KEY} FROM (SELECT {', '.join(inputs.CATALOG_TABLES[1])}
            FROM customer WHERE c_acctbal > 0) c
        ANTI JOIN (SELECT * FROM ({POLICIES}) p WHERE {_given('p', 'limit')}
            OR {_given('p', 'size')} OR {_given('p', 'spec')}) k USING ({KEY})""",
    "run_log": RUN_LOG,
    "command_stream": (
        f'SELECT event_id, payload, "timestamp", j IS NOT NULL AS is_json FROM ({MESSAGES})'
    ),
    "route_commands": f'SELECT event_id, type, "timestamp", error, route FROM ({ROUTED})',
    "dead_letter": f"""
        SELECT CAST(to_json({{'event_id': event_id, 'payload': payload, 'timestamp': "timestamp",
                'type': type}}) AS VARCHAR) AS command, error,
            'The command was not carried out: ' || error AS message
        FROM ({ROUTED}) WHERE error IS NOT NULL""",
    "transfer_notification": TRANSFERS,
    "idempotent_commands": IDEMPOTENT,
    "error_alert": """
        SELECT date_trunc('hour', ts) AS window_start,
            date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_errors,
            min(ts) AS first_error
        FROM events WHERE event_type = 'error' GROUP BY date_trunc('hour', ts)""",
    "missed_cycle_alert": MISSED,
    "governed_sample": _governed(),
}
