"""Inputs derived from the test tables, as SQL text that Spark and DuckDB both read.

Each row of a table stands for one governed table, one config object or one message. Its config
text takes all the shapes that owners and users write, valid and invalid.
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Columns of each table that a sample can be sorted by: fixed length first, then text.
ORDERED_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_regionkey n_name",
    "customer": "c_custkey c_nationkey c_acctbal c_name c_mktsegment",
    "supplier": "s_suppkey s_nationkey s_acctbal s_name",
    "part": "p_partkey p_size p_retailprice p_name p_brand p_type",
    "orders": "o_orderkey o_custkey o_totalprice o_orderdate o_orderstatus o_orderpriority",
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_shipdate l_returnflag l_linestatus"
    ),
    "events": "event_id ts user_id value event_type props",
    "documents": "doc_id n_chars text lang source",
    "embeddings": "vec_id label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}

DOUBLE_COLUMNS = "c_acctbal s_acctbal p_retailprice o_totalprice l_quantity l_extendedprice l_discount l_tax value".split()
TIME_COLUMNS = "o_orderdate l_shipdate ts".split()
# What Spark and DuckDB write differently: a time as text, a list of numbers as text.
SPARK_TEXTS = (
    "date_format({}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "array_join(transform({}, x -> CAST(CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS STRING)), ',', 'null')",
)
DUCKDB_TEXTS = (
    "strftime({}, '%Y-%m-%d %H:%M:%S.%f')",
    "array_to_string(list_transform({}, lambda x: "
    "coalesce(CAST(CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR), 'null')), ',')",
)


def row_digest(table: str, texts: tuple[str, str]) -> str:
    """MD5 over the values of all columns of a row."""
    time_text, list_text = texts
    columns = ORDERED_COLUMNS[table].split() + (["embedding"] if table == "embeddings" else [])

    def value(name: str) -> str:
        if name in DOUBLE_COLUMNS:
            return f"CAST(CAST(floor({name} * 1000000) AS BIGINT) AS STRING)"
        if name in TIME_COLUMNS:
            return time_text.format(name)
        return list_text.format(name) if name == "embedding" else f"CAST({name} AS STRING)"

    return f"md5(concat_ws('|', {', '.join(f"coalesce({value(name)}, '<null>')" for name in columns)}))"


def _count(key: str) -> str:
    return f"CAST(({key} * 7) % 90 AS STRING)"


def _percentage(key: str) -> str:
    """0.0 to 100.9: zero and more than 100 are invalid on purpose."""
    return f"CAST(({key} * 13) % 101 AS STRING) || '.' || CAST({key} % 10 AS STRING)"


def project(key: str) -> str:
    return f"'p_' || CAST({key} % 5 AS STRING)"


def dataset(key: str) -> str:
    return f"'d_' || CAST({key} % 25 AS STRING)"


def table(key: str) -> str:
    return f"'t_' || CAST({key} AS STRING)"


def policy_text(key: str) -> str:
    n, p = _count(key), _percentage(key)
    sized = f"""'"size": {{"count": ' || {n} || ', "percentage": ' || {p} || '}}'"""
    by_date = """'"spec": {"type": "sorted", "properties": {"by": "l_shipdate", "direction": "ASC"}}'"""
    return f"""CASE {key} % 12
        WHEN 0 THEN ''
        WHEN 1 THEN '{{"limit": {{"count": ' || {n} || ', "percentage": ' || {p} || '}}}}'
        WHEN 2 THEN '{{limit: {{"count": 5}}}}'
        WHEN 3 THEN '{{"limit": {{"count": ' || {n} || '}}, "default_sample": {{"size": {{"percentage": '
            || {p} || '}}, "spec": {{"type": "random"}}}}}}'
        WHEN 4 THEN '{{"__doc__": "full", "limit": {{"percentage": ' || {p} || '}}, "default_sample": {{'
            || {sized} || ', ' || {by_date} || '}}}}'
        WHEN 5 THEN '{{"limit": {{"count": "5"}}, "default_sample": {{"size": {{"count": 7}}}}}}'
        WHEN 6 THEN '{{"limit": {{"count": -3}}, "default_sample": {{"size": {{"percentage": 0}}}}}}'
        WHEN 7 THEN '{{"default_sample": {{"spec": "abc", "size": 5}}}}'
        WHEN 8 THEN '[' || {n} || ']'
        WHEN 9 THEN '{{"limit": {{"count": 99999999999999999999, "percentage": ' || {p} || '}}}}'
        WHEN 10 THEN '{{"default_sample": {{' || {sized}
            || ', "spec": {{"type": "sorted", "properties": {{"by": " c", "direction": "ASC"}}}}}}}}'
        ELSE '{{"limit": {{"count": 10.0}}, "default_sample": {{"size": {{"count": true}}, "spec": '
            || '{{"type": " Sorted ", "properties": {{"by": "o_totalprice", "direction": "desc"}}}}}}}}'
    END"""


def request_text(key: str) -> str:
    n, p = _count(key), _percentage(key)
    return f"""CASE {key} % 9
        WHEN 0 THEN ''
        WHEN 1 THEN '{{"size": {{"count": ' || {n} || '}}}}'
        WHEN 2 THEN '{{"size": {{"count": ' || {n} || ', "percentage": ' || {p} || '}}, "spec": '
            || '{{"type": "sorted", "properties": {{"by": "l_shipdate", "direction": "ASC"}}}}}}'
        WHEN 3 THEN '{{"size": {{"count": ' || {n} || ', "percentage": "' || {p} || '"}}}}'
        WHEN 4 THEN '{{"spec": {{"type": "SORTED ", "properties": '
            || '{{"by": "o_totalprice", "direction": "desc"}}}}}}'
        WHEN 5 THEN '{{"spec": "random"}}'
        WHEN 6 THEN '{{"spec": {{"type": "sorted", "properties": {{"by": 123, "direction": "ASC"}}}}}}'
        WHEN 7 THEN '{{"size": {{"count": 0}}, "__doc__": "none"}}'
        ELSE '{{"size": {{count: ' || {n} || '}}}}'
    END"""


def event_request_text() -> str:
    """Requests that carry the JSON props of events inside."""
    return """CASE event_id % 4
        WHEN 0 THEN '{"size": ' || replace(props, '"k"', '"count"') || ', "from": "' || event_type || '"}'
        WHEN 1 THEN '{"size": ' || replace(props, '"k"', '"percentage"')
            || ', "spec": {"type": "' || event_type || '"}}'
        WHEN 2 THEN '{"props": ' || props || ', "spec": {"properties": {"by": "' || event_type
            || '", "direction": "DESC"}}}'
        ELSE props
    END"""


def object_path(key: str) -> str:
    """Paths of config objects, some of another depth or kind."""
    return f"""CASE {key} % 7
        WHEN 0 THEN {project(key)} || '/' || {table(key)} || '.json'
        WHEN 1 THEN {project(key)} || '/' || {dataset(key)} || '/' || {table(key)} || '.txt'
        WHEN 2 THEN {project(key)} || '/' || {dataset(key)} || '/x/' || {table(key)} || '.json'
        WHEN 3 THEN {project(key)} || '/' || {dataset(key)} || '/' || {table(key)} || '.json.json'
        ELSE {project(key)} || '/' || {dataset(key)} || '/' || {table(key)} || '.json'
    END"""


POLICIES = ("part", [
    f"{project('p_partkey')} AS project_id",
    f"{dataset('p_partkey')} AS dataset_id",
    f"{table('p_partkey')} AS table_id",
    f"{policy_text('p_partkey')} AS content",
])

# Requests of one nation name tables that have no policy.
REQUESTS = ("customer", [
    f"{project('c_custkey')} AS project_id",
    f"{dataset('c_custkey')} AS dataset_id",
    f"CASE WHEN c_nationkey = 7 THEN 'x_' ELSE '' END || {table('c_custkey')} AS table_id",
    f"{request_text('c_custkey')} AS content",
])

# One default policy, its count taken from a table.
DEFAULT_POLICY = ("nation", [
    """'{"limit": {"count": ' || CAST(40 * count(*) AS STRING) || ', "percentage": 30.1}, '
    || '"default_sample": {"size": {"count": 10, "percentage": 5.5}, "spec": {"type": "sorted", '
    || '"properties": {"by": "l_quantity", "direction": "DESC"}}}}' AS content""",
])

ROW_COUNT = "count(*) * 100 + max(o_orderkey) % 97"

CATALOG_TABLES = ("customer", [
    f"{project('c_custkey')} AS project_id",
    f"{dataset('c_custkey')} AS dataset_id",
    f"{table('c_custkey')} AS table_id",
])

# Deliveries of commands: one command has a third of all, the others up to 11 within an hour or so.
DELIVERIES = ("events", [
    "CASE WHEN event_id % 3 = 0 THEN -1 ELSE CAST(floor(event_id / 16.0) AS BIGINT) END AS command_id",
    "ts AS delivered",
    "event_id AS delivery",
])

LOCATED_TABLES = ("customer", [
    f"{project('c_custkey')} AS project_id",
    "'d_' || CAST(c_nationkey AS STRING) AS dataset_id",
    f"{table('c_custkey')} AS table_id",
])

TABLE_REF_TEXT = f"""CASE c_custkey % 8
    WHEN 0 THEN {project('c_custkey')} || '.' || c_mktsegment
    WHEN 1 THEN ' ' || {project('c_custkey')} || ' . ' || c_mktsegment || '.' || c_name || ' '
    WHEN 2 THEN {project('c_custkey')} || '..' || c_name
    WHEN 3 THEN {project('c_custkey')} || '.' || c_mktsegment || '.' || c_name || '@ EU '
    WHEN 4 THEN {project('c_custkey')} || '.' || c_mktsegment || '.' || c_name || '@'
    WHEN 5 THEN {project('c_custkey')} || '.' || c_mktsegment || '.' || c_name || '.x'
    WHEN 6 THEN {project('c_custkey')} || '. .' || c_name || '@EU@US'
    ELSE {project('c_custkey')} || '.' || c_mktsegment || '.' || c_name
END"""

SPEC_PARTS = [
    "CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'random' WHEN 2 THEN ' Sorted ' "
    "WHEN 3 THEN p_type ELSE 'sorted' END AS sample_type",
    "CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || p_name "
    "ELSE p_name END AS sort_by",
    "CASE p_partkey % 4 WHEN 0 THEN 'ASC' WHEN 1 THEN ' desc' WHEN 2 THEN p_brand "
    "ELSE NULL END AS direction",
]

SIZE_PARTS = [
    "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_quantity AS BIGINT) - 5 END AS wanted_count",
    "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount * 1500e0 - 20e0 END AS wanted_percentage",
]

JOB_PARTS = [
    "'p' AS project_id",
    "'d' AS dataset_id",
    "CASE WHEN o_orderstatus = 'O' THEN 'embeddings' ELSE 'orders' END AS table_id",
    "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'p.d.s' END AS source_table",
    "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE 'q.d.s' END AS target_table",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey - 50 END AS amount",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'random' ELSE 'sorted' END AS sample_type",
    "CASE o_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'embedding' "
    "WHEN 3 THEN 'LABEL' ELSE ' o_totalprice ' END AS sort_by",
    "CASE o_orderkey % 5 WHEN 0 THEN o_orderpriority WHEN 1 THEN ' asc ' ELSE 'DESC' END AS direction",
]

_REF = '{"project_id": "p", "dataset_id": "d", "table_id": "t_'

MESSAGE_TEXT = f"""CASE event_id % 12
    WHEN 0 THEN '{{"type": "START"}}'
    WHEN 1 THEN '{{"type": " sample_policy_prefix ", "prefix": "p_' || CAST(user_id AS STRING) || '/d/"}}'
    WHEN 2 THEN '{{"type": "SAMPLE_START", "sample_request": {{"table_reference": {_REF}'
        || CAST(user_id AS STRING) || '"}}, "sample": {{}}}}, "target_table": {_REF}'
        || CAST(user_id AS STRING) || '", "location": "EU"}}}}'
    WHEN 3 THEN '{{"type": "SAMPLE_DONE", "sample_request": {{"table_reference": {_REF}'
        || CAST(user_id AS STRING) || '"}}, "sample": {{}}}}, "target_table": {_REF}'
        || CAST(user_id AS STRING) || '"}}, "start_timestamp": 1, "end_timestamp": '
        || CAST(user_id % 3 AS STRING) || ', "error_message": "", "amount_inserted": '
        || CAST(user_id AS STRING) || '}}'
    WHEN 4 THEN '{{"type": "REMOVE_DATASET", "project_id": "p", "dataset_id": "' || event_type || '"}}'
    WHEN 5 THEN '{{"name": "projects/P/locations/L/transferConfigs/C' || CAST(user_id AS STRING)
        || '/runs/R", "dataSourceId": "copy", "params": {{"source_project_id": "p", '
        || '"source_dataset_id": "d_' || CAST(user_id AS STRING) || '"}}, "state": "'
        || CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END || '"}}'
    WHEN 6 THEN props
    WHEN 7 THEN '{{type: "START"}}'
    WHEN 8 THEN '[' || CAST(user_id AS STRING) || ']'
    WHEN 9 THEN '{{"type": "REMOVE_DATASET", "project_id": ' || CAST(user_id AS STRING) || '}}'
    WHEN 10 THEN '{{"type": "transfer_run_done", "name": "cfg", "payload": {{"state": "SUCCEEDED", '
        || '"params": {{"source_project_id": "p", "source_dataset_id": "e_'
        || CAST(user_id AS STRING) || '"}}}}}}'
    ELSE '{{"type": "' || event_type || '"}}'
END"""

PUBLISH_TIME = (
    "replace(CAST(ts AS STRING), ' ', 'T') || CASE event_id % 3 WHEN 0 THEN 'Z' ELSE '' END"
)
