"""Telemetry reports over stand-in tables.

Each stand-in is one plain SELECT over driver tables, read by both engines;
the reports themselves are DataFrame functions here and SQL in the twin.
"""

from pyspark.sql import functions as F

from millrace.plans import telemetry as tm
from millrace.probes.registry import Tables, probe

_PARTS = "SELECT DISTINCT CAST(year(l_shipdate) - 1994 AS INTEGER) AS n FROM {lineitem}"
_OBJ = "CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END"
_FLAG = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"

STAND_INS = {
    "ag": "SELECT r_regionkey AS group_id, r_name AS name, 'wsfc' AS cluster_type_desc FROM {region}",
    "replica": """
        SELECT s_suppkey AS replica_id, s_nationkey % 5 AS group_id, s_name AS replica_server_name,
               CASE WHEN s_suppkey % 2 = 0 THEN 'SYNCHRONOUS_COMMIT' ELSE 'ASYNCHRONOUS_COMMIT' END AS availability_mode_desc,
               CASE WHEN s_suppkey % 3 = 0 THEN 'AUTOMATIC' ELSE 'MANUAL' END AS failover_mode_desc,
               concat('tcp://', s_name, ':1433') AS read_only_routing_url FROM {supplier}""",
    "state": """
        SELECT s_suppkey AS replica_id, CASE s_suppkey % 4 WHEN 0 THEN 'PRIMARY' WHEN 3 THEN 'RESOLVING' ELSE 'SECONDARY' END AS role_desc,
               CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'OFFLINE' ELSE 'ONLINE' END AS operational_state_desc,
               CASE s_suppkey % 11 WHEN 0 THEN 'DISCONNECTED' ELSE 'CONNECTED' END AS connected_state_desc,
               CASE s_suppkey % 13 WHEN 0 THEN 'NOT_HEALTHY' WHEN 1 THEN NULL ELSE 'HEALTHY' END AS synchronization_health_desc
        FROM {supplier}""",
    "db_state": """
        SELECT o_custkey AS replica_id, o_orderkey % 30 AS database_id, o_orderstatus AS synchronization_state_desc,
               o_orderpriority AS synchronization_health_desc, CAST(floor(o_totalprice / 40) AS BIGINT) AS log_send_queue_size,
               o_custkey % 9 AS log_send_rate, CAST(floor(o_totalprice / 4) AS BIGINT) AS redo_queue_size, o_orderkey % 5 AS redo_rate,
               o_orderdate AS last_commit_time, o_orderdate AS last_redone_time, o_orderkey AS last_redone_lsn,
               CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS is_local FROM {orders} WHERE o_custkey % 10 <> 3""",
    "db": "SELECT n_nationkey AS database_id, n_name AS name FROM {nation}",
    "listener": """
        SELECT n_regionkey AS group_id, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE lower(n_name) END AS dns_name,
               1433 + n_nationkey AS port FROM {nation}""",
    "counter": """
        SELECT CASE user_id % 4 WHEN 0 THEN 'Server:Availability Replica' WHEN 1 THEN 'server:DATABASE replica' ELSE 'Buffer Manager' END AS object_name,
               event_type AS counter_name, concat('u', user_id) AS instance_name, event_id AS cntr_value, 65792 AS cntr_type FROM {events}""",
    "row_group": f"""
        SELECT {_OBJ} AS object_id, 1 AS index_id, CAST(year(l_shipdate) - 1994 AS INTEGER) AS partition_number, {_FLAG} AS row_group_id,
               'COMPRESSED' AS state_desc, count(*) AS total_rows, sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS deleted_rows,
               CAST(sum(floor(l_extendedprice)) AS BIGINT) AS size_in_bytes, min(l_shipdate) AS created_time, max(l_shipdate) AS closed_time,
               CASE {_FLAG} WHEN 0 THEN 'BULKLOAD' WHEN 1 THEN 'DICTIONARY_SIZE' END AS trim_reason_desc,
               CASE {_FLAG} WHEN 2 THEN 'TUPLE_MOVER' END AS transition_to_compressed_state_desc, 500 + {_FLAG} AS delta_store_hobt_id
        FROM {{lineitem}} GROUP BY 1, 3, 4""",
    "partition": f"""
        SELECT {_OBJ} AS object_id, 1 AS index_id, CAST(year(l_shipdate) - 1994 AS INTEGER) AS partition_number,
               {_OBJ} * 100 + CAST(year(l_shipdate) - 1994 AS INTEGER) AS partition_id, 'COLUMNSTORE' AS data_compression_desc,
               sum(CASE WHEN year(l_shipdate) % 2 = 0 THEN 1 ELSE 0 END) AS rows FROM {{lineitem}} GROUP BY 1, 3, 4""",
    "segment": f"""
        SELECT {_OBJ} * 100 + CAST(year(l_shipdate) - 1994 AS INTEGER) AS partition_id, {_FLAG} AS row_group_id, 1 AS column_id,
               min(l_partkey) AS min_data_id, max(l_partkey) AS max_data_id FROM {{lineitem}} WHERE l_returnflag <> 'R' GROUP BY 1, 2
        UNION ALL SELECT {_OBJ} * 100 + CAST(year(l_shipdate) - 1994 AS INTEGER), {_FLAG}, 2, min(l_suppkey), max(l_suppkey)
        FROM {{lineitem}} WHERE l_returnflag <> 'R' GROUP BY 1, 2""",
    "col": f"SELECT DISTINCT {_OBJ} AS object_id, 1 AS column_id, 'l_partkey' AS name FROM {{lineitem}}",
    "unit": f"""
        SELECT 100 + n AS container_id, 'IN_ROW_DATA' AS type_desc, n * 10 AS total_pages FROM ({_PARTS}) p
        UNION ALL SELECT 100 + n, 'LOB_DATA', n * 7 FROM ({_PARTS}) p""",
    "idx": f"SELECT DISTINCT {_OBJ} AS object_id, 1 AS index_id, concat('CCI_', l_linestatus) AS name FROM {{lineitem}}",
    "page": """
        SELECT 100 + CAST(year(l_shipdate) - 1994 AS INTEGER) AS rowset_id, l_linenumber AS file_id, l_orderkey AS page_id, 1 AS index_id,
               l_returnflag AS type_desc, 1 AS is_allocated, 0 AS is_iam_page, l_linestatus AS page_type_desc FROM {lineitem}""",
    "internal": f"""
        SELECT 100 + n AS partition_id, n AS row_group_id, 'COLUMN_STORE_DELTA_STORE' AS internal_object_type_desc,
               'NONE' AS data_compression_desc FROM ({_PARTS}) p WHERE n < 4""",
    "used": f"""
        SELECT {_FLAG} + 10 AS object_id, CASE {_FLAG} WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END AS index_id,
               CAST(year(l_shipdate) - 1994 AS INTEGER) AS partition_number, CAST(sum(floor(l_quantity)) AS BIGINT) AS in_row_data_page_count,
               CAST(sum(floor(l_quantity)) + 130 AS BIGINT) AS used_page_count, CAST(sum(floor(l_quantity)) * 2 AS BIGINT) AS reserved_page_count,
               count(*) AS row_count FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "obj": f"""
        SELECT DISTINCT {_FLAG} + 10 AS object_id, 'dbo' AS schema_name, concat('T', l_returnflag) AS name,
               0 AS is_shipped FROM {{lineitem}} UNION ALL SELECT 99, 'sys', 'shipped', 1""",
    "uidx": f"""
        SELECT DISTINCT {_FLAG} + 10 AS object_id, CASE {_FLAG} WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END AS index_id,
               CASE WHEN l_returnflag = 'A' THEN NULL ELSE concat('IX_', l_returnflag) END AS name,
               CASE WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS data_space_id FROM {{lineitem}}""",
    "space": "SELECT 1 AS data_space_id, 'PRIMARY' AS name UNION ALL SELECT 2, 'ps_year'",
    "scheme": "SELECT 2 AS data_space_id, 'ps_year' AS name, 7 AS function_id UNION ALL SELECT 3, 'ps_other', 8",
    "destination": f"SELECT 2 AS partition_scheme_id, n AS destination_id, 10 + n % 2 AS data_space_id FROM ({_PARTS}) p",
    "filegroup": "SELECT 10 AS data_space_id, 'FG_EVEN' AS name UNION ALL SELECT 12, 'FG_NONE'",
    "border": f"SELECT 7 AS function_id, n AS boundary_id, (n + 1994) * 100 AS value FROM ({_PARTS}) p WHERE n < 7",
    "lock": """
        SELECT l_orderkey AS request_session_id, l_linenumber % 2 AS resource_database_id,
               CASE l_partkey % 4 WHEN 0 THEN 'OBJECT' WHEN 1 THEN 'PAGE' WHEN 2 THEN 'KEY' ELSE 'DATABASE' END AS resource_type,
               CASE l_partkey % 4 WHEN 0 THEN l_suppkey % 25 WHEN 3 THEN 0 ELSE 1000 + l_suppkey END AS resource_associated_entity_id,
               l_orderkey * 10 + l_linenumber AS lock_owner_address, l_returnflag AS request_mode, l_linestatus AS request_status,
               '' AS resource_subtype, concat('r', l_partkey) AS resource_description FROM {lineitem}""",
    "wait": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS resource_address, l_orderkey % 7 AS blocking_session_id, l_orderkey * 3 AS wait_duration_ms
        FROM {lineitem} WHERE l_orderkey % 10 = 0""",
    "hobt": """
        SELECT 1000 + s_suppkey AS hobt_id, CAST(s_nationkey AS BIGINT) AS object_id,
               CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE NULL END AS index_id FROM {supplier} WHERE s_suppkey % 6 <> 5""",
    "tab": "SELECT CAST(n_nationkey AS BIGINT) AS object_id, n_name AS name FROM {nation} WHERE n_nationkey < 22",
    "tidx": """
        SELECT CAST(n_nationkey AS BIGINT) AS object_id, 1 AS index_id, concat('PK_', n_name) AS name FROM {nation} WHERE n_nationkey < 20
        UNION ALL SELECT CAST(n_nationkey AS BIGINT), 2, concat('IX_', n_name) FROM {nation} WHERE n_nationkey < 10""",
    "feedback": """
        SELECT event_id AS plan_id, 1 AS feature_id, CASE WHEN event_type = 'click' THEN 'CE Feedback' ELSE 'Memory Grant Feedback' END AS feature_desc,
               CASE WHEN event_type = 'click' THEN concat('{{"Feedback hints":"', CASE event_id % 7 WHEN 0 THEN 'Independence'
                    WHEN 1 THEN 'Exponential backoff' WHEN 2 THEN 'Min selectivity' WHEN 3 THEN 'Simple containment' WHEN 4 THEN 'Base containment'
                    WHEN 5 THEN 'Something else' ELSE '' END, '"}}')
               ELSE concat('{{"NodeId":"', user_id, '","AdditionalMemoryKB":"', event_id, '","Count":"3"}}') END AS feedback_data,
               2 AS state, 'FEEDBACK_VALID' AS state_desc, ts AS last_updated_time FROM {events}""",
    "plan_of": "SELECT event_id AS plan_id, user_id AS query_id, props AS query_plan FROM {events} WHERE event_id % 10 <> 9",
    "hint": "SELECT c_custkey AS query_id, c_mktsegment AS query_hint_text FROM {customer} WHERE c_custkey % 2 = 0",
    "node": "SELECT n_nationkey AS node_id, CASE WHEN n_nationkey % 7 = 0 THEN 'OFFLINE' ELSE 'ONLINE' END AS node_state_desc FROM {nation}",
    "scheduler": """
        SELECT s_suppkey AS cpu_id, s_nationkey AS parent_node_id, s_suppkey * 3 AS scheduler_id,
               CASE WHEN s_suppkey % 5 = 0 THEN 'HIDDEN ONLINE' ELSE 'VISIBLE ONLINE' END AS status FROM {supplier}""",
    "query": """
        SELECT user_id AS query_id, concat('proc_', user_id) AS name, user_id + 1000 AS query_text_id, max(ts) AS last_execution_time
        FROM {events} GROUP BY user_id""",
    "plan": """
        SELECT user_id * 1000 + ascii(event_type) AS plan_id, user_id AS query_id, max(ts) AS last_execution_time,
               max(event_id) % 2 = 0 AS is_forced_plan, max(event_id) % 3 = 0 AS is_parallel_plan, max(event_type) AS plan_forcing_type_desc
        FROM {events} GROUP BY user_id, event_type, ascii(event_type)""",
    "runtime": """
        SELECT user_id * 1000 + ascii(event_type) AS plan_id, CAST(round(value * 1000) AS BIGINT) AS min_duration,
               CAST(round(value * 1000) AS BIGINT) AS avg_duration, CAST(round(value * 1000) AS BIGINT) AS max_duration,
               event_id % 5 - 1 AS min_rowcount, event_id % 11 AS max_rowcount, ts AS last_execution_time FROM {events}""",
    "statement": """
        SELECT p_partkey AS statement_id, max(l_shipdate) AS last_execution_time, concat('SELECT ', max(p_name), ' FROM t') AS text,
               p_partkey % 4 * 2 AS statement_start_offset, CASE WHEN p_partkey % 3 = 0 THEN -1 ELSE 20 END AS statement_end_offset,
               count(*) AS execution_count, CAST(sum(floor(l_quantity)) AS BIGINT) AS total_logical_reads,
               CAST(sum(l_linenumber) AS BIGINT) AS total_logical_writes, CAST(sum(floor(l_extendedprice)) * 3000 AS BIGINT) AS total_worker_time,
               CAST(max(floor(l_extendedprice)) * 1800 AS BIGINT) AS max_worker_time, CAST(sum(floor(l_quantity)) * 1000000 AS BIGINT) AS total_elapsed_time,
               CAST(max(floor(l_quantity)) * 3700000 AS BIGINT) AS max_elapsed_time, CAST(sum(l_linenumber) AS BIGINT) AS total_dop,
               CAST(sum(l_linenumber) AS BIGINT) AS total_rows, max(l_linenumber) AS max_rows, 1 AS dbid, p_partkey % 7000 AS plan_handle
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY p_partkey""",
    "session": """
        SELECT c_custkey AS session_id, c_custkey % 2 AS database_id, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS is_user_process,
               c_mktsegment AS host_name, 'app' AS program_name, c_name AS login_name FROM {customer}""",
    "process": """
        SELECT o_custkey AS spid, o_orderkey % 2 AS dbid, o_orderkey AS kpid, o_orderkey % 4 AS ecid, o_orderstatus AS status, 1 AS open_tran,
               o_orderpriority AS waitresource FROM {orders}""",
    "request": """
        SELECT doc_id AS session_id, doc_id AS sql_handle, doc_id AS plan_handle, lang AS wait_type, n_chars AS wait_time,
               DATE '2024-01-01' AS start_time, doc_id % 50 * 2 AS statement_start_offset,
               CASE WHEN doc_id % 3 = 0 THEN -1 ELSE doc_id % 50 * 2 + n_chars END AS statement_end_offset FROM {documents}""",
    "grant_": "SELECT vec_id AS session_id, label AS dop, vec_id * 10 AS granted_memory_kb FROM {embeddings}",
    "text_": "SELECT doc_id AS sql_handle, text FROM {documents}",
    "buffer": "SELECT doc_id AS session_id, source AS event_info FROM {documents}",
    "runtime_text": "SELECT page_id AS session_id, concat('run ', url) AS query_plan FROM {pages} WHERE page_id % 3 = 0",
    "plan_text": "SELECT page_id AS plan_handle, url AS query_plan FROM {pages}",
    "part_rows": """
        SELECT CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS object_id, concat('icon.', l_linestatus) AS table_name, 1 AS index_id, 7 AS function_id,
               CAST(year(l_shipdate) - 1994 AS INTEGER) AS partition_number, 5 AS used_page_count, count(*) AS row_count
        FROM {lineitem} GROUP BY l_linestatus, 5""",
    "stats": f"""
        SELECT DISTINCT {_OBJ} AS object_id, 1 AS stats_id, 'PK_stats' AS name FROM {{lineitem}}
        UNION ALL SELECT DISTINCT {_OBJ}, 2, 'other' FROM {{lineitem}}""",
    "inc_stats": f"""
        SELECT {_OBJ} AS object_id, 1 AS stats_id, CAST(year(l_shipdate) - 1994 AS INTEGER) AS partition_number, max(l_shipdate) AS last_updated,
               sum(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS rows, count(DISTINCT l_orderkey) AS rows_sampled, 200 AS steps,
               count(*) AS unfiltered_rows, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS modification_counter
        FROM {{lineitem}} GROUP BY 1, 3""",
    "cust_part": """
        SELECT o_custkey AS object_id, 1 AS partition_number, 1 AS index_id,
               count(*) * CASE o_custkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 1000 ELSE 5000 END AS rows FROM {orders} GROUP BY o_custkey""",
    "cust_stats": """
        SELECT o_custkey AS object_id, count(*) * 400 AS modification_counter, max(o_orderdate) AS last_updated FROM {orders} GROUP BY o_custkey""",
    "stat_table": "SELECT s_suppkey AS object_id, 'dbo' AS schema_name, s_name AS table_name, s_suppkey % 2 = 0 AS is_memory_optimized FROM {supplier}",
    "stat_list": """
        SELECT l_suppkey AS object_id, l_linenumber AS stats_id, concat('stats_', max(l_linenumber)) AS stats_name, false AS is_incremental,
               max(l_shipdate) AS last_updated FROM {lineitem} GROUP BY l_suppkey, l_linenumber""",
    "stat_cols": """
        SELECT l_suppkey AS object_id, l_linenumber AS stats_id, concat('c_', l_returnflag) AS column_name FROM {lineitem}
        WHERE l_linenumber < 6 GROUP BY l_suppkey, l_linenumber, l_returnflag""",
}
_DRIVER = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages"]


def _with(*keys: str) -> str:
    names = {d: d for d in _DRIVER}
    return "WITH " + ",\n".join(f"{k} AS ({STAND_INS[k].format(**names)})" for k in keys)


def _frames(t: Tables, *keys: str):
    out = []
    for k in keys:
        used = {d: getattr(t, d) for d in _DRIVER if "{" + d + "}" in STAND_INS[k]}
        out.append(t.spark.sql(STAND_INS[k], **used))
    return out


def _stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


@probe("replica_inventory", _with("ag", "replica", "state") + """
SELECT name AS group_name, replica_server_name, availability_mode_desc, failover_mode_desc, read_only_routing_url, cluster_type_desc,
       role_desc, operational_state_desc, connected_state_desc, synchronization_health_desc
FROM ag JOIN replica USING (group_id) JOIN state USING (replica_id) ORDER BY 1, 2
""")
def replica_inventory(t: Tables):
    return tm.replica_inventory(*_frames(t, "ag", "replica", "state"))


@probe("replica_lag", _with("ag", "replica", "db_state", "db") + """
SELECT ag.name AS group_name, database_id, db.name AS database_name, replica_server_name, availability_mode_desc,
       synchronization_state_desc, synchronization_health_desc, log_send_queue_size, log_send_rate, redo_queue_size, redo_rate,
       last_commit_time, date_diff('second', last_commit_time, TIMESTAMP '2002-01-01 00:00:00') AS seconds_behind
FROM ag JOIN replica USING (group_id) JOIN db_state USING (replica_id) JOIN db USING (database_id)
""")
def replica_lag(t: Tables):
    return tm.replica_lag(*_frames(t, "ag", "replica", "db_state", "db"), as_of=_stamp("2002-01-01 00:00:00"))


@probe("role_description", _with("ag", "replica", "state") + """
SELECT name AS group_name, role_desc, CASE role_desc WHEN 'PRIMARY' THEN 'This is the Primary Replica'
       WHEN 'SECONDARY' THEN 'This is a Secondary Replica' ELSE 'Unknown Role' END AS role_description
FROM ag JOIN replica USING (group_id) JOIN state USING (replica_id) WHERE replica_server_name = 'Supplier#000000003'
""")
def role_description(t: Tables):
    return tm.role_description(*_frames(t, "ag", "replica", "state"), server="Supplier#000000003")


@probe("connection_strings", _with("ag", "listener") + """
SELECT name AS group_name, dns_name, port, 'Server=' || dns_name || ',' || port || ';Database=Sales;ApplicationIntent=ReadOnly' AS read_only_text,
       'Server=' || dns_name || ',' || port || ';Database=Sales;' AS read_write_text FROM ag JOIN listener USING (group_id)
""")
def connection_strings(t: Tables):
    return tm.connection_texts(*_frames(t, "ag", "listener"), database="Sales")


@probe("performance_counters", _with("counter") + """
SELECT * FROM counter WHERE object_name ILIKE '%Availability Replica%' OR object_name ILIKE '%Database Replica%'
""")
def performance_counters(t: Tables):
    return tm.counters(*_frames(t, "counter"), parts=["Availability Replica", "Database Replica"])


@probe("health_status", _with("ag", "replica", "state", "db_state", "db") + """
SELECT ag.name AS group_name, replica_server_name, role_desc, operational_state_desc, connected_state_desc, state.synchronization_health_desc,
       db.name AS database_name, synchronization_state_desc, log_send_queue_size, log_send_rate, redo_queue_size, redo_rate,
       CASE WHEN operational_state_desc <> 'ONLINE' OR connected_state_desc <> 'CONNECTED' OR state.synchronization_health_desc <> 'HEALTHY' THEN 'ISSUE'
            WHEN log_send_queue_size > 10240 OR redo_queue_size > 10240 THEN 'PERFORMANCE_CONCERN' ELSE 'HEALTHY' END AS health_status
FROM ag JOIN replica USING (group_id) JOIN state USING (replica_id) LEFT JOIN db_state USING (replica_id)
LEFT JOIN db ON db_state.database_id = db.database_id
""")
def health_status(t: Tables):
    return tm.health_report(*_frames(t, "ag", "replica", "state", "db_state", "db"))


@probe("redo_status", _with("ag", "replica", "db_state", "db") + """
SELECT ag.name AS group_name, db.name AS database_name, redo_queue_size, redo_rate, log_send_queue_size, log_send_rate, last_redone_lsn,
       last_redone_time, date_diff('second', last_redone_time, TIMESTAMP '2002-01-01 00:00:00') AS seconds_since_redo,
       CASE WHEN redo_rate = 0 THEN 'STALLED' WHEN redo_queue_size > 100000 THEN 'HIGH_QUEUE' WHEN redo_queue_size > 50000 THEN 'MEDIUM_QUEUE'
            ELSE 'NORMAL' END AS redo_status, CASE WHEN redo_rate > 0 THEN redo_queue_size // redo_rate END AS catch_up_seconds
FROM ag JOIN replica USING (group_id) JOIN db_state USING (replica_id) JOIN db USING (database_id)
WHERE replica_server_name = 'Supplier#000000007' AND is_local = 1
""")
def redo_status(t: Tables):
    return tm.redo_report(
        *_frames(t, "ag", "replica", "db_state", "db"), server="Supplier#000000007", as_of=_stamp("2002-01-01 00:00:00")
    )


_ROW_GROUPS = """
SELECT r.object_id, state_desc, r.partition_number, r.row_group_id, total_rows, c.name AS column_name, min_data_id, max_data_id,
       CAST(deleted_rows AS BIGINT) AS deleted_rows, size_in_bytes // 1048576 AS size_mb, trim_reason_desc,
       transition_to_compressed_state_desc, delta_store_hobt_id, created_time, closed_time
FROM row_group r JOIN partition p USING (object_id, index_id, partition_number)
LEFT JOIN segment s ON s.partition_id = p.partition_id AND s.row_group_id = r.row_group_id
LEFT JOIN col c ON c.object_id = r.object_id AND c.column_id = s.column_id
"""


@probe("row_group_report", _with("row_group", "partition", "segment", "col") + f"""
{_ROW_GROUPS}""")
def row_group_report(t: Tables):
    return tm.row_group_report(*_frames(t, "row_group", "partition", "segment", "col"))


@probe("row_groups_of_object", _with("row_group", "partition", "segment", "col") + f"""
{_ROW_GROUPS} WHERE r.object_id = (SELECT max(object_id) FROM row_group)
""")
def row_groups_of_object(t: Tables):
    frames = _frames(t, "row_group", "partition", "segment", "col")
    return tm.row_group_report(*frames, object_id=frames[0].agg(F.max("object_id")).first()[0])


_STORAGE = """
SELECT object_id, i.name AS index_name, index_id, partition_number, data_compression_desc, type_desc, total_pages, CAST(rows AS BIGINT) AS rows
FROM unit JOIN partition p ON container_id = partition_id JOIN idx i USING (object_id, index_id) WHERE rows > 0
"""


@probe("storage_pages", _with("unit", "partition", "idx") + _STORAGE)
def storage_pages(t: Tables):
    return tm.storage_pages(*_frames(t, "unit", "partition", "idx"))


@probe("storage_pages_of_object", _with("unit", "partition", "idx") + _STORAGE + " AND object_id = (SELECT min(object_id) FROM partition)")
def storage_pages_of_object(t: Tables):
    frames = _frames(t, "unit", "partition", "idx")
    return tm.storage_pages(*frames, object_id=frames[1].agg(F.min("object_id")).first()[0])


@probe("page_listing", _with("page", "internal") + """
SELECT file_id, page_id, index_id, type_desc, is_allocated, is_iam_page, page_type_desc, row_group_id, internal_object_type_desc,
       data_compression_desc, rowset_id FROM page JOIN internal ON rowset_id = partition_id
""")
def page_listing(t: Tables):
    return tm.page_listing(*_frames(t, "page", "internal"))


@probe("storage_summary", _with("used", "obj", "uidx", "space", "scheme", "destination", "filegroup", "border") + """
SELECT concat(schema_name, '.', o.name) AS table_name, u.object_id, u.index_id, CASE WHEN u.index_id = 0 THEN 'HEAP' ELSE i.name END AS index_name,
       s.name AS scheme_name, u.partition_number, l.value AS lower_border, coalesce(r.value, 10000000) AS upper_border,
       coalesce(f.name, sp.name) AS filegroup_name, CAST(in_row_data_page_count // 128 AS DOUBLE) AS data_mb,
       CAST(used_page_count // 128 AS DOUBLE) AS used_mb, CAST(reserved_page_count // 128 AS DOUBLE) AS reserved_mb,
       CASE WHEN u.index_id IN (0, 1) THEN row_count ELSE 0 END AS row_count, CASE WHEN u.index_id IN (0, 1) THEN 'data' ELSE 'index' END AS type
FROM used u JOIN obj o ON o.object_id = u.object_id AND is_shipped = 0 JOIN uidx i ON i.object_id = u.object_id AND i.index_id = u.index_id
JOIN space sp ON sp.data_space_id = i.data_space_id LEFT JOIN scheme s ON s.data_space_id = i.data_space_id
LEFT JOIN destination d ON d.partition_scheme_id = s.data_space_id AND d.destination_id = u.partition_number
LEFT JOIN filegroup f ON f.data_space_id = d.data_space_id
LEFT JOIN border r ON r.function_id = s.function_id AND r.boundary_id = u.partition_number
LEFT JOIN border l ON l.function_id = s.function_id AND l.boundary_id = u.partition_number - 1
""")
def storage_summary(t: Tables):
    out = tm.storage_summary(
        *_frames(t, "used", "obj", "uidx", "space", "scheme", "destination", "filegroup", "border"),
        open_border=F.lit(tm.OPEN_UPPER_BORDER),
    )
    return out.withColumns({c: F.col(c).cast("double") for c in ("data_mb", "used_mb", "reserved_mb")})


@probe("lock_waits", _with("lock", "wait", "hobt", "tab", "tidx") + """
SELECT 'db1' AS database_name, request_session_id, resource_type, CASE resource_type WHEN 'OBJECT' THEN o.name ELSE po.name END AS object_name, i.name AS index_name,
       resource_subtype, resource_description, resource_associated_entity_id, request_mode, request_status, blocking_session_id,
       wait_duration_ms / 1000.0 AS wait_seconds
FROM lock LEFT JOIN wait ON lock_owner_address = resource_address LEFT JOIN hobt p ON resource_associated_entity_id = hobt_id
LEFT JOIN tab o ON resource_associated_entity_id = o.object_id LEFT JOIN tab po ON po.object_id = p.object_id
LEFT JOIN tidx i ON coalesce(o.object_id, p.object_id) = i.object_id AND coalesce(p.index_id, 1) = coalesce(i.index_id, 1)
WHERE resource_associated_entity_id > 0 AND request_session_id <> 5 AND resource_database_id = 1
""")
def lock_waits(t: Tables):
    return tm.lock_waits(*_frames(t, "lock", "wait", "hobt", "tab", "tidx"), database_id=1, database="db1", own_session=5)


@probe("memory_feedback", _with("feedback", "plan_of", "hint") + """
SELECT plan_id, feature_id, feature_desc, state, state_desc, last_updated_time, query_hint_text,
       CAST(json_extract_string(feedback_data, '$.NodeId') AS INTEGER) AS node_id,
       CAST(json_extract_string(feedback_data, '$.AdditionalMemoryKB') AS INTEGER) AS granted_memory_kb,
       CAST(json_extract_string(feedback_data, '$.Count') AS INTEGER) AS count, CAST(NULL AS BIGINT) AS average, CAST(NULL AS BIGINT) AS variance, query_id
FROM feedback JOIN plan_of USING (plan_id) LEFT JOIN hint USING (query_id) WHERE feature_desc = 'Memory Grant Feedback'
""")
def memory_feedback(t: Tables):
    return tm.memory_feedback(*_frames(t, "feedback", "plan_of", "hint"))


_MEANING = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tm.HINT_TEXT.items())


@probe("ce_feedback", _with("feedback", "plan_of", "hint") + f"""
, j AS (SELECT *, json_extract_string(feedback_data, '$."Feedback hints"') AS hint_in_use FROM feedback WHERE feature_desc = 'CE Feedback')
SELECT plan_id, feature_id, feature_desc, state, state_desc, last_updated_time, query_plan, hint_in_use, query_hint_text,
       CASE hint_in_use {_MEANING} END AS meaning, query_id
FROM j JOIN plan_of USING (plan_id) LEFT JOIN hint USING (query_id) WHERE hint_in_use <> ''
""")
def ce_feedback(t: Tables):
    return tm.estimation_feedback(*_frames(t, "feedback", "plan_of", "hint"))


@probe("cpu_groups", _with("node", "scheduler") + """
SELECT node_id, min(cpu_id) AS first_cpu, max(cpu_id) AS last_cpu, count(cpu_id) AS cpu_count, string_agg(CAST(cpu_id AS VARCHAR), ',' ORDER BY cpu_id) AS cpu_list
FROM node JOIN scheduler ON node_id = parent_node_id
WHERE scheduler_id < 255 AND status = 'VISIBLE ONLINE' AND node_state_desc = 'ONLINE' GROUP BY 1 ORDER BY 1
""")
def cpu_groups(t: Tables):
    return tm.cpu_groups(*_frames(t, "node", "scheduler"))


@probe("query_store_top", _with("query", "plan", "runtime") + """
, a AS (SELECT max(ts) - INTERVAL 3 DAY AS since FROM events)
SELECT query_id, max(q.name) AS name, max(query_text_id) AS query_text_id, plan_id, max(CAST(is_forced_plan AS INTEGER)) AS is_forced,
       max(plan_forcing_type_desc) AS plan_forcing_type_desc, max(CAST(is_parallel_plan AS INTEGER)) AS is_parallel,
       (min(min_duration) * 200 + 1000) // 2000 / 100.0 AS min_duration_ms,
       CAST((sum(avg_duration) * 200 + count(*) * 1000) // (count(*) * 2000) AS BIGINT) / 100.0 AS avg_duration_ms,
       (max(max_duration) * 200 + 1000) // 2000 / 100.0 AS max_duration_ms,
       max(r.last_execution_time) AS last_execution_time, min(min_rowcount) AS min_rowcount, max(max_rowcount) AS max_rowcount
FROM query q JOIN plan p USING (query_id) JOIN runtime r USING (plan_id), a
WHERE q.last_execution_time >= since AND p.last_execution_time >= since AND r.last_execution_time >= since
  AND min_rowcount >= 0 AND max_rowcount > 1
GROUP BY query_id, plan_id ORDER BY max_duration_ms DESC, query_id, plan_id LIMIT 100
""")
def query_store_top(t: Tables):
    newest = t.events.agg(F.max("ts")).scalar()
    out = tm.query_store_top(*_frames(t, "query", "plan", "runtime"), as_of=newest)
    return out.withColumns({c: F.col(c).cast("double") for c in ("min_duration_ms", "avg_duration_ms", "max_duration_ms")})


@probe("top_io", _with("statement", "plan_text") + """
, e AS (SELECT *, CASE WHEN statement_end_offset = -1 THEN length(text) * 2 ELSE statement_end_offset END AS e FROM statement
        WHERE max_worker_time / 1000000.0 > 180 OR max_elapsed_time / 1000000.0 > 180)
SELECT statement_id, last_execution_time, substring(text, statement_start_offset // 2 + 1, (e - statement_start_offset) // 2 + 1) AS statement,
       execution_count, (total_logical_reads + total_logical_writes) // execution_count AS avg_io_pages,
       total_logical_reads // execution_count AS avg_read_pages, total_logical_writes // execution_count AS avg_write_pages,
       round(total_worker_time / (execution_count * 1000000.0), 6) AS avg_cpu_seconds, round(total_worker_time / 1000000.0, 6) AS total_cpu_seconds,
       round(max_worker_time / 1000000.0, 6) AS max_cpu_seconds, total_dop // execution_count AS avg_dop,
       round(total_elapsed_time / (execution_count * 1000000.0), 6) AS avg_elapsed_seconds,
       round(total_elapsed_time / 1000000.0, 6) AS total_elapsed_seconds, round(max_elapsed_time / 1000000.0, 6) AS max_elapsed_seconds,
       total_rows, max_rows, query_plan
FROM e LEFT JOIN plan_text USING (plan_handle) ORDER BY avg_io_pages DESC, statement_id LIMIT 50
""")
def top_io(t: Tables):
    out = tm.top_io(*_frames(t, "statement", "plan_text"), database_id=1)
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith("_seconds")})


@probe("running_statements", _with("session", "process", "request", "grant_", "text_", "buffer", "plan_text", "runtime_text") + """
, e AS (SELECT *, CASE WHEN statement_end_offset = -1 THEN length(text) * 2 ELSE statement_end_offset END AS e FROM request JOIN text_ USING (sql_handle))
SELECT s.session_id, kpid, ecid, host_name, program_name, login_name, wait_type, wait_time, status, dop, granted_memory_kb, open_tran, waitresource,
       start_time, CASE WHEN statement_start_offset = 0 THEN substring(text, 1, greatest((e - statement_start_offset) // 2 - 1, 0))
                        ELSE substring(text, statement_start_offset // 2, greatest((e - statement_start_offset) // 2, 0)) END AS statement,
       event_info AS parent_statement, x.query_plan, w.query_plan AS runtime_plan
FROM session s JOIN process p ON s.session_id = p.spid AND s.database_id = p.dbid JOIN e ON e.session_id = s.session_id
LEFT JOIN grant_ g ON g.session_id = s.session_id JOIN buffer b ON b.session_id = s.session_id LEFT JOIN plan_text x ON x.plan_handle = e.plan_handle
LEFT JOIN runtime_text w ON w.session_id = s.session_id
WHERE is_user_process = 1 AND s.database_id = 1 AND s.session_id > 50 AND s.session_id <> 51
""")
def running_statements(t: Tables):
    *frames, runtime = _frames(t, "session", "process", "request", "grant_", "text_", "buffer", "plan_text", "runtime_text")
    return tm.running_statements(*frames, database_id=1, own_session=51, runtime_plan=runtime)


@probe("stats_freshness", _with("part_rows", "border", "stats", "inc_stats") + """
, p AS (SELECT p.*, s.stats_id, s.name AS stats_name, CAST(coalesce(b.value, 10000000) AS INTEGER) AS upper_border
        FROM part_rows p LEFT JOIN border b ON b.function_id = p.function_id AND b.boundary_id = p.partition_number
        JOIN stats s ON s.object_id = p.object_id AND s.stats_id = 1)
SELECT table_name, stats_name, p.partition_number, upper_border, last_updated, row_count, CAST(rows AS BIGINT) AS stats_row_count, rows_sampled,
       steps, unfiltered_rows, CAST(modification_counter AS BIGINT) AS modification_counter
FROM p JOIN inc_stats i ON i.object_id = p.object_id AND i.stats_id = p.stats_id AND i.partition_number = p.partition_number
WHERE upper_border BETWEEN 199600 AND 10000000
""")
def stats_freshness(t: Tables):
    return tm.stats_freshness(*_frames(t, "part_rows", "border", "stats", "inc_stats"), first=199600, last=10000000)


@probe("stats_freshness_of_table", _with("part_rows", "stats", "inc_stats") + """
SELECT p.table_name, s.name AS stats_name, p.partition_number, 10000000 AS upper_border, last_updated, row_count, CAST(rows AS BIGINT) AS stats_row_count,
       rows_sampled, steps, unfiltered_rows, CAST(modification_counter AS BIGINT) AS modification_counter
FROM part_rows p JOIN stats s ON s.object_id = p.object_id AND s.stats_id = 1
JOIN inc_stats i ON i.object_id = p.object_id AND i.stats_id = 1 AND i.partition_number = p.partition_number WHERE p.table_name = 'icon.O'
""")
def stats_freshness_of_table(t: Tables):
    """One table; without borders every partition is open above."""
    parts, border, stats, inc = _frames(t, "part_rows", "border", "stats", "inc_stats")
    return tm.stats_freshness(parts, border.limit(0), stats, inc, first=199600, last=10000000, tables=["icon.O"])


@probe("stats_threshold", _with("cust_part", "cust_stats") + """
, l AS (SELECT *, CASE WHEN rows < 500 THEN 500 WHEN rows <= 25000 THEN rows // 5 ELSE CAST(floor(sqrt(1000.0 * rows)) AS BIGINT) END AS update_threshold
        FROM cust_part JOIN cust_stats USING (object_id))
SELECT object_id, partition_number, rows AS current_rows, modification_counter, last_updated, update_threshold,
       CASE WHEN modification_counter >= update_threshold THEN 'Should Update' ELSE 'Below Threshold' END AS update_status FROM l
""")
def stats_threshold(t: Tables):
    return tm.stats_threshold(*_frames(t, "cust_part", "cust_stats"))


@probe("stats_catalog", _with("stat_table", "stat_list", "stat_cols") + """
SELECT schema_name, table_name, stats_name, column_name, s.stats_id, is_incremental, last_updated
FROM stat_table t JOIN stat_list s USING (object_id) LEFT JOIN stat_cols c ON c.object_id = s.object_id AND c.stats_id = s.stats_id
WHERE table_name = 'Supplier#000000002'
""")
def stats_catalog(t: Tables):
    return tm.stats_catalog(*_frames(t, "stat_table", "stat_list", "stat_cols"), name="Supplier#000000002")


@probe("stats_histograms", _with("stat_table", "stat_list", "stat_cols") + """
, v AS (SELECT l_suppkey AS object_id, l_linenumber AS stats_id, l_quantity AS v, count(*) AS n FROM lineitem WHERE l_suppkey = 2 AND l_linenumber < 3 GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY stats_id ORDER BY v) AS upto, sum(n) OVER (PARTITION BY stats_id) AS total FROM v),
h AS (SELECT object_id, stats_id, CAST(ceil(upto * 20 / total) AS INTEGER) AS step_number, CAST(max(v) AS VARCHAR) AS range_high_key,
             CAST(sum(n) - arg_max(n, v) AS BIGINT) AS range_rows, arg_max(n, v) AS equal_rows, count(*) - 1 AS distinct_range_rows FROM c GROUP BY 1, 2, 3)
SELECT schema_name, table_name, stats_name, column_name, s.stats_id, is_incremental, is_memory_optimized, last_updated, step_number, range_high_key,
       range_rows, equal_rows, distinct_range_rows,
       round(CASE WHEN distinct_range_rows > 0 THEN range_rows / distinct_range_rows WHEN distinct_range_rows = 0 THEN 1.0 END, 6) AS average_range_rows
FROM stat_table t JOIN stat_list s USING (object_id) LEFT JOIN stat_cols c ON c.object_id = s.object_id AND c.stats_id = s.stats_id
LEFT JOIN h ON h.object_id = s.object_id AND h.stats_id = s.stats_id WHERE is_memory_optimized
""")
def stats_histograms(t: Tables):
    """Every statistic of the in-memory tables, two of them with the histogram of their quantities."""
    table, stats, columns = _frames(t, "stat_table", "stat_list", "stat_cols")
    own = lambda n: t.lineitem.filter((F.col("l_suppkey") == 2) & (F.col("l_linenumber") == n))
    steps = [tm.histogram_steps(own(n), "l_quantity", 2, n, F.col("l_quantity"), 20) for n in (1, 2)]
    out = tm.stats_histograms(table, stats, columns, steps[0].unionByName(steps[1]))
    return out.withColumn("average_range_rows", F.round("average_range_rows", 6))
