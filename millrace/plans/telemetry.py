"""Reports over tables of server telemetry.

Every report is a function of ordinary frames.  "Now" and the own server,
session or database are parameters.  Small catalog tables join by size: the
planner broadcasts what is under its limit and shuffles what is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import (
    concat_empty, int_div, lookup_text, seconds_behind, statement_slice, update_threshold,
)
from millrace.functions.semistructured import PLAN_ATTRIBUTES, json_rows, json_value, markup_elements
from millrace.operators.joins import HOT_ROWS, borders_by_offset, coalesced_join, left_join_many, spread_joins
from millrace.operators.profile import equi_height_histogram
from millrace.operators.rows import in_order
from millrace.session import scratch_path
from millrace.sources.tables import materialize

# Alert limits.
SEND_QUEUE_LIMIT_KB = 10240
REDO_HIGH_KB = 100000
REDO_MEDIUM_KB = 50000
SLOW_SECONDS = 180
PAGES_PER_MB = 128
HISTOGRAM_STEPS = 200
OPEN_UPPER_BORDER = 10000000

# Estimation hints and what they mean.
HINT_TEXT = {
    "Independence": "Tables predicates are fully independent (old CE model). The cardinality is calculated by multiplying the selectivities of all predicates",
    "Exponential backoff": "Tables predicates are partially correlated (new CE model). The cardinality is calculated using a variation on exponential backoff, ordering",
    "Min selectivity": "Tables predicates are fully correlated. The cardinality is calculated by using the minimum selectivities for all predicates",
    "Simple containment": "Join predicates are fully correlated (old CE model). Filter selectivity is calculated first, and then the join selectivity is factored in",
    "Base containment": "Join predicates are not correlated (new CE model). Join selectivity is calculated first, and then the filter selectivity is factored in",
}

# Texts of the replica roles.
ROLE_TEXT = {"PRIMARY": "This is the Primary Replica", "SECONDARY": "This is a Secondary Replica"}
OTHER_ROLE = "Unknown Role"


# Replicas -----------------------------------------------------------------


def _groups(ag: DataFrame, replica: DataFrame) -> DataFrame:
    return ag.join(replica, "group_id")


def replica_inventory(ag: DataFrame, replica: DataFrame, state: DataFrame) -> DataFrame:
    """One line per replica with its group and current state."""
    report = _groups(ag, replica).join(state, "replica_id").select(
        F.col("name").alias("group_name"), "replica_server_name", "availability_mode_desc", "failover_mode_desc",
        "read_only_routing_url", "cluster_type_desc", "role_desc", "operational_state_desc", "connected_state_desc",
        "synchronization_health_desc",
    )
    return in_order(report, "group_name", "replica_server_name")


def replica_lag(
    ag: DataFrame, replica: DataFrame, db_state: DataFrame, database: DataFrame, as_of: Column
) -> DataFrame:
    """Queues of every database copy and the seconds since its last commit."""
    names = database.select("database_id", F.col("name").alias("database_name"))
    joined = db_state.join(_groups(ag, replica), "replica_id").join(names, "database_id")
    report = joined.select(
        F.col("name").alias("group_name"), "database_id", "database_name", "replica_server_name",
        "availability_mode_desc", "synchronization_state_desc", "synchronization_health_desc", "log_send_queue_size",
        "log_send_rate", "redo_queue_size", "redo_rate", "last_commit_time",
        seconds_behind(F.col("last_commit_time"), as_of).alias("seconds_behind"),
    )
    return in_order(report, "group_name", "database_name", "replica_server_name")


def role_description(ag: DataFrame, replica: DataFrame, state: DataFrame, server: str) -> DataFrame:
    own = replica.filter(F.col("replica_server_name") == server)
    return _groups(ag, own).join(state, "replica_id").select(
        F.col("name").alias("group_name"), "role_desc",
        lookup_text(F.col("role_desc"), ROLE_TEXT, OTHER_ROLE).alias("role_description"),
    )


def connection_texts(ag: DataFrame, listener: DataFrame, database: str) -> DataFrame:
    """Read-only and read-write connection text per listener; null if a part is null."""
    base = F.concat(F.lit("Server="), F.col("dns_name"), F.lit(","), F.col("port").cast("string"),
                    F.lit(f";Database={database};"))
    return ag.join(listener, "group_id").select(
        F.col("name").alias("group_name"), "dns_name", "port",
        F.concat(base, F.lit("ApplicationIntent=ReadOnly")).alias("read_only_text"), base.alias("read_write_text"),
    )


def counters(counter: DataFrame, parts: list[str], ignore_case: bool = True) -> DataFrame:
    """Counters whose object name holds one of the texts."""
    name = F.lower("object_name") if ignore_case else F.col("object_name")
    wanted = F.lit(False)
    for part in parts:
        wanted = wanted | name.contains(part.lower() if ignore_case else part)
    report = counter.filter(wanted).select(
        "object_name", "counter_name", "instance_name", "cntr_value", "cntr_type"
    )
    return in_order(report, "object_name", "counter_name", "instance_name")


def health_report(
    ag: DataFrame, replica: DataFrame, state: DataFrame, db_state: DataFrame, database: DataFrame
) -> DataFrame:
    """Every replica with its databases, classified; unknown (null) states count as healthy."""
    copies = db_state.select(
        "replica_id", "database_id", "synchronization_state_desc", "log_send_queue_size", "log_send_rate",
        "redo_queue_size", "redo_rate",
    )
    names = database.select("database_id", F.col("name").alias("database_name"))
    issue = (
        (F.col("operational_state_desc") != "ONLINE") | (F.col("connected_state_desc") != "CONNECTED")
        | (F.col("synchronization_health_desc") != "HEALTHY")
    )
    slow = (F.col("log_send_queue_size") > SEND_QUEUE_LIMIT_KB) | (F.col("redo_queue_size") > SEND_QUEUE_LIMIT_KB)
    replicas = _groups(ag, replica).join(state, "replica_id")
    joined = left_join_many(replicas, copies, "replica_id").join(names, "database_id", "left")
    report = joined.select(
        F.col("name").alias("group_name"), "replica_server_name", "role_desc", "operational_state_desc",
        "connected_state_desc", "synchronization_health_desc", "database_name", "synchronization_state_desc",
        "log_send_queue_size", "log_send_rate", "redo_queue_size", "redo_rate",
        F.when(issue, "ISSUE").when(slow, "PERFORMANCE_CONCERN").otherwise("HEALTHY").alias("health_status"),
    )
    return in_order(report, "group_name", "replica_server_name", "database_name")


def redo_status(rate: Column, queue: Column) -> Column:
    return (
        F.when(rate == 0, "STALLED").when(queue > REDO_HIGH_KB, "HIGH_QUEUE")
        .when(queue > REDO_MEDIUM_KB, "MEDIUM_QUEUE").otherwise("NORMAL")
    )


def redo_report(
    ag: DataFrame, replica: DataFrame, db_state: DataFrame, database: DataFrame, server: str, as_of: Column
) -> DataFrame:
    """Redo queues on one server, with the estimated seconds to catch up."""
    own = replica.filter(F.col("replica_server_name") == server)
    names = database.select("database_id", F.col("name").alias("database_name"))
    rate, queue = F.col("redo_rate"), F.col("redo_queue_size")
    joined = db_state.filter("is_local = 1").join(_groups(ag, own), "replica_id").join(names, "database_id")
    report = joined.select(
        F.col("name").alias("group_name"), "database_name", "redo_queue_size", "redo_rate", "log_send_queue_size",
        "log_send_rate", "last_redone_lsn", "last_redone_time",
        seconds_behind(F.col("last_redone_time"), as_of).alias("seconds_since_redo"),
        redo_status(rate, queue).alias("redo_status"),
        F.when(rate > 0, int_div(queue, rate)).alias("catch_up_seconds"),
    )
    return in_order(report, F.desc("redo_queue_size"))


# Storage ------------------------------------------------------------------


def _of_object(df: DataFrame, object_id: int | None) -> DataFrame:
    return df if object_id is None else df.filter(F.col("object_id") == object_id)


def row_group_report(
    row_group: DataFrame, partition: DataFrame, segment: DataFrame, column: DataFrame, object_id: int | None = None
) -> DataFrame:
    """Row groups of a columnar table (or of all) with the value range of each column segment."""
    keys = ["object_id", "index_id", "partition_number"]
    parts = partition.select(*keys, "partition_id")
    names = column.select("object_id", "column_id", F.col("name").alias("column_name"))
    report = (
        _of_object(row_group, object_id).join(parts, keys)
        .join(segment, ["partition_id", "row_group_id"], "left")
        .join(names, ["object_id", "column_id"], "left")
        .select(
            "object_id", "state_desc", "partition_number", "row_group_id", "total_rows", "column_name", "min_data_id",
            "max_data_id", "deleted_rows",
            int_div(F.col("size_in_bytes"), F.lit(1024 * 1024)).alias("size_mb"), "trim_reason_desc",
            "transition_to_compressed_state_desc", "delta_store_hobt_id", "created_time", "closed_time",
        )
    )
    return in_order(report, "object_id", "partition_number", "row_group_id")


def storage_pages(unit: DataFrame, partition: DataFrame, index: DataFrame, object_id: int | None = None) -> DataFrame:
    """Pages per index partition of a table (or of all) that holds rows."""
    names = index.select("object_id", "index_id", F.col("name").alias("index_name"))
    filled = _of_object(partition, object_id).filter(F.col("rows") > 0)
    report = unit.join(filled, F.col("container_id") == F.col("partition_id")).join(names, ["object_id", "index_id"]).select(
        "object_id", "index_name", "index_id", "partition_number", "data_compression_desc", "type_desc", "total_pages", "rows"
    )
    return in_order(report, "object_id", "partition_number")


def page_listing(page: DataFrame, internal: DataFrame) -> DataFrame:
    """Pages of internal partitions (delta stores), newest partition first."""
    inner = internal.select(F.col("partition_id").alias("rowset_id"), "row_group_id", "internal_object_type_desc",
                            "data_compression_desc")
    report = page.join(inner, "rowset_id").select(
        "file_id", "page_id", "index_id", "type_desc", "is_allocated", "is_iam_page", "page_type_desc",
        "row_group_id", "internal_object_type_desc", "data_compression_desc", "rowset_id",
    )
    return in_order(report, F.desc("rowset_id"), "page_id")


def storage_summary(
    partition: DataFrame, obj: DataFrame, index: DataFrame, space: DataFrame, scheme: DataFrame,
    destination: DataFrame, filegroup: DataFrame, border: DataFrame, open_border: Column | None = None,
) -> DataFrame:
    """Size, borders and kind of each partition of each user table.

    The last partition has no upper border; it is null unless ``open_border`` is given.
    """
    indexes = index.select("object_id", "index_id", F.col("name").alias("index_name"), "data_space_id")
    spaces = space.select("data_space_id", F.col("name").alias("space_name"))
    schemes = scheme.select("data_space_id", F.col("name").alias("scheme_name"), "function_id")
    targets = destination.select(
        F.col("partition_scheme_id").alias("_scheme"), F.col("destination_id").alias("_n"),
        F.col("data_space_id").alias("_target"),
    )
    groups = filegroup.select(F.col("data_space_id").alias("_target"), F.col("name").alias("filegroup_name"))
    user = obj.filter("is_shipped = 0").select("object_id", "schema_name", F.col("name").alias("object_name"))
    used = partition.filter((F.col("used_page_count") > 0) & F.col("index_id").isin(0, 1, 5) & (F.col("row_count") > 0))
    on_scheme = (F.col("data_space_id") == F.col("_scheme")) & F.col("scheme_name").isNotNull()
    rows = (
        used.join(user, "object_id").join(indexes, ["object_id", "index_id"]).join(spaces, "data_space_id")
        .join(schemes, "data_space_id", "left")
        .join(targets, on_scheme & (F.col("partition_number") == F.col("_n")), "left")
        .join(groups, "_target", "left")
    )
    rows = borders_by_offset(rows, border, ["function_id"], "partition_number", "boundary_id", "value")
    upper = F.col("upper_border") if open_border is None else F.coalesce("upper_border", open_border)
    mb = lambda c: int_div(F.col(c), F.lit(PAGES_PER_MB)).cast("decimal(18,2)")
    is_data = F.col("index_id").isin(0, 1)
    return rows.select(
        concat_empty("schema_name", F.lit("."), "object_name").alias("table_name"), "object_id", "index_id",
        F.when(F.col("index_id") == 0, "HEAP").otherwise(F.col("index_name")).alias("index_name"),
        "scheme_name", "partition_number", F.col("lower_border"), upper.alias("upper_border"),
        F.coalesce("filegroup_name", "space_name").alias("filegroup_name"),
        mb("in_row_data_page_count").alias("data_mb"), mb("used_page_count").alias("used_mb"),
        mb("reserved_page_count").alias("reserved_mb"),
        F.when(is_data, F.col("row_count")).otherwise(F.lit(0)).alias("row_count"),
        F.when(is_data, "data").otherwise("index").alias("type"),
    )


# Statements ---------------------------------------------------------------


def lock_waits(
    lock: DataFrame, wait: DataFrame, partition: DataFrame, obj: DataFrame, index: DataFrame, database_id: int, database: str,
    own_session: int | None = None,
) -> DataFrame:
    """Locks in one database with the object and index they are on and who blocks them.

    Object ids mean something in their own database only, so the partitions,
    objects and indexes given are those of ``database_id``.
    """
    entity = "resource_associated_entity_id"
    waits = wait.select(F.col("resource_address").alias("lock_owner_address"), "blocking_session_id", "wait_duration_ms")
    parts = partition.select(F.col("hobt_id").alias(entity), F.col("object_id").alias("_part_object"), F.col("index_id").alias("_part_index"))
    objects = obj.select(F.col("object_id").alias(entity), F.col("object_id").alias("_object"), F.col("name").alias("_object_name"))
    part_objects = obj.select(F.col("object_id").alias("_part_object"), F.col("name").alias("_part_name"))
    indexes = index.select(
        F.struct("object_id", F.coalesce("index_id", F.lit(1)).alias("index_id")).alias("_index_key"),
        F.col("name").alias("index_name"),
    )
    held = lock.filter((F.col(entity) > 0) & (F.col("resource_database_id") == database_id))
    if own_session is not None:
        held = held.filter(F.col("request_session_id") != own_session)
    # What an id names is put together among the short tables, so the locks take part in two joins
    # on different ids, each alone in its stage, where the planner splits a hot id.
    named = parts.join(objects, entity, "full").join(part_objects, "_part_object", "left")
    key = F.struct(F.coalesce("_object", "_part_object").alias("object_id"), F.coalesce("_part_index", F.lit(1)).alias("index_id"))
    named = named.withColumn("_key", F.when(key["object_id"].isNotNull(), key))
    named = coalesced_join(named, indexes, [F.col("_key")], F.col("_index_key")).select(entity, "_object_name", "_part_name", "index_name")
    rows = held.join(waits, "lock_owner_address", "left").join(named, entity, "left")
    report = rows.select(
        F.lit(database).alias("database_name"), "request_session_id", "resource_type",
        F.when(F.col("resource_type") == "OBJECT", F.col("_object_name")).otherwise(F.col("_part_name")).alias("object_name"),
        "index_name", "resource_subtype", "resource_description", "resource_associated_entity_id", "request_mode",
        "request_status", "blocking_session_id", (F.col("wait_duration_ms") / F.lit(1000.0)).alias("wait_seconds"),
    )
    return in_order(report, "request_session_id", "resource_associated_entity_id")


def _with_hints(rows: DataFrame, plan: DataFrame, hint: DataFrame, *carried: str) -> DataFrame:
    return rows.join(plan.select("plan_id", "query_id", *carried), "plan_id").join(
        hint.select("query_id", "query_hint_text"), "query_id", "left"
    )


def memory_feedback(feedback: DataFrame, plan: DataFrame, hint: DataFrame, feature: str = "Memory Grant Feedback") -> DataFrame:
    """One row per operator of the feedback JSON; it is parsed where it is scanned, before the joins."""
    fields = {"NodeId": "int", "AdditionalMemoryKB": "int", "Count": "int", "Average": "bigint", "Variance": "bigint"}
    parsed = json_rows(feedback.filter(F.col("feature_desc") == feature), "feedback_data", fields).drop("feedback_data")
    report = _with_hints(parsed, plan, hint).select(
        "plan_id", "feature_id", "feature_desc", "state", "state_desc", "last_updated_time", "query_hint_text",
        F.col("NodeId").alias("node_id"), F.col("AdditionalMemoryKB").alias("granted_memory_kb"),
        F.col("Count").alias("count"), F.col("Average").alias("average"), F.col("Variance").alias("variance"), "query_id",
    )
    return in_order(report, "query_id")


def estimation_feedback(feedback: DataFrame, plan: DataFrame, hint: DataFrame, feature: str = "CE Feedback") -> DataFrame:
    """Estimation hints in use and what they mean; rows without a hint are left out before the joins."""
    used = json_value(F.col("feedback_data"), "Feedback hints")
    wanted = feedback.filter(F.col("feature_desc") == feature)
    hinted = wanted.withColumn("hint_in_use", used).drop("feedback_data").filter("hint_in_use <> ''")
    report = _with_hints(hinted, plan, hint, "query_plan").select(
        "plan_id", "feature_id", "feature_desc", "state", "state_desc", "last_updated_time", "query_plan", "hint_in_use",
        "query_hint_text", lookup_text(F.col("hint_in_use"), HINT_TEXT).alias("meaning"), "query_id",
    )
    return in_order(report, "query_id")


def cpu_groups(node: DataFrame, scheduler: DataFrame) -> DataFrame:
    """First, last, number and list of processors per node (few per node by nature)."""
    seen = scheduler.filter((F.col("scheduler_id") < 255) & (F.col("status") == "VISIBLE ONLINE"))
    ids = F.transform(F.array_sort(F.collect_list("cpu_id")), lambda c: c.cast("string"))
    return (
        node.filter("node_state_desc = 'ONLINE'").join(seen, F.col("node_id") == F.col("parent_node_id"))
        .groupBy("node_id").agg(
            F.min("cpu_id").alias("first_cpu"), F.max("cpu_id").alias("last_cpu"), F.count("cpu_id").alias("cpu_count"),
            F.array_join(ids, ",").alias("cpu_list"),
        ).orderBy("node_id")
    )


def query_store_top(query: DataFrame, plan: DataFrame, runtime: DataFrame, as_of: Column, days: int = 3, n: int = 100) -> DataFrame:
    """Slowest (query, plan) pairs of the last days.

    Run-time rows are reduced to one row per plan before they meet the plans,
    so a plan that ran all the time is one row in the join.
    """
    since = as_of - F.make_dt_interval(F.lit(days))
    recent = lambda df: df.filter(F.col("last_execution_time") >= since)
    per_plan = recent(runtime).filter((F.col("min_rowcount") >= 0) & (F.col("max_rowcount") > 1)).groupBy("plan_id").agg(
        F.min("min_duration").alias("_min"), F.max("max_duration").alias("_max"),
        F.sum(F.col("avg_duration").cast("decimal(28,6)")).alias("_sum"), F.count("avg_duration").alias("_n"),
        F.max("last_execution_time").alias("last_execution_time"), F.min("min_rowcount").alias("min_rowcount"),
        F.max("max_rowcount").alias("max_rowcount"),
    )
    plans = recent(plan).select("plan_id", "query_id", "is_forced_plan", "plan_forcing_type_desc", "is_parallel_plan")
    queries = recent(query).select("query_id", "name", "query_text_id")
    rows = per_plan.join(plans, "plan_id").join(queries, "query_id").groupBy("query_id", "plan_id").agg(
        F.max("name").alias("name"), F.max("query_text_id").alias("query_text_id"),
        F.max(F.col("is_forced_plan").cast("int")).alias("is_forced"),
        F.max("plan_forcing_type_desc").alias("plan_forcing_type_desc"),
        F.max(F.col("is_parallel_plan").cast("int")).alias("is_parallel"),
        F.min("_min").alias("_min"), F.max("_max").alias("_max"), F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"),
        F.max("last_execution_time").alias("last_execution_time"), F.min("min_rowcount").alias("min_rowcount"),
        F.max("max_rowcount").alias("max_rowcount"),
    )
    ms = lambda c: (c / F.lit(1000).cast("decimal(4,0)")).cast("decimal(15,2)")
    whole = lambda c: F.col(c).cast("decimal(28,6)")
    return rows.select(
        "query_id", "name", "query_text_id", "plan_id", "is_forced", "plan_forcing_type_desc", "is_parallel",
        ms(whole("_min")).alias("min_duration_ms"), ms(F.col("_sum") / F.col("_n")).alias("avg_duration_ms"),
        ms(whole("_max")).alias("max_duration_ms"), "last_execution_time", "min_rowcount", "max_rowcount",
    ).orderBy(F.desc("max_duration_ms"), "query_id", "plan_id").limit(n)


def plan_operators(plan: DataFrame, plan_column: str = "query_plan") -> DataFrame:
    """One row per operator of every plan text; a plan that is cut off has none.

    The operators are written before they are sorted: a sort reads its input
    twice, first for the borders of its ranges, and would split every text twice.
    """
    report = markup_elements(plan.select("plan_id", plan_column), plan_column, "RelOp", PLAN_ATTRIBUTES, whole=True).drop(
        plan_column, "pos"
    )
    found = materialize(report, scratch_path(plan.sparkSession, "plan-operators"))
    return in_order(found, "plan_id", "NodeId")


def top_io(stats: DataFrame, plan: DataFrame, database_id: int | None = None, n: int = 50) -> DataFrame:
    """Slow statements that read and write most per run, each with its plan, joined to those ``n`` rows only."""
    second = F.lit(1000000.0)
    slow = (F.col("max_worker_time") / second > SLOW_SECONDS) | (F.col("max_elapsed_time") / second > SLOW_SECONDS)
    rows = stats.filter(slow)
    if database_id is not None:
        rows = rows.filter(F.col("dbid") == database_id)
    runs = F.col("execution_count")
    io = F.col("total_logical_reads") + F.col("total_logical_writes")
    top = rows.select(
        "statement_id", "last_execution_time", "plan_handle",
        statement_slice(F.col("text"), F.col("statement_start_offset"), F.col("statement_end_offset")).alias("statement"),
        "execution_count", int_div(io, runs).alias("avg_io_pages"),
        int_div(F.col("total_logical_reads"), runs).alias("avg_read_pages"),
        int_div(F.col("total_logical_writes"), runs).alias("avg_write_pages"),
        (F.col("total_worker_time") / (runs * second)).alias("avg_cpu_seconds"),
        (F.col("total_worker_time") / second).alias("total_cpu_seconds"),
        (F.col("max_worker_time") / second).alias("max_cpu_seconds"),
        int_div(F.col("total_dop"), runs).alias("avg_dop"),
        (F.col("total_elapsed_time") / (runs * second)).alias("avg_elapsed_seconds"),
        (F.col("total_elapsed_time") / second).alias("total_elapsed_seconds"),
        (F.col("max_elapsed_time") / second).alias("max_elapsed_seconds"), "total_rows", "max_rows",
    ).orderBy(F.desc("avg_io_pages"), "statement_id").limit(n)
    found = top.join(plan.select("plan_handle", "query_plan"), "plan_handle", "left").drop("plan_handle")
    return found.orderBy(F.desc("avg_io_pages"), "statement_id")


def running_statements(
    session: DataFrame, process: DataFrame, request: DataFrame, grant: DataFrame, text: DataFrame,
    buffer: DataFrame, plan: DataFrame, database_id: int, own_session: int, system_sessions: int = 50,
    runtime_plan: DataFrame | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """What each user session runs now: thread, wait, memory, statement and plan.

    ``runtime_plan`` has the plan of a session as far as it has run; where it is
    not collected, that column is null.
    """
    own = session.filter(
        (F.col("is_user_process") == 1) & (F.col("database_id") == database_id)
        & (F.col("session_id") > system_sessions) & (F.col("session_id") != own_session)
    ).select("session_id", "database_id", "host_name", "program_name", "login_name")
    threads = process.select(
        F.col("spid").alias("session_id"), F.col("dbid").alias("database_id"), "kpid", "ecid",
        "status", "open_tran", "waitresource",
    )
    requests = request.select("session_id", "sql_handle", "plan_handle", "wait_type", "wait_time", "start_time",
                              "statement_start_offset", "statement_end_offset")
    start, end = F.col("statement_start_offset"), F.col("statement_end_offset")
    # A session may have many requests and many threads: its requests meet the tables of one row a session
    # in one chain, spread where it is hot, and the threads come last, in a join of their own.
    running = spread_joins(requests, "session_id", [
        (own, "inner"), (grant.select("session_id", "dop", "granted_memory_kb"), "left"), (buffer.select("session_id", "event_info"), "inner"),
        *([] if runtime_plan is None else [(runtime_plan.select("session_id", F.col("query_plan").alias("runtime_plan")), "left")])], hot_rows)
    if runtime_plan is None:
        running = running.withColumn("runtime_plan", F.lit(None).cast("string"))
    report = (
        running.join(text.select("sql_handle", "text"), "sql_handle")
        .join(plan.select("plan_handle", "query_plan"), "plan_handle", "left")
        .join(threads, ["session_id", "database_id"])
        .select(
            "session_id", "kpid", "ecid", "host_name", "program_name", "login_name", "wait_type", "wait_time", "status",
            "dop", "granted_memory_kb", "open_tran", "waitresource", "start_time",
            statement_slice(F.col("text"), start, end, 0, 0).alias("statement"),
            F.col("event_info").alias("parent_statement"), "query_plan", "runtime_plan",
        )
    )
    return in_order(report, "session_id")


# Statistics ---------------------------------------------------------------


def stats_freshness(
    partition: DataFrame, border: DataFrame, stats: DataFrame, properties: DataFrame, first: int, last: int,
    open_border: int = OPEN_UPPER_BORDER, tables: list[str] | None = None,
) -> DataFrame:
    """Rows, sampled rows and changes per partition of the named tables (or of all) within a border range."""
    named = partition if tables is None else partition.filter(F.col("table_name").isin(*tables))
    filled = named.filter((F.col("used_page_count") > 0) & F.col("index_id").isin(0, 1, 5) & (F.col("row_count") > 0))
    upper = border.select("function_id", F.col("boundary_id").alias("partition_number"), F.col("value").alias("_upper"))
    first_stats = stats.filter("stats_id = 1").select("object_id", "stats_id", F.col("name").alias("stats_name"))
    rows = filled.join(upper, ["function_id", "partition_number"], "left").join(first_stats, "object_id")
    rows = rows.withColumn("upper_border", F.coalesce("_upper", F.lit(open_border)).cast("int"))
    rows = rows.filter(F.col("upper_border").between(first, last))
    report = rows.join(properties, ["object_id", "stats_id", "partition_number"]).select(
        "table_name", "stats_name", "partition_number", "upper_border", "last_updated", "row_count",
        F.col("rows").alias("stats_row_count"), "rows_sampled", "steps", "unfiltered_rows", "modification_counter",
    )
    return in_order(report, "table_name", F.desc("upper_border"))


def stats_threshold(partition: DataFrame, properties: DataFrame) -> DataFrame:
    """Whether the changes since the last update pass the update threshold."""
    limit = update_threshold(F.col("rows"))
    changes = properties.select("object_id", "modification_counter", "last_updated")
    report = partition.filter((F.col("index_id") <= 1) & (F.col("rows") > 0)).join(changes, "object_id").select(
        "object_id", "partition_number", F.col("rows").alias("current_rows"), "modification_counter", "last_updated",
        limit.alias("update_threshold"),
        F.when(F.col("modification_counter") >= limit, "Should Update").otherwise("Below Threshold").alias("update_status"),
    )
    return in_order(report, "partition_number")


def stats_catalog(table: DataFrame, stats: DataFrame, columns: DataFrame, name: str) -> DataFrame:
    """Statistics of one table with the columns they cover."""
    own = table.filter(F.col("table_name") == name)
    report = own.join(stats, "object_id").join(columns, ["object_id", "stats_id"], "left").select(
        "schema_name", "table_name", "stats_name", "column_name", "stats_id", "is_incremental", "last_updated"
    )
    return in_order(report, "stats_name", "column_name")


def histogram_steps(df: DataFrame, column: str, object_id: int, stats_id: int, chunk: Column, steps: int = HISTOGRAM_STEPS) -> DataFrame:
    """The equal-height histogram of a column as rows of one statistic; counts of values below a step's highest, and of that."""
    found = equi_height_histogram(df, column, steps, chunk)
    mean = F.when(F.col("distinct_range") > 0, F.col("range_rows") / F.col("distinct_range")).otherwise(F.lit(1.0))
    return found.select(
        F.lit(object_id).cast("long").alias("object_id"), F.lit(stats_id).cast("long").alias("stats_id"), F.col("step").alias("step_number"),
        F.col("range_hi").cast("string").alias("range_high_key"), "range_rows", F.col("eq_rows").alias("equal_rows"),
        F.col("distinct_range").alias("distinct_range_rows"), mean.alias("average_range_rows"))


def stats_histograms(table: DataFrame, stats: DataFrame, columns: DataFrame, histogram: DataFrame, in_memory: bool | None = True,
                     name: str | None = None) -> DataFrame:
    """Statistics with the columns they cover and their histograms, last step first; those without steps keep a row.

    ``in_memory`` takes tables of one storage only, None all; ``name`` one table.
    """
    own = table if in_memory is None else table.filter(F.col("is_memory_optimized") == in_memory)
    if name is not None:
        own = own.filter(F.col("table_name") == name)
    on = ["object_id", "stats_id"]
    report = own.join(stats, "object_id").join(columns, on, "left").join(histogram, on, "left").select(
        "schema_name", "table_name", "stats_name", "column_name", "stats_id", "is_incremental", "is_memory_optimized", "last_updated",
        "step_number", "range_high_key", "range_rows", "equal_rows", "distinct_range_rows", "average_range_rows",
    )
    return in_order(report, "stats_id", F.desc_nulls_last("step_number"))
