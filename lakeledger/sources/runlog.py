"""The run log: an append-only event table that replaces the mutable task,
unit and heartbeat tables of the exported system.

``run_event(task_id, month, server, table_name, event, rows_local,
rows_lake, error_msg, ts, seq)``; ``event`` is one of create, claim,
complete, failed, reset, unit_report, heartbeat, acknowledge.  Order within
a task is (ts, seq).

:func:`from_events` maps the driver's ``events`` table onto it:
task = user_id, signup = create, view = claim, purchase = complete,
error = failed, click = reset; every event is also a heartbeat of its
member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions import catalog as C

RUN_EVENT_SCHEMA = T.StructType([
    T.StructField("task_id", T.LongType()),
    T.StructField("month", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("rows_local", T.LongType()),
    T.StructField("rows_lake", T.LongType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

# Fixed mapping of the driver's event types onto run-log events.
EVENT_MAP = {
    "signup": "create",
    "view": "claim",
    "purchase": "complete",
    "error": "failed",
    "click": "reset",
}


def map_event(col: str) -> F.Column:
    expr = None
    for k, v in EVENT_MAP.items():
        expr = (F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v))
    return expr.otherwise(F.lit("other"))


def from_events(events: DataFrame) -> DataFrame:
    """Task events of the driver's ``events`` table as run-log rows."""
    return events.select(
        F.col("user_id").cast("long").alias("task_id"),
        C.month_of("ts").alias("month"),
        C.shard_of("user_id").alias("server"),
        F.lit(None).cast("string").alias("table_name"),
        map_event("event_type").alias("event"),
        F.lit(None).cast("long").alias("rows_local"),
        F.lit(None).cast("long").alias("rows_lake"),
        F.lit(None).cast("string").alias("error_msg"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").cast("long").alias("seq"),
    )


def heartbeats_from_events(events: DataFrame) -> DataFrame:
    """Every event is a liveness ping of its member (user)."""
    return events.select(
        F.col("user_id").cast("long").alias("member"),
        C.shard_of("user_id").alias("server"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").cast("long").alias("seq"),
        F.col("event_type").alias("detail"),
    )


def _k(props: str = "props") -> F.Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


# Fixed report-building rules over ``events`` (the unit-report scenario):
# props.k picks the template (k mod 16) or an invalid name; the month slot
# is the month of ts + floor(value) hours; the reporter is the task's shard,
# anonymous, or a different shard.
UNKNOWN_TABLE_K = 96      # k >= 96: a name outside the 16 templates
MISSING_NAME_K = 50       # k == 50: no table name
UNKNOWN_TASK_K = 42       # k == 42: task id that does not exist (+1000)
FAKE_MONTH_K = 77         # k == 77: month slot 999999
ANON_REPORTER_MOD = 3     # k % 10 == 3: reporter sends no server
OTHER_REPORTER_MOD = 7    # k % 10 == 7: reporter is the next shard

STATUS_MAP = {
    "purchase": "complete",
    "error": "failed",
    "view": "pending",
    "click": "skipped",
    "signup": "done",   # not a unit status: rejected
}


def reports_from_events(events: DataFrame) -> DataFrame:
    """Unit reports built from ``events`` (one report per event)."""
    k = _k()
    slot = F.when(k == FAKE_MONTH_K, F.lit("999999")).otherwise(
        C.month_of(F.col("ts") + F.make_dt_interval(hours=F.floor("value").cast("int"))))
    tpl = F.element_at(C.templates_array(), (F.pmod(k, F.lit(16)) + 1).cast("int"))
    name = (F.when(k == MISSING_NAME_K, F.lit(""))
             .when(k >= UNKNOWN_TABLE_K, F.concat(F.lit("z_ranking_detail_"), slot, F.lit("_us")))
             .otherwise(C.table_name_for(tpl, slot)))
    status = None
    for a, b in STATUS_MAP.items():
        status = F.when(F.col("event_type") == a, b) if status is None else status.when(F.col("event_type") == a, b)
    status = status.otherwise(F.lit(""))
    reporter = (F.when(F.pmod(k, F.lit(10)) == ANON_REPORTER_MOD, F.lit(""))
                 .when(F.pmod(k, F.lit(10)) == OTHER_REPORTER_MOD, C.shard_of(F.col("user_id") + 1))
                 .otherwise(C.shard_of("user_id")))
    rows = F.floor("value").cast("long")
    return events.select(
        F.col("event_id").cast("long").alias("report_id"),
        F.when(k == UNKNOWN_TASK_K, F.col("user_id") + 1000).otherwise(F.col("user_id"))
         .cast("long").alias("task_id"),
        name.alias("table_name"),
        status.alias("status"),
        reporter.alias("server"),
        rows.alias("rows_local"),
        F.when(status == "failed", rows - 1).otherwise(rows).alias("rows_lake"),
        F.when(status == "failed", F.lit("row count mismatch")).otherwise(F.lit("")).alias("error_msg"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").cast("long").alias("seq"),
    )
