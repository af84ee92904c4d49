"""Registered streaming queries: the batch answers must come out of the
streams (batch = stream), so their oracles are the batch oracles.
Imported by :mod:`lakeledger.plans.queries`."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeledger.functions import catalog as C
from lakeledger.plans import runlog_queries as RQ
from lakeledger.plans import scenarios as S
from lakeledger.plans.queries import ORACLES, register
from lakeledger.session import new_run_dir
from lakeledger.sources import runlog as RL
from lakeledger.streaming import tasks_stream as TS
from lakeledger.streaming import timeouts as TO
from lakeledger.streaming import units_stream as US

SLICES = 8  # slices of the stream's input, one a micro-batch
#: rows of a file, about; a file is read by one task
ROWS_A_FILE = 200_000


def _files_a_slice(rows):
    return max(1, -(-rows // (SLICES * ROWS_A_FILE)))


def _stream(spark, path, schema, per):
    """The files as a stream, ``per`` of them a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per).parquet(path)


def _event_files(spark, sf_dir):
    """The events table as files by time, the input a stream sees, in one
    write; returns (dir, schema, files a slice).  The files' order of arrival is
    whatever their writers make it."""
    ev = S.read_source(spark, sf_dir, "events")
    per = _files_a_slice(ev.count())
    path = new_run_dir(spark, "stream-src") + "/events"
    ev.repartitionByRange(SLICES * per, "ts").write.parquet(path)
    return path, ev.schema, per


def _late_files(spark, sf_dir):
    """The events dealt over files by a hash, so that most come late, and every
    seventh delivered a second time an hour later."""
    ev = S.read_source(spark, sf_dir, "events")
    again = ev.where("event_id % 7 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    per = _files_a_slice(ev.count())
    path = new_run_dir(spark, "stream-late") + "/events"
    ev.unionByName(again).repartition(SLICES * per, F.xxhash64("event_id", "ts")).write.parquet(path)
    return path, ev.schema, per


def _task_columns(t):
    return t.select("task_id", "server", "status", RQ._txt("started_at").alias("started_at"),
                    RQ._txt("completed_at").alias("completed_at"), "error_msg",
                    RQ._txt("last_reset_at").alias("last_reset_at"))


def _run_tasks(spark, src, schema, per):
    stream = _stream(spark, src, schema, per)
    out = new_run_dir(spark, "stream-out") + "/tasks"
    TS.stream_tasks(spark, RL.from_events(stream), out, new_run_dir(spark, "stream-ckpt"))
    log = RL.from_events(spark.read.schema(schema).parquet(src))
    return _task_columns(TS.current_tasks(spark, out, now=RQ.NOW, log=log))


@register("stream_tasks")
def stream_tasks(spark, sf_dir):
    """Task replay as a Structured Streaming job over time-ordered files,
    one slice per micro-batch; state per task in the state store."""
    return _run_tasks(spark, *_event_files(spark, sf_dir))


ORACLES["stream_tasks"] = ORACLES["replay_tasks"]


@register("stream_tasks_late")
def stream_tasks_late(spark, sf_dir):
    """The same with files in no order of time and with redeliveries: tasks
    with late events are replayed from the landed log."""
    return _run_tasks(spark, *_late_files(spark, sf_dir))


ORACLES["stream_tasks_late"] = ORACLES["replay_tasks"]


@register("stream_liveness")
def stream_liveness(spark, sf_dir):
    """Latest heartbeat per member as a streaming aggregate, online at
    LIVENESS_NOW."""
    src, schema, per = _event_files(spark, sf_dir)
    stream = _stream(spark, src, schema, per)
    out = new_run_dir(spark, "stream-live") + "/members"
    TS.stream_liveness(spark, RL.heartbeats_from_events(stream), out, new_run_dir(spark, "stream-ckpt"))
    live = TS.current_liveness(spark, out)
    now_c = F.lit(RQ.LIVENESS_NOW).cast("timestamp_ntz")
    last_seen = F.col("last_seen").cast("timestamp_ntz")
    online = F.coalesce(last_seen > now_c - F.expr(f"INTERVAL {C.ONLINE_LIMIT_SECONDS} SECONDS"), F.lit(False))
    return live.select("member", "server", RQ._txt(last_seen).alias("last_seen"), "last_detail",
                       online.alias("online"))


ORACLES["stream_liveness"] = ORACLES["liveness"]


# ------------------------------------------------------------------ timeouts

DELAY_HOURS = 120
#: the sweep at NOW as an event: it moves the watermark there
TICK = {"event_id": -1, "user_id": -1, "event_type": "tick"}


def timeout_history_sql() -> str:
    """Every timeout by a full ordered fold with ``list_reduce``."""
    timed = f"(acc.st = 'progress' AND acc.started < e.ts - INTERVAL {RQ.H} HOUR)"
    st = f"(CASE WHEN {timed} THEN 'timeout' ELSE acc.st END)"
    claim = f"(e.ev = 'claim' AND {st} = 'new')"
    step = (f"struct_pack(st := CASE WHEN {claim} THEN 'progress' "
            f"WHEN e.ev IN ('complete', 'failed') AND {st} = 'progress' THEN e.ev "
            f"WHEN e.ev = 'reset' AND {st} <> 'progress' THEN 'new' ELSE {st} END, "
            f"started := CASE WHEN {claim} THEN e.ts ELSE acc.started END, "
            f"month := CASE WHEN {claim} THEN e.month ELSE acc.month END, "
            f"outs := CASE WHEN {timed} THEN list_append(acc.outs, struct_pack(started := acc.started, month := acc.month)) "
            f"ELSE acc.outs END)")
    zero = ("struct_pack(st := 'new', started := NULL::TIMESTAMP, month := NULL::VARCHAR, "
            "outs := []::STRUCT(started TIMESTAMP, month VARCHAR)[])")
    return f"""
(WITH ev AS (SELECT user_id AS task_id, ts, event_id AS seq, {RQ._event_sql()} AS ev, {RQ.O.month_sql('ts')} AS month FROM events),
 l AS (SELECT task_id, list_append(list(struct_pack(ts := ts, ev := ev, month := month) ORDER BY ts, seq),
                                   struct_pack(ts := TIMESTAMP '{RQ.NOW}', ev := 'sweep', month := NULL::VARCHAR)) AS evs
       FROM ev WHERE ev IN ('claim', 'complete', 'failed', 'reset') GROUP BY task_id),
 f AS (SELECT task_id, unnest(list_reduce(evs, lambda acc, e: {step}, {zero}).outs) AS o FROM l)
 SELECT task_id, {RQ.O.shard_sql('task_id')} AS server, o.month AS month, o.started AS started_at FROM f)"""


_TIMEOUT_SQL = f"""
SELECT task_id, server, month, 'Auto-timeout: started at ' || strftime(started_at, '%Y-%m-%d %H:%M:%S') AS error_msg,
       '{TO.finalize.TITLE_TIMEOUT}' AS title,
       'Server: ' || server || chr(10) || 'Month: ' || month || chr(10) || 'Started: '
         || strftime(started_at, '%Y-%m-%d %H:%M:%S') || chr(10) || 'Exceeded {RQ.H}h. Task marked as ''timeout''.' || chr(10)
         || 'Reset task ' || task_id || ' to retry.' AS message,
       'WARNING' AS level, array_to_string(['parquet', 'export', 'timeout'], ',') AS tags
FROM {timeout_history_sql()}
"""


def _with_tick(spark, path, schema):
    """The instant of the sweep as the last file of a stream's input."""
    tick = spark.range(1).select(*[
        (F.expr(f"TIMESTAMP_NTZ '{RQ.NOW}' + INTERVAL {DELAY_HOURS} HOURS") if f.name == "ts" else F.lit(TICK.get(f.name)))
        .cast(f.dataType).alias(f.name) for f in schema.fields])
    tick.write.mode("append").parquet(path)


def _in_turn(spark, sf_dir):
    """The events as slices that arrive one after the other in order of time."""
    src, schema, per = _event_files(spark, sf_dir)
    path = new_run_dir(spark, "stream-turn") + "/events"
    # the files' numbers follow the ranges of time
    files = sorted(spark.read.schema(schema).parquet(src).inputFiles(), key=lambda f: f.rsplit("/", 1)[-1])
    for at in range(0, len(files), per):
        rows = spark.read.schema(schema).parquet(*files[at:at + per]).where("ts is not null")
        rows.repartition(per).write.mode("append").parquet(path)
    return path, schema, per


def _timeout_alerts(spark, path, schema, per):
    run = new_run_dir(spark, "stream-timeouts")
    source = _stream(spark, path, schema, per)
    log = RL.from_events(source).select("task_id", "month", "server", "event", F.col("ts").cast("timestamp").alias("ts"), "seq")
    TO.route_late(log, f"{run}/landed", f"{run}/ckpt-route", DELAY_HOURS)
    # in a micro-batch of its own: it makes all rows beside it late
    _with_tick(spark, path, schema)
    TO.route_late(log, f"{run}/landed", f"{run}/ckpt-route", DELAY_HOURS)
    # a routed slice lands at most as many files as it has: so there are no more micro-batches than slices, however many files
    TO.stream_timeouts(spark, f"{run}/landed", f"{run}/found", f"{run}/ckpt", delay_hours=DELAY_HOURS, files_per_batch=max(8, per))
    batch = RL.from_events(spark.read.schema(schema).parquet(path)).where("task_id >= 0")
    alerts = TO.timeout_alerts(spark, f"{run}/landed", f"{run}/found", batch, now=RQ.NOW)
    return alerts.select("task_id", "server", "month", "error_msg", "title", "message", "level",
                         F.array_join("tags", ",").alias("tags"))


@register("stream_timeout_alerts", _TIMEOUT_SQL)
def stream_timeout_alerts(spark, sf_dir):
    """One WARNING for each task that newly times out, by event-time timers
    while the stream runs, over files in order of time."""
    return _timeout_alerts(spark, *_in_turn(spark, sf_dir))


@register("stream_timeout_alerts_late", _TIMEOUT_SQL)
def stream_timeout_alerts_late(spark, sf_dir):
    """The same over files in no order of time and with redeliveries: what is
    behind the watermark goes to a side table and its tasks are replayed."""
    return _timeout_alerts(spark, *_late_files(spark, sf_dir))


# ------------------------------------------------------------------ unit status

def _again_files(spark, sf_dir):
    """The events dealt over files by a hash, every fifth delivered twice, the
    second time as it was in another file."""
    ev = S.read_source(spark, sf_dir, "events").withColumn("_copy", F.lit(0))
    again = ev.where("event_id % 5 = 0").withColumn("_copy", F.lit(1))
    per = _files_a_slice(ev.count())
    path = new_run_dir(spark, "stream-again") + "/events"
    ev.unionByName(again).repartition(SLICES * per, F.xxhash64("event_id", "_copy")).drop("_copy").write.parquet(path)
    return path, S.read_source(spark, sf_dir, "events").schema, per


def _stream_units(spark, sf_dir):
    src, schema, per = _again_files(spark, sf_dir)
    run = new_run_dir(spark, "stream-units")
    RQ._replay(spark, sf_dir).write.parquet(f"{run}/tasks")
    tasks = spark.read.parquet(f"{run}/tasks")
    stream = _stream(spark, src, schema, per)
    US.stream_units(RL.reports_from_events(stream), tasks, f"{run}/units", f"{run}/ckpt", every=3)
    return tasks, f"{run}/units"


@register("stream_unit_status", ORACLES["latest_unit_status"])
def stream_unit_status(spark, sf_dir):
    """Unit rows from a stream of reports in no order and with redeliveries:
    checks by a stream-static join, merge by batch id, claims and resets of the
    tasks applied to the merged table."""
    tasks, out = _stream_units(spark, sf_dir)
    units = RQ.TK.latest_units(US.current_reports(spark, out), tasks)
    return units.select("task_id", "table_name", "status", "rows_local", "rows_lake", "error_msg",
                        RQ._txt("updated_at").alias("updated_at"))


@register("stream_rejected_reports", f"""
SELECT report_id, task_id, table_name, status, server, reject_reason, CASE WHEN report_id % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS n_times
FROM {RQ.checked_reports_sql()} WHERE reject_reason IS NOT NULL
""")
def stream_rejected_reports(spark, sf_dir):
    """The side table of the same stream: rejected reports, and how often each
    was delivered."""
    _, out = _stream_units(spark, sf_dir)
    keys = ["report_id", "task_id", "table_name", "status", "server", "reject_reason"]
    return US.rejected_reports(spark, out).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_times"))
