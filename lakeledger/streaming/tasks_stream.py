"""Structured Streaming forms of the run-log operators.

* :func:`stream_tasks` - task state machine as ``applyInPandasWithState``:
  per task, the micro-batch's rows are sorted by (ts, seq) and folded onto
  the stored state with the same rules as the batch replay.  There is no
  watermark, so no event is dropped however late it is.  An event that is not
  after everything applied so far (by ts, and by seq: a redelivery) cannot be
  folded in; it marks its task, and :func:`current_tasks` replays the marked
  tasks from the log.  So stream = batch in any order of arrival.  A call of
  the state function costs milliseconds whatever it holds, so tasks meet it in
  ``GROUPS`` groups by the hash of their id; a group's row in the state store
  holds a state for each of its tasks.
* :func:`stream_liveness` - latest heartbeat per member, a streaming
  ``max``/``max_by`` aggregate.

Both run with ``trigger(availableNow=True)`` and write each micro-batch through
``foreachBatch`` to its own ``batch_id=`` folder, which a repeated batch
overwrites; the current state is the latest row per key.  The timeout sweep
runs over the stream's states (``now`` of :func:`current_tasks`): a timer on
event time would need a watermark.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from lakeledger.functions import catalog as C
from lakeledger.operators.tasks import replay_tasks

STATE_COLS = ["st", "started", "completed", "err", "first_claim", "last_reset",
              "last_ts", "last_seq", "max_seq", "month", "server", "created", "n_late"]
STATE_SCHEMA = ("st string, started timestamp, completed timestamp, err string, "
                "first_claim timestamp, last_reset timestamp, last_ts timestamp, last_seq long, max_seq long, "
                "month string, server string, created timestamp, n_late long")
OUT_SCHEMA = "task_id long, " + STATE_SCHEMA

#: groups of tasks; a checkpoint keeps the number that it began with
GROUPS = 1024
#: a time or id that is null in the log: pandas would make floats of the others
MISSING = -2 ** 63
TIMES = ["started", "completed", "first_claim", "last_reset", "last_ts", "created"]
FOLDED = "task_id long, " + ", ".join(
    f"{c} long" if c in [*TIMES, "last_seq", "max_seq", "n_late"] else f"{c} string" for c in STATE_COLS)


def _fmt(t) -> str:
    return pd.Timestamp(t).strftime("%Y-%m-%d %H:%M:%S")


def _fold(s: dict, events: Iterable[tuple], limit, text: Callable) -> dict:
    """Apply one task's events (event, ts, seq, month, server), in (ts, seq)
    order, to its state ``s``.  Times and ``limit`` are of any one kind that
    ``text`` can print."""
    for event, ts, seq, month, server in events:
        if event == "create" and ts != MISSING:
            s["created"] = ts if s["created"] is None else min(s["created"], ts)
        if month is not None:
            s["month"] = month if s["month"] is None else min(s["month"], month)
        if server is not None:
            s["server"] = server if s["server"] is None else min(s["server"], server)
        if event not in ("claim", "complete", "failed", "reset"):
            continue
        if ts == MISSING or seq == MISSING:  # it has no place in the order here: the batch replay gives it one
            s["n_late"] += 1
            continue
        if s["last_ts"] is not None and (ts <= s["last_ts"] and (ts, seq) <= (s["last_ts"], s["last_seq"])
                                         or seq <= s["max_seq"]):
            s["n_late"] += 0 if (ts, seq) == (s["last_ts"], s["last_seq"]) else 1
            continue
        s["last_ts"], s["last_seq"] = ts, seq
        s["max_seq"] = seq if s["max_seq"] is None else max(s["max_seq"], seq)
        st = s["st"]
        if limit is not None and st == "progress" and s["started"] < ts - limit:
            st = "timeout"
            s["err"] = "Auto-timeout: started at " + text(s["started"])
        if event == "claim" and st == "new":
            st, s["started"], s["completed"] = "progress", ts, None
            if s["first_claim"] is None:
                s["first_claim"] = ts
        elif event in ("complete", "failed") and st == "progress":
            st, s["completed"] = event, ts
        elif event == "reset" and st != "progress":
            st, s["started"], s["completed"], s["err"], s["last_reset"] = "new", None, None, "", ts
        s["st"] = st
    return s


def fold_events(state: dict, rows: pd.DataFrame, timeout_hours: int | None) -> dict:
    """Apply one task's new events (any order) to its state, in (ts, seq)
    order.  Small per-task helper: the distribution is Spark's."""
    limit = None if timeout_hours is None else dt.timedelta(hours=timeout_hours)
    rows = rows.sort_values(["ts", "seq"])
    return _fold(dict(state), zip(*[rows[c] for c in ("event", "ts", "seq", "month", "server")], strict=True), limit, _fmt)


def _empty_state() -> dict:
    return {"st": "new", "started": None, "completed": None, "err": "", "first_claim": None,
            "last_reset": None, "last_ts": None, "last_seq": None, "max_seq": None, "month": None, "server": None,
            "created": None, "n_late": 0}


def _text_us(us: int) -> str:
    return _fmt(dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us))


def _group_fn(timeout_hours: int | None):
    """Folds a micro-batch's events of one group of tasks; times are
    microseconds.  Yields the new states of the tasks that had events."""
    limit = None if timeout_hours is None else timeout_hours * 3_600_000_000

    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        tasks = {r[0]: r[1:] for r in json.loads(state.get[0])} if state.exists else {}
        rows = pd.concat(list(pdfs), ignore_index=True).sort_values(["task_id", "ts", "seq"], ignore_index=True)
        ids = rows["task_id"].tolist()
        texts = {c: rows[c].astype(object).where(rows[c].notna(), None) for c in ("event", "month", "server")}
        events = list(zip(texts["event"], rows["ts"].tolist(), rows["seq"].tolist(), texts["month"], texts["server"], strict=True))
        out, at = [], 0
        while at < len(ids):
            task, to = ids[at], at + 1
            while to < len(ids) and ids[to] == task:
                to += 1
            s = dict(zip(STATE_COLS, tasks[task], strict=True)) if task in tasks else _empty_state()
            s = _fold(s, events[at:to], limit, _text_us)
            tasks[task] = [s[c] for c in STATE_COLS]
            out.append([None if task == MISSING else task, *tasks[task]])
            at = to
        state.update((json.dumps([[t, *s] for t, s in tasks.items()]),))
        yield pd.DataFrame(out, columns=["task_id", *STATE_COLS], dtype=object)
    return fn


def _ship_to_workers() -> None:
    """Serialize this module's fold helpers by value, so Python workers only
    need pandas, not this package on their path."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def stream_tasks(spark: SparkSession, source: DataFrame, out_dir: str, checkpoint_dir: str, *,
                 timeout_hours: int | None = C.TASK_TIMEOUT_HOURS) -> None:
    """Run the task replay as a stream over ``source`` (a streaming run log)
    until all available input is processed."""
    _ship_to_workers()
    known = lambda c: F.coalesce(c, F.lit(MISSING))
    ev = source.select(F.pmod(F.xxhash64("task_id"), F.lit(GROUPS)).alias("g"), known(F.col("task_id").cast("long")).alias("task_id"),
                       "month", "server", "event", known(F.unix_micros(F.col("ts").cast("timestamp"))).alias("ts"),
                       known(F.col("seq")).alias("seq"))
    folded = ev.groupBy("g").applyInPandasWithState(
        _group_fn(timeout_hours), FOLDED, "tasks string", "update", GroupStateTimeout.NoTimeout)
    states = folded.select("task_id", *[F.timestamp_micros(c).alias(c) if c in TIMES else F.col(c) for c in STATE_COLS])

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    q = (states.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()


def _latest(spark: SparkSession, out_dir: str, schema: str) -> DataFrame:
    """All rows of the batches, with their number."""
    return (spark.read.schema(schema + ", batch_id string").parquet(out_dir)
            .withColumn("batch_id", F.col("batch_id").cast("long")))


def late_tasks(spark: SparkSession, out_dir: str) -> DataFrame:
    """(task_id, n_late): tasks with events that came too late to be folded."""
    return (_latest(spark, out_dir, OUT_SCHEMA).groupBy("task_id").agg(F.max("n_late").alias("n_late"))
            .where("n_late > 0"))


def current_tasks(spark: SparkSession, out_dir: str, now: str | None = None,
                  timeout_hours: int | None = C.TASK_TIMEOUT_HOURS, log: DataFrame | None = None) -> DataFrame:
    """Latest state row per task from the stream's output table, with the
    timeout sweep at ``now`` (same columns as the batch replay).  ``log``, the
    landed events as a batch table, replays the tasks that have late events;
    without it they show the state before those."""
    out = _folded_tasks(spark, out_dir, now, timeout_hours)
    if log is None:
        return out
    late = late_tasks(spark, out_dir)
    again = replay_tasks(log.join(late, "task_id", "left_semi"), timeout_hours=timeout_hours, now=now)
    again = again.join(late, "task_id").select(*out.columns)
    return out.join(late.select("task_id"), "task_id", "left_anti").unionByName(again)


def _folded_tasks(spark: SparkSession, out_dir: str, now: str | None, timeout_hours: int | None) -> DataFrame:
    raw = _latest(spark, out_dir, OUT_SCHEMA)
    cols = [c for c in raw.columns if c not in ("task_id", "batch_id")]
    last = raw.groupBy("task_id").agg(F.max_by(F.struct(*cols), "batch_id").alias("s"))
    s = F.col("s")
    ntz = lambda c: c.cast("timestamp_ntz")
    status, err = s["st"], s["err"]
    if now is not None and timeout_hours is not None:
        swept = (status == "progress") & (ntz(s["started"]) < F.lit(now).cast("timestamp_ntz")
                                           - F.expr(f"INTERVAL {int(timeout_hours)} HOURS"))
        err = F.when(swept, F.concat(F.lit("Auto-timeout: started at "),
                                     F.date_format(ntz(s["started"]), "yyyy-MM-dd HH:mm:ss"))).otherwise(err)
        status = F.when(swept, F.lit("timeout")).otherwise(status)
    return last.select("task_id", s["month"].alias("month"), s["server"].alias("server"),
                       status.alias("status"), ntz(s["started"]).alias("started_at"),
                       ntz(s["completed"]).alias("completed_at"), err.alias("error_msg"),
                       ntz(s["first_claim"]).alias("first_claim_at"), ntz(s["last_reset"]).alias("last_reset_at"),
                       ntz(s["created"]).alias("created_at"), s["n_late"].alias("n_late"))


def stream_liveness(spark: SparkSession, beats: DataFrame, out_dir: str, checkpoint_dir: str) -> None:
    """Latest heartbeat per member as a streaming aggregate (update mode,
    partial aggregation per micro-batch, state kept per member).  Each batch
    writes the members that it changed; :func:`current_liveness` reads them."""
    agg = (beats.select("member", "server", F.col("ts").cast("timestamp").alias("ts"), "seq", "detail")
           .groupBy("member")
           .agg(F.max("server").alias("server"), F.max("ts").alias("last_seen"),
                F.max_by("detail", F.struct("ts", "seq")).alias("last_detail")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()


LIVE_SCHEMA = "member long, server string, last_seen timestamp, last_detail string"


def current_liveness(spark: SparkSession, out_dir: str) -> DataFrame:
    """(member, server, last_seen, last_detail) after the last batch."""
    rows = _latest(spark, out_dir, LIVE_SCHEMA)
    return (rows.groupBy("member").agg(F.max_by(F.struct("server", "last_seen", "last_detail"), "batch_id").alias("s"))
            .select("member", "s.*"))
