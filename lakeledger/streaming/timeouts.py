"""Timeout alerts while a stream runs.

* :func:`route_late` - a stateless pass in front of the stateful ones: rows
  behind the watermark go to a side table, the others are landed for the next
  stream.  Spark drops late rows in front of an operator with timers; this way
  none is lost, and the tasks that they concern are known.
* :func:`stream_timeouts` - ``transformWithState`` on RocksDB.  A task's events
  wait in its state until the watermark has passed them, so they are folded in
  (ts, seq) order whatever their order of arrival.  A task in progress has a
  timer at its start plus the limit; when it fires the task becomes
  ``timeout`` and one row is emitted.  An event that the fold meets first, later
  than the limit, does the same.  State holds each task and the events within
  the watermark's delay.  A call for a key costs milliseconds whatever it holds,
  so tasks share ``GROUPS`` keys by the hash of their id, and a key has one timer
  at the earliest instant that one of its tasks waits for.
* :func:`timeout_alerts` - the alert records: those of the stream, and for tasks
  with late events those of a replay of the landed log.

The watermark follows the events.  A sweep at an instant is an event, too: a row
of no task with the time ``instant + delay`` moves the watermark to the instant.
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeledger.functions import catalog as C
from lakeledger.operators import finalize
from lakeledger.operators.tasks import timeout_history

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ACTING = ["claim", "complete", "failed", "reset"]
OUT = "task_id long, server string, month string, started_us long"
#: groups of tasks; a checkpoint keeps the number that it began with
GROUPS = 1024
MISSING = -2 ** 63  # a null task: pandas would make floats of the other ids
#: a group's tasks, each with its state, and its waiting events, as JSON
TASKS = "tasks string"
EVENTS = "events string"
NEW = ("new", None, None, None, None)


def fold(state: tuple, events: list[tuple], limit_us: int) -> tuple[tuple, list[tuple]]:
    """A task's state after events in order, and its timeouts on the way as
    (started_us, month, server).  An event with a seq that is not above all
    before is a redelivery."""
    st, started, month, server, max_seq = state
    out = []
    for us, seq, event, e_month, e_server in events:
        if max_seq is not None and seq <= max_seq:
            continue
        max_seq = seq
        if st == "progress" and started + limit_us < us:
            st = "timeout"
            out.append((started, month, server))
        if event == "claim" and st == "new":
            st, started, month, server = "progress", us, e_month, e_server
        elif event in ("complete", "failed") and st == "progress":
            st = event
        elif event == "reset" and st != "progress":
            st, started = "new", None
    return (st, started, month, server, max_seq), out


class TaskTimers(StatefulProcessor):
    """Folds the events of a group's tasks up to the watermark and times tasks
    out by timers."""

    def __init__(self, limit_hours: int):
        self.limit_us = limit_hours * 3_600_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tasks = handle.getValueState("tasks", TASKS)
        self.waiting = handle.getListState("waiting", EVENTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for b in rows:
            b = b[b["event"].isin(ACTING)]
            texts = [b[c].astype(object).where(b[c].notna(), None) for c in ("event", "month", "server")]
            events = list(zip(*[b[c].tolist() for c in ("task_id", "us", "seq")], *texts, strict=True))
            if events:
                self.waiting.appendValue((json.dumps(events),))
                first = min([e[1] for e in events] + ([] if first is None else [first]))
        if first is not None:
            self.handle.registerTimer(first // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        tasks = {t: tuple(s) for t, *s in json.loads(self.tasks.get()[0])} if self.tasks.exists() else {}
        chunks = list(self.waiting.get()) if self.waiting.exists() else []
        ready, later, found, due = defaultdict(list), [], [], []
        for chunk in chunks:
            for e in json.loads(chunk[0]):
                if e[1] <= mark:
                    ready[e[0]].append(tuple(e[1:]))
                else:
                    later.append(e)
        for t, events in ready.items():
            tasks[t], out = fold(tasks.get(t, NEW), sorted(events), self.limit_us)
            found += [(t, server, month, started) for started, month, server in out]
        for t, (st, started, month, server, max_seq) in tasks.items():
            if st == "progress" and started + self.limit_us < mark:
                found.append((t, server, month, started))
                tasks[t] = ("timeout", started, month, server, max_seq)
            elif st == "progress":
                due.append(started + self.limit_us)
        self.tasks.update((json.dumps([[t, *s] for t, s in tasks.items()]),))
        if later:
            self.waiting.put([(json.dumps(later),)])
            due.append(min(e[1] for e in later))
        elif chunks:
            self.waiting.clear()
        if due:
            # at its millisecond the timer may be just before the limit
            self.handle.registerTimer(max(min(due) // 1000, mark // 1000 + 1))
        if found:
            found = [(None if t == MISSING else t, *rest) for t, *rest in found]
            yield pd.DataFrame(found, columns=["task_id", "server", "month", "started_us"], dtype=object)

    def close(self) -> None:
        pass


def route_late(source: DataFrame, out_dir: str, checkpoint_dir: str, delay_hours: int) -> None:
    """Land a streaming run log in ``out_dir``: rows that are not behind the
    watermark (the greatest time of this batch and those before, less the delay)
    under ``on_time``, the others under ``late``.  So the next stream may split
    and join the landed batches and finds none of their rows late.  Each
    micro-batch has a folder of its own, which a repeated batch overwrites, and
    a row in ``clock``.  A row without a time or a seq is late."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, clock = batch.sparkSession, f"{out_dir}/clock"
        batch.agg(F.max("ts").alias("top")).write.mode("overwrite").parquet(f"{clock}/batch_id={batch_id}")
        # one row a batch
        mark = (spark.read.schema("top timestamp, batch_id long").parquet(clock).where(F.col("batch_id") <= batch_id)
                .agg(F.unix_micros(F.max("top")) - F.lit(delay_hours * 3_600_000_000)).first()[0])
        ahead = F.lit(False) if mark is None else F.coalesce((F.unix_micros("ts") > F.lit(mark)) & F.col("seq").isNotNull(), F.lit(False))
        batch.where(ahead).write.mode("overwrite").parquet(f"{out_dir}/on_time/batch_id={batch_id}")
        batch.where(~ahead).write.mode("overwrite").parquet(f"{out_dir}/late/batch_id={batch_id}")

    q = (source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()


LOG = "task_id long, month string, server string, event string, ts timestamp, seq long"


def stream_timeouts(spark: SparkSession, landed_dir: str, out_dir: str, checkpoint_dir: str, *, delay_hours: int,
                    timeout_hours: int = C.TASK_TIMEOUT_HOURS, files_per_batch: int = 8) -> None:
    """Emit a row (task_id, server, month, started_us) for each task that newly
    times out, over what :func:`route_late` has landed in ``landed_dir``; each
    micro-batch writes its own folder.  Runs until all input is processed; run
    again it goes on where it stopped."""
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    own = spark.newSession()  # RocksDB for this query alone
    own.conf.set(PROVIDER, ROCKSDB)
    # batches write their changes, not whole snapshots, and few of them are kept
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.minBatchesToRetain", "4")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    rows = own.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_batch).parquet(f"{landed_dir}/on_time/*")
    rows = (rows.withWatermark("ts", f"{int(delay_hours)} hours").withColumn("us", F.unix_micros("ts"))
            .withColumn("g", F.pmod(F.xxhash64("task_id"), F.lit(GROUPS)))
            .withColumn("task_id", F.coalesce("task_id", F.lit(MISSING))))
    found = rows.groupBy("g").transformWithStateInPandas(TaskTimers(timeout_hours), OUT, "Update", "EventTime")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    q = (found.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def timeout_alerts(spark: SparkSession, landed_dir: str, out_dir: str, log: DataFrame, *, now: str,
                   timeout_hours: int = C.TASK_TIMEOUT_HOURS) -> DataFrame:
    """Alert records of all timeouts up to ``now``: the stream's rows, but for
    tasks with late events those of a replay of ``log``, the landed events as a
    batch table."""
    found = spark.read.schema(OUT).parquet(out_dir)
    late = spark.read.schema(LOG).parquet(f"{landed_dir}/late").select("task_id").distinct()
    again = timeout_history(log.join(late, "task_id", "left_semi"), now=now, timeout_hours=timeout_hours)
    rows = found.select("task_id", "server", "month", F.timestamp_micros("started_us").cast("timestamp_ntz").alias("started_at"))
    rows = rows.join(late, "task_id", "left_anti").unionByName(again)
    return finalize.timeout_alerts(rows, timeout_hours)
