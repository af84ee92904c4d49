"""Timers in a stream: order within the delay, late rows, restarts."""

import random

from pyspark.sql import functions as F

from lakeledger.operators import tasks as TK
from lakeledger.streaming import timeouts as TO

SCHEMA = "task_id long, month string, server string, event string, ts timestamp, seq long"
HOUR = 3600
START = 1_704_067_200  # 2024-01-01
NOW = "2024-01-31 00:00:00"


def rows_of(events, seq=0):
    """(task, hour, event) as log rows."""
    return [(t, "202401", f"srv-{t}", e, h, seq + i) for i, (t, h, e) in enumerate(events)]


def land(spark, path, rows):
    df = spark.createDataFrame(rows, "task_id long, month string, server string, event string, h double, seq long")
    (df.select("task_id", "month", "server", "event", F.timestamp_micros(((F.col("h") * HOUR + START) * 1_000_000).cast("long"))
               .alias("ts"), "seq").coalesce(1).write.mode("append").parquet(path))


def run(spark, base, delay=24):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    TO.route_late(src, f"{base}/landed", f"{base}/ck1", delay)
    TO.stream_timeouts(spark, f"{base}/landed", f"{base}/out", f"{base}/ck2", delay_hours=delay, files_per_batch=1)


def emitted(spark, base):
    got = spark.read.schema(TO.OUT).parquet(f"{base}/out").collect()
    return sorted((r.task_id, (r.started_us / 1e6 - START) / HOUR) for r in got)


def tick(hour, delay=24):
    return [(-1, None, None, "tick", float(hour + delay), 10**6)]


def test_each_rule_and_a_restart(spark, tmp_path):
    base = str(tmp_path)
    land(spark, f"{base}/src", rows_of([(t, 0.0, "claim") for t in (1, 2, 3, 4)]))
    land(spark, f"{base}/src", rows_of([
        (2, 47.0, "complete"),  # ends in time; task 1 never ends: one alert
        (3, 48.0, "failed"),    # ends at the limit: in time
        (4, 49.0, "complete"),  # too late: the end is refused
    ], 10))
    run(spark, base)
    assert emitted(spark, base) == []  # the watermark is at 25 h
    land(spark, f"{base}/src", rows_of([(5, 60.0, "claim"), (4, 60.0, "reset"), (4, 61.0, "claim"), (9, 80.0, "other")], 50))
    run(spark, base)
    assert emitted(spark, base) == [(1, 0.0), (4, 0.0)]
    land(spark, f"{base}/src", rows_of([(5, 100.0, "reset"), (6, 100.0, "complete")], 90))
    land(spark, f"{base}/src", tick(109))
    run(spark, base)
    # task 5 at 108 h; 4 again, at 109 h exactly: not yet
    assert emitted(spark, base) == [(1, 0.0), (4, 0.0), (5, 60.0)]
    land(spark, f"{base}/src", tick(200))
    run(spark, base)
    run(spark, base)  # nothing new
    assert emitted(spark, base) == [(1, 0.0), (4, 0.0), (4, 61.0), (5, 60.0)]
    assert spark.read.schema(SCHEMA).parquet(f"{base}/landed/late").count() == 0


def test_random_logs_equal_the_batch_fold(spark, tmp_path):
    """Files in order but for a day, some rows behind the watermark,
    redeliveries: stream and side table against a fold in Python."""
    rng = random.Random(3)
    base, events = str(tmp_path), []
    for k in range(400):
        events.append((rng.randrange(12), round(k * 1.5 + rng.random(), 3), rng.choice(
            ["claim", "claim", "complete", "failed", "reset", "create"])))
    rows = rows_of(events)
    late = [r for r in rows if r[0] in (3, 4) and 100 < r[4] < 300]
    files = [[r for r in rows if r not in late and lo <= r[4] < lo + 60] for lo in range(0, 660, 60)]
    for k, f in enumerate(files):
        again = [(*r[:4], r[4] + 0.5, r[5]) for r in f if r[5] % 11 == 0]
        land(spark, f"{base}/src", rng.sample(f + again, len(f + again)))
        if k == 9:
            land(spark, f"{base}/src", late)
    land(spark, f"{base}/src", tick(720, 100))
    run(spark, base, delay=100)
    assert spark.read.schema(SCHEMA).parquet(f"{base}/landed/late").select("task_id").distinct().count() == 2
    log = spark.read.schema(SCHEMA).parquet(f"{base}/src").where("task_id >= 0")
    want = []
    for t in range(12):
        own = sorted({(r[4], r[5], r[3]) for r in rows if r[0] == t}) + [(720.0, 10**7, "sweep")]
        st, on = "new", None
        for h, _, e in own:
            if st == "progress" and on < h - 48:
                st = "timeout"
                want.append((t, on))
            if e == "claim" and st == "new":
                st, on = "progress", h
            elif e in ("complete", "failed") and st == "progress":
                st = e
            elif e == "reset" and st != "progress":
                st = "new"
    alerts = TO.timeout_alerts(spark, f"{base}/landed", f"{base}/out", log, now=NOW)
    text = {(t, h) for t, h in want}
    got = alerts.select("task_id", F.substring_index("error_msg", "at ", -1).cast("timestamp").alias("at")).collect()
    assert len(got) == len(want) > 10 and {r.task_id for r in got} == {t for t, _ in text}
    history = TK.timeout_history(log, now=NOW).select("task_id", F.unix_micros(F.col("started_at").cast("timestamp")).alias("us"))
    assert sorted((r.task_id, round((r.us / 1e6 - START) / HOUR, 3)) for r in history.collect()) == sorted(want)


def test_empty_log(spark, tmp_path):
    base = str(tmp_path)
    land(spark, f"{base}/src", tick(0))
    run(spark, base)
    assert emitted(spark, base) == []


def test_tasks_that_share_a_group(spark, tmp_path, monkeypatch):
    """All tasks in one group, which has one timer: each task times out at its
    own instant; a task without an id and events without a seq take part."""
    monkeypatch.setattr(TO, "GROUPS", 1)
    base = str(tmp_path)
    land(spark, f"{base}/src", rows_of([(t, 2.0 * t, "claim") for t in range(1, 6)] + [(None, 1.0, "claim")]))
    land(spark, f"{base}/src", [(2, "202401", "srv-2", "complete", 30.0, None)])
    land(spark, f"{base}/src", tick(53))
    run(spark, base)
    got = spark.read.schema(TO.OUT).parquet(f"{base}/out").collect()
    assert sorted(str(r.task_id) for r in got) == ["1", "2", "None"]
    late = spark.read.schema(SCHEMA).parquet(f"{base}/landed/late").collect()
    assert [r.task_id for r in late] == [2]  # its events are replayed from the log
    land(spark, f"{base}/src", tick(150))
    run(spark, base)
    got = spark.read.schema(TO.OUT).parquet(f"{base}/out").collect()
    assert sorted(str(r.task_id) for r in got) == ["1", "2", "3", "4", "5", "None"]
