import datetime as dt
import json
import os
import random
import tempfile

import pandas as pd

from lakeledger.operators import finalize as FZ
from lakeledger.operators.tasks import replay_tasks
from lakeledger.streaming import tasks_stream as TS
from lakeledger.streaming.tasks_stream import _empty_state, fold_events

T0 = pd.Timestamp("2024-01-01")


def _rows(items):
    return pd.DataFrame([{"event": e, "ts": T0 + pd.Timedelta(hours=h), "seq": s,
                          "month": "202401", "server": "srv-001"} for e, h, s in items])


def test_batches_fold_like_one_batch_and_late_events_are_counted():
    items = [("create", 0, 0), ("claim", 1, 1), ("failed", 2, 2), ("reset", 3, 3), ("claim", 4, 4),
             ("complete", 5, 5)]
    whole = fold_events(_empty_state(), _rows(items), 48)
    split = fold_events(fold_events(_empty_state(), _rows(items[:3]), 48), _rows(items[3:]), 48)
    assert whole == split and whole["st"] == "complete" and whole["n_late"] == 0
    late = fold_events(split, _rows([("reset", 2.5, 9), ("complete", 5, 5)]), 48)   # older + redelivery
    assert late["st"] == "complete" and late["n_late"] == 1


def test_timeout_in_stream_fold():
    s = fold_events(_empty_state(), _rows([("claim", 0, 1), ("complete", 49, 2)]), 48)
    assert s["st"] == "timeout" and s["err"] == "Auto-timeout: started at 2024-01-01 00:00:00"


def test_alert_sink_writes_json(spark):
    rows = spark.createDataFrame([("m1", "t", "msg", "INFO", "src", ["a", "b"], "ch")],
                                 "month string, title string, message string, level string, source string, "
                                 "tags array<string>, channel string")
    out = os.path.join(tempfile.mkdtemp(prefix="lakeledger-test-alerts-"), "alerts")
    FZ.write_alerts(rows, out)
    docs = [json.loads(line) for f in os.listdir(out) if f.endswith(".json")
            for line in open(os.path.join(out, f))]
    assert docs == [{"month": "m1", "title": "t", "message": "msg", "level": "INFO", "source": "src",
                     "tags": ["a", "b"], "channel": "ch"}]


class _State:
    exists, value = False, None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.exists, self.value = True, value


def test_one_call_folds_the_tasks_of_a_group():
    """Two micro-batches of one group, its rows in no order, against the fold
    of each task alone."""
    rng, us = random.Random(5), lambda h: 1_704_067_200_000_000 + int(h * 3_600_000_000)
    rows = [(t, "202401", f"srv-{t}", rng.choice(["create", "claim", "claim", "failed", "reset"]), us(3 * k + t), 10 * k + t)
            for t in range(9) for k in range(20)]
    state, got = _State(), {}
    for part in ([r for r in rows if r[5] < 90], [r for r in rows if r[5] >= 90]):
        frame = pd.DataFrame(rng.sample(part, len(part)), columns=["task_id", "month", "server", "event", "ts", "seq"])
        for out in TS._group_fn(48)((0,), iter([frame[:7], frame[7:]]), state):
            got.update({r.task_id: r for r in out.itertuples(index=False)})
    assert sorted(got) == list(range(9)) and len(json.loads(state.value[0])) == 9
    for t, r in got.items():
        own = pd.DataFrame([x for x in rows if x[0] == t], columns=["task_id", "month", "server", "event", "ts", "seq"])
        own["ts"] = pd.to_datetime(own["ts"], unit="us")
        want = fold_events(_empty_state(), own, 48)
        assert (r.st, r.err, r.n_late, r.last_seq) == (want["st"], want["err"], want["n_late"], want["last_seq"])
        assert want["started"] is None and r.started is None or pd.Timestamp(r.started, unit="us") == want["started"]


def test_late_and_timeless_events_of_tasks_that_share_a_group(spark, tmp_path, monkeypatch):
    """Three files in no order, two groups for twelve tasks, against the batch
    replay; an event without a time is put into place by the replay."""
    monkeypatch.setattr(TS, "GROUPS", 2)
    rng = random.Random(8)
    rows = [(t, "202401", "srv-1", rng.choice(["create", "claim", "failed", "reset"]), 7.0 * k + t, 12 * k + t)
            for k in range(15) for t in range(12)]
    rows[40] = (*rows[40][:4], None, rows[40][5])
    schema = "task_id long, month string, server string, event string, ts timestamp, seq long"
    part = rng.sample(rows, len(rows))
    for k in range(3):
        df = spark.createDataFrame(part[k::3], "task_id long, month string, server string, event string, h double, seq long")
        (df.selectExpr("task_id", "month", "server", "event", "timestamp_seconds(1704067200 + h * 3600) AS ts", "seq")
         .coalesce(1).write.mode("append").parquet(f"{tmp_path}/src"))
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src")
    TS.stream_tasks(spark, src, f"{tmp_path}/out", f"{tmp_path}/ck")
    log = spark.read.schema(schema).parquet(f"{tmp_path}/src")
    cols = ["task_id", "status", "started_at", "completed_at", "error_msg", "last_reset_at"]
    log = log.withColumn("ts", log.ts.cast("timestamp_ntz"))
    got = TS.current_tasks(spark, f"{tmp_path}/out", now="2024-01-31 00:00:00", log=log).select(*cols)
    want = replay_tasks(log, now="2024-01-31 00:00:00").select(*cols)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
