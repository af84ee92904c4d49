import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from lakeledger.operators import tasks as TK
from lakeledger.sources.runlog import RUN_EVENT_SCHEMA
from lakeledger.streaming.tasks_stream import _empty_state, fold_events

T0 = dt.datetime(2024, 1, 1)


def _log(spark, rows):
    """rows: (task_id, event, hours_after_T0, seq)"""
    data = [(t, "202401", "srv-001", None, e, None, None, None, T0 + dt.timedelta(hours=h), s)
            for t, e, h, s in rows]
    return spark.createDataFrame(data, RUN_EVENT_SCHEMA)


def _state(spark, rows, **kw):
    out = TK.replay_tasks(_log(spark, rows), **kw).collect()
    return {r.task_id: r for r in out}


def test_guards(spark):
    rows = [
        (1, "claim", 0, 1), (1, "complete", 1, 2),                        # complete
        (2, "complete", 0, 3), (2, "claim", 1, 4),                        # complete before claim ignored
        (3, "claim", 0, 5), (3, "reset", 1, 6),                           # reset refused in progress
        (4, "claim", 0, 7), (4, "failed", 1, 8), (4, "reset", 2, 9),      # failed then reset -> new
        (5, "claim", 0, 10), (5, "claim", 1, 11), (5, "failed", 2, 12),   # first claim wins
        (6, "create", 0, 13),                                             # only created
    ]
    s = _state(spark, rows, timeout_hours=None)
    assert s[1].status == "complete" and s[1].completed_at == T0 + dt.timedelta(hours=1)
    assert s[2].status == "progress" and s[2].started_at == T0 + dt.timedelta(hours=1)
    assert s[3].status == "progress"
    assert s[4].status == "new" and s[4].started_at is None and s[4].last_reset_at is not None
    assert s[5].status == "failed" and s[5].started_at == T0
    assert s[6].status == "new" and s[6].created_at == T0


def test_timeout_rules(spark):
    rows = [
        (1, "claim", 0, 1), (1, "complete", 49, 2),                 # late complete refused
        (2, "claim", 0, 3), (2, "complete", 47, 4),                 # in time
        (3, "claim", 0, 5), (3, "reset", 50, 6),                    # timeout then reset accepted
        (4, "claim", 0, 7),                                         # swept at now
        (5, "claim", 0, 8), (5, "claim", 60, 9),                    # timed out at the last claim of a run
    ]
    s = _state(spark, rows, timeout_hours=48, now="2024-01-02 12:00:00")
    assert s[1].status == "timeout" and s[1].completed_at is None
    assert s[1].error_msg == "Auto-timeout: started at 2024-01-01 00:00:00"
    assert s[2].status == "complete"
    assert s[3].status == "new"
    assert s[4].status == "progress"          # 36 h before now: not yet overdue
    assert s[5].status == "timeout"           # without a sweep, seen at hour 60
    s2 = _state(spark, rows, timeout_hours=48, now="2024-01-03 00:00:01")
    assert s2[4].status == "timeout"


def _random_rows(rng, n_tasks=40, n_events=30):
    rows, seq = [], 0
    for t in range(n_tasks):
        h = 0.0
        for _ in range(rng.randint(0, n_events)):
            h += rng.choice([0.5, 1, 5, 20, 30, 60])
            e = rng.choice(["claim", "claim", "complete", "failed", "reset", "reset", "create", "heartbeat"])
            rows.append((t, e, h, seq))
            seq += 1
            if rng.random() < 0.1:   # exact redelivery
                rows.append((t, e, h, seq - 1))
    return rows


def _brute(rows, timeout_hours, now):
    out = {}
    df = pd.DataFrame([{"task_id": t, "event": e, "ts": pd.Timestamp(T0 + dt.timedelta(hours=h)), "seq": s,
                        "month": "202401", "server": "srv-001"} for t, e, h, s in rows])
    for t, g in df.groupby("task_id"):
        s = fold_events(_empty_state(), g.drop_duplicates(["seq"]), timeout_hours)
        st = s["st"]
        if now is not None and timeout_hours is not None and st == "progress" and \
                s["started"] < pd.Timestamp(now) - pd.Timedelta(hours=timeout_hours):
            st = "timeout"
        out[t] = (st, s["started"], s["last_reset"])
    return out


def test_reduced_fold_equals_brute_force(spark):
    rng = random.Random(7)
    rows = _random_rows(rng)
    for timeout, now in [(None, None), (48, None), (48, "2024-01-20 00:00:00")]:
        got = _state(spark, rows, timeout_hours=timeout, now=now)
        want = _brute(rows, timeout, now)
        for t, (st, started, last_reset) in want.items():
            r = got[t]
            assert r.status == st, (t, timeout, now)
            assert (r.started_at is None and started is None) or pd.Timestamp(r.started_at) == started
            assert (r.last_reset_at is None and last_reset is None) or pd.Timestamp(r.last_reset_at) == last_reset


def test_order_comes_from_ts_and_seq_not_input_order(spark):
    rng = random.Random(3)
    rows = _random_rows(rng, n_tasks=15)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    a = TK.replay_tasks(_log(spark, rows), now="2024-01-20 00:00:00")
    b = TK.replay_tasks(_log(spark, shuffled).repartition(5), now="2024-01-20 00:00:00")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_redelivery_counts_once(spark):
    """Seq 2 comes again hours later: the earliest delivery counts."""
    rows = [(1, "claim", 1, 1), (1, "complete", 2, 2), (1, "reset", 3, 3), (1, "claim", 4, 4), (1, "complete", 5, 2)]
    got = _state(spark, rows, timeout_hours=None, now=None)[1]
    assert got.status == "progress" and got.completed_at is None


def test_finished_cycles_are_cut(spark):
    """A task with thousands of finished cycles keeps a handful of events."""
    rows, seq = [], 0
    for i in range(400):
        for e in ("claim", "complete", "reset"):
            rows.append((1, e, i * 3 + seq % 3, seq))
            seq += 1
    rows += [(1, "claim", 5000, seq), (1, "failed", 5001, seq + 1)]
    kept = TK.state_events(_log(spark, rows)).count()
    assert kept <= 4
    got = _state(spark, rows, timeout_hours=None, now=None)[1]
    assert got.status == "failed" and pd.Timestamp(got.first_claim_at) == pd.Timestamp(T0)


def test_unit_report_and_reset_at_the_same_instant(spark):
    tasks = TK.replay_tasks(_log(spark, [(1, "claim", 0, 1), (1, "failed", 1, 2), (1, "reset", 2, 3)]), now=None)
    at = (T0 + dt.timedelta(hours=2))
    name = "d_ranking_url_202401_us"
    reports = spark.createDataFrame([(1, name, "complete", 5, 5, "", at, 4)],
                                    "task_id long, table_name string, status string, rows_local long, rows_lake long, "
                                    "error_msg string, ts timestamp_ntz, seq long")
    units = {r.table_name: r.status for r in TK.latest_units(reports, tasks).collect()}
    assert units[name] == "complete"


def test_liveness_from_text(spark):
    rows = spark.createDataFrame([("a", "2024-01-02 00:00:00"), ("b", "yesterday"), ("c", None), ("d", "2024-01-01 23:00:00")],
                                 "member string, last_seen string")
    got = {r.member: r.online for r in TK.liveness_of_text(rows, "2024-01-02 00:05:00").collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}


def test_overdue_and_head_of_backlog(spark):
    rows = [(1, "claim", 0, 1), (2, "claim", 40, 2)]
    t = TK.replay_tasks(_log(spark, rows), now=None)
    od = TK.overdue(t, "2024-01-03 00:00:01").collect()   # strictly before now - 48 h
    assert [r.task_id for r in od] == [1]
    tasks = spark.createDataFrame([(5, "202402", "a", "new"), (3, "202401", "a", "new"),
                                   (1, "202401", "a", "complete"), (4, "202401", "b", "new")],
                                  "task_id long, month string, server string, status string")
    head = {r.server: (r.month, r.task_id) for r in TK.head_of_backlog(tasks).collect()}
    assert head == {"a": ("202401", 3), "b": ("202401", 4)}
