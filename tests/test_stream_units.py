"""The merge of unit reports by batch id."""

import random

from lakeledger.streaming import units_stream as US

SCHEMA = US.REPORT + ", server string, reject_reason string, report_id long"


def batch_of(spark, rows):
    return spark.createDataFrame(rows, "task_id long, table_name string, status string, seq long, reject_reason string").selectExpr(
        "task_id", "table_name", "status", "seq as rows_local", "seq as rows_lake", "'' as error_msg",
        "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, seq div 3) as ts", "seq",
        "'s' as server", "reject_reason", "seq as report_id")


def test_repeated_batches_and_snapshots_leave_the_same_table(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(5), f"t{rng.randrange(4)}", rng.choice(["complete", "failed"]), i, rng.choice([None, None, "bad"]))
            for i in range(90)]
    rng.shuffle(rows)
    want = {}
    for t, n, st, seq, bad in rows:
        if bad is None and seq > want.get((t, n), ("", -1))[1]:
            want[t, n] = st, seq
    tables = []
    for every, twice in ((100, False), (2, False), (3, True)):
        out = str(tmp_path / f"{every}")
        for kind in ("snapshot", "delta", "rejected"):
            (tmp_path / f"{every}" / kind).mkdir(parents=True)
        for i in range(9):
            for _ in range(2 if twice and i in (2, 5, 7) else 1):
                US.merge_batch(batch_of(spark, rows[i * 10:i * 10 + 10]), i, out, every)
        tables.append({(r.task_id, r.table_name): (r.status, r.seq) for r in US.current_reports(spark, out).collect()})
        assert US.rejected_reports(spark, out).count() == sum(r[4] is not None for r in rows)
    assert tables == [want] * 3


def test_a_reader_opens_the_last_snapshot_and_what_follows(spark, tmp_path):
    out = str(tmp_path)
    for kind in ("snapshot", "delta", "rejected"):
        (tmp_path / kind).mkdir()
    for i in range(5):
        US.merge_batch(batch_of(spark, [(i, "t", "complete", i, None)]), i, out, 2)
    plan = US.current_reports(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
