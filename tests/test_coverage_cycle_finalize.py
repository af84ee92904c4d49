from pyspark.sql import functions as F

from lakeledger.operators import coverage as COV
from lakeledger.operators import finalize as FZ
from lakeledger.operators import tasks as TK


def test_coverage_gate_rules(spark):
    feeds = spark.createDataFrame([
        ("p1", "US_D"), ("p1", "US_M"), ("p1", "INTL_D"), ("p1", "INTL_M"), ("p1", "EXTRA"), ("p1", "US_D"),
        ("p2", "US_D"), ("p2", "us_m"), ("p2", "INTL_D"),
        ("p3", "OTHER"),
    ], "period string, code string")
    req = ["US_D", "US_M", "INTL_D", "INTL_M"]
    got = {r.period: r for r in COV.coverage(feeds, ["period"], "code", req).collect()}
    assert got["p1"].ready and got["p1"].n_missing == 0
    assert not got["p2"].ready and got["p2"].missing == "INTL_M,US_M"   # case sensitive
    assert got["p3"].n_missing == 4
    assert all(r.ready for r in COV.coverage(feeds, ["period"], "code", []).collect())


def test_readiness_feed_filter(spark):
    feed = spark.createDataFrame([(19, "202401", c) for c in ["US_D", "US_M", "INTL_D", "INTL_M"]]
                                 + [(18, "202402", "US_D")],
                                 "feed_type int, feed_month string, code string")
    assert COV.readiness(feed, "202401").first().ready
    # no rows of type 19 for that month: every code is missing
    got = COV.readiness(feed, "202402").first()
    assert not got.ready and got.n_missing == 4 and got.missing == "INTL_D,INTL_M,US_D,US_M"
    assert COV.readiness(feed, "202402", required=[]).first().ready


def _tasks(spark, rows):
    return spark.createDataFrame(rows, "month string, server string, status string")


def test_cycle_state_precedence(spark):
    full_done = [("m1", f"s{i}", "complete") for i in range(3)]
    rows = (full_done
            + [("m2", "s0", "progress"), ("m2", "s1", "new")]
            + [("m3", "s0", "new"), ("m3", "s1", "timeout")]
            + [("m4", "s0", "timeout"), ("m4", "s1", "failed")]      # short set: stalled
            + [("m5", "s0", "complete"), ("m5", "s1", "failed")]     # short set, only terminal: idle
            + [("m6", f"s{i}", "failed") for i in range(3)])
    fin = spark.createDataFrame([("m6",)], "month string")
    got = {r.month: r.cycle_state for r in TK.cycle_state(_tasks(spark, rows), "month", 3, fin).collect()}
    assert got == {"m1": "ready_for_finalize", "m2": "running", "m3": "dispatched",
                   "m4": "stalled", "m5": "idle", "m6": "finalized"}


def _units(spark, rows):
    return spark.createDataFrame(rows, "table_name string, month string, server string, n_local long, "
                                       "n_lake long, status string, error_msg string")


def _by_table(spark, rows):
    return spark.createDataFrame(rows, "table_name string, month string, n_local long, n_lake long, "
                                       "diff long, verdict string, lake_status string")


def test_finalize_branches_and_log(spark):
    tasks = _tasks(spark, [("m1", "a", "complete"), ("m1", "b", "complete"),
                           ("m2", "a", "complete"), ("m2", "b", "complete"),
                           ("m3", "a", "failed"), ("m3", "b", "timeout"),
                           ("m4", "a", "progress"), ("m4", "b", "complete"),
                           ("m5", "a", "complete")])
    units = _units(spark, [("t1", "m3", "a", 10, 9, "failed", "bad"), ("t2", "m3", "a", 5, None, "pending", "")])
    by_table = _by_table(spark, [("t1", "m1", 10, 10, 0, "OK", "OK"),
                                 ("t1", "m2", 10, 12, 2, "MISMATCH", "OK"),
                                 ("t2", "m2", 10, None, None, "ERROR", "NO_FILES")])
    final = {r.month: r for r in FZ.finalize(tasks, units, by_table, 2).collect()}
    assert final["m1"].status == "success"
    assert final["m2"].status == "mismatch"
    assert final["m3"].status == "partial_failure"
    kinds = [(d.kind, d.server, d.table) for d in final["m3"].details]
    assert kinds == [("server", "a", None), ("table", "a", "t1"), ("table", "a", "t2"), ("server", "b", None)]
    assert final["m3"].details[2].diff is None            # pending unit: no diff
    assert final["m4"].status == "not_all_done" and final["m4"].pending == ["a"]
    assert final["m5"].status == "not_all_created"

    log = FZ.log_records(FZ.finalize(tasks, units, by_table, 2), "2024-01-31 00:00:00")
    dec = {r.month: r for r in FZ.decode_log(log).collect()}
    assert set(dec) == {"m1", "m2", "m3"} and dec["m2"].details[1].lake_label == "NO_FILES"
    acked = {r.month: r.status for r in FZ.acknowledge(log, spark.createDataFrame(
        [("m1",), ("m2",)], "month string")).collect()}
    assert acked == {"m1": "success", "m2": "acknowledged", "m3": "partial_failure"}
    again = FZ.finalize(tasks, units, by_table, 2, finalized=log.select("month"))
    assert {r.month for r in again.collect()} == {"m4", "m5"}

    al = {r.month: r for r in FZ.alerts(FZ.finalize(tasks, units, by_table, 2)).collect()}
    assert al["m1"].level == "INFO" and al["m2"].level == "CRITICAL" and al["m3"].level == "WARNING"
    assert "1/2 tables have mismatches!" in al["m2"].message
    assert "Servers not completed: ['a (failed)', 'b (timeout)']" in al["m3"].message
    assert "  FAILED t1  local=10  parquet=9  diff=-1  bad" in al["m3"].message


def test_decode_corrupt_details(spark):
    log = spark.createDataFrame([("m1", "success", "not json"), ("m2", "success", ""),
                                 ("m3", "success", '[{"kind":"table","table":"t"}]')],
                                "month string, status string, details string")
    got = {r.month: r for r in FZ.decode_log(log).collect()}
    assert got["m1"].details == [] and got["m1"].details_error == "corrupt"
    assert got["m2"].details == [] and got["m2"].details_error is None
    assert got["m3"].details[0].table == "t"


def test_create_if_absent_is_null_safe(spark):
    plan = spark.createDataFrame([("m1", "a"), ("m1", "b"), ("m2", "a")], "month string, server string")
    existing = spark.createDataFrame([("m1",), (None,)], "month string")
    got = sorted(tuple(r) for r in TK.create_if_absent(plan, existing).collect())
    assert got == [("m2", "a")]   # NOT IN over a NULL would have hidden every month


def test_decode_flags_every_loss(spark):
    texts = ['[{"kind":"table","n_local":5}]', '{"a":1}', '[{"n_local":"abc"}]', "[1, 2]", "not json", "", None, "[]"]
    log = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "month string, details string")
    got = {r.month: (r.details_error, len(r.details)) for r in FZ.decode_log(log).collect()}
    assert got["0"] == (None, 1) and got["5"] == got["6"] == got["7"] == (None, 0)
    assert all(got[k] == ("corrupt", 0) for k in "1234")


def test_reset_voids_a_record(spark):
    tasks = spark.createDataFrame(
        [("m1", "a", "complete", "2024-01-03 00:00:00"), ("m2", "a", "complete", "2024-01-01 00:00:00")],
        "month string, server string, status string, r string").selectExpr(
        "month", "server", "status", "cast(r as timestamp_ntz) as last_reset_at")
    log = spark.createDataFrame([("m1", "2024-01-02 00:00:00"), ("m2", "2024-01-02 00:00:00")],
                                "month string, c string").selectExpr("month", "cast(c as timestamp_ntz) as created_at")
    assert [r.month for r in FZ.decide(tasks, 1, log).collect()] == ["m1"]
    states = {r.month: r.cycle_state for r in TK.cycle_state(tasks, "month", 1, log).collect()}
    assert states == {"m1": "ready_for_finalize", "m2": "finalized"}
