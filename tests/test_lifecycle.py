"""Record lifecycle: ordered fold, append log, acknowledgements in time."""

import random

from pyspark.sql import functions as F

from lakeledger.operators import finalize as FZ
from lakeledger.operators import lifecycle as LC

EVENTS = "month string, event string, status string, h int, seq long"


def events_of(spark, rows):
    return spark.createDataFrame(rows, EVENTS).withColumn(
        "ts", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, h)")).drop("h")


def brute(rows):
    out = {}
    for m, e, st, h, _ in sorted(rows, key=lambda r: (r[3], r[4])):
        live = out.setdefault(m, [None, None, None])
        if e == "reset":
            out[m] = [None, None, None]
        elif e == "record" and live[0] is None:
            out[m] = [st, h, None]
        elif e == "acknowledge" and live[0] == "mismatch":
            out[m] = ["acknowledged", live[1], h]
    return {m: tuple(x) for m, x in out.items()}


def folded(spark, rows):
    hour = lambda c: F.expr(f"cast(timestampdiff(HOUR, timestamp_ntz '2024-01-01 00:00:00', {c}) as int)")
    got = LC.live_record(events_of(spark, rows)).select("month", "status", hour("created_at"), hour("acknowledged_at"))
    return {r[0]: (r[1], r[2], r[3]) for r in got.collect()}


def test_order_rules(spark):
    rows = [("a", "acknowledge", None, 1, 1), ("a", "record", "mismatch", 2, 2),           # before the record
            ("b", "record", "mismatch", 1, 1), ("b", "reset", None, 2, 2), ("b", "acknowledge", None, 3, 3),
            ("c", "record", "mismatch", 1, 1), ("c", "reset", None, 2, 2), ("c", "record", "success", 3, 3),
            ("d", "record", "mismatch", 1, 1), ("d", "record", "success", 2, 2), ("d", "acknowledge", None, 3, 3),
            ("e", "record", "success", 1, 1), ("e", "acknowledge", None, 2, 2),
            ("f", "record", "mismatch", 1, 1), ("f", "acknowledge", None, 1, 2), ("f", "reset", None, 1, 3),
            ("g", "reset", None, 1, 1), (None, "record", "mismatch", 1, 1), (None, "acknowledge", None, 2, 2)]
    got = folded(spark, rows)
    assert got == brute(rows)
    assert got["a"] == ("mismatch", 2, None) and got["c"] == ("success", 3, None) and got["d"] == ("acknowledged", 1, 3)


def test_random_lives(spark):
    rng = random.Random(6)
    rows = [(f"m{rng.randrange(12)}", rng.choice(["record", "record", "acknowledge", "acknowledge", "reset"]),
             rng.choice(["mismatch", "success", "partial_failure"]), rng.randrange(40), i) for i in range(600)]
    assert folded(spark, rows) == brute(rows)
    assert LC.live_record(events_of(spark, rows).where("month = 'x'")).count() == 0


def test_acknowledgements_need_a_record_before_them(spark):
    log = spark.sql("""SELECT * FROM VALUES ('m1', 'mismatch', timestamp_ntz '2024-03-01 00:00:00'),
                       ('m2', 'mismatch', timestamp_ntz '2024-03-01 00:00:00') AS t(month, status, created_at)""")
    acks = spark.sql("""SELECT * FROM VALUES ('m1', timestamp_ntz '2024-02-01 00:00:00'),
                        ('m2', timestamp_ntz '2024-02-01 00:00:00'), ('m2', timestamp_ntz '2024-03-02 00:00:00') AS t(month, acked_at)""")
    assert {r.month: r.status for r in FZ.acknowledge(log, acks).collect()} == {"m1": "mismatch", "m2": "acknowledged"}


def test_append_after_a_reset_and_after_a_lost_alert(spark, tmp_path):
    log_dir = str(tmp_path)
    tasks = spark.sql("""SELECT * FROM VALUES ('m1', 's1', 'complete', timestamp_ntz '2024-01-05 00:00:00'),
                         ('m2', 's1', 'complete', CAST(NULL AS timestamp_ntz)) AS t(month, server, status, last_reset_at)""")
    final = spark.createDataFrame([("m1", "success", 1), ("m2", "mismatch", 1), ("m3", "not_all_done", 1)],
                                  "month string, status string, n_tasks long").withColumn("details", F.array().cast(FZ.DETAILS))
    early = tasks.withColumn("last_reset_at", F.lit(None).cast("timestamp_ntz"))
    LC.append_records(final, early, log_dir, "a", "2024-01-03 00:00:00")  # its alerts are lost
    LC.append_records(final, tasks, log_dir, "b", "2024-01-06 00:00:00")  # m1 was reset meanwhile
    LC.append_alerts(spark, log_dir, "b")
    LC.append_alerts(spark, log_dir, "b")
    LC.append_records(final, tasks, log_dir, "c", "2024-01-07 00:00:00")
    LC.append_alerts(spark, log_dir, "c")
    records = LC.read_records(spark, log_dir)
    assert sorted((r.month, r.run) for r in records.collect()) == [("m1", "a"), ("m1", "b"), ("m2", "a")]
    assert {(r.month, r.run) for r in LC.latest_records(records).collect()} == {("m1", "b"), ("m2", "a")}
    told = sorted((r.month, r.level) for r in LC.read_alerts(spark, log_dir).collect())
    assert told == [("m1", "INFO"), ("m1", "INFO"), ("m2", "CRITICAL")]
