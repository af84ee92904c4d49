"""Registered finalize queries: the export world (tasks = (month, server),
units = tables) validated against the export-faulted lake and compared
against the drifted lake.  Imported by :mod:`lakeledger.plans.queries`."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from lakeledger.functions import catalog as C
from lakeledger.operators import export, reconcile
from lakeledger.operators import finalize as FZ
from lakeledger.operators import lifecycle as LC
from lakeledger.operators import tasks as TK
from lakeledger.plans import oracle as O
from lakeledger.plans import scenarios as S
from lakeledger.plans.queries import BOTH, register
from lakeledger.session import new_run_dir
from lakeledger.sources import lake

EXPECTED_TASKS = C.SHARD_COUNT
# Months before this one were finalized by an earlier run; the mismatch
# among them were acknowledged after review.
FINALIZED_BEFORE = "199601"
CREATED_AT = "2024-01-31 00:00:00"
VALIDATION_ERROR = "row count mismatch or count query failed"


def _world(spark, sf_dir):
    """Build both lakes; return (tasks, units, by_table, root)."""
    root_a, root_b = new_run_dir(spark, "lake"), new_run_dir(spark, "lake")

    def built(root: str):
        S.build_lake(spark, sf_dir, root, BOTH, export_fault=True, drift=root == root_b)
        return lake.lake_units(spark, root, BOTH)

    with ThreadPoolExecutor(2) as pool:  # the two lakes share the cluster
        held_a, held_b = pool.map(inheritable_thread_target(spark)(built), [root_a, root_b])
    local = _stage(spark, S.local_counts(spark, sf_dir, BOTH), root_a, "_local")
    units = (export.validate_units(local, held_a)
             .withColumn("error_msg", F.when(F.col("status") == "failed", F.lit(VALIDATION_ERROR))
                         .otherwise(F.lit(""))))
    units = _stage(spark, units, root_a, "_units")
    tasks = export.task_outcome(units)
    drift = reconcile.reconcile_units(local, held_b)
    by_table = _stage(spark, reconcile.reconcile_at(drift, ["table_name", "month"]), root_b, "_by_table")
    return tasks, units, by_table, root_a


def _stage(spark, df, root, name):
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _earlier_log(spark, tasks, units, by_table, root):
    """Finalize log of the earlier run (months before FINALIZED_BEFORE),
    written with the log sink and read back."""
    early = FZ.finalize(tasks.where(F.col("month") < FINALIZED_BEFORE), units, by_table, EXPECTED_TASKS)
    path = f"{root}/_finalize_log"
    FZ.log_records(early, CREATED_AT).write.mode("overwrite").parquet(path)
    log = FZ.decode_log(spark.read.parquet(path))
    acks = log.where(F.col("status") == "mismatch").select("month")
    return FZ.acknowledge(log, acks)


def _final_all(spark, sf_dir):
    tasks, units, by_table, root = _world(spark, sf_dir)
    earlier = _earlier_log(spark, tasks, units, by_table, root)
    now = FZ.finalize(tasks, units, by_table, EXPECTED_TASKS, finalized=earlier)
    return earlier, _stage(spark, now, root, "_final"), tasks


# ------------------------------------------------------------------ oracle SQL

def _units_sql() -> str:
    return (f"(SELECT table_name, month, server, n_local::BIGINT AS n_local, ({O.lake_a_sql()})::BIGINT AS n_lake, "
            f"CASE WHEN ({O.lake_a_sql()}) = n_local THEN 'complete' ELSE 'failed' END AS status, "
            f"CASE WHEN ({O.lake_a_sql()}) = n_local THEN '' ELSE '{VALIDATION_ERROR}' END AS error_msg "
            f"FROM ({O.all_units_sql(BOTH)}))")


def _tasks_sql() -> str:
    return (f"(SELECT month, server, CASE WHEN count(*) FILTER (WHERE status = 'failed') = 0 THEN 'complete' "
            f"ELSE 'failed' END AS status FROM {_units_sql()} GROUP BY month, server)")


def _by_table_sql() -> str:
    from lakeledger.plans.queries import _drift_units_sql
    return f"({O.reconcile_at_sql(_drift_units_sql(BOTH), ['table_name', 'month'])})"


def _decisions_sql() -> str:
    return (f"(SELECT month, count(*)::BIGINT AS n_tasks, "
            f"CASE WHEN count(*) <> {EXPECTED_TASKS} THEN 'not_all_created' "
            f"WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'partial_failure' "
            f"ELSE 'compare' END AS decision FROM {_tasks_sql()} GROUP BY month)")


def _details_sql() -> str:
    """One row per detail: kind, server, table, status, counts, label,
    diff, error_msg, plus the sort keys."""
    return f"""
(WITH d AS {_decisions_sql()},
 u AS {_units_sql()}, t AS {_tasks_sql()}, b AS {_by_table_sql()}
 SELECT d.month, 'server' AS kind, t.server, NULL::VARCHAR AS "table", t.status, NULL::BIGINT AS n_local,
        NULL::BIGINT AS n_lake, NULL::VARCHAR AS lake_label, NULL::BIGINT AS diff, NULL::VARCHAR AS error_msg,
        t.server AS k1, 0 AS k2, '' AS k3
 FROM d JOIN t USING (month) WHERE d.decision = 'partial_failure' AND t.status = 'failed'
 UNION ALL
 SELECT d.month, 'table', u.server, u.table_name, u.status, u.n_local, u.n_lake, NULL, (u.n_lake - u.n_local)::BIGINT,
        u.error_msg, u.server, 1, u.table_name
 FROM d JOIN t USING (month) JOIN u ON u.month = t.month AND u.server = t.server
 WHERE d.decision = 'partial_failure' AND t.status = 'failed'
 UNION ALL
 SELECT d.month, 'table', NULL, b.table_name, b.verdict, b.n_local, b.n_lake, b.lake_status, b.diff, NULL,
        '', 0, b.table_name
 FROM d JOIN b USING (month) WHERE d.decision = 'compare')"""


def _final_sql() -> str:
    return f"""
(WITH d AS {_decisions_sql()}, x AS {_details_sql()},
 c AS (SELECT month, bool_and(status = 'OK') AS all_ok FROM x WHERE kind = 'table' AND server IS NULL GROUP BY month)
 SELECT d.month, d.n_tasks,
        CASE WHEN d.decision = 'compare' THEN (CASE WHEN c.all_ok THEN 'success' ELSE 'mismatch' END)
             ELSE d.decision END AS status
 FROM d LEFT JOIN c USING (month))"""


def _final_with_log_sql() -> str:
    """Earlier months carry the acknowledged status."""
    return (f"(SELECT month, n_tasks, CASE WHEN month < '{FINALIZED_BEFORE}' AND status = 'mismatch' "
            f"THEN 'acknowledged' ELSE status END AS status, month < '{FINALIZED_BEFORE}' "
            f"AND status IN ('success', 'mismatch', 'partial_failure') AS from_log FROM {_final_sql()})")


# ------------------------------------------------------------------ queries

@register("finalize_log", f"""
WITH f AS {_final_with_log_sql()}, x AS {_details_sql()}
SELECT f.month, f.status, f.from_log,
       count(x.kind)::BIGINT AS n_details,
       count(x.kind) FILTER (WHERE x.kind = 'server')::BIGINT AS n_failed_servers
FROM f LEFT JOIN x USING (month)
GROUP BY f.month, f.status, f.from_log
""")
def finalize_log(spark, sf_dir):
    """Finalize decision per month: earlier-log months (read back from the
    log sink, mismatches acknowledged) plus every later month decided now."""
    earlier, now, _ = _final_all(spark, sf_dir)

    def shape(df, from_log):
        d = F.coalesce(F.col("details"), F.array())
        return df.select("month", "status", F.lit(from_log).alias("from_log"),
                         F.size(d).cast("long").alias("n_details"),
                         F.size(F.filter(d, lambda x: x["kind"] == "server")).cast("long").alias("n_failed_servers"))
    return shape(earlier, True).unionByName(shape(now, False))


@register("finalize_decoded", f"""
SELECT x.month, f.status, x.kind, x.server, x."table", x.status AS detail_status, x.n_local, x.n_lake,
       x.lake_label, x.diff, x.error_msg
FROM {_details_sql()} x JOIN {_final_sql()} f USING (month)
WHERE f.status IN ('success', 'mismatch', 'partial_failure')
""")
def finalize_decoded(spark, sf_dir):
    """Every finalize record of this run written as JSON text to the log
    sink, read back, decoded and exploded to one row per detail."""
    tasks, units, by_table, root = _world(spark, sf_dir)
    final = FZ.finalize(tasks, units, by_table, EXPECTED_TASKS)
    path = f"{root}/_finalize_log_all"
    FZ.log_records(final, CREATED_AT).write.mode("overwrite").parquet(path)
    log = FZ.decode_log(spark.read.parquet(path))
    x = log.select("month", "status", F.explode("details").alias("d"))
    return x.select("month", "status", x["d"]["kind"].alias("kind"), x["d"]["server"].alias("server"),
                    x["d"]["table"].alias("table"), x["d"]["status"].alias("detail_status"),
                    x["d"]["n_local"].alias("n_local"), x["d"]["n_lake"].alias("n_lake"),
                    x["d"]["lake_label"].alias("lake_label"), x["d"]["diff"].alias("diff"),
                    x["d"]["error_msg"].alias("error_msg"))


def _alert_message_sql() -> str:
    line_cmp = ("printf('  %-8s %s  local=%s  cloud=%s  diff=%s', x.status, x.\"table\", "
                "coalesce(CAST(x.n_local AS VARCHAR), 'ERROR'), coalesce(CAST(x.n_lake AS VARCHAR), x.lake_label), "
                "coalesce(CAST(x.diff AS VARCHAR), '-'))")
    line_fail = ("CASE WHEN x.kind = 'server' THEN printf('  %s (%s)', x.server, x.status) "
                 "ELSE rtrim(printf('  FAILED %s  local=%s  parquet=%s  diff=%s  %s', x.\"table\", "
                 "coalesce(CAST(x.n_local AS VARCHAR), '-'), coalesce(CAST(x.n_lake AS VARCHAR), '-'), "
                 "coalesce(CAST(x.diff AS VARCHAR), '-'), x.error_msg)) END")
    return f"""
(WITH f AS {_final_sql()}, x AS {_details_sql()},
 agg AS (SELECT f.month, f.status, f.n_tasks,
                count(*) FILTER (WHERE x.kind = 'table') AS n_tables,
                count(*) FILTER (WHERE x.kind = 'table' AND x.status = 'MISMATCH') AS n_mismatch,
                string_agg(printf('''%s (%s)''', x.server, x.status), ', ' ORDER BY x.k1, x.k2, x.k3)
                  FILTER (WHERE x.kind = 'server') AS names,
                string_agg(CASE WHEN f.status = 'partial_failure' THEN
                             (CASE WHEN x.kind = 'server' OR x.status = 'failed' THEN {line_fail} END)
                           ELSE {line_cmp} END, chr(10) ORDER BY x.k1, x.k2, x.k3) AS body
         FROM f JOIN x USING (month)
         WHERE f.status IN ('success', 'mismatch', 'partial_failure')
         GROUP BY f.month, f.status, f.n_tasks)
 SELECT month, status,
        CASE status WHEN 'success' THEN '{FZ.TITLE_SUCCESS}' WHEN 'mismatch' THEN '{FZ.TITLE_MISMATCH}'
                    ELSE '{FZ.TITLE_PARTIAL}' END AS title,
        CASE status WHEN 'success' THEN 'INFO' WHEN 'mismatch' THEN 'CRITICAL' ELSE 'WARNING' END AS level,
        CASE status WHEN 'success' THEN printf('Month: %s' || chr(10) || 'All %d servers finished. %d tables validated OK.', month, n_tasks, n_tables)
                    WHEN 'mismatch' THEN printf('Month: %s' || chr(10) || '%d/%d tables have mismatches!', month, n_mismatch, n_tables)
                    ELSE printf('Month: %s' || chr(10) || 'Servers not completed: [%s]', month, names) END
          || CASE WHEN body IS NULL THEN '' ELSE chr(10) || body END AS message
 FROM agg)"""


@register("alerts", f"""
SELECT month, title, level, message, '{C.ALERT_SOURCE}' AS source, '{C.ALERT_CHANNEL}' AS channel
FROM {_alert_message_sql()}
""")
def alerts(spark, sf_dir):
    """One alert per finalized month: INFO / CRITICAL / WARNING with the
    per-table report or the failed servers and units."""
    tasks, units, by_table, root = _world(spark, sf_dir)
    final = FZ.finalize(tasks, units, by_table, EXPECTED_TASKS)
    rows = FZ.alerts(final).select("month", "title", "level", "message", "source", "channel", "tags")
    path = f"{root}/_alerts"
    FZ.write_alerts(rows, path)   # alert sink, read back as delivered
    return spark.read.schema(rows.schema).json(path).select("month", "title", "level", "message",
                                                            "source", "channel")


@register("cycle_state", f"""
WITH t AS {_tasks_sql()},
fin AS (SELECT month FROM {_final_sql()} WHERE month < '{FINALIZED_BEFORE}'
        AND status IN ('success', 'mismatch', 'partial_failure')),
g AS (SELECT month, count(*)::BIGINT AS n_tasks,
             string_agg(server, ',' ORDER BY server) FILTER (WHERE status = 'failed') AS failed
      FROM t GROUP BY month)
SELECT g.month, g.n_tasks, g.n_tasks = {EXPECTED_TASKS} AS complete_set,
       CASE WHEN g.n_tasks = {EXPECTED_TASKS} AND fin.month IS NOT NULL THEN 'finalized'
            WHEN g.n_tasks = {EXPECTED_TASKS} THEN 'ready_for_finalize' ELSE 'idle' END AS cycle_state,
       coalesce(g.failed, '') AS failed_servers
FROM g LEFT JOIN fin USING (month)
""")
def cycle_state(spark, sf_dir):
    """Cycle state per month of the export world; the earlier finalize log
    marks its months finalized (distinct months minus the log, by anti join)."""
    tasks, units, by_table, root = _world(spark, sf_dir)
    earlier = _earlier_log(spark, tasks, units, by_table, root)
    cs = TK.cycle_state(tasks, "month", EXPECTED_TASKS, finalized=earlier.select("month"))
    return cs.select("month", "n_tasks", "complete_set", "cycle_state",
                     F.array_join("failed", ",").alias("failed_servers"))


@register("finalize_clean", f"""
WITH t AS ({O.reconcile_at_sql(f"(SELECT *, n_local AS n_lake FROM ({O.all_units_sql(['orders'])}))",
                               ['table_name', 'month'])}),
l AS (SELECT *, {O.report_line_sql()} AS line FROM t)
SELECT month, CASE WHEN n_units = {EXPECTED_TASKS} THEN 'success' ELSE 'not_all_created' END AS status,
       CASE WHEN n_units = {EXPECTED_TASKS} THEN 'INFO' END AS level,
       CASE WHEN n_units = {EXPECTED_TASKS} THEN '{FZ.TITLE_SUCCESS}' END AS title,
       CASE WHEN n_units = {EXPECTED_TASKS} THEN '{",".join(FZ.TAGS["success"])}' END AS tags,
       CASE WHEN n_units = {EXPECTED_TASKS} THEN 'Month: ' || month || chr(10) || 'All ' || n_units
            || ' servers finished. 1 tables validated OK.' || chr(10) || line END AS message
FROM l
""")
def finalize_clean(spark, sf_dir):
    """A clean export of orders: months with all shards finalize as success,
    with their INFO alert in full."""
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, ["orders"])
    local = S.local_counts(spark, sf_dir, ["orders"])
    held = lake.lake_units(spark, root, ["orders"])
    units = _stage(spark, export.validate_units(local, held).withColumn("error_msg", F.lit("")), root, "_units")
    by_table = reconcile.reconcile_at(reconcile.reconcile_units(local, held), ["table_name", "month"])
    final = _stage(spark, FZ.finalize(export.task_outcome(units), units, by_table, EXPECTED_TASKS), root, "_final")
    told = FZ.alerts(final).select("month", "level", "title", F.array_join("tags", ",").alias("tags"), "message")
    return final.select("month", "status").join(told, "month", "left")


# ------------------------------------------------------------------ record log and lifecycle

#: a record whose text was damaged, as the log may hold it
DAMAGED = ("000000", "mismatch", '[{"kind":"table","n_lo')


def _tags_sql() -> str:
    return "CASE status " + " ".join(f"WHEN '{k}' THEN '{','.join(FZ.TAGS[k])}'"
                                     for k in ("success", "mismatch", "partial_failure")) + " END"


@register("finalize_append", f"""
WITH n AS (SELECT month, count(*)::BIGINT AS n FROM {_details_sql()} GROUP BY month)
SELECT a.month, 1::BIGINT AS n_records, 1::BIGINT AS n_alerts, a.status, coalesce(n.n, 0)::BIGINT AS n_details,
       NULL::VARCHAR AS details_error, a.level, {_tags_sql()} AS tags, a.message,
       CASE WHEN a.month < '{FINALIZED_BEFORE}' THEN 'r1' ELSE 'r2' END AS run
FROM {_alert_message_sql()} a LEFT JOIN n USING (month)
UNION ALL
SELECT '{DAMAGED[0]}', 1, 1, '{DAMAGED[1]}', 0, 'corrupt', 'CRITICAL', '{",".join(FZ.TAGS["mismatch"])}',
       'Month: {DAMAGED[0]}' || chr(10) || '0/0 tables have mismatches!' || chr(10), 'r0'
""")
def finalize_append(spark, sf_dir):
    """The append log after runs that overlap and repeat: one record and one
    alert a month, read back and decoded; a damaged record is flagged."""
    tasks, units, by_table, root = _world(spark, sf_dir)
    final = _stage(spark, FZ.finalize(tasks, units, by_table, EXPECTED_TASKS), root, "_final")
    log_dir = f"{root}/_log"
    spark.createDataFrame([(*DAMAGED, 0)], "month string, status string, details string, n_tasks long").withColumn(
        "created_at", F.lit(CREATED_AT).cast("timestamp_ntz")).write.parquet(f"{log_dir}/records/run=r0")
    early = final.where(F.col("month") < FINALIZED_BEFORE)
    for run, rows in (("r1", early), ("r1", early), ("r2", final), ("r2", final), ("r3", final)):
        LC.append_records(rows, tasks, log_dir, run, CREATED_AT)
        LC.append_alerts(spark, log_dir, run)
    records = LC.read_records(spark, log_dir)
    last = FZ.decode_log(LC.latest_records(records))
    n = records.groupBy("month").agg(F.count(F.lit(1)).alias("n_records"))
    told = LC.read_alerts(spark, log_dir).groupBy("month").agg(
        F.count(F.lit(1)).alias("n_alerts"), F.first("level").alias("level"),
        F.first(F.array_join("tags", ",")).alias("tags"), F.first("message").alias("message"))
    return (last.join(n, "month").join(told, "month", "left")
            .select("month", "n_records", "n_alerts", "status", F.size("details").cast("long").alias("n_details"),
                    "details_error", "level", "tags", "message", "run"))


#: events as life of a period's record: purchase and error make records, views
#: acknowledge, clicks reset; the period is the member
_LIFE = {"purchase": "record", "error": "record", "view": "acknowledge", "click": "reset"}


def _life_sql() -> str:
    step = ("struct_pack(st := CASE WHEN e.ev = 'reset' THEN NULL WHEN e.ev = 'record' AND acc.st IS NULL THEN e.status "
            "WHEN e.ev = 'acknowledge' AND acc.st = 'mismatch' THEN 'acknowledged' ELSE acc.st END, "
            "made := CASE WHEN e.ev = 'reset' THEN NULL WHEN e.ev = 'record' AND acc.st IS NULL THEN e.ts ELSE acc.made END, "
            "acked := CASE WHEN e.ev = 'reset' THEN NULL WHEN e.ev = 'acknowledge' AND acc.st = 'mismatch' THEN e.ts "
            "ELSE acc.acked END)")
    zero = "struct_pack(st := NULL::VARCHAR, made := NULL::TIMESTAMP, acked := NULL::TIMESTAMP)"
    kind = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _LIFE.items()) + " END"
    return f"""
(WITH ev AS (SELECT user_id, ts, event_id, {kind} AS ev, CASE WHEN event_type = 'error' THEN 'partial_failure'
                    WHEN value < 60 THEN 'mismatch' ELSE 'success' END AS status
             FROM events WHERE {kind} IS NOT NULL),
 l AS (SELECT user_id, count(*) FILTER (WHERE ev = 'record') AS n_records, count(*) FILTER (WHERE ev = 'reset') AS n_resets,
              list(struct_pack(ts := ts, ev := ev, status := status) ORDER BY ts, event_id) AS evs FROM ev GROUP BY user_id)
 SELECT CAST(user_id AS VARCHAR) AS month, n_records, n_resets, list_reduce(evs, lambda acc, e: {step}, {zero}) AS s FROM l)"""


@register("finalize_lifecycle", f"""
SELECT month, s.st AS status, strftime(s.made, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
       strftime(s.acked, '%Y-%m-%d %H:%M:%S.%f') AS acknowledged_at, n_records::BIGINT AS n_records, n_resets::BIGINT AS n_resets
FROM {_life_sql()}
""")
def finalize_lifecycle(spark, sf_dir):
    """Records, acknowledgements and resets of each period as an ordered fold:
    acknowledgements before a record or behind a reset change nothing, a period
    is finalized again after a reset."""
    ev = S.read_source(spark, sf_dir, "events")
    kind = F.coalesce(*[F.when(F.col("event_type") == a, b) for a, b in _LIFE.items()])
    status = (F.when(F.col("event_type") == "error", "partial_failure").when(F.col("value") < 60, "mismatch")
              .otherwise("success"))
    events = ev.select(F.col("user_id").cast("string").alias("month"), kind.alias("event"), status.alias("status"),
                       F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("event_id").alias("seq")).where("event is not null")
    txt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return LC.live_record(events).select("month", "status", txt("created_at"), txt("acknowledged_at"), "n_records", "n_resets")
