"""Finalize: decide each period once all its tasks are done, record the
result with typed details, and derive alerts.

Decision per period (periods already in the finalize log are skipped):

* not exactly ``expected`` tasks -> ``not_all_created`` (no record);
* a task not terminal -> ``not_all_done`` (no record, pending servers);
* any failed or timed-out task -> ``partial_failure``: details are the
  failed servers, each followed by its unit rows (comparison is not run);
* otherwise the lake comparison: ``success`` when every table is OK,
  else ``mismatch`` (errors included) which may later be acknowledged.

Details are ``array<struct>`` with the superset of both shapes; the log
sink stores them as JSON text and :func:`decode_log` reads them back,
turning unreadable text into an empty array plus a ``corrupt`` flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions import catalog as C
from lakeledger.operators import reconcile
from lakeledger.operators.tasks import live_records

DETAIL = T.StructType([
    T.StructField("kind", T.StringType()),        # server | table
    T.StructField("server", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_local", T.LongType()),
    T.StructField("n_lake", T.LongType()),
    T.StructField("lake_label", T.StringType()),
    T.StructField("diff", T.LongType()),
    T.StructField("error_msg", T.StringType()),
])
DETAILS = T.ArrayType(DETAIL)

# Fixed alert texts and tags.
TITLE_SUCCESS = "Parquet export & validation completed"
TITLE_MISMATCH = "Parquet validation MISMATCH"
TITLE_PARTIAL = "Parquet export completed with failures"
TITLE_TIMEOUT = "Parquet export task TIMEOUT"
TAGS = {
    "success": ["parquet", "export", "validation", "success"],
    "mismatch": ["parquet", "export", "validation", "failure", "p0"],
    "partial_failure": ["parquet", "export", "partial-failure"],
    "timeout": ["parquet", "export", "timeout"],
}


def _detail(kind, server, table, status, n_local, n_lake, lake_label, diff, error_msg) -> Column:
    vals = [kind, server, table, status, n_local, n_lake, lake_label, diff, error_msg]
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast(f.dataType).alias(f.name)
                      for v, f in zip(vals, DETAIL.fields)])


def decide(tasks: DataFrame, expected: int, finalized: DataFrame | None = None,
           period: str = "month") -> DataFrame:
    """Per period not yet finalized: decision and the failed servers."""
    g = tasks.groupBy(period).agg(
        F.count(F.lit(1)).cast("long").alias("n_tasks"),
        F.count_if(~F.col("status").isin(C.TERMINAL_TASK_STATUSES)).cast("long").alias("n_not_done"),
        F.count_if(F.col("status").isin("failed", "timeout")).cast("long").alias("n_failed"))
    if finalized is not None:  # records that a later reset made void do not count
        g = g.join(live_records(finalized, tasks, period).select(period).distinct(), period, "left_anti")
    decision = (F.when(F.col("n_tasks") != expected, "not_all_created")
                 .when(F.col("n_not_done") > 0, "not_all_done")
                 .when(F.col("n_failed") > 0, "partial_failure")
                 .otherwise("compare"))
    return g.withColumn("decision", decision)


def failure_details(decisions: DataFrame, tasks: DataFrame, units: DataFrame,
                    period: str = "month") -> DataFrame:
    """Failed servers and their unit rows, one array per period, ordered by
    (server, header first, table).  Bounded by servers x tables."""
    failed = (decisions.where(F.col("decision") == "partial_failure").select(period)
              .join(tasks.where(F.col("status").isin("failed", "timeout")), period))
    head = failed.select(period, F.col("server").alias("_s"), F.lit(0).alias("_r"), F.lit("").alias("_t"),
                         _detail("server", F.col("server"), None, F.col("status"), None, None, None, None,
                                 None).alias("d"))
    rows = (failed.select(period, "server")
            .join(units, [period, "server"], "left")
            .where(F.col("table_name").isNotNull())
            .select(period, F.col("server").alias("_s"), F.lit(1).alias("_r"), F.col("table_name").alias("_t"),
                    _detail("table", F.col("server"), F.col("table_name"), F.col("status"),
                            F.col("n_local"), F.col("n_lake"), None,
                            reconcile.diff_col(F.col("n_local"), F.col("n_lake")),
                            F.coalesce(F.col("error_msg"), F.lit(""))).alias("d")))
    both = head.unionByName(rows)
    return both.groupBy(period).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_s", "_r", "_t", "d"))), lambda x: x["d"])
         .alias("details"))


def compare_details(decisions: DataFrame, by_table: DataFrame, period: str = "month") -> DataFrame:
    """Comparison rows for periods whose tasks all completed."""
    todo = decisions.where(F.col("decision") == "compare").select(period)
    rows = todo.join(by_table, period).select(
        period, "verdict", F.col("table_name").alias("_t"),
        _detail("table", None, F.col("table_name"), F.col("verdict"), F.col("n_local"), F.col("n_lake"),
                F.col("lake_status"), F.col("diff"), None).alias("d"))
    return rows.groupBy(period).agg(
        F.bool_and(F.col("verdict") == "OK").alias("all_ok"),
        F.transform(F.array_sort(F.collect_list(F.struct("_t", "d"))), lambda x: x["d"]).alias("details"))


def finalize(tasks: DataFrame, units: DataFrame, by_table: DataFrame, expected: int,
             finalized: DataFrame | None = None, period: str = "month") -> DataFrame:
    """Finalize records for every period that can be decided now.

    Output: period, status, n_tasks, details (array<struct>), pending
    servers for ``not_all_done``.  Only success / mismatch /
    partial_failure rows are written to the log (:func:`log_records`).
    """
    dec = decide(tasks, expected, finalized, period)
    fails = failure_details(dec, tasks, units, period)
    comp = compare_details(dec, by_table, period)
    pending = (tasks.where(~F.col("status").isin(C.TERMINAL_TASK_STATUSES))
               .groupBy(period).agg(F.array_sort(F.collect_list("server")).alias("pending")))
    out = (dec.join(fails, period, "left")
              .join(comp.withColumnRenamed("details", "_cd"), period, "left")
              .join(pending, period, "left"))
    status = (F.when(F.col("decision") == "compare",
                     F.when(F.col("all_ok"), F.lit("success")).otherwise(F.lit("mismatch")))
               .otherwise(F.col("decision")))
    details = F.coalesce(F.col("details"), F.col("_cd"), F.array().cast(DETAILS))
    return out.select(period, status.alias("status"), "n_tasks", details.alias("details"),
                      F.coalesce("pending", F.array().cast("array<string>")).alias("pending"))


def log_records(final: DataFrame, created_at: str, period: str = "month") -> DataFrame:
    """Rows for the finalize log: details as JSON text."""
    return (final.where(F.col("status").isin("success", "mismatch", "partial_failure"))
            .select(period, "status", F.to_json("details").alias("details"),
                    F.lit(created_at).cast("timestamp_ntz").alias("created_at")))


def decode_log(log: DataFrame) -> DataFrame:
    """Parse the details text.  Text that is not a JSON array of objects, or
    holds a value that its field's type cannot take, becomes an empty array
    with ``details_error = 'corrupt'``; no value is lost without a flag."""
    parsed = F.from_json(F.col("details"), DETAILS)
    texts = F.from_json(F.col("details"), "array<map<string,string>>")
    lost = F.exists(F.arrays_zip(parsed.alias("p"), texts.alias("t")), lambda x: F.lit(False) | _any_lost(x))
    some = F.coalesce(F.col("details"), F.lit("")).rlike(r"\S")
    bad = some & (~F.coalesce(F.col("details").rlike(r"^\s*\["), F.lit(False)) | parsed.isNull() | texts.isNull()
                  | F.coalesce(F.size(parsed) != F.size(texts), F.lit(True)) | F.coalesce(lost, F.lit(True)))
    return log.select(*[c for c in log.columns if c != "details"],
                      F.when(bad, F.array().cast(DETAILS)).otherwise(F.coalesce(parsed, F.array().cast(DETAILS)))
                      .alias("details"),
                      F.when(bad, F.lit("corrupt")).alias("details_error"))


def _any_lost(pair: Column) -> Column:
    """An array element (as struct and as texts) of which a value did not
    survive, or that is no object."""
    lost = pair["p"].isNull() | pair["t"].isNull()
    for f in DETAIL.fields:
        text = F.try_element_at(pair["t"], F.lit(f.name))
        lost = lost | (text.isNotNull() & pair["p"][f.name].isNull())
    return lost


def acknowledge(log: DataFrame, acks: DataFrame, period: str = "month") -> DataFrame:
    """Apply acknowledgements: only a ``mismatch`` record becomes
    ``acknowledged``; its details are kept.  With ``acked_at`` in ``acks`` only
    one that is not earlier than the record counts."""
    timed = "acked_at" in acks.columns
    hit = acks.groupBy(F.col(period).alias("_p")).agg(F.max("acked_at" if timed else F.lit(True)).alias("_ack"))
    j = log.join(hit, F.col(period) == F.col("_p"), "left")
    ok = F.col("_ack") >= F.col("created_at") if timed else F.col("_ack")
    return j.select(*[c for c in log.columns if c != "status"],
                    F.when(ok & (F.col("status") == "mismatch"), F.lit("acknowledged"))
                     .otherwise(F.col("status")).alias("status"))


def _num(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("-"))


def alerts(final: DataFrame, period: str = "month", source: str = C.ALERT_SOURCE,
           channel: str = C.ALERT_CHANNEL, extra: list[str] | None = None) -> DataFrame:
    """One alert per finalized period: INFO / CRITICAL / WARNING; ``extra``
    columns of ``final`` are kept."""
    rec = final.where(F.col("status").isin("success", "mismatch", "partial_failure"))
    d = F.col("details")
    table_rows = F.filter(d, lambda x: x["kind"] == "table")
    compare_lines = F.transform(table_rows, lambda x: reconcile.report_line(
        x["status"], x["table"], x["n_local"], x["n_lake"], x["lake_label"]))
    failure_lines = F.transform(
        F.filter(d, lambda x: (x["kind"] == "server") | (x["status"] == "failed")),
        lambda x: F.when(x["kind"] == "server", F.format_string("  %s (%s)", x["server"], x["status"]))
                   .otherwise(F.rtrim(F.format_string("  FAILED %s  local=%s  parquet=%s  diff=%s  %s",
                                                      x["table"], _num(x["n_local"]), _num(x["n_lake"]),
                                                      _num(x["diff"]), x["error_msg"]))))
    names = F.transform(F.filter(d, lambda x: x["kind"] == "server"),
                        lambda x: F.format_string("'%s (%s)'", x["server"], x["status"]))
    n_tables = F.size(table_rows)
    n_mismatch = F.size(F.filter(table_rows, lambda x: x["status"] == "MISMATCH"))
    st = F.col("status")
    title = (F.when(st == "success", TITLE_SUCCESS).when(st == "mismatch", TITLE_MISMATCH)
              .otherwise(TITLE_PARTIAL))
    level = F.when(st == "success", "INFO").when(st == "mismatch", "CRITICAL").otherwise("WARNING")
    tags = (F.when(st == "success", F.array(*map(F.lit, TAGS["success"])))
             .when(st == "mismatch", F.array(*map(F.lit, TAGS["mismatch"])))
             .otherwise(F.array(*map(F.lit, TAGS["partial_failure"]))))
    head = (F.when(st == "success", F.format_string("Month: %s\nAll %d servers finished. %d tables validated OK.",
                                                   F.col(period), F.col("n_tasks"), n_tables))
             .when(st == "mismatch", F.format_string("Month: %s\n%d/%d tables have mismatches!",
                                                     F.col(period), n_mismatch, n_tables))
             .otherwise(F.format_string("Month: %s\nServers not completed: [%s]", F.col(period),
                                        F.array_join(names, ", "))))
    body = F.array_join(F.when(st == "partial_failure", failure_lines).otherwise(compare_lines), "\n")
    return rec.select(period, title.alias("title"),
                      F.concat_ws("\n", head, body).alias("message"),
                      level.alias("level"), F.lit(source).alias("source"), tags.alias("tags"),
                      F.lit(channel).alias("channel"), *(extra or []))


def write_alerts(alert_rows: DataFrame, path: str) -> None:
    """Alert sink: append alert records as JSON documents (one per line).
    In a stream, call it from ``foreachBatch``; delivery to an alerting
    endpoint is outside this library."""
    alert_rows.write.mode("append").json(path)


def timeout_alerts(overdue_tasks: DataFrame, timeout_hours: int = C.TASK_TIMEOUT_HOURS,
                   source: str = C.ALERT_SOURCE, channel: str = C.ALERT_CHANNEL) -> DataFrame:
    """One WARNING per task newly timed out."""
    started = F.date_format("started_at", "yyyy-MM-dd HH:mm:ss")
    msg = F.format_string("Server: %s\nMonth: %s\nStarted: %s\nExceeded %dh. Task marked as 'timeout'.\n"
                          "Reset task %d to retry.", F.col("server"), F.col("month"), started,
                          F.lit(timeout_hours), F.col("task_id"))
    return overdue_tasks.select(
        "task_id", "server", "month",
        F.concat(F.lit("Auto-timeout: started at "), started).alias("error_msg"),
        F.lit(TITLE_TIMEOUT).alias("title"), msg.alias("message"), F.lit("WARNING").alias("level"),
        F.lit(source).alias("source"), F.array(*map(F.lit, TAGS["timeout"])).alias("tags"),
        F.lit(channel).alias("channel"))
