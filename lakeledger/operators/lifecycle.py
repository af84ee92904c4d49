"""Life of a finalize record: append-only log, and the record that holds now.

* :func:`append_records`, :func:`append_alerts` - sinks that are safe to repeat:
  a run writes a folder of its own (its id is the key), which a repeat of the
  run overwrites, and only what no other run has written.
* :func:`read_records`, :func:`latest_records` - the log as written, and the last
  record of each period.
* :func:`live_record` - records, acknowledgements and resets as events of a
  period in (ts, seq) order, folded to at most one live record.  A record is
  taken if none is live, an acknowledgement turns a live ``mismatch`` into
  ``acknowledged``, a reset makes the live record void.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.operators import finalize as FZ
from lakeledger.operators.tasks import live_records

RECORD = "status string, details string, created_at timestamp_ntz, n_tasks long, run string"
ALERT = ("title string, message string, level string, source string, tags array<string>, channel string, "
         "created_at timestamp_ntz, run string")


def _folder(spark: SparkSession, path: str) -> str:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def read_records(spark: SparkSession, log_dir: str, period: str = "month") -> DataFrame:
    """All records of all runs: period, status, details (text), created_at, n_tasks, run."""
    return spark.read.schema(f"{period} string, {RECORD}").parquet(_folder(spark, f"{log_dir}/records"))


def read_alerts(spark: SparkSession, log_dir: str, period: str = "month") -> DataFrame:
    """All alert documents of all runs, with the created_at of their record."""
    return spark.read.schema(f"{period} string, {ALERT}").json(_folder(spark, f"{log_dir}/alerts"))


def latest_records(records: DataFrame, period: str = "month") -> DataFrame:
    """The last record of each period (by creation time, then run)."""
    rest = [c for c in records.columns if c != period]
    last = F.max_by(F.struct(*rest), F.struct("created_at", "run")).alias("r")
    return records.groupBy(period).agg(last).select(period, "r.*")


def append_records(final: DataFrame, tasks: DataFrame, log_dir: str, run: str, created_at: str,
                   period: str = "month") -> None:
    """Append a record for each period of ``final`` (see
    :func:`finalize.finalize`) that has a result and no live record of another
    run: one made before the last reset of one of its tasks is void."""
    spark = final.sparkSession
    others = latest_records(read_records(spark, log_dir, period).where(F.col("run") != run), period)
    held = live_records(others, tasks, period).select(period).distinct()
    rows = final.join(held, period, "left_anti")
    counts = rows.select(period, F.col("n_tasks").cast("long").alias("n_tasks"))
    (FZ.log_records(rows, created_at, period).join(counts, period)
     .write.mode("overwrite").parquet(f"{log_dir}/records/run={run}"))


def append_alerts(spark: SparkSession, log_dir: str, run: str, period: str = "month") -> None:
    """Append an alert for each record that has none from another run, so a run
    that fell over between the two sinks is made up for by the next one."""
    records = FZ.decode_log(read_records(spark, log_dir, period))
    told = read_alerts(spark, log_dir, period).where(F.col("run") != run).select(period, "created_at")
    rows = records.join(told, [period, "created_at"], "left_anti")
    (FZ.alerts(rows, period, extra=["created_at"])
     .write.mode("overwrite").json(f"{log_dir}/alerts/run={run}"))


def live_record(events: DataFrame, period: str = "month") -> DataFrame:
    """(period, status, created_at, created_seq, acknowledged_at, n_records,
    n_resets) of every period that has an event, status NULL where no record is
    live.  ``events``: period, event (record, acknowledge, reset), status (of a
    record), ts, seq.

    The fold is three aggregations with partial sums, so a period with a third
    of all events costs no more than another: its last reset, the first record
    behind that, and the first acknowledgement behind that record.
    """
    at = F.struct("ts", "seq")
    kind = F.col("event")
    per = events.groupBy(period).agg(
        F.max(F.when(kind == "reset", at)).alias("cut"),
        F.count_if(kind == "record").alias("n_records"), F.count_if(kind == "reset").alias("n_resets"))
    behind = events.join(per.select(F.col(period).alias("_p"), "cut"), F.col(period).eqNullSafe(F.col("_p")))
    first = (behind.where((kind == "record") & (F.col("cut").isNull() | (at > F.col("cut"))))
             .groupBy(period).agg(F.min(F.struct("ts", "seq", "status")).alias("rec")))
    acks = events.where(kind == "acknowledge").join(first.select(F.col(period).alias("_p"), "rec"),
                                                    F.col(period).eqNullSafe(F.col("_p")))
    acked = (acks.where((F.col("rec.status") == "mismatch") & (at > F.struct("rec.ts", "rec.seq")))
             .groupBy(period).agg(F.min("ts").alias("acknowledged_at")))
    for part in (first, acked):
        per = per.join(part.withColumnRenamed(period, "_p"), F.col(period).eqNullSafe(F.col("_p")), "left").drop("_p")
    status = F.when(F.col("acknowledged_at").isNotNull(), F.lit("acknowledged")).otherwise(F.col("rec.status"))
    return per.select(period, status.alias("status"), F.col("rec.ts").alias("created_at"), F.col("rec.seq").alias("created_seq"),
                      "acknowledged_at", "n_records", "n_resets")
