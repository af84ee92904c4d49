"""Unit status from a stream of reports.

Each micro-batch of reports meets the tasks (a stream-static join), passes the
checks of the batch form, and is reduced to the last accepted report of each
(task, table).  The reduced rows are merged into a table by batch id: a batch
writes its own folder, which a repeated batch overwrites, and every ``every``-th
batch a snapshot of all before it, so a reader opens the last snapshot and the
few batches behind it, however long the stream has run.  Rejected reports go to
a side table with their reasons.

The last report by (ts, seq) wins, so the result does not depend on the order
of arrival, and a report that is delivered again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.operators.tasks import report_checks

REPORT = ("task_id long, table_name string, status string, rows_local long, rows_lake long, error_msg string, "
          "ts timestamp_ntz, seq long")
_KEYS = ["task_id", "table_name"]
_REST = ["status", "rows_local", "rows_lake", "error_msg", "ts", "seq"]


def last_reports(reports: DataFrame) -> DataFrame:
    """The last report of each (task, table); partial aggregation keeps one
    a key and map task."""
    last = F.max_by(F.struct(*_REST), F.struct("ts", "seq")).alias("r")
    return reports.groupBy(*_KEYS).agg(last).select(*_KEYS, "r.*")


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT + ", batch_id long").parquet(path)


def current_reports(spark: SparkSession, out_dir: str, before: int | None = None) -> DataFrame:
    """The last report of each (task, table) after all batches, or after those
    up to and with ``before``."""
    upto = F.lit(True) if before is None else F.col("batch_id") <= before
    # the folders' names alone: no column of the files is read
    top = _table(spark, f"{out_dir}/snapshot").where(upto).agg(F.max("batch_id")).first()[0]
    deltas = _table(spark, f"{out_dir}/delta").where(upto)
    if top is None:
        return last_reports(deltas)
    whole = _table(spark, f"{out_dir}/snapshot").where(F.col("batch_id") == top)
    return last_reports(whole.unionByName(deltas.where(F.col("batch_id") > top)))


def merge_batch(batch: DataFrame, batch_id: int, out_dir: str, every: int) -> None:
    """Merge the checked reports of a micro-batch; doing it again for the same
    batch leaves the same table."""
    ok = F.col("reject_reason").isNull()
    batch = batch.persist()
    last_reports(batch.where(ok)).write.mode("overwrite").parquet(f"{out_dir}/delta/batch_id={batch_id}")
    batch.where(~ok).write.mode("overwrite").parquet(f"{out_dir}/rejected/batch_id={batch_id}")
    batch.unpersist()
    if (batch_id + 1) % every == 0:
        whole = current_reports(batch.sparkSession, out_dir, before=batch_id - 1).unionByName(
            _table(batch.sparkSession, f"{out_dir}/delta").where(F.col("batch_id") == batch_id).drop("batch_id"))
        last_reports(whole).write.mode("overwrite").parquet(f"{out_dir}/snapshot/batch_id={batch_id}")


def stream_units(reports: DataFrame, tasks: DataFrame, out_dir: str, checkpoint_dir: str, every: int = 16) -> None:
    """Run over ``reports`` (a streaming frame of unit reports) until all input
    is processed.  ``tasks`` is a batch frame (task_id, month, server, ...),
    read again by each micro-batch."""
    spark = reports.sparkSession
    for kind in ("snapshot", "delta", "rejected"):  # readable before the first batch
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{kind}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    q = (report_checks(reports, tasks).writeStream.foreachBatch(lambda b, i: merge_batch(b, i, out_dir, every))
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()


def rejected_reports(spark: SparkSession, out_dir: str) -> DataFrame:
    """(report_id, task_id, table_name, status, server, reject_reason) of the side table."""
    return spark.read.schema("report_id long, task_id long, table_name string, status string, server string, "
                             "reject_reason string").parquet(f"{out_dir}/rejected")
