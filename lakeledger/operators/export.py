"""Export: plan units, skip what the lake has, write the rest, validate.

A unit is (table, month, server).  The reference exports one unit per
process, serially; here one distributed write per table covers all pending
units, and the counts that validate it are grouped passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import catalog as C
from lakeledger.session import conf_scope, new_run_dir
from lakeledger.sources import lake

UNIT_KEYS = lake.UNIT_KEYS


@dataclass(frozen=True)
class SourceTable:
    """A sharded source: which column picks the shard and which the month."""
    name: str
    key_col: str
    date_col: str


NO_KEY = "unknown"  # the unit label of rows whose date or shard key is NULL


def unit_key(src: SourceTable, n_shards: int = C.SHARD_COUNT) -> list[Column]:
    """(month, server) of a source row, never NULL: rows without a date or a
    shard key belong to units labelled ``unknown``, on both sides."""
    return [F.coalesce(C.month_of(src.date_col), F.lit(NO_KEY)),
            F.when(F.col(src.key_col).isNull(), NO_KEY).otherwise(C.shard_of(src.key_col, n_shards))]


def plan_units(periods: DataFrame, month_col: str = "month",
               n_shards: int = C.SHARD_COUNT) -> DataFrame:
    """Work plan: every valid period x every shard x every table template.

    The roster and the templates are fixed-size literals expanded with
    ``explode`` inside one projection, so there is no join and no shuffle;
    invalid months are dropped by the month rule.
    """
    months = periods.select(F.col(month_col).alias("month")).where(C.valid_month("month"))
    per_server = months.select("month", F.explode(C.roster_array(n_shards)).alias("server"))
    per_table = per_server.select("month", "server", F.explode(C.templates_array()).alias("_tpl"))
    return per_table.select(
        "month",
        C.year_of_month("month").alias("year"),
        "server",
        C.table_name_for(F.col("_tpl"), F.col("month")).alias("table_name"),
    )


def source_counts(df: DataFrame, src: SourceTable, n_shards: int = C.SHARD_COUNT) -> DataFrame:
    """Rows per unit in the source: one grouped pass over two columns."""
    month, server = unit_key(src, n_shards)
    return (df.groupBy(month.alias("month"), server.alias("server"))
            .agg(F.count(F.lit(1)).cast("long").alias("n_local"))
            .select(F.lit(src.name).alias("table_name"), "month", "server", "n_local"))


def pending_units(planned: DataFrame, present: DataFrame,
                  verify_existing: bool = True) -> DataFrame:
    """Decide per planned unit: ``export``, ``skip`` or ``reexport``.

    ``planned`` has the unit keys and ``n_local``; ``present`` is the lake
    side (:func:`lake.lake_units`).  A present unit counts as done only when
    its lake count equals the source count (``verify_existing``), so a file
    that was published but never validated is written again rather than
    skipped forever.
    """
    j = planned.join(present.select(*UNIT_KEYS, "n_lake"), UNIT_KEYS, "left")
    action = (F.when(F.col("n_lake").isNull(), "export")
               .when(F.lit(not verify_existing) | (F.col("n_lake") == F.col("n_local")), "skip")
               .otherwise("reexport"))
    return j.select(*UNIT_KEYS, "n_local", "n_lake", action.alias("action"))


def write_units(df: DataFrame, src: SourceTable, root: str, *,
                units: DataFrame | None = None,
                rows_per_file: int = C.ROW_GROUP_ROWS,
                row_group_rows: int = C.ROW_GROUP_ROWS,
                n_shards: int = C.SHARD_COUNT) -> str:
    """Write a source table as a new, unpublished attempt; returns its name.

    ``units`` (optional) restricts the write to those (month, server) keys,
    e.g. the ``export``/``reexport`` rows of :func:`pending_units`.

    Rows are rebalanced on the unit key: adaptive execution merges small units
    into one task and splits a large one over several, by measured size, so
    no count is needed first and a unit with a third of all rows is written by
    many tasks.  No file has more than ``rows_per_file`` rows.  Any column type
    and any column name but the two partition columns' may occur.
    """
    taken = [c for c in df.columns if c.lower() in lake.PARTITION_COLS]
    if taken:
        raise ValueError(f"source columns {taken} are the lake's partition columns")
    month, server = unit_key(src, n_shards)
    keyed = df.withColumns(dict(zip(lake.PARTITION_COLS, (month, server), strict=True)))
    if units is not None:
        wanted = units.select(F.col("month").alias("unit_month"), F.col("server").alias("unit_server")).distinct()
        keyed = keyed.join(wanted, lake.PARTITION_COLS, "left_semi")
    attempt = lake.new_attempt()
    # many small units are file creations, not bytes: keep all cores at them
    with conf_scope(df.sparkSession, {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
                                      "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}):
        (keyed.hint("rebalance", *[F.col(c) for c in lake.PARTITION_COLS])
         .write.option("compression", "zstd")
         .option("maxRecordsPerFile", rows_per_file)
         .option("parquet.block.row.count.limit", str(row_group_rows))
         .partitionBy(*lake.PARTITION_COLS)
         .parquet(lake.attempt_path(root, src.name, attempt)))
    return attempt


def write_and_publish(spark: SparkSession, df: DataFrame, src: SourceTable, root: str, **options) -> None:
    """Write and publish whatever was written, unchecked (first loads, and the
    faulty writers of the test scenarios)."""
    attempt = write_units(df, src, root, **options)
    held = lake.attempt_units(spark, root, src.name, [attempt])
    lake.publish(spark, root, src.name, held.withColumn("n_rows", F.col("n_lake")))


def safe_source_counts(spark: SparkSession, df: DataFrame, src: SourceTable, planned: DataFrame,
                       n_shards: int = C.SHARD_COUNT) -> DataFrame:
    """:func:`source_counts` of a source that may not be readable: then every
    planned unit of the table has n_local NULL and local_status ERROR, and the
    other tables go on."""
    run = new_run_dir(spark, "counts")
    try:
        counts = _materialize(spark, source_counts(df, src, n_shards), run, src.name)
    except (PySparkException, Py4JJavaError) as exc:
        java = exc.java_exception if isinstance(exc, Py4JJavaError) else exc
        condition = java.getCondition() if hasattr(java, "getCondition") else None
        if not (condition or "").startswith(("FAILED_READ_FILE", "CANNOT_READ", "PATH_NOT_FOUND")):
            raise
        return (planned.where(F.col("table_name") == src.name).select(*UNIT_KEYS)
                .select(*UNIT_KEYS, F.lit(None).cast("long").alias("n_local"), F.lit("ERROR").alias("local_status")))
    return counts.withColumn("local_status", F.lit("OK"))


def validate_units(local: DataFrame, present: DataFrame) -> DataFrame:
    """Unit verdict: complete iff both counts are known and equal.

    An unreadable or absent lake side gives ``n_lake = NULL`` and ``failed``
    (never a faked 0).
    """
    j = local.join(present.select(*UNIT_KEYS, "n_lake"), UNIT_KEYS, "left")
    ok = F.coalesce(F.col("n_local") == F.col("n_lake"), F.lit(False))
    return j.select(*UNIT_KEYS, "n_local", "n_lake",
                    F.when(ok, "complete").otherwise("failed").alias("status"))


def task_outcome(units: DataFrame, task_keys: list[str] | None = None) -> DataFrame:
    """Task result from its units: failed when any unit failed."""
    keys = task_keys or ["month", "server"]
    agg = units.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("n_units"),
        F.count_if(F.col("status") == "failed").cast("long").alias("n_failed"))
    return agg.select(
        *keys, "n_units", "n_failed",
        F.when(F.col("n_failed") == 0, "complete").otherwise("failed").alias("status"),
        F.when(F.col("n_failed") == 0, F.lit(""))
         .otherwise(F.format_string("%d tables failed", F.col("n_failed"))).alias("error_msg"))


def export_table(spark: SparkSession, df: DataFrame, src: SourceTable, root: str, *,
                 verify_existing: bool = True, rows_per_file: int = C.ROW_GROUP_ROWS,
                 n_shards: int = C.SHARD_COUNT, writer=write_units) -> DataFrame:
    """Incremental export of one table, end to end; returns unit verdicts.

    1. grouped source count (two columns read);
    2. the published units with their footer counts, then :func:`pending_units`;
    3. one rebalanced write of the pending units to a new attempt;
    4. the attempt's footer counts against the source's: units that agree are
       published and ``complete``, the others ``failed`` and not published, so
       what readers saw before stays.  Skipped units report ``skipped`` with
       their measured lake count.
    """
    run = new_run_dir(spark, "export")
    counts = _materialize(spark, source_counts(df, src, n_shards), run, "counts")
    before = lake.lake_units(spark, root, [src.name])
    plan = _materialize(spark, pending_units(counts, before, verify_existing), run, "plan")
    todo = plan.where(F.col("action") != "skip")
    done = plan.where(F.col("action") == "skip").select(*UNIT_KEYS, "n_local", "n_lake", F.lit("skipped").alias("status"))
    if todo.isEmpty():
        return done
    return done.unionByName(export_again(spark, df, src, root, todo, writer=writer, rows_per_file=rows_per_file,
                                         n_shards=n_shards))


def export_again(spark: SparkSession, df: DataFrame, src: SourceTable, root: str, units: DataFrame, *,
                 writer=write_units, **options) -> DataFrame:
    """Write the given units (with n_local), count what was written and publish
    the units that agree; verdicts as :func:`validate_units`."""
    run = new_run_dir(spark, "export")
    attempt = writer(df, src, root, units=units, **options)
    held = _materialize(spark, lake.attempt_units(spark, root, src.name, [attempt]), run, "held")
    verdict = validate_units(units.select(*UNIT_KEYS, "n_local"), held.withColumn("table_name", F.lit(src.name)))
    good = (verdict.where(F.col("status") == "complete").select("month", "server")
            .join(held, ["month", "server"]).withColumn("n_rows", F.col("n_lake")))
    lake.publish(spark, root, src.name, good)
    return verdict


def _materialize(spark: SparkSession, df: DataFrame, run: str, name: str) -> DataFrame:
    """Write a small derived table to this run's folder and read it back.

    Cuts lineage so later stages (and retries after an executor loss) reuse
    the stored result instead of re-running the source scan; a later run has a
    folder of its own.
    """
    path = f"{run}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
