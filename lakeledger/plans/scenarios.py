"""Scenarios the registered queries run: the driver tables as sharded sources,
and lakes built from them with deterministic faults.

Fault plan (a copy of ``lineitem``; ``orders`` is always exported clean):

* export-time fault: shard 5 loses the rows whose key is a multiple of 97
  (a writer that dropped rows; validation must catch it);
* post-publish drift, applied on top in a second lake copy: shard 3 is
  absent (NO_FILES), shard 7 is written twice (positive diff), shard 9 is
  present with zero rows (count 0, not NO_FILES).

Every lake is written by :func:`export.write_units`, i.e. by the same
distributed writer the export uses; faults are DataFrame filters/unions on
the source, never edits of files.  The tables of a lake are written at the
same time, so that small jobs share the cluster.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import catalog as C
from lakeledger.operators import export
from lakeledger.sources import lake

SOURCES = {
    "lineitem": export.SourceTable("lineitem", "l_orderkey", "l_shipdate"),
    "orders": export.SourceTable("orders", "o_orderkey", "o_orderdate"),
}

# Fixed fault plan (shard numbers are 1-based, as in the shard names).
FAULT_TABLE = "lineitem"
DROP_SHARD, DROP_MODULUS = 5, 97
ABSENT_SHARD = 3
DOUBLED_SHARD = 7
EMPTY_SHARD = 9
CORRUPT_SHARD = 2
STRAY_SERVER = "srv-099"  # in the lake, but nobody planned it
# Months before this one were exported by an earlier run (incremental case).
EARLIER_RUN_BEFORE = "199701"


def shard_name(i: int) -> str:
    return C.SHARD_NAME_FORMAT % i


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def export_time_fault(df: DataFrame, src: export.SourceTable) -> DataFrame:
    server = C.shard_of(src.key_col)
    dropped = (server == shard_name(DROP_SHARD)) & (F.pmod(F.col(src.key_col), F.lit(DROP_MODULUS)) == 0)
    return df.where(~dropped)


def drift_fault(df: DataFrame, src: export.SourceTable) -> DataFrame:
    """Post-publish drift on an already export-faulted copy."""
    server = C.shard_of(src.key_col)
    kept = df.where(~server.isin(shard_name(ABSENT_SHARD), shard_name(EMPTY_SHARD)))
    return kept.unionByName(df.where(server == shard_name(DOUBLED_SHARD)))


def _empty_units(spark: SparkSession, df: DataFrame, src: export.SourceTable, root: str) -> None:
    """Publish every unit of the empty shard as present with zero rows."""
    month, server = export.unit_key(src)
    empty = (df.select(month.alias("month"), server.alias("server"))
             .where(F.col("server") == shard_name(EMPTY_SHARD)).distinct())
    lake.publish(spark, root, src.name, empty.select(
        "month", "server", F.lit(lake.new_attempt()).alias("attempt"),
        F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_files")))


def build_lake(spark: SparkSession, sf_dir: str, root: str, tables: list[str], *,
               export_fault: bool = False, drift: bool = False,
               months_before: str | None = None) -> None:
    """Write ``tables`` into the lake at ``root`` with the chosen faults."""
    def one(name: str) -> None:
        src = SOURCES[name]
        df = read_source(spark, sf_dir, name)
        if months_before is not None:
            df = df.where(C.month_of(src.date_col) < months_before)
        faulty = name == FAULT_TABLE
        data = df
        if faulty and export_fault:
            data = export_time_fault(data, src)
        if faulty and drift:
            data = drift_fault(data, src)
        export.write_and_publish(spark, data, src, root)
        if faulty and drift:
            _empty_units(spark, df, src, root)

    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(inheritable_thread_target(spark)(one), tables))


def corrupt_and_stray(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Publish the corrupt shard with files that are not Parquet (a text file of
    that name), and a stray shard with the rows of shard 1."""
    src = SOURCES[FAULT_TABLE]
    df = read_source(spark, sf_dir, FAULT_TABLE)
    month, server = export.unit_key(src)
    counts = export.source_counts(df, src)
    attempt = lake.new_attempt()
    units = counts.where(F.col("server") == shard_name(CORRUPT_SHARD)).select(
        "month", "server", F.lit(attempt).alias("attempt"), F.col("n_local").alias("n_rows"),
        F.lit(1).cast("long").alias("n_files"))
    junk = units.select(F.lit("not parquet").alias("value"), F.col("month").alias("unit_month"),
                        F.col("server").alias("unit_server"))
    folder = lake.attempt_path(root, src.name, attempt)
    junk.coalesce(1).write.partitionBy(*lake.PARTITION_COLS).option("compression", "none").text(folder)
    _rename_files(spark, folder, ".txt", ".parquet")
    lake.publish(spark, root, src.name, units)
    stray = (df.withColumns({"unit_month": month, "unit_server": server})
             .where(F.col("unit_server") == shard_name(1)).withColumn("unit_server", F.lit(STRAY_SERVER)))
    attempt = lake.new_attempt()
    stray.write.partitionBy(*lake.PARTITION_COLS).parquet(lake.attempt_path(root, src.name, attempt))
    held = lake.attempt_units(spark, root, src.name, [attempt])
    lake.publish(spark, root, src.name, held.withColumn("n_rows", F.col("n_lake")))


def _rename_files(spark: SparkSession, folder: str, old: str, new: str) -> None:
    """Fixture only: give the files of one shard's units another ending."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listFiles(path(folder), True)
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(old):
            fs.rename(path(name), path(name[:-len(old)] + new))


def local_counts(spark: SparkSession, sf_dir: str, tables: list[str]) -> DataFrame:
    """Grouped source counts of ``tables`` at unit grain."""
    out = None
    for name in tables:
        c = export.source_counts(read_source(spark, sf_dir, name), SOURCES[name])
        out = c if out is None else out.unionByName(c)
    return out
