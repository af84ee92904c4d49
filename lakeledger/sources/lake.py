"""The Parquet lake: attempts, a manifest of published units, and counts.

Layout: ``{root}/{table}/attempt=A/unit_month=YYYYMM/unit_server=srv-NNN/part-*.parquet``
and ``{root}/{table}/_manifest/part-*.parquet``.

A write goes to an attempt folder of its own, which no reader sees.  A unit is
published by a manifest row that names its attempt, added after its rows were
counted.  Readers take, for each unit, the last attempt in the manifest.  So
an attempt that fails or loses rows leaves the earlier good copy readable,
nothing is renamed or overwritten, and a unit can be present with zero rows
and no file.  The year bucket of the original layout is
``substring(month, 1, 4)`` and is not a directory level.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.session import new_run_dir

UNIT_KEYS = ["table_name", "month", "server"]
#: partition columns of a lake table; a source may not have columns of these names
PARTITION_COLS = ["unit_month", "unit_server"]

EMPTY_FILE_BYTES = 4 << 20  # a whole file without rows is smaller
FEW_UNITS = 1000            # units whose folders are named in a filter

MANIFEST_SCHEMA = T.StructType([
    T.StructField("month", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_files", T.LongType()),
])
KEY_SCHEMA = "attempt string, unit_month string, unit_server string"
UNIT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("n_files", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_lake", T.LongType()),
    T.StructField("lake_status", T.StringType()),
])


def table_path(root: str, table_name: str) -> str:
    return f"{root.rstrip('/')}/{table_name}"


def manifest_path(root: str, table_name: str) -> str:
    return f"{table_path(root, table_name)}/_manifest"


def attempt_path(root: str, table_name: str, attempt: str) -> str:
    return f"{table_path(root, table_name)}/attempt={attempt}"


def new_attempt() -> str:
    """A name that sorts after those of earlier attempts."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def publish(spark: SparkSession, root: str, table_name: str, units: DataFrame) -> None:
    """Add manifest rows: (month, server, attempt, n_rows, n_files)."""
    (units.select(*[f.name for f in MANIFEST_SCHEMA.fields])
     .write.mode("append").parquet(manifest_path(root, table_name)))


def manifest(spark: SparkSession, root: str, table_name: str) -> DataFrame:
    """The current attempt of every published unit."""
    path = manifest_path(root, table_name)
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    return (rows.groupBy("month", "server")
            .agg(F.max(F.struct("attempt", "n_rows", "n_files")).alias("m"))
            .select("month", "server", "m.*"))


def current_attempts(spark: SparkSession, root: str, table_name: str) -> list[str]:
    """Attempts that some unit is current in: one name for each write that is
    still in use, which is what the driver needs to list their folders."""
    return sorted(r[0] for r in manifest(spark, root, table_name).select("attempt").distinct().collect()
                  if exists(spark, attempt_path(root, table_name, r[0])))


def files(spark: SparkSession, root: str, table_name: str, attempts: list[str]) -> DataFrame | None:
    """(attempt, month, server, path, length) of the Parquet files of the given
    attempts; other tables are not listed and no file is read.  Keys are the
    unescaped partition values.  None without attempts."""
    if not attempts:
        return None
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("basePath", table_path(root, table_name))
             .load([attempt_path(root, table_name, a) for a in attempts]))
    if not set(PARTITION_COLS) <= set(found.columns):  # folders without any unit
        return None
    return found.select("attempt", F.col("unit_month").alias("month"), F.col("unit_server").alias("server"),
                        "path", "length")


def inventory(spark: SparkSession, root: str, table_name: str, attempts: list[str] | None = None) -> DataFrame | None:
    """Files and bytes by (attempt, month, server)."""
    found = files(spark, root, table_name,
                  current_attempts(spark, root, table_name) if attempts is None else attempts)
    return None if found is None else found.groupBy("attempt", "month", "server").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def file_counts(spark: SparkSession, root: str, table_name: str, attempts: list[str]) -> DataFrame | None:
    """(attempt, month, server, file, length, n_rows) of every Parquet file of
    the attempts: the inventory joined with the rows that each file's footer
    gives.  The scan references no column (``ReadSchema: struct<>``), so no page
    is read.  n_rows is NULL for a file of which the scan saw no row: one without
    rows, or one that cannot be read (:func:`unreadable` tells them apart)."""
    found = files(spark, root, table_name, attempts)
    if found is None:
        return None
    keys = ["attempt", "month", "server", "file"]
    found = found.withColumn("file", F.substring_index("path", "/", -1)).select(*keys, "length")
    rows = (spark.read.schema(KEY_SCHEMA).option("basePath", table_path(root, table_name))
            .option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", "true")
            .parquet(*[attempt_path(root, table_name, a) for a in attempts]))
    counts = rows.groupBy("attempt", F.col("unit_month").alias("month"), F.col("unit_server").alias("server"),
                          F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    return found.join(counts, keys, "left")


def lake_counts(spark: SparkSession, root: str, table_name: str, attempts: list[str]) -> DataFrame | None:
    """Rows by (attempt, month, server), from the footers; files that cannot be
    read add nothing."""
    per_file = file_counts(spark, root, table_name, attempts)
    return None if per_file is None else per_file.groupBy("attempt", "month", "server").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_lake"))


def _footer_rows(batches):
    """(attempt, month, server, n_rows) of file contents, n_rows NULL where
    there is no whole footer."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    for b in batches:
        rows = []
        for content in b.column(3):
            try:
                rows.append(pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows)
            except Exception:  # noqa: BLE001  any damage
                rows.append(None)
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(rows, pa.int64())],
                                         ["attempt", "month", "server", "n_rows"])


def unreadable(spark: SparkSession, root: str, table_name: str, silent: DataFrame) -> DataFrame:
    """Of ``silent`` units (attempt, month, server) with files that gave no row:
    those with a file that is not whole.  A whole file without rows is little
    more than its footer: larger ones are damaged and not opened, of the others
    the footer is parsed.  Only the folders of these units are opened."""
    keys = ["attempt", "month", "server"]
    some = [tuple(r) for r in silent.select(*keys).limit(FEW_UNITS + 1).collect()]
    if not some:
        return silent.select(*keys)
    attempts = sorted(r[0] for r in silent.select("attempt").distinct().collect())
    held = file_counts(spark, root, table_name, attempts).join(silent.select(*keys), keys, "left_semi")
    mute = held.where("n_rows is null")
    large = mute.where(F.col("length") > EMPTY_FILE_BYTES).select(*keys)
    small = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("basePath", table_path(root, table_name)).load([attempt_path(root, table_name, a) for a in attempts])
             .where(F.col("length") <= EMPTY_FILE_BYTES))
    if len(some) <= FEW_UNITS:  # a filter on the folders; beyond that the join prunes them
        folder = F.concat_ws("/", "attempt", "unit_month", "unit_server")
        small = small.where(folder.isin(["/".join(x or "" for x in r) for r in some]))
    small = small.select("attempt", F.col("unit_month").alias("month"), F.col("unit_server").alias("server"),
                         F.substring_index("path", "/", -1).alias("file"), "content")
    small = small.join(mute.select(*keys, "file"), [*keys, "file"], "left_semi").select(*keys, "content")
    footers = small.mapInArrow(_footer_rows, "attempt string, month string, server string, n_rows long")
    # rows in a footer that the scan cannot read count as damage, too
    broken = footers.where("n_rows is null or n_rows > 0").select(*keys)
    return large.unionByName(broken).distinct()


def attempt_units(spark: SparkSession, root: str, table_name: str, attempts: list[str]) -> DataFrame:
    """(attempt, month, server, n_files, n_bytes, n_lake, n_silent) of what the
    attempts hold, published or not; n_silent counts the files without a row."""
    per_file = file_counts(spark, root, table_name, attempts)
    if per_file is None:
        return spark.createDataFrame([], "attempt string, month string, server string, n_files long, n_bytes long, "
                                         "n_lake long, n_silent long")
    return per_file.groupBy("attempt", "month", "server").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_lake"), F.count_if(F.col("n_rows").isNull()).alias("n_silent"))


def lake_units(spark: SparkSession, root: str, tables: list[str]) -> DataFrame:
    """Every published unit of the tables with its row count and status.

    ``lake_status``: OK; ERROR when a file cannot be read (n_lake is NULL, and
    the other units go on); NO_FILES when its files are gone (n_lake NULL).  A
    unit published without files, or of files without rows, has zero rows.  A
    unit that was never published has no row; the caller's outer join turns that
    into NO_FILES.  The tables are listed at the same time and counted in one
    job.
    """
    if not tables:
        return spark.createDataFrame([], UNIT_SCHEMA)

    def one(name: str) -> DataFrame:
        held = attempt_units(spark, root, name, current_attempts(spark, root, name))
        now = manifest(spark, root, name).select("month", "server", "attempt", F.col("n_files").alias("n_published"))
        return now.join(held, ["attempt", "month", "server"], "left").withColumn("table_name", F.lit(name))

    with ThreadPoolExecutor(min(8, len(tables))) as pool:
        frames = list(pool.map(inheritable_thread_target(spark)(one), tables))
    path = new_run_dir(spark, "units") + "/t"
    # one small row a unit, stored: the snapshot that all counts are taken against
    reduce(DataFrame.unionByName, frames).write.parquet(path)
    j = spark.read.schema(frames[0].schema).parquet(path)
    silent = j.where("n_silent > 0")
    bad = [unreadable(spark, root, r[0], silent.where(F.col("table_name") == r[0])).withColumn("table_name", F.lit(r[0]))
           for r in silent.select("table_name").distinct().collect()]
    error = F.lit(False)
    if bad:
        j = j.join(reduce(DataFrame.unionByName, bad).withColumn("bad", F.lit(True)),
                   ["table_name", "attempt", "month", "server"], "left")
        error = F.coalesce("bad", F.lit(False))
    n_lake = F.when(F.col("n_published") == 0, F.coalesce("n_lake", F.lit(0))).otherwise(F.col("n_lake")).cast("long")
    status = F.when(error, "ERROR").when(n_lake.isNull(), "NO_FILES").otherwise("OK")
    return j.select("table_name", "month", "server", F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
                    F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"),
                    F.when(~error, n_lake).alias("n_lake"), status.alias("lake_status"))


def read_table(spark: SparkSession, root: str, table_name: str) -> DataFrame | None:
    """Cross-shard scan of the published units of a table, with unit_month and
    unit_server; None when nothing is published.  A predicate on these two
    prunes folders."""
    attempts = current_attempts(spark, root, table_name)
    if not attempts or files(spark, root, table_name, attempts) is None:
        return None
    rows = (spark.read.option("basePath", table_path(root, table_name))
            .parquet(*[attempt_path(root, table_name, a) for a in attempts]))
    now = manifest(spark, root, table_name).select(
        "attempt", F.col("month").alias("unit_month"), F.col("server").alias("unit_server"))
    data = [c for c in rows.columns if c not in ("attempt", *PARTITION_COLS)]
    return rows.join(now, ["attempt", *PARTITION_COLS], "left_semi").select(*data, *PARTITION_COLS)
