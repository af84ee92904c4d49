"""External sources: sharded tables and readiness feeds in an RDBMS.

Plain ``spark.read.jdbc`` with a partition column, so the scan is split into
``num_partitions`` range queries run by the executors, and filters and the
projection are pushed into the SQL the database runs.  Needs the database's
JDBC driver on the classpath; not exercised in this container (no network,
no driver jars), the Parquet path is used in tests instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_shard_table(spark: SparkSession, url: str, table: str, *, partition_column: str,
                     lower: int, upper: int, num_partitions: int,
                     properties: dict | None = None) -> DataFrame:
    """Full scan of one shard table, split into range reads on a numeric key."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=properties or {})


def read_readiness_feed(spark: SparkSession, url: str, table: str, month: str, feed_type: int, *,
                        type_col: str = "feed_type", month_col: str = "feed_month",
                        code_col: str = "code", properties: dict | None = None) -> DataFrame:
    """Rows of the readiness feed for one month and feed type, as
    (feed_type, feed_month, code); the WHERE clause runs in the database.
    Column names of the source table are parameters."""
    df = spark.read.jdbc(url, table, properties=properties or {})
    return (df.where((F.col(type_col) == feed_type) & (F.col(month_col) == month))
              .select(F.col(type_col).alias("feed_type"), F.col(month_col).alias("feed_month"),
                      F.col(code_col).alias("code")))
