"""Coverage gate (relational division): a period is ready iff every
required code is present; the missing codes are listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.functions import catalog as C


def coverage(feeds: DataFrame, period_cols: list[str], code_col: str,
             required: list[str]) -> DataFrame:
    """Per period: present codes, missing codes, ready flag.

    Codes outside ``required`` map to NULL before ``collect_set``, so each
    partial aggregate holds at most ``len(required)`` values however many
    feed rows a period has; extra codes and duplicates are ignored, the
    match is case sensitive and whole-value.  An empty requirement is ready.
    """
    req = F.array(*[F.lit(c) for c in required]) if required else F.array().cast("array<string>")
    code = F.col(code_col)
    g = feeds.groupBy(*period_cols).agg(
        F.collect_set(F.when(code.isin(required), code)).alias("_have"))
    missing = F.array_sort(F.array_except(req, F.col("_have")))
    return g.select(*period_cols,
                    (F.size(missing) == 0).alias("ready"),
                    F.size(missing).cast("long").alias("n_missing"),
                    F.array_join(missing, ",").alias("missing"))


def readiness(feed: DataFrame, month: str, feed_type: int = C.READINESS_FEED_TYPE,
              required: list[str] | None = None) -> DataFrame:
    """The dispatch gate for one target month over a readiness feed
    (feed_type, feed_month, code); the filter and projection reach the
    source scan (Parquet ``PushedFilters`` or a JDBC WHERE clause).  Always
    one row; without a requirement the month is ready."""
    target = feed.sparkSession.range(1).select(F.lit(month).alias("month"))
    rows = (feed.where((F.col("feed_type") == feed_type) & (F.col("feed_month") == month))
                .select(F.lit(month).alias("month"), "code"))
    # a month without any feed row misses all codes
    return coverage(target.join(rows, "month", "left"), ["month"], "code",
                    C.REQUIRED_FEEDS if required is None else required)
