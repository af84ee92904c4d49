"""Reconciliation: count both sides, diff, classify, roll up, report.

The reference issues two count queries per table, serially (32 a month).
Here each side is one grouped pass (``export.source_counts`` and
``lake.lake_units``), joined once at unit grain; every coarser grain is an
aggregate of that small joined table, so no grain rescans the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.sources import lake

UNIT_KEYS = lake.UNIT_KEYS


def diff_col(n_local: Column, n_lake: Column) -> Column:
    """Signed difference lake - local; NULL when either side is unknown."""
    return (n_lake - n_local).cast("long")


def verdict_col(n_local: Column, n_lake: Column) -> Column:
    """OK when the difference is 0, ERROR when a side is not a number,
    MISMATCH otherwise."""
    d = diff_col(n_local, n_lake)
    return (F.when(d.isNull(), "ERROR")
             .when(d == 0, "OK")
             .otherwise("MISMATCH"))


def reconcile_units(local: DataFrame, lake_side: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Unit grain, full outer: expected units, source units and lake units.

    ``local``: (table_name, month, server, n_local) and, where a source could
    not be counted, local_status ERROR with n_local NULL.
    ``lake_side``: present units with n_lake and lake_status (OK, ERROR or
    NO_FILES), e.g. :func:`lake.lake_units`; an absent unit is missing there.
    ``expected``: planned units (table_name, month, server), so that one that
    is absent on both sides still has a row.  By default those of ``local``.

    ``unit_status``: UNEXPECTED for a unit that nobody planned, else OK.
    """
    side = lambda df, c: F.col(c) if c in df.columns else F.lit("OK").alias(c)
    left = local.select(*UNIT_KEYS, "n_local", side(local, "local_status"))
    right = lake_side.select(*UNIT_KEYS, "n_lake", side(lake_side, "lake_status"))
    plan = (local if expected is None else expected).select(*UNIT_KEYS, F.lit(True).alias("_planned"))
    j = left.join(right, UNIT_KEYS, "full_outer").join(plan.distinct(), UNIT_KEYS, "full_outer")
    return j.select(
        *UNIT_KEYS, "n_local", "n_lake",
        F.coalesce("lake_status", F.lit("NO_FILES")).alias("lake_status"),
        F.coalesce("local_status", F.lit("NO_ROWS")).alias("local_status"),
        F.when(F.col("_planned").isNull(), "UNEXPECTED").otherwise("OK").alias("unit_status"),
    )


def _sides(units: DataFrame, keys: list[Column | str], rollup: bool = False) -> DataFrame:
    """Totals of both sides by ``keys``.  A side's total is NULL when one of its
    units cannot be counted, or when none of them exists."""
    def total(n: str, status: str) -> Column:
        return F.when(F.count_if(F.col(status) == "ERROR") == 0, F.sum(n)).cast("long").alias(n)

    grouped = units.rollup(*keys) if rollup else units.groupBy(*keys)
    extra = [F.grouping_id().cast("int").alias("grain")] if rollup else []
    return grouped.agg(
        *extra, total("n_local", "local_status"), total("n_lake", "lake_status"),
        F.count(F.lit(1)).cast("long").alias("n_units"),
        F.count_if(F.col("lake_status") == "NO_FILES").cast("long").alias("n_units_missing"),
        F.count_if(F.col("lake_status") == "ERROR").cast("long").alias("n_units_error"),
        F.count_if(F.col("unit_status") == "UNEXPECTED").cast("long").alias("n_units_unexpected"))


def _lake_label() -> Column:
    return (F.when(F.col("n_units_error") > 0, "ERROR").when(F.col("n_lake").isNull(), "NO_FILES").otherwise("OK")
            .alias("lake_status"))


def reconcile_at(units: DataFrame, keys: list[str]) -> DataFrame:
    """Roll unit-grain rows up to ``keys`` and classify.

    A side's total is NULL when none of its units exist at this grain, so a
    table with no lake files reads NO_FILES while a present unit with zero rows
    reads 0, and NULL with lake_status ERROR when a unit cannot be read.
    """
    return _sides(units, keys).select(
        *keys, "n_local", "n_lake",
        diff_col(F.col("n_local"), F.col("n_lake")).alias("diff"),
        verdict_col(F.col("n_local"), F.col("n_lake")).alias("verdict"),
        _lake_label(), "n_units", "n_units_missing",
    )


def reconcile_status(units: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`reconcile_at` with the counts of unreadable and unexpected units."""
    return _sides(units, keys).select(
        *keys, "n_local", "n_lake",
        diff_col(F.col("n_local"), F.col("n_lake")).alias("diff"),
        verdict_col(F.col("n_local"), F.col("n_lake")).alias("verdict"),
        _lake_label(), "n_units", "n_units_missing", "n_units_error", "n_units_unexpected",
    )


def reconcile_rollup(units: DataFrame, keys: list[str]) -> DataFrame:
    """Every prefix grain of ``keys`` in one aggregate (``rollup``).

    ``grain`` is ``grouping_id()``: 0 for the finest grain, one bit per
    rolled-up key.  A side that does not exist at a grain is NULL there, never
    0, and so is its difference.
    """
    return _sides(units, keys, rollup=True).select(
        *keys, "grain", "n_local", "n_lake", diff_col(F.col("n_local"), F.col("n_lake")).alias("diff"),
        "n_units_missing")


def report_line(verdict: Column, table: Column, n_local: Column, n_lake: Column,
                lake_status: Column) -> Column:
    """One aligned report line: ``  VERDICT  table  local=.. cloud=.. diff=..``."""
    local_txt = F.coalesce(n_local.cast("string"), F.lit("ERROR"))
    lake_txt = F.coalesce(n_lake.cast("string"), lake_status)
    diff_txt = F.coalesce(diff_col(n_local, n_lake).cast("string"), F.lit("-"))
    return F.format_string("  %-8s %s  local=%s  cloud=%s  diff=%s",
                           verdict, table, local_txt, lake_txt, diff_txt)


def reconcile_summary(by_table: DataFrame, period_keys: list[str],
                      item_col: str = "table_name") -> DataFrame:
    """Per period: all-OK flag, mismatch and error counts, and the report.

    Errors (a side not countable) make ``all_ok`` false but are not
    mismatches.  The report is one line per item, sorted by item name; it
    is bounded by the number of tables in a period, never by data rows.
    """
    lines = by_table.select(
        *period_keys, item_col, "verdict",
        report_line(F.col("verdict"), F.col(item_col), F.col("n_local"), F.col("n_lake"),
                    F.col("lake_status")).alias("_line"))
    return lines.groupBy(*period_keys).agg(
        F.bool_and(F.col("verdict") == "OK").alias("all_ok"),
        F.count(F.lit(1)).cast("long").alias("n_tables"),
        F.count_if(F.col("verdict") == "MISMATCH").cast("long").alias("mismatch_count"),
        F.count_if(F.col("verdict") == "ERROR").cast("long").alias("error_count"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(item_col).alias("k"),
                                                             F.col("_line").alias("v")))),
                        lambda x: x["v"]),
            "\n").alias("report"),
    )
