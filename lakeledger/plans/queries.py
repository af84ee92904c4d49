"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables in full (or lakes Spark writes from
them), so its work grows with the data.  ``ORACLES`` holds the DuckDB SQL
that computes the same rows from the source tables alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import catalog as C
from lakeledger.operators import export, reconcile
from lakeledger.plans import oracle as O
from lakeledger.plans import scenarios as S
from lakeledger.session import apply_required_conf, new_run_dir
from lakeledger.sources import lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


BOTH = ["lineitem", "orders"]
UNIT_COLS = ["table_name", "month", "server"]


# --------------------------------------------------------------------------
# Export
# --------------------------------------------------------------------------

@register("plan_units", f"""
SELECT m.month, substr(m.month, 1, 4) AS year, printf('srv-%03d', s.i) AS server,
       replace(tpl.template, '{{m}}', m.month) AS table_name
FROM (SELECT DISTINCT {O.month_sql('o_orderdate')} AS month FROM orders) m,
     range(1, {C.SHARD_COUNT + 1}) AS s(i), {O.templates_values_sql()}
WHERE regexp_full_match(m.month, '{C.MONTH_PATTERN}')
""")
def plan_units(spark, sf_dir):
    """Work plan for every month that has orders: months x shards x templates."""
    orders = S.read_source(spark, sf_dir, "orders")
    months = orders.select(C.month_of("o_orderdate").alias("month")).distinct()
    return export.plan_units(months)


@register("export_counts", f"""
SELECT table_name, month, server, n_local::BIGINT AS n_local, n_local::BIGINT AS n_lake,
       'complete' AS status
FROM ({O.all_units_sql(BOTH)})
""")
def export_counts(spark, sf_dir):
    """Fresh export of lineitem and orders; unit counts read back and validated."""
    root = new_run_dir(spark, "lake")
    out = None
    for name in BOTH:
        v = export.export_table(spark, S.read_source(spark, sf_dir, name), S.SOURCES[name], root)
        out = v if out is None else out.unionByName(v)
    return out


@register("pending_units", f"""
WITH u AS ({O.all_units_sql(['lineitem'])}),
e AS (SELECT *, CASE WHEN month < '{S.EARLIER_RUN_BEFORE}' THEN {O.lake_a_sql()} END AS n_lake FROM u)
SELECT table_name, month, server, n_local::BIGINT AS n_local, n_lake::BIGINT AS n_lake,
       CASE WHEN n_lake IS NULL THEN 'export' WHEN n_lake = n_local THEN 'skip' ELSE 'reexport' END AS action
FROM e
""")
def pending_units(spark, sf_dir):
    """An earlier run exported the months before 1997 with the shard-5 writer
    fault; decide export / skip / reexport for every source unit."""
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, ["lineitem"], export_fault=True,
                 months_before=S.EARLIER_RUN_BEFORE)
    planned = S.local_counts(spark, sf_dir, ["lineitem"])
    return export.pending_units(planned, lake.lake_units(spark, root, ["lineitem"]))


@register("export_incremental", f"""
WITH u AS ({O.all_units_sql(['lineitem'])}),
e AS (SELECT *, CASE WHEN month < '{S.EARLIER_RUN_BEFORE}' THEN {O.lake_a_sql()} END AS earlier FROM u)
SELECT table_name, month, server, n_local::BIGINT AS n_local, n_local::BIGINT AS n_lake,
       CASE WHEN earlier = n_local THEN 'skipped' ELSE 'complete' END AS status
FROM e
""")
def export_incremental(spark, sf_dir):
    """Second run over the lake of ``pending_units``: skips verified units,
    rewrites the faulty ones, exports the rest, validates all."""
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, ["lineitem"], export_fault=True,
                 months_before=S.EARLIER_RUN_BEFORE)
    return export.export_table(spark, S.read_source(spark, sf_dir, "lineitem"),
                               S.SOURCES["lineitem"], root)


@register("validate_units", f"""
SELECT table_name, month, server, n_local::BIGINT AS n_local, ({O.lake_a_sql()})::BIGINT AS n_lake,
       CASE WHEN ({O.lake_a_sql()}) = n_local THEN 'complete' ELSE 'failed' END AS status
FROM ({O.all_units_sql(BOTH)})
""")
def validate_units(spark, sf_dir):
    """Per-unit validation of a lake written with the export-time fault."""
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, BOTH, export_fault=True)
    local = S.local_counts(spark, sf_dir, BOTH)
    return export.validate_units(local, lake.lake_units(spark, root, BOTH))


TASK_OUTCOME_SQL = f"""
WITH v AS (SELECT month, server,
                  CASE WHEN ({O.lake_a_sql()}) = n_local THEN 0 ELSE 1 END AS bad
           FROM ({O.all_units_sql(BOTH)}))
SELECT month, server, count(*)::BIGINT AS n_units, sum(bad)::BIGINT AS n_failed,
       CASE WHEN sum(bad) = 0 THEN 'complete' ELSE 'failed' END AS status,
       CASE WHEN sum(bad) = 0 THEN '' ELSE printf('%d tables failed', sum(bad)) END AS error_msg
FROM v GROUP BY month, server
"""


def _task_outcomes(spark, sf_dir, root):
    local = S.local_counts(spark, sf_dir, BOTH)
    units = export.validate_units(local, lake.lake_units(spark, root, BOTH))
    return export.task_outcome(units)


@register("task_outcome", TASK_OUTCOME_SQL)
def task_outcome(spark, sf_dir):
    """Task (month, server) result from its table units."""
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, BOTH, export_fault=True)
    return _task_outcomes(spark, sf_dir, root)


# --------------------------------------------------------------------------
# Reconciliation (lake with export fault and post-publish drift)
# --------------------------------------------------------------------------

def _drift_units(spark, sf_dir, tables):
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, tables, export_fault=True, drift=True)
    local = S.local_counts(spark, sf_dir, tables)
    return reconcile.reconcile_units(local, lake.lake_units(spark, root, tables)), root


def _drift_units_sql(tables):
    return f"(SELECT table_name, month, server, n_local, ({O.lake_b_sql()}) AS n_lake FROM ({O.all_units_sql(tables)}))"


@register("reconcile_by_shard", O.reconcile_at_sql(_drift_units_sql(["lineitem"]), ["table_name", "server"]))
def reconcile_by_shard(spark, sf_dir):
    """Source vs lake per shard of lineitem, all four faults present."""
    units, _ = _drift_units(spark, sf_dir, ["lineitem"])
    return reconcile.reconcile_at(units, ["table_name", "server"])


@register("reconcile_by_table", O.reconcile_at_sql(_drift_units_sql(BOTH), ["table_name", "month"]))
def reconcile_by_table(spark, sf_dir):
    """Source vs lake per (table, month), the reference's table grain."""
    units, _ = _drift_units(spark, sf_dir, BOTH)
    return reconcile.reconcile_at(units, ["table_name", "month"])


@register("reconcile_rollup", f"""
SELECT table_name, server, grouping(table_name, server)::INTEGER AS grain,
       sum(n_local)::BIGINT AS n_local, sum(n_lake)::BIGINT AS n_lake,
       (sum(n_lake) - sum(n_local))::BIGINT AS diff,
       count(*) FILTER (WHERE n_lake IS NULL)::BIGINT AS n_units_missing
FROM {_drift_units_sql(BOTH)}
GROUP BY ROLLUP (table_name, server)
""")
def reconcile_rollup(spark, sf_dir):
    """Unit counts rolled up to (table, server), table and grand total."""
    units, _ = _drift_units(spark, sf_dir, BOTH)
    return reconcile.reconcile_rollup(units, ["table_name", "server"])


@register("reconcile_summary", f"""
WITH t AS ({O.reconcile_at_sql(_drift_units_sql(BOTH), ['table_name', 'month'])}),
l AS (SELECT *, {O.report_line_sql()} AS line FROM t)
SELECT month, bool_and(verdict = 'OK') AS all_ok, count(*)::BIGINT AS n_tables,
       count(*) FILTER (WHERE verdict = 'MISMATCH')::BIGINT AS mismatch_count,
       count(*) FILTER (WHERE verdict = 'ERROR')::BIGINT AS error_count,
       string_agg(line, chr(10) ORDER BY table_name) AS report
FROM l GROUP BY month
""")
def reconcile_summary(spark, sf_dir):
    """Per month: all-OK flag, mismatch / error counts and the report text."""
    units, _ = _drift_units(spark, sf_dir, BOTH)
    by_table = reconcile.reconcile_at(units, ["table_name", "month"])
    return reconcile.reconcile_summary(by_table, ["month"])


# --------------------------------------------------------------------------
# NULL keys, unreadable and unexpected units
# --------------------------------------------------------------------------

NULL_DATE_MOD, NULL_KEY_MOD = 11, 13


@register("export_null_keys", f"""
WITH o AS (SELECT CASE WHEN o_custkey % {NULL_KEY_MOD} = 0 THEN NULL ELSE o_orderkey END AS k,
                  CASE WHEN o_custkey % {NULL_DATE_MOD} = 0 THEN NULL ELSE o_orderdate END AS d FROM orders)
SELECT 'orders' AS table_name, coalesce({O.month_sql('d')}, '{export.NO_KEY}') AS month,
       coalesce({O.shard_sql('k')}, '{export.NO_KEY}') AS server, count(*)::BIGINT AS n_local,
       count(*)::BIGINT AS n_lake, 'complete' AS status
FROM o GROUP BY ALL
""")
def export_null_keys(spark, sf_dir):
    """Export of orders with dates and shard keys that are NULL by a fixed
    rule, and with a map column: no row is lost, and the units of rows without
    a key have a verdict."""
    orders = S.read_source(spark, sf_dir, "orders")
    null = lambda c, mod: F.when(F.col("o_custkey") % mod != 0, F.col(c))
    df = orders.withColumns({"o_orderkey": null("o_orderkey", NULL_KEY_MOD),
                             "o_orderdate": null("o_orderdate", NULL_DATE_MOD),
                             "month": F.create_map("o_orderstatus", "o_orderpriority")})
    return export.export_table(spark, df, S.SOURCES["orders"], new_run_dir(spark, "lake"))


def _fault_units_sql():
    """Drifted lineitem with two more faults: shard 2 cannot be read, and the
    lake has a shard that nobody planned."""
    n_lake = (f"CASE WHEN server = '{S.shard_name(S.CORRUPT_SHARD)}' THEN NULL ELSE ({O.lake_b_sql()}) END")
    return (f"(SELECT table_name, month, server, n_local, {n_lake} AS n_lake, "
            f"CASE WHEN server = '{S.shard_name(S.CORRUPT_SHARD)}' THEN 'ERROR' WHEN ({n_lake}) IS NULL "
            f"THEN 'NO_FILES' ELSE 'OK' END AS lake_status, 'OK' AS unit_status FROM ({O.all_units_sql(['lineitem'])}) "
            f"UNION ALL SELECT table_name, month, '{S.STRAY_SERVER}', NULL, n_local, 'OK', 'UNEXPECTED' "
            f"FROM ({O.all_units_sql(['lineitem'])}) WHERE server = '{S.shard_name(1)}')")


@register("reconcile_status", f"""
WITH g AS (SELECT table_name, server, sum(n_local)::BIGINT AS n_local,
       CASE WHEN count(*) FILTER (WHERE lake_status = 'ERROR') = 0 THEN sum(n_lake)::BIGINT END AS n_lake,
       count(*)::BIGINT AS n_units, count(*) FILTER (WHERE lake_status = 'NO_FILES')::BIGINT AS n_units_missing,
       count(*) FILTER (WHERE lake_status = 'ERROR')::BIGINT AS n_units_error,
       count(*) FILTER (WHERE unit_status = 'UNEXPECTED')::BIGINT AS n_units_unexpected
FROM {_fault_units_sql()} GROUP BY table_name, server)
SELECT table_name, server, n_local, n_lake, (n_lake - n_local)::BIGINT AS diff,
       {O.verdict_sql('n_local', 'n_lake')} AS verdict,
       CASE WHEN n_units_error > 0 THEN 'ERROR' WHEN n_lake IS NULL THEN 'NO_FILES' ELSE 'OK' END AS lake_status,
       n_units, n_units_missing, n_units_error, n_units_unexpected FROM g
""")
def reconcile_status(spark, sf_dir):
    """Per shard, with a corrupt, an absent, a doubled, an empty and an
    unexpected shard: one file that cannot be read marks its unit only."""
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, ["lineitem"], export_fault=True, drift=True)
    S.corrupt_and_stray(spark, sf_dir, root)
    local = S.local_counts(spark, sf_dir, ["lineitem"])
    units = reconcile.reconcile_units(local, lake.lake_units(spark, root, ["lineitem"]))
    return reconcile.reconcile_status(units, ["table_name", "server"])


#: a month of which every shard is planned and nothing is there
UNSEEN_MONTH = "209912"


@register("reconcile_planned", f"""
WITH u AS ({O.all_units_sql(['orders'])}),
a AS (SELECT server, month, n_local::BIGINT AS n_local, n_local::BIGINT AS n_lake, 'OK' AS lake_status, 'OK' AS local_status,
             CASE WHEN month < '199301' THEN 'UNEXPECTED' ELSE 'OK' END AS unit_status FROM u
      UNION ALL SELECT DISTINCT server, '{UNSEEN_MONTH}', NULL, NULL, 'NO_FILES', 'NO_ROWS', 'OK' FROM u)
SELECT server, lake_status, local_status, unit_status, count(*)::BIGINT AS n_units, sum(n_local)::BIGINT AS n_local,
       sum(n_lake)::BIGINT AS n_lake
FROM a GROUP BY server, lake_status, local_status, unit_status
""")
def reconcile_planned(spark, sf_dir):
    """Reconciliation against a plan: planned units absent on both sides have a
    row, units that the plan does not name are unexpected."""
    root = new_run_dir(spark, "lake")
    S.build_lake(spark, sf_dir, root, ["orders"])
    local = S.local_counts(spark, sf_dir, ["orders"])
    plan = local.where("month >= '199301'").select(*UNIT_COLS).unionByName(
        local.select("table_name", F.lit(UNSEEN_MONTH).alias("month"), "server").distinct())
    units = reconcile.reconcile_units(local, lake.lake_units(spark, root, ["orders"]), expected=plan)
    return units.groupBy("server", "lake_status", "local_status", "unit_status").agg(
        F.count(F.lit(1)).alias("n_units"), F.sum("n_local").alias("n_local"), F.sum("n_lake").alias("n_lake"))


@register("export_fault_kept", f"""
WITH u AS ({O.all_units_sql(['lineitem'])})
SELECT table_name, month, server, n_local::BIGINT AS n_local, n_local::BIGINT AS n_readable,
       CASE WHEN n_kept = n_local THEN 'complete' ELSE 'failed' END AS status
FROM u
""")
def export_fault_kept(spark, sf_dir):
    """A good export, then a forced second one whose writer loses rows of
    shard 5: its bad units fail, and readers still see the good ones."""
    root, src = new_run_dir(spark, "lake"), S.SOURCES["lineitem"]
    df = S.read_source(spark, sf_dir, "lineitem")
    export.write_and_publish(spark, df, src, root)
    planned = export.source_counts(df, src)

    def faulty(data, source, where, **options):
        return export.write_units(S.export_time_fault(data, source), source, where, **options)

    verdict = export.export_again(spark, df, src, root, planned, writer=faulty)
    now = lake.lake_units(spark, root, ["lineitem"]).select(*UNIT_COLS, F.col("n_lake").alias("n_readable"))
    return verdict.join(now, UNIT_COLS, "left").select(*UNIT_COLS, "n_local", "n_readable", "status")


# Run-log, ledger and finalize queries register themselves on import.
from lakeledger.plans import runlog_queries as _runlog_queries  # noqa: E402,F401
from lakeledger.plans import finalize_queries as _finalize_queries  # noqa: E402,F401
from lakeledger.plans import stream_queries as _stream_queries  # noqa: E402,F401
