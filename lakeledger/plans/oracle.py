"""DuckDB SQL fragments that compute, from the source tables alone, what the
Spark jobs must find in the lakes they really write and read back.

Shard: ``printf('srv-%03d', key % 12 + 1)``; month: ``strftime(d, '%Y%m')``.
"""

from __future__ import annotations

from lakeledger.functions import catalog as C
from lakeledger.plans import scenarios as S


def sql_str_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def shard_sql(key: str) -> str:
    return f"printf('srv-%03d', {key} % {C.SHARD_COUNT} + 1)"


def month_sql(d: str) -> str:
    return f"strftime({d}, '%Y%m')"


def units_sql(table: str) -> str:
    """Source counts per unit; ``n_kept`` = rows the faulty writer keeps."""
    src = S.SOURCES[table]
    k = src.key_col
    if table == S.FAULT_TABLE:
        kept = (f"count(*) FILTER (WHERE NOT ({k} % {C.SHARD_COUNT} + 1 = {S.DROP_SHARD} "
                f"AND {k} % {S.DROP_MODULUS} = 0))")
    else:
        kept = "count(*)"
    return (f"SELECT '{table}' AS table_name, {month_sql(src.date_col)} AS month, "
            f"{shard_sql(k)} AS server, count(*) AS n_local, {kept} AS n_kept "
            f"FROM {table} GROUP BY ALL")


def all_units_sql(tables: list[str], where: str = "") -> str:
    body = " UNION ALL ".join(f"({units_sql(t)})" for t in tables)
    return f"SELECT * FROM ({body}) {('WHERE ' + where) if where else ''}"


def lake_a_sql() -> str:
    """Expected unit count in a lake with the export-time fault only."""
    return (f"CASE WHEN table_name = '{S.FAULT_TABLE}' AND server = '{S.shard_name(S.DROP_SHARD)}' "
            f"THEN NULLIF(n_kept, 0) ELSE n_local END")


def lake_b_sql() -> str:
    """Expected unit count after the post-publish drift as well."""
    ft = S.FAULT_TABLE
    return (f"CASE WHEN table_name = '{ft}' AND server = '{S.shard_name(S.ABSENT_SHARD)}' THEN NULL "
            f"WHEN table_name = '{ft}' AND server = '{S.shard_name(S.EMPTY_SHARD)}' THEN 0 "
            f"WHEN table_name = '{ft}' AND server = '{S.shard_name(S.DOUBLED_SHARD)}' THEN 2 * n_local "
            f"ELSE {lake_a_sql()} END")


def verdict_sql(n_local: str, n_lake: str) -> str:
    return (f"CASE WHEN ({n_lake}) IS NULL OR ({n_local}) IS NULL THEN 'ERROR' "
            f"WHEN ({n_lake}) = ({n_local}) THEN 'OK' ELSE 'MISMATCH' END")


def reconcile_at_sql(units_cte: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (f"SELECT {k}, sum(n_local)::BIGINT AS n_local, sum(n_lake)::BIGINT AS n_lake, "
            f"(sum(n_lake) - sum(n_local))::BIGINT AS diff, "
            f"{verdict_sql('sum(n_local)', 'sum(n_lake)')} AS verdict, "
            f"CASE WHEN sum(n_lake) IS NULL THEN 'NO_FILES' ELSE 'OK' END AS lake_status, "
            f"count(*)::BIGINT AS n_units, "
            f"count(*) FILTER (WHERE n_lake IS NULL)::BIGINT AS n_units_missing "
            f"FROM {units_cte} GROUP BY {k}")


def report_line_sql() -> str:
    return ("printf('  %-8s %s  local=%s  cloud=%s  diff=%s', verdict, table_name, "
            "coalesce(CAST(n_local AS VARCHAR), 'ERROR'), coalesce(CAST(n_lake AS VARCHAR), lake_status), "
            "coalesce(CAST(diff AS VARCHAR), '-'))")


def templates_values_sql() -> str:
    return "(VALUES " + ", ".join(f"({i + 1}, '{t}')" for i, t in enumerate(C.TABLE_TEMPLATES)) + ") AS tpl(idx, template)"
