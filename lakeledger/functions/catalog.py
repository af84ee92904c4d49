"""Catalog constants and the column expressions every operator shares.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values.  These must equal the exported system's own values for the
# results to match; they are stated as-is, in their natural order.
# --------------------------------------------------------------------------

# The 16 table templates of one period; "{m}" is the YYYYMM slot.
TABLE_TEMPLATES = [
    "d_ranking_detail_{m}_intl",
    "d_ranking_detail_{m}_us",
    "d_ranking_info_{m}_intl",
    "d_ranking_info_{m}_us",
    "d_ranking_subrank_{m}_intl",
    "d_ranking_subrank_{m}_us",
    "d_ranking_url_{m}_intl",
    "d_ranking_url_{m}_us",
    "m_ranking_detail_{m}_intl",
    "m_ranking_detail_{m}_us",
    "m_ranking_info_{m}_intl",
    "m_ranking_info_{m}_us",
    "m_ranking_subrank_{m}_intl",
    "m_ranking_subrank_{m}_us",
    "m_ranking_url_{m}_intl",
    "m_ranking_url_{m}_us",
]

# Feed codes that must all be present before a period is dispatched.
REQUIRED_FEEDS = ["US_D", "US_M", "INTL_D", "INTL_M"]
READINESS_FEED_TYPE = 19

# Status domains.
TASK_STATUSES = ["new", "progress", "complete", "failed", "timeout"]
TERMINAL_TASK_STATUSES = ["complete", "failed", "timeout"]
UNIT_STATUSES = ["complete", "failed", "skipped", "pending"]
FINALIZE_STATUSES = ["success", "mismatch", "partial_failure", "acknowledged"]

# Limits.
TASK_TIMEOUT_HOURS = 48
ONLINE_LIMIT_SECONDS = 900
ROW_GROUP_ROWS = 1_000_000
SHARD_COUNT = 12
SHARD_NAME_FORMAT = "srv-%03d"

# Alert fields (deployment settings, not values of the exported system).
ALERT_SOURCE = "lakeledger"
ALERT_CHANNEL = "alerts"

# Month text: a real YYYYMM between 1900 and 2099.
MONTH_PATTERN = r"(19|20)\d{2}(0[1-9]|1[0-2])"
# Month slot inside a table name, and its normalised form.
NAME_MONTH_SLOT = r"_\d{6}_"
NAME_MONTH_GROUP = r"_(\d{6})_"
NAME_MONTH_PLACEHOLDER = "_YYYYMM_"


def normalised_templates() -> list[str]:
    """Templates with the month slot replaced by the placeholder."""
    return [t.replace("{m}", "YYYYMM") for t in TABLE_TEMPLATES]


# --------------------------------------------------------------------------
# Column expressions
# --------------------------------------------------------------------------

def shard_of(key: Column | str, n_shards: int = SHARD_COUNT,
             fmt: str = SHARD_NAME_FORMAT) -> Column:
    """Shard name of a row: ``srv-NNN`` with NNN = key mod n + 1."""
    return F.format_string(fmt, F.pmod(F.col(key) if isinstance(key, str) else key,
                                       F.lit(n_shards)) + 1)


def month_of(ts: Column | str) -> Column:
    """YYYYMM text of a date or timestamp."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyyMM")


def valid_month(month: Column | str) -> Column:
    """True for a real YYYYMM; NULL and empty text are invalid (never NULL)."""
    m = F.col(month) if isinstance(month, str) else month
    return F.coalesce(m, F.lit("")).rlike(r"\A" + MONTH_PATTERN + r"\z")


def previous_month(d: Column | str) -> Column:
    """YYYYMM of the calendar month before the one containing ``d``."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_format(F.add_months(F.trunc(c, "MM"), -1), "yyyyMM")


def year_of_month(month: Column | str) -> Column:
    m = F.col(month) if isinstance(month, str) else month
    return F.substring(m, 1, 4)


def table_name_for(template: Column, month: Column) -> Column:
    """Expand a template's ``{m}`` slot with a month."""
    return F.replace(template, F.lit("{m}"), month)


def normalise_table_name(name: Column | str) -> Column:
    n = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(n, NAME_MONTH_SLOT, NAME_MONTH_PLACEHOLDER)


def known_table(name: Column | str) -> Column:
    """Name matches one of the 16 templates (any six digits in the slot)."""
    return normalise_table_name(name).isin(normalised_templates())


def month_in_name(name: Column | str) -> Column:
    """First ``_DDDDDD_`` group of a table name, '' when absent."""
    n = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(n, NAME_MONTH_GROUP, 1)


def templates_array() -> Column:
    """The 16 templates as an array literal (fixed size, no join needed)."""
    return F.array(*[F.lit(t) for t in TABLE_TEMPLATES])


def roster_array(n_shards: int = SHARD_COUNT, fmt: str = SHARD_NAME_FORMAT) -> Column:
    """Shard names srv-001..srv-n as an array built from the rule."""
    return F.transform(F.sequence(F.lit(1), F.lit(n_shards)),
                       lambda i: F.format_string(fmt, i))
