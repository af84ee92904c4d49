"""Registered run-log queries over the driver's ``events`` (and ``orders``)
with their DuckDB oracles.  Imported by :mod:`lakeledger.plans.queries`."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeledger.functions import catalog as C
from lakeledger.operators import coverage as COV
from lakeledger.operators import export
from lakeledger.operators import tasks as TK
from lakeledger.plans import oracle as O
from lakeledger.plans import scenarios as S
from lakeledger.plans.queries import register
from lakeledger.sources import runlog as RL

# Evaluation instants (fixed parameters of the scenarios).
NOW = "2024-01-31 00:00:00"          # after the last event: timeout sweep
LIVENESS_NOW = "2024-01-30 12:00:00"  # mid-day: online, offline and future pings
TS_FMT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_FMT_DUCK = "%Y-%m-%d %H:%M:%S.%f"
H = C.TASK_TIMEOUT_HOURS


def _txt(c):
    return F.date_format(c, TS_FMT_SPARK)


def _dtxt(c: str) -> str:
    return f"strftime({c}, '{TS_FMT_DUCK}')"


def _events(spark, sf_dir):
    return S.read_source(spark, sf_dir, "events")


def _log(spark, sf_dir):
    return RL.from_events(_events(spark, sf_dir))


def _replay(spark, sf_dir, timeout=True, now=NOW):
    return TK.replay_tasks(_log(spark, sf_dir), timeout_hours=H if timeout else None, now=now)


# ------------------------------------------------------------------ oracle SQL

def _event_sql() -> str:
    m = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RL.EVENT_MAP.items())
    return f"CASE event_type {m} ELSE 'other' END"


def replay_sql(timeout: bool = True, now: str | None = NOW) -> str:
    """Full ordered fold per task (no event reduction) with ``list_reduce``."""
    timed = f"(acc.st = 'progress' AND acc.started < e.ts - INTERVAL {H} HOUR)" if timeout else "FALSE"
    st0 = f"(CASE WHEN {timed} THEN 'timeout' ELSE acc.st END)"
    err0 = (f"(CASE WHEN {timed} THEN 'Auto-timeout: started at ' || strftime(acc.started, '%Y-%m-%d %H:%M:%S') "
            f"ELSE acc.err END)")
    claim = f"(e.ev = 'claim' AND {st0} = 'new')"
    finish = f"(e.ev IN ('complete', 'failed') AND {st0} = 'progress')"
    reset = f"(e.ev = 'reset' AND {st0} <> 'progress')"
    step = (f"struct_pack(st := CASE WHEN {claim} THEN 'progress' WHEN {finish} THEN e.ev WHEN {reset} THEN 'new' ELSE {st0} END, "
            f"started := CASE WHEN {claim} THEN e.ts WHEN {reset} THEN NULL ELSE acc.started END, "
            f"completed := CASE WHEN {finish} THEN e.ts WHEN {reset} OR {claim} THEN NULL ELSE acc.completed END, "
            f"err := CASE WHEN {reset} THEN '' ELSE {err0} END, "
            f"first_claim := CASE WHEN {claim} AND acc.first_claim IS NULL THEN e.ts ELSE acc.first_claim END, "
            f"last_reset := CASE WHEN {reset} THEN e.ts ELSE acc.last_reset END)")
    zero = ("struct_pack(st := 'new', started := NULL::TIMESTAMP, completed := NULL::TIMESTAMP, err := '', "
            "first_claim := NULL::TIMESTAMP, last_reset := NULL::TIMESTAMP)")
    if timeout and now:
        swept = f"(s.st = 'progress' AND s.started < TIMESTAMP '{now}' - INTERVAL {H} HOUR)"
        status = f"CASE WHEN {swept} THEN 'timeout' ELSE s.st END"
        err = f"CASE WHEN {swept} THEN 'Auto-timeout: started at ' || strftime(s.started, '%Y-%m-%d %H:%M:%S') ELSE s.err END"
    else:
        status, err = "s.st", "s.err"
    return f"""
(WITH ev AS (SELECT user_id AS task_id, ts, event_id AS seq, {_event_sql()} AS ev,
                    {O.month_sql('ts')} AS month, {O.shard_sql('user_id')} AS server FROM events),
 l AS (SELECT task_id, min(month) AS month, min(server) AS server,
              min(ts) FILTER (WHERE ev = 'create') AS created_at,
              list(struct_pack(ts := ts, ev := ev) ORDER BY ts, seq) AS evs FROM ev GROUP BY task_id),
 f AS (SELECT *, list_reduce(list_filter(evs, lambda x: x.ev IN ('claim', 'complete', 'failed', 'reset')),
                             lambda acc, e: {step}, {zero}) AS s FROM l)
 SELECT task_id, month, server, {status} AS status, s.started AS started_at, s.completed AS completed_at,
        {err} AS error_msg, s.first_claim AS first_claim_at, s.last_reset AS last_reset_at, created_at
 FROM f)"""


def _k_sql() -> str:
    return "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def reports_sql() -> str:
    k = _k_sql()
    slot = (f"CASE WHEN {k} = {RL.FAKE_MONTH_K} THEN '999999' "
            f"ELSE strftime(ts + to_hours(CAST(floor(value) AS BIGINT)), '%Y%m') END")
    tpl = "[" + O.sql_str_list(C.TABLE_TEMPLATES) + f"][{k} % 16 + 1]"
    name = (f"CASE WHEN {k} = {RL.MISSING_NAME_K} THEN '' WHEN {k} >= {RL.UNKNOWN_TABLE_K} "
            f"THEN 'z_ranking_detail_' || ({slot}) || '_us' ELSE replace({tpl}, '{{m}}', {slot}) END")
    status = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in RL.STATUS_MAP.items()) + " ELSE '' END"
    reporter = (f"CASE WHEN {k} % 10 = {RL.ANON_REPORTER_MOD} THEN '' WHEN {k} % 10 = {RL.OTHER_REPORTER_MOD} "
                f"THEN {O.shard_sql('(user_id + 1)')} ELSE {O.shard_sql('user_id')} END")
    return f"""
(SELECT event_id AS report_id,
        CASE WHEN {k} = {RL.UNKNOWN_TASK_K} THEN user_id + 1000 ELSE user_id END AS task_id,
        {name} AS table_name, {status} AS status, {reporter} AS server,
        CAST(floor(value) AS BIGINT) AS rows_local,
        CASE WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) - 1 ELSE CAST(floor(value) AS BIGINT) END AS rows_lake,
        CASE WHEN event_type = 'error' THEN 'row count mismatch' ELSE '' END AS error_msg,
        ts, event_id AS seq
 FROM events)"""


def checked_reports_sql() -> str:
    norm = O.sql_str_list(C.normalised_templates())
    st = O.sql_str_list(C.UNIT_STATUSES)
    return f"""
(SELECT r.*, CASE
   WHEN coalesce(r.table_name, '') = '' OR coalesce(r.status, '') = '' THEN 'missing_field'
   WHEN r.status NOT IN ({st}) THEN 'bad_status'
   WHEN regexp_replace(r.table_name, '_\\d{{6}}_', '_YYYYMM_', 'g') NOT IN ({norm}) THEN 'unknown_table'
   WHEN t.month IS NULL THEN 'no_task'
   WHEN regexp_extract(r.table_name, '_(\\d{{6}})_', 1) <> t.month THEN 'wrong_month'
   WHEN trim(coalesce(r.server, '')) <> '' AND trim(r.server) <> t.server THEN 'wrong_server'
 END AS reject_reason
 FROM {reports_sql()} r LEFT JOIN {replay_sql()} t USING (task_id))"""


def latest_units_sql() -> str:
    tpl = O.templates_values_sql()
    return f"""
(WITH t AS {replay_sql()},
 a AS (SELECT * FROM {checked_reports_sql()} WHERE reject_reason IS NULL),
 last AS (SELECT task_id, table_name,
                 arg_max(struct_pack(status := status, rows_local := rows_local, rows_lake := rows_lake,
                                     error_msg := error_msg, ts := ts), struct_pack(ts := ts, seq := seq)) AS r
          FROM a GROUP BY task_id, table_name),
 c AS (SELECT task_id, replace(tpl.template, '{{m}}', month) AS table_name, first_claim_at
       FROM t, {tpl} WHERE first_claim_at IS NOT NULL),
 u AS (SELECT coalesce(c.task_id, last.task_id) AS task_id, coalesce(c.table_name, last.table_name) AS table_name,
              c.first_claim_at, last.r FROM c FULL OUTER JOIN last ON c.task_id = last.task_id AND c.table_name = last.table_name),
 v AS (SELECT u.*, t.last_reset_at,
              (u.r IS NOT NULL AND (t.last_reset_at IS NULL OR u.r.ts > t.last_reset_at)) AS live
       FROM u LEFT JOIN t USING (task_id))
 SELECT task_id, table_name,
        CASE WHEN live THEN r.status ELSE 'pending' END AS status,
        CASE WHEN live THEN r.rows_local ELSE 0 END::BIGINT AS rows_local,
        CASE WHEN live THEN r.rows_lake ELSE 0 END::BIGINT AS rows_lake,
        CASE WHEN live THEN r.error_msg ELSE '' END AS error_msg,
        coalesce(r.ts, first_claim_at) AS updated_at
 FROM v)"""


# ------------------------------------------------------------------ queries

@register("coverage_gate", f"""
WITH g AS (SELECT user_id, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start,
                  list(DISTINCT event_type) FILTER (WHERE event_type IN ('signup', 'purchase', 'view', 'click')) AS have
           FROM events GROUP BY ALL),
m AS (SELECT *, list_sort(list_filter(['signup', 'purchase', 'view', 'click'],
                                      lambda x: NOT list_contains(coalesce(have, []), x))) AS miss FROM g)
SELECT user_id, week_start, len(miss) = 0 AS ready, len(miss)::BIGINT AS n_missing,
       array_to_string(miss, ',') AS missing
FROM m
""")
def coverage_gate(spark, sf_dir):
    """Readiness per (member, week): all of signup/purchase/view/click seen."""
    ev = _events(spark, sf_dir).select(
        "user_id", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week_start"), "event_type")
    return COV.coverage(ev, ["user_id", "week_start"], "event_type", ["signup", "purchase", "view", "click"])


@register("replay_tasks", f"""
SELECT task_id, server, status, {_dtxt('started_at')} AS started_at, {_dtxt('completed_at')} AS completed_at,
       error_msg, {_dtxt('last_reset_at')} AS last_reset_at
FROM {replay_sql()}
""")
def replay_tasks(spark, sf_dir):
    """Task state from the run log, with 48 h timeouts and a sweep at NOW."""
    t = _replay(spark, sf_dir)
    return t.select("task_id", "server", "status", _txt("started_at").alias("started_at"),
                    _txt("completed_at").alias("completed_at"), "error_msg",
                    _txt("last_reset_at").alias("last_reset_at"))


@register("replay_tasks_no_timeout", f"""
SELECT task_id, status, {_dtxt('started_at')} AS started_at, {_dtxt('completed_at')} AS completed_at,
       {_dtxt('first_claim_at')} AS first_claim_at
FROM {replay_sql(timeout=False, now=None)}
""")
def replay_tasks_no_timeout(spark, sf_dir):
    """Task state from the run log without the timeout rule."""
    t = _replay(spark, sf_dir, timeout=False, now=None)
    return t.select("task_id", "status", _txt("started_at").alias("started_at"),
                    _txt("completed_at").alias("completed_at"), _txt("first_claim_at").alias("first_claim_at"))


@register("task_status_counts", f"""
SELECT status, count(*)::BIGINT AS n_tasks FROM {replay_sql()} GROUP BY status
""")
def task_status_counts(spark, sf_dir):
    """Tasks per state after the sweep (39/21/47/29/14 at sf0.01)."""
    return _replay(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("n_tasks"))


@register("overdue_tasks", f"""
SELECT task_id, server, month, 'Auto-timeout: started at ' || strftime(started_at, '%Y-%m-%d %H:%M:%S') AS error_msg,
       'WARNING' AS level
FROM {replay_sql(timeout=True, now=None)}
WHERE status = 'progress' AND started_at < TIMESTAMP '{NOW}' - INTERVAL {H} HOUR
""")
def overdue_tasks(spark, sf_dir):
    """Tasks a sweep at NOW newly times out, one WARNING alert each."""
    from lakeledger.operators import finalize as FZ
    t = _replay(spark, sf_dir, timeout=True, now=None)
    return FZ.timeout_alerts(TK.overdue(t, NOW)).select("task_id", "server", "month", "error_msg", "level")


@register("reports_quality", f"""
SELECT report_id, task_id, table_name, status, server, reject_reason FROM {checked_reports_sql()}
""")
def reports_quality(spark, sf_dir):
    """Unit reports checked in order; reject_reason NULL when accepted."""
    reports = RL.reports_from_events(_events(spark, sf_dir))
    checked = TK.report_checks(reports, _replay(spark, sf_dir))
    return checked.select("report_id", "task_id", "table_name", "status", "server", "reject_reason")


def _latest_units(spark, sf_dir):
    tasks = _replay(spark, sf_dir)
    reports = RL.reports_from_events(_events(spark, sf_dir))
    accepted = TK.report_checks(reports, tasks).where(F.col("reject_reason").isNull())
    return TK.latest_units(accepted, tasks), tasks


@register("latest_unit_status", f"""
SELECT task_id, table_name, status, rows_local, rows_lake, error_msg, {_dtxt('updated_at')} AS updated_at
FROM {latest_units_sql()}
""")
def latest_unit_status(spark, sf_dir):
    """Unit rows: claim-created pending rows, last report wins, reset clears."""
    units, _ = _latest_units(spark, sf_dir)
    return units.select("task_id", "table_name", "status", "rows_local", "rows_lake", "error_msg",
                        _txt("updated_at").alias("updated_at"))


@register("task_nested", f"""
WITH u AS {latest_units_sql()},
p AS (SELECT task_id, count(*)::BIGINT AS n_units,
             string_agg(table_name || ':' || status, ';' ORDER BY table_name) AS units
      FROM u GROUP BY task_id)
SELECT t.task_id, t.status, coalesce(p.n_units, 0)::BIGINT AS n_units, coalesce(p.units, '') AS units
FROM {replay_sql()} t LEFT JOIN p USING (task_id)
""")
def task_nested(spark, sf_dir):
    """Each task with its unit rows sorted by table name (nested, shown as text)."""
    units, tasks = _latest_units(spark, sf_dir)
    nested = TK.task_units_nested(tasks, units)
    arr = F.coalesce(F.col("units"), F.array())
    return nested.select(
        "task_id", "status", F.size(arr).cast("long").alias("n_units"),
        F.array_join(F.transform(arr, lambda u: F.concat(u["table_name"], F.lit(":"), u["status"])), ";")
         .alias("units"))


@register("task_listing", f"""
SELECT task_id, month, server, status, {_dtxt('started_at')} AS started_at
FROM {replay_sql()} WHERE month = '202401' AND status = 'progress'
""")
def task_listing(spark, sf_dir):
    """Tasks filtered by month and status (optional conjunctive filters)."""
    t = TK.list_tasks(_replay(spark, sf_dir), month="202401", status="progress")
    return t.select("task_id", "month", "server", "status", _txt("started_at").alias("started_at"))


LIVENESS_SQL = f"""
(SELECT user_id AS member, max({O.shard_sql('user_id')}) AS server, max(ts) AS last_seen,
        arg_max(event_type, struct_pack(ts := ts, seq := event_id)) AS last_detail,
        coalesce(max(ts) > TIMESTAMP '{LIVENESS_NOW}' - INTERVAL {C.ONLINE_LIMIT_SECONDS} SECOND, FALSE) AS online
 FROM events GROUP BY user_id)"""


@register("liveness", f"""
SELECT member, server, {_dtxt('last_seen')} AS last_seen, last_detail, online FROM {LIVENESS_SQL}
""")
def liveness(spark, sf_dir):
    """Latest heartbeat per member and online flag at LIVENESS_NOW."""
    live = TK.liveness(RL.heartbeats_from_events(_events(spark, sf_dir)), LIVENESS_NOW)
    return live.select("member", "server", _txt("last_seen").alias("last_seen"), "last_detail", "online")


def _board(spark, sf_dir):
    ev = _events(spark, sf_dir)
    roster = ev.select(F.col("user_id").cast("long").alias("member")).distinct()
    live = TK.liveness(RL.heartbeats_from_events(ev), LIVENESS_NOW)
    return TK.fleet_board(roster, _replay(spark, sf_dir), live)


BOARD_SQL = f"""
(SELECT r.member, coalesce(t.status, 'idle') AS status, l.last_seen, coalesce(l.online, FALSE) AS online
 FROM (SELECT DISTINCT user_id AS member FROM events) r
 LEFT JOIN {replay_sql()} t ON t.task_id = r.member
 LEFT JOIN {LIVENESS_SQL} l ON l.member = r.member)"""


@register("fleet_board", f"""
SELECT member, status, {_dtxt('last_seen')} AS last_seen, online FROM {BOARD_SQL}
""")
def fleet_board(spark, sf_dir):
    """Roster with task status (idle when none) and liveness."""
    b = _board(spark, sf_dir)
    return b.select("member", "status", _txt("last_seen").alias("last_seen"), "online")


@register("fleet_kpis", f"""
SELECT count(*)::BIGINT AS n_members,
       count(*) FILTER (WHERE status IN ('complete', 'failed', 'timeout'))::BIGINT AS done,
       count(*) FILTER (WHERE status = 'progress')::BIGINT AS in_progress,
       count(*) FILTER (WHERE online)::BIGINT AS online
FROM {BOARD_SQL}
""")
def fleet_kpis(spark, sf_dir):
    """Done / in progress / online counts over the board."""
    return TK.fleet_kpis(_board(spark, sf_dir))


# --- ledger operators over orders: task = order, status from o_orderstatus ---

ORDER_STATUS = {"O": "new", "P": "progress", "F": "complete"}


def _order_tasks(spark, sf_dir):
    o = S.read_source(spark, sf_dir, "orders")
    st = F.coalesce(*[F.when(F.col("o_orderstatus") == k, v) for k, v in ORDER_STATUS.items()])
    return o.select(F.col("o_orderkey").alias("task_id"), C.month_of("o_orderdate").alias("month"),
                    C.shard_of("o_orderkey").alias("server"), st.alias("status"),
                    F.col("o_orderdate").alias("created_at"))


def _order_tasks_sql() -> str:
    st = "CASE o_orderstatus " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ORDER_STATUS.items()) + " END"
    return (f"(SELECT o_orderkey AS task_id, {O.month_sql('o_orderdate')} AS month, {O.shard_sql('o_orderkey')} AS server, "
            f"{st} AS status, o_orderdate AS created_at FROM orders)")


@register("next_task", f"""
SELECT server, min(struct_pack(month := month, task_id := task_id)).month AS month,
       min(struct_pack(month := month, task_id := task_id)).task_id AS task_id
FROM {_order_tasks_sql()} WHERE status = 'new' GROUP BY server
""")
def next_task(spark, sf_dir):
    """Head of each server's backlog: first new task by (month, task_id)."""
    return TK.head_of_backlog(_order_tasks(spark, sf_dir))


@register("latest_month", f"""
SELECT month, {_dtxt('created_at')} AS created_at FROM {_order_tasks_sql()}
ORDER BY created_at DESC, month DESC LIMIT 1
""")
def latest_month(spark, sf_dir):
    """Most recent period by creation time (top-1)."""
    t = TK.latest_period(_order_tasks(spark, sf_dir))
    return t.select("month", _txt("created_at").alias("created_at"))


@register("create_if_absent", f"""
WITH plan AS (SELECT m.month, printf('srv-%03d', s.i) AS server
              FROM (SELECT DISTINCT {O.month_sql('o_orderdate')} AS month FROM orders) m, range(1, 13) s(i)
              WHERE regexp_full_match(m.month, '{C.MONTH_PATTERN}')),
ex AS (SELECT DISTINCT month FROM {_order_tasks_sql()} WHERE status = 'complete' AND server = 'srv-001')
SELECT month, server FROM plan WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.month = plan.month)
""")
def create_if_absent(spark, sf_dir):
    """Tasks to create: months with no task yet.  Existing ledger: the
    complete orders of shard srv-001; one existing task blocks its month."""
    t = _order_tasks(spark, sf_dir)
    plan = (t.select("month").distinct().where(C.valid_month("month"))
            .select("month", F.explode(C.roster_array()).alias("server")))
    existing = t.where((F.col("status") == "complete") & (F.col("server") == "srv-001"))
    return TK.create_if_absent(plan, existing)


@register("insert_ignore", f"""
WITH p AS (SELECT DISTINCT o.month, o.server, replace(tpl.template, '{{m}}', o.month) AS table_name
           FROM {_order_tasks_sql()} o, {O.templates_values_sql()} WHERE o.status = 'progress'),
ex AS (SELECT DISTINCT month, server, replace([{O.sql_str_list(C.TABLE_TEMPLATES)}][task_id % 16 + 1], '{{m}}', month) AS table_name
       FROM {_order_tasks_sql()} WHERE status = 'complete')
SELECT month, server, table_name FROM p
WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.month = p.month AND ex.server = p.server AND ex.table_name = p.table_name)
""")
def insert_ignore(spark, sf_dir):
    """Unit rows to insert for claimed (in-progress) tasks, minus unit rows
    that exist (one per complete order, table = template of key mod 16)."""
    t = _order_tasks(spark, sf_dir)
    proposed = (t.where(F.col("status") == "progress")
                .select("month", "server", F.explode(C.templates_array()).alias("_tpl"))
                .select("month", "server", C.table_name_for(F.col("_tpl"), F.col("month")).alias("table_name"))
                .distinct())
    tpl = F.element_at(C.templates_array(), (F.pmod("task_id", F.lit(16)) + 1).cast("int"))
    existing = (t.where(F.col("status") == "complete")
                .select("month", "server", C.table_name_for(tpl, F.col("month")).alias("table_name")))
    return TK.insert_ignore(proposed, existing, ["month", "server", "table_name"])


# --- ordering, transitions, dispatch and voided records ---

@register("task_listing_ordered", f"""
SELECT task_id, month, server, status,
       row_number() OVER (PARTITION BY month ORDER BY server, task_id)::INTEGER AS place
FROM {replay_sql()}
""")
def task_listing_ordered(spark, sf_dir):
    """All tasks with their place in the month's listing (server, task)."""
    t = TK.ordered_listing(_replay(spark, sf_dir), "server")
    return t.select("task_id", "month", "server", "status", "place")


REQUEST_STATUS = {"purchase": "complete", "error": "failed", "view": "progress", "click": "new", "signup": "done"}
_REQUEST_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REQUEST_STATUS.items())


@register("task_transitions", f"""
WITH q AS (SELECT event_id, CASE WHEN k = {RL.UNKNOWN_TASK_K} THEN user_id + 1000 ELSE user_id END AS task_id,
                  CASE k % 10 WHEN {RL.ANON_REPORTER_MOD} THEN '' WHEN {RL.OTHER_REPORTER_MOD}
                       THEN {O.shard_sql('(user_id + 1)')} ELSE {O.shard_sql('user_id')} END AS server,
                  CASE event_type {_REQUEST_CASES} ELSE '' END AS status
           FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events))
SELECT q.event_id, q.task_id, q.server, q.status,
       CASE WHEN q.server = '' THEN 'missing_server'
            WHEN q.status NOT IN ({O.sql_str_list(C.TASK_STATUSES)}) THEN 'bad_status'
            WHEN t.status IS NULL THEN 'no_task' WHEN q.server <> t.server THEN 'wrong_server'
            WHEN q.status = 'new' AND t.status = 'progress' THEN 'in_progress'
            WHEN q.status = 'progress' AND t.status <> 'new' THEN 'not_new'
            WHEN q.status IN ({O.sql_str_list(C.TERMINAL_TASK_STATUSES)}) AND t.status <> 'progress'
            THEN 'not_in_progress' END AS reject_reason
FROM q LEFT JOIN {replay_sql()} t ON t.task_id = q.task_id
""")
def task_transitions(spark, sf_dir):
    """Status requests built from the events, checked against the tasks."""
    k = F.get_json_object("props", "$.k").cast("int")
    server = (F.when(F.pmod(k, F.lit(10)) == RL.ANON_REPORTER_MOD, "")
              .when(F.pmod(k, F.lit(10)) == RL.OTHER_REPORTER_MOD, C.shard_of(F.col("user_id") + 1))
              .otherwise(C.shard_of("user_id")))
    status = F.coalesce(*[F.when(F.col("event_type") == a, b) for a, b in REQUEST_STATUS.items()], F.lit(""))
    requests = _events(spark, sf_dir).select(
        "event_id", F.when(k == RL.UNKNOWN_TASK_K, F.col("user_id") + 1000).otherwise(F.col("user_id")).alias("task_id"),
        server.alias("server"), status.alias("status"))
    return (TK.task_transitions(requests, _replay(spark, sf_dir))
            .select("event_id", "task_id", "server", "status", "reject_reason"))


FEED_CODES = dict(zip("1234", C.REQUIRED_FEEDS, strict=True))  # by the digit of the order priority
FEED_EVERY = 50                                                # every so many customers report a feed


@register("dispatch_plan", f"""
WITH f AS (SELECT strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y%m') AS month,
                  CASE substr(o_orderpriority, 1, 1) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in FEED_CODES.items())}
                  END AS code FROM orders WHERE o_custkey % {FEED_EVERY} = 0),
g AS (SELECT month, count(DISTINCT code) = {len(FEED_CODES)} AS ready FROM f GROUP BY month)
SELECT month, ready, CASE WHEN ready THEN {C.SHARD_COUNT * len(C.TABLE_TEMPLATES)} ELSE 0 END::BIGINT AS n_units FROM g
""")
def dispatch_plan(spark, sf_dir):
    """The dispatch chain: the month before each run date, its feeds, the gate,
    and the units planned for months that pass it."""
    run_date = F.add_months(F.trunc("o_orderdate", "MM"), 1)
    code = F.coalesce(*[F.when(F.substring("o_orderpriority", 1, 1) == k, v) for k, v in FEED_CODES.items()])
    feeds = (S.read_source(spark, sf_dir, "orders").where(F.pmod("o_custkey", F.lit(FEED_EVERY)) == 0)
             .select(C.previous_month(run_date).alias("month"), code.alias("code")))
    gate = COV.coverage(feeds, ["month"], "code", C.REQUIRED_FEEDS)
    planned = export.plan_units(gate.where("ready")).groupBy("month").agg(F.count("*").alias("n_units"))
    return gate.join(planned, "month", "left").select(
        "month", "ready", F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"))


FINALIZED_AT = "2024-01-29 00:00:00"


@register("finalize_after_reset", f"""
SELECT server, NOT coalesce(max(last_reset_at) > TIMESTAMP '{FINALIZED_AT}', FALSE) AS holds
FROM {replay_sql()} GROUP BY server
""")
def finalize_after_reset(spark, sf_dir):
    """Records of all shards made at FINALIZED_AT: void where a task of the
    shard was reset afterwards."""
    tasks = _replay(spark, sf_dir)
    log = tasks.select("server").distinct().withColumn("created_at", F.lit(FINALIZED_AT).cast("timestamp_ntz"))
    holds = TK.live_records(log, tasks, "server").select("server", F.lit(True).alias("holds"))
    return log.join(holds, "server", "left").select("server", F.coalesce("holds", F.lit(False)).alias("holds"))


# --- readiness feed: events as feed rows -------------------------------------

_CODES = len(C.REQUIRED_FEEDS)
_FEED_SQL = f"""
(SELECT CASE WHEN user_id % 2 = 0 THEN {C.READINESS_FEED_TYPE} ELSE {C.READINESS_FEED_TYPE + 1} END AS feed_type,
        {O.month_sql('ts')} AS feed_month, [{O.sql_str_list(C.REQUIRED_FEEDS)}][event_id % {_CODES} + 1] AS code
 FROM events WHERE user_id % 2 = 0 OR event_id % {_CODES} <> 0)"""
#: (month, feed type): all codes there, one missing, a month without rows
_GATES = [("202401", C.READINESS_FEED_TYPE), ("202401", C.READINESS_FEED_TYPE + 1), ("209901", C.READINESS_FEED_TYPE)]


@register("readiness_gate", " UNION ALL ".join(f"""
SELECT month, feed_type, len(miss) = 0 AS ready, len(miss)::BIGINT AS n_missing, array_to_string(miss, ',') AS missing
FROM (SELECT '{m}' AS month, {t} AS feed_type, list_sort(list_filter([{O.sql_str_list(C.REQUIRED_FEEDS)}],
             lambda x: NOT list_contains(have, x))) AS miss
      FROM (SELECT coalesce(list(DISTINCT code), []) AS have FROM {_FEED_SQL}
            WHERE feed_type = {t} AND feed_month = '{m}'))""" for m, t in _GATES))
def readiness_gate(spark, sf_dir):
    """The dispatch gate of a month over a readiness feed; type and month are
    filtered in the scan."""
    from lakeledger.session import new_run_dir
    own = F.col("user_id") % 2 == 0
    feed = _events(spark, sf_dir).where(own | (F.col("event_id") % _CODES != 0)).select(
        F.when(own, C.READINESS_FEED_TYPE).otherwise(C.READINESS_FEED_TYPE + 1).alias("feed_type"),
        C.month_of("ts").alias("feed_month"),
        F.element_at(F.array(*map(F.lit, C.REQUIRED_FEEDS)), (F.col("event_id") % _CODES + 1).cast("int")).alias("code"))
    path = new_run_dir(spark, "feed") + "/t"
    feed.write.parquet(path)
    feed, out = spark.read.schema(feed.schema).parquet(path), None
    for month, kind in _GATES:
        one = COV.readiness(feed, month, feed_type=kind).withColumn("feed_type", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out.select("month", "feed_type", "ready", "n_missing", "missing")


# --- a ledger in which every state and decision occurs: period = customer ---

LEDGER_EXPECTED = 10

_LEDGER_SQL = """
(SELECT o_orderkey AS task_id, o_custkey AS period, 'order-' || o_orderkey AS server,
        CASE WHEN o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) = '1' THEN 'timeout'
             WHEN o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) = '2' THEN 'failed'
             WHEN o_orderstatus = 'F' OR o_custkey % 3 = 0 THEN 'complete'
             WHEN o_orderstatus = 'O' THEN 'new' ELSE 'progress' END AS status FROM orders)"""


def _ledger(spark, sf_dir):
    """Orders as tasks of their customer: open orders are new or in progress
    (done for every third customer), finished ones end by their priority."""
    done, urgency = F.col("o_orderstatus") == "F", F.substring("o_orderpriority", 1, 1)
    status = (F.when(done & (urgency == "1"), "timeout").when(done & (urgency == "2"), "failed")
              .when(done | (F.pmod("o_custkey", F.lit(3)) == 0), "complete")
              .when(F.col("o_orderstatus") == "O", "new").otherwise("progress"))
    return S.read_source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("period"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("server"), status.alias("status"))


def _ledger_log(spark, sf_dir):
    return _ledger(spark, sf_dir).select("period").distinct().where(F.pmod("period", F.lit(2)) == 0)


@register("cycle_states_ledger", f"""
WITH g AS (SELECT period, count(*)::BIGINT AS n_tasks,
                  bool_and(status IN ('complete', 'failed', 'timeout')) AS done,
                  bool_or(status = 'progress') AS p, bool_or(status = 'new') AS n, bool_or(status = 'timeout') AS t,
                  list_sort(list(server) FILTER (WHERE status IN ('failed', 'timeout'))) AS failed
           FROM {_LEDGER_SQL} GROUP BY period)
SELECT period, n_tasks, done AND n_tasks = {LEDGER_EXPECTED} AS complete_set,
       CASE WHEN done AND n_tasks = {LEDGER_EXPECTED} AND period % 2 = 0 THEN 'finalized'
            WHEN done AND n_tasks = {LEDGER_EXPECTED} THEN 'ready_for_finalize' WHEN p THEN 'running'
            WHEN n THEN 'dispatched' WHEN t THEN 'stalled' ELSE 'idle' END AS cycle_state,
       coalesce(array_to_string(failed, ','), '') AS failed
FROM g
""")
def cycle_states_ledger(spark, sf_dir):
    """Cycle state of every customer's orders; all six states occur."""
    got = TK.cycle_state(_ledger(spark, sf_dir), "period", LEDGER_EXPECTED, _ledger_log(spark, sf_dir))
    return got.select("period", "n_tasks", "complete_set", "cycle_state", F.array_join("failed", ",").alias("failed"))


@register("finalize_decisions", f"""
WITH g AS (SELECT period, count(*)::BIGINT AS n_tasks,
                  count(*) FILTER (WHERE status NOT IN ('complete', 'failed', 'timeout'))::BIGINT AS n_not_done,
                  count(*) FILTER (WHERE status IN ('failed', 'timeout'))::BIGINT AS n_failed
           FROM {_LEDGER_SQL} GROUP BY period)
SELECT *, CASE WHEN n_tasks <> {LEDGER_EXPECTED} THEN 'not_all_created' WHEN n_not_done > 0 THEN 'not_all_done'
               WHEN n_failed > 0 THEN 'partial_failure' ELSE 'compare' END AS decision
FROM g WHERE period % 2 <> 0
""")
def finalize_decisions(spark, sf_dir):
    """What finalizing decides for every customer without a record."""
    from lakeledger.operators import finalize as FZ
    return FZ.decide(_ledger(spark, sf_dir), LEDGER_EXPECTED, _ledger_log(spark, sf_dir), "period")


@register("fleet_board_all", f"""
SELECT r.c_custkey AS member, coalesce(t.status, 'idle') AS status, {_dtxt('l.last_seen')} AS last_seen,
       coalesce(l.online, FALSE) AS online
FROM customer r LEFT JOIN {replay_sql()} t ON t.task_id = r.c_custkey LEFT JOIN {LIVENESS_SQL} l ON l.member = r.c_custkey
""")
def fleet_board_all(spark, sf_dir):
    """The board over all customers: those without a task are idle."""
    live = TK.liveness(RL.heartbeats_from_events(_events(spark, sf_dir)), LIVENESS_NOW)
    roster = S.read_source(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member"))
    b = TK.fleet_board(roster, _replay(spark, sf_dir), live)
    return b.select("member", "status", _txt("last_seen").alias("last_seen"), "online")
