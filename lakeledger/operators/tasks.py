"""Run-log analytics: replay the task state machine, unit status, liveness,
overdue tasks, listings, fleet board and cycle state.

State machine (per task, events in (ts, seq) order):

* new --claim--> progress (started_at = ts)
* progress --complete--> complete, --failed--> failed (completed_at = ts)
* any state but progress --reset--> new (times and error cleared)
* anything else is ignored; the first claim wins.
* timeout: before each event, a task in progress whose started_at is more
  than ``timeout_hours`` before the event becomes ``timeout`` (no
  completion time; a later complete/failed is refused); the same test runs
  once more at ``now`` after the last event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions import catalog as C
from lakeledger.session import new_run_dir

_KIND = {"claim": "C", "complete": "T", "failed": "T", "reset": "R"}
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def _hours(h: int) -> Column:
    return F.expr(f"INTERVAL {int(h)} HOURS")


def first_deliveries(log: DataFrame) -> DataFrame:
    """The one rule for redeliveries, in batch and stream: of the events of a
    task with the same ``seq`` the earliest by ``ts`` counts.  The result is
    partitioned by task, which the replay's windows reuse."""
    first = F.expr("row_number() OVER (PARTITION BY task_id, seq ORDER BY ts, event)")
    return log.repartition("task_id").withColumn("_n", first).where("_n = 1").drop("_n")


def _with_keep(log: DataFrame) -> DataFrame:
    """Add ``_keep``: the event can still change the task's state.

    Exact reductions (checked against a brute-force fold in the tests and
    against the full fold by the oracle):

    * ``create`` and unknown events never act;
    * of a run of consecutive claims only the first can act and only the last
      can still see a timeout, of a run of complete/failed only the first can
      act, of a run of resets only the last matters (it sees the latest
      timeout);
    * after a complete/failed no task is in progress, so a reset directly after
      it leaves ``new`` whatever came before: all events before the last such
      reset are cut.  (The first claim of a log always acts; it is kept as an
      aggregate.)

    So redelivery storms, repeated claims and finished cycles, the usual causes
    of a hot task, never reach the per-task array.

    The window passes share the (task; ts, seq) sort and stream the partition,
    spilling as needed.
    """
    order = "PARTITION BY task_id ORDER BY ts, seq"
    kind = F.coalesce(*[F.when(F.col("event") == e, k) for e, k in _KIND.items()])
    staged = first_deliveries(log).withColumn("_kind", kind)
    k = F.col("_kind")
    staged = (staged.withColumn("_prev", F.expr(f"lag(_kind) IGNORE NULLS OVER ({order})"))
              .withColumn("_next", F.expr(f"lead(_kind) IGNORE NULLS OVER ({order})")))
    cycle_end = F.when((k == "R") & (F.col("_prev") == "T"), F.struct("ts", "seq"))
    staged = staged.withColumn("_end", cycle_end).withColumn(
        "_cut", F.expr("max(_end) OVER (PARTITION BY task_id)"))
    first_of_run = F.col("_prev").isNull() | (F.col("_prev") != k)
    last_of_run = F.col("_next").isNull() | (F.col("_next") != k)
    keep = (F.when(k == "R", last_of_run | F.col("_end").isNotNull())
             .when(k == "C", first_of_run | last_of_run)
             .otherwise(first_of_run))
    live = F.col("_cut").isNull() | (F.struct("ts", "seq") >= F.col("_cut"))
    return staged.withColumn("_keep", k.isNotNull() & keep & live).drop("_kind", "_prev", "_next", "_end", "_cut")


def state_events(log: DataFrame) -> DataFrame:
    """The events that can change a task's state (see :func:`_with_keep`)."""
    return _with_keep(log).where("_keep").drop("_keep")


def _fold_step(timeout_hours: int | None):
    def step(acc: Column, e: Column) -> Column:
        if timeout_hours is None:
            timed = F.lit(False)
        else:
            timed = (acc["st"] == "progress") & (acc["started"] < e["ts"] - _hours(timeout_hours))
        st0 = F.when(timed, F.lit("timeout")).otherwise(acc["st"])
        err0 = F.when(timed, F.concat(F.lit("Auto-timeout: started at "),
                                      F.date_format(acc["started"], TS_TEXT))).otherwise(acc["err"])
        ev = e["event"]
        claim = (ev == "claim") & (st0 == "new")
        finish = ev.isin("complete", "failed") & (st0 == "progress")
        reset = (ev == "reset") & (st0 != "progress")
        return F.struct(
            F.when(claim, F.lit("progress")).when(finish, ev).when(reset, F.lit("new"))
             .otherwise(st0).alias("st"),
            F.when(claim, e["ts"]).when(reset, F.lit(None)).otherwise(acc["started"]).alias("started"),
            F.when(finish, e["ts"]).when(reset | claim, F.lit(None)).otherwise(acc["completed"]).alias("completed"),
            F.when(reset, F.lit("")).otherwise(err0).alias("err"),
            F.when(reset, e["ts"]).otherwise(acc["last_reset"]).alias("last_reset"),
            F.when(reset, e["seq"]).otherwise(acc["reset_seq"]).alias("reset_seq"),
        )
    return step


def replay_tasks(log: DataFrame, *, timeout_hours: int | None = C.TASK_TIMEOUT_HOURS,
                 now: str | None = None) -> DataFrame:
    """Current state of every task in the log.

    ``now`` (text timestamp) runs the final timeout sweep; leave it out to
    see the state as of the last event (used by :func:`overdue`).
    Output: task_id, month, server, status, started_at, completed_at,
    error_msg, first_claim_at, last_reset_at, last_reset_seq, created_at.
    """
    tnull = F.lit(None).cast("timestamp_ntz")
    zero = F.struct(F.lit("new").alias("st"), tnull.alias("started"), tnull.alias("completed"),
                    F.lit("").alias("err"), tnull.alias("last_reset"), F.lit(None).cast("long").alias("reset_seq"))
    # One shuffle: the windows partition by task_id, and the aggregate on the
    # same key reuses that partitioning.  collect_list skips NULLs, so only
    # the reduced state events reach the array.
    keep = F.col("_keep")
    per_task = (_with_keep(log)
                .groupBy("task_id")
                .agg(F.min("month").alias("month"), F.min("server").alias("server"),
                     F.min(F.when(F.col("event") == "create", F.col("ts"))).alias("created_at"),
                     F.min(F.when(F.col("event") == "claim", F.col("ts"))).alias("first_claim"),
                     F.array_sort(F.collect_list(F.when(keep, F.struct("ts", "seq", "event"))))
                      .alias("evs")))
    folded = per_task.select("task_id", "month", "server", "created_at", "first_claim",
                             F.aggregate("evs", zero, _fold_step(timeout_hours)).alias("s"))
    s = F.col("s")
    status, err = F.coalesce(s["st"], F.lit("new")), F.coalesce(s["err"], F.lit(""))
    if now is not None and timeout_hours is not None:
        swept = (status == "progress") & (s["started"] < F.lit(now).cast("timestamp_ntz") - _hours(timeout_hours))
        err = F.when(swept, F.concat(F.lit("Auto-timeout: started at "),
                                     F.date_format(s["started"], TS_TEXT))).otherwise(err)
        status = F.when(swept, F.lit("timeout")).otherwise(status)
    return (folded
            .select("task_id", "month", "server", status.alias("status"),
                    s["started"].alias("started_at"), s["completed"].alias("completed_at"),
                    err.alias("error_msg"), F.col("first_claim").alias("first_claim_at"),
                    s["last_reset"].alias("last_reset_at"), s["reset_seq"].alias("last_reset_seq"), "created_at"))


def timeout_history(log: DataFrame, *, now: str, timeout_hours: int = C.TASK_TIMEOUT_HOURS) -> DataFrame:
    """Every timeout in the log up to a sweep at ``now``, one row each:
    task_id, server, month (of the claim that started it) and started_at.  A
    task that is reset can time out again."""
    limit = F.expr(f"INTERVAL {int(timeout_hours)} HOURS")
    acting = first_deliveries(log.where(F.col("event").isin(*_KIND)))
    event = F.struct(F.col("ts").cast("timestamp_ntz").alias("ts"), "seq", "event", "month", "server")
    per = acting.groupBy("task_id").agg(F.array_sort(F.collect_list(event)).alias("evs"))
    # the sweep is one more event, which acts on nothing but a task in progress
    sweep = F.struct(F.lit(now).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("long").alias("seq"),
                     F.lit("sweep").alias("event"), F.lit(None).cast("string").alias("month"),
                     F.lit(None).cast("string").alias("server"))
    start = "struct<ts:timestamp_ntz,month:string,server:string>"
    zero = F.struct(F.lit("new").alias("st"), F.lit(None).cast(start).alias("on"),
                    F.array().cast(f"array<{start}>").alias("out"))

    def step(acc: Column, e: Column) -> Column:
        timed = (acc["st"] == "progress") & (acc["on"]["ts"] < e["ts"] - limit)
        st = F.when(timed, F.lit("timeout")).otherwise(acc["st"])
        claim = (e["event"] == "claim") & (st == "new")
        finish = e["event"].isin("complete", "failed") & (st == "progress")
        reset = (e["event"] == "reset") & (st != "progress")
        return F.struct(
            F.when(claim, F.lit("progress")).when(finish, e["event"]).when(reset, F.lit("new")).otherwise(st).alias("st"),
            F.when(claim, F.struct(e["ts"].alias("ts"), e["month"].alias("month"), e["server"].alias("server")))
             .otherwise(acc["on"]).alias("on"),
            F.when(timed, F.array_append(acc["out"], acc["on"])).otherwise(acc["out"]).alias("out"))

    folded = per.select("task_id", F.aggregate(F.array_append("evs", sweep), zero, step)["out"].alias("out"))
    return folded.select("task_id", F.explode("out").alias("o")).select(
        "task_id", "o.server", "o.month", F.col("o.ts").alias("started_at"))


def overdue(tasks: DataFrame, now: str, timeout_hours: int = C.TASK_TIMEOUT_HOURS) -> DataFrame:
    """Tasks in progress that started strictly before now - timeout: the ones
    a sweep at ``now`` newly turns into ``timeout`` (one alert each)."""
    cutoff = F.lit(now).cast("timestamp_ntz") - _hours(timeout_hours)
    return tasks.where((F.col("status") == "progress") & (F.col("started_at") < cutoff))


def report_checks(reports: DataFrame, tasks: DataFrame) -> DataFrame:
    """Validate unit reports; ``reject_reason`` is NULL for accepted ones.

    Checks in fixed order, first failure wins: missing field, bad status,
    unknown table, no task, wrong month (the name's month must be the
    task's), wrong server (only when the reporter names itself).  The task
    side is a plain join: AQE broadcasts it at run time when it is small
    and keeps a shuffle join when it is not.
    """
    t = tasks.select("task_id", F.col("month").alias("_t_month"), F.col("server").alias("_t_server"))
    j = reports.join(t, "task_id", "left")
    name, status = F.coalesce("table_name", F.lit("")), F.coalesce("status", F.lit(""))
    reporter = F.trim(F.coalesce("server", F.lit("")))
    reason = (F.when((name == "") | (status == ""), "missing_field")
               .when(~status.isin(C.UNIT_STATUSES), "bad_status")
               .when(~C.known_table(name), "unknown_table")
               .when(F.col("_t_month").isNull(), "no_task")
               .when(C.month_in_name(name) != F.col("_t_month"), "wrong_month")
               .when((reporter != "") & (reporter != F.col("_t_server")), "wrong_server"))
    return j.withColumn("reject_reason", reason).drop("_t_month", "_t_server")


def latest_units(accepted: DataFrame, tasks: DataFrame) -> DataFrame:
    """Unit rows per (task, table): last report wins by (ts, seq).

    A claim creates pending rows for the task's 16 tables unless a row
    exists; a reset after a unit's last report turns it back to pending
    with zero counts, keeping its update time.  The 16 rows per claimed
    task come from a fixed-size literal, exploded in a projection.
    """
    last = accepted.groupBy("task_id", "table_name").agg(
        F.max_by(F.struct("status", "rows_local", "rows_lake", "error_msg", "ts", "seq"),
                 F.struct("ts", "seq")).alias("r"))
    claimed = (tasks.where(F.col("first_claim_at").isNotNull())
               .select("task_id", "month", "first_claim_at",
                       F.explode(C.templates_array()).alias("_tpl"))
               .select("task_id", C.table_name_for(F.col("_tpl"), F.col("month")).alias("table_name"),
                       "first_claim_at"))
    rows = claimed.join(last, ["task_id", "table_name"], "full_outer")
    rows = rows.join(tasks.select("task_id", "last_reset_at", "last_reset_seq"), "task_id", "left")
    r = F.col("r")
    # a report and a reset at the same instant are ordered by seq, as all events
    after = F.struct(r["ts"], r["seq"]) > F.struct(F.col("last_reset_at"), F.col("last_reset_seq"))
    live = r.isNotNull() & (F.col("last_reset_at").isNull() | after)
    return rows.select(
        "task_id", "table_name",
        F.when(live, r["status"]).otherwise(F.lit("pending")).alias("status"),
        F.when(live, r["rows_local"]).otherwise(F.lit(0).cast("long")).alias("rows_local"),
        F.when(live, r["rows_lake"]).otherwise(F.lit(0).cast("long")).alias("rows_lake"),
        F.when(live, r["error_msg"]).otherwise(F.lit("")).alias("error_msg"),
        F.coalesce(r["ts"], F.col("first_claim_at")).alias("updated_at"),
    )


def list_tasks(tasks: DataFrame, month: str | None = None, server: str | None = None,
               status: str | None = None) -> DataFrame:
    """Optional conjunctive filter; the caller sorts at the report edge."""
    out = tasks
    for col, val in (("month", month), ("server", server), ("status", status)):
        if val:
            out = out.where(F.col(col) == val)
    return out


def task_units_nested(tasks: DataFrame, units: DataFrame) -> DataFrame:
    """Each task with its unit rows, sorted by table name (bounded by the
    16-table catalog per task)."""
    per = units.groupBy("task_id").agg(
        F.array_sort(F.collect_list(F.struct("table_name", "status", "rows_local", "rows_lake")))
         .alias("units"))
    return tasks.join(per, "task_id", "left")


def liveness(beats: DataFrame, now: str, limit_seconds: int = C.ONLINE_LIMIT_SECONDS) -> DataFrame:
    """Latest heartbeat per member, and online = last seen strictly less
    than ``limit_seconds`` before now (a future last_seen is online).
    ``max``/``max_by`` aggregate partially before the shuffle."""
    last = beats.groupBy("member").agg(
        F.max("server").alias("server"),
        F.max("ts").alias("last_seen"),
        F.max_by("detail", F.struct("ts", "seq")).alias("last_detail"))
    now_c = F.lit(now).cast("timestamp_ntz")
    online = F.coalesce(F.col("last_seen") > now_c - F.expr(f"INTERVAL {int(limit_seconds)} SECONDS"),
                        F.lit(False))
    return last.withColumn("online", online)


def liveness_of_text(members: DataFrame, now: str, limit_seconds: int = C.ONLINE_LIMIT_SECONDS) -> DataFrame:
    """(member, last_seen text) with online by the rule of :func:`liveness`; a
    text that is no timestamp, and NULL, are offline."""
    seen = F.try_to_timestamp("last_seen").cast("timestamp_ntz")
    limit = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(limit_seconds)} SECONDS")
    return members.withColumn("online", F.coalesce(seen > limit, F.lit(False)))


def task_transitions(requests: DataFrame, tasks: DataFrame) -> DataFrame:
    """Check status requests (task_id, server, status) against current tasks;
    ``reject_reason`` is NULL for accepted ones, the first failure wins:
    missing_server, bad_status (outside the task domain), no_task,
    wrong_server (not the task's), in_progress (a reset of a running task),
    not_new (a claim of a taken one), not_in_progress (an end of one that does
    not run)."""
    t = tasks.select("task_id", F.col("server").alias("_t_server"), F.col("status").alias("_t_status"))
    j = requests.join(t, "task_id", "left")
    server, status = F.trim(F.coalesce("server", F.lit(""))), F.coalesce("status", F.lit(""))
    now = F.col("_t_status")
    reason = (F.when(server == "", "missing_server")
               .when(~status.isin(C.TASK_STATUSES), "bad_status")
               .when(now.isNull(), "no_task")
               .when(server != F.col("_t_server"), "wrong_server")
               .when((status == "new") & (now == "progress"), "in_progress")
               .when((status == "progress") & (now != "new"), "not_new")
               .when(status.isin(C.TERMINAL_TASK_STATUSES) & (now != "progress"), "not_in_progress"))
    return j.withColumn("reject_reason", reason).drop("_t_server", "_t_status")


def ordered_listing(tasks: DataFrame, *order: str, group: str = "month") -> DataFrame:
    """The listing with its order as a column: ``place`` is the task's place
    within its group, so the order survives any later shuffle.

    A group with most of the rows is not sorted in one task: the rows are range
    partitioned by (group, order, task_id) and stored in that order; a row's
    place is its place in its partition, less that of the group's first row
    there, plus the rows that the group has in the partitions before.  Only
    these counts, one for each group in each partition, meet in a window.  Rows
    that are equal in all of these keys are placed in any order.
    """
    keys = [group, *order, "task_id"]
    rows = tasks.repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = new_run_dir(tasks.sparkSession, "listing") + "/t"
    at = F.monotonically_increasing_id()  # partition << 33 | place in it
    rows = rows.select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    rows.write.parquet(path)
    rows = tasks.sparkSession.read.schema(rows.schema).parquet(path)
    counts = rows.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part")) - F.col("_n")
    counts = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), (before - F.col("_first") + 1).alias("_add"))
    out = rows.join(counts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return out.select(*tasks.columns, (F.col("_at") + F.col("_add")).cast("int").alias("place"))


def fleet_board(roster: DataFrame, tasks: DataFrame, live: DataFrame) -> DataFrame:
    """Roster with each member's task and heartbeat; no task -> idle."""
    return (roster.join(tasks.select(F.col("task_id").alias("member"), "status"), "member", "left")
            .join(live.select("member", "last_seen", "online"), "member", "left")
            .select("member", F.coalesce("status", F.lit("idle")).alias("status"),
                    "last_seen", F.coalesce("online", F.lit(False)).alias("online")))


def fleet_kpis(board: DataFrame) -> DataFrame:
    """Done counts failed and timeout too."""
    return board.agg(
        F.count(F.lit(1)).cast("long").alias("n_members"),
        F.count_if(F.col("status").isin(C.TERMINAL_TASK_STATUSES)).cast("long").alias("done"),
        F.count_if(F.col("status") == "progress").cast("long").alias("in_progress"),
        F.count_if(F.col("online")).cast("long").alias("online"))


def live_records(finalized: DataFrame, tasks: DataFrame, period: str) -> DataFrame:
    """Finalize records that still hold: one made before the last accepted
    reset of any task of its period is void.  Logs without created_at and
    tasks without last_reset_at have nothing to compare."""
    if "created_at" not in finalized.columns or "last_reset_at" not in tasks.columns:
        return finalized
    reset = tasks.groupBy(F.col(period).alias("_p")).agg(F.max("last_reset_at").alias("_reset"))
    void = (F.col(period) == F.col("_p")) & (F.col("created_at") < F.col("_reset"))
    return finalized.join(reset, void, "left_anti")


def cycle_state(tasks: DataFrame, period: str, expected: int,
                finalized: DataFrame | None = None) -> DataFrame:
    """Per period: idle / dispatched / running / stalled /
    ready_for_finalize / finalized, by precedence.  A full set (exactly
    ``expected`` tasks, all terminal) is decided first; a short set of only
    complete/failed is idle."""
    g = tasks.groupBy(period).agg(
        F.count(F.lit(1)).cast("long").alias("n_tasks"),
        F.bool_and(F.col("status").isin(C.TERMINAL_TASK_STATUSES)).alias("_all_done"),
        F.bool_or(F.col("status") == "progress").alias("_any_progress"),
        F.bool_or(F.col("status") == "new").alias("_any_new"),
        F.bool_or(F.col("status") == "timeout").alias("_any_timeout"),
        F.array_sort(F.collect_list(F.when(~F.col("status").isin(C.TERMINAL_TASK_STATUSES),
                                           F.col("server")))).alias("pending"),
        F.array_sort(F.collect_list(F.when(F.col("status").isin("failed", "timeout"),
                                           F.col("server")))).alias("failed"))
    if finalized is not None:
        live = live_records(finalized, tasks, period)
        g = g.join(live.select(F.col(period), F.lit(True).alias("_fin")).distinct(), period, "left")
    else:
        g = g.withColumn("_fin", F.lit(None).cast("boolean"))
    full = (F.col("n_tasks") == expected) & F.col("_all_done")
    state = (F.when(full & F.col("_fin").isNotNull(), "finalized")
              .when(full, "ready_for_finalize")
              .when(F.col("_any_progress"), "running")
              .when(F.col("_any_new"), "dispatched")
              .when(F.col("_any_timeout"), "stalled")
              .otherwise("idle"))
    return g.select(period, "n_tasks", full.alias("complete_set"), state.alias("cycle_state"),
                    "pending", "failed")


def head_of_backlog(tasks: DataFrame, group: str = "server",
                    order: tuple[str, ...] = ("month", "task_id")) -> DataFrame:
    """First ``new`` task of every group, in (month, task_id) order.

    A ``min`` over a struct: partial aggregation keeps one candidate per
    group per task before the shuffle, so a group holding a third of the
    rows costs no more than any other (a window would sort it in one task).
    """
    best = F.min(F.struct(*[F.col(c) for c in order])).alias("_b")
    return (tasks.where(F.col("status") == "new").groupBy(group).agg(best)
            .select(group, *[F.col("_b")[c].alias(c) for c in order]))


def latest_period(tasks: DataFrame, created_col: str = "created_at", period: str = "month") -> DataFrame:
    """Most recent period by creation time, ties broken by period desc
    (a top-1 ``TakeOrderedAndProject``: one candidate per partition)."""
    return (tasks.select(period, created_col)
            .orderBy(F.col(created_col).desc(), F.col(period).desc()).limit(1))


def create_if_absent(plan: DataFrame, existing: DataFrame, grain: str = "month") -> DataFrame:
    """Tasks to create: plan rows whose whole ``grain`` has no task yet
    (any existing task suppresses the period).  ``left_anti`` is null-safe,
    unlike ``NOT IN`` over a nullable column."""
    return plan.join(existing.select(grain).where(F.col(grain).isNotNull()).distinct(), grain, "left_anti")


def insert_ignore(proposed: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to insert at unit grain: proposed minus existing keys."""
    return proposed.join(existing.select(*keys).distinct(), keys, "left_anti")
