"""Case management as data: a command log folded per alert, and the recent-alert list.

Commands: ``seq, ts, alert_id, cmd (STATUS|ASSIGN|ACTION), status, assigned_to,
action_note, complete``. They apply in (ts, seq) order; the last writer wins.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import texts
from txnwatch.functions.times import floor_to

SLAB_MS = 3_600_000


# --- commands ----------------------------------------------------------------
def accepted(require_assignee: bool = False) -> Column:
    """Which commands take effect (on an alert that exists).

    An empty or missing assignee un-assigns; ``require_assignee`` rejects it,
    as the outer interface does.
    """
    assignee, note = F.col("assigned_to"), F.col("action_note")
    assign_ok = assignee.isNull() | (texts.utf16_length(assignee) <= S.MAX_ASSIGNEE_CHARS)
    if require_assignee:
        assign_ok = F.coalesce(F.length(assignee) > 0, F.lit(False)) & assign_ok
    note_ok = texts.utf16_length(note).between(1, S.MAX_NOTE_CHARS)
    kind = F.col("cmd")
    ok = (
        F.when(kind == "STATUS", F.col("status").isin(*S.STATUSES))
        .when(kind == "ASSIGN", assign_ok)
        .when(kind == "ACTION", note_ok)
    )
    return F.coalesce((F.length("alert_id") > 0) & ok, F.lit(False))


def _effects(commands: DataFrame, require_assignee: bool) -> DataFrame:
    """Accepted commands with what each one sets; NULL means it sets nothing."""
    kind = F.col("cmd")
    completes = (kind == "ACTION") & F.coalesce("complete", F.lit(False))
    status = F.when(kind == "STATUS", F.col("status")).when(completes, "COMPLETED")
    return commands.filter(accepted(require_assignee)).select(
        "alert_id",
        "ts",
        "seq",
        "cmd",
        status.alias("set_status"),
        # a struct, because un-assigning sets a NULL
        F.when(kind == "ASSIGN", F.struct(F.col("assigned_to").alias("to"))).alias("set_assignee"),
        F.when(kind == "ACTION", F.col("action_note")).alias("set_note"),
        F.when(status == "COMPLETED", F.col("ts")).alias("completed_at"),
    )


def _latest(value: str) -> Column:
    """Value of the last row that sets it, wrapped as (ts, seq, v)."""
    return F.max(
        F.when(F.col(value).isNotNull(), F.struct("ts", "seq", F.col(value).alias("v")))
    )


def fold_commands(commands: DataFrame, require_assignee: bool = False) -> DataFrame:
    """Net effect per alert. Partial aggregation runs before the shuffle, so a busy alert is cheap."""
    return (
        _effects(commands, require_assignee)
        .groupBy("alert_id")
        .agg(
            _latest("set_status").alias("_status"),
            _latest("set_assignee").alias("_assignee"),
            _latest("set_note").alias("_note"),
            F.min("completed_at").alias("completed_at"),
            F.count("*").alias("n_commands"),
        )
        .select(
            "alert_id",
            F.col("_status.v").alias("set_status"),
            F.col("_assignee.v").alias("set_assignee"),
            F.col("_note.v").alias("set_note"),
            "completed_at",
            "n_commands",
        )
    )


def apply_commands(alerts: DataFrame, commands: DataFrame, require_assignee: bool = False) -> DataFrame:
    """Alerts in the state the command log leaves them in.

    ``processed_at`` keeps the first completion, also when the case reopens.
    """
    net = fold_commands(commands, require_assignee)
    assigned = F.when(F.col("set_assignee").isNotNull(), F.col("set_assignee.to")).otherwise(F.col("assigned_to"))
    return (
        alerts.join(net, "alert_id", "left")
        .withColumn("status", F.coalesce("set_status", "status"))
        .withColumn("assigned_to", assigned)
        .withColumn("action_note", F.coalesce("set_note", "action_note"))
        .withColumn("processed_at", F.coalesce("processed_at", "completed_at"))
        .select(*alerts.columns)
    )


def status_events(
    alerts: DataFrame, commands: DataFrame, require_assignee: bool = False, slab_ms: int = SLAB_MS
) -> DataFrame:
    """One event per accepted command, holding the alert's full state after it.

    An alert's commands are cut into time slabs. Each slab starts from a carried
    row with the state at its start, so a busy alert spreads over many tasks and
    only one row per slab meets in the per-alert window.
    """
    effects = _effects(commands, require_assignee).withColumn("slab", floor_to(F.unix_millis("ts"), slab_ms))
    state = ("set_status", "set_assignee", "set_note")

    per_slab = effects.groupBy("alert_id", "slab").agg(
        *[_latest(name).getField("v").alias(name) for name in state],
        F.min("completed_at").alias("completed_at"),
    )
    earlier = Window.partitionBy("alert_id").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slab.select(
        "alert_id",
        "slab",
        *[F.last(name, ignorenulls=True).over(earlier).alias(name) for name in state],
        F.min("completed_at").over(earlier).alias("completed_at"),
    )
    start = alerts.select(
        "alert_id",
        F.col("status").alias("_status"),
        F.struct(F.col("assigned_to").alias("to")).alias("_assignee"),
        F.col("action_note").alias("_note"),
        "processed_at",
    )
    opening = carried.join(start, "alert_id").select(
        "alert_id",
        "slab",
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("cmd"),
        F.coalesce("set_status", "_status").alias("set_status"),
        F.coalesce("set_assignee", "_assignee").alias("set_assignee"),
        F.coalesce("set_note", "_note").alias("set_note"),
        F.coalesce("processed_at", "completed_at").alias("completed_at"),
    )
    so_far = (
        Window.partitionBy("alert_id", "slab")
        .orderBy(F.col("ts").asc_nulls_first(), F.col("seq").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )

    def running(name: str) -> Column:
        return F.last(name, ignorenulls=True).over(so_far)

    return (
        opening.unionByName(effects)
        .select(
            "alert_id", "ts", "seq", "cmd",
            running("set_status").alias("status"),
            running("set_assignee").getField("to").alias("assigned_to"),
            running("set_note").alias("action_note"),
            F.first("completed_at", ignorenulls=True).over(so_far).alias("processed_at"),
            # only an alert that exists has an opening row
            F.max(F.col("cmd").isNull()).over(so_far).alias("_known"),
        )
        .filter(F.col("cmd").isNotNull() & F.col("_known"))
        .drop("_known")
    )


def apply_status_events(alerts: DataFrame, events: DataFrame, order: str = "seq") -> DataFrame:
    """Merge decoded status events into an alert list.

    Status is replaced; ``processedAt`` only by a non-empty value; assignee and
    note whenever their key is present, also with a null.
    """

    def latest(condition: Column, value: Column) -> Column:
        return F.max(F.when(condition, F.struct(F.col(order).alias("o"), value.alias("v"))))

    change = F.col("change")

    def has(key: str) -> Column:
        return F.map_contains_key(change, key)

    net = events.groupBy("alert_id").agg(
        latest(F.lit(True), F.col("status")).alias("_status"),
        latest(F.length(change["processedAt"]) > 0, change["processedAt"]).alias("_processed"),
        latest(has("assignedTo"), change["assignedTo"]).alias("_assigned"),
        latest(has("actionNote"), change["actionNote"]).alias("_note"),
    )

    def or_keep(new: str, old: str) -> Column:
        return F.when(F.col(new).isNotNull(), F.col(f"{new}.v")).otherwise(F.col(old))

    return (
        alerts.join(net, "alert_id", "left")
        .withColumn("status", or_keep("_status", "status"))
        .withColumn("processed_at", F.coalesce(F.try_to_timestamp("_processed.v"), "processed_at"))
        .withColumn("assigned_to", or_keep("_assigned", "assigned_to"))
        .withColumn("action_note", or_keep("_note", "action_note"))
        .select(*alerts.columns)
    )


# --- lists --------------------------------------------------------------------
def newest_first(arrival: str = "alert_timestamp") -> list[Column]:
    return [F.col(arrival).desc(), F.col("alert_id").desc()]


def recent(alerts: DataFrame, limit: int = S.RECENT_ALERTS, arrival: str = "alert_timestamp") -> DataFrame:
    """The newest ``limit`` alerts, newest first; none for a limit of 0 or less."""
    return alerts.orderBy(*newest_first(arrival)).limit(max(0, min(limit, S.RECENT_ALERTS)))


def with_rank(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Append ``position`` 1.. to a list already cut to a page or to ``RECENT_ALERTS`` rows."""
    return rows.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("long"))


def with_position(alerts: DataFrame, arrival: str = "alert_timestamp") -> DataFrame:
    return with_rank(alerts, newest_first(arrival))


def severity_order(arrival: str = "alert_timestamp") -> list[Column]:
    return [texts.severity_priority(F.col("severity")).desc(), *newest_first(arrival)]


def sort_by_severity(alerts: DataFrame, arrival: str = "alert_timestamp") -> DataFrame:
    """Highest priority first; unknown severities last."""
    return alerts.orderBy(*severity_order(arrival))


_NOT_GIVEN = object()


def list_alerts(
    alerts: DataFrame,
    status=_NOT_GIVEN,
    assigned_to=_NOT_GIVEN,
    severity=_NOT_GIVEN,
    sort_by: str | None = None,
    precedence: bool = False,
    arrival: str = "alert_timestamp",
) -> DataFrame:
    """The recent list, cut to the newest first and then filtered and sorted.

    A filter that is given as None (or an empty assignee) matches nothing.
    Filters combine; with ``precedence`` only the first of status, assignee and
    severity counts, and an empty one counts as not given.
    """
    given = {"status": status, "assigned_to": assigned_to, "severity": severity}
    given = {name: value for name, value in given.items() if value is not _NOT_GIVEN}
    if precedence:
        given = {name: value for name, value in given.items() if value not in (None, "")}
        given = dict(list(given.items())[:1])
    page = recent(alerts, arrival=arrival)
    if given:
        tests = [F.lit(False) if value in (None, "") else F.col(name) == value for name, value in given.items()]
        page = page.filter(functools.reduce(operator.and_, tests))
    if (sort_by or "").lower() == "severity":
        page = sort_by_severity(page, arrival)
    return page


def find(alerts: DataFrame, alert_id: str | None) -> DataFrame:
    if not alert_id:
        return alerts.limit(0)
    return alerts.filter(F.col("alert_id") == alert_id).limit(1)


def new_only(alerts: DataFrame, seen: DataFrame) -> DataFrame:
    """Alerts whose id is not among ``seen``, each id once."""
    return alerts.dropDuplicates(["alert_id"]).join(seen.select("alert_id"), "alert_id", "left_anti")
