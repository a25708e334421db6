"""Throughput and alert-rate series, their summaries, and service status.

A series has one point per step, also where nothing happened. Rows are counted
per step first, so the size of a series follows the time span and not the data.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import times
from txnwatch.functions.times import floor_to
from txnwatch.operators import prefix

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def _ms(when: datetime | Column) -> Column:
    return F.unix_millis(when if isinstance(when, Column) else times.at(when))


Bounds = tuple[datetime, datetime]


def _grid(points: DataFrame, step_ms: int, bounds: Bounds | None) -> DataFrame:
    """Every step from the first to the last ``point_ms``, or inside ``bounds``, a task per day."""
    chunk = max(step_ms, DAY_MS - DAY_MS % step_ms)
    if bounds:
        first, last = (_ms(end) for end in bounds)
        ends = points.sparkSession.range(1).select(
            (F.ceil(first / F.lit(step_ms)) * step_ms).alias("_first"), floor_to(last, step_ms).alias("_last")
        )
    else:
        ends = points.agg(F.min("point_ms").alias("_first"), F.max("point_ms").alias("_last"))
    chunks = ends.filter(F.col("_first").isNotNull()).select(
        "_last", F.explode(F.sequence("_first", "_last", F.lit(chunk).cast("long"))).alias("_from")
    )
    upto = F.least(F.col("_from") + F.lit(chunk - step_ms), F.col("_last"))
    return chunks.repartition("_from").select(F.explode(F.sequence("_from", upto, F.lit(step_ms).cast("long"))).alias("point_ms"))


def _with_empty_steps(
    points: DataFrame, step_ms: int, counts: Sequence[str], bounds: Bounds | None = None
) -> DataFrame:
    if bounds:
        points = points.filter((F.col("point_ms") >= _ms(bounds[0])) & (F.col("point_ms") <= _ms(bounds[1])))
    # reading a count keeps both uses of ``points`` alike, so they share one shuffle
    occupied = points.filter(functools.reduce(operator.add, [F.col(c) for c in counts]) > 0)
    zeros = _grid(occupied, step_ms, bounds).select("point_ms", *[F.lit(0).cast("long").alias(c) for c in counts])
    return (
        points.select("point_ms", *counts)
        .unionByName(zeros)
        .groupBy("point_ms")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )


def tps_series(
    transactions: DataFrame,
    step_seconds: int = 5,
    unit_seconds: int = 1,
    time: str = "event_ms",
    bounds: Bounds | None = None,
    before: int = 0,
) -> DataFrame:
    """``point_ms, n, tps, total_transactions`` per step.

    ``tps`` is the whole number of transactions per ``unit_seconds``. With ``bounds`` the series
    has the steps inside them and reads no other transactions (they need ``event_ts``);
    ``before`` is the total up to there, and a stray time adds no steps.
    """
    if bounds:
        transactions = transactions.filter(
            (F.col("event_ts") >= times.at(bounds[0])) & (F.col("event_ts") < times.at(bounds[1] + timedelta(seconds=step_seconds)))
        )
    step_ms = step_seconds * 1000
    counts = transactions.groupBy(floor_to(F.col(time), step_ms).alias("point_ms")).agg(F.count("*").alias("n"))
    points = _with_empty_steps(counts, step_ms, ["n"], bounds)
    rate = F.floor(F.col("n") / F.lit(step_seconds // unit_seconds))
    return prefix.running_total(
        points, "point_ms", "n", "total_transactions", max(step_ms, DAY_MS)
    ).withColumns({"tps": rate, "total_transactions": F.col("total_transactions") + F.lit(before)})


def alert_rate_series(
    alerts: DataFrame,
    window_seconds: int = 60,
    step_seconds: int = 5,
    rules: Iterable[str] = S.RULE_NAMES,
    hidden: Iterable[str] = (),
    time: str = "alert_timestamp",
    bounds: Bounds | None = None,
) -> DataFrame:
    """Alerts in ``[t - window, t)`` at every step t, in total and per rule.

    Alerts are counted per step and rule before a count is repeated for the
    windows it belongs to. With ``bounds`` only the alerts of their windows are read.
    """
    if bounds:
        since = bounds[0] - timedelta(seconds=window_seconds)
        alerts = alerts.filter((F.col(time) >= times.at(since)) & (F.col(time) <= times.at(bounds[1])))
    if window_seconds % step_seconds:
        raise ValueError("the window must be a whole number of steps")
    rules, hidden = list(rules), list(hidden)
    shown = [r for r in rules if r not in hidden]
    step, window = step_seconds * 1000, window_seconds * 1000
    bucket = floor_to(F.unix_millis(time), step)
    per_step = (
        alerts.filter(F.col("rule_name").isin(shown))
        .groupBy(bucket.alias("_bucket"))
        .agg(*[F.count_if(F.col("rule_name") == r).alias(r) for r in shown])
    )
    samples = F.sequence(F.col("_bucket") + F.lit(step), F.col("_bucket") + F.lit(window), F.lit(step).cast("long"))
    spread = (
        per_step.withColumn("point_ms", F.explode(samples))
        .groupBy("point_ms")
        .agg(*[F.sum(r).alias(r) for r in shown])
    )
    points = _with_empty_steps(spread, step, shown, bounds)
    by_rule = F.create_map(*[x for r in shown for x in (F.lit(r), F.col(r))])
    total = sum((F.col(r) for r in shown[1:]), F.col(shown[0]))
    return points.select("point_ms", total.alias("alerts_per_minute"), by_rule.alias("by_rule"))


def with_warning(
    points: DataFrame, value: str = "alerts_per_minute", window_ms: int = HOUR_MS, factor: int = 2
) -> DataFrame:
    """Per point: average and maximum of the trailing window, and whether it exceeds twice the average."""
    stats = prefix.trailing_stats(
        points, "point_ms", value, window_ms, {"average_value": F.avg, "max_value": F.max}
    )
    return stats.withColumn("is_warning", F.col(value) > F.col("average_value") * factor)


def summary(points: DataFrame, value: str, as_of: datetime | Column, window_ms: int = HOUR_MS) -> DataFrame:
    """One row: current (latest), average and maximum of the points of the last ``window_ms``."""
    return trailing(points, as_of, window_ms).agg(
        F.max_by(value, "point_ms").alias("current_value"),
        F.avg(value).alias("average_value"),
        F.max(value).alias("max_value"),
    )


def trailing(points: DataFrame, as_of: datetime | Column, window_ms: int = HOUR_MS) -> DataFrame:
    """Points still kept at ``as_of``: those of ``(as_of - window_ms, as_of]``, 720 at most at five-second steps."""
    now = _ms(as_of)
    return points.filter((F.col("point_ms") > now - F.lit(window_ms)) & (F.col("point_ms") <= now))


def back_fill(points: DataFrame, since: datetime | Column, as_of: datetime | Column, window_ms: int = HOUR_MS):
    """Kept points strictly after ``since``, oldest first."""
    return trailing(points, as_of, window_ms).filter(F.col("point_ms") > _ms(since)).orderBy("point_ms")


def retained(rows: DataFrame, time: str, as_of: datetime, hours: int) -> DataFrame:
    """Rows not older than the retention: 1 hour for transactions, 24 hours for alerts."""
    return rows.filter(F.col(time) >= times.at(as_of) - F.make_dt_interval(hours=F.lit(hours)))


def service_status(
    heartbeats: DataFrame, as_of: datetime, timeout_ms: int = 5_000, stale_seconds: int = 10
) -> DataFrame:
    """Latest heartbeat per service; DOWN when it failed, took too long, is stale, or never came."""
    now = times.at(as_of)
    last = (
        heartbeats.filter(F.col("checked_at") <= now)
        .groupBy("service_name")
        .agg(F.max(F.struct("checked_at", "seq", "ok", "response_ms")).alias("_last"))
    )
    services = heartbeats.sparkSession.createDataFrame([(s,) for s in S.SERVICES], "service_name string")
    checked, took = F.col("_last.checked_at"), F.col("_last.response_ms")
    stale = checked.isNull() | (checked < now - F.make_dt_interval(secs=F.lit(stale_seconds)))
    error = (
        F.when(stale, "NETWORK_ERROR")
        .when(~F.col("_last.ok"), "HTTP_ERROR")
        .when(took > timeout_ms, "TIMEOUT")
    )
    return services.join(last, "service_name", "left").select(
        "service_name",
        F.when(error.isNull(), "UP").otherwise("DOWN").alias("status"),
        checked.alias("last_checked"),
        F.when(error.isNull(), took).alias("response_time"),
        error.alias("error_type"),
    )


def snapshot(
    tps: DataFrame, rates: DataFrame, services: DataFrame, as_of: datetime, window_ms: int = HOUR_MS
) -> DataFrame:
    """One row: services, throughput and alert rate with their histories.

    Histories hold the points of the trailing window only, and there are five
    services, so the row has a fixed size.
    """
    tps_part = trailing(tps, as_of, window_ms).agg(
        F.struct(
            F.max_by("tps", "point_ms").alias("current"),
            F.avg("tps").alias("average"),
            F.max("tps").alias("max"),
            F.array_sort(F.collect_list(F.struct("point_ms", "tps", "total_transactions"))).alias("history"),
        ).alias("tps")
    )
    rate_part = trailing(rates, as_of, window_ms).agg(
        F.struct(
            F.max_by("alerts_per_minute", "point_ms").alias("current"),
            F.avg("alerts_per_minute").alias("average"),
            F.max("alerts_per_minute").alias("max"),
            F.max_by("by_rule", "point_ms").alias("by_rule"),
            # maps do not sort, so the time alone is the sort key
            F.array_sort(
                F.collect_list(F.struct("point_ms", "alerts_per_minute", "by_rule")),
                lambda a, b: F.when(a["point_ms"] < b["point_ms"], -1).otherwise(1),
            ).alias("history"),
        ).alias("alerts")
    )
    service_part = services.agg(
        F.array_sort(
            F.collect_list(F.struct("service_name", "status", "last_checked", "response_time", "error_type"))
        ).alias("services")
    )
    one = F.lit(1).alias("_one")
    return (
        service_part.select(one, "services")
        .join(tps_part.select(one, "tps"), "_one")
        .join(rate_part.select(one, "alerts"), "_one")
        .select(
            F.lit("METRICS_UPDATE").alias("type"),
            times.at(as_of).alias("timestamp"),
            F.struct("services", "tps", "alerts").alias("data"),
        )
    )
