"""Roll-ups over the alert history and profiles of transactions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import times

PERIODS = ("day", "week", "month")


def _share(part: Column, whole: Column) -> Column:
    """Percentage 0-100; 0 of nothing is 0."""
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def _whole(column: str) -> Column:
    """Total over an already aggregated frame (one row per group)."""
    return F.sum(column).over(Window.partitionBy())


def status_counts(history: DataFrame, since: datetime) -> DataFrame:
    return (
        history.filter(F.col("alert_timestamp") >= times.at(since))
        .groupBy("status")
        .agg(F.count("*").alias("n"))
    )


def hourly_counts(history: DataFrame, day: date | None = None, as_of: datetime | None = None) -> DataFrame:
    """Alerts per hour of day 0..23 for one day, else for the 24 hours up to ``as_of``.

    Hours without alerts count 0.
    """
    ts = F.col("alert_timestamp")
    if day is not None:
        start = datetime(day.year, day.month, day.day)
        chosen = (ts >= times.at(start)) & (ts < times.at(start + timedelta(days=1)))
    else:
        end = F.current_timestamp() if as_of is None else times.at(as_of)
        chosen = (ts > end - F.expr("INTERVAL 24 HOURS")) & (ts <= end)
    counts = history.filter(chosen).groupBy(F.hour(ts).cast("long").alias("hour")).agg(F.count("*").alias("n"))
    hours = history.sparkSession.range(24).withColumnRenamed("id", "hour")
    return hours.join(counts, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))


def rule_stats(history: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Per rule: count, share of all, completed count and completion rate."""
    if start is not None:
        history = history.filter(F.col("alert_timestamp") >= times.at(start))
    if end is not None:
        history = history.filter(F.col("alert_timestamp") <= times.at(end))
    completed = F.count_if(F.col("status") == "COMPLETED")
    return (
        history.groupBy("rule_name")
        .agg(F.count("*").alias("n"), completed.alias("completed"))
        .select(
            "rule_name",
            "n",
            _share(F.col("n"), _whole("n")).alias("percentage"),
            "completed",
            _share(F.col("completed"), F.col("n")).alias("completion_rate"),
        )
    )


def period_rollup(history: DataFrame, unit: str) -> DataFrame:
    """Alerts per period and rule; weeks start on Monday."""
    if unit not in PERIODS:
        raise ValueError(f"unit is one of {', '.join(PERIODS)}")
    return history.groupBy(F.date_trunc(unit, "alert_timestamp").alias("period"), "rule_name").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "COMPLETED").alias("completed")
    )


def rule_coverage(alerts: DataFrame, rules: Iterable[str] = S.RULE_NAMES) -> DataFrame:
    """Which of the rules fired at all."""
    wanted = alerts.sparkSession.createDataFrame([(r,) for r in rules], "rule_name string")
    counts = alerts.groupBy("rule_name").agg(F.count("*").alias("n"))
    return wanted.join(counts, "rule_name", "left").select(
        "rule_name", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNotNull().alias("fired")
    )


def transaction_profile(transactions: DataFrame) -> DataFrame:
    """Per country: count, share, amount range, users, rows outside the valid range.

    Users are counted per country with their shares summing over countries, so
    no single task sees all ids.
    """
    outside = ~F.col("amount").between(S.MIN_AMOUNT, S.MAX_AMOUNT)
    per_user = transactions.groupBy("country_code", "user_id").agg(
        F.count("*").alias("_n"),
        F.min("amount").alias("_min"),
        F.max("amount").alias("_max"),
        F.count_if(outside).alias("_outside"),
    )
    return (
        per_user.groupBy("country_code")
        .agg(
            F.sum("_n").alias("n"),
            F.min("_min").alias("min_amount"),
            F.max("_max").alias("max_amount"),
            F.count("user_id").alias("users"),
            F.sum("_outside").alias("outside_range"),
        )
        .withColumn("percentage", _share(F.col("n"), _whole("n")))
    )
