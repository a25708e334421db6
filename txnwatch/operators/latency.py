"""Detection latency: alert time minus transaction time."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.operators import prefix
from txnwatch.operators.analytics import _share, _whole

# Lower bounds of the buckets in seconds, and their labels
BUCKETS = ((0, "0-1"), (1, "1-2"), (2, "2-3"), (3, "3-5"), (5, "5-10"), (10, "10+"))


def latencies(alerts: DataFrame, transactions: DataFrame, arrival: str = "event_id") -> DataFrame:
    """``latency_us`` per alert whose transaction is known; negative ones are dropped.

    Of several transactions with one id the last to arrive counts.
    """
    last = (
        transactions.groupBy("transaction_id")
        .agg(F.max_by("event_ts", arrival).alias("event_ts"))
    )
    took = F.unix_micros("alert_timestamp") - F.unix_micros("event_ts")
    return (
        alerts.join(last, "transaction_id").withColumn("latency_us", took).drop("event_ts")
        .filter(F.col("latency_us") >= 0)
    )


def unmatched(alerts: DataFrame, transactions: DataFrame) -> DataFrame:
    return alerts.join(transactions.select("transaction_id"), "transaction_id", "left_anti")


def latency_stats(rows: DataFrame) -> DataFrame:
    """n, min, mean, p95, p99 and max in seconds; a percentile is the element at floor(n * q)."""
    stats = prefix.order_statistics(rows, "latency_us", {"p95": 0.95, "p99": 0.99})

    def seconds(us: Column) -> Column:
        return us / F.lit(1e6)

    return stats.select(
        "n",
        seconds(F.col("min")).alias("min_s"),
        seconds(F.col("sum") / F.col("n")).alias("mean_s"),
        seconds(F.col("p95")).alias("p95_s"),
        seconds(F.col("p99")).alias("p99_s"),
        seconds(F.col("max")).alias("max_s"),
    )


def _first_us_shown_as(seconds: int) -> int:
    """Smallest latency whose two-decimal text reads ``seconds`` or more."""
    if seconds == 0:
        return 0
    return next(us for us in count(seconds * 1_000_000 - 5_000) if float(f"{us / 1e6:.2f}") >= seconds)


def latency_histogram(rows: DataFrame) -> DataFrame:
    """Count and share per bucket, of latencies rounded to two decimals."""
    edges = [(_first_us_shown_as(low), label) for low, label in BUCKETS]
    bucket = F.lit(edges[0][1])
    for edge, label in edges[1:]:
        bucket = F.when(F.col("latency_us") >= edge, label).otherwise(bucket)
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    labels = rows.sparkSession.createDataFrame([(label,) for _, label in BUCKETS], "bucket string")
    n = F.coalesce("n", F.lit(0))
    return labels.join(counts, "bucket", "left").select("bucket", n.alias("n")).withColumn(
        "percentage", _share(F.col("n"), _whole("n"))
    )
