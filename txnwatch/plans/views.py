"""Transactions, alerts, commands and heartbeats read out of the given tables.

Every view is a plain projection of ``events`` (or of another view), so its
size follows the table and the scan reads only the columns a query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import texts, times
from txnwatch.operators import rules


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_transactions(raw: DataFrame) -> DataFrame:
    """Project ``events`` rows (static or streaming) to transactions."""
    k = F.get_json_object("props", "$.k").cast("int") % 20
    ts = F.col("ts").cast("timestamp")
    # 20 slots: four in five transactions are domestic
    slots = ["KR"] * 16 + ["US"] * 2 + ["JP", "CN"]
    country = F.get(F.array(*[F.lit(c) for c in slots]), k)
    return raw.select(
        "event_id",
        F.lit(S.SCHEMA_VERSION).alias("schema_version"),
        F.concat(F.lit("txn-"), F.col("event_id")).alias("transaction_id"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("user_id"),
        F.round(F.col("value") * 10000).cast("long").alias("amount"),
        F.lit(S.CURRENCY).alias("currency"),
        country.alias("country_code"),
        times.iso_instant(ts).alias("timestamp"),
        ts.alias("event_ts"),
        F.unix_millis(ts).alias("event_ms"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(events(spark, sf_dir))


FAST_FROM_MS, FAST_FACTOR = 1_704_067_200_000, 4_000


def fast_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with time running 4,000 times faster, so that the rules' own windows fill."""
    fast = F.lit(FAST_FROM_MS) + F.floor((F.col("event_ms") - FAST_FROM_MS) / FAST_FACTOR)
    rows = transactions(spark, sf_dir).withColumn("event_ms", fast)
    ts = F.timestamp_millis("event_ms")
    return rows.withColumns({"event_ts": ts, "timestamp": times.iso_instant(ts)})


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateless alerts; the alert time is the transaction's own time."""
    return rules.stateless_alerts(transactions(spark, sf_dir), alert_ts=F.col("event_ts"))


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_alert_history(transactions(spark, sf_dir))


def as_alert_history(rows: DataFrame) -> DataFrame:
    """Flat alert rows with a case state taken from the event number."""
    digit = F.col("event_id") % 10
    ts = F.col("event_ts")
    return rules.stateless_alerts(rows, alert_ts=ts, keep=("event_id", "event_ts")).select(
        "alert_id",
        "schema_version",
        F.col("original_transaction.transaction_id").alias("transaction_id"),
        F.col("original_transaction.user_id").alias("user_id"),
        F.col("original_transaction.amount").alias("amount"),
        F.col("original_transaction.currency").alias("currency"),
        F.col("original_transaction.country_code").alias("country_code"),
        "rule_name",
        "reason",
        "severity",
        ts.alias("alert_timestamp"),
        F.when(digit < 6, "UNREAD").when(digit < 8, "IN_PROGRESS").otherwise("COMPLETED").alias("status"),
        F.when(digit >= 6, F.concat(F.lit("agent-"), F.col("event_id") % 7)).alias("assigned_to"),
        F.lit(None).cast("string").alias("action_note"),
        F.when(digit >= 8, ts + F.expr("INTERVAL 1 MINUTE")).alias("processed_at"),
        ts.alias("created_at"),
    )


def as_commands(raw: DataFrame, alert_id) -> DataFrame:
    kind, event = F.col("event_type"), F.col("event_id")
    assigns, acts = kind == "view", kind == "signup"
    return raw.select(
        event.alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        alert_id.alias("alert_id"),
        F.when(assigns, "ASSIGN").when(acts, "ACTION").otherwise("STATUS").alias("cmd"),
        F.when(kind == "click", "IN_PROGRESS").when(kind == "purchase", "COMPLETED")
        .when(kind == "error", "UNREAD").alias("status"),
        F.when(assigns & (event % 11 != 0), F.concat(F.lit("agent-"), F.col("user_id"))).alias("assigned_to"),
        F.when(acts, F.when(event % 13 == 0, "").otherwise(F.concat(F.lit("note "), event))).alias("action_note"),
        (acts & (event % 5 == 0)).alias("complete"),
    )


def case_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands on 200 cases: every case is a busy key."""
    return as_commands(events(spark, sf_dir), F.concat(F.lit("case-"), F.col("event_id") % 200))


def as_alert_commands(raw: DataFrame) -> DataFrame:
    target = F.concat(F.lit("txn-"), F.col("event_id") - F.col("event_id") % 7)
    return as_commands(raw, texts.alert_id(target, F.lit(S.FOREIGN_COUNTRY)))


def alert_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands on foreign-country alerts; about four in five name no alert."""
    return as_alert_commands(events(spark, sf_dir))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    service = F.col("user_id") % 5
    name = F.when(service == 0, S.SERVICES[0])
    for i in range(1, 4):
        name = name.when(service == i, S.SERVICES[i])
    ok = F.col("event_type") != "error"
    return events(spark, sf_dir).select(
        name.otherwise(S.SERVICES[4]).alias("service_name"),
        F.col("ts").cast("timestamp").alias("checked_at"),
        F.col("event_id").alias("seq"),
        F.round(F.col("value") * 30).cast("long").alias("response_ms"),
        ok.alias("ok"),
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw_records(transactions(spark, sf_dir))


def as_raw_records(rows: DataFrame) -> DataFrame:
    """Transaction records as they come off the wire, some of them damaged."""
    event = F.col("event_id")
    body = F.to_json(
        F.struct(
            F.when(event % 89 == 0, "2.0").otherwise(S.SCHEMA_VERSION).alias("schemaVersion"),
            F.col("transaction_id").alias("transactionId"),
            F.when(event % 83 != 0, F.col("user_id")).alias("userId"),
            F.col("amount"),
            F.col("currency"),
            F.col("country_code").alias("countryCode"),
            F.col("timestamp"),
        )
    )
    damaged = F.when(event % 97 == 0, F.substring(body, 1, 40)).otherwise(body)
    return rows.select(
        event.alias("offset"), F.encode(damaged, "UTF-8").alias("value"), F.col("event_ts").alias("ingest_ts")
    )


def timed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that leave the detector some time after their transaction (a few before it)."""
    event = F.substring_index("transaction_id", "-", -1).cast("long")
    delay_ms = (event * 37) % 12000 - 500
    return alert_history(spark, sf_dir).select(
        "alert_id",
        "transaction_id",
        "rule_name",
        F.timestamp_micros(F.unix_micros("alert_timestamp") + delay_ms * 1000).alias("alert_timestamp"),
    )
