"""Validity of transactions, alerts, history rows, metric points, heartbeats and rules.

A predicate never drops rows: ``with_violations`` lists what is wrong, and
``split`` turns that into an accepted and a rejected frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import texts, times

# fixed patterns
USER_ID = r"^user-(1[0]|[1-9])$"
COUNTRY = r"^[A-Z]{2}$"
CURRENCY = r"^[A-Z]{3}$"
TRANSACTION_UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def _true(condition: Column) -> Column:
    """A check on a missing value fails."""
    return F.coalesce(condition, F.lit(False))


def is_uuid(text: Column) -> Column:
    """Whether an id has the random-UUID form (an id in another form is still accepted)."""
    return _true(text.rlike(TRANSACTION_UUID))


def schema_ok(row: str = "") -> Column:
    return _true(F.col(f"{row}schema_version") == S.SCHEMA_VERSION)


def transaction_valid(row: str = "") -> Column:
    """``row`` is a prefix such as ``original_transaction.``."""

    def c(name: str) -> Column:
        return F.col(f"{row}{name}")

    return _true(
        (c("schema_version") == S.SCHEMA_VERSION)
        & (F.length(c("transaction_id")) > 0)
        & c("user_id").rlike(USER_ID)
        & c("amount").between(S.MIN_AMOUNT, S.MAX_AMOUNT)
        & (c("currency") == S.CURRENCY)
        & c("country_code").rlike(COUNTRY)
        & (F.length(c("timestamp")) > 0)
    )


def alert_valid() -> Column:
    return _true(
        (F.col("schema_version") == S.SCHEMA_VERSION)
        & (F.length("alert_id") > 0)
        & transaction_valid("original_transaction.")
        & F.col("rule_type").isin(*S.RULE_TYPES)
        & F.col("rule_name").isin(*S.RULE_NAMES)
        & texts.utf16_length(F.col("reason")).between(1, S.MAX_REASON_CHARS)
        & F.col("severity").isin(*S.DETECTOR_SEVERITIES)
        & (F.length("alert_timestamp") > 0)
    )


def alert_chronological() -> Column:
    """The alert is not older than its transaction; unreadable times fail."""
    alert = times.parse_instant(F.col("alert_timestamp"))
    return _true(alert >= times.parse_instant(F.col("original_transaction.timestamp")))


def with_violations(rows: DataFrame, checks: dict[str, Column], out: str = "violations") -> DataFrame:
    """Append the codes whose condition does not hold, in the order given."""
    codes = F.concat_ws(",", *[F.when(~_true(ok), F.lit(code)) for code, ok in checks.items()])
    return rows.withColumn(out, codes).withColumn(
        out, F.when(F.col(out) == "", F.array().cast("array<string>")).otherwise(F.split(out, ","))
    )


def split(rows: DataFrame, out: str = "violations") -> tuple[DataFrame, DataFrame]:
    return rows.filter(F.size(out) == 0).drop(out), rows.filter(F.size(out) > 0)


def history_checks(as_of: Column) -> dict[str, Column]:
    low, high = S.HISTORY_REASON_CHARS
    completed = F.col("status") == "COMPLETED"
    return {
        "AMOUNT_NOT_POSITIVE": F.col("amount") > 0,
        "REASON_LENGTH": texts.utf16_length(F.col("reason")).between(low, high),
        "CURRENCY_FORMAT": F.col("currency").rlike(CURRENCY),
        "COUNTRY_FORMAT": F.col("country_code").rlike(COUNTRY),
        "ALERT_IN_FUTURE": F.col("alert_timestamp") <= as_of,
        "COMPLETED_WITHOUT_TIME": ~completed | F.col("processed_at").isNotNull(),
        "NOTE_TOO_LONG": F.col("action_note").isNull()
        | (texts.utf16_length(F.col("action_note")) <= S.MAX_NOTE_CHARS),
        "SEVERITY_UNKNOWN": F.col("severity").isin(*S.DETECTOR_SEVERITIES),
        "STATUS_UNKNOWN": F.col("status").isin(*S.STATUSES),
        "MISSING_FIELD": F.concat(
            *[
                F.col(c).cast("string")
                for c in ("alert_id", "schema_version", "transaction_id", "user_id", "rule_name")
            ]
        ).isNotNull(),
    }


def tps_point_checks(step_seconds: int = 5) -> dict[str, Column]:
    """Needs ``point_ms, tps, total_transactions`` and ``previous_total``."""
    return {
        "TM-001": F.pmod(F.col("point_ms"), F.lit(step_seconds * 1000)) == 0,
        "TM-002": F.col("tps").between(0, 10_000),
        "TM-003": (F.col("total_transactions") >= 0)
        & (F.col("total_transactions") >= F.coalesce("previous_total", F.lit(0))),
    }


def alert_point_checks(step_seconds: int = 5) -> dict[str, Column]:
    """Needs ``point_ms, alerts_per_minute`` and the map ``by_rule``."""
    counts = F.map_values("by_rule")
    zero = F.lit(0).cast("long")
    return {
        "AM-001": F.pmod(F.col("point_ms"), F.lit(step_seconds * 1000)) == 0,
        "AM-002": F.col("alerts_per_minute").between(0, 1_000),
        "AM-003": F.sort_array(F.map_keys("by_rule")) == F.array(*[F.lit(r) for r in sorted(S.RULE_NAMES)]),
        "AM-004": F.forall(counts, lambda n: n >= 0),
        "AM-005": F.aggregate(counts, zero, lambda total, n: total + n) == F.col("alerts_per_minute"),
    }


def history_length_checks(points: int = S.HISTORY_POINTS) -> dict[str, Column]:
    """Needs the snapshot's struct ``data``: its histories have at most so many points."""
    return {
        "TM-004": F.size("data.tps.history") <= points,
        "AM-006": F.size("data.alerts.history") <= points,
    }


def service_checks(as_of: Column) -> dict[str, Column]:
    """Needs ``service_name, status, last_checked, response_time, memory_usage, error_type, error_message``."""
    up, down = F.col("status") == "UP", F.col("status") == "DOWN"
    return {
        "SH-001": F.col("service_name").isin(*S.SERVICES),
        "SH-002": up | down,
        "SH-003": F.col("last_checked") >= as_of - F.expr("INTERVAL 10 SECONDS"),
        "SH-004": ~up | F.col("response_time").between(0, 5_000),
        "SH-005": ~up | F.col("memory_usage").between(0, 8_192),
        "SH-006": ~down | F.col("error_type").isNotNull(),
        "SH-007": ~down | (F.length("error_message") <= 256),
    }
