"""Small inputs for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from txnwatch import schemas as S

START = datetime(2023, 3, 14, 21, 30, 0)
BASE_MS = int(START.replace(tzinfo=timezone.utc).timestamp() * 1000)

_LAYOUT = (
    "schema_version string, transaction_id string, user_id string, amount bigint, currency string, "
    "country_code string, timestamp string, event_ms bigint"
)


def transactions(spark, rows):
    """Rows are dicts with any of ms (offset), user, amount, country, id."""
    data = []
    for i, row in enumerate(rows):
        ms = BASE_MS + row.get("ms", i * 1000)
        at = datetime(1970, 1, 1) + timedelta(milliseconds=ms)
        data.append(
            (
                row.get("version", "1.0"), row.get("id", f"t{i}"), row.get("user", "user-1"),
                row.get("amount", 50_000), row.get("currency", "KRW"), row.get("country", "KR"),
                at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z", ms,
            )
        )
    return spark.createDataFrame(data, _LAYOUT).withColumn("event_ts", F.timestamp_millis("event_ms"))


def history(spark, rows):
    """Flat alert rows; each dict overrides the defaults."""
    data = []
    for i, row in enumerate(rows):
        base = {
            "alert_id": f"a{i:04d}", "schema_version": "1.0", "transaction_id": f"t{i}", "user_id": "user-1",
            "amount": 1_200_000, "currency": "KRW", "country_code": "KR", "rule_name": S.HIGH_VALUE,
            "reason": "고액 거래 (100만원 초과): 1,200,000원", "severity": "HIGH",
            "alert_timestamp": START + timedelta(seconds=i), "status": "UNREAD", "assigned_to": None,
            "action_note": None, "processed_at": None, "created_at": START,
        }
        base.update(row)
        data.append(tuple(base[name] for name in S.HISTORY.names))
    return spark.createDataFrame(data, S.HISTORY)


def commands(spark, rows):
    data = []
    for i, row in enumerate(rows):
        base = {
            "seq": i, "ts": START + timedelta(seconds=i), "alert_id": "a0000", "cmd": "STATUS", "status": None,
            "assigned_to": None, "action_note": None, "complete": False,
        }
        base.update(row)
        data.append(tuple(base[name] for name in S.COMMANDS.names))
    return spark.createDataFrame(data, S.COMMANDS)
