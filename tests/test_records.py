import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from builders import transactions
from txnwatch.functions import times
from txnwatch.operators import rules
from txnwatch.sources import records

GOOD = {
    "schemaVersion": "1.0", "transactionId": "550e8400-e29b-41d4-a716-446655440000", "userId": "user-3",
    "amount": 1250000, "currency": "KRW", "countryCode": "KR", "timestamp": "2025-11-06T10:30:45.123Z",
}
INGEST = datetime(2025, 11, 6, 12, 0)


def wire(spark, *texts):
    data = [(i, None if t is None else bytearray(t.encode()), INGEST) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "offset bigint, value binary, ingest_ts timestamp")


def test_bad_records_go_to_quarantine(spark):
    without_user = {k: v for k, v in GOOD.items() if k != "userId"}
    good, bad = records.decode_transactions(
        wire(spark, json.dumps(GOOD), '{"schemaVersion":', json.dumps(without_user), "", None, json.dumps({**GOOD, "x": 1}), "[1]")
    )
    assert [r.offset for r in good.collect()] == [0]
    problems = {r.offset: r.problem for r in bad.collect()}
    assert problems[1] == "BAD_JSON" and problems[2] == "MISSING_FIELD: userId"
    assert problems[3] == "EMPTY_PAYLOAD" and problems[4] == "NULL_PAYLOAD" and problems[5] == "UNKNOWN_FIELD: x"
    assert set(problems) == {1, 2, 3, 4, 5, 6}


def test_unknown_fields_can_be_allowed(spark):
    good, bad = records.decode_transactions(wire(spark, json.dumps({**GOOD, "x": 1})), reject_unknown=False)
    assert good.count() == 1 and bad.count() == 0


def test_invalid_records_are_kept_and_flagged(spark):
    texts = [json.dumps({**GOOD, "schemaVersion": "2.0"}), json.dumps({**GOOD, "amount": 5}), json.dumps(GOOD)]
    good, _ = records.decode_transactions(wire(spark, *texts))
    rows = {r.offset: (r.schema_ok, r.is_valid) for r in good.collect()}
    assert rows == {0: (False, False), 1: (True, False), 2: (True, True)}
    kept, _ = records.decode_transactions(wire(spark, *texts), drop_invalid=True)
    assert [r.offset for r in kept.collect()] == [2]


def test_unreadable_time_falls_back_to_ingest_time(spark):
    good, _ = records.decode_transactions(wire(spark, json.dumps({**GOOD, "timestamp": "yesterday"}), json.dumps(GOOD)))
    rows = {r.offset: (r.event_ts, r.time_ok) for r in good.collect()}
    assert rows == {0: (INGEST, False), 1: (datetime(2025, 11, 6, 10, 30, 45, 123000), True)}


def test_failfast(spark):
    good, _ = records.decode_transactions(wire(spark, "{bad"), mode="failfast")
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        good.collect()
    with pytest.raises(ValueError):
        records.decode_transactions(wire(spark, "{}"), mode="other")


def test_alert_round_trip(spark):
    alerts = rules.stateless_alerts(transactions(spark, [{"id": "x", "amount": 2_000_000, "country": "US"}]), alert_ts=F.col("event_ts"))
    encoded = records.encode_alerts(alerts)
    row = encoded.first()
    headers = {h.key: bytes(h.value).decode() for h in row.headers}
    assert row.key == "user-1" and headers["schema-version"] == "1.0" and headers["source-service"] == "fraud-detector"
    assert list(json.loads(row.value)) == [
        "schemaVersion", "alertId", "originalTransaction", "ruleType", "ruleName", "reason", "severity", "alertTimestamp",
    ]
    decoded, bad = records.decode_alerts(encoded.select(F.encode("value", "UTF-8").alias("value")))
    assert bad.count() == 0
    assert decoded.exceptAll(alerts).count() == 0 and alerts.exceptAll(decoded).count() == 0


def test_bad_alert_record_is_skipped(spark):
    good, bad = records.decode_alerts(wire(spark, "oops", '{"alertId":"a"}'))
    assert good.count() == 0 and bad.count() == 2


def test_transaction_record(spark):
    row = records.encode_transactions(transactions(spark, [{"id": "x"}])).first()
    assert row.key == "user-1" and json.loads(row.value)["transactionId"] == "x"


def test_times(spark):
    def one(column):
        return spark.range(1).select(column.alias("c")).first().c

    assert one(times.display_time(F.lit("2025-11-06T10:30:45.123Z"))) == "2025-11-06 10:30:45"
    assert one(times.display_time(F.lit("soon"))) == "soon"
    assert one(times.parse_instant(F.lit("2025-11-06"))) is None
    day = F.lit(datetime(2025, 11, 6, 15, 4, 5))
    assert one(times.day_start(day)) == datetime(2025, 11, 6)
    assert one(times.day_end(day)) == datetime(2025, 11, 6, 23, 59, 59, 999000)
    assert one(times.floor_to(F.lit(-1).cast("bigint"), 10)) == -10
