from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from builders import START, transactions
from txnwatch import schemas as S
from txnwatch.functions import texts
from txnwatch.operators import dynamic_rules, quality, rules


def fired(alerts):
    return sorted(r.id for r in alerts.select(F.col("original_transaction.transaction_id").alias("id")).collect())


def test_high_value_boundary(spark):
    for limit in (S.HIGH_VALUE_THRESHOLD, 77_000):
        amounts = {step: limit + step for step in (-limit, -1, 0, 1, limit)}
        rows = transactions(spark, [{"id": str(step), "amount": v} for step, v in amounts.items()])
        alerts = rules.stateless_alerts(rows, [rules.high_value(threshold=limit)])
        assert fired(alerts) == sorted(str(step) for step in amounts if step > 0)


def test_high_value_alert_fields(spark):
    row = rules.stateless_alerts(transactions(spark, [{"id": "x", "amount": 7_004_321}]), alert_ts=F.col("event_ts")).first()
    assert row.reason == "고액 거래 (100만원 초과): 7,004,321원"
    assert (row.rule_type, row.rule_name, row.severity) == (S.SIMPLE_RULE, S.HIGH_VALUE, "HIGH")
    assert row.alert_timestamp == row.original_transaction.timestamp == f"{START.isoformat()}.000Z"
    assert row.original_transaction.amount == 7_004_321


def test_foreign_country(spark):
    codes = ["KR", "FR", "BR", "ZA", "Kr", "", None]
    rows = transactions(spark, [{"id": str(c), "country": c} for c in codes])
    alerts = rules.stateless_alerts(rows, [rules.foreign_country()])
    assert fired(alerts) == sorted(str(c) for c in codes if c != "KR")
    assert {r.severity for r in alerts.collect()} == {"MEDIUM"}


def test_two_rules_give_two_alerts_with_stable_ids(spark):
    rows = transactions(spark, [{"id": "x", "amount": 2_000_000, "country": "US"}])
    first, second = (rules.stateless_alerts(rows).select("alert_id", "rule_name").collect() for _ in range(2))
    assert {r.rule_name for r in first} == {S.HIGH_VALUE, S.FOREIGN_COUNTRY}
    assert {r.alert_id for r in first} == {r.alert_id for r in second} and len({r.alert_id for r in first}) == 2


def reasons(spark, offsets, user="user-1", **kw):
    rows = transactions(spark, [{"ms": ms, "user": user} for ms in offsets])
    alerts = rules.window_alerts(rows, rules.high_frequency(**kw), F.col("event_ts"))
    return [r.reason for r in alerts.orderBy("alert_timestamp").collect()]


MOST, WINDOW = S.FREQUENCY_THRESHOLD, S.FREQUENCY_WINDOW_MS


@pytest.mark.parametrize("extra", [0, 1, 4])
def test_every_transaction_past_the_threshold_alerts(spark, extra):
    gap = WINDOW // (MOST + extra)
    found = reasons(spark, [i * gap for i in range(MOST + extra)])
    assert found == [f"빈번한 거래 (1분 내 {MOST}회 초과): user-1, {MOST + 1 + i}회" for i in range(extra)]


@pytest.mark.parametrize("overshoot, n", [(0, 1), (1, 0)])
@pytest.mark.parametrize("place", [0, MOST // 2, MOST - 1])
def test_window_edges(spark, place, overshoot, n):
    """Both ends belong to the window, wherever the transactions between them lie."""
    between = [1 + i if i < place else WINDOW - MOST + i for i in range(MOST - 1)]
    assert len(reasons(spark, [0, *between, WINDOW + overshoot])) == n


def test_bursts_apart_do_not_add_up(spark):
    assert reasons(spark, [start + i for start in (0, 2 * WINDOW) for i in range(MOST)]) == []


@pytest.mark.parametrize("copies", [1, MOST, 3 * MOST])
def test_one_millisecond_counts_once(spark, copies):
    assert reasons(spark, [17] * copies) == []


def test_every_transaction_of_a_counted_millisecond_alerts(spark):
    found = reasons(spark, [0, 1, 2, 3, 4, 5, 5, 5])
    assert len(found) == 3 and all(r.endswith("6회") for r in found)


def test_users_do_not_mix(spark):
    rows = transactions(spark, [{"ms": i * 1000, "user": f"user-{i % 2}"} for i in range(6)])
    assert rules.window_alerts(rows, rules.high_frequency()).count() == 0


def test_multi_country(spark):
    def run(*visits):
        rows = transactions(spark, [{"ms": ms, "country": c} for ms, c in visits])
        return [r.reason for r in rules.window_alerts(rows, rules.multi_country()).collect()]

    assert run((0, "KR"), (60_000, "US"), (120_000, "JP")) == ["다중 국가 거래 (10분 내 3개 국가): JP, KR, US"]
    assert run((0, "KR"), (60_000, "US"), (120_000, "KR")) == []
    assert len(run((0, "KR"), (300_000, "US"), (600_000, "JP"))) == 1
    assert run((0, "KR"), (300_000, "US"), (600_001, "JP")) == []


def test_tumbling_windows(spark):
    rows = transactions(spark, [{"id": f"t{i}", "ms": ms} for i, ms in enumerate([0, 1, 2, 3, 4, 59_999, 60_000, 60_001])])
    alerts = rules.tumbling_alerts(rows, alert_ts=F.col("event_ts"))
    assert fired(alerts) == ["t5"] and alerts.first().reason.endswith("user-1, 6회")


def test_detect_equals_the_rules_one_by_one(spark):
    """Also for rows without user or country, repeated rows and two window rules."""
    rows = [{"ms": (i * 137) % 900, "user": f"user-{i % 3}", "country": ["KR", "US", "JP", None][i % 4]} for i in range(60)]
    rows += [{"id": "none", "user": None, "amount": 3_000_000}, {"id": "t3", "ms": 411, "user": "user-0"}]
    table = transactions(spark, rows)
    windows = [rules.high_frequency(2, 300), rules.multi_country(3, 200)]
    key = lambda frame: sorted(map(str, frame.collect()))
    parts = [rules.stateless_alerts(table, alert_ts=F.col("event_ts"))]
    parts += [rules.window_alerts(table, rule, F.col("event_ts")) for rule in windows]
    got = key(rules.detect(table, windows=windows, alert_ts=F.col("event_ts")))
    assert got == sorted(line for part in parts for line in key(part)) and len(got) > 60
    alone = rules.detect(table, stateless=[], windows=windows, alert_ts=F.col("event_ts"))
    assert key(alone) == sorted(line for part in parts[1:] for line in key(part))


def test_detect_unions_all_rules(spark):
    rows = transactions(spark, [{"ms": i, "amount": 1_500_000, "country": "US"} for i in range(6)])
    counts = {r.rule_name: r["count"] for r in rules.detect(rows).groupBy("rule_name").count().collect()}
    assert counts == {S.HIGH_VALUE: 6, S.FOREIGN_COUNTRY: 6, S.HIGH_FREQUENCY: 1}


def test_transaction_validity(spark):
    good = {"id": "ok", "user": "user-10", "amount": 1_000, "country": "KR"}
    changes = {
        "user": ["user-0", "user-11", "user-1x", None], "amount": [999, 1_500_001, None], "country": ["kr", "KOR", None],
        "version": ["2.0", None], "currency": ["USD"], "id": [""],
    }
    bad = [{**good, key: value} for key, values in changes.items() for value in values]
    flags = transactions(spark, [good, *bad]).select(quality.transaction_valid().alias("v")).collect()
    assert [r.v for r in flags] == [True] + [False] * len(bad)


def test_alert_validity_and_order(spark):
    alerts = rules.stateless_alerts(
        transactions(spark, [{"id": "x", "amount": 1_200_000}]), alert_ts=F.col("event_ts") + F.expr("INTERVAL 1 SECOND")
    )
    cases = [
        (alerts, True, True),
        (alerts.withColumn("severity", F.lit("CRITICAL")), False, True),
        (alerts.withColumn("reason", F.repeat(F.lit("x"), 201)), False, True),
        (alerts.withColumn("rule_name", F.lit("MULTI_COUNTRY")), False, True),
        (alerts.withColumn("alert_timestamp", F.lit(f"{(START - timedelta(seconds=1)).isoformat()}Z")), True, False),
        (alerts.withColumn("alert_timestamp", F.lit("soon")), True, False),
    ]
    for frame, valid, ordered in cases:
        row = frame.select(quality.alert_valid().alias("v"), quality.alert_chronological().alias("o")).first()
        assert (row.v, row.o) == (valid, ordered)


def test_texts(spark):
    row = spark.range(1).select(
        texts.display_won(F.lit(None).cast("bigint")).alias("none"),
        texts.severity_priority(F.lit("critical")).alias("critical"),
        texts.severity_priority(F.lit("??")).alias("unknown"),
        texts.normalize_rule_name(F.lit("RAPID_TRANSACTION")).alias("alias"),
        texts.normalize_rule_name(F.lit("OTHER")).alias("other"),
        texts.parse_enum(F.lit("in_progress"), S.STATUSES).alias("parsed"),
        texts.parse_enum(F.lit("done"), S.STATUSES).alias("unparsed"),
        texts.utf16_length(F.lit("a😀")).alias("units"),
    ).first()
    assert tuple(row) == ("0원", 4, 0, S.HIGH_FREQUENCY, "OTHER", "IN_PROGRESS", None, 3)


def _rules(spark, *conditions):
    rows = [(f"r{i}", f"RULE_{i}", f"rule {i}", "SIMPLE_RULE", "HIGH", True, c, None, None) for i, c in enumerate(conditions)]
    return spark.createDataFrame(rows, S.RULES)


def test_dynamic_rules(spark):
    table = _rules(
        spark,
        '{"type":"simple","field":"amount","operator":">","value":1500000}',
        '{"type":"simple","field":"amount","operator":"IN","value":[1000, 2000]}',
        '{"type":"simple","field":"userId","operator":"!=","value":"user-1"}',
        '{"type":"simple","field":"countryCode","operator":"=","value":"US"}',
    )
    rows = transactions(
        spark,
        [{"id": "a", "amount": 2_000_000}, {"id": "b", "amount": 2_000, "country": "US"}, {"id": "c", "user": "user-2"}],
    )
    found = dynamic_rules.dynamic_alerts(rows, table, F.col("event_ts"))
    assert sorted((r.rule_id, r.original_transaction.transaction_id) for r in found.collect()) == [
        ("r0", "a"), ("r1", "b"), ("r2", "c"), ("r3", "b"),
    ]


def test_equality_rules_with_many_values(spark):
    """Lists are looked up by value, once per rule, also where a value repeats."""
    listed = ",".join(str(i % 500) for i in range(3_000))
    table = _rules(
        spark,
        f'{{"type":"simple","field":"amount","operator":"IN","value":[{listed}]}}',
        '{"type":"simple","field":"userId","operator":"IN","value":["user-2","user-2","user-3"]}',
        '{"type":"simple","field":"amount","operator":"=","value":"007"}',
    )
    rows = transactions(spark, [{"id": "a", "amount": 7, "user": "user-2"}, {"id": "b", "amount": 500}])
    found = dynamic_rules.dynamic_alerts(rows, table, F.col("event_ts"))
    assert sorted((r.rule_id, r.original_transaction.transaction_id) for r in found.collect()) == [
        ("r0", "a"), ("r1", "a"), ("r2", "a"),
    ]


def test_dry_run_takes_one_rule(spark):
    two = _rules(spark, *2 * ['{"type":"simple","field":"amount","operator":">","value":5}'])
    with pytest.raises(ValueError):
        dynamic_rules.dry_run(transactions(spark, [{}]), two)


def test_dry_run(spark):
    rule = _rules(spark, '{"type":"simple","field":"amount","operator":">","value":1500000}').withColumn(
        "description", F.lit("큰 거래")
    )
    rows = transactions(spark, [{"id": "hit", "amount": 2_000_000}, {"id": "miss", "amount": 1_000_000}])
    found = {r.transaction_id: (r.matched, r.result) for r in dynamic_rules.dry_run(rows, rule).collect()}
    assert found == {"hit": (True, "매칭됨 - 큰 거래: 2,000,000원"), "miss": (False, "매칭 안됨")}
