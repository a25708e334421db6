from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from builders import START, history as rows_of
from builders import transactions
from txnwatch.functions import times
from txnwatch.operators import analytics, history, latency, metrics, quality, rules
from txnwatch.sources import ledger, tables

NOW = START + timedelta(days=1)


@pytest.mark.parametrize(
    "bad",
    [
        {"page": -1}, {"size": 0}, {"size": 101}, {"start": NOW, "end": START}, {"end": NOW + timedelta(days=1)},
        {"start": NOW + timedelta(days=1)}, {"rule_name": "OTHER"}, {"user_id": "user 1"}, {"user_id": ""}, {"status": "DONE"},
    ],
)
def test_search_arguments(bad):
    with pytest.raises(ValueError):
        history.Search(as_of=NOW, **bad)


def test_search_arguments_at_the_limits():
    for good in ({"size": 1}, {"size": 100}, {"start": START, "end": START}, {"user_id": "user-1"}):
        history.Search(as_of=NOW, **good)


def test_default_range_only_without_dates(spark):
    old = START - timedelta(days=30)
    frame = rows_of(spark, [{"alert_timestamp": old}, {"alert_timestamp": START}, {"alert_timestamp": NOW + timedelta(days=2)}])

    def ids(**kw):
        return [r.alert_id for r in history.search_page(frame, history.Search(as_of=NOW, **kw)).collect()]

    assert ids() == ["a0001"]
    assert ids(start=old) == ["a0002", "a0001", "a0000"]
    assert ids(end=START) == ["a0001", "a0000"]


def test_combined_search(spark):
    frame = rows_of(
        spark,
        [{"user_id": "user-10"}, {"user_id": "user-10", "status": "COMPLETED"}, {"user_id": "user-2"},
         {"user_id": "user-10", "rule_name": "FOREIGN_COUNTRY"}],
    )
    search = history.Search(user_id="user-10", rule_name="HIGH_AMOUNT", status="UNREAD", as_of=NOW)
    assert [r.alert_id for r in history.search_page(frame, search).collect()] == ["a0000"]


def test_pages_cover_everything_once(spark):
    frame = rows_of(spark, [{"alert_timestamp": START + timedelta(seconds=i // 4)} for i in range(23)])
    seen = []
    for page in range(4):
        search = history.Search(page=page, size=7, as_of=NOW)
        seen += [r.alert_id for r in history.search_page(frame, search).collect()]
        meta = history.page_meta(frame, search).first()
        assert (meta.total_elements, meta.total_pages) == (23, 4)
        assert (meta.has_next, meta.has_previous) == (page < 3, page > 0)
    assert len(seen) == len(set(seen)) == 23
    nothing = history.page_meta(frame, history.Search(user_id="nobody", as_of=NOW)).first()
    assert (nothing.total_pages, nothing.has_next) == (0, False)


def test_deep_pages_equal_plain_pages(spark):
    frame = rows_of(spark, [{"alert_timestamp": START + timedelta(seconds=(i * 7) % 30)} for i in range(60)])
    for page in (1, 3, 8, 9):
        search = history.Search(page=page, size=7, as_of=NOW)
        plain, deep = (of(frame, search).collect() for of in (history.search_page, history.far_page))
        assert [r.alert_id for r in plain] == [r.alert_id for r in deep], page


def test_page_is_cut_before_it_is_sorted(spark):
    frame = rows_of(spark, [{"amount": 100 - i} for i in range(10)])
    page = history.search_page(frame, history.Search(size=3, as_of=NOW))
    assert [r.amount for r in history.sort_page(page, "amount").collect()] == [91, 92, 93]
    with pytest.raises(ValueError):
        history.sort_page(page, "alert_id")


def test_append_prunes_and_adds_once(spark, tmp_path):
    path = f"{tmp_path}/history"
    frame = rows_of(spark, [{"alert_timestamp": START + timedelta(days=i % 3)} for i in range(9)])
    tables.append_history(frame.limit(5), path)
    tables.append_history(frame.unionByName(frame), path)
    stored = tables.read_history(spark, path)
    assert stored.count() == 9 and len(list(Path(path).glob("alert_date=*"))) == 3
    found = history.matching(stored, history.Search(start=START, end=START + timedelta(hours=1), as_of=NOW))
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(alert_date" in plan


@pytest.mark.parametrize("bucket_rows", [2, 200_000])
def test_append_knows_an_alert_at_any_time(spark, tmp_path, monkeypatch, bucket_rows):
    monkeypatch.setattr(ledger, "BUCKET_ROWS", bucket_rows)
    path = f"{tmp_path}/history"
    tables.append_history(rows_of(spark, [{} for _ in range(5)]), path)
    again = rows_of(spark, [{"alert_timestamp": START + timedelta(days=i)} for i in (2, 40, -3, 0, 9, 1)])
    tables.append_history(again, path)
    stored = tables.read_history(spark, path).select("alert_id", "alert_timestamp").collect()
    assert sorted(r.alert_id for r in stored) == [f"a{i:04d}" for i in range(6)]
    assert all(r.alert_timestamp < START + timedelta(days=1) for r in stored if r.alert_id < "a0005")


def test_flatten_rejects_unknown_severity(spark):
    alerts = rules.stateless_alerts(transactions(spark, [{"amount": 2_000_000}]), alert_ts=F.col("event_ts"))
    alerts = alerts.unionByName(alerts.withColumn("severity", F.lit("CRITICAL")))
    alerts = alerts.withColumn("rule_name", F.lit("HIGH_AMOUNT"))
    good, rejected = history.flatten(alerts)
    row = good.first()
    assert good.count() == rejected.count() == 1
    assert (row.rule_name, row.status, row.alert_timestamp, row.processed_at) == ("HIGH_VALUE", "UNREAD", START, None)


def test_history_checks(spark):
    bad = [
        ({"amount": 0}, "AMOUNT_NOT_POSITIVE"), ({"reason": "x" * 9}, "REASON_LENGTH"), ({"reason": "x" * 1001}, "REASON_LENGTH"),
        ({"currency": "KR"}, "CURRENCY_FORMAT"), ({"country_code": "kr"}, "COUNTRY_FORMAT"),
        ({"alert_timestamp": NOW + timedelta(seconds=1)}, "ALERT_IN_FUTURE"), ({"status": "COMPLETED"}, "COMPLETED_WITHOUT_TIME"),
        ({"action_note": "x" * 2001}, "NOTE_TOO_LONG"), ({"severity": "CRITICAL"}, "SEVERITY_UNKNOWN"),
        ({"status": "DONE"}, "STATUS_UNKNOWN"), ({"user_id": None}, "MISSING_FIELD"),
    ]
    frame = rows_of(spark, [change for change, _ in bad] + [{}, {"reason": "x" * 10}, {"action_note": "x" * 2000}])
    checked = quality.with_violations(frame, quality.history_checks(times.at(NOW)))
    got = [r.violations for r in checked.orderBy("alert_id").collect()]
    assert got == [[code] for _, code in bad] + [[], [], []]
    good, rejected = quality.split(checked)
    assert (good.count(), rejected.count()) == (3, len(bad))


def test_csv_report(spark, tmp_path):
    report = analytics.rule_stats(rows_of(spark, [{}, {"status": "COMPLETED"}]))
    path = tables.export_csv(report, str(tmp_path), "by-rule", date(2025, 11, 1), date(2025, 11, 7))
    assert path.endswith("by-rule-alerts-2025-11-01-to-2025-11-07.csv")
    assert tables.report_name("hourly", date(2025, 11, 10)) == "hourly-alerts-2025-11-10.csv"
    (part,) = Path(path).glob("part-*.csv")
    content = part.read_bytes()
    assert content.startswith(b"\xef\xbb\xbfrule_name,n,percentage,completed,completion_rate\n")
    assert b"HIGH_VALUE,2,100.0,1,50.0" in content


def test_archive(spark, tmp_path):
    frame = rows_of(spark, [{"alert_timestamp": NOW - timedelta(days=d)} for d in (1, 90, 91, 200)])
    kept, archived = tables.archive_split(frame, NOW)
    assert (kept.count(), archived.count()) == (2, 2)
    tables.write_by_month(archived, f"{tmp_path}/archive")
    assert len(list(Path(f"{tmp_path}/archive").glob("alert_month=*"))) == 2


def test_latency(spark):
    txns = transactions(spark, [{"id": "a", "ms": 0}, {"id": "a", "ms": 1000}, {"id": "b", "ms": 0}]).withColumn(
        "event_id", F.monotonically_increasing_id()
    ).withColumn("event_id", F.col("event_ms"))
    alerts = rows_of(
        spark,
        [{"transaction_id": "a", "alert_timestamp": START + timedelta(seconds=3)},
         {"transaction_id": "b", "alert_timestamp": START - timedelta(seconds=1)},
         {"transaction_id": "zz"}],
    )
    rows = latency.latencies(alerts, txns)
    assert [r.latency_us for r in rows.collect()] == [2_000_000]
    assert [r.transaction_id for r in latency.unmatched(alerts, txns).collect()] == ["zz"]


def test_histogram_rounds_like_two_decimal_text(spark):
    micros = [0, 994_999, 995_000, 995_001, 1_994_999, 1_995_000, 2_995_000, 4_994_999, 4_995_000, 9_995_000, 9_995_001, 10**8]
    frame = spark.createDataFrame([(m,) for m in micros], "latency_us bigint")
    got = {r.bucket: r.n for r in latency.latency_histogram(frame).collect()}
    want = {label: 0 for _, label in latency.BUCKETS}
    for m in micros:
        shown = float(f"{m / 1e6:.2f}")
        want[[label for low, label in latency.BUCKETS if shown >= low][-1]] += 1
    assert got == want


def test_series_has_empty_steps_and_whole_rates(spark):
    rows = transactions(spark, [{"ms": ms} for ms in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 12_000]])
    points = [(r.n, r.tps, r.total_transactions) for r in metrics.tps_series(rows).orderBy("point_ms").collect()]
    assert points == [(10, 2, 10), (0, 0, 10), (1, 0, 11)]


def test_rate_window_is_half_open(spark):
    frame = rows_of(spark, [{"alert_timestamp": START}, {"alert_timestamp": START + timedelta(seconds=59)}])
    series = {r.point_ms: r for r in metrics.alert_rate_series(frame).collect()}
    base = min(series) - 5_000
    assert series[base + 5_000].alerts_per_minute == 1 and series[base + 60_000].alerts_per_minute == 2
    assert series[base + 65_000].alerts_per_minute == 1 and max(series) == base + 55_000 + 60_000
    assert series[base + 60_000].by_rule == {"HIGH_VALUE": 2, "FOREIGN_COUNTRY": 0, "HIGH_FREQUENCY": 0}


def test_warning_against_trailing_average(spark):
    points = [(i * 1000, 10 if i == 30 else 1) for i in range(40)]
    frame = spark.createDataFrame(points, "point_ms bigint, alerts_per_minute bigint")
    rows = metrics.with_warning(frame, window_ms=10_000).orderBy("point_ms").collect()
    assert [r.point_ms for r in rows if r.is_warning] == [30_000]
    for r in rows:
        inside = [v for t, v in points if r.point_ms - 10_000 <= t <= r.point_ms]
        assert (r.average_value, r.max_value) == (sum(inside) / len(inside), max(inside))


def test_tps_and_service_checks(spark):
    frame = spark.createDataFrame(
        [(0, 5, 10, 10), (7, 5, 10, 10), (5000, 10_001, 10, 10), (5000, 1, 9, 10)],
        "point_ms bigint, tps bigint, total_transactions bigint, previous_total bigint",
    )
    got = [r.violations for r in quality.with_violations(frame, quality.tps_point_checks()).collect()]
    assert got == [[], ["TM-001"], ["TM-002"], ["TM-003"]]
    layout = "service_name string, status string, last_checked timestamp, response_time bigint, memory_usage bigint, " \
             "error_type string, error_message string"
    services = spark.createDataFrame(
        [("alert-service", "UP", NOW, 45, 128, None, None), ("other", "UP", NOW, None, 9000, None, None),
         ("alert-service", "DOWN", NOW - timedelta(seconds=11), None, None, None, "x" * 257), ("alert-service", "?", NOW, None, None, None, None)],
        layout,
    )
    got = [r.violations for r in quality.with_violations(services, quality.service_checks(times.at(NOW))).collect()]
    assert got == [[], ["SH-001", "SH-004", "SH-005"], ["SH-003", "SH-006", "SH-007"], ["SH-002"]]


def test_service_status(spark):
    beats = [("alert-service", NOW, 1, 10, True), ("fraud-detector", NOW, 1, 5_001, True),
             ("websocket-gateway", NOW - timedelta(seconds=11), 1, 10, True), ("frontend-dashboard", NOW, 1, 10, False),
             ("frontend-dashboard", NOW - timedelta(seconds=5), 0, 10, True)]
    frame = spark.createDataFrame(beats, "service_name string, checked_at timestamp, seq bigint, response_ms bigint, ok boolean")
    got = {r.service_name: (r.status, r.error_type) for r in metrics.service_status(frame, NOW).collect()}
    assert got == {
        "alert-service": ("UP", None), "fraud-detector": ("DOWN", "TIMEOUT"), "websocket-gateway": ("DOWN", "NETWORK_ERROR"),
        "frontend-dashboard": ("DOWN", "HTTP_ERROR"), "transaction-generator": ("DOWN", "NETWORK_ERROR"),
    }


def test_day_bounds():
    low, high = history.day_range(date(2025, 11, 1), date(2025, 11, 11))
    assert low == datetime(2025, 11, 1) and high == datetime(2025, 11, 11, 23, 59, 59, 999000)


def test_one_search_has_one_now(spark):
    search = history.Search()
    assert search.with_default_range() == search.with_default_range()
    assert str(history.conditions(search, [])) == str(history.conditions(search, []))
