"""The registered queries: each reads the given tables whole and returns one DataFrame.

Result columns are plain (numbers, text, booleans; times as epoch milliseconds)
so that any engine can be asked for the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import texts, times
from txnwatch.operators import (
    analytics,
    cases,
    dynamic_rules,
    history,
    latency,
    metrics,
    quality,
    rules,
    trailing,
)
from txnwatch.plans import views
from txnwatch.session import shared_dir
from txnwatch.sources import records, tables
from txnwatch.streaming import jobs, upkeep

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries. The test tables have a few events per
# user and day, so windows and steps are wider than the defaults.
AS_OF = datetime(2024, 1, 31)
STATUS_AS_OF = datetime(2024, 1, 29)
SEEN_UNTIL = datetime(2024, 1, 15)
DAY_MS = 86_400_000
HOUR_MS = 3_600_000

RULE_ROWS = [
    ("r1", "ABOVE_900K", "90만원을 넘는 거래", "SIMPLE_RULE", "CRITICAL", True,
     '{"type":"simple","field":"amount","operator":">","value":900000}'),
    ("r2", "WATCHED_COUNTRY", "감시 국가 거래", "SIMPLE_RULE", "MEDIUM", True,
     '{"type":"simple","field":"countryCode","operator":"IN","value":["US","CN"]}'),
    ("r3", "WATCHED_USER", "감시 사용자", "SIMPLE_RULE", "LOW", False,
     '{"type":"simple","field":"userId","operator":"=","value":"user-7"}'),
    ("r4", "SMALL_VALUE", "소액 거래", "SIMPLE_RULE", "LOW", True,
     '{"type":"simple","field":"amount","operator":"<","value":50000}'),
    ("r5", "NOT_HOME", "국외 거래", "SIMPLE_RULE", "HIGH", True,
     '{"type":"simple","field":"countryCode","operator":"!=","value":"KR"}'),
    ("r6", "BAD_OPERATOR", "잘못된 연산자", "SIMPLE_RULE", "LOW", True,
     '{"type":"simple","field":"amount","operator":">=","value":1}'),
    ("r7", "BAD_FIELD", "잘못된 필드", "SIMPLE_RULE", "LOW", True,
     '{"type":"simple","field":"currency","operator":"=","value":"KRW"}'),
    ("r8", "BAD_JSON", "잘못된 조건", "SIMPLE_RULE", "LOW", True, '{"type":"simple","field":'),
    ("r9", "BAD_VALUE", "잘못된 값", "SIMPLE_RULE", "LOW", True,
     '{"type":"simple","field":"amount","operator":">","value":"many"}'),
    ("r10", "TWICE", "같은 이름", "SIMPLE_RULE", "LOW", True, '{"type":"simple","field":"amount","operator":"=","value":1}'),
    ("r11", "TWICE", "같은 이름", "SIMPLE_RULE", "LOW", True, '{"type":"simple","field":"amount","operator":"=","value":2}'),
    ("r12", "WITH_STATE", "상태 규칙", "STATEFUL_RULE", "LOW", True, '{"type":"simple","field":"amount","operator":"=","value":3}'),
    ("r13", "OTHER_TYPE", "다른 종류", "SIMPLE_RULE", "LOW", True, '{"type":"window","field":"amount","operator":"=","value":4}'),
]


def rule_table(spark: SparkSession) -> DataFrame:
    layout = "rule_id string, rule_name string, description string, rule_type string, severity string, " \
             "is_active boolean, condition_json string"
    return spark.createDataFrame(RULE_ROWS, layout)


def _ms(column: str):
    return F.unix_millis(column)


def _flat_alerts(alerts: DataFrame) -> DataFrame:
    inner = F.col("original_transaction")
    return alerts.select(
        "alert_id",
        inner["transaction_id"].alias("transaction_id"),
        inner["user_id"].alias("user_id"),
        inner["amount"].alias("amount"),
        "rule_type",
        "rule_name",
        "severity",
        "reason",
        "alert_timestamp",
    )


# --- records --------------------------------------------------------------------
def _decoded_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "offset", "problem", "transaction_id", "user_id", "event_ms", "time_ok", "schema_ok", "is_valid"
    )


def decode_quarantine(spark, sf):
    return _decoded_columns(records.decoded_transactions(views.raw_records(spark, sf)))


def txn_validity(spark, sf):
    return views.transactions(spark, sf).select(
        "transaction_id",
        quality.schema_ok().alias("schema_ok"),
        quality.transaction_valid().alias("is_valid"),
        F.col("user_id").rlike(quality.USER_ID).alias("user_ok"),
        quality.is_uuid(F.col("transaction_id")).alias("uuid_ok"),
        texts.display_won(F.col("amount")).alias("amount_text"),
        times.display_time(F.col("timestamp")).alias("time_text"),
    )


def transaction_records(spark, sf):
    return records.encode_transactions(views.transactions(spark, sf))


def alert_records(spark, sf):
    headers = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.decode(h["value"], "UTF-8")))
    return records.encode_alerts(views.alerts(spark, sf)).select(
        "key", "value", F.array_join(headers, ";").alias("headers")
    )


def decoded_alerts(spark, sf):
    """Encode, put on the wire, decode: what an alert consumer sees."""
    encoded = records.encode_alerts(views.alerts(spark, sf)).select(F.encode("value", "UTF-8").alias("value"))
    good, _ = records.decode_alerts(encoded)
    return _flat_alerts(good)


# --- detection ------------------------------------------------------------------
def _stateless(rule):
    def run(spark, sf):
        alerts = rules.stateless_alerts(views.transactions(spark, sf), [rule], F.col("event_ts"))
        summary = texts.summary(F.col("severity"), F.col("user_id"), F.col("reason")).alias("summary")
        return _flat_alerts(alerts).select("*", summary)

    return run


def _windowed(rule, rows=views.transactions):
    def run(spark, sf):
        return _flat_alerts(rules.window_alerts(rows(spark, sf), rule, F.col("event_ts")))

    return run


def all_alerts(spark, sf):
    return _flat_alerts(
        rules.detect(
            views.transactions(spark, sf), windows=[rules.high_frequency(window_ms=DAY_MS)], alert_ts=F.col("event_ts")
        )
    )


def high_frequency_tumbling(spark, sf):
    rows = views.transactions(spark, sf)
    return _flat_alerts(rules.tumbling_alerts(rows, 3, DAY_MS, alert_ts=F.col("event_ts")))


def alert_validity(spark, sf):
    return views.alerts(spark, sf).select(
        "alert_id", quality.alert_valid().alias("is_valid"), quality.alert_chronological().alias("in_order")
    )


def dynamic_rule_matches(spark, sf):
    matched = dynamic_rules.dynamic_alerts(views.transactions(spark, sf), rule_table(spark), F.col("event_ts"))
    return _flat_alerts(matched)


def rule_validation(spark, sf):
    """Rule table check, with how many transactions each usable rule matches."""
    hits = (
        dynamic_rules.join_rules(views.transactions(spark, sf), dynamic_rules.usable(rule_table(spark)))
        .groupBy("rule_id").agg(F.count("*").alias("n"))
    )
    return dynamic_rules.parse(rule_table(spark)).join(hits, "rule_id", "left").select(
        "rule_id", F.array_join("violations", ",").alias("violations"), F.coalesce("n", F.lit(0)).alias("n")
    )


def rule_dry_run(spark, sf):
    one = rule_table(spark).filter(F.col("rule_id") == "r3")
    return dynamic_rules.dry_run(views.transactions(spark, sf), one)


# --- history --------------------------------------------------------------------
def flatten_history(spark, sf):
    rows, _ = history.flatten(views.alerts(spark, sf), created_at=times.at(AS_OF))
    return rows.select(
        "alert_id", "schema_version", "transaction_id", "user_id", "amount", "currency", "country_code",
        "rule_name", "reason", "severity", _ms("alert_timestamp").alias("alert_ms"), "status", "assigned_to",
        "action_note", _ms("processed_at").alias("processed_ms"), _ms("created_at").alias("created_ms"),
    )


def rough_history(spark, sf) -> DataFrame:
    """History rows with every kind of damage the checks look for."""
    n = F.substring_index("transaction_id", "-", -1).cast("long")
    rows = views.alert_history(spark, sf)
    return (
        rows.withColumn("amount", F.col("amount") - 300000)
        .withColumn("reason", F.expr("substring(reason, 1, 5 + CAST(amount % 20 AS INT))"))
        .withColumn("currency", F.when(n % 17 == 0, "krw").otherwise(F.col("currency")))
        .withColumn("country_code", F.when(n % 13 == 0, "K").otherwise(F.col("country_code")))
        .withColumn("processed_at", F.when(n % 3 != 0, F.col("processed_at")))
        .withColumn("action_note", F.when(n % 11 == 0, F.repeat(F.lit("x"), 1990 + (n % 20).cast("int"))))
        .withColumn("severity", F.when(n % 19 == 0, "CRITICAL").otherwise(F.col("severity")))
        .withColumn("status", F.when(n % 23 == 0, "DONE").otherwise(F.col("status")))
        .withColumn("rule_name", F.when(n % 29 != 0, F.col("rule_name")))
    )


def history_violations(spark, sf):
    checks = quality.history_checks(times.at(datetime(2024, 1, 28)))
    return quality.with_violations(rough_history(spark, sf), checks).select(
        "alert_id", F.array_join("violations", ",").alias("violations")
    )


SEARCH = history.Search(rule_name="HIGH_AMOUNT", status="UNREAD", page=1, size=20, as_of=AS_OF)
_FROM, _TO = history.day_range(date(2024, 1, 5), date(2024, 1, 20))
USER_SEARCH = history.Search(start=_FROM, end=_TO, user_id="user-7", size=100, as_of=AS_OF)


def _page(rows: DataFrame) -> DataFrame:
    return rows.select(
        "alert_id", "transaction_id", "user_id", "amount", "rule_name", "severity", "status",
        _ms("alert_timestamp").alias("alert_ms"),
    )


def history_search_page(spark, sf):
    return _page(history.search_page(views.alert_history(spark, sf), SEARCH))


def history_search_user(spark, sf):
    return _page(history.search_page(views.alert_history(spark, sf), USER_SEARCH))


def history_search_stored(spark, sf):
    """The same page, read from the stored history: the dates of the search prune its folders."""
    path = shared_dir(spark, "history")
    tables.append_history(views.alert_history(spark, sf), path)
    return _page(history.search_page(tables.read_history(spark, path), SEARCH))


def history_search_deep(spark, sf):
    """The same page, found the way a page far down is found."""
    return _page(history.far_page(views.alert_history(spark, sf), SEARCH))


def history_page_meta(spark, sf):
    meta = history.page_meta(views.alert_history(spark, sf), SEARCH)
    return meta.select(
        "total_elements", F.col("total_pages").cast("bigint"), F.col("current_page").cast("bigint"),
        F.col("page_size").cast("bigint"), "has_next", "has_previous",
    )


def history_page_sorted(spark, sf):
    page = history.search_page(views.alert_history(spark, sf), SEARCH)
    shown = _page(history.sort_page(page, "amount", descending=True))
    return cases.with_rank(shown, [F.col("amount").desc(), F.col("alert_id")])


def latest_history(spark, sf):
    return _page(history.latest(views.alert_history(spark, sf), 10))


def history_append(spark, sf):
    """Append everything, then the second half again: nothing is stored twice."""
    path = shared_dir(spark, "history")
    rows = views.alert_history(spark, sf)
    tables.append_history(rows, path)
    tables.append_history(rows.filter(F.col("alert_timestamp") >= times.at(SEEN_UNTIL)), path)
    stored = tables.read_history(spark, path)
    return stored.groupBy(F.col("alert_date").cast("string").alias("alert_date")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("total_amount"), F.min("alert_id").alias("first_id")
    )


def history_append_days(spark, sf):
    """Every alert detected again, one to three days later, twice: the ids keep the first ones."""
    path = shared_dir(spark, "history")
    rows = views.alert_history(spark, sf)
    tables.append_history(rows, path)
    for days in (1, 3):
        later = F.col("alert_timestamp") + F.make_dt_interval(days=F.lit(days))
        tables.append_history(rows.withColumn("alert_timestamp", later), path)
    stored = tables.read_history(spark, path)
    return stored.groupBy(F.col("alert_date").cast("string").alias("alert_date")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("total_amount"), F.min("alert_id").alias("first_id")
    )


def archive_split(spark, sf):
    kept, archived = tables.archive_split(views.alert_history(spark, sf), AS_OF, days=10)
    return (
        kept.withColumn("part", F.lit("kept"))
        .unionByName(archived.withColumn("part", F.lit("archived")))
        .groupBy("part", "alert_month")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("total_amount"))
    )


def archive_written(spark, sf):
    """Both parts written by month and read back."""
    path = shared_dir(spark, "archive")
    for part, rows in zip(("kept", "archived"), tables.archive_split(views.alert_history(spark, sf), AS_OF, days=10)):
        tables.write_by_month(rows, f"{path}/part={part}")
    stored = spark.read.parquet(path)
    return stored.groupBy("part", F.col("alert_month").cast("string").alias("alert_month")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("total_amount")
    )


def retention(spark, sf):
    as_of = datetime(2024, 1, 20)
    txns = metrics.retained(views.transactions(spark, sf), "event_ts", as_of, 1)
    alerts = metrics.retained(views.alert_history(spark, sf), "alert_timestamp", as_of, 24)
    return (
        txns.select(F.lit("transactions").alias("kind"), "event_ms")
        .unionByName(alerts.select(F.lit("alerts").alias("kind"), _ms("alert_timestamp").alias("event_ms")))
        .groupBy("kind")
        .agg(F.count("*").alias("n"), F.min("event_ms").alias("first_ms"))
    )


# --- cases ----------------------------------------------------------------------
def _listed(rows: DataFrame) -> DataFrame:
    return rows.select("alert_id", "user_id", "rule_name", "severity", "status", "assigned_to")


def recent_alerts(spark, sf):
    return cases.with_position(cases.recent(views.alert_history(spark, sf))).select(
        "alert_id", "user_id", "rule_name", "position"
    )


def recent_filtered(spark, sf):
    return _listed(cases.list_alerts(views.alert_history(spark, sf), status="UNREAD", severity="MEDIUM"))


def recent_first_filter(spark, sf):
    return _listed(
        cases.list_alerts(
            views.alert_history(spark, sf), assigned_to="agent-5", severity="HIGH", precedence=True, sort_by="severity"
        )
    )


def severity_sorted(spark, sf):
    page = cases.list_alerts(views.alert_history(spark, sf), sort_by="severity")
    ranked = cases.with_rank(page, cases.severity_order())
    return ranked.select(
        "alert_id", "severity", texts.severity_name(F.col("severity")).alias("severity_name"),
        texts.status_name(F.col("status")).alias("status_name"), "position",
    )


def alert_display(spark, sf):
    """Names and day bounds as a list shows them, from loosely written input."""
    rows = views.alert_history(spark, sf)
    short = F.when(F.col("status") == "COMPLETED", "done").otherwise(F.lower("status"))
    alias = F.when(F.col("rule_name") == S.HIGH_VALUE, "HIGH_AMOUNT").otherwise(F.col("rule_name"))
    return rows.select(
        "alert_id",
        texts.parse_enum(short, S.STATUSES).alias("status"),
        texts.status_name(texts.parse_enum(short, S.STATUSES)).alias("status_name"),
        texts.normalize_rule_name(alias).alias("rule_name"),
        texts.severity_priority(F.lower("severity")).cast("bigint").alias("priority"),
        F.unix_millis(times.day_start(F.col("alert_timestamp"))).alias("day_start_ms"),
        F.unix_millis(times.day_end(F.col("alert_timestamp"))).alias("day_end_ms"),
    )


def point_lookup(spark, sf):
    rows = views.alert_history(spark, sf)
    return _listed(cases.find(rows, "2e583b9f89eebf6e344fe232716e1a09"))


def status_fold(spark, sf):
    return cases.fold_commands(views.case_commands(spark, sf)).select(
        "alert_id",
        F.col("set_status").alias("status"),
        F.col("set_assignee.to").alias("assigned_to"),
        F.col("set_note").alias("action_note"),
        _ms("completed_at").alias("processed_ms"),
        "n_commands",
    )


def _status_events(spark, sf):
    return cases.status_events(views.alert_history(spark, sf), views.alert_commands(spark, sf))


def status_events(spark, sf):
    return _status_columns(_status_events(spark, sf))


def _status_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "alert_id", "seq", "cmd", "status", "assigned_to", "action_note", _ms("processed_at").alias("processed_ms")
    )


def status_event_records(spark, sf):
    return records.encode_status_events(_status_events(spark, sf))


def case_state(spark, sf):
    """Alerts after the whole command log."""
    folded = cases.apply_commands(views.alert_history(spark, sf), views.alert_commands(spark, sf))
    return folded.select(
        "alert_id", "status", "assigned_to", "action_note", _ms("processed_at").alias("processed_ms")
    )


def apply_status_changes(spark, sf):
    """Status events off the wire, merged into the alert list."""
    encoded = records.encode_status_events(_status_events(spark, sf), keep=("seq",))
    events, _ = records.decode_status_events(encoded)
    merged = cases.apply_status_events(views.alert_history(spark, sf), events)
    return merged.select(
        "alert_id", "status", "assigned_to", "action_note", _ms("processed_at").alias("processed_ms")
    )


def new_alerts_only(spark, sf):
    rows = views.alert_history(spark, sf)
    seen = rows.filter(F.col("alert_timestamp") < times.at(SEEN_UNTIL))
    return cases.new_only(rows.unionByName(rows), seen).select("alert_id", "rule_name", "user_id")


# --- analytics ------------------------------------------------------------------
def status_counts(spark, sf):
    return analytics.status_counts(views.alert_history(spark, sf), datetime(2024, 1, 10))


def hourly_counts(spark, sf):
    return analytics.hourly_counts(views.alert_history(spark, sf), day=date(2024, 1, 17))


def hourly_counts_last_day(spark, sf):
    return analytics.hourly_counts(views.alert_history(spark, sf), as_of=datetime(2024, 1, 17, 13, 30))


def rule_stats(spark, sf):
    return analytics.rule_stats(views.alert_history(spark, sf), datetime(2024, 1, 3), AS_OF)


def _rollup(unit):
    def run(spark, sf):
        rows = analytics.period_rollup(views.alert_history(spark, sf), unit)
        return rows.withColumn("period", F.date_format("period", "yyyy-MM-dd"))

    return run


def rule_coverage(spark, sf):
    return analytics.rule_coverage(views.alert_history(spark, sf))


def txn_profile(spark, sf):
    return analytics.transaction_profile(views.transactions(spark, sf))


def report_csv(spark, sf):
    """The rule report, written as CSV and read back."""
    stats = analytics.rule_stats(views.alert_history(spark, sf), _FROM, _TO)
    report = stats.select("rule_name", "n", "completed")
    path = tables.export_csv(report, shared_dir(spark, "reports"), "by-rule", date(2024, 1, 5), date(2024, 1, 20))
    return spark.read.option("header", True).schema("rule_name string, n bigint, completed bigint").csv(path)


def _read_back(spark, report, kind, *days):
    path = tables.export_csv(report, shared_dir(spark, "reports"), kind, *days)
    return spark.read.option("header", True).schema(report.schema).csv(path)


def rule_csv(spark, sf):
    """The whole rule report with shares and completion rates, written as CSV and read back."""
    return _read_back(spark, rule_stats(spark, sf), "by-rule", date(2024, 1, 3), date(2024, 1, 30))


def hourly_csv(spark, sf):
    """The hourly report of one day, written as CSV and read back."""
    return _read_back(spark, hourly_counts(spark, sf), "hourly", date(2024, 1, 17))


def _latencies(spark, sf):
    return latency.latencies(views.timed_alerts(spark, sf), views.transactions(spark, sf))


def latency_stats(spark, sf):
    return latency.latency_stats(_latencies(spark, sf))


def latency_histogram(spark, sf):
    return latency.latency_histogram(_latencies(spark, sf))


def latency_unmatched(spark, sf):
    """Alerts on transactions that a shortened transaction log no longer holds."""
    kept = views.transactions(spark, sf).filter(F.col("event_ts") >= times.at(datetime(2024, 1, 3)))
    return latency.unmatched(views.timed_alerts(spark, sf), kept).select("alert_id", "transaction_id")


# --- metrics --------------------------------------------------------------------
def _tps(spark, sf):
    return metrics.tps_series(views.transactions(spark, sf), step_seconds=300, unit_seconds=60)


def _rates(spark, sf, hidden=()):
    rows = views.alert_history(spark, sf)
    return metrics.alert_rate_series(rows, window_seconds=3600, step_seconds=300, hidden=hidden)


def tps_series(spark, sf):
    return _tps(spark, sf).select("point_ms", "n", "tps", "total_transactions")


def alert_rate_series(spark, sf):
    return _rates(spark, sf).withColumn("by_rule", F.to_json("by_rule"))


def alert_rate_visible(spark, sf):
    return _rates(spark, sf, hidden=["HIGH_VALUE"]).withColumn("by_rule", F.to_json("by_rule"))


def alert_warnings(spark, sf):
    return metrics.with_warning(_rates(spark, sf), window_ms=6 * HOUR_MS).drop("by_rule")


def _bounded(spark, sf, window, step_seconds=300):
    """(throughput, alert rate) of the window before ``STATUS_AS_OF``; totals go on from the count before it."""
    bounds = (STATUS_AS_OF - window + timedelta(milliseconds=1), STATUS_AS_OF)
    txns = views.transactions(spark, sf)
    first = bounds[0].replace(second=0, microsecond=0) + timedelta(seconds=step_seconds)
    before = txns.filter(F.col("event_ts") < times.at(first)).count()
    tps = metrics.tps_series(txns, step_seconds, min(60, step_seconds), bounds=(first, bounds[1]), before=before)
    rows = views.alert_history(spark, sf)
    rates = metrics.alert_rate_series(rows, window_seconds=3600, step_seconds=step_seconds, bounds=(first, bounds[1]))
    return tps, rates


def metrics_summary(spark, sf):
    tps, rates = _bounded(spark, sf, timedelta(days=1))
    tps = metrics.summary(tps, "n", STATUS_AS_OF, DAY_MS)
    rates = metrics.summary(rates, "alerts_per_minute", STATUS_AS_OF, DAY_MS)
    return tps.withColumn("metric", F.lit("tps")).unionByName(rates.withColumn("metric", F.lit("alerts")))


def metric_backfill(spark, sf):
    since = datetime(2024, 1, 28, 12, 0)
    tps, _ = _bounded(spark, sf, timedelta(days=1))
    return metrics.back_fill(tps, since, STATUS_AS_OF, DAY_MS).select("point_ms", "n")


def metric_checks(spark, sf):
    """Validity of alert-rate points, some of them spoiled."""
    slot = F.floor(F.col("point_ms") / 300_000) % 10
    spoiled = _rates(spark, sf).select(
        F.when(slot == 1, F.col("point_ms") + 7).otherwise(F.col("point_ms")).alias("point_ms"),
        F.when(slot == 2, F.col("alerts_per_minute") + 1).when(slot == 3, F.lit(1001).cast("bigint"))
        .otherwise(F.col("alerts_per_minute")).alias("alerts_per_minute"),
        F.when(slot == 4, F.map_filter("by_rule", lambda k, _: k != "HIGH_VALUE"))
        .when(slot == 5, F.transform_values("by_rule", lambda _, n: n - 1))
        .otherwise(F.col("by_rule")).alias("by_rule"),
    )
    checked = quality.with_violations(spoiled, quality.alert_point_checks(300))
    return checked.select("point_ms", "alerts_per_minute", F.array_join("violations", ",").alias("violations"))


def tps_checks(spark, sf):
    """Validity of throughput points, some of them spoiled."""
    slot = F.floor(F.col("point_ms") / 300_000) % 7
    spoiled = _tps(spark, sf).select(
        F.when(slot == 1, F.col("point_ms") + 7).otherwise(F.col("point_ms")).alias("point_ms"),
        F.when(slot == 2, F.lit(-1).cast("bigint")).otherwise(F.col("tps")).alias("tps"),
        F.when(slot == 3, F.lit(-5).cast("bigint")).otherwise(F.col("total_transactions")).alias("total_transactions"),
        (F.col("total_transactions") - F.col("n")).alias("previous_total"),
    )
    checked = quality.with_violations(spoiled, quality.tps_point_checks(300))
    return checked.select("point_ms", "tps", "total_transactions", F.array_join("violations", ",").alias("violations"))


def service_checks(spark, sf):
    """Validity of heartbeats as service rows."""
    rows = views.heartbeats(spark, sf).select(
        F.when(F.col("seq") % 10 == 0, "other").otherwise(F.col("service_name")).alias("service_name"),
        F.when(F.col("ok"), "UP").otherwise("DOWN").alias("status"),
        F.col("checked_at").alias("last_checked"),
        (F.col("response_ms") * 2).alias("response_time"),
        (F.col("seq") % 9000).alias("memory_usage"),
        F.when(F.col("seq") % 3 == 0, "HTTP_ERROR").alias("error_type"),
        F.when(F.col("seq") % 4 == 0, F.repeat(F.lit("x"), 300)).otherwise("short").alias("error_message"),
        "seq",
    )
    checked = quality.with_violations(rows, quality.service_checks(times.at(STATUS_AS_OF)))
    return checked.select("seq", "service_name", "status", F.array_join("violations", ",").alias("violations"))


def history_length_checks(spark, sf):
    """At five-second steps an hour has exactly as many points as a history may hold."""
    services = metrics.service_status(views.heartbeats(spark, sf), STATUS_AS_OF, 2_000, 3_600)
    one = metrics.snapshot(*_bounded(spark, sf, timedelta(hours=1), 5), services, STATUS_AS_OF, HOUR_MS)
    checked = quality.with_violations(one, quality.history_length_checks())
    return checked.select(
        F.size("data.tps.history").alias("tps_points"), F.size("data.alerts.history").alias("alert_points"),
        F.array_join("violations", ",").alias("violations"),
    )


def service_status(spark, sf):
    status = metrics.service_status(views.heartbeats(spark, sf), STATUS_AS_OF, timeout_ms=2_000, stale_seconds=3_600)
    return status.select(
        "service_name", "status", _ms("last_checked").alias("checked_ms"), "response_time", "error_type"
    )


def metrics_snapshot(spark, sf):
    services = metrics.service_status(views.heartbeats(spark, sf), STATUS_AS_OF, 2_000, 3_600)
    one = metrics.snapshot(*_bounded(spark, sf, timedelta(hours=1)), services, STATUS_AS_OF, HOUR_MS)
    data = F.col("data")
    text = F.transform(data["services"], lambda s: F.concat(s["service_name"], F.lit("="), s["status"]))
    return one.select(
        "type",
        _ms("timestamp").alias("at_ms"),
        F.array_join(text, ",").alias("services"),
        data["tps"]["current"].alias("tps_current"),
        data["tps"]["average"].alias("tps_average"),
        data["tps"]["max"].alias("tps_max"),
        F.to_json(data["tps"]["history"]).alias("tps_history"),
        data["alerts"]["current"].alias("alerts_current"),
        data["alerts"]["average"].alias("alerts_average"),
        data["alerts"]["max"].alias("alerts_max"),
        F.to_json(data["alerts"]["by_rule"]).alias("alerts_by_rule"),
        F.array_join(F.transform(data["alerts"]["history"], lambda p: p["alerts_per_minute"].cast("string")), ",")
        .alias("alerts_history"),
    )


# --- streaming twins --------------------------------------------------------------
# Every twin also runs over files whose times overlap, one file per micro-batch ("_late").
LATE_FILES = 5
ROW_GROUP_BYTES = 8 << 20
"""One task writes a file of the stream; in row groups of this size many tasks read it."""


def _stream(spark, sf, late=False):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if not late:
        return tables.stream_table(spark, sf, "events")
    folder = shared_dir(spark, "late")
    for i in range(LATE_FILES):
        some = spark.read.parquet(f"{sf}/events.parquet").filter(F.pmod("event_id", F.lit(LATE_FILES)) == i)
        # many tasks read the table, one writes the file
        some.repartition(1).write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{folder}/events.parquet")
    return tables.stream_table(spark, folder, "events", files_per_batch=1)


def _folders(spark):
    return shared_dir(spark, "stream"), shared_dir(spark, "stream-checkpoint")


def _finish(stream: DataFrame, **options) -> DataFrame:
    spark = stream.sparkSession
    path, checkpoint = _folders(spark)
    jobs.to_table(stream, path, checkpoint, **options).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _detected(spark, sf, late, windows, slab_ms=None):
    txns = views.as_transactions(_stream(spark, sf, late))
    path, checkpoint = _folders(spark)
    upkeep.detect(
        txns, path, checkpoint, windows=windows, window_ms=DAY_MS, slab_ms=slab_ms, alert_ts=F.col("event_ts")
    ).awaitTermination()
    layout = rules.detect(views.transactions(spark, sf), alert_ts=F.col("event_ts")).schema
    return _flat_alerts(upkeep.current(spark, layout, path))


def stream_detect(spark, sf, late=False):
    return _detected(spark, sf, late, [rules.high_frequency(window_ms=DAY_MS)])


def stream_detect_split(spark, sf, late=False):
    """The same alerts from parts of another width."""
    return _detected(spark, sf, late, [rules.high_frequency(window_ms=DAY_MS)], slab_ms=3 * DAY_MS)


def stream_multi_country(spark, sf, late=False):
    found = _detected(spark, sf, late, [rules.multi_country(window_ms=DAY_MS)])
    return found.filter(F.col("rule_name") == S.MULTI_COUNTRY)


def _counted(stream, **options):
    path, checkpoint = _folders(stream.sparkSession)
    upkeep.counts(stream, path, checkpoint, **options).awaitTermination()
    return upkeep.total_counts(stream.sparkSession, path).select("point_ms", "n")


def stream_tps(spark, sf, late=False):
    return _counted(views.as_transactions(_stream(spark, sf, late)), step="1 hour")


def _stream_alerts(spark, sf, late):
    txns = views.as_transactions(_stream(spark, sf, late))
    return rules.stateless_alerts(txns, alert_ts=F.col("event_ts"), keep=("event_ts",)).select(
        "alert_id", F.col("original_transaction.user_id").alias("user_id"), "rule_name", "event_ts"
    )


def stream_alert_rate(spark, sf, late=False):
    """Alerts per hour, sampled every half hour."""
    return _counted(_stream_alerts(spark, sf, late), step="1 hour", slide="30 minutes")


def stream_tumbling(spark, sf, late=False):
    txns = views.as_transactions(_stream(spark, sf, late))
    path, checkpoint = _folders(spark)
    upkeep.tumbling(txns, path, checkpoint, 3, DAY_MS, alert_ts=F.col("event_ts")).awaitTermination()
    layout = rules.tumbling_alerts(views.transactions(spark, sf), 3, DAY_MS, alert_ts=F.col("event_ts")).schema
    return _flat_alerts(upkeep.current(spark, layout, path))


def stream_decode(spark, sf, late=False):
    raw = views.as_raw_records(views.as_transactions(_stream(spark, sf, late)))
    return _decoded_columns(_finish(records.decoded_transactions(raw)))


def stream_dedup(spark, sf, late=False):
    """Every alert arrives twice and leaves once."""
    alerts = _stream_alerts(spark, sf, late)
    twice = alerts.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    path, checkpoint = _folders(spark)
    upkeep.once(twice, path, checkpoint, time="event_ts").awaitTermination()
    return upkeep.current(spark, twice.schema, path).select("alert_id", "user_id", "rule_name")


def stream_recent(spark, sf, late=False):
    alerts = _stream_alerts(spark, sf, late)
    path, checkpoint = _folders(spark)
    jobs.to_recent(alerts, path, checkpoint, arrival="event_ts").awaitTermination()
    rows = jobs.read_recent(spark, path, alerts.schema)
    return cases.with_position(rows, "event_ts").select("alert_id", "user_id", "rule_name", "position")


def stream_cases(spark, sf, late=False):
    """Alerts and commands both arrive; nothing is known at the start."""
    alerts = views.as_alert_history(views.as_transactions(_stream(spark, sf, late)))
    commands = views.as_alert_commands(_stream(spark, sf, late))
    path, checkpoint = _folders(spark)
    upkeep.case_states(alerts, commands, path, checkpoint).awaitTermination()
    layout = _status_events(spark, sf).schema
    return _status_columns(upkeep.current(spark, layout, path))


def stream_dedup_days(spark, sf, late=False):
    """Two runs of one job; in the second every alert comes again, a day later by its own time."""
    folder, (path, checkpoint) = shared_dir(spark, "again"), _folders(spark)
    files = LATE_FILES if late else 1
    rows = views.events(spark, sf)
    for days in (0, 1):
        moved = rows.withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(days)))
        for i in range(files):
            # the second run's files hold other alerts together than the first one's
            some = moved.filter(F.pmod(F.floor(F.col("event_id") / (1 + 2 * days)), F.lit(files)) == i)
            some.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        txns = views.as_transactions(tables.stream_table(spark, folder, "events", files_per_batch=1))
        alerts = rules.stateless_alerts(txns, alert_ts=F.col("event_ts"), keep=("event_ts",)).select(
            "alert_id", F.col("original_transaction.user_id").alias("user_id"), "rule_name", "event_ts"
        )
        upkeep.once(alerts, path, checkpoint, time="event_ts").awaitTermination()
    return upkeep.current(spark, alerts.schema, path).select("alert_id", "user_id", "rule_name", _ms("event_ts").alias("event_ms"))


def stream_retained(spark, sf, late=False):
    """The alerts of the newest ten days; what is older has left the job's tables."""
    txns = views.as_transactions(_stream(spark, sf, late))
    path, checkpoint = _folders(spark)
    upkeep.detect(
        txns, path, checkpoint, windows=[rules.high_frequency(window_ms=DAY_MS)], window_ms=DAY_MS,
        alert_ts=F.col("event_ts"), retain=10 * DAY_MS,
    ).awaitTermination()
    layout = rules.detect(views.transactions(spark, sf), alert_ts=F.col("event_ts")).schema
    return _flat_alerts(upkeep.current(spark, layout, path))


def stream_arrival(spark, sf, late=False):
    """The frequency rule row by row in the order the source gives, times out of order."""
    txns = views.as_transactions(_stream(spark, sf, late))
    alerts = jobs.high_frequency(txns, window_ms=DAY_MS, order=("event_id",), alert_ts=F.col("event_ts"))
    return _flat_alerts(_finish(alerts))


def stream_timers(spark, sf):
    """What the frequency rule still keeps per user after its timers, read back from the checkpoint."""
    txns = views.as_transactions(_stream(spark, sf)).withWatermark("event_ts", "5 seconds")
    path, checkpoint = _folders(spark)
    alerts = jobs.high_frequency(txns, window_ms=DAY_MS, alert_ts=F.col("event_ts"), time_mode="EventTime")
    jobs.to_table(alerts, path, checkpoint).awaitTermination()
    return jobs.kept_times(spark, checkpoint).groupBy("user_id").agg(
        F.count("*").alias("n_kept"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms")
    )


def stream_restart(spark, sf):
    """Detection that stops after some files, fails in a batch after it has written, and goes on."""
    folder, (path, checkpoint) = shared_dir(spark, "restart"), _folders(spark)
    rows = views.events(spark, sf)
    failures = iter((False, False, False, True))
    find = upkeep.detection(trailing.slab_width(DAY_MS), rules.STATELESS_RULES, [rules.high_frequency(window_ms=DAY_MS)], F.col("event_ts"))

    def evaluate(stored: DataFrame) -> DataFrame:
        if next(failures, False):
            raise RuntimeError("a batch that fails on purpose")
        return find(stored)

    def run(files: range) -> None:
        for i in files:
            some = rows.filter(F.pmod("event_id", F.lit(LATE_FILES)) == i)
            some.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        txns = views.as_transactions(tables.stream_table(spark, folder, "events", files_per_batch=1))
        width = trailing.slab_width(DAY_MS)
        slab = times.floor_to(F.col("event_ms"), width)
        try:
            upkeep.keep_up(txns, slab, evaluate, path, checkpoint, width, 1).awaitTermination()
        except StreamingQueryException as problem:
            if "fails on purpose" not in str(problem):
                raise

    run(range(3))  # ends; a new query takes over its checkpoint
    run(range(3, LATE_FILES))  # fails in the first of its batches
    run(range(0))
    layout = rules.detect(views.transactions(spark, sf), alert_ts=F.col("event_ts")).schema
    return _flat_alerts(upkeep.current(spark, layout, path))


def stream_rules(spark, sf):
    """Rules that change while a stream runs, and back again; every batch keeps those it began with."""
    folder, (path, checkpoint) = shared_dir(spark, "rules"), _folders(spark)
    rows, every = views.events(spark, sf), rule_table(spark)
    for i in range(LATE_FILES):
        named = every if i < 2 else every.filter("rule_id IN ('r2', 'r4')") if i < 4 else every.filter("rule_id = 'r5'")
        named.coalesce(1).write.mode("overwrite").parquet(f"{folder}/rules")
        some = rows.filter(F.pmod("event_id", F.lit(LATE_FILES)) == i)
        some.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        txns = views.as_transactions(tables.stream_table(spark, folder, "events", files_per_batch=1))
        jobs.dynamic_rules_to_table(txns, f"{folder}/rules", path, checkpoint).awaitTermination()
    layout = dynamic_rules.dynamic_alerts(views.transactions(spark, sf), every, F.col("event_ts")).schema
    stored = spark.read.schema(layout).parquet(path)
    versions = jobs.used_rules(spark, path).groupBy("version").agg(F.count("*").alias("n_rules"))
    alerts = _flat_alerts(stored)
    event = F.substring_index("transaction_id", "-", -1).cast("long")
    return alerts.join(versions, F.pmod(event, F.lit(LATE_FILES)) == F.col("version")).drop("version")


def stream_watermark(spark, sf, late=False):
    """Rows in time and rows behind a two-hour watermark, by hour."""
    txns = views.as_transactions(_stream(spark, sf, late))
    path, checkpoint = _folders(spark)
    jobs.split_by_watermark(txns, path, checkpoint, delay_ms=2 * HOUR_MS).awaitTermination()
    rows = jobs.split_rows(spark, txns.schema, path)
    return rows.groupBy(times.floor_to(F.col("event_ms"), HOUR_MS).alias("point_ms")).agg(
        F.count_if(~F.col("late")).alias("n_kept"), F.count_if("late").alias("n_late")
    )


def stream_latency(spark, sf):
    """Alerts and transactions as two streams, joined inside ten minutes."""
    folder, (path, checkpoint) = shared_dir(spark, "timed"), _folders(spark)
    views.timed_alerts(spark, sf).coalesce(1).write.parquet(f"{folder}/alerts.parquet")
    alerts = tables.stream_table(spark, folder, "alerts")
    joined = jobs.join_latency(alerts, views.as_transactions(_stream(spark, sf)))
    jobs.to_table(joined, path, checkpoint).awaitTermination()
    found = spark.read.schema(joined.schema).parquet(path).filter("event_ts IS NOT NULL")
    took = F.unix_micros("alert_timestamp") - F.unix_micros("event_ts")
    return found.select("alert_id", took.alias("latency_us")).filter("latency_us >= 0")


def stream_live_list(spark, sf):
    """The newest alerts with the status events off the wire merged in, as one stream."""
    folder, (path, checkpoint) = shared_dir(spark, "live"), _folders(spark)
    records.encode_status_events(_status_events(spark, sf), keep=("seq",)).write.parquet(f"{folder}/changes.parquet")
    changes, _ = records.decode_status_events(tables.stream_table(spark, folder, "changes"))
    alerts = views.as_alert_history(views.as_transactions(_stream(spark, sf)))
    jobs.to_live_list(alerts, changes, path, checkpoint).awaitTermination()
    return jobs.read_recent(spark, path, alerts.schema).select(
        "alert_id", "status", "assigned_to", "action_note", _ms("processed_at").alias("processed_ms")
    )


STREAMS = (
    stream_detect, stream_detect_split, stream_multi_country, stream_tps, stream_dedup, stream_recent,
    stream_cases, stream_decode, stream_alert_rate, stream_tumbling, stream_dedup_days, stream_retained,
    stream_arrival, stream_watermark,
)
#: Jobs whose files and runs are part of the query.
RUNS = (stream_timers, stream_restart, stream_rules, stream_latency, stream_live_list)


def _late(run):
    return lambda spark, sf: run(spark, sf, late=True)


def registry() -> dict[str, Query]:
    named = [
        decode_quarantine, txn_validity, transaction_records, alert_records, decoded_alerts, all_alerts,
        alert_validity, dynamic_rule_matches, rule_validation, rule_dry_run, flatten_history, history_violations,
        history_search_page, history_search_user, history_search_deep, history_search_stored, history_page_meta, history_page_sorted, latest_history,
        history_append, archive_split, archive_written, retention, recent_alerts, recent_filtered, recent_first_filter,
        severity_sorted, point_lookup, status_fold, status_events, status_event_records, case_state,
        apply_status_changes, new_alerts_only, status_counts, hourly_counts, hourly_counts_last_day, rule_stats,
        rule_coverage, txn_profile, report_csv, rule_csv, hourly_csv, latency_stats, latency_histogram, latency_unmatched, tps_series,
        alert_rate_series, alert_rate_visible, alert_warnings, metrics_summary, metric_backfill, metric_checks, tps_checks, service_checks, history_length_checks,
        service_status, metrics_snapshot, high_frequency_tumbling, alert_display, history_append_days, *STREAMS, *RUNS,
    ]
    found = {run.__name__: run for run in named}
    found |= {f"{run.__name__}_late": _late(run) for run in STREAMS}
    found["high_value_alerts"] = _stateless(rules.high_value())
    found["foreign_country_alerts"] = _stateless(rules.foreign_country())
    found["high_frequency_alerts"] = _windowed(rules.high_frequency(window_ms=DAY_MS))
    found["high_frequency_short"] = _windowed(
        rules.high_frequency(threshold=1, window_ms=2 * HOUR_MS, slab_ms=6 * HOUR_MS)
    )
    found["multi_country_alerts"] = _windowed(rules.multi_country(window_ms=DAY_MS))
    # the rules as they run in production: 60 seconds and 5, 10 minutes and 3
    found["high_frequency_default"] = _windowed(rules.high_frequency(), views.fast_transactions)
    found["multi_country_default"] = _windowed(rules.multi_country(), views.fast_transactions)
    for unit in analytics.PERIODS:
        found[f"period_rollup_{unit}"] = _rollup(unit)
    return found
