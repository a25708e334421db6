"""Detection rules: the registry, stateless rules in one pass, trailing-window rules."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import texts, times
from txnwatch.operators import trailing


@dataclass(frozen=True)
class StatelessRule:
    """A predicate on one transaction and the text that explains a hit."""

    name: str
    severity: str
    predicate: Callable[[], Column]
    reason: Callable[[], Column]
    rule_type: str = S.SIMPLE_RULE


@dataclass(frozen=True)
class WindowRule:
    """A count over one user's trailing window.

    ``hits(transactions)`` returns (user_id, event_ms) rows with whatever
    columns ``reason`` needs.
    """

    name: str
    severity: str
    hits: Callable[[DataFrame], DataFrame]
    reason: Callable[[], Column]
    rule_type: str = S.STATEFUL_RULE


def high_value(threshold: int = S.HIGH_VALUE_THRESHOLD) -> StatelessRule:
    return StatelessRule(
        S.HIGH_VALUE,
        "HIGH",
        lambda: F.col("amount") > threshold,
        lambda: texts.high_value_reason(F.col("amount"), threshold),
    )


def foreign_country(home: str = S.HOME_COUNTRY) -> StatelessRule:
    """Case-sensitive; a missing country is not the home country."""
    return StatelessRule(
        S.FOREIGN_COUNTRY,
        "MEDIUM",
        lambda: ~F.col("country_code").eqNullSafe(home),
        lambda: texts.foreign_country_reason(F.coalesce("country_code", F.lit("null"))),
    )


def high_frequency(
    threshold: int = S.FREQUENCY_THRESHOLD, window_ms: int = S.FREQUENCY_WINDOW_MS, slab_ms: int | None = None
) -> WindowRule:
    """More than ``threshold`` distinct event milliseconds in ``[t - window_ms, t]``."""

    def hits(transactions: DataFrame) -> DataFrame:
        counts = trailing.trailing_count(transactions, ["user_id"], window_ms, slab_ms=slab_ms)
        return counts.filter(F.col("n") > threshold)

    return WindowRule(
        S.HIGH_FREQUENCY,
        "HIGH",
        hits,
        lambda: texts.high_frequency_reason(F.col("user_id"), F.col("n"), threshold, window_ms),
    )


def multi_country(
    threshold: int = S.MULTI_COUNTRY_THRESHOLD,
    window_ms: int = S.MULTI_COUNTRY_WINDOW_MS,
    slab_ms: int | None = None,
) -> WindowRule:
    """``threshold`` or more distinct countries in ``[t - window_ms, t]``."""

    def hits(transactions: DataFrame) -> DataFrame:
        return trailing.trailing_distinct(
            transactions, ["user_id"], "country_code", window_ms, threshold, slab_ms=slab_ms
        ).withColumnRenamed("values", "countries")

    return WindowRule(
        S.MULTI_COUNTRY,
        "HIGH",
        hits,
        lambda: texts.multi_country_reason(F.col("n"), F.col("countries"), window_ms),
    )


STATELESS_RULES: tuple[StatelessRule, ...] = (high_value(), foreign_country())


def transaction_struct() -> Column:
    return F.struct(*S.TRANSACTION_FIELDS.values()).alias("original_transaction")


def _alert_columns(rule_type, rule_name, reason, severity, alert_ts: Column | None, keep: Sequence[str]):
    alert_ts = F.current_timestamp() if alert_ts is None else alert_ts
    return [
        F.lit(S.SCHEMA_VERSION).alias("schema_version"),
        texts.alert_id(F.col("transaction_id"), rule_name).alias("alert_id"),
        transaction_struct(),
        rule_type.alias("rule_type"),
        rule_name.alias("rule_name"),
        reason.alias("reason"),
        severity.alias("severity"),
        times.iso_instant(alert_ts).alias("alert_timestamp"),
        *keep,
    ]


@dataclass(frozen=True)
class _Hit:
    """When a rule fires on a row, and the text that goes with it."""

    rule: StatelessRule | WindowRule
    fires: Column
    reason: Column


def _alert_per_hit(rows: DataFrame, hits: Sequence[_Hit], alert_ts: Column | None, keep: Sequence[str]) -> DataFrame:
    """One alert per row and hit, in one pass."""
    numbers = [F.when(hit.fires, F.lit(i)) for i, hit in enumerate(hits)]
    exploded = rows.withColumn("_rule", F.explode(F.array(*numbers))).filter(F.col("_rule").isNotNull())

    # only the rule's number is exploded, so texts nobody asks for are never built
    def per_rule(value: Callable[[_Hit], Column]) -> Column:
        chosen = value(hits[-1])
        for i in reversed(range(len(hits) - 1)):
            chosen = F.when(F.col("_rule") == i, value(hits[i])).otherwise(chosen)
        return chosen

    return exploded.select(
        *_alert_columns(
            per_rule(lambda hit: F.lit(hit.rule.rule_type)),
            per_rule(lambda hit: F.lit(hit.rule.name)),
            per_rule(lambda hit: hit.reason),
            per_rule(lambda hit: F.lit(hit.rule.severity)),
            alert_ts,
            keep,
        )
    )


def stateless_alerts(
    transactions: DataFrame,
    rules: Iterable[StatelessRule] = STATELESS_RULES,
    alert_ts: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One alert per transaction and rule that fires, in one pass over the input."""
    hits = [_Hit(rule, rule.predicate(), rule.reason()) for rule in rules]
    # the plain disjunction is what reaches the scan; the array decides per rule
    any_fires = functools.reduce(operator.or_, [hit.fires for hit in hits])
    return _alert_per_hit(transactions.filter(any_fires), hits, alert_ts, keep)


def window_alerts(
    transactions: DataFrame, rule: WindowRule, alert_ts: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One alert per transaction whose trailing window fires.

    The windows run over (user, time) pairs only; whole transactions join the
    pairs that fired, an inner join that adaptive execution can split when one
    pair has many transactions.
    """
    fired = transactions.join(rule.hits(transactions), ["user_id", "event_ms"])
    return fired.select(
        *_alert_columns(
            F.lit(rule.rule_type), F.lit(rule.name), rule.reason(), F.lit(rule.severity), alert_ts, keep
        )
    )


def tumbling_alerts(
    transactions: DataFrame,
    threshold: int = S.FREQUENCY_THRESHOLD,
    window_ms: int = S.FREQUENCY_WINDOW_MS,
    alert_ts: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The frequency rule on fixed windows: one alert per user and window with more
    than ``threshold`` transactions, on the last transaction of the window.
    """
    others = [name for name in S.TRANSACTION_FIELDS.values() if name not in ("user_id", "transaction_id")]
    last = F.max(F.struct("event_ms", "transaction_id", "event_ts", *others)).alias("_last")
    windows = transactions.groupBy("user_id", F.window("event_ts", f"{window_ms} milliseconds").alias("_window"))
    busy = windows.agg(F.count("*").alias("n"), last).filter(F.col("n") > threshold).select("user_id", "n", "_last.*")
    reason = texts.high_frequency_reason(F.col("user_id"), F.col("n"), threshold, window_ms)
    return busy.select(
        *_alert_columns(F.lit(S.STATEFUL_RULE), F.lit(S.HIGH_FREQUENCY), reason, F.lit("HIGH"), alert_ts, keep)
    )


def detect(
    transactions: DataFrame,
    stateless: Iterable[StatelessRule] = STATELESS_RULES,
    windows: Iterable[WindowRule] = (high_frequency(),),
    alert_ts: Column | None = None,
) -> DataFrame:
    """All alerts of all rules; a transaction that breaks two rules gives two alerts.

    Whole transactions are read once for all rules. Each window rule adds a scan of the columns
    its windows need, and its (user, time) pairs join the transactions.
    """
    stateless, windows = list(stateless), list(windows)
    if not windows:
        return stateless_alerts(transactions, stateless, alert_ts)
    rows, hits = transactions, [_Hit(rule, rule.predicate(), rule.reason()) for rule in stateless]
    for i, rule in enumerate(windows):
        fired = F.struct(rule.reason().alias("reason")).alias(f"_fired{i}")
        rows = rows.join(rule.hits(transactions).select("user_id", "event_ms", fired), ["user_id", "event_ms"], "left")
        hits.append(_Hit(rule, F.col(f"_fired{i}").isNotNull(), F.col(f"_fired{i}.reason")))
    return _alert_per_hit(rows, hits, alert_ts, ())
