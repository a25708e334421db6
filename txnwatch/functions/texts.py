"""Display texts, lookups and ids."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnwatch import schemas as S


def lookup(values: dict, key: Column) -> Column:
    """Literal map lookup; NULL when the key is unknown."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])
    return F.try_element_at(table, key)


def won(amount: Column) -> Column:
    """``1,250,000원``."""
    return F.concat(F.format_number(amount, 0), F.lit("원"))


def display_won(amount: Column) -> Column:
    """Display form: a missing amount shows as ``0원``."""
    return won(F.coalesce(amount, F.lit(0).cast("long")))


def _threshold_text(threshold: int) -> str:
    return f"{threshold // 10_000}만원" if threshold % 10_000 == 0 else f"{threshold:,}원"


def _span_text(window_ms: int) -> str:
    for unit, name in ((3_600_000, "시간"), (60_000, "분"), (1_000, "초")):
        if window_ms % unit == 0:
            return f"{window_ms // unit}{name}"
    return f"{window_ms}밀리초"


# Fixed texts: the reasons of alerts, of which readers and tests know the wording.
def high_value_reason(amount: Column, threshold: int) -> Column:
    return F.concat(F.lit(f"고액 거래 ({_threshold_text(threshold)} 초과): "), won(amount))


def foreign_country_reason(country: Column) -> Column:
    return F.concat(F.lit("해외 거래 탐지 (국가: "), country, F.lit(")"))


def high_frequency_reason(user: Column, count: Column, threshold: int, window_ms: int) -> Column:
    return F.concat(
        F.lit(f"빈번한 거래 ({_span_text(window_ms)} 내 {threshold}회 초과): "),
        user, F.lit(", "), count.cast("string"), F.lit("회"),
    )


def multi_country_reason(count: Column, countries: Column, window_ms: int) -> Column:
    return F.concat(
        F.lit(f"다중 국가 거래 ({_span_text(window_ms)} 내 "), count.cast("string"),
        F.lit("개 국가): "), F.array_join(countries, ", "),
    )


def summary(severity: Column, user: Column, reason: Column) -> Column:
    return F.concat(F.lit("["), severity, F.lit("] "), user, F.lit(": "), reason)


def alert_id(transaction_id: Column, rule_name: Column) -> Column:
    """Same transaction and rule, same id: a replay cannot add an alert."""
    return F.md5(F.concat(transaction_id, F.lit("|"), rule_name))


def normalize_rule_name(name: Column) -> Column:
    return F.coalesce(lookup(S.RULE_ALIASES, name), name)


def parse_enum(text: Column, values) -> Column:
    """Upper-cased member of ``values``, NULL for anything else."""
    return F.when(F.upper(text).isin(*values), F.upper(text))


def severity_name(severity: Column) -> Column:
    return lookup(S.SEVERITIES, severity)


def status_name(status: Column) -> Column:
    return lookup(S.STATUSES, status)


def severity_priority(severity: Column) -> Column:
    return F.coalesce(lookup(S.SEVERITY_PRIORITY, F.upper(severity)), F.lit(0))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, the unit the length limits are stated in."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")
