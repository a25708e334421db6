"""Alert history: flat rows, conjunctive search, paging."""

from __future__ import annotations

import functools
import operator
import re
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import texts, times
from txnwatch.operators import prefix

_USER_ID = re.compile(r"[a-zA-Z0-9-]+")
SORTABLE = ("user_id", "amount", "rule_name", "severity", "alert_timestamp", "status")


def flatten(alerts: DataFrame, created_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(history rows, rejected): nested alerts to flat rows, new cases being UNREAD.

    A severity outside HIGH, MEDIUM and LOW is rejected; rule aliases get their
    canonical name.
    """
    known = F.coalesce(F.col("severity").isin(*S.DETECTOR_SEVERITIES), F.lit(False))
    inner = [
        F.col(f"original_transaction.{name}").alias(name)
        for name in ("transaction_id", "user_id", "amount", "currency", "country_code")
    ]
    none = F.lit(None)
    rows = alerts.filter(known).select(
        "alert_id",
        "schema_version",
        *inner,
        texts.normalize_rule_name(F.col("rule_name")).alias("rule_name"),
        "reason",
        "severity",
        times.parse_instant(F.col("alert_timestamp")).alias("alert_timestamp"),
        F.lit("UNREAD").alias("status"),
        none.cast("string").alias("assigned_to"),
        none.cast("string").alias("action_note"),
        none.cast("timestamp").alias("processed_at"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )
    return rows, alerts.filter(~known)


@dataclass(frozen=True)
class Search:
    """Search arguments; a field left None adds no condition.

    ``as_of`` stands for "now": the default range ends there, and later dates
    are refused. Left out, it is the time at which the search is made, so that
    the page and the counts of one search cover the same rows.
    """

    start: datetime | None = None
    end: datetime | None = None
    rule_name: str | None = None
    user_id: str | None = None
    status: str | None = None
    page: int = 0
    size: int = S.DEFAULT_PAGE_SIZE
    as_of: datetime | None = None

    def __post_init__(self):
        if self.as_of is None:
            object.__setattr__(self, "as_of", datetime.now(timezone.utc).replace(tzinfo=None))
        if self.page < 0:
            raise ValueError("page must be 0 or more")
        if not 1 <= self.size <= S.MAX_PAGE_SIZE:
            raise ValueError(f"size must be 1 to {S.MAX_PAGE_SIZE}")
        if self.start and self.end and self.start > self.end:
            raise ValueError("start must not be after end")
        for name in ("start", "end"):
            value = getattr(self, name)
            if value and value > self.as_of:
                raise ValueError(f"{name} must not be in the future")
        if self.rule_name is not None and self.rule_name not in (*S.RULE_NAMES, *S.RULE_ALIASES):
            raise ValueError("unknown rule name")
        if self.user_id is not None and not _USER_ID.fullmatch(self.user_id):
            raise ValueError("user id may hold letters, digits and hyphens only")
        if self.status is not None and self.status not in S.STATUSES:
            raise ValueError("unknown status")

    def with_default_range(self) -> Search:
        """The last seven days, only when neither date is given."""
        if self.start is not None or self.end is not None:
            return self
        return replace(self, start=self.as_of - timedelta(days=S.DEFAULT_SEARCH_DAYS), end=self.as_of)


def day_range(first: date, last: date) -> tuple[datetime, datetime]:
    """Whole calendar days: 00:00:00.000 to 23:59:59.999."""
    start = datetime(first.year, first.month, first.day)
    end = datetime(last.year, last.month, last.day) + timedelta(days=1) - timedelta(milliseconds=1)
    return start, end


def conditions(search: Search, columns) -> list[Column]:
    s = search.with_default_range()
    tests: list[Column] = []
    by_date = "alert_date" in columns
    if s.start is not None:
        tests.append(F.col("alert_timestamp") >= times.at(s.start))
        if by_date:  # the partition column needs a predicate of its own
            tests.append(F.col("alert_date") >= F.lit(s.start.date()))
    if s.end is not None:
        tests.append(F.col("alert_timestamp") <= times.at(s.end))
        if by_date:
            tests.append(F.col("alert_date") <= F.lit(s.end.date()))
    if s.rule_name is not None:
        tests.append(F.col("rule_name") == S.RULE_ALIASES.get(s.rule_name, s.rule_name))
    if s.user_id is not None:
        tests.append(F.col("user_id") == s.user_id)
    if s.status is not None:
        tests.append(F.col("status") == s.status)
    return tests


def matching(history: DataFrame, search: Search) -> DataFrame:
    return history.filter(functools.reduce(operator.and_, conditions(search, history.columns)))


def _newest_first() -> list[Column]:
    return [F.col("alert_timestamp").desc(), F.col("alert_id").asc()]


def search_page(history: DataFrame, search: Search) -> DataFrame:
    """One page, newest first; equal times are ordered by id so pages never overlap.

    Every task and the driver hold the rows before the page; ``far_page`` is for pages far down.
    """
    return matching(history, search).orderBy(*_newest_first()).offset(search.page * search.size).limit(search.size)


def far_page(history: DataFrame, search: Search) -> DataFrame:
    """The same page by way of the times it covers.

    They are looked up first (one small row comes back), and only rows of these times are
    sorted, so the work does not grow with the number of the page.
    """
    rows, skip = matching(history, search), search.page * search.size
    covered = _times_at(rows, skip, search.size)
    if covered is None:
        return rows.limit(0)
    newest, oldest, before = covered
    rows = rows.filter(F.unix_millis("alert_timestamp").between(oldest, newest))
    return rows.orderBy(*_newest_first()).offset(skip - before).limit(search.size)


def _times_at(rows: DataFrame, skip: int, size: int) -> tuple[int, int, int] | None:
    """(newest ms, oldest ms, rows newer than these) of positions ``skip`` to ``skip + size - 1``."""
    age = (-F.unix_millis("alert_timestamp")).alias("age")
    counts = rows.groupBy(age).agg(F.count("*").alias("n"))
    placed = prefix.running_total(counts, "age", "n", "upto", cell=3_600_000)
    covers = (F.col("upto") > skip) & (F.col("upto") - F.col("n") < skip + size)
    found = placed.filter(covers).agg(
        F.max(-F.col("age")).alias("newest"),
        F.min(-F.col("age")).alias("oldest"),
        F.min(F.col("upto") - F.col("n")).alias("before"),
    ).first()
    return None if found.newest is None else (found.newest, found.oldest, found.before)


def page_meta(history: DataFrame, search: Search) -> DataFrame:
    """One row: total_elements, total_pages, current_page, page_size, has_next, has_previous."""
    pages = F.ceil(F.col("total_elements") / F.lit(search.size))
    page = F.lit(search.page)
    return (
        matching(history, search)
        .agg(F.count("*").alias("total_elements"))
        .select(
            "total_elements",
            pages.alias("total_pages"),
            page.alias("current_page"),
            F.lit(search.size).alias("page_size"),
            (page < pages - 1).alias("has_next"),
            (page > 0).alias("has_previous"),
        )
    )


def sort_page(page: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Re-sort one page (already cut) by a display column; severity sorts as text."""
    if column not in SORTABLE:
        raise ValueError(f"sort by one of {', '.join(SORTABLE)}")
    key = F.col(column).desc() if descending else F.col(column).asc()
    return page.orderBy(key, "alert_id")


def latest(history: DataFrame, n: int = 10) -> DataFrame:
    return history.orderBy(*_newest_first()).limit(max(0, n))
