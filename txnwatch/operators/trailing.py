"""Counts over a trailing time window per key, for keys of any size.

A key's rows are cut into slabs of event time. A point also goes into the next
slab when its window reaches over the border, so each (key, slab) group is
complete on its own and one busy key spreads over as many tasks as it has
slabs. Inside a slab the window is a sweep: a point enters at ``t``, leaves
after ``t + window_ms``, and a running sum gives the number inside, so the work
is linear where a sliding frame would re-read the window for every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.functions.times import floor_to

MIN_SLAB_MS = 600_000
HOUR_MS = 3_600_000

# order of edges that share a time: a window includes both of its ends
_ENTER, _READ, _LEAVE = 0, 1, 2


def slab_width(window_ms: int, slab_ms: int | None = None) -> int:
    """A slab is at least one window wide, so a window touches two slabs at most.

    By default a few windows wide, so that few points are carried, but not so
    wide that the distinct milliseconds of one slab become many.
    """
    return max(window_ms, slab_ms or max(MIN_SLAB_MS, min(4 * window_ms, HOUR_MS)))


def _edge(slab: Column, at: Column, kind: int, delta: int) -> Column:
    return F.struct(slab.alias("slab"), at.alias("at"), F.lit(kind).alias("kind"), F.lit(delta).alias("delta"))


def trailing_count(
    points: DataFrame, keys: Sequence[str], window_ms: int, time: str = "event_ms", slab_ms: int | None = None
) -> DataFrame:
    """Distinct times per key inside ``[t - window_ms, t]``, one row per (key, t).

    Returns ``keys``, ``time`` and ``n``. Rows of one key with the same time
    count once.
    """
    width = slab_width(window_ms, slab_ms)
    t, leave = F.col(time), F.col(time) + F.lit(window_ms)
    slab = floor_to(t, width)
    following = slab + F.lit(width)
    crosses = leave >= following
    home = F.when(crosses, following).otherwise(slab)
    edges = F.array(
        _edge(slab, t, _READ, 1),
        _edge(home, leave, _LEAVE, -1),
        F.when(crosses, _edge(following, following, _ENTER, 1)),
    )
    running = (
        Window.partitionBy(*keys, "slab").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        points.select(*keys, time)
        .dropna()
        .distinct()
        .select(*keys, F.inline(edges))
        .filter(F.col("slab").isNotNull())
        .withColumn("n", F.sum("delta").over(running))
        .filter(F.col("kind") == _READ)
        .select(*keys, F.col("at").alias(time), F.col("n").cast("long").alias("n"))
    )


def with_carry(
    points: DataFrame, window_ms: int, time: str = "event_ms", slab_ms: int | None = None
) -> DataFrame:
    """Each row in its own slab, and again (``carried``) in the next one if its window reaches it."""
    width = slab_width(window_ms, slab_ms)
    slab = floor_to(F.col(time), width)
    following = slab + F.lit(width)
    homes = F.array(
        F.struct(slab.alias("slab"), F.lit(False).alias("carried")),
        F.when(
            F.col(time) + F.lit(window_ms) >= following,
            F.struct(following.alias("slab"), F.lit(True).alias("carried")),
        ),
    )
    return points.select("*", F.inline(homes)).filter(F.col("slab").isNotNull())


def trailing_distinct(
    points: DataFrame,
    keys: Sequence[str],
    value: str,
    window_ms: int,
    at_least: int,
    time: str = "event_ms",
    slab_ms: int | None = None,
) -> DataFrame:
    """(key, t) where ``[t - window_ms, t]`` holds ``at_least`` distinct values or more.

    Returns ``keys``, ``time``, ``n`` and the sorted ``values``. Overlapping
    windows of one value merge into one stretch, which counts one while it lasts.
    """
    span = F.lit(window_ms)
    homes = with_carry(points.select(*keys, value, time).dropna().distinct(), window_ms, time, slab_ms)
    homes = homes.repartition(*keys, "slab")

    same_value = Window.partitionBy(*keys, "slab", value).orderBy(time)
    t = F.col(time)
    earlier, later = F.lag(time).over(same_value), F.lead(time).over(same_value)
    starts = earlier.isNull() | (earlier + span < t)
    ends = later.isNull() | (t + span < later)

    def edge(at: Column, kind: int, delta: int) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), F.lit(delta).alias("delta"))

    # most groups hold too few values to fire at all; leave them out early
    group = Window.partitionBy(*keys, "slab")
    marked = (
        homes.select(
            *keys, "slab", "carried", value, time, starts.alias("starts"), ends.alias("ends"),
            earlier.isNull().cast("int").alias("first_of_value"),
        )
        .withColumn("n_values", F.sum("first_of_value").over(group))
        .filter(F.col("n_values") >= at_least)
    )
    edges = F.array(
        F.when(F.col("starts"), edge(t, _ENTER, 1)),
        edge(t, _READ, 0),
        F.when(F.col("ends"), edge(t + span, _LEAVE, -1)),
    )
    running = group.orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    # a point has one home slab, so several values at one time are the only rows that repeat
    fired = (
        marked.select(*keys, "slab", "carried", F.inline(edges))
        .filter(F.col("kind").isNotNull())
        .withColumn("n", F.sum("delta").over(running))
        .filter((F.col("kind") == _READ) & ~F.col("carried") & (F.col("n") >= at_least))
        .select(*keys, "slab", F.col("at").alias(time))
        .distinct()
    )
    # a value has a few stretches in a slab at most, as a slab is a few windows wide: what a
    # fired point meets is in proportion to what it returns
    last = F.when(F.col("ends"), t).otherwise(F.lead(time).over(same_value))
    stretches = (
        marked.filter(F.col("starts") | F.col("ends"))
        .select(*keys, "slab", value, t.alias("since"), (last + span).alias("until"), "starts")
        .filter("starts")
        .select(*keys, "slab", F.struct(F.col(value).alias("v"), "since", "until").alias("stretch"))
    )
    inside = t.between(F.col("stretch.since"), F.col("stretch.until"))
    return (
        fired.join(stretches, [*keys, "slab"])
        .filter(inside)
        .groupBy(*keys, "slab", time)
        .agg(F.collect_set("stretch.v").alias("values"))
        .select(*keys, time, F.sort_array("values").alias("values"), F.size("values").cast("long").alias("n"))
    )
