"""Running totals and exact order statistics without sorting a table into one task.

Both work in two levels: inside coarse cells, and over one row per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.functions.times import floor_to


def running_total(
    rows: DataFrame, order: str, value: str, out: str, cell: int, coarser: Sequence[int] = ()
) -> DataFrame:
    """``out`` = sum of ``value`` over all rows up to and including this one.

    ``order`` is a long, unique per row. Only the per-cell sums (one row per
    ``cell``-wide stretch of ``order``) meet in a single task; where even those
    may be many, ``coarser`` names wider cells to sum them in first.
    """
    here, offset, total = f"_cell{cell}", f"_offset{cell}", f"_sum{cell}"
    # never NULL, so no null filter gets into one use of ``rows`` and not the other: they share a shuffle
    rows = rows.withColumn(here, F.coalesce(floor_to(F.col(order), cell), F.lit(0)))
    sums = rows.groupBy(here).agg(F.sum(value).alias(total))
    if coarser:
        upto = running_total(sums, here, total, offset, coarser[0], coarser[1:])
        offsets = upto.select(here, (F.col(offset) - F.col(total)).alias(offset))
    else:
        before = Window.orderBy(here).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select(here, F.coalesce(F.sum(total).over(before), F.lit(0)).alias(offset))
    inside = Window.partitionBy(here).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(offsets, here)
        .withColumn(out, F.col(offset) + F.sum(value).over(inside))
        .drop(here, offset)
    )


def order_statistics(rows: DataFrame, value: str, fractions: dict[str, float], cell: int = 1_000_000) -> DataFrame:
    """One row: ``n, sum, min, max`` of a long column and, for each name, the
    element at 0-based position ``floor(n * fraction)`` of the sorted values.

    The answer is exact. Values are counted first, so equal values meet once;
    the per-cell counts then say which cell holds each wanted position.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    ranked = running_total(counts, "_value", "_n", "_upto", cell, coarser=(1000 * cell,))
    names = F.array(
        *[F.struct(F.lit(name).alias("_name"), F.lit(q).alias("_fraction")) for name, q in fractions.items()]
    )
    wanted = (
        counts.agg(
            F.sum("_n").alias("n"),
            F.sum(F.col("_value") * F.col("_n")).alias("sum"),
            F.min("_value").alias("min"),
            F.max("_value").alias("max"),
        )
        .select("*", F.inline(names))
        .withColumn("_position", F.floor(F.col("n") * F.col("_fraction")))
    )
    hit = (F.col("_position") < F.col("_upto")) & (F.col("_position") >= F.col("_upto") - F.col("_n"))
    # ``wanted`` has exactly one row per fraction
    found = ranked.join(F.broadcast(wanted), hit)
    return found.agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        *[F.max(name).alias(name) for name in ("sum", "min", "max")],
        *[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in fractions],
    )


def trailing_stats(
    points: DataFrame, time_ms: str, value: str, window_ms: int, aggregates: dict, cells: Sequence[str] = ()
) -> DataFrame:
    """Aggregates of ``value`` over ``[t - window_ms, t]`` of a regular series.

    ``aggregates`` maps an output name to an aggregate function. The series has
    one point per step, so a slab holds a fixed number of them.
    """
    from txnwatch.operators.trailing import with_carry

    frame = Window.partitionBy(*cells, "slab").orderBy(time_ms).rangeBetween(-window_ms, 0)
    homes = with_carry(points, window_ms, time_ms, slab_ms=4 * window_ms)
    for name, function in aggregates.items():
        homes = homes.withColumn(name, function(value).over(frame))
    return homes.filter(~F.col("carried")).drop("slab", "carried")
