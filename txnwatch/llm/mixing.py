"""Mixing sources to target weights by entropy balancing.

Every word starts with weight one. Among all reweightings that meet the word targets of the
sources, entropy balancing takes the one closest to the start in relative entropy. Its convex
dual has one multiplier per source; the optimal rate of a document is the exponential of its
multipliers (``rate = exp(lambda)`` of its source). Newton steps solve the dual: each one is an
aggregate of gradient and curvature over cells of equal (source, size), which are counted
once. Rates become whole copies by error feedback: from long documents to short ones, each
takes the copies that bring the running total closest to the running target, so what long
documents miss short ones make up for. A source's longest documents come first and together:
those above a thousandth of its words, of which there are fewer than a thousand. Its others
follow at the rate that what is left calls for, in blocks of a bounded number of rows, whatever
share of all rows the source has. Blocks are dealt by id; rows whose id is null or repeats get a
number of their own, by which they are dealt and by which copies find their rows.

Targets share the words of all documents by weight, stop at ``cap`` times a source's words, and
the excess is shared again by weight until no source is above.

Defined results: a null text has no words; a null source is a source, the last one; documents
without words take none; rows that repeat are counted each and may take different numbers of
copies; an empty table gives an empty result; other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm.common import ROW, WORD, packed, whole_text, written

NUMBER = "_number"

CAP = 3
BLOCK_ROWS = 2_000
LONG_SHARE = 1_000
"""A document is long if it has more than one in so many words of its source."""
TOLERANCE = 1e-9
MAX_STEPS = 60


def ranked_sources(totals: DataFrame) -> DataFrame:
    """Adds ``rank`` (0-based, by code point, null last) without bringing all sources into one task.

    Ranges are sorted on their own; only one row per range is summed up in order.
    """
    placed = written(
        totals.withColumn("_last", F.col("source").isNull())
        .repartitionByRange("_last", "source")
        .withColumn("_range", F.spark_partition_id()),
        "sources",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range").agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range").orderBy("_last", "source")
    return (
        placed.join(offsets, "_range")
        .withColumn("rank", F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_range", "_before", "_last")
    )


def with_targets(totals: DataFrame, weights: Sequence[float], cap: float = CAP) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: weights repeat in source order."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = ranked_sources(totals).select(
        "source", "source_size", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight")
    )
    rows = written(rows.withColumn("held", F.lit(False)), "targets")
    while True:
        state = rows.agg(
            F.sum(F.when(F.col("held"), F.col("source_size") * float(cap)).otherwise(0.0)).alias("held"),
            F.sum("source_size").alias("all"),
            F.sum(F.when(~F.col("held"), F.col("weight"))).alias("weight"),
        ).first()
        share = (state["all"] - state["held"]) / state["weight"] if state["weight"] else 0.0
        above = ~F.col("held") & (F.col("weight") * share > F.col("source_size") * float(cap))
        if rows.filter(above).isEmpty():
            break
        rows = written(rows.withColumn("held", F.col("held") | above), "targets")
    target = F.when(F.col("held"), F.col("source_size") * float(cap)).otherwise(F.col("weight") * share)
    return rows.select("source", "source_size", target.alias("target"))


def multipliers(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``lambda`` to the targets: Newton on the dual, from zero, until every gradient vanishes.

    ``cells``: ``source, size, n``. Sources without words or without a target have no multiplier.
    """
    rows = written(targets.withColumn("lambda", F.lit(0.0)), "dual")
    cells = cells.withColumnRenamed("source", "_s")
    same = F.col("_s").eqNullSafe(F.col("source"))
    for _ in range(MAX_STEPS):
        # of sum(size * exp(lambda)) - lambda * target, by source
        slopes = (
            cells.join(rows.filter("source_size > 0 AND target > 0"), same)
            .groupBy("source", "source_size", "target", "lambda")
            .agg(F.sum(F.col("size") * F.col("n") * F.exp("lambda")).alias("curvature"))
            .withColumn("gradient", F.col("curvature") - F.col("target"))
        )
        step = F.greatest(F.lit(-5.0), F.least(F.lit(5.0), -F.col("gradient") / F.col("curvature")))
        rows = written(
            slopes.select(
                "source", "source_size", "target", (F.col("lambda") + step).alias("lambda"),
                (F.abs("gradient") / F.col("target")).alias("off"),
            ),
            "dual",
        )
        if (rows.agg(F.max("off")).first()[0] or 0.0) < TOLERANCE:
            break
    else:
        raise RuntimeError(f"the dual has not converged after {MAX_STEPS} steps")
    return rows.select("source", "lambda")


def copies(sizes: np.ndarray, rate: float, cap: int = CAP, after: float = 0.0) -> np.ndarray:
    """Whole copies for sizes in falling order; the running total follows ``rate``.

    A document takes the copies just below or above its rate, whichever leaves less to make up,
    as long as the rest, and ``after`` words that are rounded later, can still do so within the
    cap. Where neither does, any number may.
    """
    near = (int(rate), min(int(rate) + 1, cap))
    out = np.empty(len(sizes), np.int64)
    error, rest = 0.0, float(sizes.sum()) + after  # error: taken so far, less what was due
    for i, size in enumerate(sizes.tolist()):
        rest -= size
        least, most = (rate - cap) * rest - 0.5, rate * rest + 0.5  # what the rest can make up
        best = None
        for some in (near, range(cap + 1)):
            for taken in some:
                left = error + (taken - rate) * size
                rank = (max(0.0, least - left, left - most), abs(left))
                if best is None or rank < best[0]:
                    best = (rank, taken, left)
            if best[0][0] == 0:
                break
        out[i], error = best[1], best[2]
    return out


ROUNDED = f"doc_id bigint, {NUMBER} bigint, source string, size bigint, source_size bigint, target double, copies bigint"


def _rounded(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["size", "doc_id", NUMBER], ascending=[False, True, True], kind="stable")
    rows["copies"] = copies(rows["size"].to_numpy(), float(rows["rate"].iloc[0]), after=float(rows["after"].iloc[0]))
    return rows[["doc_id", NUMBER, "source", "size", "source_size", "target", "copies"]]


def rounded(rows: DataFrame) -> DataFrame:
    """Copies for ``doc_id, _number, source, size, source_size, target, rate``: long documents, then the others."""
    is_long = F.col("size") * LONG_SHARE > F.col("source_size")
    rows = written(rows, "rated")
    tails = rows.filter(~is_long).groupBy(F.col("source").alias("_s")).agg(
        F.sum("size").alias("tail_size"), F.count("*").alias("tail_docs")
    )
    tails = written(tails, "tails")
    same = F.col("source").eqNullSafe(F.col("_s"))
    long = written(
        rows.filter(is_long).join(tails, same, "left")
        .withColumn("after", F.coalesce("tail_size", F.lit(0)).cast("double"))
        .select("doc_id", NUMBER, "source", "size", "source_size", "target", "rate", "after")
        .groupBy("source").applyInPandas(_rounded, ROUNDED),
        "long",
    )
    taken = long.groupBy(F.col("source").alias("_t")).agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
    left = tails.join(taken, F.col("_s").eqNullSafe(F.col("_t")), "left").select(
        "_s", "tail_size", F.coalesce("taken", F.lit(0)).alias("taken"),
        (F.floor(F.col("tail_docs") / BLOCK_ROWS) + 1).alias("blocks"),
    )
    left = written(left, "left")
    rate = F.coalesce((F.col("target") - F.col("taken")) / F.nullif(F.col("tail_size"), F.lit(0)), F.lit(0.0))
    short = (
        rows.filter(~is_long).join(left, same)
        .withColumn("block", F.pmod(F.xxhash64("doc_id", NUMBER), F.col("blocks")))
        .select("doc_id", NUMBER, "source", "size", "source_size", "target", "block",
                F.greatest(F.lit(0.0), F.least(F.lit(float(CAP)), rate)).alias("rate"), F.lit(0.0).alias("after"))
        .groupBy("source", "block").applyInPandas(_rounded, ROUNDED)
    )
    return long.unionByName(short)


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``_number``: 0 where the id is the row's alone, else a number of the row's own, written with it.

    Usually no id repeats, and nothing is written but the empty list of such ids.
    """
    again = rows.groupBy(F.col("doc_id").alias("_again")).agg(F.count("*").alias("_n"))
    again = written(again.filter("_n > 1 OR _again IS NULL").select("_again"), "repeated-ids")
    if again.isEmpty():
        return rows.withColumn(NUMBER, F.lit(0).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    alone = rows.join(again, same, "left_anti").withColumn(NUMBER, F.lit(0).cast("long"))
    shared = rows.join(again, same, "left_semi").withColumn(NUMBER, F.monotonically_increasing_id() + 1)
    return alone.unionByName(written(shared, "repeated-rows"))


def _sizes(docs: DataFrame) -> DataFrame:
    size = F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size")
    return docs.select("doc_id", *[c for c in (NUMBER,) if c in docs.columns], "source", size)


def _mixed(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Copies of ``doc_id, _number, source, size``, which are stored."""
    cells = written(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = with_targets(totals, weights)
    dual = multipliers(cells, targets)
    plan = targets.join(
        dual.select(F.col("source").alias("_d"), "lambda"), F.col("source").eqNullSafe(F.col("_d")), "left"
    ).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.least(F.lit(float(CAP)), F.coalesce(F.exp("lambda"), F.lit(0.0))).alias("rate"),
    )
    # written, so that Spark knows how small it is
    rows = sizes.join(written(plan, "rates"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return rounded(rows)


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3)) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies``."""
    return _mixed(numbered(written(_sizes(docs.select("doc_id", "source", "text")), "sizes")), weights).drop(NUMBER)


def repeat(docs: DataFrame, weights: Sequence[float] = (1, 2, 3)) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, with their own columns."""
    slim = numbered(docs.select(packed(docs), "doc_id", "source", "text"))
    taken = _mixed(written(_sizes(slim), "sizes"), weights).filter("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col(NUMBER).alias("_their"), "copies"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(NUMBER) == F.col("_their"))
    return (
        slim.select(ROW, "doc_id", NUMBER).join(taken, same)
        .select(ROW, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"))
        .select(f"{ROW}.*")
    )
