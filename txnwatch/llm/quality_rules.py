"""Quality rules whose limits follow the data: one quantile sketch per language and source.

A sketch is a set of counters over value cells: integers below 64 each have a cell, larger
ones keep their six leading bits (1.6 % relative width). Cells are integers, so sketches merge
by adding counters, in any order, with the same result on every run; a sketch holds at most a
few hundred counters however many documents it has seen. Limits are Tukey fences on the
sketch's quartiles. A group with few documents uses the merged sketch of its language, and one
of a rare language that of all documents.

Defined results: a null text counts as empty; a text without words has ratios of zero and
fails the base rule; null languages and sources form groups of their own; rows that repeat are
counted and judged each; an empty table gives empty results; other columns pass unchanged,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from txnwatch.llm.common import ROW, SPACES, each_bytes, give_back, packed, unpacked, written

SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
MEASURES = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])
LONG_TEXT = 100_000
"""Words from which the windows are compared as numbers, which takes less memory than tuples."""


@dataclass(frozen=True)
class Rules:
    """``fences``: distance of the fence from the quartile, in interquartile ranges, per metric.

    ``slack``: its least distance, in thousandths. In most texts symbols, repeated lines and
    repeated words are none, so their quartiles have no width and the slack decides; the word
    length has a width, and there it only guards groups of near equal texts. ``min_docs``:
    documents a group needs for a sketch of its own.
    """

    fences: dict[str, int] = field(
        default_factory=lambda: {"symbols": 3, "dup_lines": 3, "repeats": 3, "word_length": 6}
    )
    min_docs: int = 100
    slack: dict[str, int] = field(
        default_factory=lambda: {"symbols": 200, "dup_lines": 500, "repeats": 400, "word_length": 1000}
    )
    two_sided: tuple[str, ...] = ("word_length",)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text has twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    if n < LONG_TEXT:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == n:
            return 0
        counted = Counter(windows)
        twice = np.fromiter((counted[w] > 1 for w in windows), bool, n)
    else:
        number: dict[bytes, int] = {}
        codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n + 2)
        pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)[1]
        triples = pairs[:-1] * np.int64(len(number)) + codes[2:]
        _, inverse, count = np.unique(triples, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift : shift + n] |= twice
    return int(covered.sum())


def measure_text(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if not (line == b"" or line.isspace())]
    return (
        len(words),
        len(text.translate(None, SPACES + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@F.arrow_udf(MEASURES)
def measures(texts: pa.Array) -> pa.Array:
    rows = np.array([measure_text(t) for t in each_bytes(texts)], np.int64).reshape(-1, len(COUNTS))
    give_back()
    return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))


#: Else a filter on the counts is pushed below them and every text is measured once more for it, by a second worker.
measures = measures.asNondeterministic()


def _ratio(part: str, whole: str) -> str:
    return f"coalesce(1000 * _m.{part} div nullif(_m.{whole}, 0), 0)"


#: The judged metrics, in thousandths.
METRICS = {
    "symbols": _ratio("n_symbols", "n_words"),
    "dup_lines": _ratio("n_dup_lines", "n_lines"),
    "repeats": _ratio("n_repeat_words", "n_words"),
    "word_length": _ratio("word_chars", "n_words"),
}


def measured(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Columns ``_row`` (the document, or the columns named), ``_lang``, ``_source``, ``_m`` (its counts)."""
    row = packed(docs if keep is None else docs.select(*keep))
    return docs.select(
        row, F.col("lang").alias("_lang"), F.col("source").alias("_source"), measures("text").alias("_m")
    )


def cell(value: Column) -> Column:
    """The sketch's cell of a value: its six leading bits."""
    bits = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketches(rows: DataFrame) -> DataFrame:
    """One counter per language, source, metric and cell; partial counts are added before the shuffle."""
    each = F.explode(
        F.array(*[F.struct(F.lit(k).alias("metric"), F.expr(v).alias("value")) for k, v in METRICS.items()])
    )
    return (
        rows.select("_lang", "_source", each.alias("_x"))
        .groupBy("_lang", "_source", F.col("_x.metric").alias("metric"), cell(F.col("_x.value")).alias("cell"))
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame, rules: Rules) -> DataFrame:
    """Per language and source: ``limits``, a map from metric to its lowest and highest good value."""
    levels = F.explode(
        F.array(
            F.struct(F.lit(0).alias("level"), F.col("_lang").alias("lang"), F.col("_source").alias("source")),
            F.struct(F.lit(1).alias("level"), F.col("_lang").alias("lang"), F.lit(None).cast("string").alias("source")),
            F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")),
        )
    )
    merged = (
        sketch.select(levels.alias("k"), "metric", "cell", "n")
        .groupBy("k.level", "k.lang", "k.source", "metric", "cell")
        .agg(F.sum("n").alias("n"))
    )
    group = Window.partitionBy("level", "lang", "source", "metric")
    upto = F.sum("n").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumns({"upto": upto, "total": F.sum("n").over(group)})
    of_metric = lambda values: F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col("metric")]
    two_sided = F.col("metric").isin(*rules.two_sided)
    quartiles = (
        ranked.groupBy("level", "lang", "source", "metric", "total")
        .agg(
            F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("cell"))).alias("low"),
            F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("cell"))).alias("high"),
        )
        .withColumn(
            "reach", F.greatest((F.col("high") - F.col("low")) * of_metric(rules.fences), of_metric(rules.slack))
        )
    )
    limits = quartiles.groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"),
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    "metric",
                    F.struct(
                        F.when(two_sided, F.col("low") - F.col("reach")).alias("least"),
                        (F.col("high") + F.col("reach")).alias("most"),
                    ),
                )
            )
        ).alias("limits"),
    )
    groups = sketch.select("_lang", "_source").distinct().select("_lang", "_source", levels.alias("k"))
    return (
        groups.join(
            limits,
            (F.col("k.level") == F.col("level"))
            & F.col("k.lang").eqNullSafe(F.col("lang"))
            & F.col("k.source").eqNullSafe(F.col("source")),
        )
        .filter((F.col("total") >= rules.min_docs) | (F.col("level") == 2))
        .groupBy("_lang", "_source")
        .agg(F.min_by("limits", "level").alias("limits"))
    )


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``_base_failed`` and ``_kept`` to measured rows."""
    limits = limits.select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"), "limits")
    joined = rows.join(
        limits, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left"
    )
    inside = F.lit(True)
    for metric, value in METRICS.items():
        limit = F.col("limits")[metric]
        inside &= (F.expr(value) <= limit["most"]) & F.coalesce(F.expr(value) >= limit["least"], F.lit(True))
    failed = F.expr("_m.n_words < 50 OR 100 * _m.n_repeat_words > 50 * _m.n_words")
    return joined.select(
        ROW, "_m", failed.alias("_base_failed"), (~failed & F.coalesce(inside, F.lit(True))).alias("_kept")
    )


def judge(docs: DataFrame, rules: Rules | None = None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Measures every text once, fits the limits on all documents, joins them back and judges."""
    rows = written(measured(docs, keep), "measured")
    return judged(rows, fences(sketches(rows), rules or Rules()))


def keep_good(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """The documents that pass, with their own columns.

    Whole rows are neither written nor shuffled: texts are measured once for the limits and once
    more when they are judged, and the limits are written first, so Spark knows their size.
    """
    slim = docs.select("lang", "source", "text")
    sketch = written(sketches(measured(slim, keep=("lang",))), "sketches")
    limits = written(fences(sketch, rules or Rules()), "limits")
    return unpacked(judged(measured(docs), limits).filter("_kept"))
