"""SimHash near-deduplication over deletion-variant signatures.

A text's fingerprint has 64 bits: each is the majority of that bit over the XXH64 hashes of its
word shingles. Two fingerprints that differ in at most two bits, cut into two segments of 32,
have a segment that differs by at most one. So each fingerprint is indexed under its two whole
segments and under the 32 variants of each that leave one bit out; fingerprints meet by an
equality join on these keys (a variant joins only the two values of the bit left out) and the
whole distance is verified.

A key that very many fingerprints share (near copies of one text) is not joined: its members
go to a second exact index. Fingerprints at distance two or less are those that can be turned
into one common value by changing at most one bit each, so each member is listed under the 65
values it can become. At most 65 members can share such a value and any two of them are close
enough, so linking them all to the smallest is exact and linear.

Defined results: a null or wordless text has fingerprint zero and is linked like any other;
rows that repeat belong to the same component; a null id is the component's id only where no
row of it has one; an empty table gives empty results; other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from txnwatch.llm.common import ROW, each_bytes, give_back, packed, unpacked, written
from txnwatch.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
BITS = 64
SEGMENT = 32
BUSY = 32
"""Fingerprints of a key from which its members go to the second index; results don't depend on it."""
PART = 1 << 15
"""Hashes whose bits are counted at a time."""

_digest = partial(xxhash.xxh64_digest, seed=SEED)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number. ``bytes.lower`` changes A-Z only."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.frombuffer(b"".join(map(_digest, shingles)), np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), PART):
        ones += np.unpackbits(hashes[start : start + PART], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


@F.arrow_udf(T.LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    found = pa.array([fingerprint(t) for t in each_bytes(texts)], pa.int64())
    give_back()
    return found


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _variants(prints: DataFrame) -> DataFrame:
    """``key, side, fp``: 33 keys per segment. ``side`` is the bit left out, null for the whole segment."""
    spread = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * (SEGMENT + 1) - 1))).alias("k"))
    spread = spread.selectExpr(
        "fp", f"k % {SEGMENT + 1} AS bit", f"cast(k div {SEGMENT + 1} AS int) AS segment",
        f"shiftrightunsigned(fp, cast({SEGMENT} * (k div {SEGMENT + 1}) AS int)) & 4294967295L AS value",
    )
    return spread.selectExpr(
        f"shiftleft(cast(segment * 64 + bit AS bigint), {SEGMENT}) | "
        f"(CASE WHEN bit < {SEGMENT} THEN value & ~shiftleft(1L, bit) ELSE value END) AS key",
        f"CASE WHEN bit < {SEGMENT} THEN cast(shiftright(value, bit) & 1 AS int) END AS side",
        "fp",
    )


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: links between distinct fingerprints (``fp``) that join all within two bits of each other."""
    shared = written(
        _variants(prints)
        .withColumn("n", F.count("*").over(Window.partitionBy("key")))
        .filter("n > 1"),
        "variants",
    )
    few = shared.filter(F.col("n") <= BUSY).select("key", "side", "fp")
    left = few.select("key", F.col("side").alias("s"), F.col("fp").alias("a"))
    right = few.select(F.col("key").alias("k"), F.col("side").alias("t"), F.col("fp").alias("b"))
    met = left.join(
        right,
        (F.col("key") == F.col("k"))
        & (((F.col("s") == 0) & (F.col("t") == 1)) | (F.col("s").isNull() & F.col("t").isNull() & (F.col("a") < F.col("b"))))
        & (_distance(F.col("a"), F.col("b")) <= MAX_BITS),
    ).select("a", "b")

    busy = shared.filter(F.col("n") > BUSY).select("fp").distinct()
    reached = busy.select(
        "fp",
        F.explode(F.expr(f"transform(sequence(0, {BITS}), i -> IF(i < {BITS}, fp ^ shiftleft(1L, i), fp))")).alias("value"),
    )
    stars = (
        reached.groupBy("value").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("members"))
        .filter(F.size("members") > 1)
        .select("a", F.explode("members").alias("b")).filter("a <> b").distinct()
    )
    return met.union(stars)


def labels(prints: DataFrame, find_links: Callable[[DataFrame], DataFrame] = links) -> DataFrame:
    """Per fingerprint: ``component_id``, and which row of the component stays (``keep_fp``, ``keep_rows``).

    ``prints``: ``doc_id, fp``, a row per document. The row that stays has the smallest id and,
    should that id have several texts, the smallest fingerprint.
    """
    # nulls last: no row has a smaller first field than one that has an id
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "rows"))
    counted = prints.groupBy("fp", "doc_id").agg(F.count("*").alias("rows"))
    distinct = written(counted.groupBy("fp").agg(first.alias("first")), "fingerprints")
    linked = components(find_links(distinct.select("fp")))
    placed = distinct.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    roots = placed.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("of"))
    return placed.join(roots, F.col("root") == F.col("_root")).select(
        "fp", F.col("of.doc_id").alias("component_id"), F.col("of.fp").alias("keep_fp"), F.col("of.rows").alias("keep_rows")
    )


def membership(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    prints = written(docs.select("doc_id", fingerprints("text").alias("fp")), "prints")
    found = labels(prints).select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(found, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id, with its own columns."""
    rows = written(docs.select(packed(docs), F.col("doc_id").alias("_id"), fingerprints("text").alias("_fp")), "prints")
    return kept_rows(rows, labels(rows.select(F.col("_id").alias("doc_id"), F.col("_fp").alias("fp"))))


def kept_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Of rows ``_row, _id, _fp`` those that stay by ``labels``, unpacked."""
    kept = rows.join(found, F.col("_fp") == F.col("fp")).filter(
        F.col("_id").eqNullSafe(F.col("component_id")) & (F.col("_fp") == F.col("keep_fp"))
    )
    again = kept.filter("keep_rows > 1").groupBy("_fp").agg(F.first(ROW).alias(ROW)).select(ROW)
    return unpacked(kept.filter("keep_rows = 1").select(ROW).unionByName(again))
