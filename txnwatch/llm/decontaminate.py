"""Benchmark passages in documents, by a prefix-filtered set join.

An item's windows are its runs of ten words (a shorter item is one window). A window is the set
of its three-word shingles. Shingles are ordered by how often they occur in all documents, the
rarest first; a document part that contains a whole window contains all of its shingles, so a
prefix of one shingle, the rarest, is all that has to be joined. A pass over the documents counts
the windows' shingles; a second one gives the places of prefix shingles, with the words around
each. These places meet the windows by an equality join on the shingle; the window must fit
between the document's ends around that place (positional and length bound), and the words of
the window's size that lie there must equal its own.

Most shingles of documents belong to no window: a fixed-size bitmap (``sieve``) holds them back
before the shuffle. Shingles that take more than a 64th of all places are dealt out to 64 parts.
Windows that occur in the same items count as one when a document's items are gathered.

Defined results: words are lower-cased in A-Z; a null text has no words and no hits; an item
without words has no window; items that share an id count once; an item whose id is null marks
words but is not listed; rows that repeat are judged each; empty tables give empty or clean
results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm import sieve
from txnwatch.llm.common import byte_list, written

WINDOW = 10
WIDTH = 3
PARTS = 64
"""A shingle with more than this share of all places is hot, so there are fewer than this many."""
BATCH = 10_000

#: Fixed: A-Z become a-z, other ASCII that is no letter or digit becomes a space.
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words."""
    codes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    n = max(0, len(words) - width + 1)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ codes[k : k + n]) * _MIX[0]
        out ^= out >> np.uint64(29)
    return out * _MIX[1]


WINDOWS = "item string, window string, length int, keys array<bigint>"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("item", pa.string()), ("window", pa.string()), ("length", pa.int32()), ("keys", pa.list_(pa.int64()))
    ])
    for batch in batches:
        for item, text in zip(batch["item"].to_pylist(), byte_list(batch["text"])):
            words = words_of(text)
            length = min(WINDOW, len(words))
            if not length:
                continue
            width = min(WIDTH, length)
            keys = shingles(words, width).view(np.int64).tolist()
            per = length - width + 1
            for start in range(0, len(words) - length + 1, BATCH):
                rows = [
                    (item, b" ".join(words[i : i + length]).decode(), length, keys[i : i + per])
                    for i in range(start, min(start + BATCH, len(words) - length + 1))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )


def windows(items: DataFrame) -> DataFrame:
    """Distinct windows: ``id, window, length, keys`` and ``set``, which windows of the same items share."""
    each = items.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(_windows, WINDOWS)
    distinct = written(
        each.groupBy("window")
        .agg(F.first("length").alias("length"), F.first("keys").alias("keys"),
             F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("id", F.monotonically_increasing_id()),
        "windows",
    )
    sets = distinct.groupBy("items").agg(F.min("id").alias("set"))
    return written(distinct.join(sets, "items"), "window-sets")


def _counter(bitmap: np.ndarray, widths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for text in byte_list(batch["text"]):
                words = words_of(text)
                for width in widths:
                    keys = shingles(words, width)
                    hits.append(keys[sieve.maybe(bitmap, keys)])
            keys, n = np.unique(np.concatenate(hits or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    return run


def counted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``key, n``: how often each shingle of the windows occurs in all documents; never is left out."""
    keys = written(found.select(F.explode("keys").alias("key")).distinct(), "shingles")
    counts = docs.select("text").mapInArrow(_counter(sieve.build(keys), _widths(found)), "key bigint, n bigint")
    return counts.groupBy("key").agg(F.sum("n").alias("n")).join(keys, "key")


def _widths(found: DataFrame) -> list[int]:
    width = F.least(F.lit(WIDTH), F.col("length"))
    return sorted(r[0] for r in found.select(width).distinct().collect())


def prefixes(found: DataFrame, counts: DataFrame) -> DataFrame:
    """``id, key, place, n`` of each window's rarest shingle. A window with a shingle that never occurs goes."""
    each = found.select("id", F.size("keys").alias("all"), F.posexplode("keys").alias("place", "key"))
    return (
        each.join(counts, "key")
        .groupBy("id", "all")
        .agg(F.min(F.struct("n", "key", "place")).alias("least"), F.count("*").alias("seen"))
        .filter("seen = `all`")
        .select("id", "least.key", "least.place", "least.n")
    )


PLACES = "row bigint, doc_id bigint, n_words bigint, key bigint, place bigint, lead int, context string"


def _finder(bitmap: np.ndarray, widths: list[int]):
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("key", pa.int64()),
        ("place", pa.int64()), ("lead", pa.int32()), ("context", pa.string()),
    ])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            ids = zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), byte_list(batch["text"]))
            for row, doc, text in ids:
                words = words_of(text)
                rows.append((row, doc, len(words), None, None, None, None))
                for width in widths:
                    keys = shingles(words, width)
                    for at in np.flatnonzero(sieve.maybe(bitmap, keys)).tolist():
                        first = max(0, at - WINDOW + 1)
                        context = b" ".join(words[first : at + WINDOW]).decode()
                        rows.append((row, doc, len(words), int(keys[at].view(np.int64)), at, at - first, context))
                        if len(rows) >= BATCH:
                            yield packed(rows)
                            rows = []
            if rows:
                yield packed(rows)

    return run


def matches(places: DataFrame, rare: DataFrame, found: DataFrame) -> DataFrame:
    """``row, start, stop, set`` of every occurrence of a window."""
    total = rare.select("key", "n").distinct().agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in rare.filter(F.col("n") * PARTS > total).select("key").distinct().collect()]
    is_hot = F.col("key").isin(hot) if hot else F.lit(False)
    windows_ = rare.join(found.select("id", "window", "length", "set"), "id").select(
        F.col("key").alias("_key"), F.col("place").alias("inside"), "window", "length", "set",
        F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))).alias("_part"),
    )
    windows_ = written(windows_, "prefixes")
    part = F.when(is_hot, F.pmod(F.xxhash64("row", "place"), F.lit(PARTS))).otherwise(F.lit(0)).cast("int")
    fits = (F.col("inside") <= F.col("lead")) & (F.col("place") - F.col("inside") + F.col("length") <= F.col("n_words"))
    same = F.expr("array_join(slice(split(context, ' '), lead - inside + 1, length), ' ') = window")
    start = F.col("place") - F.col("inside")
    return (
        places.filter("key IS NOT NULL").withColumn("part", part)
        .join(windows_, (F.col("key") == F.col("_key")) & (F.col("part") == F.col("_part")) & fits & same)
        .select("row", start.alias("start"), (start + F.col("length")).alias("stop"), "set")
    )


def spans(found: DataFrame) -> DataFrame:
    """``row, spans``: the occurrences' words, joined where they touch or overlap."""
    before = Window.partitionBy("row").orderBy("start", "stop")
    reach = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > F.col("reach"), F.lit(True)).cast("long")
    return (
        found.withColumn("reach", reach)
        .withColumn("island", F.sum(opens).over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    )


def listed(found: DataFrame, sets: DataFrame) -> DataFrame:
    """``row, items``: the ids (as text, sorted) of the items whose windows occur. Equal sets are listed once."""
    rows = found.groupBy("row").agg(F.array_sort(F.collect_set("set")).alias("sets"))
    each = rows.select("sets").distinct().select("sets", F.explode("sets").alias("set"))
    items = (
        each.join(sets, "set").select("sets", F.explode("items").alias("item"))
        .groupBy("sets").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return rows.join(items, "sets").select("row", "items")


def find(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans`` (hit words, from 0, end exclusive) and ``items``."""
    found = windows(items)
    rare = written(prefixes(found, counted(docs, found)), "rarest")
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    bitmap = sieve.build(rare.select("key").distinct())
    places = written(numbered.mapInArrow(_finder(bitmap, _widths(found)), PLACES), "places")
    hits = written(matches(places, rare, found), "hits")
    sets = found.select("set", "items").distinct()
    marked = spans(hits).join(listed(hits, sets), "row", "left").withColumnRenamed("row", "_row")
    return (
        places.filter("key IS NULL").select("row", "doc_id", "n_words")
        .join(written(marked, "marked"), F.col("row") == F.col("_row"), "left")
        .select(
            "doc_id", "n_words",
            F.coalesce("spans", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
