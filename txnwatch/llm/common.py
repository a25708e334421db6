"""What the operators of this folder share: words, packed rows, written intermediate tables, hold-out sets."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.session import shared_dir

#: Fixed: the characters between words. ``bytes.split()`` cuts at exactly these.
SPACES = b" \t\n\x0b\x0c\r"
#: The same as a pattern that Java, Python and RE2 read alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Name of the column that holds a whole input row while an operator works on it.
ROW = "_row"


def byte_list(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return pc.fill_null(texts, "").cast(pa.binary()).to_pylist()


def each_bytes(texts: pa.Array, rows: int = 500) -> Iterator[bytes]:
    """The same one by one, with at most ``rows`` of them copied at a time."""
    for start in range(0, len(texts), rows):
        yield from byte_list(texts.slice(start, rows))


def text_list(texts: pa.Array) -> list[str]:
    return pc.fill_null(texts, "").to_pylist()


def byte_slices(texts: list[bytes], most: int) -> Iterator[slice]:
    """Stretches of at most ``most`` bytes, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    yield slice(start, len(texts))


def give_back() -> None:
    """Returns a Python worker's free memory to the system. Workers live on and would keep what their largest task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def then_given_back(results: Iterable) -> Iterator:
    """The results of a task; when they are all out, its memory is given back."""
    yield from results
    give_back()


def packed(rows: DataFrame) -> Column:
    """The whole row as one struct, so that no working column can clash with one of its own."""
    return F.struct(*[F.col(f"`{name}`") for name in rows.columns]).alias(ROW)


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select(f"{ROW}.*")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts the lineage and lets several uses share the work; any executor can read the files, so
    a lost one costs nothing but its running tasks.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, modulo ``parts``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


MOST_TEXTS = 100_000
"""Texts of a sample in all; with very many kinds each gets fewer."""


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_hash"))


def chosen_documents(docs: DataFrame, kinds: DataFrame, per_kind: int, max_bytes: int) -> list[tuple]:
    """``(kind, doc_id, hash)`` of at most ``per_kind`` documents of each kind, spread by a hash; for fitting only.

    ``kinds``: ``_id, _kind``. Documents are chosen by id, size and hash, without their texts.
    Texts above ``max_bytes`` are left out of the sample, so its size on the driver has a bound.
    Every run takes the same documents; a repeated row counts once.
    """
    slim = _hashed(docs).filter(F.octet_length("text") <= max_bytes).select("doc_id", "_hash").distinct()
    slim = written(slim.join(kinds, F.col("doc_id") == F.col("_id")).select("_kind", "doc_id", "_hash"), "sample")
    counts = written(slim.groupBy(F.col("_kind").alias("_k")).agg(F.count("*").alias("_n")), "kinds")
    each = min(per_kind, MOST_TEXTS // max(1, counts.count()) + 1)
    # twice the share that is wanted, then the first of them by hash: a bounded number of rows per kind
    share = F.least(F.lit(1.0), F.lit(2.0 * each) / F.col("_n"))
    some = slim.join(counts, F.col("_kind") == F.col("_k")).filter(
        F.pmod("_hash", F.lit(1 << 20)) < F.floor(share * (1 << 20)) + 1
    )
    place = F.row_number().over(Window.partitionBy("_kind").orderBy("_hash", "doc_id"))
    chosen = some.withColumn("_place", place).filter(F.col("_place") <= each).select("_kind", "doc_id", "_hash").collect()
    return sorted(map(tuple, chosen), key=lambda r: (str(r[0]), r[2], r[1]))


def bounded_sample(docs: DataFrame, kinds: DataFrame, per_kind: int, max_bytes: int) -> list[tuple]:
    """``(kind, text)`` of the chosen documents; only their texts are fetched."""
    chosen = chosen_documents(docs, kinds, per_kind, max_bytes)
    if not chosen:
        return []
    wanted = docs.sparkSession.createDataFrame([r[1:] for r in chosen], "_wanted long, _h long")
    found = _hashed(docs).join(F.broadcast(wanted), (F.col("doc_id") == F.col("_wanted")) & (F.col("_hash") == F.col("_h")))
    text_of = {(r["doc_id"], r["_hash"]): r["text"] for r in found.select("doc_id", "_hash", "text").collect()}
    return [(kind, text_of[doc_id, number]) for kind, doc_id, number in chosen]


def sample_windows(docs: DataFrame, draws: list[tuple], width: int) -> list[bytes]:
    """``width`` bytes of the document of each draw ``(doc_id, hash, at)``, cut in Spark.

    ``at`` is any number; the window begins at its remainder by the number of places there are.
    """
    rows = [(n, *draw) for n, draw in enumerate(draws)]
    wanted = docs.sparkSession.createDataFrame(rows, "_n int, _wanted long, _h long, _at long")
    found = _hashed(docs).join(F.broadcast(wanted), (F.col("doc_id") == F.col("_wanted")) & (F.col("_hash") == F.col("_h")))
    places = F.greatest(F.octet_length("text") - width + 1, F.lit(1))
    start = (F.col("_at") % places + 1).cast("int")
    cut = found.select("_n", F.substring(F.encode("text", "UTF-8"), start, F.lit(width)).alias("_cut"))
    window_of = {r["_n"]: bytes(r["_cut"]) for r in cut.collect()}
    return [window_of[n] for n in range(len(draws))]
