"""Exact deduplication over a sharded cuckoo-filter index of live digests.

Texts go by their SHA-256. Every batch first adds up its own copies, so a text with very many
copies sends at most one row per batch; then the digests are dealt out by hash into shards. A
shard is a cuckoo filter (two candidate buckets of four 16-bit marks) whose slots lead to
bucketed content: the full digest, the row that stays, and the number of copies. A hit on a
mark counts only if the stored digest is the same. A copy with a larger id deletes the live
entry and inserts its own; a filter that overflows doubles and is filled again from the stored
keys. Shards have a bounded number of rows; more documents mean more shards.

Defined results: a null text counts as empty; of equal texts the row with the largest id stays;
where that id repeats with the same text, one of its rows stays; null ids count as smaller than
any other; an empty table gives empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import ROW, packed, unpacked, whole_text

SLOTS = 4
MAX_KICKS = 200
SHARD_ROWS = 100_000
LEAST_ID = -(2**63)


class CuckooIndex:
    """Live digests of one shard. Entry: ``[digest, id, copies, rows with that id]``."""

    def __init__(self, buckets: int = 64):
        self.entries: list[list | None] = []
        self.free: list[int] = []
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = np.zeros((buckets, SLOTS), np.uint16).tolist()
        self.content = np.full((buckets, SLOTS), -1, np.int64).tolist()

    @property
    def buckets(self) -> int:
        return self.mask + 1

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[2:10], "big") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _slot(self, digest: bytes) -> tuple[int, int] | None:
        """Where a live digest lies; a mark that only looks like it is passed over."""
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot, found in enumerate(self.marks[bucket]):
                if found == mark and self.entries[self.content[bucket][slot]][0] == digest:
                    return bucket, slot
        return None

    def find(self, digest: bytes) -> list | None:
        at = self._slot(digest)
        return None if at is None else self.entries[self.content[at[0]][at[1]]]

    def insert(self, digest: bytes, doc_id: int, copies: int = 1, rows: int = 1) -> None:
        if self.free:
            key = self.free.pop()
            self.entries[key] = [digest, doc_id, copies, rows]
        else:
            key = len(self.entries)
            self.entries.append([digest, doc_id, copies, rows])
        if not self._place(key):
            self._grow()

    def delete(self, digest: bytes) -> list | None:
        at = self._slot(digest)
        if at is None:
            return None
        bucket, slot = at
        key, self.marks[bucket][slot], self.content[bucket][slot] = self.content[bucket][slot], 0, -1
        entry, self.entries[key] = self.entries[key], None
        self.free.append(key)
        return entry

    def _place(self, key: int) -> bool:
        mark, first, second = self._places(self.entries[key][0])
        for bucket in (first, second):
            if 0 in self.marks[bucket]:
                slot = self.marks[bucket].index(0)
                self.marks[bucket][slot], self.content[bucket][slot] = mark, key
                return True
        bucket = second
        for kick in range(MAX_KICKS):
            slot = (kick + mark) % SLOTS
            self.marks[bucket][slot], mark = mark, self.marks[bucket][slot]
            self.content[bucket][slot], key = key, self.content[bucket][slot]
            bucket = self._other(bucket, mark)
            if 0 in self.marks[bucket]:
                slot = self.marks[bucket].index(0)
                self.marks[bucket][slot], self.content[bucket][slot] = mark, key
                return True
        return False

    def _grow(self) -> None:
        """Twice the buckets, filled from the stored keys; again, should that overflow too."""
        live = [key for key, entry in enumerate(self.entries) if entry is not None]
        buckets = self.buckets
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._place(key) for key in live):
                return

    def add(self, digest: bytes, doc_id: int, copies: int, rows: int) -> None:
        """Counts copies of a text; the live entry is always that of its largest id."""
        entry = self.find(digest)
        if entry is None:
            self.insert(digest, doc_id, copies, rows)
        elif doc_id > entry[1]:
            self.delete(digest)
            self.insert(digest, doc_id, copies + entry[2], rows)
        else:
            entry[2] += copies
            if doc_id == entry[1]:
                entry[3] += rows

    def remove(self, digest: bytes, copies: int) -> None:
        """Takes copies away; the last one deletes the live digest."""
        entry = self.find(digest)
        if entry is not None:
            entry[2] -= copies
            if entry[2] <= 0:
                self.delete(digest)

    def live(self) -> Iterator[list]:
        return (entry for entry in self.entries if entry is not None)


PARTIAL = "digest binary, doc_id bigint, copies bigint, rows bigint, op string"
LIVE = "digest binary, keep_id bigint, group_size bigint, keep_rows bigint"


def _added_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's copies of a text as one row."""
    for batch in batches:
        sums: dict[tuple, list] = {}
        for digest, doc_id, op in zip(*(batch.column(i).to_pylist() for i in range(3))):
            got = sums.get((digest, op))
            if got is None:
                sums[digest, op] = [doc_id, 1, 1]
            else:
                got[1] += 1
                if doc_id > got[0]:
                    got[0], got[2] = doc_id, 1
                elif doc_id == got[0]:
                    got[2] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in sums], pa.binary()),
                *[pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(3)],
                pa.array([k[1] for k in sums], pa.string()),
            ],
            names=["digest", "doc_id", "copies", "rows", "op"],
        )


def _indexed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs one index per shard; the rows come sorted by shard, inserts before deletes."""
    shard, index = None, CuckooIndex()
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for now, digest, doc_id, copies, rows, op in zip(*columns):
            if now != shard:
                if shard is not None:
                    yield from _emitted(index)
                shard, index = now, CuckooIndex()
            if op == "delete":
                index.remove(digest, copies)
            else:
                index.add(digest, doc_id, copies, rows)
    yield from _emitted(index)


def _emitted(index: CuckooIndex, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    entries = list(index.live())
    types = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
    for start in range(0, len(entries), size):
        part = entries[start : start + size]
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[i] for e in part], kind) for i, kind in enumerate(types)],
            names=["digest", "keep_id", "group_size", "keep_rows"],
        )


def live_digests(changes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The live index after ``changes`` (``digest`` binary, ``doc_id`` long, ``op`` insert or delete).

    One row per live digest: ``digest``, ``keep_id`` (largest id seen), ``group_size`` (inserted
    less deleted copies), ``keep_rows`` (rows that have that id and text).
    """
    shards = 1 + changes.count() // shard_rows
    return (
        changes.select("digest", "doc_id", "op")
        .mapInArrow(_added_up, PARTIAL)
        .withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
        .repartition("shard")
        .sortWithinPartitions("shard", F.desc("op"))
        .select("shard", "digest", "doc_id", "copies", "rows", "op")
        .mapInArrow(_indexed, LIVE)
    )


def digests(docs: DataFrame) -> DataFrame:
    """``digest`` (SHA-256 of the UTF-8 text) and ``doc_id`` of every document."""
    return docs.select(
        F.unhex(F.sha2(whole_text(), 256)).alias("digest"),
        F.coalesce(F.col("doc_id"), F.lit(LEAST_ID)).alias("doc_id"),
    )


def groups(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    return live_digests(digests(docs).withColumn("op", F.lit("insert")), shard_rows)


def _copied(docs: DataFrame, shard_rows: int) -> DataFrame:
    """The groups of more than one row, named so that they clash with nothing."""
    return groups(docs, shard_rows).filter("group_size > 1").select(
        F.col("digest").alias("_group"), F.col("keep_id").alias("_keep"),
        F.col("group_size").alias("_size"), F.col("keep_rows").alias("_rows"),
    )


def membership(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    joined = digests(docs).join(_copied(docs, shard_rows), F.col("digest") == F.col("_group"), "left").select(
        F.col("doc_id"),
        F.coalesce("_keep", "doc_id").alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.coalesce("_rows", F.lit(1)).alias("_rows"),
    )
    stays = F.col("doc_id") == F.col("keep_id")
    plain = joined.filter(~stays | (F.col("_rows") == 1)).withColumn("kept", stays)
    # rows that repeat the largest id: counted, and given back with one of them kept
    again = (
        joined.filter(stays & (F.col("_rows") > 1))
        .groupBy("doc_id", "keep_id", "group_size", "text_sha256", "_rows")
        .agg(F.count("*").alias("_n"))
        .withColumn("kept", F.explode(F.transform(F.sequence(F.lit(1), F.col("_n")), lambda i: i == 1)))
        .drop("_n")
    )
    null_id = lambda name: F.nullif(F.col(name), F.lit(LEAST_ID)).alias(name)
    return plain.unionByName(again).select(null_id("doc_id"), null_id("keep_id"), "group_size", "kept", "text_sha256")


def keep_one(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The documents without their exact copies, with their own columns."""
    rows = docs.select(
        packed(docs), F.unhex(F.sha2(whole_text(), 256)).alias("_digest"),
        F.coalesce(F.col("doc_id"), F.lit(LEAST_ID)).alias("_id"),
    )
    joined = rows.join(_copied(docs, shard_rows), F.col("_digest") == F.col("_group"), "left").filter(
        F.col("_keep").isNull() | (F.col("_id") == F.col("_keep"))
    )
    alone = F.coalesce(F.col("_rows") == 1, F.lit(True))
    again = joined.filter(~alone).groupBy("_digest").agg(F.first(ROW).alias(ROW)).select(ROW)
    return unpacked(joined.filter(alone).select(ROW).unionByName(again))
