"""Tables that grow by many small batches, on a shared file system.

A manifest names the folders that count. A batch writes its rows into folders of its own, reads
what it needs by name, and last of all writes the next manifest; until then nobody sees its rows.
Manifests lie in two alternating slots: batch ``n`` reads that of ``n - 1`` and overwrites that of
``n - 2``, so a batch that is run again, after a failure at any point, gives the same tables, and a
reader finds a whole one at any time. Nothing is found by listing folders of data.

A table has parts (longs: a time slab, a day, a bucket of keys). Folders of one part and level are
merged by ``FAN`` into one of the next level, so a part has few of them however many batches came,
and a row is rewritten a logarithmic number of times. Parts can expire. Folders that no longer
count are removed two batches later, when no batch can need them again.

Buckets hold the top bits of a key's hash. Their number doubles when they hold more than a fixed
number of rows on average, so what a batch reads to look its keys up depends on the batch, not on
the table. The manifest has a row per folder; the driver holds it, and the parts of one batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, VERSION = "_part", "_version"
FAN = 4
BUCKET_ROWS = 200_000
"""Rows of a bucket on average, at most; results don't depend on it."""

_MANIFEST = "version long, name string, part long, level int, folder string, rows long, gone long"


@dataclass(frozen=True)
class Piece:
    """A folder with the rows that one batch wrote for one part; ``gone``: the version that dropped it."""

    name: str
    part: int
    level: int
    folder: str
    rows: int
    gone: int | None = None


def _missing(problem: AnalysisException) -> bool:
    return problem.getCondition() == "PATH_NOT_FOUND"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _slots(self, *slots: int) -> DataFrame | None:
        """The manifests in the given slots, those that exist."""
        found = None
        for slot in slots:
            try:
                some = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/_manifest/slot{slot}")
            except AnalysisException as problem:
                if not _missing(problem):
                    raise
                continue
            found = some if found is None else found.unionByName(some)
        return found

    def last(self) -> int:
        """The newest version that is whole; -1 where there is none."""
        found = self._slots(0, 1)
        version = None if found is None else found.agg(F.max("version")).first()[0]
        return -1 if version is None else version

    def pieces(self, version: int) -> list[Piece]:
        if version < 0:
            return []
        found = self._slots(version % 2)
        rows = [] if found is None else found.filter(F.col("version") == version).collect()
        if not rows:
            raise RuntimeError(f"{self.path} has no version {version}")
        return [Piece(*row[1:]) for row in rows if row["name"]]

    def begin(self, version: int | None = None) -> Batch:
        """A batch on top of the version before it, or of the newest one."""
        version = self.last() + 1 if version is None else version
        return Batch(self, version, self.pieces(version - 1))

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """A whole table as of the newest version, with ``_part`` and ``_version``."""
        return Batch(self, 0, self.pieces(self.last())).read(name, schema)

    def rows(self, name: str) -> int:
        """Rows of a whole table as of the newest version."""
        return sum(p.rows for p in self.pieces(self.last()) if p.name == name and p.gone is None)

    def _write(self, version: int, pieces: list[Piece]) -> None:
        rows = [(version, *astuple(piece)) for piece in pieces] + [(version, "", 0, 0, "", 0, None)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/_manifest/slot{version % 2}"
        )

    def _remove(self, folders: Iterable[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            path.getFileSystem(conf).delete(path, True)


class Batch:
    """Changes to the tables of a ledger; they count from ``commit`` on."""

    def __init__(self, ledger: Ledger, version: int, pieces: list[Piece]):
        self.ledger, self.version = ledger, version
        self.live = [piece for piece in pieces if piece.gone is None]
        self.gone = [piece for piece in pieces if piece.gone is not None]
        self.written = 0
        #: Stored rows that this batch read, for whoever watches its cost.
        self.rows_read = 0

    def of(self, name: str, parts: Iterable[int] | None = None) -> list[Piece]:
        wanted = None if parts is None else set(parts)
        return [p for p in self.live if p.name == name and (wanted is None or p.part in wanted)]

    def _retire(self, pieces: list[Piece]) -> None:
        old = set(pieces)
        self.live = [p for p in self.live if p not in old]
        self.gone += [replace(p, gone=self.version) for p in pieces]

    def _put(self, name: str, rows: DataFrame, options: dict[str, str], order: list[Column]) -> list[Piece]:
        """Writes rows (with ``_part``) into folders of this batch."""
        folder = f"{name}/{VERSION}={self.version:012d}-{self.written}"
        self.written += 1
        dealt = rows.hint("rebalance", PART).sortWithinPartitions(PART, *order)
        dealt.write.mode("overwrite").options(**options).partitionBy(PART).parquet(f"{self.ledger.path}/{folder}")
        layout = T.StructType([T.StructField(PART, T.LongType())])
        stored = self.ledger.spark.read.schema(layout).parquet(f"{self.ledger.path}/{folder}")
        counts = stored.groupBy(PART).agg(F.count("*")).collect()
        return [Piece(name, part, 0, f"{folder}/{PART}={part}", n) for part, n in counts]

    def append(self, name: str, rows: DataFrame, order: list[Column] = (), **options: str) -> list[int]:
        """Adds rows to the parts their ``_part`` names; gives those parts."""
        fresh = self._put(name, rows, options, list(order))
        self.live += fresh
        return [p.part for p in fresh]

    def replace(self, name: str, rows: DataFrame, parts: Iterable[int] | None = None, order: list[Column] = (), **options: str) -> None:
        """Puts rows in the place of whole parts (of all of them: ``None``)."""
        old = self.of(name, parts)
        fresh = self._put(name, rows, options, list(order))
        self._retire(old)
        self.live += fresh

    def read(self, name: str, schema: T.StructType, parts: Iterable[int] | None = None) -> DataFrame:
        """Rows of a table, of the named parts only, with ``_part`` and ``_version``."""
        return self._read(name, schema, self.of(name, parts))

    def _read(self, name: str, schema: T.StructType, pieces: list[Piece]) -> DataFrame:
        columns = [field for field in schema.fields if field.name not in (PART, VERSION)]
        layout = T.StructType([*columns, T.StructField(VERSION, T.StringType()), T.StructField(PART, T.LongType())])
        if not pieces:
            return self.ledger.spark.createDataFrame([], layout)
        self.rows_read += sum(p.rows for p in pieces)
        reader = self.ledger.spark.read.schema(layout).option("basePath", f"{self.ledger.path}/{name}")
        return reader.parquet(*[f"{self.ledger.path}/{p.folder}" for p in pieces])

    def expire(self, name: str, before: int, keep: int | None = None) -> None:
        """Drops the parts below ``before``, but for ``keep``."""
        self._retire([p for p in self.of(name) if p.part < before and p.part != keep])

    def compact(
        self, name: str, schema: T.StructType, fold: Callable[[DataFrame], DataFrame] | None = None,
        order: list[Column] = (), **options: str,
    ) -> None:
        """Merges ``FAN`` folders of one part and level into one; ``fold`` may join their rows."""
        levels = defaultdict(list)
        for piece in self.of(name):
            levels[piece.part, piece.level].append(piece)
        chosen: dict[int, list[Piece]] = {}
        for (part, _), pieces in sorted(levels.items(), key=lambda item: item[0][1]):
            if len(pieces) >= FAN:
                chosen.setdefault(part, pieces)
        if not chosen:
            return
        old = [piece for pieces in chosen.values() for piece in pieces]
        rows = self._read(name, schema, old)
        fresh = self._put(name, (fold(rows) if fold else rows).drop(VERSION), options, list(order))
        self._retire(old)
        self.live += [replace(p, level=chosen[p.part][0].level + 1) for p in fresh]

    # --- buckets of keys ----------------------------------------------------------
    def depth(self, name: str) -> int:
        """Bits of the hash that name a bucket; a part's leading one tells."""
        return max((p.part.bit_length() - 1 for p in self.of(name)), default=0)

    def deepen(self, arriving: int, tables: dict[str, tuple[T.StructType, str]]) -> int:
        """The depth for the tables (name to schema and key), deepened where the first of them needs more buckets."""
        first = next(iter(tables))
        depth = max(self.depth(name) for name in tables)
        wanted = depth
        rows = arriving + sum(p.rows for p in self.of(first))
        while rows > BUCKET_ROWS << wanted:
            wanted += 1
        for name, (schema, key) in tables.items():
            if self.of(name) and self.depth(name) < wanted:
                all_rows = self.read(name, schema).drop(VERSION)
                self.replace(name, all_rows.withColumn(PART, bucket(F.col(key), wanted)))
        return wanted

    def commit(self) -> None:
        kept = [p for p in self.gone if p.gone > self.version - 2]
        dead = [p for p in self.gone if p.gone <= self.version - 2]
        self.ledger._write(self.version, self.live + kept)
        self.ledger._remove(p.folder for p in dead)


def bucket(key: Column, depth: int) -> Column:
    """The bucket of a key as a part: a leading one, then the top bits of its hash."""
    if depth == 0:
        return F.lit(1).cast("long")
    return F.shiftrightunsigned(F.xxhash64(key), 64 - depth) + F.lit(1 << depth)


def unseen(batch: Batch, rows: DataFrame, key: str, name: str = "ids") -> DataFrame:
    """Of ``rows`` (a key each at most once) those whose key is not in the id table, which then holds them.

    Reads only the buckets the keys fall into. ``rows`` should be stored: they are read three times.
    """
    layout = T.StructType([rows.schema[key]])
    depth = batch.deepen(rows.count(), {name: (layout, key)})
    ids = rows.select(key, bucket(F.col(key), depth).alias(PART))
    touched = [row[0] for row in ids.select(PART).distinct().collect()]
    known = batch.read(name, layout, touched).select(key)
    batch.append(name, ids.join(known, key, "left_anti"), order=[F.col(key)])
    batch.compact(name, layout, order=[F.col(key)])
    return rows.join(known, key, "left_anti")
