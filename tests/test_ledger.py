import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from builders import START, history
from txnwatch.sources import ledger, tables
from txnwatch.sources.ledger import PART, VERSION, Ledger, bucket, unseen

MANY = 25
LAYOUT = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])


def rows(spark, pairs):
    return spark.createDataFrame(pairs, LAYOUT).withColumn(PART, F.pmod("k", F.lit(3)))


def content(book):
    return sorted((r["k"], r["v"]) for r in book.read("t", LAYOUT).collect())


def test_uncommitted_rows_are_not_seen_and_a_replay_changes_nothing(spark, tmp_path):
    book = Ledger(spark, str(tmp_path))
    assert book.last() == -1 and book.read("t", LAYOUT).count() == 0
    first = book.begin(0)
    first.append("t", rows(spark, [(i, 0) for i in range(9)]))
    assert content(book) == []
    first.commit()
    for attempt in range(3):  # the last attempt is run after one that had committed
        batch = book.begin(1)
        batch.append("t", rows(spark, [(100 + i, attempt) for i in range(4)]))
        batch.replace("t", rows(spark, [(0, 7)]), [0])
        if attempt:
            batch.commit()
        want = [(0, 7)] + [(i, 0) for i in range(9) if i % 3] if attempt else [(i, 0) for i in range(9)]
        got = content(book)
        assert [r for r in got if r[0] < 100] == want
    # part 0 was replaced after the append, so of the new rows those of the other parts are there
    assert sorted(r for r in content(book) if r[0] >= 100) == [(100 + i, 2) for i in range(4) if (100 + i) % 3]


def test_many_small_batches_leave_few_files(spark, tmp_path):
    """The live folders per part, the files on disk and the rows read back (run once with 200 batches, too)."""
    book = Ledger(spark, str(tmp_path))
    most = 0
    for i in range(MANY):
        batch = book.begin(i)
        batch.append("t", rows(spark, [(i, 1)]).withColumn(PART, F.lit(0).cast("long")))
        batch.compact("t", LAYOUT)
        batch.commit()
        most = max(most, len(batch.of("t")))
    assert most <= ledger.FAN * 3
    assert content(book) == [(i, 1) for i in range(MANY)]
    assert len(list(tmp_path.glob("t/*/*/*.parquet"))) <= most + 3 * ledger.FAN


def test_fold_and_expiry(spark, tmp_path):
    book = Ledger(spark, str(tmp_path))
    for i in range(9):
        batch = book.begin()
        batch.append("t", rows(spark, [(0, 1), (1, 1), (2, 1)]))
        batch.compact("t", LAYOUT, fold=lambda r: r.groupBy("k", PART).agg(F.sum("v").alias("v")))
        batch.commit()
    total = book.read("t", LAYOUT).groupBy("k").agg(F.sum("v").alias("v"))
    assert {r["k"]: r["v"] for r in total.collect()} == {0: 9, 1: 9, 2: 9}
    assert book.read("t", LAYOUT).count() == 3 * 3  # two merged and one fresh
    batch = book.begin()
    batch.expire("t", 2)
    batch.commit()
    assert {r["k"] for r in book.read("t", LAYOUT).collect()} == {2}
    for _ in range(2):
        book.begin().commit()
    assert {p.name for p in tmp_path.glob(f"t/*/{PART}=*")} == {f"{PART}=2"}


def test_ids_are_found_in_buckets_that_double(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "BUCKET_ROWS", 50)
    random.seed(9)
    book, known, read = Ledger(spark, str(tmp_path)), set(), []
    for i in range(6):
        ids = {f"id{random.randrange(2_000)}" for _ in range(60)}
        frame = spark.createDataFrame([(x,) for x in ids], "id string")
        batch = book.begin()
        new = {r[0] for r in unseen(batch, frame, "id").collect()}
        assert new == ids - known
        batch.commit()
        known |= ids
    layout = T.StructType([T.StructField("id", T.StringType())])
    assert {r["id"] for r in book.read("ids", layout).collect()} == known
    assert book.begin().depth("ids") >= 2


def test_what_an_append_reads_does_not_grow(spark, tmp_path, monkeypatch):
    """Ten new ids against a thousand and against ten thousand stored ones: the same number of rows, give or take."""
    monkeypatch.setattr(ledger, "BUCKET_ROWS", 100)
    read = []
    for size in (1_000, 10_000):
        book = Ledger(spark, f"{tmp_path}/{size}")
        stored = spark.range(size).select(F.concat(F.lit("old"), "id").alias("id"))
        batch = book.begin()
        unseen(batch, stored, "id")
        batch.commit()
        batch = book.begin()
        unseen(batch, spark.range(10).select(F.concat(F.lit("new"), "id").alias("id")), "id")
        read.append(batch.rows_read)
    assert read[1] <= 1.5 * read[0] <= 1.5 * 10 * 150


def test_bucket_is_the_top_of_the_hash(spark):
    found = spark.range(1_000).select(bucket(F.col("id"), 0).alias("a"), bucket(F.col("id"), 4).alias("b")).collect()
    assert {r["a"] for r in found} == {1} and {r["b"] for r in found} == set(range(16, 32))


@pytest.mark.parametrize("written", [0, 2, 6])
def test_interrupted_append_is_finished_by_the_next(spark, tmp_path, monkeypatch, written):
    """The job dies after some of the rows got into the history and before their ids count."""
    path = f"{tmp_path}/history"
    first = history(spark, [{"alert_timestamp": START + timedelta(days=i % 3)} for i in range(4)])
    tables.append_history(first, path)
    more = history(spark, [{"alert_timestamp": START + timedelta(days=i % 3)} for i in range(10)])

    def die(batch, staged, path, interrupted=False):
        some = staged.filter("alert_id >= 'a0004'").orderBy("alert_id").limit(written)
        dated = some.withColumn("alert_date", F.to_date("alert_timestamp"))
        dated.write.mode("append").partitionBy("alert_date").parquet(path)
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_finish", die)
        with pytest.raises(RuntimeError):
            tables.append_history(more, path)
    tables.append_history(history(spark, [{} for _ in range(12)]).filter("alert_id >= 'a0009'"), path)
    stored = tables.read_history(spark, path).select("alert_id").collect()
    assert sorted(r[0] for r in stored) == [f"a{i:04d}" for i in range(12)]
    assert Path(path, "_ids").is_dir()


def test_versions_are_told_apart(spark, tmp_path):
    book = Ledger(spark, str(tmp_path))
    for i in range(2):
        batch = book.begin()
        batch.append("t", rows(spark, [(i, i)]))
        batch.commit()
    assert len({r[VERSION] for r in book.read("t", LAYOUT).collect()}) == 2
