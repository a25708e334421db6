import hashlib
import random

from pyspark.sql import functions as F

from txnwatch.llm import cuckoo as C


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_index_against_a_dictionary():
    """Inserts and deletes in any order, through many overflows."""
    random.seed(4)
    index, truth = C.CuckooIndex(4), {}
    for _ in range(30_000):
        key = digest(random.randrange(3000))
        if random.random() < 0.6:
            if key not in truth:
                truth[key] = random.randrange(10**6)
                index.insert(key, truth[key])
        else:
            entry = index.delete(key)
            assert (entry and entry[1]) == truth.pop(key, None)
    assert {e[0]: e[1] for e in index.live()} == truth
    assert index.buckets > 4
    for i in range(3000):
        found = index.find(digest(i))
        assert (found and found[1]) == truth.get(digest(i))


def test_marks_that_collide_are_told_apart():
    index = C.CuckooIndex(4)
    keys = [b"\x00\x07" + b"\x00" * 8 + bytes([i]) * 22 for i in range(8)]  # one mark, one pair of buckets
    for i, key in enumerate(keys):
        index.insert(key, i)
    assert [index.find(k)[1] for k in keys] == list(range(8))
    assert index.find(b"\x00\x07" + b"\x00" * 8 + b"\x63" * 22) is None


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = first and i != keep
    return sorted(out)


def test_membership(spark, docs):
    random.seed(5)
    rows = [(i, random.choice(["", None, "a", "b", "a ", "A", f"own {i}"])) for i in range(400)]
    rows += [(399, rows[399][1])] * 5 + [(1000, "a")] * 3
    got = sorted(tuple(r) for r in C.membership(docs(rows).repartition(7), shard_rows=50).collect())
    assert got == brute(rows)
    assert C.membership(docs([])).count() == 0


def test_kept_rows(spark, docs, odd_rows):
    table = docs(odd_rows)
    kept = C.keep_one(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == sorted(
        [(2, ""), (3, "word " * 30_000), (5, "same text here"), (-1, "an id that is null"), (7, "x" * 200_000),
         (8, " \t\n "), (9, odd_rows[-1][1])]
    )


def test_deletes_take_live_digests_away(spark):
    rows = [(bytearray(digest(i % 10)), i, "insert") for i in range(40)]
    rows += [(bytearray(digest(3)), 3, "delete")] * 4 + [(bytearray(digest(4)), 4, "delete")]
    live = C.live_digests(spark.createDataFrame(rows, "digest binary, doc_id long, op string"), shard_rows=8)
    got = {bytes(r["digest"]): (r["keep_id"], r["group_size"]) for r in live.collect()}
    want = {digest(i): (30 + i, 4) for i in range(10) if i != 3}
    want[digest(4)] = (34, 3)
    assert got == want
    assert live.select(F.sum("group_size")).first()[0] == 35
