import hashlib
import random
import re

import numpy as np
import pytest

from txnwatch.llm import catalog, sieve
from txnwatch.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    """Words, hit words and ids of items, by trying every window at every place."""
    words, hit, ids = words_of(text), set(), set()
    for item_id, item in items:
        target = words_of(item)
        n = min(10, len(target))
        for i in range(len(target) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == target[i : i + n]:
                    hit |= set(range(at, at + n))
                    ids |= {str(item_id)} if item_id is not None else set()
    return len(words), hit, sorted(ids)


def check(found, rows, items):
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in found)
    want = []
    for doc_id, text, *_ in rows:
        n, hit, ids = brute(text, items)
        starts = sorted(i for i in hit if i - 1 not in hit)
        stops = sorted(i + 1 for i in hit if i + 1 not in hit)
        want.append((doc_id is None, doc_id, n, list(zip(starts, stops)), ids))
    assert got == sorted(want)


def test_words_against_the_pattern():
    random.seed(1)
    for _ in range(300):
        text = "".join(random.choice("aZ9 .,-_\x00\x1c\x7f\tÉ日😀\n") for _ in range(40))
        assert [w.decode() for w in D.words_of(text.encode())] == words_of(text)


@pytest.mark.parametrize("parts", [1, 64])
def test_against_brute_force(spark, docs, monkeypatch, parts):
    """A small alphabet, so that windows overlap, repeat and share shingles; short items too."""
    monkeypatch.setattr(D, "PARTS", parts)
    random.seed(parts)
    word = lambda: random.choice(["a", "b", "C", "dé", "e5"])
    text = lambda n: random.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    items = [(i, text(random.choice([0, 1, 2, 3, 5, 9, 10, 11, 14]))) for i in range(25)]
    items += [(3, items[7][1]), (90, items[8][1]), (None, "only this one has no id here but ten words"), (91, None)]
    rows = [(i, text(random.randrange(60))) for i in range(60)]
    rows += [(100 + i, f"start {item} end") for i, (_, item) in enumerate(items)]
    table = spark.createDataFrame(items, "item_id long, text string")
    check(D.find(docs(rows), table).collect(), rows, items)


def test_odd_rows_and_empty_tables(spark, docs, odd_rows):
    items = [(1, "same text here"), (2, "word " * 12), (2, "word " * 12), (3, ""), (4, None), (5, "x" * 200_000)]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = D.find(docs(odd_rows), table).collect()
    # the brute force is too slow on the long text; its answer is plain
    check([r for r in found if r["doc_id"] != 3], [r for r in odd_rows if r[0] != 3], items)
    long = next(r for r in found if r["doc_id"] == 3)
    assert (long["n_words"], [tuple(s) for s in long["spans"]], long["items"]) == (30_000, [(0, 30_000)], ["2"])
    assert D.find(docs([]), table).count() == 0
    clean = D.find(docs(odd_rows), table.limit(0)).collect()
    assert len(clean) == len(odd_rows) and not any(r["spans"] or r["items"] for r in clean)


def test_prefix_is_the_rarest_shingle(spark, docs):
    items = spark.createDataFrame([(1, "the cat sat on a mat"), (2, "the cat sat in a hat")], "item_id long, text string")
    rows = [(i, "the cat sat on") for i in range(5)] + [(9, "the cat sat on a mat"), (10, "the cat sat in a hat")]
    found = D.windows(items)
    rare = D.prefixes(found, D.counted(docs(rows), found)).join(found, "id").collect()
    for row in rare:
        words = row["window"].split()
        counts = [sum(" ".join(words[i : i + 3]) in text for _, text in rows) for i in range(len(words) - 2)]
        assert row["n"] == min(counts) == 1 and counts[row["place"]] == 1


def test_sieve_lets_every_key_through(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(-(2**63), 2**63 - 1, 5_000)
    bitmap = sieve.build(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert sieve.maybe(bitmap, keys.view(np.uint64)).all()
    others = rng.integers(-(2**63), 2**63 - 1, 20_000)
    assert sieve.maybe(bitmap, others.view(np.uint64)).mean() < 0.15
    assert not sieve.maybe(sieve.build(spark.createDataFrame([], "key long")), keys.view(np.uint64)).any()


def test_digest(spark, tmp_path):
    rows = [(5, "one two three four five six seven eight nine ten eleven"), (6, "nothing")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(10, rows[0][1]), (9, "Two three-four five six seven eight nine TEN eleven")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r.asDict() for r in catalog.op11_decontaminate(spark, str(tmp_path)).collect()}
    assert got[5] == {
        "doc_id": 5, "n_words": 11, "n_hit": 11, "n_items": 2, "contaminated": True,
        "items_sha256": hashlib.sha256(b"10,9").hexdigest(),
    }
    assert got[6]["n_hit"] == 0 and got[6]["items_sha256"] == hashlib.sha256(b"").hexdigest()
