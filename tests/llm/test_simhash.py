import random

import pytest
import xxhash

from txnwatch.llm import simhash as S
from txnwatch.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def unsigned(number):
    return number & (2**64 - 1)


def signed(number):
    return number - 2**64 if number >> 63 else number


def brute(prints):
    """Smallest id reachable, by comparing everything with everything."""
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_fingerprint_against_the_statement():
    random.seed(6)
    for _ in range(500):
        text = "".join(random.choice("aB c\n\tÄß\x1c") for _ in range(random.randrange(50)))
        assert unsigned(S.fingerprint(text.encode())) == plain_fingerprint(text)
    assert S.fingerprint(b" \n ") == 0


def test_counting_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefg", k=300)).encode()
    want = S.fingerprint(text)
    monkeypatch.setattr(S, "PART", 7)
    assert S.fingerprint(text) == want


@pytest.mark.parametrize("busy", [1, 4, 32])
def test_components_against_brute_force(spark, monkeypatch, busy):
    """Both indexes find the same links: distances zero to four around a few centres."""
    random.seed(7)
    monkeypatch.setattr(S, "BUSY", busy)
    prints = {}
    for centre in [random.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]:
        for _ in range(40):
            value = centre
            for _ in range(random.randrange(5)):
                value ^= 1 << random.randrange(64)
            prints[len(prints)] = value
    rows = spark.createDataFrame([(i, signed(v)) for i, v in prints.items()], "doc_id long, fp long")
    found = {unsigned(r["fp"]): r["component_id"] for r in S.labels(rows).collect()}
    assert {i: found[v] for i, v in prints.items()} == brute(prints)


def test_membership_and_kept(spark, docs, odd_rows):
    rows = odd_rows + [(20, "SAME text  here"), (21, "one two three four"), (22, "ONE two\nthree four")]
    table = docs(rows)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in S.membership(table).collect()}
    prints = {(r[0], f"{plain_fingerprint(r[1]):016x}") for r in rows}
    assert {g[:2] for g in got} == prints
    ids = {g[0]: g[2] for g in got}
    assert (ids[1], ids[2], ids[8]) == (1, 1, 1)  # wordless texts are alike
    assert ids[4] == ids[5] == ids[20] == 4 and ids[22] == 21 and ids[None] is None
    kept = S.keep_one(table)
    assert kept.columns == table.columns
    # of each component the smallest id stays, once
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 3, 4, 7, 9, 21]
    assert S.membership(docs([])).count() == 0 and S.keep_one(docs([])).count() == 0


def test_row_that_repeats_stays_once(spark, docs):
    rows = [(5, "an early text of five words")] * 3 + [(6, "an early text of five words")]
    assert [r["doc_id"] for r in S.keep_one(docs(rows)).collect()] == [5]


def test_connected_components(spark):
    random.seed(8)
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    random.shuffle(chain)
    links = spark.createDataFrame(chain + star + chain[:5], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}
    assert components(links.limit(0)).count() == 0
