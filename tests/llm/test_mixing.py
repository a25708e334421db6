import random
from collections import Counter

import numpy as np
import pytest

from txnwatch.llm import mixing as M


def targets(sizes, weights=(1, 2, 3), cap=3):
    """The statement's targets: shares by weight, excess shared again until no source is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in held]
        left = total - sum(held.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return held | share
        held |= {s: cap * sizes[s] for s in above}


def rows_of(seed, sources, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = r.choices(list(sources), list(sources.values()))[0]
        rows.append((i, " ".join(["w"] * int(r.paretovariate(0.9) * 3) if r.random() < 0.97 else []), "en", source))
    return rows


@pytest.mark.parametrize("seed", (0, 2))
def test_against_the_statement(spark, docs, seed, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 150)
    rows = rows_of(seed, {"b": 50, "ä": 5, "a": 30, None: 10, "Z": 1, "c": 4}, 800)
    got = M.mix(docs(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    want, taken = targets(dict(sizes)), Counter()
    for r in got:
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and 0 <= r["copies"] <= 3
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["copies"] * r["size"]
    for source, target in want.items():
        longest = max(len(r[1].split()) for r in rows if r[3] == source)
        rest = sizes[source] - longest
        # one document may be most of a source, and is taken whole or not at all
        unavoidable = min(max(0, target - k * longest - 3 * rest, k * longest - target) for k in range(4))
        assert abs(taken[source] - target) <= unavoidable + max(0.005 * target, 2)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    again = M.mix(docs(rows).repartition(5)).collect()
    assert sorted(tuple(r) for r in again if r["source"]) == sorted(tuple(r) for r in got if r["source"])


def test_multipliers_solve_the_dual(spark):
    rows = [("a", 10, 4), ("a", 3, 5), ("b", 1000, 7), (None, 2, 1), ("zero", 0, 9)]
    cells = spark.createDataFrame(rows, "source string, size long, n long")
    goals = spark.createDataFrame(
        [("a", 55, 1.5), ("b", 7000, 21000.0), (None, 2, 2.0), ("zero", 0, 0.0)], "source string, source_size long, target double"
    )
    found = {r["source"]: r["lambda"] for r in M.multipliers(cells, goals).collect()}
    assert found == pytest.approx({"a": np.log(1.5 / 55), "b": np.log(3), None: 0.0}, abs=1e-8)


def test_rounding_follows_the_rate():
    rng = np.random.default_rng(5)
    sizes = np.sort((rng.pareto(1.0, 2000) * 5 + 1).astype(int))[::-1]
    for rate in (0.0, 0.01, 0.4, 1.0, 1.7, 2.999, 3.0):
        taken = M.copies(sizes, rate)
        assert taken.min() >= 0 and taken.max() <= 3
        assert abs((taken * sizes).sum() - rate * sizes.sum()) <= 1 + sizes[-1]


def test_odd_rows(spark, docs, odd_rows):
    table = docs(odd_rows)
    got = M.mix(table).collect()
    assert len(got) == len(odd_rows) and all(r["copies"] <= 3 for r in got)
    mixed = M.repeat(table)
    assert mixed.columns == table.columns and set(r["kept"] for r in mixed.collect()) <= {"theirs"}
    assert M.mix(docs([])).count() == 0 and M.repeat(docs([])).count() == 0
    assert [r["copies"] for r in M.mix(docs([(1, ""), (2, None)])).collect()] == [0, 0]


def test_repeats_match_the_mix(spark, docs):
    rows = rows_of(9, {"a": 5, "b": 1, "c": 1}, 200)
    taken = {r["doc_id"]: r["copies"] for r in M.mix(docs(rows)).collect()}
    assert Counter(r["doc_id"] for r in M.repeat(docs(rows)).collect()) == Counter({i: n for i, n in taken.items() if n})


def test_many_sources_rank_by_code_point(spark):
    names = [f"{c}{i}" for c in "aZéz日" for i in range(30)] + [None]
    random.Random(1).shuffle(names)
    rows = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long").repartition(6)
    got = {r["source"]: r["rank"] for r in M.ranked_sources(rows).collect()}
    order = sorted((n for n in names if n is not None), key=lambda s: s.encode()) + [None]
    assert got == {n: i for i, n in enumerate(order)}


def test_rows_without_an_id_of_their_own_keep_the_target(spark, docs):
    """A third of the ids null and a third repeated: what ``repeat`` gives is what ``mix`` says."""
    rows = rows_of(4, {"a": 6, "b": 1, "c": 2}, 300)
    rows = [((None, 7, r[0])[i % 3], *r[1:]) for i, r in enumerate(rows)]
    words = Counter()
    for r in M.repeat(docs(rows)).collect():
        words[r["source"]] += len((r["text"] or "").split())
    plan, size = Counter(), {}
    for r in M.mix(docs(rows)).collect():
        plan[r["source"]] += r["copies"] * r["size"]
        size[r["source"]] = r["target"]
    assert len(M.mix(docs(rows)).collect()) == len(rows)
    for source, target in size.items():
        assert abs(words[source] - target) <= 0.02 * target + 20, source
        assert abs(plan[source] - target) <= 0.02 * target + 20, source
