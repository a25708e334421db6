import random
from collections import Counter

import pytest

from txnwatch.llm import quality_rules as Q


def counts(text):
    """The counts as stated, from first principles."""
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), dup, len(covered))


def test_counts_against_the_statement():
    random.seed(1)
    for _ in range(2000):
        text = "".join(random.choice("ab \n\t#é\x1c\xa0|日") for _ in range(random.randrange(60)))
        assert Q.measure_text(text.encode()) == counts(text)


def test_long_texts_count_alike(monkeypatch):
    text = " ".join(random.Random(2).choices("abcdefgh", k=400)).encode()
    want = Q.measure_text(text)
    monkeypatch.setattr(Q, "LONG_TEXT", 5)
    assert Q.measure_text(text) == want


def test_odd_rows(spark, docs, odd_rows):
    table = docs(odd_rows)
    rows = Q.judge(table).select("_row.*", "_m.*", "_base_failed", "_kept").collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        assert tuple(row[name] for name in Q.COUNTS) == counts(row["text"])
        words, repeats = row["n_words"], row["n_repeat_words"]
        assert row["_base_failed"] == (words < 50 or 100 * repeats > 50 * words)
        assert row["kept"] == "theirs"
    assert Q.judge(docs([])).count() == 0
    assert Q.keep_good(table).columns == table.columns


def prose(seed, words=120):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(words))


def test_limits_follow_the_group(spark, docs):
    """Text full of symbols is fine where that is usual, and is rejected elsewhere."""
    code = lambda i: " ".join(w + "|&" for w in prose(i).split())
    rows = [(i, prose(i), "en", "web") for i in range(300)] + [(1000 + i, code(i), "en", "forge") for i in range(300)]
    rows += [(5000, code(5000), "en", "web"), (5001, code(5001), "en", "forge"), (5002, prose(5002), "en", "rare")]
    kept = {r["doc_id"] for r in Q.keep_good(docs(rows)).collect()}
    assert kept == {r[0] for r in rows} - {5000}


def test_word_length_limits_come_from_the_sketch(spark, docs):
    """The same words are too long where texts are alike, and are not where lengths vary widely."""
    of_length = lambda i, n: " ".join(w[:1] + "x" * (n - 1) for w in prose(i).split())
    rows = [(i, of_length(i, 5), "en", "even") for i in range(200)]
    rows += [(1000 + i, of_length(i, 3 + i % 8), "en", "mixed") for i in range(200)]
    rows += [(5000, of_length(1, 6), "en", "even"), (5001, of_length(1, 7), "en", "even"), (5002, of_length(1, 13), "en", "mixed")]
    limits = {r["_source"]: r["limits"]["word_length"] for r in Q.fences(Q.sketches(Q.measured(docs(rows))), Q.Rules()).collect()}
    slack = Q.Rules().slack["word_length"]
    assert limits["even"]["most"] - limits["even"]["least"] == 2 * slack
    assert limits["mixed"]["most"] - limits["mixed"]["least"] > 6 * slack
    repeats_allowed = Q.Rules(slack=Q.Rules().slack | {"repeats": 1000})
    kept = {r["doc_id"] for r in Q.keep_good(docs(rows), repeats_allowed).collect()}
    assert 5002 in kept and 5001 not in kept


@pytest.mark.parametrize("value", [0, 1, 63, 64, 65, 127, 128, 1000, 12345, 10**9])
def test_cells_keep_six_bits(spark, value):
    from pyspark.sql import functions as F

    cell = spark.range(1).select(Q.cell(F.lit(value).cast("long")).alias("c")).first()["c"]
    shift = max(0, value.bit_length() - 6)
    assert cell == (value >> shift) << shift


def test_sketches_merge(spark, docs):
    rows = Q.measured(docs([(i, prose(i, 60 + i)) for i in range(40)]))
    whole = {tuple(r[:4]): r[4] for r in Q.sketches(rows).collect()}
    halves = Counter()
    for part in (0, 1):
        for r in Q.sketches(rows.filter(f"_row.doc_id % 2 = {part}")).collect():
            halves[tuple(r[:4])] += r[4]
    assert halves == whole


def test_kept_texts_are_measured_by_one_worker(docs):
    """A filter on the counts that is pushed below them would measure every text again, by a second worker of the task."""
    kept = Q.keep_good(docs([(i, prose(i, 60 + i), "en", "a") for i in range(40)]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert kept.count() > 0
