import random
import re
import zlib
from collections import Counter

import pytest

from txnwatch.llm import spelling as S


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_near(words):
    """Per word: count of near words, form and its count, by comparing all with all."""
    out = {}
    for w, n in words.items():
        near = [x for x in words if x != w and one_edit(w, x)]
        form = min(near, key=lambda x: (-words[x], x), default=None)
        if form is not None and words[form] < 2 * n:
            form = None
        out[w] = [form, None, n, len(near), words.get(form)]
    for w, row in out.items():
        at = w
        while out[at][0] is not None:
            at = out[at][0]
        row[1] = at
    return {w: tuple(row) for w, row in out.items()}


@pytest.mark.parametrize(("tile", "shared"), [(2048, 512), (8, 4), (3, 1)])
def test_near_words_against_all_pairs(spark, tile, shared):
    """Small alphabets give long lists, many near words and repeated letters; lists are cut at any size."""
    random.seed(tile)
    words = {}
    for alphabet in ("ab", "abé", "abcdÀ"):
        words |= {"".join(random.choices(alphabet, k=random.randrange(5, 9))): random.randrange(3, 40) for _ in range(120)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in S.near(table, tile, shared).collect()}
    want = {}
    for w in words:
        near = [x for x in words if x != w and one_edit(w, x)]
        if near:
            form = min(near, key=lambda x: (-words[x], x))
            want[w] = (len(near), form, words[form])
    assert got == want


def test_query_against_brute_force(spark, docs, odd_rows):
    random.seed(13)
    base = ["liefern", "schreiben", "garçon", "Österreich", "though", "thought", "through", "xxxxxx", "abcde"]

    def typo(word):
        i = random.randrange(len(word))
        return random.choice([word[:i] + word[i + 1 :], word[:i] + random.choice("aeé") + word[i + 1 :], word[:i] + "n" + word[i:]])

    rows = list(odd_rows)
    for i in range(400):
        words = [random.choice(base) for _ in range(12)]
        words = [typo(w) if random.random() < 0.3 else w for w in words]
        rows.append((i, random.choice([" ", "’", "×", "1", " – "]).join(w.upper() if random.random() < 0.1 else w for w in words)))
    rows += [(1000 + i, "z" * 5_000 + " " + "z" * 4_999) for i in range(4)]
    got = {r["word"]: tuple(r)[1:] for r in S.variants(docs(rows)).collect()}
    words = plain_words(rows)
    assert len(words) > 100 and got == plain_near(words)


def test_roots_follow_to_the_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)]
    got = {r["word"]: r["root"] for r in S.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w37" for w, _ in chain}


def test_empty(docs):
    assert S.variants(docs([])).count() == 0
    assert S.variants(docs([(1, None), (2, "")])).count() == 0


def test_runs_against_the_pattern():
    random.seed(5)
    for _ in range(400):
        text = "".join(random.choice("aZé÷×ÿĀǆ’日😀¿Ā 9_\x00") for _ in range(30))
        want = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r) for r in re.findall("[A-Za-zÀ-ÿ]+", text)]
        assert [w.decode() for w in S.runs_of(text.encode())] == want
