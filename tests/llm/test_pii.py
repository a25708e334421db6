import hashlib
import random
import re

import numpy as np
import pytest

from txnwatch.llm import pii as P

# the statement's patterns, as they stand
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def brute(text):
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(P.BASE[kind], a, b) for a, kind, b in sorted(found)]


@pytest.mark.parametrize("alphabet", ["a.@@12 -", "1234567890-  ", "+1(2). 3-\n", "a@b.c%é-1+"])
def test_base_against_the_patterns(alphabet):
    random.seed(9)
    for _ in range(5000):
        text = "".join(random.choice(alphabet) for _ in range(random.randrange(50)))
        assert P.base_spans(text) == brute(text)


def test_cards_and_limits():
    for text in ("4539 1488 0343 6467", "4539148803436467", "x4539-1488-0343-6467y", "4539148803436468", "256.1.1.1",
                 "00255.000001.1.1 9", "+1 (555) 123-4567", "+123", "a@b", "a@b.c@d.e"):
        assert P.base_spans(text) == brute(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000):
        P.scan(text)


def test_added_spans_never_overlap():
    random.seed(10)
    for _ in range(5000):
        text = "".join(random.choice(["password=", "a1b2c3d4e5f60718", "4539148803436467", " ", "(216) 555-1234", "Dr. Ada", "x@y.zz", "9"]) for _ in range(8))
        spans = P.scan(text)
        base = [(s["start"], s["end"]) for s in spans if s["base"]]
        loose = sorted((s["start"], s["end"]) for s in spans if not s["base"])
        assert all(b <= c for (_, b), (c, _) in zip(loose, loose[1:]))
        assert not any(a < d and c < b for a, b in loose for c, d in base)


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.4
    hit = [0.95, 0.9, 0.9, 0.6, 0.5]
    votes = ["".join("+" if (rng.random() < h) == y else "-" for h in hit) for y in truth]
    ballots, back, counts = np.unique(votes, return_inverse=True, return_counts=True)
    posterior = P.reliabilities(np.zeros(len(ballots), int), list(ballots), counts.astype(float))
    assert ((posterior[back] >= 0.5) == truth).mean() > 0.95


def test_documents(spark, docs, odd_rows):
    rows = odd_rows + [(100 + i, f"call +1 (555) 123-{4000 + i} or mail user{i}@mail.example.com now") for i in range(40)]
    rows += [(200 + i, f"the password=ab12cd34ef{i:02d}98ab76 is set, version {i}.0 of page {i}") for i in range(40)]
    rows += [(300, "ring (216) 555-1234 today")]
    table = docs(rows)
    got = {r["doc_id"]: r for r in P.find(table).collect()}
    assert P.find(table).count() == len(rows)
    assert got[7]["spans"] == ""  # the patterns as they stand take very long on it
    for doc_id, text, *_ in rows:
        if doc_id == 7:
            continue
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text or ""))
        assert got[doc_id]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[doc_id]["spans"].split(","))
    assert (got[105]["n_email"], got[105]["n_phone"], got[105]["n_ip"], got[105]["n_card"]) == (1, 1, 0, 0)
    assert got[205]["spans"] == "secret:13:31"  # the credential is added, version and page are not
    assert got[300]["spans"] == "phone:5:19"
    assert P.find(docs([])).count() == 0
    assert [r["spans"] for r in P.find(docs([(1, "nothing here")])).collect()] == [""]


def test_address_part_of_very_many_zeros():
    part = "0" * 5000
    text = f"x {part}1.2.{part}.4 y"
    assert ("ip", 2, len(text) - 2) in P.base_spans(text)
