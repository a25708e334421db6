import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from txnwatch.llm import catalog
from txnwatch.llm import conversations as C


def plain_best(rows):
    """Cost, letters and repaired roles by the statement: the smallest (cost, letters) pair of all edits."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if i < len(rows):
            initial, fault = rows[i]
            after = lambda cost, letter, state: (lambda r: (r[0] + cost, letter + r[1]))(best(i + 1, state, 0))
            ways.append(after(4, "D", last))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if initial and (initial == follows[last] or (initial == "s" and last == "")):
                    ways.append(after(extra, "K", initial))
                ways.append(after(3 + extra, "R", follows[last]))
        if inserted < 3:
            cost, letters = best(i, follows[last], inserted + 1)
            ways.append((3 + cost, "I" + letters))
        return min(ways) if ways else (10**9, "")

    return best(0, "", 0)


def plain(conv_rows):
    """The whole result of one conversation from its damaged ``(turn, role, text)`` rows in order."""
    turns = {t for t, _, _ in conv_rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults, seen = [], set()
    for _, role, text in conv_rows:
        rest = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append(
            "blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    pairs = zip(conv_rows, conv_rows[1:])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
    cost, audit = plain_best(tuple((r[:1] if r[:1] in tuple("sua") else "", f) for (_, r, _), f in zip(conv_rows, faults)))
    out, rows, last = [], iter(conv_rows), ""
    for letter in audit:
        wanted = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        if letter == "I":
            out.append(f"{wanted}:")
            last = wanted[0]
            continue
        _, role, text = next(rows)
        if letter != "D":
            role = wanted if letter == "R" else role
            out.append(f"{role}:{text}")
            last = role[0]
    count = faults.count
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest


def plain_damage(rows):
    out = {}
    show = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        kept += [] if kind == 0 else [row, row] if kind == 3 else [row]
    return {c: plain(sorted(k, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for c, k in out.items()}


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_dag_against_all_edits(monkeypatch, block):
    """The statement's answer, whatever the number of rows whose letters one number holds."""
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "PLACES", 1 + 3 * block + 2)
    monkeypatch.setattr(C, "LOW", C.BITS * (1 + 3 * block + 2))
    random.seed(block)
    for _ in range(1500):
        rows = tuple(
            (random.choice(["s", "u", "u", "a", "a", ""]), random.choice(["", "", "", "truncated", "blank", "duplicate"]))
            for _ in range(random.randrange(12))
        )
        assert C.cheapest(rows) == plain_best(rows), rows


def test_long_conversation():
    rows = [("ua"[i % 2], "") for i in range(50_000)]
    assert C.cheapest(rows) == (0, "K" * 50_000)
    assert C.cheapest(rows + [("u", "truncated")]) == (4, "K" * 50_000 + "D")


def run(spark, tmp_path, rows):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seen string, audit string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    found = catalog.op12_repair(spark, str(tmp_path)).collect()
    return {r["conv_id"]: tuple(r)[1:] for r in found}, len(found)


def test_query_against_brute_force(spark, tmp_path):
    random.seed(12)
    texts = ["Yes.", "No!", "What?", "cut off", "  ", "", None, "ends. \n", "Ünï.", "same.", "a" * 1000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "s", "User"]
    rows = []
    for conv in range(150):
        turns = random.sample(range(-3, 30), random.randrange(1, 10))
        rows += [(conv, t, random.choice(roles), random.choice(texts)) for t in sorted(turns)]
    rows += [(None, None, "user", "null everything"), (None, 1, None, None), (500, None, "assistant", "turn is null.")]
    rows += [(501, t, "user", "again.") for t in range(200)]
    rows += [rows[0]] * 3
    random.shuffle(rows)
    got, n = run(spark, tmp_path, [(*r, "theirs", "theirs") for r in rows])
    want = plain_damage(rows)
    assert n == len(want) and got == want


def test_all_rows_dropped(spark, tmp_path):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got, _ = run(spark, tmp_path, [(conv, 0, "user", "gone.", "", "")])
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == ({}, 0)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "")]
    found = C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert (found["cost"], found["audit"]) == (7, "KIKD")
    assert [tuple(r) for r in found["repaired"]] == [("system", "Be kind."), ("user", ""), ("assistant", "Hello.")]
