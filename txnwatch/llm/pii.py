"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Four base patterns (email, ip, card, phone) find spans that always stay. Looser generators add
candidates: written-out addresses, national phone numbers, credentials, titled names, and every
other number as a possible identifier (few are, which shows the model what a wrong candidate
looks like). On every candidate five labelers vote yes, no or nothing: the pattern's own check, a gazetteer, the words
before it, its shape, and how it stands in the text. Expectation-maximisation estimates each
labeler's reliability from how often they agree (Dawid and Skene's model; an abstention says nothing), over
the counted vote patterns of all documents. Its posteriors are the soft labels of a logistic
span classifier over features of the span; candidates it gives one half or more are added.

Texts are scanned once; only counts of (kind, votes, features) reach the driver, whose number
is bounded by the possible patterns, however many documents there are.

Defined results: a null text counts as empty and has no spans; offsets are code points, ends
exclusive; an added span never overlaps a base one or an earlier added one; rows that repeat are
scanned each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.llm.common import text_list, written

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "name", "id")
LABELERS = ("check", "gazetteer", "context", "shape", "stand")
FEATURES = ("digits", "letters", "upper", "long", "parts", "marked", "cue", "known", "spaced")
MAX_CELLS = 500_000

# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The loose generators and the labelers' word lists.
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
WRITTEN_AT = ("(at)", "[at]", "{at}")
WRITTEN_EMAIL = re.compile(r"([A-Za-z0-9._%+-]{1,64}) ?[(\[{]at[)\]}] ?([A-Za-z0-9-]+(?: ?(?:\.|[(\[{]dot[)\]}]) ?[A-Za-z0-9-]+)+)")
NATIONAL = re.compile(r"(?<![\w+.])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![\w.])")
RUN = re.compile(r"[0-9]+")
SECRET = re.compile(r"[A-Za-z0-9_/+-]{16,}={0,2}")
TITLES = ("Mr. ", "Mrs. ", "Ms. ", "Dr. ", "Herr ", "Frau ", "Señor ", "Señora ", "Monsieur ", "Madame ")
NAMED = re.compile(r"[^\W\d_a-z][^\W\d_]+(?: [^\W\d_a-z][^\W\d_]+)?")
CUES = frozenset(
    "mail email e-mail tel phone telefon call fax mobile contact ip host server address card visa "
    "mastercard credit karte password passwd pwd token secret key apikey api_key bearer login".split()
)
ANTI_CUES = frozenset("version v license licence page chapter section isbn figure table no nr since year".split())
ENDINGS = frozenset("com org net edu gov io de fr es uk eu info".split())
PREFIXES = {"secret": ("AKIA", "ASIA", "ghp_", "sk-", "xox"), "card": ("4", "5", "34", "37", "6011", "65"), "phone": ("+1", "+3", "+4", "+5", "+8", "(")}
WORD_BEFORE = re.compile(r"([^\W\d][\w-]*)[^\w]{0,4}\Z")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """What the pattern finds, left to right, by way of the at-signs."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            end = host.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four kinds, those that fail their check left out, in order."""
    found = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def loose_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    if any(mark in text for mark in WRITTEN_AT):
        found += [("email", *m.span()) for m in WRITTEN_EMAIL.finditer(text)]
    end = 0
    for m in RUN.finditer(text):
        if m.start() < end:
            continue
        # the stretch of credential characters around a digit
        start = m.start()
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "_/+-")):
            start -= 1
        token = SECRET.match(text, start)
        end = m.end() if token is None else token.end()
        if token and any(c.isalpha() for c in token[0]):
            found.append(("secret", *token.span()))
        else:
            found += [("id", *run.span()) for run in RUN.finditer(text, m.start(), end)]
    if end:
        found += [("phone", *m.span()) for m in NATIONAL.finditer(text)]
    for title in TITLES:
        at = text.find(title)
        while at >= 0:
            name = NAMED.match(text, at + len(title))
            if name and (at == 0 or not text[at - 1].isalnum()):
                found.append(("name", name.start(), name.end()))
            at = text.find(title, at + len(title))
    return found


def _without_overlaps(base: list[tuple[str, int, int]], loose: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    furthest = list(accumulate((b for _, b in taken), max))
    kept, end = [], -1
    for kind, a, b in sorted(loose, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        before = bisect_left(starts, b)  # base spans that start before this one ends
        if a >= end and not (before and furthest[before - 1] > a):
            kept.append((kind, a, b))
            end = b
    return kept


def votes(text: str, kind: str, a: int, b: int, base: bool) -> tuple[str, int]:
    """The labelers' votes, a character of ``+0-`` each, and the features of the span as bits."""
    span, before = text[a:b], text[max(0, a - 24) : a]
    digits, letters = sum(c.isdigit() for c in span), sum(c.isalpha() for c in span)
    word = WORD_BEFORE.search(before)
    word = word[1].lower() if word else ""
    cue, anti = word in CUES, word in ANTI_CUES
    marked = before.rstrip()[-1:] in ("=", ":", '"', "'")
    known = span.startswith(PREFIXES.get(kind, ())) if kind in PREFIXES else (
        kind == "name" or span.rstrip(".").rsplit(".", 1)[-1].lower() in ENDINGS
    )
    mixed = digits >= 4 and letters >= 3
    if kind == "secret":
        check = "+" if mixed and (known or re.fullmatch(r"[0-9a-f]{16,}", span)) else "-" if digits < 4 else "0"
        shape = "+" if 16 <= len(span) <= 128 and digits * 4 >= len(span) else "-"
    elif kind == "id":
        check = "-" if digits < 7 or (14 <= digits <= 19 and not luhn(span)) else "0"
        shape = "+" if 7 <= digits <= 19 else "-"
    elif kind == "name":
        check, shape = "+", "+" if 3 <= len(span) <= 40 else "-"
    else:
        check = "+" if base else "0"
        shape = "+" if 7 <= len(span) <= 80 else "-"
    outer = text[a - 1 : a] + text[b : b + 1]
    free = not any(c.isalnum() for c in outer)
    ballot = check + ("+" if known else "0") + ("+" if cue else "-" if anti else "0") + shape + ("+" if free else "-")
    bits = (
        digits * 4 >= len(span), letters * 2 >= len(span), any(c.isupper() for c in span), len(span) >= 16,
        any(c in ".-() " for c in span), marked, cue, known, free,
    )
    return ballot, sum(1 << i for i, bit in enumerate(bits) if bit)


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("base", T.BooleanType()), T.StructField("votes", T.StringType()), T.StructField("features", T.IntegerType()),
    ]
)
ARROW_SPAN = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.string()), ("features", pa.int32())]
    )
)


def scan(text: str) -> list[dict]:
    base = base_spans(text)
    out = []
    for of, spans in ((True, base), (False, _without_overlaps(base, loose_spans(text)))):
        for kind, a, b in spans:
            ballot, bits = votes(text, kind, a, b, of)
            out.append({"kind": kind, "start": a, "end": b, "base": of, "votes": ballot, "features": bits})
    return out


@F.arrow_udf(T.ArrayType(SPAN))
def scanned(texts: pa.Array) -> pa.Array:
    return pa.array([scan(t) for t in text_list(texts)], ARROW_SPAN)


# --- the label model and the classifier ---------------------------------------------------
def reliabilities(kinds: np.ndarray, ballots: list[str], counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of a true span per vote pattern, by expectation-maximisation over counted patterns."""
    cast = np.array([["-0+".index(v) for v in ballot] for ballot in ballots])
    posterior = np.clip(0.5 + 0.15 * (cast - 1).sum(1), 0.05, 0.95)
    for _ in range(rounds):
        log_odds = np.zeros(len(counts))
        for kind in np.unique(kinds):
            of = kinds == kind
            prior = ((posterior * counts)[of].sum() + 2) / (counts[of].sum() + 4)
            log_odds[of] = np.log(prior / (1 - prior))
        for labeler in range(cast.shape[1]):
            seen = np.stack(
                [np.bincount(cast[:, labeler], weight, 3) + 1.0 for weight in (counts * (1 - posterior), counts * posterior)]
            )
            seen[:, 1] = 0  # abstentions
            seen = seen / seen.sum(1, keepdims=True)
            seen[:, 1] = 1
            log_odds += np.log(seen[1] / seen[0])[cast[:, labeler]]
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return posterior


def _inputs(kinds: np.ndarray, bits: np.ndarray) -> np.ndarray:
    one_hot = kinds[:, None] == np.arange(len(KINDS))
    flags = (bits[:, None] >> np.arange(len(FEATURES))) & 1
    return np.hstack([one_hot, flags]).astype(float)


EVIDENCE = 1e5
"""What all candidates together weigh against the classifier's prior."""


def classifier(kinds: np.ndarray, bits: np.ndarray, soft: np.ndarray, counts: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by Newton steps."""
    # shares, so that a corpus of any size gives the same weights
    x, weight = _inputs(kinds, bits), counts * (EVIDENCE / counts.sum())
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - soft)) + 0.1 * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(curve, slope), -5, 5)
    return w


def fitted(spans: DataFrame) -> np.ndarray | None:
    """Classifier weights from the votes on all candidates (``s``: array of spans per document)."""
    cells = (
        spans.select(F.explode("s").alias("x")).groupBy("x.kind", "x.votes", "x.features").agg(F.count("*").alias("n"))
        .orderBy("kind", "votes", "features").limit(MAX_CELLS + 1).collect()
    )
    if not cells:
        return None
    if len(cells) > MAX_CELLS:
        raise ValueError("more vote patterns than the labelers can make")
    kinds = np.array([KINDS.index(c["kind"]) for c in cells])
    counts = np.array([c["n"] for c in cells], float)
    soft = reliabilities(kinds, [c["votes"] for c in cells], counts)
    return classifier(kinds, np.array([c["features"] for c in cells]), soft, counts)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


def _reporter(weights: np.ndarray | None):
    def report(found: pa.Array) -> pa.Array:
        rows = []
        for spans in found.to_pylist():
            kept = list(spans)
            if spans and weights is not None:
                kinds = np.array([KINDS.index(s["kind"]) for s in spans])
                sure = _inputs(kinds, np.array([s["features"] for s in spans])) @ weights >= 0
                kept = [s for s, yes in zip(spans, sure) if s["base"] or yes]
            base = [(s["kind"], s["start"], s["end"]) for s in spans if s["base"]]
            every = [(s["kind"], s["start"], s["end"]) for s in kept]
            counts = {f"n_{kind}": sum(s[0] == kind for s in base) for kind in BASE}
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append(counts | {"base_sha256": digest, "spans": _joined(every)})
        names = [(f"n_{kind}", pa.int64()) for kind in BASE] + [("base_sha256", pa.string()), ("spans", pa.string())]
        return pa.array(rows, pa.struct(names))

    return F.arrow_udf(report, REPORT)


REPORT = "struct<" + ",".join(f"n_{kind}:bigint" for kind in BASE) + ",base_sha256:string,spans:string>"


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts and digest, and all ``spans``, a row per document."""
    spans = written(docs.select("doc_id", scanned("text").alias("s")), "spans")
    report = _reporter(fitted(spans))
    return spans.select("doc_id", report("s").alias("r")).select("doc_id", "r.*")
