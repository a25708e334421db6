"""Toxic spans by a linear-chain conditional random field over words.

Two tags, clean and toxic. A word's evidence is a sum of learned weights of hashed features: the
word, its beginnings and endings, and the same of its neighbours. Training words are labelled
from document marks: in a document marked toxic, a word is toxic when it, or its beginning, is
found in toxic documents far more often than in clean ones; copies and near copies of a sampled
text are left out of the sample, or all their words would look toxic. The field is fitted by gradient
steps on the exact likelihood (forward-backward); marginals by forward-backward score every word
of every text. A small logistic model turns a text's marginals into its score; spans are runs of
words whose marginal is at least one half.

Each different word of a task is hashed once. The recursions run over all texts of a batch at
the same time, position by position, over whole texts.

Defined results: a null text counts as empty; a text without words scores as one without any
evidence and has no spans; with only one mark, or none, to learn from every score is 0; rows that repeat
are scored each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import bounded_sample, byte_list, byte_slices, held_out

SLOTS = 1 << 17
EDGE = ".,;:!?\"'()[]"
CACHED_WORDS = 1_000_000
RESULT = "doc_id bigint, held_out boolean, score double, predicted int, spans string"


@dataclass(frozen=True)
class Fit:
    """``per_label`` and ``max_bytes`` bound the sample that fits the model."""

    per_label: int = 1500
    max_bytes: int = 12_000
    steps: int = 40
    rate: float = 0.3
    ridge: float = 2e-4
    least_seen: int = 3
    least_share: float = 0.015
    least_odds: float = 40.0
    parts: int = 5
    held_part: int = 0


def word_features(word: bytes) -> tuple[list[int], list[int]]:
    """Hashed features of a word, and those by which it speaks for its neighbours."""
    word = _plain(word)
    own = ("w" + word, "a" + word[:4], "b" + word[:5], "c" + word[:6], "z" + word[-4:])
    near = ("n" + word, "m" + word[:4])
    return [crc32(f.encode()) % SLOTS for f in own], [crc32(f.encode()) % SLOTS for f in near]


def _plain(word: bytes) -> str:
    return word.decode("utf-8", "replace").strip(EDGE).lower()


OWN, NEAR = 5, 2


def _log1pexp(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


PIECE = 8192
"""Words of a text that are passed one after the other; what follows is cut into pieces passed side by side."""


class Chain:
    """The recursions for texts of any length, all at once. ``trans``: scores from clean/toxic to clean/toxic.

    A text longer than ``PIECE`` words has a first part of at most that many and whole pieces
    after it. The product of a piece's transition matrices says what a piece makes of the odds it
    is given from either side, so the odds between pieces come first and the words of all pieces
    after that.
    """

    def __init__(self, lengths: np.ndarray):
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
        self.pieces = np.maximum(lengths - 1, 0) // PIECE
        first = lengths - self.pieces * PIECE
        self.order = np.argsort(-first, kind="stable")
        sizes, starts = first[self.order], begin[self.order]
        self.longest = int(sizes[0]) if len(sizes) else 0
        # texts that still have a word at each position of their first part
        active = np.searchsorted(-sizes, -np.arange(self.longest), side="left")
        self.at = [starts[:n] + t for t, n in enumerate(active)]
        # of each long text: the place of its first piece; of each piece: the places of its words
        self.long = [(int(begin[i] + first[i]), int(self.pieces[i])) for i in np.flatnonzero(self.pieces)]
        heads = [start + PIECE * np.arange(n) for start, n in self.long]
        heads = np.concatenate(heads) if heads else np.zeros(0, np.int64)
        self.rest = heads[:, None] + np.arange(PIECE)

    def marginals(self, evidence: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of toxic from the left (with the word itself) and from the right (without it)."""
        left, right = np.zeros_like(evidence), np.zeros_like(evidence)
        for t in range(self.longest):
            at = self.at[t]
            before = 0.0 if t == 0 else self._pass(left[at - 1], trans[0], trans[1])
            left[at] = evidence[at] + before
        if self.long:
            self._pieces(evidence, trans, left, right)
        for t in range(self.longest - 2, -1, -1):
            at = self.at[t + 1] - 1
            after = evidence[at + 1] + right[at + 1]
            right[at] = self._pass(after, trans[:, 0], trans[:, 1])
        return left, right

    def _pieces(self, evidence: np.ndarray, trans: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Fills in the pieces of long texts, and ``right`` at the last word before them."""
        words = evidence[self.rest]
        through = self._products(words, trans)
        given = np.zeros(len(words))
        number = 0
        for start, n in self.long:
            odds = left[start - 1]
            for piece in range(number, number + n):
                given[piece] = odds
                (a, b), (c, d) = through[piece]
                odds = np.logaddexp(b, odds + d) - np.logaddexp(a, odds + c)
            odds = 0.0
            for piece in range(number + n - 1, number - 1, -1):
                right[self.rest[piece, -1]] = odds
                (a, b), (c, d) = through[piece]
                odds = np.logaddexp(c, odds + d) - np.logaddexp(a, odds + b)
            right[start - 1] = odds
            number += n
        for t in range(PIECE):
            given = words[:, t] + self._pass(given, trans[0], trans[1])
            left[self.rest[:, t]] = given
        back = right[self.rest[:, -1]]
        for t in range(PIECE - 1, 0, -1):
            back = self._pass(words[:, t] + back, trans[:, 0], trans[:, 1])
            right[self.rest[:, t - 1]] = back

    @staticmethod
    def _products(words: np.ndarray, trans: np.ndarray) -> np.ndarray:
        """Logarithms of the products of each piece's matrices, up to a factor: piece x from x to."""
        product = np.repeat(trans[None], len(words), 0)
        product[:, :, 1] += words[:, 0, None]
        for t in range(1, words.shape[1]):
            clean, toxic = product[:, :, 0], product[:, :, 1]
            to_clean = np.logaddexp(clean + trans[0, 0], toxic + trans[1, 0])
            to_toxic = np.logaddexp(clean + trans[0, 1], toxic + trans[1, 1]) + words[:, t, None]
            product = np.stack([to_clean, to_toxic], 2)
            product -= to_clean[:, :1, None]
        return product

    @staticmethod
    def _pass(odds: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Log odds after a transition; ``clean`` and ``toxic``: scores out of (or into) each tag."""
        top = _log1pexp(odds + toxic[1] - clean[1]) + clean[1]
        bottom = _log1pexp(odds + toxic[0] - clean[0]) + clean[0]
        return top - bottom

    def pair_marginals(self, evidence, left, right, trans) -> np.ndarray:
        """Expected transitions, 2 x 2, over all texts."""
        here = np.concatenate([*self.at[1:], self.rest.ravel()]).astype(np.int64)
        a, b = left[here - 1], evidence[here] + right[here]
        scores = np.stack([trans[0, 0] + 0 * a, trans[0, 1] + b, trans[1, 0] + a, trans[1, 1] + a + b])
        scores = np.exp(scores - scores.max(0))
        return (scores / scores.sum(0)).sum(1).reshape(2, 2)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def different(texts: list[bytes]) -> list[int]:
    """Positions of texts that share none of three MinHash values with an earlier one."""
    kept, seen = [], set()
    for i, text in enumerate(texts):
        words = text.split()
        shingles = {b" ".join(words[j : j + 5]) for j in range(max(1, len(words) - 4))}
        least = {(seed, min(crc32(s, seed) for s in shingles)) for seed in (1, 2, 3)}
        if seen.isdisjoint(least):
            kept.append(i)
        seen |= least
    return kept


def labelled_words(texts: list[list[bytes]], toxic: np.ndarray, fit: Fit) -> list[np.ndarray]:
    """Marks the words of toxic texts that, by word or beginning, come from toxic texts."""
    bad_in, good_in = Counter(), Counter()
    parts = lambda w: {"w" + w, "a" + w[:4], "b" + w[:5]}
    of = lambda words: set().union(*(parts(_plain(w)) for w in set(words))) if words else set()
    for words, mark in zip(texts, toxic):
        if mark:
            bad_in.update(of(words))
    least = max(fit.least_seen, fit.least_share * (toxic == 1).sum())
    bad_in = {part: n for part, n in bad_in.items() if n >= least}
    for words, mark in zip(texts, toxic):
        if not mark:
            good_in.update(of(words) & bad_in.keys())
    share = max(1, (toxic == 0).sum()) / max(1, (toxic == 1).sum())
    bad = {part for part, n in bad_in.items() if n * share / (good_in[part] + 0.5) >= fit.least_odds}
    return [
        np.array([bool(mark) and not bad.isdisjoint(parts(_plain(w))) for w in words], bool)
        for words, mark in zip(texts, toxic)
    ]


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    scale: np.ndarray

    def evidence(self, codes: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray, starts: np.ndarray):
        out = own[codes]
        if len(codes) > 1:
            first = np.zeros(len(codes), bool)
            first[starts] = True
            out[1:] += np.where(first[1:], 0.0, before[codes[:-1]])
            out[:-1] += np.where(first[1:], 0.0, after[codes[1:]])
        return out

    def score(self, marginals: np.ndarray) -> float:
        return float(sigmoid(self.scale @ summary(marginals)))


def summary(marginals: np.ndarray) -> np.ndarray:
    if not len(marginals):
        return np.array([1.0, -10.0, 0.0])
    top = float(np.clip(marginals.max(), 1e-5, 1 - 1e-5))
    return np.array([1.0, np.log(top / (1 - top)), np.log1p(marginals[marginals >= 0.5].sum())])


def train(texts: list[bytes], toxic: np.ndarray, fit: Fit) -> Model:
    """Adam on the penalised likelihood, then a logistic model of the documents' marginals."""
    words = [t.split() for t in texts]
    marks = np.concatenate(labelled_words(words, toxic, fit))
    flat = [w for doc in words for w in doc]
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in flat), np.int64, len(flat))
    features = [word_features(w) for w in number]
    own = np.array([f[0] for f in features], np.int64).reshape(-1, OWN)
    near = np.array([f[1] for f in features], np.int64).reshape(-1, NEAR)
    lengths = np.array([len(doc) for doc in words])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    starts, chain = starts[lengths > 0], Chain(lengths)
    first = np.zeros(len(codes), bool)
    first[starts] = True
    inner = ~first[1:]

    # evidence = bias + own features + those of the words before and after (other slots)
    size = 1 + 3 * SLOTS
    params = np.zeros(size + 4)
    params[0] = -2.0
    target = np.zeros((2, 2))
    np.add.at(target, (marks[:-1][inner].astype(int), marks[1:][inner].astype(int)), 1)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, fit.steps + 1):
        model = Model(params[:size], params[size:].reshape(2, 2), np.zeros(3))
        by_word = _word_scores(params, own, near)
        evidence = model.evidence(codes, *by_word, starts)
        left, right = chain.marginals(evidence, model.trans)
        miss = sigmoid(left + right) - marks
        per_word = np.bincount(codes, miss, len(number))
        before = np.bincount(codes[:-1], np.where(inner, miss[1:], 0.0), len(number))
        after = np.bincount(codes[1:], np.where(inner, miss[:-1], 0.0), len(number))
        gradient = np.zeros_like(params)
        gradient[0] = miss.sum()
        gradient[1 : 1 + SLOTS] = np.bincount(own.ravel(), np.repeat(per_word, OWN), SLOTS)
        gradient[1 + SLOTS : 1 + 2 * SLOTS] = np.bincount(near.ravel(), np.repeat(before, NEAR), SLOTS)
        gradient[1 + 2 * SLOTS : size] = np.bincount(near.ravel(), np.repeat(after, NEAR), SLOTS)
        gradient[size:] = (chain.pair_marginals(evidence, left, right, model.trans) - target).ravel()
        gradient = gradient / max(1, len(codes)) + fit.ridge * params / max(1.0, len(codes) ** 0.5)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        params -= fit.rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-10)
    model = Model(params[:size], params[size:].reshape(2, 2), np.zeros(3))
    evidence = model.evidence(codes, *_word_scores(params, own, near), starts)
    found = sigmoid(sum(chain.marginals(evidence, model.trans)))
    cuts = np.cumsum(lengths)[:-1]
    x = np.array([summary(m) for m in np.split(found, cuts)])
    weight = np.zeros(3)
    for _ in range(30):
        p = sigmoid(x @ weight)
        slope = x.T @ (p - toxic) + 0.5 * weight
        weight -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3), slope)
    model.scale = weight
    return model


def _word_scores(params: np.ndarray, own: np.ndarray, near: np.ndarray):
    return (
        params[0] + params[1 + own].sum(1),
        params[1 + SLOTS + near].sum(1),
        params[1 + 2 * SLOTS + near].sum(1),
    )


class Tagger:
    """Scores batches of texts; keeps the scores of words it has seen, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.known = np.zeros((3, 0))

    def tag(self, texts: list[bytes]) -> list[np.ndarray]:
        """The marginals of each text's words."""
        if len(self.number) > CACHED_WORDS:
            self._forget()
        words = [t.split() for t in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        total = int(lengths.sum())
        codes = np.fromiter(
            (self.number.setdefault(w, len(self.number)) for doc in words for w in doc), np.int64, total
        )
        if new := list(self.number)[self.known.shape[1] :]:
            features = [word_features(w) for w in new]
            own = np.array([f[0] for f in features], np.int64)
            near = np.array([f[1] for f in features], np.int64)
            self.known = np.hstack([self.known, np.stack(_word_scores(self.model.weights, own, near))])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
        evidence = self.model.evidence(codes, *self.known, starts[lengths > 0])
        left, right = Chain(lengths).marginals(evidence, self.model.trans)
        return np.split(sigmoid(left + right), np.cumsum(lengths)[:-1])


def spans(text: str, marginals: np.ndarray) -> list[tuple[int, int]]:
    """Code-point offsets of runs of toxic words."""
    found: list[tuple[int, int]] = []
    if not (marginals >= 0.5).any():
        return found
    before = False
    for word, p in zip(re.finditer(r"[^ \t\n\x0b\x0c\r]+", text), marginals):
        if p >= 0.5:
            start = found.pop()[0] if before else word.start()
            found.append((start, word.end()))
        before = p >= 0.5
    return found


def _scorer(model: Model, batch_bytes: int = 8 << 20):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            texts, scores, offsets = byte_list(batch.column(1)), [], []
            for part in byte_slices(texts, batch_bytes):
                for text, marginals in zip(texts[part], tagger.tag(texts[part])):
                    scores.append(model.score(marginals))
                    toxic = spans(text.decode(), marginals) if (marginals >= 0.5).any() else []
                    offsets.append(",".join(f"{a}:{b}" for a, b in toxic))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(offsets, pa.string())],
                names=["doc_id", "score", "spans"],
            )

    return run


def score(docs: DataFrame, labels: DataFrame, fit: Fit | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every document. ``labels``: ``doc_id, toxic``."""
    fit = fit or Fit()
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_kind")).filter("_kind IN (0, 1)")
    known = known.filter(~held_out(F.col("_id"), fit.parts, fit.held_part))
    sample = bounded_sample(docs, known, fit.per_label, fit.max_bytes)
    texts = [text.encode() for _, text in sample]
    kept = different(texts)
    toxic = np.array([sample[i][0] for i in kept])
    held = held_out(F.col("doc_id"), fit.parts, fit.held_part).alias("held_out")
    if len(set(toxic.tolist())) < 2:
        return docs.select("doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit("").alias("spans"))
    model = train([texts[i] for i in kept], toxic, fit)
    scored = docs.select("doc_id", "text").mapInArrow(_scorer(model), "doc_id bigint, score double, spans string")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
