"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in windows, forwards and backwards, gives every position
a distribution over languages, and averages the distributions over all positions of the text.
It is trained in numpy by backpropagation through time with the loss at every position, on a
bounded sample of labelled texts (``Fit``), one window of each, cut in Spark: the driver holds
windows, not texts. A language with fewer texts gives several windows of each. Prediction covers
whole texts.
The languages are those of the rows it may learn from.

Defined results: a null text, and one without a letter, is ``und`` with score 0; with no
labelled rows to learn from every text is; rows that repeat are predicted each; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import byte_slices, chosen_documents, held_out, sample_windows, text_list

UNKNOWN = "und"
PAD = 256
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Fit:
    """``per_language`` and ``max_bytes`` bound the sample that fits the network."""

    per_language: int = 1500
    max_bytes: int = 50_000
    hidden: int = 8
    window: int = 64
    batch: int = 192
    steps: int = 260
    rate: float = 0.02
    parts: int = 4
    held_part: int = 2


class Direction:
    """A gated recurrent layer that reads windows in one direction.

    Arrays have units first and windows last, so that gates are blocks of whole rows. Gates:
    reset, update, candidate.
    """

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.inputs = (rng.standard_normal((PAD + 1, 3 * hidden)) * 0.3).astype(np.float32)
        self.states = (rng.standard_normal((3 * hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.hold_at_pad()

    def hold_at_pad(self) -> None:
        """At padding the update gate is one, so the state passes unchanged."""
        self.inputs[PAD] = 0
        self.inputs[PAD, self.hidden : 2 * self.hidden] = 40

    def forward(self, windows: np.ndarray, keep: bool = False):
        """``windows``: position x window. The states after each position; with ``keep`` also the gates."""
        size, half = self.hidden, np.float32(0.5)
        out = np.zeros((len(windows) + 1, size, windows.shape[1]), np.float32)
        kept = []
        for t, codes in enumerate(windows):
            drive = np.ascontiguousarray(np.take(self.inputs, codes, axis=0).T)
            back = self.states @ out[t]
            gates = drive[: 2 * size]
            gates += back[: 2 * size]
            # logistic function by way of tanh
            gates *= half
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            reset, update = gates[:size], gates[size:]
            candidate = drive[2 * size :]
            candidate += reset * back[2 * size :]
            np.tanh(candidate, out=candidate)
            after = np.subtract(out[t], candidate, out=out[t + 1])
            after *= update
            after += candidate
            if keep:
                kept.append((reset, update, candidate, back[2 * size :]))
        return (out, kept) if keep else out

    def backward(self, windows: np.ndarray, out: np.ndarray, kept: list, slope: np.ndarray):
        """Gradients of inputs and states from ``slope``, the loss's slope at each position's state."""
        inputs, states = np.zeros_like(self.inputs), np.zeros_like(self.states)
        n = windows.shape[1]
        flow = np.zeros((self.hidden, n), np.float32)
        for t in range(len(windows) - 1, -1, -1):
            reset, update, candidate, back = kept[t]
            flow = flow + slope[t]
            before = out[t]
            d_candidate = flow * (1 - update) * (1 - candidate * candidate)
            d_update = flow * (before - candidate) * update * (1 - update)
            d_reset = d_candidate * back * reset * (1 - reset)
            one = np.zeros((PAD + 1, n), np.float32)
            one[windows[t], np.arange(n)] = 1
            inputs += one @ np.vstack([d_reset, d_update, d_candidate]).T
            d_back = np.vstack([d_reset, d_update, d_candidate * reset])
            states += d_back @ before.T
            flow = flow * update + self.states.T @ d_back
        inputs[PAD] = 0
        return inputs, states


class Network:
    def __init__(self, languages: list[str], fit: Fit):
        rng = np.random.default_rng(7)
        self.languages, self.fit = languages, fit
        self.ahead, self.behind = Direction(fit.hidden, rng), Direction(fit.hidden, rng)
        self.head = (rng.standard_normal((2 * fit.hidden, len(languages))) * 0.3).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _parameters(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.states, self.behind.inputs, self.behind.states, self.head, self.bias]

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        """``states``: position x unit x window."""
        scores = self.head.T @ states
        scores += self.bias[:, None]
        scores -= scores.max(1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(1, keepdims=True)
        return scores

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """Language distributions at every position: position x language x window."""
        ahead = self.ahead.forward(windows)[1:]
        behind = self.behind.forward(windows[::-1])[1:][::-1]
        return self._softmax(np.concatenate([ahead, behind], 1))

    def train(self, windows: np.ndarray, labels: np.ndarray) -> None:
        """Adam over random batches; ``windows``: window x position."""
        rng = np.random.default_rng(11)
        mean = [np.zeros_like(p) for p in self._parameters()]
        square = [np.zeros_like(p) for p in self._parameters()]
        for step in range(1, self.fit.steps + 1):
            chosen = rng.integers(len(windows), size=self.fit.batch)
            gradients = self._gradients(windows[chosen].T, labels[chosen])
            rate = self.fit.rate * min(1.0, 2 * (1 - step / (self.fit.steps + 1)))
            for i, (p, g) in enumerate(zip(self._parameters(), gradients)):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.99 * square[i] + 0.01 * g * g
                p -= rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
            self.ahead.hold_at_pad()
            self.behind.hold_at_pad()

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        size = self.fit.hidden
        out_a, kept_a = self.ahead.forward(windows, keep=True)
        out_b, kept_b = self.behind.forward(windows[::-1], keep=True)
        states = np.concatenate([out_a[1:], out_b[1:][::-1]], 1)
        miss = self._softmax(states)
        miss[:, labels, np.arange(len(labels))] -= 1
        miss *= (windows != PAD)[:, None, :] / np.float32(max(1, int((windows != PAD).sum())))
        slope = self.head @ miss
        in_a, st_a = self.ahead.backward(windows, out_a, kept_a, slope[:, :size])
        in_b, st_b = self.behind.backward(windows[::-1], out_b, kept_b, slope[::-1, size:])
        return [in_a, st_a, in_b, st_b, np.einsum("tun,tcn->uc", states, miss, optimize=True), miss.sum((0, 2))]

    def pooled(self, texts: list[bytes], batch: int = 1024) -> np.ndarray:
        """The mean distribution over all positions of each text; zeros for an empty one."""
        width = 2 * self.fit.window
        out = np.zeros((len(texts), len(self.languages)))
        counts = np.array([-(-len(t) // width) for t in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        if not len(owner):
            return out
        cells = np.full(len(owner) * width, PAD, np.int16)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) * width
        for start, text in zip(starts, texts):
            cells[start : start + len(text)] = np.frombuffer(text, np.uint8)
        cells = cells.reshape(-1, width)
        for first in range(0, len(cells), batch):
            windows = np.ascontiguousarray(cells[first : first + batch].T)
            found = self.positions(windows)
            found *= (windows != PAD)[:, None, :]
            np.add.at(out, owner[first : first + batch], found.sum(0).T)
        sizes = np.array([max(1, len(t)) for t in texts])
        return out / sizes[:, None]


def _padded(piece: bytes, width: int) -> np.ndarray:
    return np.concatenate([np.frombuffer(piece, np.uint8), np.full(width - len(piece), PAD)]).astype(np.int16)


def trained(docs: DataFrame, fit: Fit) -> Network | None:
    """A network fitted on the labelled documents that may be learned from; None without any."""
    known = docs.filter(
        ~held_out(F.col("doc_id"), fit.parts, fit.held_part) & F.col("lang").isNotNull() & (F.octet_length("text") > 0)
    )
    kinds = known.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_kind")).distinct()
    sample = chosen_documents(known, kinds, fit.per_language, fit.max_bytes)
    if not sample:
        return None
    own: dict[str, list[tuple]] = {}
    for language, *document in sample:
        own.setdefault(language, []).append(document)
    languages = sorted(own)
    # classes weigh alike: each text gives windows until its language has its share
    share, rng = max(map(len, own.values())), np.random.default_rng(3)
    draws = [(*own[of][i % len(own[of])], int(rng.integers(1 << 31))) for of in languages for i in range(share)]
    windows = np.array([_padded(piece, fit.window) for piece in sample_windows(known, draws, fit.window)])
    labels = np.repeat(np.arange(len(languages)), share)
    network = Network(languages, fit)
    network.train(windows, labels)
    return network


def _predictor(network: Network, batch_bytes: int = 4 << 20):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_list(batch.column(1))
            as_bytes = [t.encode() for t in texts]
            found, scores = [], []
            for part in byte_slices(as_bytes, batch_bytes):
                for text, row in zip(texts[part], network.pooled(as_bytes[part])):
                    best = int(row.argmax())
                    letters = LETTER.search(text) is not None
                    found.append(network.languages[best] if letters else UNKNOWN)
                    scores.append(min(1.0, float(row[best])) if letters else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, fit: Fit | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document."""
    fit = fit or Fit()
    held = held_out(F.col("doc_id"), fit.parts, fit.held_part).alias("held_out")
    network = trained(docs, fit)
    if network is None:
        return docs.select("doc_id", held, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = docs.select("doc_id", "text").mapInArrow(_predictor(network), "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held, "lang_pred", "score")
