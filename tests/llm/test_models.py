import random
from zlib import crc32

import numpy as np
import pytest

from txnwatch.llm import crf, langid, ranking

LABELS = "doc_id long, quality int, toxic int"


def held(doc_id, parts, part):
    return crc32(str(doc_id).encode()) % parts == part


def words(seed, n, letters="abcdefghijkl"):
    r = random.Random(seed)
    return ["".join(r.choices(letters, k=r.randrange(2, 7))) for _ in range(n)]


# --- language -----------------------------------------------------------------------------
SPEECH = {"xx": "the of and ing er to", "yy": "der und ch sch ein ö", "zz": "que les eau é ou tion"}


def speech(language, seed, n=30):
    r = random.Random(f"{language}{seed}")
    return " ".join("".join(r.choices(SPEECH[language].split(), k=r.randrange(1, 4))) for _ in range(n))


FAST = langid.Fit(per_language=60, hidden=6, window=32, batch=48, steps=60)


def test_gradients_against_differences():
    """Backpropagation through time equals finite differences of the loss."""
    network = langid.Network(["a", "b"], langid.Fit(hidden=3))
    for layer in (network.ahead, network.behind):
        layer.inputs, layer.states = layer.inputs.astype(np.float64), layer.states.astype(np.float64)
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 5, (7, 4))
    windows[5:, 1] = langid.PAD
    labels = np.array([0, 1, 0, 1])

    def loss():
        p = network.positions(windows)
        own = np.log(p[:, labels, np.arange(4)])
        return -(own * (windows != langid.PAD)).sum() / (windows != langid.PAD).sum()

    found = network._gradients(windows, labels)
    for values, gradient in zip(network._parameters(), found):
        for at in [tuple(rng.integers(0, min(s, 5)) for s in values.shape) for _ in range(6)]:
            kept, step = values[at], 1e-2
            values[at] = kept + step
            up = loss()
            values[at] = kept - step
            down = loss()
            values[at] = kept
            assert abs((up - down) / (2 * step) - gradient[at]) < 2e-3


def test_batches_do_not_change_predictions():
    network = langid.Network(["a", "b"], langid.Fit(hidden=4, window=16))
    texts = [b"", b"x", b"some words" * 50, b"y" * 32, b"z" * 33]
    whole = network.pooled(texts)
    assert np.allclose(whole, network.pooled(texts, batch=3), atol=1e-5)
    assert np.allclose(whole, np.vstack([network.pooled([t]) for t in texts]), atol=1e-5)
    assert whole[0].sum() == 0 and np.allclose(whole[1:].sum(1), 1, atol=1e-4)


def test_languages(spark, docs, odd_rows):
    rows = [(100 + i, speech(language, i), language) for i, language in enumerate(list(SPEECH) * 70)]
    rows += [(i, t, None) for i, t, *_ in odd_rows if i not in (3, 7)] + [(50, "12 34 !", "xx"), (51, "éa", None)]
    got = {r["doc_id"]: r for r in langid.identify(docs(rows), FAST).collect()}
    assert set(got) == {r[0] for r in rows}
    fresh = [r for r in rows if (r[0] or 0) >= 100 and held(r[0], 4, 2)]
    assert len(fresh) > 30 and np.mean([got[i]["lang_pred"] == language for i, _, language in fresh]) >= 0.95
    for i, row in got.items():
        assert 0 <= row["score"] <= 1 and (i is None or row["held_out"] == held(i, 4, 2))
    assert all(got[i]["lang_pred"] == "und" for i in (1, 2, 8, 50)) and got[51]["lang_pred"] in SPEECH
    assert langid.identify(docs([]), FAST).count() == 0
    assert [r["lang_pred"] for r in langid.identify(docs([(1, "text")]), FAST).collect()] == ["und"]


def test_predictions_against_plain_recurrences(spark, docs):
    """Every score equals that of the recurrences written out, position by position."""
    rows = [(i, speech(language, i, 12), language) for i, language in enumerate(list(SPEECH) * 20)]
    rows += [(90, "é", None), (91, "ab" * 70, None), (92, speech("yy", 5) * 3, None)]
    fit = langid.Fit(per_language=20, hidden=3, window=16, batch=12, steps=20)
    network = langid.trained(docs(rows), fit)
    logistic = lambda x: 1 / (1 + np.exp(-x))

    def states(layer, codes):
        h, found = np.zeros(3), []
        for code in codes:
            drive, back = layer.inputs[code].astype(float), layer.states.astype(float) @ h
            reset, update = logistic(drive[:3] + back[:3]), logistic(drive[3:6] + back[3:6])
            h = update * h + (1 - update) * np.tanh(drive[6:] + reset * back[6:])
            found.append(h)
        return found

    def scores(text):
        data, total = text.encode(), np.zeros(3)
        for start in range(0, len(data), 32):
            codes = list(data[start : start + 32])
            for a, b in zip(states(network.ahead, codes), states(network.behind, codes[::-1])[::-1]):
                odds = np.exp(network.head.T.astype(float) @ np.concatenate([a, b]) + network.bias)
                total += odds / odds.sum()
        return total / len(data)

    text_of = {r[0]: r[1] for r in rows}
    for row in langid.identify(docs(rows), fit).collect():
        want = scores(text_of[row["doc_id"]])
        assert row["score"] == pytest.approx(want.max(), abs=1e-4)
        assert want[network.languages.index(row["lang_pred"])] == pytest.approx(want.max(), abs=1e-4)


def test_very_long_text_and_many_languages(spark, docs):
    rows = [(i, speech(list(SPEECH)[i % 3], i, 8), f"l{i % 60:03}") for i in range(240)]
    rows += [(1000, "yy " + speech("yy", 1) * 1500, None)]
    assert len(rows[-1][1]) > 200_000
    got = {r["doc_id"]: r for r in langid.identify(docs(rows), langid.Fit(hidden=2, window=8, batch=8, steps=3)).collect()}
    assert len(got) == len(rows) and got[1000]["lang_pred"].startswith("l") and 0 < got[1000]["score"] <= 1


def test_language_never_sees_held_out_labels(spark, docs):
    """Other labels on held-out documents change nothing."""
    rows = [(i, speech(language, i), language) for i, language in enumerate(list(SPEECH) * 30)]
    changed = [(i, t, "qq" if held(i, 4, 2) else language) for i, t, language in rows]
    key = lambda rs: sorted(tuple(r) for r in langid.identify(docs(rs), FAST).collect())
    assert key(rows) == key(changed)


# --- quality ------------------------------------------------------------------------------
def labelled(n=240):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = " ".join(words(i, 80)) if good else " ".join(w.upper() + "!!" for w in words(i, 80))
        rows.append((i, text, "en", "web"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality(spark, docs, frame, odd_rows):
    rows, labels = labelled()
    odd = [(1000 + n, *r[1:]) for n, r in enumerate(odd_rows)]
    marks = frame(labels + [(1000, None, 0), (77777, 1, 0), (None, 0, 0)], LABELS, clash=False)
    got = {r["doc_id"]: r for r in ranking.score(docs(rows + odd + [(None, "x", "en", "a")]), marks).collect()}
    assert len(got) == len(rows) + len(odd) + 1
    fresh = [(i, q) for i, q, _ in labels if held(i, 3, 1)]
    assert len(fresh) > 50 and np.mean([got[i]["predicted"] == q for i, q in fresh]) >= 0.95
    for i, row in got.items():
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
        assert i is None or row["held_out"] == held(i, 3, 1)
    flipped = frame([(i, 1 - q if held(i, 3, 1) else q, 0) for i, q, _ in labels], LABELS, clash=False)
    again = {r["doc_id"]: r["score"] for r in ranking.score(docs(rows), flipped).collect()}
    plain = {r["doc_id"]: r["score"] for r in ranking.score(docs(rows), frame(labels, LABELS, clash=False)).collect()}
    assert again == plain


def test_quality_without_labels(spark, docs, frame):
    none = frame([], LABELS, clash=False)
    assert [(r["score"], r["predicted"]) for r in ranking.score(docs([(1, "a")]), none).collect()] == [(0.5, 1)]
    assert ranking.score(docs([]), none).count() == 0


def test_ranker_orders_by_the_feature_that_matters():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0, 1, (200, ranking.FEATURES)), rng.normal(0, 1, (200, ranking.FEATURES))
    good[:, 3] += 3
    ranker = ranking.Ranker(good, bad, ranking.Fit())
    assert (ranker.scores(good)[:, None] > ranker.scores(bad)[None, :]).mean() > 0.95


# --- toxicity -----------------------------------------------------------------------------
@pytest.mark.parametrize("piece", [crf.PIECE, 1, 2, 3])
def test_marginals_against_enumeration(monkeypatch, piece):
    monkeypatch.setattr(crf, "PIECE", piece)
    rng = np.random.default_rng(3)
    lengths = np.array([3, 0, 1, 5, 8, 2])
    evidence, trans = rng.normal(0, 2, lengths.sum()), rng.normal(0, 1, (2, 2))
    chain = crf.Chain(lengths)
    left, right = chain.marginals(evidence, trans)
    found, pairs, start = crf.sigmoid(left + right), np.zeros((2, 2)), 0
    for n in lengths:
        weights = {}
        for code in range(2**n):
            tags = [code >> k & 1 for k in range(n)]
            score = sum(evidence[start + k] * tags[k] for k in range(n))
            weights[tuple(tags)] = np.exp(score + sum(trans[a, b] for a, b in zip(tags, tags[1:])))
        total = sum(weights.values())
        for k in range(n):
            assert found[start + k] == pytest.approx(sum(w for t, w in weights.items() if t[k]) / total)
            if k:
                for t, w in weights.items():
                    pairs[t[k - 1], t[k]] += w / total
        start += n
    assert np.allclose(chain.pair_marginals(evidence, left, right, trans), pairs)


def test_long_texts_in_pieces(monkeypatch):
    """Pieces side by side give what one pass gives, also with strong evidence and no text at all."""
    rng = np.random.default_rng(4)
    lengths = np.array([1000, 3, 0, 64, 65])
    evidence, trans = rng.normal(0, 30, lengths.sum()), rng.normal(0, 3, (2, 2))
    whole = crf.Chain(lengths).marginals(evidence, trans)
    monkeypatch.setattr(crf, "PIECE", 64)
    for one, other in zip(whole, crf.Chain(lengths).marginals(evidence, trans)):
        assert np.allclose(one, other, atol=1e-9)
    none = crf.Chain(np.zeros(0, np.int64))
    assert none.pair_marginals(np.zeros(0), np.zeros(0), np.zeros(0), trans).tolist() == [[0, 0], [0, 0]]


def toxic_rows(n=300):
    rows, labels = [], []
    for i in range(n):
        text, mark = words(i, 60), int(i % 3 == 0)
        if mark:
            for k in range(3):
                text[10 + 15 * k] = f"zorgh{random.Random(i * 7 + k).choice(['', 'el', 'um', 'at'])}"
        rows.append((i, " ".join(text), "en", "web"))
        labels.append((i, 1, mark))
    return rows, labels


def test_toxicity(spark, docs, frame, odd_rows):
    rows, labels = toxic_rows()
    extra = [(1000 + n, *r[1:]) for n, r in enumerate(odd_rows) if r[0] != 3]
    extra += [(2000, "Éa zorghel, bb.\nzorgh zorghel end"), (2001, "é " * 3000 + "zorghum")]
    extra += [(2002, "é " * 150_000 + "zorghum" + " é" * 20_000)]
    got = {r["doc_id"]: r for r in crf.score(docs(rows + extra), frame(labels, LABELS)).collect()}
    assert set(got) == {r[0] for r in rows + extra}
    fresh = [(i, t) for i, _, t in labels if held(i, 5, 0)]
    assert len(fresh) > 40 and np.mean([got[i]["predicted"] == t for i, t in fresh]) >= 0.95
    for i, row in got.items():
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
        assert row["held_out"] == held(i, 5, 0)
    assert got[2000]["spans"] == "3:11,16:29"  # code points; neighbours make one span
    assert got[2001]["spans"] == "6000:6007"  # far into a long text
    assert got[2002]["spans"] == "300000:300007"
    assert got[1001]["spans"] == "" and got[1001]["predicted"] == 0


def test_toxicity_without_labels(spark, docs, frame):
    none = frame([], LABELS, clash=False)
    assert [tuple(r) for r in crf.score(docs([(1, "a")]), none).collect()] == [(1, held(1, 5, 0), 0.0, 0, "")]
    assert crf.score(docs([]), none).count() == 0


def test_forgetting_words_changes_nothing(monkeypatch):
    rows, labels = toxic_rows(90)
    texts = [r[1].encode() for r in rows]
    model = crf.train(texts, np.array([t for _, _, t in labels]), crf.Fit(steps=10))
    want = crf.Tagger(model).tag(texts)
    monkeypatch.setattr(crf, "CACHED_WORDS", 10)
    tagger = crf.Tagger(model)
    for text, marginals in zip(texts, want):
        assert np.allclose(tagger.tag([text])[0], marginals)
