"""The network against plain loops, its training's bounds, and a trained network on hard cases."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from leafmill.llm import toxicity
from leafmill.llm.tokens import Powers

RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choices("abcdefghijklmnop", k=RNG.randint(2, 8))) for _ in range(400)]
BAD = ["vile", "rotten", "wretch"]


def babble(n):
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def plain_score(net, vectors):
    """The network over one window of word vectors, one number at a time."""
    h, p = toxicity.HIDDEN, {k: v.astype(float) for k, v in net.p.items()}
    logistic = lambda v: 1 / (1 + math.exp(-v))
    states = [[0.0] * (2 * h) for _ in vectors]
    for d, order, base in (("f", range(len(vectors)), 0), ("b", range(len(vectors) - 1, -1, -1), h)):
        now = [0.0] * h
        for t in order:
            x = [sum(vectors[t][i] * p["x" + d][i, j] for i in range(len(vectors[t]))) + p["o" + d][j] for j in range(3 * h)]
            r = [sum(now[i] * p["h" + d][i, j] for i in range(h)) for j in range(3 * h)]
            update, reset = ([logistic(x[k + j] + r[k + j]) for j in range(h)] for k in (0, h))
            new = [math.tanh(x[2 * h + j] + reset[j] * r[2 * h + j]) for j in range(h)]
            now = [(1 - z) * a + z * b for z, a, b in zip(update, now, new)]
            states[t][base : base + h] = now
    e = [sum(v * math.tanh(s) for v, s in zip(p["v"], state)) for state in states]
    w = [math.exp(x - max(e)) for x in e]
    return logistic(sum(wt * sum(u * s for u, s in zip(p["u"], state)) for wt, state in zip(w, states)) / sum(w) + p["c"][0])


@pytest.fixture(scope="module")
def net():
    texts = [" ".join(w + ([RNG.choice(BAD)] if i % 3 == 0 else [])) for i in range(240) for w in [babble(RNG.randint(5, 90))]]
    return toxicity.trained(texts, [int(i % 3 == 0) for i in range(240)])


def test_scores_are_those_of_plain_loops(net):
    texts = [" ".join(babble(n)) for n in (1, 3, 48, 49, 130)] + ["", "vile " * 5, " ".join(babble(60) + ["rotten"] + babble(60))]
    e = toxicity.Encoded(pa.array(texts), Powers())
    x, _ = net.inputs(e)
    want = []
    for t in texts:
        n = len(t.split())
        starts = [] if not n else sorted({min(s, max(n - toxicity.WINDOW, 0)) for s in range(0, max(n - toxicity.WINDOW, 0) + toxicity.STRIDE, toxicity.STRIDE)})
        want += [(s, t.split()[s : s + toxicity.WINDOW]) for s in starts]
    assert [int(s) for s in e.start] == [s for s, _ in want]
    vector = {}
    for t in texts:
        for w in t.split():
            one = toxicity.Encoded(pa.array([w]), Powers())
            vector[w] = net.inputs(one)[0][0]
    assert net.scores(e) == pytest.approx([plain_score(net, [vector[w] for w in words]) for _, words in want], abs=1e-4)
    assert toxicity.sigmoid(net.forward(x, e.windows)[0]) == pytest.approx(net.scores(e), abs=1e-4)


def test_trained_network_on_hard_cases(spark, net, monkeypatch):
    monkeypatch.setattr(toxicity, "fitted", lambda *a: net)
    long = " ".join(babble(30000) + ["vile rotten wretch vile"] + babble(30000))
    rows = [(1, None), (2, ""), (3, " \n.,! "), (4, "vile"), (None, "you vile rotten wretch"), (6, " ".join(babble(300))), (7, long), (7, long), (8, "é ü 漢字 " * 50), (9, "the " * 3000)]
    docs = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id bigint, text string, score double").withColumn("a.b", toxicity.F.lit(1))
    got = toxicity.toxic_documents(docs, None).collect()
    assert {None, 7} <= {r.doc_id for r in got} and {r.doc_id for r in got}.isdisjoint({1, 2, 3})
    both = [r for r in got if r.doc_id == 7]
    e = toxicity.Encoded(pa.array([long]), Powers())
    scores = net.scores(e)
    assert len(both) == 2 and both[0] == both[1] and both[0].windows == len(scores) == math.ceil((60004 - 48) / toxicity.STRIDE) + 1
    assert both[0].first_word == e.start[np.argmax(scores)] and both[0].toxic_windows == (scores >= 0.5).sum()
    kept = toxicity.without_toxic(docs, None)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {r.doc_id for r in got}
    assert toxicity.toxic_documents(docs.limit(0), None).collect() == []


def test_training_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "trained", lambda texts, toxic: seen.append(texts))
    docs = spark.createDataFrame([(i, "w" * (10 if i else 90)) for i in range(12)] + [(3, "a"), (None, "x"), (20, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(20, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    toxicity.fitted(docs, labels, 100, 60)
    toxicity.fitted(docs, labels, 4, 1000)
    assert [len(t) for t in seen] == [6, 4] and all(len(x) <= 10 for x in seen[0]) and sum(map(len, seen[0])) <= 60


def test_training_tells_nothing_apart():
    assert toxicity.trained([], []) is None and toxicity.trained(["", "!"], [0, 1]) is None and toxicity.trained(["a b", "c d"], [1, 1]) is None
    a, b = (toxicity.trained(["one two three", "four five six", "seven"], [1, 0, 0]) for _ in range(2))
    assert all(np.array_equal(a.p[k], b.p[k]) for k in a.p)
