"""Frequencies, weights, temperature and scores of language identification, against plain loops."""

import math
import random
from collections import Counter, defaultdict

import fixtures as fx
import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import language


def plain_features(text):
    body = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    out = []
    for order in (2, 3):
        for i in range(len(body) - order + 1):
            h = order
            for b in body[i : i + order]:
                h = (h ^ b) * 0x01000193 & 0xFFFFFFFF
            out.append((h ^ (h >> 15)) & 0xFFFF)
    return out


def plain_softmax(x):
    e = [math.exp(v - max(x)) for v in x]
    return [v / sum(e) for v in e]


def check_scores(docs, rows, model):
    texts = {}
    for d, t in docs:
        texts.setdefault(d, t)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        found = Counter(plain_features(text))
        n = max(1, sum(found.values()))
        p = plain_softmax([sum(c * float(model.weights[f, k]) for f, c in found.items()) / n for k in range(len(model.names))])
        if not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == model.names[p.index(max(p))] and r["score"] == pytest.approx(max(p), rel=1e-6), r["doc_id"]


def trained(docs):
    return language.train(docs.filter(~language.held_out(F.col("doc_id"))).select("text", "lang"))


def test_scores_of_the_whole_table(spark):
    docs = fx.table(spark, "documents")
    check_scores(fx.pairs(docs), language.identify(docs).collect(), trained(docs))


def test_scores_of_odd_documents(spark):
    docs = fx.documents(spark, [(300, "a", "en", "a"), (301, "ab", "de", "a"), (302, "é" * 40_000, "fr", "a")]).filter("doc_id <> 4")
    check_scores(fx.pairs(docs), language.identify(docs).collect(), trained(docs))


def test_document_frequencies(spark):
    docs = fx.documents(spark)
    wanted = Counter(f for _, t in fx.pairs(docs) for f in set(plain_features(t or "")))
    found, rows = language.document_frequencies(docs)
    assert rows == docs.count() and {f: n for f, n in enumerate(found.tolist()) if n} == dict(wanted)


def test_leader_follows_the_regularised_sum(monkeypatch):
    """Each coordinate on its own, in the usual form: the penalised minimum of the linearised losses so far."""
    monkeypatch.setattr(language, "FEATURES", 30)
    r = random.Random(4)
    rows = []
    for _ in range(60):
        index = sorted(r.sample(range(30), r.randint(1, 6)))
        rows.append((np.array(index), np.array([r.random() for _ in index]), r.randrange(3)))
    z, n = defaultdict(float), defaultdict(float)

    def weight(i, k):
        if abs(z[i, k]) <= language.L1:
            return 0.0
        return -(z[i, k] - math.copysign(language.L1, z[i, k])) / ((language.BETA + math.sqrt(n[i, k])) / language.ALPHA + language.L2)

    for epoch in range(language.EPOCHS):
        for at in np.random.default_rng(epoch).permutation(len(rows)):
            index, value, label = rows[at]
            w = {(i, k): weight(i, k) for i in index for k in range(3)}
            p = plain_softmax([sum(v * w[i, k] for i, v in zip(index, value, strict=True)) for k in range(3)])
            for i, v in zip(index, value, strict=True):
                for k in range(3):
                    g = v * (p[k] - (k == label))
                    z[i, k] += g - (math.sqrt(n[i, k] + g * g) - math.sqrt(n[i, k])) / language.ALPHA * w[i, k]
                    n[i, k] += g * g
    found = language.fit_ftrl(rows, 3)
    assert np.allclose(found, [[weight(i, k) for k in range(3)] for i in range(30)], rtol=1e-9)


def test_temperature_has_the_least_loss():
    r = np.random.default_rng(1)
    labels = r.integers(0, 3, 400)
    logits = 6 * (np.eye(3)[np.where(r.random(400) < 0.8, labels, r.integers(0, 3, 400))])
    t = language.fit_temperature(logits, labels)

    def loss(divisor):
        return -sum(math.log(plain_softmax((row / divisor).tolist())[y]) for row, y in zip(logits, labels, strict=True))

    assert all(loss(t) <= loss(t * f) + 1e-9 for f in (0.5, 0.8, 1.25, 2)) and language.fit_temperature(logits[:0], labels[:0]) == 1.0
