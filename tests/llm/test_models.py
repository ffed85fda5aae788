"""The trained models against plain formulas: convolution by loops, gradients by differences, the ordinal likelihood."""

import math
import random

import numpy as np

from quarry.llm.language_id import FOLD, WIDTHS, WINDOW, ByteCnn
from quarry.llm.toxicity import WORD, OrdinalRegression, word_features


def plain_probabilities(model, raw):
    """One window: every filter at every place, the greatest answer, a dense layer, softmax."""
    z = []
    for w, conv, bias in zip(WIDTHS, model.conv, model.bias):
        places = range(max(1, len(raw) - w + 1)) if len(raw) < WINDOW else range(WINDOW - w + 1)
        padded = list(raw) + [0] * (WINDOW - len(raw))
        for f in range(conv.shape[2]):
            z.append(max(sum(float(conv[j, padded[p + j], f]) for j in range(w)) for p in places) + float(bias[f]))
    z = np.maximum(z, 0) @ model.dense.astype(float) + model.top
    e = np.exp(z - z.max())
    return e / e.sum()


def a_model(classes=3, seed=1):
    r = np.random.default_rng(seed)
    model = ByteCnn([f"l{k}" for k in range(classes)], seed=seed)
    model.bias = [r.normal(size=b.shape).astype(np.float32) for b in model.bias]
    model.top = r.normal(size=classes).astype(np.float32)
    return model


def test_language_probabilities_equal_a_plain_convolution():
    model, r = a_model().prepare(), random.Random(2)
    texts = [bytes(r.randrange(32, 250) for _ in range(n)) for n in (1, 2, 3, 5, 100, WINDOW - 1, WINDOW, WINDOW + 1, 2 * WINDOW, 700)]
    got = model.of_texts(texts, at_once=3)
    for text, p in zip(texts, got):
        folded = bytes(FOLD[np.frombuffer(text, np.uint8)])
        starts = [min(a, len(text) - WINDOW) for a in range(0, len(text), WINDOW)] if len(text) >= WINDOW else [0]
        want = np.mean([plain_probabilities(model, folded[a : a + WINDOW]) for a in starts], axis=0)
        assert np.allclose(p, want, atol=1e-5)


def test_language_gradients_equal_differences():
    model, r = a_model(seed=3), np.random.default_rng(4)
    for p in ("conv", "bias"):
        setattr(model, p, [x.astype(np.float64) for x in getattr(model, p)])
    model.dense, model.top = model.dense.astype(np.float64), model.top.astype(np.float64)
    lengths = np.array([WINDOW, 40, 3, 120])
    x = np.zeros((4, WINDOW), np.uint8)
    for k, n in enumerate(lengths):
        x[k, :n] = r.integers(32, 120, n)
    y = np.array([0, 1, 2, 1])
    loss = lambda: -np.mean([math.log(plain_probabilities(model, bytes(x[k, : lengths[k]]))[y[k]]) for k in range(4)])
    params = [*model.conv, *model.bias, model.dense, model.top]
    grads = model._gradients(x, lengths, y)
    for p, g in zip(params, grads):
        some = [np.unravel_index(i, p.shape) for i in np.argsort(-np.abs(g).ravel())[:3]] + [tuple(r.integers(0, n) for n in p.shape)]
        for at in some:
            old = p[at]
            p[at] = old + 1e-5
            up = loss()
            p[at] = old - 1e-5
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5


def likelihood(x, grades, w, t, l2):
    """Mean negative log of P(grade) of cumulative links, with the penalty."""
    total = 0.0
    for row, g in zip(x, grades):
        at_least = [1.0, *(1 / (1 + math.exp(-(float(row @ w) - float(v)))) for v in t), 0.0]
        total -= math.log(at_least[g] - at_least[g + 1])
    return total / len(grades) + l2 / 2 * float(w @ w)


def test_ordinal_fit_is_a_minimum_of_the_plain_likelihood():
    r = np.random.default_rng(5)
    x = np.where(r.uniform(size=(150, 4)) < 0.5, 0, r.uniform(0.5, 2, (150, 4)))
    z = x @ np.array([1.5, -1.0, 0.5, 0.0]) + r.logistic(size=150)
    grades = (z > 0.5).astype(int) + (z > 2)
    model = OrdinalRegression(list("abcd"), 3)
    rows, cols = np.nonzero(x)
    model.fit(rows, cols, x[rows, cols], grades, l2=0.01, steps=3000, rate=0.02)
    w, t = model.weights, model.thresholds
    best = likelihood(x, grades, w, t, 0.01)
    assert t[0] < t[1]
    for k in range(6):
        for step in (1e-3, -1e-3):
            v = np.concatenate([w, t])
            v[k] += step
            assert likelihood(x, grades, v[:4], v[4:], 0.01) >= best - 1e-9
    # expected severity: the sum of P(grade >= j)
    assert np.allclose(model.at_least(x @ w), [[1 / (1 + math.exp(-(float(row @ w) - float(v)))) for v in t] for row in x])


def test_toxicity_scores_equal_a_plain_sum():
    model = OrdinalRegression(["bad", "bad*", "worse*", "x"], 3)
    model.weights = np.array([0.5, 1.5, -2.0, 4.0])
    texts = ["", "Bad bad badly WORSEN x", "nothing here", "x " * 50, "worse, worst; bad-x"]
    for text, got in zip(texts, model.scorer()(texts)):
        features = [f for w in WORD.findall(text.lower()) for f in word_features(w)]
        assert math.isclose(got, sum(model.weights[i] * math.log1p(features.count(f)) for f, i in model.index.items() if f in features), abs_tol=1e-12)
