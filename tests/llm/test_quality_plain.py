"""The classifier against follow-the-regularised-leader written out coordinate by coordinate."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from songweave.llm import quality  # noqa: E402


def plain_ftrl(rows, labels, s):
    z, n = {}, {}

    def weight(j):
        v = z.get(j, 0.0)
        if abs(v) <= s.l1:
            return 0.0
        slope = (s.beta + math.sqrt(n.get(j, 0.0))) / s.alpha + s.l2
        return -(v - math.copysign(s.l1, v)) / slope

    for _ in range(s.epochs):
        for row, label in zip(rows, labels):
            w = {j: weight(j) for j in row}
            p = 1 / (1 + math.exp(-sum(w[j] * x for j, x in row.items())))
            for j, x in row.items():
                g = (p - label) * x
                before = n.get(j, 0.0)
                rate = (math.sqrt(before + g * g) - math.sqrt(before)) / s.alpha
                z[j] = z.get(j, 0.0) + g - rate * w[j]
                n[j] = before + g * g
    return weight


def test_training_and_scores_equal_the_plain_algorithm():
    rng = random.Random(3)
    good = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=rng.randrange(3, 30))) for _ in range(40)]
    bad = [" ".join(rng.choices(["zeta", "beta", "buy", "now!!"], k=rng.randrange(3, 30))) for _ in range(40)]
    texts = [t for pair in zip(good, bad) for t in pair] + ["", "one"]
    labels = np.array([1.0, 0.0] * 40 + [1.0, 0.0])
    settings = quality.Settings(bits=12, alpha=2.0)
    raw = [t.encode() for t in texts]
    bias, rows = 1 << settings.bits, []
    for text in raw:
        index, owners = quality.text_features([text], settings.bits)
        row = {bias: 1.0}
        for j in index.tolist():
            row[j] = row.get(j, 0.0) + 1 / len(index)
        rows.append(row)
    weight = plain_ftrl(rows, labels, settings)
    model = quality.train_shard(raw, labels, settings)
    for j in range(1 << settings.bits):
        assert model.weights[j] == pytest.approx(weight(j), abs=1e-9)
    assert model.bias == pytest.approx(weight(bias), abs=1e-9)
    scores = quality.scores(quality.Model(model.weights, model.bias), raw)
    for row, score in zip(rows, scores):
        dot = sum(weight(j) * x for j, x in row.items())
        assert score == pytest.approx(1 / (1 + math.exp(-dot)), abs=1e-6)
