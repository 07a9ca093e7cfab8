"""The toxicity machine against a kernel written out pair by pair, and fitting on whole units."""

from __future__ import annotations

import itertools
import math

import numpy as np

from tidemark.llm import toxicity

SPEC = toxicity.ToxicSpec()


def plain_vector(word):
    """Every ordered triple of letters within reach, weaker by ``decay`` for each place beyond three."""
    marked = [toxicity.CLASSES - 1, *(toxicity._letter_class(c) for c in word), toxicity.CLASSES - 1]
    out: dict = {}
    for a, b, c in itertools.combinations(range(len(marked)), 3):
        if c - a <= SPEC.reach and marked[a] and marked[b] and marked[c]:
            key = marked[a], marked[b], marked[c]
            out[key] = out.get(key, 0.0) + SPEC.decay ** (c - a - 2)
    return out


def plain_kernel(x, y):
    u, v = plain_vector(x), plain_vector(y)
    size = math.sqrt(sum(a * a for a in u.values()) * sum(b * b for b in v.values()))
    return sum(a * v.get(k, 0.0) for k, a in u.items()) / size if size else 0.0


def test_machine_against_plain_kernel():
    """The folded weights give what landmarks, inverse root and separate kernel values give."""
    bad, good = ["moron", "m0ron", "idiot", "idi-ot", "loser"], ["morning", "idea", "lose", "garden", "motor", "x"]
    model = toxicity._fit(bad, good, SPEC)
    marks = [*bad, *good]
    values, vectors = np.linalg.eigh([[plain_kernel(a, b) for b in marks] for a in marks])
    inverse = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    features = lambda words: np.array([[plain_kernel(w, m) for m in marks] for w in words]) @ inverse
    signs = np.array([1.0] * len(bad) + [-1.0] * len(good))
    cost = SPEC.cost * np.where(signs > 0, len(marks) / 2 / len(bad), len(marks) / 2 / len(good))
    w, bias = toxicity._machine(features(marks), signs, cost)
    asked = [*marks, "mo-ron", "idiiot", "gardener", "", "zz"]
    assert np.allclose(model.score_words(asked), features(asked) @ w + bias, atol=1e-6)
    assert (model.score_words(bad) > 0).all() and (model.score_words(good) < 0).all()


def test_windows_cover_words():
    for n in (0, 1, 24, 25, 36, 37, 500):
        word = "".join(chr(97 + i % 26) for i in range(n))
        found = toxicity.windows(word, SPEC)
        half = SPEC.span // 2
        assert all(len(w) <= SPEC.span for w in found)
        assert found[0] + "".join(w[half:] for w in found[1:]) == word


def test_insult_at_the_end_of_a_long_unit(spark):
    """What marks toxic texts stands behind the 64th character of a word: fitting must count it there."""
    words = "alpha bravo charlie delta echo foxtrot golf hotel india juliet".split()
    docs = [(i, f"{words[i % 10]} {words[i // 10 % 10]} " + "ab" * 48 + ("dumbhead" if i % 3 == 0 else words[i % 7])) for i in range(300)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 200)], "doc_id long, toxic int")
    model = toxicity.train(table, labels)
    score = {r.doc_id: r.s for r in table.select("doc_id", toxicity.toxicity_of(model, table).alias("s")).collect()}
    assert all((score[i] >= 0.5) == (i % 3 == 0) for i in range(200, 300))
