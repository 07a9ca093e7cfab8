"""Pure parts of the operators against brute-force versions."""

from __future__ import annotations

import fnmatch
import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import langid, packing, quality, simhash, tokenbin, urlfilter


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 3) | st.integers(0, 50_000), max_size=300), st.integers(1, 90))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(ids, block):
    words, firsts = tokenbin.encode(np.array(ids, np.uint64), block)
    assert tokenbin.decode(words).tolist() == ids
    assert len(firsts) == -(-len(ids) // block)
    for k, a in enumerate(firsts):  # blocks decode alone
        b = firsts[k + 1] if k + 1 < len(firsts) else len(words)
        assert tokenbin.decode(words[a:b]).tolist() == ids[k * block : (k + 1) * block]


@given(st.lists(st.text("ab/.", max_size=8), max_size=12), st.lists(st.text("ab/.*?", max_size=6), min_size=1, max_size=20))
@settings(max_examples=150, deadline=None)
def test_globs_match_like_fnmatch(texts, globs):
    automaton = urlfilter.GlobAutomaton([urlfilter._glob_pattern(g) for g in globs])
    found = automaton.matches([f".{t}" for t in texts])
    assert found.tolist() == [[fnmatch.fnmatchcase(t, g) for g in globs] for t in texts]


@given(st.lists(st.integers(1, 9), min_size=1, max_size=14), st.integers(9, 20), st.randoms())
@settings(max_examples=200, deadline=None)
def test_best_cuts_cost_least(gaps, window, random):
    places = np.cumsum([0, *gaps])
    costs = np.array([0, *(random.choice([0, 4, 16]) for _ in gaps[:-1]), 0])

    def cost(cuts):
        return sum(window - (b - a) + costs[np.searchsorted(places, b)] for a, b in itertools.pairwise(cuts[:-1]))

    best = min(cost([0, *c, places[-1]]) for k in range(len(gaps)) for c in itertools.combinations(places[1:-1].tolist(), k) if all(b - a <= window for a, b in itertools.pairwise([0, *c, places[-1]])))
    got = packing.best_cuts(places, costs, window)
    assert got[0] == 0 and got[-1] == places[-1] and (np.diff(got) <= window).all()
    assert cost(got.tolist()) == best


@given(st.sets(st.integers(0, 63), max_size=3), st.integers(0, 2**64 - 1))
@settings(max_examples=300, deadline=None)
def test_covering_masks_hide_every_difference(bits, x):
    y = x ^ sum(1 << b for b in bits)
    assert any(x & m == y & m for m in simhash.covering_masks(list(range(64)), 3))


@given(st.integers(1, 4), st.integers(1, 7), st.randoms())
@settings(max_examples=100, deadline=None)
def test_viterbi_finds_the_best_path(languages, words, random):
    scores = np.array([[random.uniform(-9, 0) for _ in range(languages)] for _ in range(words)])
    value = lambda path: sum(scores[i, s] for i, s in enumerate(path)) - 2.5 * sum(a != b for a, b in itertools.pairwise(path))
    got = langid._viterbi(scores, np.array([0]), np.array([words]), 2.5)
    assert abs(value(got) - max(map(value, itertools.product(range(languages), repeat=words)))) < 1e-9


@given(st.text("ab #|\n", max_size=60) | st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_text_statistics(text):
    words = [w for w in text.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = text.split("\n")
    repeated = sum(bool(line.strip(" \t\x0b\x0c\r")) and line in lines[:i] for i, line in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text)
    assert quality.text_statistics(text.encode("utf-8", "surrogatepass")) == (len(words), sum(map(len, words)), symbols, repeated, len(covered))
