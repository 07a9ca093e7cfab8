"""URL filters by a bit-parallel wildcard automaton.

Rules are compiled to glob patterns over a canonical form of the url and packed into the bits of several 64-bit words,
one bit per state (Shift-And). Reading a character shifts all patterns at once: states move on where the character
fits the next position and stay where a star loops. A batch of urls is simulated together, one column of states per
url, longest first, so that each step touches only the urls that still have characters.

The canonical form is ``.host`` followed by the path. A rule ``host/path`` is the pattern ``(not '/')*`` ``.host``
``/path`` ``*``: the leading dot makes it fit the host itself and every subdomain, and the first star cannot leave the
host. Further globs (``*`` any run, ``?`` any character) match the whole canonical form without its first dot.

The longest fitting rule wins (the first of equal ones). Without a rule, a url that fits a block glob is blocked; else
the verdict is ``default``. Null urls and urls without ``://`` have empty host and path and get the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shipped

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class UrlRules:
    """rules: (verdict, host/path), the path with its slash. block_globs: glob over host and path, e.g. ``*casino*``."""

    rules: Sequence[tuple[str, str]]
    block_globs: Sequence[str] = ()
    default: str = "allow"


class GlobAutomaton:
    """Patterns are lists of (kind, character) items: kinds are 'char', 'any', 'star' and 'host' (a star without '/')."""

    def __init__(self, patterns: Sequence[Sequence[tuple[str, str]]]) -> None:
        letters = sorted({c for p in patterns for kind, c in p if kind == "char"} | {"/"})
        self.codes = np.array([ord(c) for c in letters], np.uint32)
        classes = len(letters) + 1  # class 0: every other character
        step, stay, start, accept, total = {}, {}, [], [], 0
        for p in patterns:
            # State k is reached after k character items; a star lets the state before it loop.
            state = total
            start.append(state)
            for kind, c in p:
                if kind == "star":
                    stay[state] = range(classes)
                elif kind == "host":
                    stay[state] = [k for k in range(classes) if k != letters.index("/") + 1]
                else:
                    state += 1
                    step[state] = range(classes) if kind == "any" else [letters.index(c) + 1]
            accept.append(state)
            total = state + 1
        self.words = max(1, -(-total // 64))
        self.step, self.stay = np.zeros((classes, self.words), np.uint64), np.zeros((classes, self.words), np.uint64)
        for table, source in ((self.step, step), (self.stay, stay)):
            for state, fits in source.items():
                for k in fits:
                    table[k, state // 64] |= np.uint64(1 << state % 64)
        self.first = np.zeros(self.words, np.uint64)
        for state in start:
            self.first[state // 64] |= np.uint64(1 << state % 64)
        self.accept = np.array(accept, np.int64)

    def classes_of(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at + 1, 0).astype(np.uint16)

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """(texts, patterns) booleans: the pattern fits the whole text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = self.classes_of("".join(texts))
        begin = (np.cumsum(lengths) - lengths)[order]
        ordered = lengths[order]
        state = np.tile(self.first, (len(texts), 1))
        one, carry = np.uint64(1), np.uint64(63)
        live = len(texts)
        for k in range(int(ordered[0]) if len(texts) else 0):
            while ordered[live - 1] <= k:
                live -= 1
            c = flat[begin[:live] + k]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> carry
            state[:live] = (moved & self.step[c]) | (now & self.stay[c])
        found = (state[:, self.accept // 64] >> (self.accept % 64).astype(np.uint64)) & one
        out = np.zeros(found.shape, bool)
        out[order] = found.astype(bool)
        return out


def _rule_pattern(rule: str) -> list[tuple[str, str]]:
    return [("host", ""), *(("char", c) for c in "." + rule), ("star", "")]


def _glob_pattern(glob: str) -> list[tuple[str, str]]:
    kinds = {"*": "star", "?": "any"}
    return [("char", "."), *((kinds.get(c, "char"), c) for c in glob)]


def judged_urls(pages: DataFrame, rules: UrlRules, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule (text, or null), verdict (``allow`` or ``block``) of every row."""
    shipped(pages.sparkSession)
    automaton = GlobAutomaton([*map(_rule_pattern, (r for _, r in rules.rules)), *map(_glob_pattern, rules.block_globs)])
    texts = [r for _, r in rules.rules]
    rank = sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i))
    verdicts = [v for v, _ in rules.rules]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
                found = automaton.matches([f".{h}{p}" for h, p in zip(hosts, paths, strict=True)])
                by_rule, by_glob = found[:, rank], found[:, len(texts) :].any(axis=1)
                won = np.where(by_rule.any(axis=1), np.array([*rank, -1])[by_rule.argmax(axis=1)] if rank else -1, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"), batch.column("host"), batch.column("path"),
                        pa.array([texts[i] if i >= 0 else None for i in won], pa.string()),
                        pa.array([verdicts[i] if i >= 0 else "block" if g else rules.default for i, g in zip(won, by_glob, strict=True)], pa.string()),
                    ],
                    names=["key", "host", "path", "rule", "verdict"],
                )

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(pages[key].alias("key"), url_host(pages[url]).alias("host"), url_path(pages[url]).alias("path"))
    return rows.mapInArrow(judge, f"key {kind}, host string, path string, rule string, verdict string").withColumnRenamed("key", key)
