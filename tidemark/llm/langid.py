"""Language identification with span labels for mixed text.

A word is a run of letters. Its script (by code point ranges) narrows the candidates to the languages whose training
text uses that script; only those are scored, by the sum of the log-probabilities of the word's letter trigrams, word
edges included, hashed into ``2 ** bits`` features. Viterbi over the words of a text, with a penalty for every change
of language, labels spans. The document's language is the one with most letters; its share is that of all letters of
the text, and its score the share times the language's posterior over the words labelled with it.

Texts whose best single language cannot be beaten by any change are labelled at once: if no run of words gains more
than half the penalty in another language, no path with changes can win. All others go through Viterbi, many texts
side by side. Both ways give the path of least cost over the whole text.

The model is counted on the whole texts of all labelled rows; its size depends on the languages alone. Nothing but the
text enters a prediction. Any number of languages will do; each takes ``4 * 2 ** bits`` bytes of the model, and slices of texts become smaller in proportion.

Nulls and texts without letters give ``und`` with score 0. If no language is known, every text is ``und``. Words in a
script that no language uses count for no language, but among the letters that shares are of; a text of such words
alone gets the most frequent language with share and score 0. Rows with null doc_id count as id '' for the holdout. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_text_crc, released, shipped, slices, stored, trimmed

# The scripts' code point ranges (Unicode blocks), everything else is 'other'.
SCRIPT_RANGES = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
SCRIPTS = ["other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES)]


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter; its script's number."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    scripts = np.zeros(0x110000, np.uint8)
    for name, a, b in SCRIPT_RANGES:
        scripts[a : b + 1] = SCRIPTS.index(name)
    return letters, scripts


@dataclass(frozen=True)
class LangIdSpec:
    bits: int = 16
    switch_penalty: float = 12.0
    #: A script is a language's own if at least this share of its training letters is in it.
    script_share: float = 0.02
    batch_chars: int = 250_000


#: What a language that is no candidate scores for a word: less than any word does.
OUT = np.float32(-1e6)


class Letters:
    """The words of some texts as flat arrays over their code points."""

    def __init__(self, texts: list[str], bits: int) -> None:
        is_letter, script = _tables()
        lowered = [t.lower() for t in texts]
        codes = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum([len(t) + 1 for t in lowered]) if lowered else np.zeros(0, np.int64)
        letter = is_letter[codes]
        at = np.flatnonzero(letter)
        fold = np.where(letter, codes, 0).astype(np.uint32)
        before = np.concatenate((np.zeros(1, np.uint32), fold[:-1]))[at] if len(fold) else fold[at]
        after = np.concatenate((fold[1:], np.zeros(1, np.uint32)))[at] if len(fold) else fold[at]
        mixed = (before * np.uint32(0x9E3779B1)) ^ (fold[at] * np.uint32(0x85EBCA77)) ^ (after * np.uint32(0xC2B2AE3D))
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x27D4EB2F)
        self.features = (mixed >> np.uint32(32 - bits)).astype(np.int64)
        self.scripts = script[codes[at]]
        #: First letter of each word, and the text that the word is in.
        self.begins = np.flatnonzero(before == 0)
        self.lengths = np.diff(self.begins, append=len(at))
        self.owners = np.searchsorted(ends, at[self.begins], "right")


@dataclass(frozen=True)
class LangModel:
    languages: tuple[str, ...]
    log_probs: np.ndarray  # (features, languages)
    uses_script: np.ndarray  # (scripts, languages)
    prior: int
    spec: LangIdSpec


def _counts(rows: DataFrame, languages: list[str], spec: LangIdSpec) -> DataFrame:
    """lang, feature, n over the rows' whole texts; features beyond ``2 ** bits`` are scripts."""
    number = {lang: i for i, lang in enumerate(languages)}
    width = (1 << spec.bits) + len(SCRIPTS)

    def batch_of(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys // width), pa.array(keys % width), pa.array(n)], names=["lang", "feature", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices([len(t) for t in texts], spec.batch_chars):
                letters = Letters(texts[a:b], spec.bits)
                own = np.repeat(np.array([number[x] for x in langs[a:b]], np.int64)[letters.owners], letters.lengths) * width
                found, times = np.unique(np.concatenate((own + letters.features, own + (1 << spec.bits) + letters.scripts)), return_counts=True)
                keys, place = np.unique(np.concatenate((keys, found)), return_inverse=True)
                n = np.bincount(place, np.concatenate((n, times)), len(keys)).astype(np.int64)
                if len(keys) > HELD:
                    yield batch_of(keys, n)
                    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield batch_of(keys, n)

    return rows.select("lang", "text").mapInArrow(trimmed(run), "lang long, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


#: Counts that a task holds before it sends them on.
HELD = 1_000_000


def train(labelled: DataFrame, spec: LangIdSpec = LangIdSpec()) -> LangModel:
    """Counts the model over rows (doc_id, text, lang); rows without text or lang are passed over."""
    shipped(labelled.sparkSession)
    labelled = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    found = labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language of the model
    sizes = {r["lang"]: r["n"] for r in sorted(found, key=lambda r: r["lang"])}
    languages, features, smooth = list(sizes), 1 << spec.bits, 0.05
    log_probs = np.full((features, len(languages)), -math.log(features), np.float32)
    uses_script = np.zeros((len(SCRIPTS), len(languages)), bool)
    counts = _counts(labelled, languages, spec).orderBy("lang").toLocalIterator() if languages else ()  # features times languages at most
    for lang, own in groupby(counts, key=lambda r: r["lang"]):
        table = np.zeros(features + len(SCRIPTS))
        for r in own:
            table[r["feature"]] = r["n"]
        trigrams, scripts = table[:features], table[features:]
        log_probs[:, lang] = np.log(trigrams + smooth) - math.log(trigrams.sum() + smooth * features)
        uses_script[:, lang] = scripts >= spec.script_share * max(1, scripts.sum())
    return LangModel(tuple(languages), log_probs, uses_script, int(np.argmax(list(sizes.values()))) if sizes else -1, spec)


#: Words of a stretch, and the number of languages up to which long texts are cut into stretches.
STRETCH, FEW = 128, 16


def _stretches(lengths: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in its text, first word and length of each stretch of at most ``size`` words, the longest first."""
    counts = -(-lengths // size)
    text = np.repeat(np.arange(len(lengths)), counts)
    place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    held = np.minimum(size, lengths[text] - place * size)
    order = np.argsort(-held, kind="stable")
    return text[order], place[order], (begins[text] + place * size)[order], held[order]


def _entered(scores: np.ndarray, begins: np.ndarray, lengths: np.ndarray, text: np.ndarray, place: np.ndarray, penalty: float) -> np.ndarray:
    """The best value of each language just before each stretch.

    Every stretch is run once from each language, all side by side; then the stretches of a text follow each other.
    """
    count = scores.shape[1]
    run = np.where(np.eye(count, dtype=bool), 0.0, -np.inf)[None].repeat(len(begins), axis=0)
    for k in range(int(lengths[0])):
        live = int(np.searchsorted(-lengths, -k, "left"))
        run[:live] = np.maximum(run[:live], run[:live].max(axis=2, keepdims=True) - penalty) + scores[begins[:live] + k][:, None, :]
    best = np.zeros((len(begins), count))
    at = np.zeros((int(text.max()) + 1, count))
    for p in range(int(place.max()) + 1):
        own = np.flatnonzero(place == p)
        best[own] = at[text[own]]
        at[text[own]] = (best[own][:, :, None] + run[own]).max(axis=1)
    return best


def _traced(came: np.ndarray, begins: np.ndarray, lengths: np.ndarray, now: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Follows ``came`` from the labels ``now`` of the stretches' last words to those of the words before the stretches."""
    now = now.copy()
    for k in range(int(lengths[0]) - 1, -1, -1):
        live = int(np.searchsorted(-lengths, -k, "left"))  # stretches with more than k words
        at = begins[:live] + k
        if labels is not None:
            labels[at] = now[:live, 0]
        now[:live] = np.take_along_axis(came[at], now[:live], axis=1)
    return now


def _viterbi(scores: np.ndarray, begins: np.ndarray, lengths: np.ndarray, penalty: float, size: int = STRETCH) -> np.ndarray:
    """Labels of the words of several texts, each ``lengths[i]`` rows of ``scores`` from ``begins[i]``; side by side.

    Long texts are cut into stretches that are walked side by side too; the path is still the best of the whole text.
    """
    labels, count = np.zeros(len(scores), np.int64), scores.shape[1]
    begins, lengths = begins[lengths > 0], lengths[lengths > 0]
    if not len(lengths):
        return labels
    text, place, begins, lengths = _stretches(lengths, begins, size if count <= FEW else int(lengths.max()))
    several = bool(place.any())
    best = _entered(scores, begins, lengths, text, place, penalty) if several else np.zeros((len(begins), count))
    came = np.zeros((len(scores), count), np.int16)
    for k in range(int(lengths[0])):
        live = int(np.searchsorted(-lengths, -k, "left"))
        top = best[:live].argmax(axis=1)
        change = best[np.arange(live), top] - penalty
        stay = best[:live] >= change[:, None]
        at = begins[:live] + k
        came[at] = np.where(stay, np.arange(count), top[:, None])
        best[:live] = np.where(stay, best[:live], change[:, None]) + scores[at]
    last = best.argmax(axis=1)  # right for each text's last stretch
    if several:
        back = _traced(came, begins, lengths, np.arange(count)[None].repeat(len(begins), axis=0))
        follows = np.full(int(text.max()) + 1, -1)
        for p in range(int(place.max()), -1, -1):
            own = np.flatnonzero(place == p)
            known = follows[text[own]]
            last[own] = np.where(known >= 0, known, last[own])
            follows[text[own]] = back[own, last[own]]
    _traced(came, begins, lengths, last[:, None], labels)
    return labels


@dataclass
class Spans:
    """Word labels of some texts: -1 where a word's script has no language."""

    labels: np.ndarray
    owners: np.ndarray
    lengths: np.ndarray
    best: np.ndarray
    share: np.ndarray
    posterior: np.ndarray
    has_letters: np.ndarray


def word_scores(model: LangModel, letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Per word and language its score, OUT for those that are no candidates; and does the word have candidates?"""
    script = letters.scripts[letters.begins] if len(letters.begins) else np.zeros(0, np.uint8)
    present = np.unique(script)
    if model.languages and len(present) == 1 and model.uses_script[present[0]].all():
        return np.add.reduceat(model.log_probs[letters.features], letters.begins, axis=0), np.ones(len(script), bool)
    scores, scored = np.full((len(script), len(model.languages)), OUT, np.float32), np.zeros(len(script), bool)
    for number in present:
        candidates = np.flatnonzero(model.uses_script[number])
        if len(candidates):
            own = np.flatnonzero(script == number)
            scored[own] = True
            sizes = letters.lengths[own]
            features = letters.features[np.repeat(letters.begins[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
            if len(candidates) == len(model.languages):  # whole rows, which is faster
                scores[own] = np.add.reduceat(model.log_probs[features], np.cumsum(sizes) - sizes, axis=0)
            else:
                scores[np.ix_(own, candidates)] = np.add.reduceat(model.log_probs[features[:, None], candidates], np.cumsum(sizes) - sizes, axis=0)
    return scores, scored


def label_words(model: LangModel, texts: list[str]) -> Spans:
    letters, count = Letters(texts, model.spec.bits), len(model.languages)
    n = len(texts)
    scores, scored = word_scores(model, letters)
    scores[~scored] = 0
    words = np.bincount(letters.owners, minlength=n)
    begins = np.cumsum(words) - words
    total = np.zeros((n, count))
    for k in range(count):
        total[:, k] = np.bincount(letters.owners, scores[:, k], minlength=n)
    single = total.argmax(axis=1) if count else np.zeros(n, np.int64)
    labels = single[letters.owners]
    # The largest gain of any run of words in another language, by text.
    gain = np.zeros(n)
    if len(labels) and count:
        own = scores[np.arange(len(labels)), labels]
        first = np.zeros(len(labels), bool)
        first[begins[words > 0]] = True
        for k in range(count):
            climb = np.cumsum((scores[:, k] - own).astype(np.float64))
            base = climb - (scores[:, k] - own)
            # Texts are kept apart by a large step down between them.
            drop = 1e7 * letters.owners
            low = np.minimum.accumulate(base - drop)
            np.maximum.at(gain, letters.owners, climb - drop - low)
    mixed = np.flatnonzero(gain > model.spec.switch_penalty / 2)
    if len(mixed):
        pick = np.isin(letters.owners, mixed)
        sizes = words[mixed]
        labels[pick] = _viterbi(scores[pick], np.cumsum(sizes) - sizes, sizes, model.spec.switch_penalty)
    labels = np.where(scored, labels, -1)
    by_language = np.zeros((n, max(1, count)))
    np.add.at(by_language, (letters.owners[scored], labels[scored]), letters.lengths[scored])
    best = by_language.argmax(axis=1)
    known = by_language.sum(axis=1)
    share = by_language.max(axis=1) / np.maximum(1, np.bincount(letters.owners, letters.lengths, minlength=n))
    # Posterior from the average word that is labelled with the language, as neighbouring trigrams are far from independent.
    posterior = np.ones(n)
    if count:
        own = labels == best[letters.owners]
        summed = np.stack([np.bincount(letters.owners[own], scores[own, k], minlength=n) for k in range(count)], axis=1)
        sized = summed / np.sqrt(np.maximum(1, np.bincount(letters.owners[own], minlength=n)))[:, None]
        odds = np.exp(sized - sized.max(axis=1, keepdims=True))
        posterior = odds[np.arange(n), best] / odds.sum(axis=1)
    best = np.where(known > 0, best, model.prior)
    return Spans(labels, letters.owners, letters.lengths, best, share, np.where(known > 0, posterior, 0.0), words > 0)


def _room(model: LangModel) -> int:
    """Characters of a slice: fewer for many languages, as each word has a score for each of them."""
    return max(4096, model.spec.batch_chars * FEW // max(FEW, len(model.languages)))


FOUND = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("share", pa.float64())])


def identified(model: LangModel, texts: list[str | None]) -> list[dict]:
    """lang, score, share (of the letters in that language) for each text."""
    rows = [t or "" for t in texts]
    out = []
    for a, b in slices([len(t) for t in rows], _room(model)):
        spans = label_words(model, rows[a:b])
        for has, best, share, posterior in zip(spans.has_letters, spans.best, spans.share, spans.posterior, strict=True):
            known = has and best >= 0
            out.append({"lang": model.languages[best], "score": float(min(1.0, share * posterior)), "share": float(share)} if known else {"lang": "und", "score": 0.0, "share": 0.0})
    return out


def language_of(model: LangModel, docs: DataFrame, text: str = "text") -> Column:
    """A struct column (lang, score, share) for the texts of ``docs``."""
    shipped(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 * 2 ** bits bytes for each language

    @F.arrow_udf("lang string, score double, share double")
    def udf(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(identified(shared.value, batch.to_pylist()), FOUND)
        released()

    return udf(docs[text])


def spans_of(model: LangModel, docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each text: array of (lang, words, letters) in order."""
    shipped(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices([len(t) for t in texts], _room(shared.value)):
                found = label_words(shared.value, texts[a:b])
                out: list[list[dict]] = [[] for _ in range(b - a)]
                for owner, label, letters in zip(found.owners, found.labels, found.lengths, strict=True):
                    lang = shared.value.languages[label] if label >= 0 else "und"
                    if out[owner] and out[owner][-1]["lang"] == lang:
                        out[owner][-1]["words"] += 1
                        out[owner][-1]["letters"] += int(letters)
                    else:
                        out[owner].append({"lang": lang, "words": 1, "letters": int(letters)})
                kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64()), ("letters", pa.int64())]))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(out, kind)], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), f"doc_id {kind}, spans array<struct<lang:string,words:bigint,letters:bigint>>")


def _least(labelled: DataFrame, found: Column, most: float) -> float:
    lowest = labelled.where("lang is not null and text is not null").where(found["lang"] == F.col("lang")).agg(F.min(found["score"])).first()[0]
    return min(most, (lowest or 0.0) / 2)


def least_score(model: LangModel, labelled: DataFrame, most: float = 0.25) -> float:
    """Half of the lowest score of all labelled rows whose language is found, ``most`` at most: what is below is unlike all of them.

    0 without labelled rows.
    """
    own = labelled.select("lang", "text")
    scored = own.select("lang", "text", language_of(model, own).alias("_found"))
    return _least(scored, scored["_found"], most)


def _known(found: Column, min_share: float, min_score: float) -> Column:
    return (found["lang"] != "und") & (found["share"] >= min_share) & (found["score"] >= min_score)


def with_known_language(model: LangModel, docs: DataFrame, min_share: float, min_score: float = 0.0, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text has a language that holds at least ``min_share`` of all letters and scores ``min_score``."""
    return docs.where(_known(language_of(model, docs, text), min_share, min_score))


def like_labelled(model: LangModel, docs: DataFrame, labelled: Column, min_share: float) -> DataFrame:
    """``with_known_language`` from the ``least_score`` of those rows of ``docs`` that are ``labelled``; each text is scored once."""
    name = free_name(docs, "_found")
    scored = stored(docs.withColumn(name, language_of(model, docs)), "languages")
    found = scored[name]
    return scored.where(_known(found, min_share, _least(scored.where(labelled), found, 0.25))).drop(name)


def held_out(doc_id: Column) -> Column:
    return F.pmod(id_text_crc(doc_id), F.lit(3)) == 1
