"""Scripts narrow candidates; spans against all paths; scores and held-out agreement through the query op6_language_id."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from tidemark.llm import langid
from tidemark.llm.queries import op6_language_id

TRAIN = {"en": "the house and the dog are in the garden with that man", "de": "der Hund und die Katze sind nicht in dem Haus", "ru": "дом и собака в саду с этим человеком и кошка", "uk": "будинок і собака в саду з цією людиною та кішка"}
TEXTS = [
    "the dog in the garden", "der Hund in dem Haus", "собака в саду с кошка", "собака в саду з цією людиною", None, "", "123 !!", "Ω αβγ δεζ ηθι", "the dog and the man собака в саду с этим человеком",
    "αβγδεζηθικλμ αβγδεζηθικλμ αβγδεζηθικλμ the", "the dog and the man are in the house der Hund und die Katze sind nicht in dem Haus", "x", "the dog", "der man und the Hund",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lang"))
    rows = [(k, t, x, 1) for k, (x, t) in enumerate(list(TRAIN.items()) * 30)]
    rows += [(1000 + k, t, None, 1) for k, t in enumerate(TEXTS)] + [(1000, TEXTS[0], "en", 1), (1000, TEXTS[0], "en", 1), (None, "the dog", None, 1), (None, None, "en", 1), (5000, "the house and the dog " * 20_000 + "der Hund und die Katze " * 9_000, None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def model(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return langid.train(docs.where(~langid.held_out(docs["doc_id"])))


def words_of(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def plain_label(model, text):
    """lang, score, share by trying every path over the words with candidates."""
    words = words_of(text)
    scripts = [next((langid.SCRIPTS.index(n) for n, a, b in langid.SCRIPT_RANGES if a <= ord(w[0]) <= b), 0) for w in words]
    candidates = [np.flatnonzero(model.uses_script[s]).tolist() for s in scripts]
    if not words:
        return "und", 0.0, 0.0
    value = []
    for w, own in zip(words, candidates, strict=True):
        features = langid.Letters([w], model.spec.bits).features
        value.append({k: float(model.log_probs[features, k].astype(np.float64).sum()) for k in own})
    known = [i for i, own in enumerate(candidates) if own]
    if not known:
        return model.languages[model.prior], 0.0, 0.0
    # A word without candidates costs nothing and keeps whatever language is held; a path may pass through any.
    best = max(itertools.product(*(candidates[i] for i in known)), key=lambda path: sum(value[i][k] for i, k in zip(known, path, strict=True)) - model.spec.switch_penalty * sum(a != b for a, b in itertools.pairwise(path)))
    letters = {}
    for i, k in zip(known, best, strict=True):
        letters[k] = letters.get(k, 0) + len(words[i])
    lang = max(letters, key=lambda k: (letters[k], -k))
    share = letters[lang] / sum(map(len, words))
    own = [i for i, k in zip(known, best, strict=True) if k == lang]
    sums = {k: sum(value[i].get(k, -1e6) for i in own) / len(own) ** 0.5 for k in range(len(model.languages))}
    top = max(sums.values())
    odds = {k: np.exp(v - top) for k, v in sums.items()}
    return model.languages[lang], min(1.0, share * odds[lang] / sum(odds.values())), share


def test_query_against_all_paths(spark, folder, model):
    rows = op6_language_id(spark, folder).collect()
    assert len(rows) == 120 + len(TEXTS) + 5 and all(0 <= r.score <= 1 and 0 <= r.share <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 3 == 1) for r in rows)
    got = {r.doc_id: r for r in rows}
    for k, text in enumerate(TEXTS):
        lang, score, share = plain_label(model, text)
        row = got[1000 + k]
        assert (row.lang_pred, round(row.share, 6)) == (lang, round(share, 6)) and abs(row.score - score) < 1e-4, text
    assert [got[1000 + k].lang_pred for k in range(7)] == ["en", "de", "ru", "uk", "und", "und", "und"]
    assert got[5000].lang_pred == "en" and 0.6 < got[5000].share < 0.8
    assert sum(got[k].lang_pred == x for k, x in enumerate(list(TRAIN) * 30)) == 120  # held out or not
    assert [r.lang_pred for r in rows if r.doc_id is None].count("und") == 1


def test_only_candidates_are_scored(model):
    scores, scored = langid.word_scores(model, langid.Letters(["dog собака αβγ"], model.spec.bits))
    names = [[model.languages[k] for k in np.flatnonzero(row > langid.OUT)] for row in scores]
    assert names == [["de", "en"], ["ru", "uk"], []] and scored.tolist() == [True, True, False]


def test_stage_rejects_texts_in_other_scripts(spark, folder, model):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    least = langid.least_score(model, docs.where(~langid.held_out(docs["doc_id"])))
    kept = {r.doc_id for r in langid.with_known_language(model, docs, 0.3, least).collect()}
    assert 0 < least < 0.5 and 1009 not in kept and 1007 not in kept and {*range(120), 1000, 1001, 1002, 1003, 1010, 5000} <= kept


def test_stretches_of_long_texts_give_the_same_path() -> None:
    """Whole-number scores, so that sums are exact: the path's value is the same however a text is cut."""
    rng = np.random.default_rng(5)

    def value(scores: np.ndarray, labels: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> float:
        total = 0.0
        for b, n in zip(begins, lengths, strict=True):
            own = labels[b : b + n]
            total += scores[np.arange(b, b + n), own].sum() - 3.0 * (own[1:] != own[:-1]).sum()
        return total

    for _ in range(40):
        lengths = rng.integers(0, 50, rng.integers(1, 7))
        scores = rng.integers(-4, 5, (lengths.sum(), int(rng.integers(1, 6)))).astype(np.float32)
        begins = np.cumsum(lengths) - lengths
        whole = value(scores, langid._viterbi(scores, begins, lengths, 3.0, 1000), begins, lengths)
        for size in (1, 2, 7, 16):
            assert value(scores, langid._viterbi(scores, begins, lengths, 3.0, size), begins, lengths) == whole


def test_hundreds_of_languages(spark):
    """No number of languages is too many: each of 600 with words of its own is found again, one without letters never."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k, i: "".join(letters[int(c, 16) + i] for c in f"{zlib.crc32(f'{k} {i}'.encode()):08x}")
    rows = [(3 * k, " ".join(word(k, i) for i in range(8)), f"l{k:03}") for k in range(600)] + [(9000, "1 2 3", "digits")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(train)
    assert len(model.languages) == 601 and not model.uses_script[:, model.languages.index("digits")].any()
    asked = spark.createDataFrame([(k, " ".join(word(k, i) for i in (5, 2, 7, 0))) for k in range(0, 600, 7)], "doc_id long, text string")
    found = {r.doc_id: r.f for r in asked.select("doc_id", langid.language_of(model, asked).alias("f")).collect()}
    assert all(f.lang == f"l{k:03}" and f.score > 0.9 for k, f in found.items())


def test_counts_against_plain_ones(spark):
    """log-probabilities are those of counts in one pass, whatever slices and batches the texts come in."""
    rows = [(i, t, x) for i, (x, t) in enumerate([*TRAIN.items()] * 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    spec = langid.LangIdSpec(bits=8, batch_chars=60)
    model = langid.train(frame, spec)
    for k, lang in enumerate(model.languages):
        counts = np.bincount(langid.Letters([TRAIN[lang]], 8).features, minlength=256) * 5.0
        assert np.allclose(model.log_probs[:, k], np.log(counts + 0.05) - np.log(counts.sum() + 0.05 * 256), atol=1e-5)


def test_every_labelled_row_counts(spark):
    """Beyond 4,000 texts of a language too: trigrams of all are counted, and the least certain of all sets the least score."""
    from pyspark.sql import functions as F

    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("the house "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))).otherwise("der Hund und").alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"))
    odd = spark.createDataFrame([(9001, "the und der hound dog", "en")], "doc_id long, text string, lang string")
    docs = rows.unionByName(odd).repartition(3)
    spec = langid.LangIdSpec(bits=10)
    model = langid.train(docs, spec)
    texts = {x: [r.text for r in docs.where(F.col("lang") == x).collect()] for x in ("de", "en")}
    for k, lang in enumerate(model.languages):
        counts = np.bincount(langid.Letters(texts[lang], 10).features, minlength=1024)
        assert np.allclose(model.log_probs[:, k], np.log(counts + 0.05) - np.log(counts.sum() + 0.05 * 1024), atol=1e-5)
    found = [f["score"] for lang, own in texts.items() for f in langid.identified(model, own) if f["lang"] == lang]
    least = langid.least_score(model, docs, most=1.0)
    assert abs(least - min(found) / 2) < 1e-9
    kept = lambda d: sorted(map(str, d.collect()))
    assert kept(langid.like_labelled(model, docs.withColumn("_found", F.lit(1)), F.col("doc_id") >= 0, 0.3)) == kept(langid.with_known_language(model, docs.withColumn("_found", F.lit(1)), 0.3, langid.least_score(model, docs)))
