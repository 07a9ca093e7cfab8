"""Every stretch of a text gives signatures, not only what follows the listed common words."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import spotsigs
from tidemark.llm.queries import op8_spot_fingerprints

RARE = [f"item{k}" for k in range(60)]
TEXTS = ["the " + " ".join(RARE), " ".join(RARE), " ".join([*RARE[:30], "und", *RARE[30:]]), "the dog and the cat are in the house", "", "the", "lone", " ".join([*RARE[:9], "the", *RARE[9:18], "of"])]


def plain_anchors(text, reach=8):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [i for i, w in enumerate(words) if w in spotsigs.ANCHORS or not any(v in spotsigs.ANCHORS for v in words[max(0, i - reach) : i])], words


def test_signatures_throughout(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in docs.select("doc_id", spotsigs.signature_set(F.col("text")).alias("s")).collect()}
    rows = []
    for i, text in enumerate(TEXTS):
        anchors, words = plain_anchors(text)
        rows += [(i, words[k], [w for w in words[k + 1 : k + 9] if w not in spotsigs.ANCHORS][:2]) for k in anchors]
    plain = spark.createDataFrame(rows, "doc_id long, w string, chain array<string>")
    want = {r.doc_id: sorted(r.s) for r in plain.groupBy("doc_id").agg(F.collect_set(F.xxhash64("w", "chain").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s")).collect()}
    assert got == {i: want.get(i, []) for i in range(len(TEXTS))}


def test_edit_leaves_shared_signatures(spark):
    # One listed word only, and a third from a text that is full of them.
    docs = spark.createDataFrame([(1, "the house and the dog are in the garden with the man that was there for a day " * 10), (2, "the " + " ".join(RARE))], "doc_id long, text string")
    row = spotsigs.edited_fingerprints(docs).where("doc_id = 2").first()
    assert row.n_signatures > 40 and row.near_edited > 0.4


def plain_sets(texts):
    out = []
    for text in texts:
        anchors, words = plain_anchors(text or "")
        out.append({(words[k], *[w for w in words[k + 1 : k + 9] if w not in spotsigs.ANCHORS][:2]) for k in anchors})
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_texts():
    r = random.Random(4)
    pool = [*RARE, *spotsigs.ANCHORS[:25]]
    texts = [None, "", "...", "the", "lone"]
    for _ in range(25):
        words = r.choices(pool, k=r.randrange(5, 300))
        texts.append(" ".join(words))
        for _ in range(r.randrange(3)):
            other = list(words)
            for _ in range(r.randrange(1, 4)):
                other[r.randrange(len(other))] = r.choice(pool)
            texts.append(" ".join(other))
    return [*texts, texts[5], texts[6]]


def test_near_pairs_against_all_pairs(spark):
    texts = edited_texts()
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[7])], "doc_id long, text string")
    sets = spotsigs.near_sets(docs)
    got = {(r.a, r.b): r.likeness for r in spotsigs.near_pairs(sets).collect()}
    plain, first = plain_sets(texts), {}
    for i, s in enumerate(plain):
        first.setdefault(frozenset(s), i)
    ids = sorted(first.values())
    want = {(a, b): jaccard(plain[a], plain[b]) for a in ids for b in ids if a < b and plain[a] and plain[b] and jaccard(plain[a], plain[b]) >= 0.8}
    assert len(want) > 8 and got == pytest.approx(want)


def test_query_against_plain_sets(spark, tmp_path):
    texts = edited_texts()
    rows = [(3 * i, t, "clash") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op8_spot_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        text, following = text or "", texts[i - 1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, changed, after = plain_sets([text, edited, following])
        row = got[3 * i]
        assert (row.n_chars, row.edited_sha256, row.n_signatures) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), len(own))
        assert abs(row.near_edited - jaccard(own, changed)) < 1e-9 and abs(row.near_next - jaccard(own, after)) < 1e-9
        assert len(row.fingerprint) == 8 * len(own) and (row.fingerprint == got[3 * (len(texts) - 2)].fingerprint) == (own == plain_sets([texts[5]])[0])


@pytest.mark.parametrize("stretch", [1, 3, 256])
@pytest.mark.parametrize("ids", ["mixed", "null", "one"])
def test_ring_with_hot_ids(spark, stretch, ids):
    """Null and equal ids with one text and with many follow each other as in one plain sort."""
    texts = [None] * 9 + ["same text of the hot group"] * 7 + [f"text {i} of its own, and the rest {i * i}" for i in range(24)] + [""]
    own = {"mixed": lambda i: None if i % 3 == 0 else 5 if i < 20 else i, "null": lambda i: None, "one": lambda i: 5}[ids]
    docs = spark.createDataFrame([(own(i), t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = [(r.doc_id, r.t, r.h) for r in docs.selectExpr("doc_id", "coalesce(text, '') t", "xxhash64(coalesce(text, '')) h").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]), reverse=True)
    want = sorted((str(a[0]), a[1], b[1]) for a, b in zip(rows, [*rows[1:], rows[0]], strict=True))
    led = spotsigs.with_next(docs, spotsigs.SpotSpec(stretch=stretch)).collect()
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in led for _ in range(r.copies)) == want
    found = spotsigs.edited_fingerprints(docs, spotsigs.SpotSpec(stretch=stretch)).collect()
    digest = lambda t, n: hashlib.sha256((t[: len(t) - len(t) // 3] + n[: len(t) // 3]).encode()).hexdigest()
    assert sorted((str(r.doc_id), r.edited_sha256) for r in found) == sorted((i, digest(t, n)) for i, t, n in want)
