"""The operators on small tables with nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

from __future__ import annotations

import hashlib
import zlib

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import langid, packing, quality, simhash, spotsigs, tokenbin, tokencount, toxicity, urlfilter

WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, copies int, _text_key string, _copies int"
LONG = "the quick brown fox jumps over the lazy dog. " * 3000
TEXTS = ["Hello, world. It is <|endoftext|> here", "der Hund und die Katze", None, "", " \t\n", "the the the the", LONG, "naïve café ÉTÉ Ünder ß", "Hello, world. It is <|endoftext|> here", "A.B.C... don't 3.14 (x)! 日本語 text"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 4 == 3 else "en", None if i % 5 == 4 else f"s{i % 3}", len(t or ""), 9, 9, "clash", 7) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, "no id", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def library_ids(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_packing(docs, empty):
    pieces = packing.packed(docs, packing.PackSpec(WORDS, window=64)).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for i in range(1, 10):
        own, ids = sorted(by_doc[i], key=lambda p: p.start), library_ids(TEXTS[i])
        if i == 8:
            continue
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert all(p.doc_tokens == len(ids) and p.ids_crc32 == crc(ids[p.start : p.start + p.length]) for p in own) and sum(p.length for p in own) == len(ids)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))] and sum(p.length for p in own) <= 64
    assert packing.packed(empty, packing.PackSpec(WORDS)).count() == 0


def test_token_files(spark, docs, empty, tmp_path):
    tokenbin.write_token_files(docs, f"{tmp_path}/files", tokenbin.TokenFileSpec(WORDS, chunk_ids=100, block=16))
    rows = tokenbin.read_token_files(spark, f"{tmp_path}/files").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 0, 0, 0, *range(1, 10)]
    start = 0
    for r in rows:
        if r.doc_id is not None:
            ids = library_ids(TEXTS[r.doc_id])
            assert (r.n_tokens, r.ids_crc32) == (len(ids), crc(ids))
        assert r.start == start
        start += r.n_tokens
    ids = {r.doc_id: r.ids for r in tokenbin.read_token_ids(spark, f"{tmp_path}/files").collect()}
    assert ids[7] == library_ids(TEXTS[7])
    tokenbin.write_token_files(empty, f"{tmp_path}/none", tokenbin.TokenFileSpec(WORDS))
    assert tokenbin.read_token_files(spark, f"{tmp_path}/none").count() == 0


def test_url_filter(spark):
    rules = urlfilter.UrlRules((("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")), ("*casino*",))
    cases = {
        "https://Sub.Example.ORG/es/a?x#y": ("sub.example.org", "/es/a", "example.org/es/", "block"), "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"), "http://a.com/de/fr/": ("a.com", "/de/fr/", "com/de/", "block"), "http://com/fr/x": ("com", "/fr/x", "com/fr/", "allow"),
        "http://x.net/my-casino": ("x.net", "/my-casino", None, "block"), "http://x.net?http://y.org/": ("x.net", "", None, "allow"), "x.org/es/": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
        "http://example.org": ("example.org", "", None, "allow"), "a://b.org/\nq/é": ("b.org", "/\nq/é", "org/", "allow"), "http://" + "a." * 3000 + "org/z": ("a." * 3000 + "org", "/z", "org/", "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(cases)], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.host, r["path"], r.rule, r.verdict) for r in urlfilter.judged_urls(pages, rules).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert urlfilter.judged_urls(pages.limit(0), rules).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints(docs, empty):
    got = {r.doc_id: r.fp for r in simhash.fingerprints(docs).where("doc_id is not null").collect()}
    assert {k: v % (1 << 64) for k, v in got.items()} == {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    classes = simhash.near_duplicate_classes(docs).collect()
    assert len(classes) == docs.count() and {r.component_id for r in classes if r.doc_id in (2, 3, 4)} == {2} and {r.component_id for r in classes if r.doc_id == 8} == {0}
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 5, 6, 7, 9]
    assert simhash.without_near_duplicates(empty).count() == 0


def plain_roots(fps):
    """Of each fingerprint the least one that it reaches by steps of up to three bits."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unsigned = [f % (1 << 64) for f in fps]
    for i, a in enumerate(fps):
        for j in range(i):
            if (unsigned[i] ^ unsigned[j]).bit_count() <= 3:
                x, y = find(a), find(fps[j])
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def clustered_fingerprints(seed, packed):
    """Chains, a star, and ``packed`` fingerprints that differ in few places only, so that they share crowded buckets."""
    import random

    r = random.Random(seed)
    fps = [r.getrandbits(64) for _ in range(60)]
    for base in fps[:12]:
        at = base
        for _ in range(r.randrange(12)):
            at ^= sum(1 << b for b in r.sample(range(64), r.randrange(1, 5)))
            fps.append(at)
    fps += [fps[0] ^ (1 << b) for b in range(40)]
    base, places = r.getrandbits(64), r.sample(range(64), 24)
    for _ in range(packed):
        fps.append(base ^ sum(1 << b for b in r.sample(places, r.randrange(0, 13))))
    return sorted({f - (1 << 64) if f >> 63 else f for f in fps})


@pytest.mark.parametrize(("dense", "direct_bits", "packed"), [(3, 3, 150), (8, 9, 900), (64, 9, 900), (200, 5, 900), (512, 9, 900)])
def test_simhash_components(spark, dense, direct_bits, packed):
    fps = clustered_fingerprints(5, packed)
    links = simhash.links_within(spark.createDataFrame([(f,) for f in fps], "fp long"), simhash.SimHashSpec(dense=dense, direct_bits=direct_bits))
    got = {row.node: row.root for row in simhash.components(links).collect()}
    assert {f: got.get(f, f) for f in fps} == plain_roots(fps)


def test_language_id(spark, docs, empty):
    train = [("the house and the dog are in the garden with that man", "en"), ("der Hund und die Katze sind nicht in dem Haus", "de"), ("el perro y la casa son de los hombres que viven", "es")]
    labelled = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(train * 20)] + [(999, None, "en"), (998, "x", None)], "doc_id long, text string, lang string")
    model = langid.train(labelled)
    mixed = "the dog and the man are in the house with that dog and the man der Hund und die Katze sind nicht in dem Haus und die Katze"
    rows = spark.createDataFrame([(0, train[1][0], 1), (1, None, 1), (2, "123 !!", 1), (3, mixed, 1), (4, "", 1), (5, LONG, 1), (6, "привет", 1)], "doc_id long, text string, lang int")
    got = {r.doc_id: r.f for r in rows.select("doc_id", langid.language_of(model, rows).alias("f")).collect()}
    assert [got[i].lang for i in (0, 1, 2, 4)] == ["de", "und", "und", "und"] and got[1].score == 0 and all(0 <= g.score <= 1 for g in got.values())
    spans = {r.doc_id: [s.lang for s in r.spans] for r in langid.spans_of(model, rows).collect()}
    assert spans[3] == ["en", "de"] and spans[1] == []
    assert sorted(r.doc_id for r in langid.with_known_language(model, rows, 0.3).collect()) == [0, 3, 5]
    nothing = langid.train(empty)
    assert {r.f.lang for r in docs.select(langid.language_of(nothing, docs).alias("f")).collect()} == {"und"}
    assert empty.select(langid.language_of(model, empty).alias("f")).count() == 0


def test_token_counts(spark, docs, empty, tmp_path):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    spec = tokencount.CountSpec(path, limit=5)
    rows = tokencount.counted(docs, f"{tmp_path}/cache", spec).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            text = TEXTS[r.doc_id] or ""
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), len(library.encode(text)), len(library.encode(text)) > 5)
    stored = spark.read.parquet(f"{tmp_path}/cache")
    assert stored.count() == stored.select("content").distinct().count() == 9
    again = tokencount.counted(docs.unionByName(docs.select("doc_id", F.lit("a new text").alias("text")).limit(1), allowMissingColumns=True), f"{tmp_path}/cache", spec)
    assert again.count() == len(rows) + 1 and spark.read.parquet(f"{tmp_path}/cache").count() == 10
    assert tokencount.counted(empty, f"{tmp_path}/none", spec).count() == 0


def test_spot_fingerprints(spark, docs, empty):
    plain = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in spotsigs.edited_fingerprints(plain, spotsigs.SpotSpec(stretch=3)).collect()}
    for i in range(10):
        text, following = TEXTS[i] or "", TEXTS[i - 1 if i else 9] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
    assert rows[0].fingerprint == rows[8].fingerprint and rows[2].fingerprint == rows[3].fingerprint == "" and rows[4].near_next == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows.values())
    assert spotsigs.edited_fingerprints(docs).count() == docs.count() and spotsigs.edited_fingerprints(empty).count() == 0


def test_toxicity(spark, docs, empty):
    clean = ["we walked along the river and talked about music", "a good dinner with friends in the garden", "the report was finished before the meeting", "children played football near the school"]
    rude = ["you {} go away from here", "what a {} thing to say and {} too", "only an {} would write that, {}"]
    rows, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        words = ["idiot", "moron", "scum", "trash"]
        text = f"{clean[i % 4]} number{i % 17} " + (rude[i % 3].replace("{}", words[i // 4 % 4]) if toxic else clean[i // 7 % 4])
        rows.append((i, text))
        labels.append((i, int(toxic)))
    train = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (0, 0), (None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(train, marks)
    asked = ["my friends and the id-iot and the mo.ron", "an i d i o t and a moron and scum", "friends in the garden by the river", None, "", LONG]
    table = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    score = {r.doc_id: r.s for r in table.select("doc_id", toxicity.toxicity_of(model, table).alias("s")).collect()}
    assert score[0] > 0.5 and score[1] > 0.5 and max(score[k] for k in (2, 3, 4, 5)) < 0.5
    assert {r.doc_id for r in toxicity.without_toxic(model, table).collect()} == {2, 3, 4, 5}
    constant = toxicity.train(empty, marks.limit(0))
    assert docs.select(toxicity.toxicity_of(constant, docs).alias("s")).where("s between 0 and 1").count() == docs.count()
    assert empty.select(toxicity.toxicity_of(model, empty).alias("s")).count() == 0


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (7, None)], "doc_id long, quality int")
    rows = quality.judged(docs, labels).collect()
    assert len(rows) == docs.count() and all(not (r.kept and r.base_failed) for r in rows)
    assert {r.doc_id for r in rows if r.base_failed and r.doc_id is not None} >= {1, 2, 3, 4, 5, 6}
    assert quality.judged(empty, labels).count() == 0
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    good = [(i, " ".join(words[(i * 5 + k * k) % 12] + str(k) for k in range(30)), 1) for i in range(150)]
    odd = [(1000 + i, " ".join(f"$$#{words[(i + k) % 12]}%%&&**{k}" for k in range(30)), 0) for i in range(40)]
    table = spark.createDataFrame([*good, *odd], "doc_id long, text string, quality int")
    kept = {r.doc_id: r.kept for r in quality.judged(table.drop("quality"), table.select("doc_id", "quality").where("doc_id % 2 = 0")).collect()}
    assert sum(kept[i] for i, *_ in good) >= 140 and sum(kept[i] for i, *_ in odd) <= 4
