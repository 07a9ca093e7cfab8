"""The pipeline's stages, each against a plain version on the same input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_path

from .test_near_copies import plain_groups
from .test_operators import plain_fingerprint


def test_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "mix", "pack"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small_dir)
        out.write.parquet(path := scratch_path(spark, name))
        docs = spark.read.schema(out.schema).parquet(path)
        rows = docs.collect()
        if name == "pack":
            for doc_id, copies in {k: sum(r.doc_id == k for r in mixed) for k in {r.doc_id for r in mixed}}.items():
                assert sum(p.length for p in rows if p.doc_id == doc_id) == copies * next(p.doc_tokens for p in rows if p.doc_id == doc_id)
            break
        assert docs.columns == columns and all(r == before[r.doc_id] for r in rows)
        if name == "mix":
            mixed = rows
            assert max(sum(r.doc_id == k for r in rows) for k in {r.doc_id for r in rows}) <= 2
            break_words = sum(len(r.text.split()) for r in rows) / sum(len(r.text.split()) for r in kept)
            assert 1.3 < break_words < 1.7
            continue
        kept = rows
        if name == "near_dedup":
            fps = [plain_fingerprint(r.text) for r in rows]
            assert all((a ^ b).bit_count() > 3 for i, a in enumerate(fps) for b in fps[:i])
    assert corpus_pipeline.run(spark, small_dir).count() == len(rows)


def odd_folder(spark, small_dir, path):
    """A part of the documents, with nulls, repeats, a long text and columns whose names the stages use themselves."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    names = ("_key", "_id", "_row", "size", "copies", "score", "row_key", "token", "part", "toxic", "share")
    own = docs.where("doc_id is not null and text is not null").orderBy("doc_id").limit(120)
    first = own.orderBy("doc_id").limit(1)
    text = F.col("text")
    odd = [first, first, first.withColumn("doc_id", F.lit(None).cast("long")), *(first.withColumn("text", F.lit(t).cast("string")) for t in (None, "", " \n\t")),
           first.withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string")), first.withColumn("text", F.repeat(F.concat(text, F.lit(" ")), 300))]
    for part in odd:
        own = own.unionByName(part)
    own.withColumns({n: F.lit("clash") for n in names}).coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{small_dir}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_odd_rows(spark, small_dir, tmp_path):
    folder = odd_folder(spark, small_dir, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, folder)
        out.write.parquet(path := scratch_path(spark, name))
        docs = spark.read.schema(out.schema).parquet(path)
        rows = docs.collect()
        if name == "pack":
            assert Counter(p.doc_id for p in rows if p.start == 0) == Counter(r.doc_id for r in before)
            break
        assert out.columns == spark.read.parquet(f"{folder}/documents.parquet").columns
        if name == "mix":
            assert {str(r) for r in rows} <= {str(r) for r in before}
            continue
        assert not Counter(map(str, rows)) - Counter(map(str, before))
        if name == "near_dedup":
            groups = plain_groups([r.text for r in before])
            numbers = {}
            for r, g in zip(before, groups, strict=True):
                numbers.setdefault(r.text, g)
            assert sorted(numbers[r.text] for r in rows) == sorted(set(groups))
            continue
        # Decisions are of texts: equal ones share theirs. Texts without letters end at the first stage.
        left = {r.text for r in rows}
        assert all(r.text in left for r in rows) and Counter(map(str, rows)) == Counter(str(r) for r in before if r.text in left)
        assert not left & {None, "", " \n\t"}


def test_no_rows(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small_dir}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
