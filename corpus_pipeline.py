"""From raw documents to packed training sequences, stage by stage.

Every stage takes what its predecessor kept, with the columns of ``documents``; the last returns pieces of sequences.
Each result is written as Parquet and read again, so that a lost executor costs at most the tasks of one stage.

language_id rejects texts without letters or language, those of which no language holds ``MIN_SHARE`` of all letters,
and those that score less than half of what the least certain labelled document scores; toxicity rejects scores from 0.5; near_dedup keeps one document of each group; mix repeats or drops documents
until the sources meet their targets; pack cuts the token streams into windows. The classifiers learn from the stage's
own documents, never from held-out rows. Null and empty texts end at the first stage. Tables without rows pass all
stages and give no pieces. Further columns of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, toxicity
from tidemark.llm.common import rested, scratch_path, shipped
from tidemark.llm.mixing import mixed
from tidemark.llm.neardup import without_near_copies
from tidemark.llm.packing import PackSpec, packed

MIN_SHARE = 0.3
MIN_TOXIC = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from rows with a lang that are not held out."""
    rested(spark)
    model = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    return langid.like_labelled(model, docs, ~langid.held_out(F.col("doc_id")), MIN_SHARE)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model learns from labels that are not held out."""
    rested(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(labels["doc_id"])))
    rested(spark)
    return toxicity.without_toxic(model, docs, MIN_TOXIC)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, exact Jaccard likeness of 0.8 or more."""
    rested(spark)
    return without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    rested(spark)
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    rested(spark)
    return packed(docs, PackSpec(public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in a folder."""
    shipped(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


#: SQL can't express the classifiers; tests/llm holds the stages against plain versions.
ORACLE_SQL = None
