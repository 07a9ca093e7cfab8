"""An inverted index as tables, and ranked boolean search over it.

Terms are dealt to hash partitions, so that a search reads those of its terms alone. A block is a run of documents of one
task, the same for all terms; a posting list is one row for each term and block, so that the list of a frequent
word is spread over rows and tasks. It is whole before the only shuffle of postings, which brings the lists of a partition
together. Next to it each block's greatest share is kept; what a term weighs is multiplied in by the search, from the
table of terms. A search first takes the blocks of
the greatest bounds, learns from their documents how good the k-th is at least, and then reads only blocks whose bound
reaches that. The result is that of a full scan.

Scores are BM25, in whole billionths for each term, so that sums don't depend on their order. Words are runs of letters
and digits, in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNIT = 1_000_000_000


@dataclass(frozen=True)
class IndexSpec:
    k1: float = 1.2
    b: float = 0.75
    partitions: int = 64
    #: Documents of a block.
    block: int = 256


@dataclass(frozen=True)
class Index:
    path: str
    spec: IndexSpec
    n_docs: int
    average: float
    key_type: str = "bigint"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _partition(term: Column, spec: IndexSpec) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(spec.partitions)).cast("int")


def _postings(kind: str) -> str:
    return f"array<struct<key: {kind}, doc: bigint, share: double>>"


def _blocks(split: DataFrame, average: float, spec: IndexSpec) -> DataFrame:
    """term, block, n (documents of the block with the term), bound (their greatest share), postings, from (key, w)."""

    def lists(block: int, first: int, keys: pa.Array, words: pa.Array) -> pa.RecordBatch:
        sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        own = np.repeat(np.arange(len(sizes)), sizes)
        found, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(sizes) + own, return_counts=True)
        term, doc = found // len(sizes), found % len(sizes)
        share = tf * (spec.k1 + 1) / (tf + spec.k1 * (1 - spec.b + spec.b * sizes[doc] / average))
        begins = np.flatnonzero(np.diff(term, prepend=-1))
        postings = pa.StructArray.from_arrays([keys.take(pa.array(doc)), pa.array(first + doc), pa.array(share)], names=["key", "doc", "share"])
        held = pa.ListArray.from_arrays(pa.array(np.append(begins, len(term)).astype(np.int32)), postings)
        most = np.maximum.reduceat(share, begins) if len(begins) else share
        columns = [coded.dictionary.take(pa.array(term[begins])), pa.array(np.full(len(begins), block)), pa.array(np.diff(begins, append=len(term))), pa.array(most), held]
        return pa.RecordBatch.from_arrays(columns, names=["term", "block", "n", "bound", "postings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33  # as Spark numbers rows
        for batch in batches:
            for a in range(0, batch.num_rows, spec.block):
                part = batch.slice(a, spec.block)
                yield lists(at, at, part.column("key"), part.column("w"))
                at += part.num_rows

    return split.select("key", "w").mapInArrow(run, f"term string, block bigint, n bigint, bound double, postings {_postings(split.schema['key'].dataType.simpleString())}")


def build_index(docs: DataFrame, key: str, text: str, path: str, spec: IndexSpec = IndexSpec()) -> Index:
    """Writes terms, postings and bounds of ``docs`` below ``path``. Rows with one key count as documents of their own."""
    spark = docs.sparkSession
    split = docs.select(F.col(key).alias("key"), words(F.col(text)).alias("w"))
    total = split.agg(F.count("*").alias("n"), F.avg(F.size("w")).alias("a")).first()
    n_docs, average = total["n"], float(total["a"] or 0.0) or 1.0
    lists = _blocks(split, average, spec).withColumn("part", _partition(F.col("term"), spec))
    # Blocks of one term go to several tasks and files, more for more documents, whose ranges of terms let a scan skip.
    dealt = F.pmod(F.xxhash64("block"), F.lit(max(8, -(-n_docs // 250_000))))
    lists.repartition("part", dealt).sortWithinPartitions("part", "term", "block").write.partitionBy("part").parquet(f"{path}/postings")
    index = Index(path, spec, n_docs, average, docs.schema[key].dataType.simpleString())
    frequent = _stored_lists(spark, index).groupBy("part", "term").agg(F.sum("n").alias("df"))
    frequent.repartition("part").sortWithinPartitions("part", "term").write.partitionBy("part").parquet(f"{path}/terms")
    return index


def _stored_lists(spark: SparkSession, index: Index) -> DataFrame:
    return spark.read.schema(f"term string, block bigint, n bigint, bound double, postings {_postings(index.key_type)}, part int").parquet(f"{index.path}/postings")


def _score(idf: Column, share: Column) -> Column:
    return F.round(idf * share * UNIT).cast("long")


def _lists(spark: SparkSession, index: Index, terms: Sequence[str]) -> DataFrame:
    """term, block, idf, bound, postings of some terms: the folders of their partitions, and of these the files that may hold them."""
    named = spark.createDataFrame([(t,) for t in terms], "term string").select("term", _partition(F.col("term"), index.spec).alias("part"))
    parts = [r["part"] for r in named.select("part").distinct().collect()]  # as many as the query has terms
    own = F.col("part").isin(parts) & F.col("term").isin(list(terms))
    idf = F.log(1 + (F.lit(index.n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = spark.read.schema("term string, df bigint, part int").parquet(f"{index.path}/terms").where(own).select("term", idf.alias("idf"))
    lists = _stored_lists(spark, index).where(own).join(F.broadcast(weights), "term")  # a row for each term of the query
    return lists.select("term", "block", "idf", _score(F.col("idf"), F.col("bound")).alias("bound"), "postings")


def _found(lists: DataFrame, must: Sequence[str], barred: Sequence[str]) -> DataFrame:
    """key, doc, score of the documents in posting lists that hold all of ``must`` and none of ``barred``."""
    rows = lists.select("term", "idf", F.explode("postings").alias("p")).select("term", "p.key", "p.doc", _score(F.col("idf"), F.col("p.share")).alias("score"))
    if barred:
        rows = rows.withColumn("score", F.when(F.col("term").isin(list(barred)), F.lit(0)).otherwise(F.col("score")))
    held = rows.groupBy("key", "doc").agg(F.sum("score").alias("score"), F.count(F.when(F.col("term").isin(list(must)), 1)).alias("held"), F.count(F.when(F.col("term").isin(list(barred)), 1)).alias("barred"), F.count(F.when(~F.col("term").isin(list(barred)), 1)).alias("wanted"))
    return held.where((F.col("held") == len(must)) & (F.col("barred") == 0) & (F.col("wanted") > 0)).select("key", "doc", "score")


def ranked(spark: SparkSession, index: Index, must: Sequence[str] = (), should: Sequence[str] = (), must_not: Sequence[str] = (), k: int = 10) -> DataFrame:
    """key, score of the best ``k`` documents that hold all of ``must`` (or, without, one of ``should``) and none of ``must_not``.

    Ties go to the smaller key. A term in several lists counts as in the first of must_not, must, should.
    """
    lower = lambda terms: list(dict.fromkeys(t.lower() for t in terms))
    barred = lower(must_not)
    needed = [t for t in lower(must) if t not in barred]
    if len(needed) < len(lower(must)) or not (needed or lower(should)) or k < 1:
        return spark.createDataFrame([], f"key {index.key_type}, score bigint")
    wanted = needed + [t for t in lower(should) if t not in needed and t not in barred]
    bounds = _lists(spark, index, wanted).groupBy("block").agg(F.sum("bound").alias("bound"), F.count_distinct(F.when(F.col("term").isin(needed), F.col("term"))).alias("held")).where(F.col("held") == len(needed))
    every = _lists(spark, index, wanted + barred)
    # The first blocks: a few of the greatest bounds. A row for each block, of which k are taken.
    first = bounds.orderBy(F.desc("bound"), "block").limit(max(8, k)).select("block")
    best = _found(every.join(F.broadcast(first), "block", "left_semi"), needed, barred).orderBy(F.desc("score"), "key").limit(k)
    row = best.agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
    open_blocks = bounds.where(F.col("bound") >= (row["least"] if row["n"] == k else 0)).select("block")
    return _found(every.join(open_blocks, "block", "left_semi"), needed, barred).orderBy(F.desc("score"), "key").limit(k).select("key", "score")
