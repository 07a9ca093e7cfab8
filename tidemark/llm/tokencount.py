"""Token counts through a digest cache.

A text's content digest (sha256 of the normalised text, null as the empty text) and the tokenizer's digest (sha256 of
its file and the library's version) name a count. Content is normalised only by what the tokenizer itself does first,
so that counts stay exact: for a sentencepiece file that drops extra white space, blanks at both ends go and runs of
blanks become one (its file says so; both are tried on a probe); every other file gets texts as they are. Texts are joined to the stored counts by digest; of what is missing, each
distinct content is encoded once, whole, and its count appended to the cache, a Parquet table partitioned by tokenizer.
A run that is repeated or cut off leaves at most equal rows twice, which reading merges. Hot contents are merged
before the shuffle, and the final join is one that Spark can split on skew.

Null texts count as empty. Rows, repeated ids and nulls in doc_id stay as they are; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shipped, slices, stored, trimmed

CACHE = "content binary, n_tokens long"


@dataclass(frozen=True)
class CountSpec:
    tokenizer: str
    limit: int = 4096
    batch_bytes: int = 1_000_000


def tokenizer_digest(path: str) -> str:
    """Changes with the file and with the library that reads it."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    return hashlib.sha256(Path(path).read_bytes() + f"{library.__name__} {library.__version__}".encode()).hexdigest()


def _counter(path: str):
    """A function from texts to the numbers of their tokens, without special tokens, truncation or padding."""
    if path.endswith(".json"):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in processor.encode(texts, add_bos=False, add_eos=False, num_threads=1)]


@lru_cache(maxsize=4)
def drops_blanks(path: str) -> bool:
    """Does the tokenizer count a text the same with blanks at its ends and runs of blanks merged? Told by probes."""
    if path.endswith(".json"):
        return False
    import sentencepiece

    normalizer = sentencepiece.SentencePieceNormalizer(model_file=path)
    probes = ["a  b", "  a", "a  ", " a   b  c ", "   ", "", "a \t b", "x    y."]
    return all(normalizer.normalize(p) == normalizer.normalize(re.sub(" +", " ", p).strip(" ")) for p in probes)


def normalised(text: Column, spec: CountSpec) -> Column:
    """What is digested and encoded in place of the text."""
    return F.trim(F.regexp_replace(text, " +", " ")) if drops_blanks(spec.tokenizer) else text


def _known(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(CACHE).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def counted(docs: DataFrame, cache: str, spec: CountSpec) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; ``cache`` is a folder that the cluster shares."""
    spark = docs.sparkSession
    folder = f"{cache}/tokenizer={tokenizer_digest(spec.tokenizer)[:32]}"
    shipped(spark)
    text = F.coalesce(docs["text"], F.lit(""))
    plain = normalised(text, spec)
    rows = docs.select(docs["doc_id"], F.unhex(F.sha2(plain, 256)).alias("content"), F.octet_length(text).cast("long").alias("n_bytes"))
    texts = docs.select(F.unhex(F.sha2(plain, 256)).alias("content"), plain.alias("text"))
    known = _known(spark, folder)
    if known is not None:
        texts = texts.join(known, "content", "left_anti")
    misses = texts.dropDuplicates(["content"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(spec.tokenizer)
        for batch in batches:
            strings = batch.column("text").to_pylist()
            for a, b in slices([len(t) for t in strings], spec.batch_bytes):
                yield pa.RecordBatch.from_arrays([batch.column("content").slice(a, b - a), pa.array(count(strings[a:b]), pa.int64())], names=["content", "n_tokens"])

    misses.mapInArrow(trimmed(encode), CACHE).write.mode("append").parquet(folder)
    counts = stored(spark.read.schema(CACHE).parquet(folder).groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    return rows.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > spec.limit).alias("over_limit"))
