"""Token-id files in Simple-8b, a word-aligned code.

Each 64-bit word holds a selector in its top four bits and as many ids as fit in the other sixty:

    selector   0            1             2  3  4  5  6  7  8  9  10 11 12 13 14 15
    ids        escape low   escape high   60 30 20 15 12 10 8  7  6  5  4  3  2  1
    bits       60           rest          1  2  3  4  5  6  7  8  10 12 15 20 30 60

An id of more than sixty bits takes two words: its low sixty bits, then its high four. Ids are coded in blocks of
``block`` ids, each a whole number of words, and the offset of every block's first word is kept, so that blocks decode
alone and all words of a selector decode in one vector operation.

A file set is a Parquet dataset whose part files follow ascending doc_id (null first; equal ids by the text's hash).
A row is a chunk of whole documents: shard, chunk, ids_before (in the shard), n_ids, doc_ids, lengths, block_words,
words. Spark's committer writes it, so lost tasks leave nothing behind, and any store that Spark can write to will do.
Null texts are empty; every document has at least its end id; empty tables give an empty file set.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shipped, slices, text_bytes, trimmed
from .wordtokens import word_tokens

# Fixed values of the code: ids in a word and bits of an id, by selector.
COUNTS = np.array([0, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([60, 4, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
LOW60 = np.uint64((1 << 60) - 1)
#: Bit lengths of ids below 65,536.
SHORT = np.array([n.bit_length() for n in range(1 << 16)], np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit length of each id."""
    if len(ids) and ids.max() < len(SHORT):
        return SHORT[ids]
    out, rest = np.zeros(len(ids), np.uint8), ids.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1 << step)
        out += np.uint8(step) * big
        rest = np.where(big, rest >> np.uint64(step), rest)
    return out + (rest > 0)


def encode(ids: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids, and the index of each block's first word."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bits = _bits(ids)
    room = np.minimum(block - np.arange(n) % block, n - np.arange(n))
    best = np.ones(n, np.uint8)  # ids in the word that starts here; 0: escape
    most = bits.copy()
    for c in range(2, 61):
        most = np.maximum(most[:-1], bits[c - 1 :])
        at = np.flatnonzero(COUNTS == c)
        if c > len(most) + c - 1 or not len(most):
            break
        if len(at):
            fits = (most <= WIDTHS[at[0]]) & (room[: len(most)] >= c)
            if not fits.any():
                break
            best[: len(most)][fits] = c
    step = best.astype(np.int64)
    starts, firsts = [], np.arange(0, n, block)
    place, stop = firsts.copy(), np.minimum(firsts + block, n)
    lanes = np.arange(len(firsts))
    while len(place):
        starts.append((lanes, place))
        place = place + step[place]
        on = place < stop
        place, stop, lanes = place[on], stop[on], lanes[on]
    begin = np.sort(np.concatenate([p for _, p in starts]))
    size = step[begin]
    large = bits[begin] > 60
    slot = np.cumsum(1 + large) - 1  # of a word, or of an escape's second
    words = np.zeros(int(slot[-1]) + 1, np.uint64)
    for selector in range(2, 16):
        own = np.flatnonzero((size == COUNTS[selector]) & ~large)
        if len(own):
            parts = ids[begin[own][:, None] + np.arange(COUNTS[selector])] << (np.arange(COUNTS[selector]) * WIDTHS[selector]).astype(np.uint64)
            words[slot[own]] = np.bitwise_or.reduce(parts, axis=1) | np.uint64(selector << 60)
    words[slot[large] - 1] = ids[begin[large]] & LOW60
    words[slot[large]] = (ids[begin[large]] >> np.uint64(60)) | np.uint64(1 << 60)
    at_first = np.searchsorted(begin, firsts)
    return words, slot[at_first] - large[at_first]


def decode(words: np.ndarray) -> np.ndarray:
    """Ids of whole blocks."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    after = np.cumsum(counts)
    out = np.zeros(int(after[-1]) if len(after) else 0, np.uint64)
    for selector in range(2, 16):
        own = np.flatnonzero(selectors == selector)
        if len(own):
            lanes = np.arange(COUNTS[selector])
            mask = np.uint64((1 << int(WIDTHS[selector])) - 1)
            out[(after[own] - COUNTS[selector])[:, None] + lanes] = (words[own][:, None] >> (lanes * WIDTHS[selector]).astype(np.uint64)) & mask
    high = np.flatnonzero(selectors == 1)
    out[after[high] - 1] = (words[high - 1] & LOW60) | ((words[high] & np.uint64(15)) << np.uint64(60))
    return out


@dataclass(frozen=True)
class TokenFileSpec:
    tokenizer: str
    end_id: int = 1
    block: int = 1024
    chunk_ids: int = 65_536
    text_bytes: int = 1_000_000


CHUNKS = "shard int, chunk int, ids_before long, n_ids long, doc_ids array<long>, lengths array<long>, block_words array<int>, words binary"


def write_token_files(docs: DataFrame, path: str, spec: TokenFileSpec) -> None:
    """Encodes every text and writes the file set; documents are dealt to shards by ranges of (doc_id, text hash)."""
    shipped(docs.sparkSession)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard, number, before = word_tokens(spec.tokenizer, spec.end_id), TaskContext.get().partitionId(), 0, 0
        schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("ids_before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("block_words", pa.list_(pa.int32())), ("words", pa.binary())])
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal number, before
            ids = np.concatenate([x[1] for x in held])
            words, firsts = encode(ids, spec.block)
            row = [shard, number, before, len(ids), [i for x in held for i in x[0]], np.concatenate([x[2] for x in held]), firsts.astype(np.int32), words.astype("<u8").tobytes()]
            number, before = number + 1, before + len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), text_bytes(batch)
            for a, b in slices([len(t) for t in texts], spec.text_bytes // 4):
                ids, lengths, _ = tokens.encode(texts[a:b])
                held.append((doc_ids[a:b], ids, lengths))
                if sum(len(x[1]) for x in held) >= spec.chunk_ids:
                    yield close()
        if held:
            yield close()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(trimmed(chunks), CHUNKS).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, decoded from the files."""
    shipped(spark)
    files = spark.read.schema(CHUNKS).parquet(path)
    # One row per shard, as many as the writer had partitions.
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = batch.slice(row, 1)
                lengths = chunk.column("lengths")[0].values.to_numpy(zero_copy_only=False)
                ids = decode(np.frombuffer(chunk.column("words")[0].as_buffer(), "<u8")).astype("<u4")
                ends = np.cumsum(lengths)
                view = memoryview(ids).cast("B")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), chunk.column("shard")[0].as_py(), np.int32)),
                        chunk.column("doc_ids")[0].values,
                        pa.array(chunk.column("ids_before")[0].as_py() + ends - lengths),
                        pa.array(lengths),
                        pa.array([zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)], pa.int64()),
                    ],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    decoded = files.select("shard", "ids_before", "doc_ids", "lengths", "words").mapInArrow(trimmed(documents), "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return decoded.join(F.broadcast(base), "shard").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and its ids as an array, for consumers that want the tokens themselves."""
    shipped(spark)
    files = spark.read.schema(CHUNKS).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = batch.slice(row, 1)
                lengths = chunk.column("lengths")[0].values.to_numpy(zero_copy_only=False)
                ids = decode(np.frombuffer(chunk.column("words")[0].as_buffer(), "<u8")).astype(np.int64)
                offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([chunk.column("doc_ids")[0].values, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=["doc_id", "ids"])

    return files.select("doc_ids", "lengths", "words").mapInArrow(trimmed(documents), "doc_id long, ids array<long>")
