"""Packing token streams into fixed windows by order-preserving dynamic programming.

Within each input partition the documents' ids form one stream, in row order. Windows of at most ``window`` ids cut
it at document ends, sentence ends or, where those are far apart, inside a sentence. With ``f(j)`` the least cost of a
stream cut at position ``p(j)``, ``f(j) = min over p(j) - p(i) <= window of f(i) + window - (p(j) - p(i)) + cut(j)``:
padding plus a penalty for cutting a document (small) or a sentence (larger). As padding is linear in ``p(i)``, a
monotone queue of ``f(i) + p(i)`` gives each minimum in constant time. Memory is bounded by ``block`` ids and the
longest document; the last, open window of a block becomes the start of the next block. The ids of a partition
depend on its rows alone, so a task that runs again gives the same sequences. No shuffle is needed.

Null texts are empty; every document has at least its end id. doc_id may be null or repeat. Empty tables give no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import shipped, slices, text_bytes, trimmed
from .wordtokens import word_tokens


@dataclass(frozen=True)
class PackSpec:
    tokenizer: str
    end_id: int = 1
    window: int = 2048
    document_cut: int = 4
    sentence_cut: int = 16
    #: Where document and sentence ends are further apart than this, cuts inside are offered as often.
    stride: int = 32
    block: int = 400_000
    text_bytes: int = 1_000_000


def cut_costs(total: int, documents: np.ndarray, sentences: np.ndarray, spec: PackSpec) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a stream of ``total`` ids may be cut, with their penalties; 0 and ``total`` are among them."""
    soft = np.unique(np.concatenate(([0, total], documents, sentences)))
    gaps = np.diff(soft)
    wide = np.flatnonzero(gaps > spec.stride)
    more = (gaps[wide] - 1) // spec.stride
    inside = np.repeat(soft[wide], more) + spec.stride * (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1)
    places = np.concatenate((soft, inside))
    costs = np.concatenate((np.full(len(soft), spec.document_cut), np.full(len(inside), spec.sentence_cut)))
    order = np.argsort(places, kind="stable")
    places, costs = places[order], costs[order]
    costs[np.isin(places, documents)] = 0
    costs[0] = costs[-1] = 0
    return places, costs


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int) -> np.ndarray:
    """Cut positions of least total cost, both ends included; the last window's padding is free, as it stays open."""
    spots, fees = places.tolist(), costs.tolist()
    last = len(spots) - 1
    back = [0] * (last + 1)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # f + p, position, index; f + p rises from left to right
    for j in range(1, last + 1):
        here = spots[j]
        while here - queue[0][1] > window:
            queue.popleft()
        key, _, i = queue[0]
        back[j] = i
        key += window + fees[j]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, j))
    # For the open last window f alone counts: f(i) = key(i) - p(i), over the starts that can reach the end.
    best = min(((k - p, -p, i) for k, p, i in queue if i != last and spots[last] - p <= window), default=(0, 0, back[last]))
    back[last] = best[2]
    cuts = [last]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return places[cuts[::-1]]


class _Packer:
    def __init__(self, spec: PackSpec, first_sequence: int) -> None:
        self.spec, self.next = spec, first_sequence
        self.tokens = word_tokens(spec.tokenizer, spec.end_id)
        self._restart(np.zeros(0, np.uint32), [], [], [], np.zeros(0, np.int64))

    def _restart(self, ids: np.ndarray, docs: list, begins: list[int], totals: list[int], sentences: np.ndarray) -> None:
        self.ids, self.docs, self.begins, self.totals, self.sentences = [ids], docs, begins, totals, [sentences]
        self.held = len(ids)

    def add(self, docs: list, texts: list[bytes]) -> None:
        ids, lengths, sentences = self.tokens.encode(texts)
        self.docs += docs
        self.begins += (self.held + np.cumsum(lengths) - lengths).tolist()
        self.totals += lengths.tolist()
        self.sentences.append(sentences + self.held)
        self.ids.append(ids)
        self.held += len(ids)

    def take(self, end: bool) -> Iterator[pa.RecordBatch]:
        """Pieces of the closed windows; at the end those of the open one as well."""
        if not self.held:
            return
        ids, begins, totals = np.concatenate(self.ids), np.array(self.begins, np.int64), np.array(self.totals, np.int64)
        sentences = np.concatenate(self.sentences)
        cuts = best_cuts(*cut_costs(len(ids), begins[begins > 0], sentences, self.spec), self.spec.window)
        until = len(ids) if end else int(cuts[-2])
        edges = np.union1d(cuts[cuts <= until], begins[(begins > 0) & (begins < until)])
        if until:
            starts, lengths = edges[:-1], np.diff(edges)
            windows = np.searchsorted(cuts, starts, "right") - 1
            owners = np.searchsorted(begins, starts, "right") - 1
            view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([self.docs[i] for i in owners], pa.int64()),
                    pa.array(starts - begins[owners]),
                    pa.array(lengths),
                    pa.array([zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)], pa.int64()),
                    pa.array(totals[owners]),
                    pa.array(self.next + windows),
                    pa.array(starts - cuts[windows]),
                ],
                names=PIECES,
            )
            self.next += int(windows[-1]) + 1
        first = np.searchsorted(begins, until, "right") - 1 if until < len(ids) else len(begins)
        self._restart(ids[until:].copy(), self.docs[first:], (begins[first:] - until).tolist(), totals[first:].tolist(), sentences[sentences > until] - until)


PIECES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECE_SCHEMA = ", ".join(f"{c} long" for c in PIECES)


def packed(docs: DataFrame, spec: PackSpec) -> DataFrame:
    """One row per piece of a document in a sequence: see PIECES. sequence_id is the partition, shifted, plus a count."""
    shipped(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(spec, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), text_bytes(batch)
            for a, b in slices([len(t) for t in texts], spec.text_bytes):
                packer.add(ids[a:b], texts[a:b])
                if packer.held >= spec.block:
                    yield from packer.take(False)
        yield from packer.take(True)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(trimmed(pack), PIECE_SCHEMA)
