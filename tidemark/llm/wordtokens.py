"""Whole-text tokenization through a bounded memo of words.

A tokenizer that drops white space and never joins across it gives a text's ids as the concatenation of its
words' ids. Frequent words are then encoded once per Python worker instead of once per occurrence.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np

from .common import released

#: Stands for the end of a document among words; no word contains white space.
END = b"\n"


class _Numbered(dict):
    """Numbers new keys in order of appearance and remembers them."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


@lru_cache(maxsize=2)
def word_tokens(path: str, end_id: int) -> WordTokens:
    """The encoder of this Python worker, which keeps its memo from task to task."""
    return WordTokens(path, end_id)


class WordTokens:
    """Encodes texts with a ``tokenizers`` file whose pre-tokenizer drops white space and splits letters from the rest.

    The file's normalizer must lower-case. ``limit`` bounds the memo: when more distinct words are held, it starts
    anew. The ids do not depend on it: they are those of the library for the whole text.
    """

    def __init__(self, path: str, end_id: int, limit: int = 500_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: For words that the normalizer leaves alone and the pre-tokenizer leaves whole.
        self.plain = Tokenizer(self.tokenizer.model)  # the same vocabulary, held once
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: Ids that only a word's last token has.
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        del vocabulary
        released()  # what reading the file took
        self.end_id, self.limit = end_id, limit
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbered()
        self.pool = np.zeros(1 << 16, np.uint32)
        self.begin, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.closes, self.rough = np.zeros(1 << 14, bool), np.zeros(1 << 14, bool)
        self.used = 0
        self.numbers[END]
        self._put(np.array([0]), np.array([self.end_id], np.uint32), np.array([1]))
        for word in (b".", b","):  # 1 and 2
            self.numbers[word]
        self._store([b".", b","])
        self.numbers.fresh.clear()

    def _ends_plain(self, word: str) -> bool:
        """Does the word end in a letter or digit once it is normalised? Some letters then end in a combining mark."""
        if word[-1].isascii():
            return word[-1].isalnum()
        word = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return bool(word) and unicodedata.category(word[-1])[0] in "LN"

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _plain_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words in a row, and their number for each word."""
        ids = np.array(self.plain.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
        counts = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        if len(counts) == len(words) and counts.sum() == len(ids):
            return ids, counts
        e = self.plain.encode(words, is_pretokenized=True, add_special_tokens=False)  # which says to what word a token belongs
        return np.array(e.ids, np.uint32), np.bincount(np.array(e.word_ids, np.int64), minlength=len(words))

    def _put(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Ids of the words with these numbers, in a row."""
        self.pool = _grown(self.pool, self.used + len(ids))
        self.pool[self.used : self.used + len(ids)] = ids
        self.begin[numbers] = self.used + np.cumsum(counts) - counts
        self.count[numbers] = counts
        self.used += len(ids)

    def _store(self, words: list[bytes]) -> None:
        """Encodes the words that were numbered last."""
        last = len(self.numbers)
        first = last - len(words)
        self.begin, self.count, self.closes, self.rough = (_grown(x, last) for x in (self.begin, self.count, self.closes, self.rough))
        self.closes[first:last] = self.rough[first:last] = False
        texts = b"\n".join(words).decode("utf-8", "replace").split("\n")
        easy, hard = [], []
        for i, (w, t) in enumerate(zip(words, texts, strict=True)):
            # ASCII letters are lower case by now.
            if w.isalpha() or t.isalpha() and max(t) < "\u0250" and t == t.lower() and unicodedata.is_normalized("NFC", t):
                easy.append(i)
            else:
                hard.append(i)
                self.closes[first + i] = w.rstrip(b"\"')]").endswith((b".", b"!", b"?", b"\xe3\x80\x82"))
                self.rough[first + i] = not self._ends_plain(t)
        if easy:
            self._put(first + np.array(easy), *self._plain_ids([texts[i] for i in easy]))
        if hard:
            many = [e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in hard], add_special_tokens=False)]
            self._put(first + np.array(hard), np.array([x for ids in many for x in ids], np.uint32), np.array([len(ids) for ids in many], np.int64))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row with the end id after each; ids per text; positions after which a sentence ends.

        A full stop or comma before white space is looked up apart from its word. That is exact after a letter or
        digit; texts where it follows anything else, or that may hold special tokens, go through the library whole.
        """
        if len(self.numbers) > self.limit:
            self._clear()
        words: list[bytes] = []
        stops, whole = [], []
        for i, text in enumerate(texts):
            if b"<|" in text:
                whole.append(i)
            else:
                words += text.lower().replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n").replace(b",\n", b" ,\n").split()
            words.append(END)
            stops.append(len(words))
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.numbers.fresh:
            fresh, self.numbers.fresh = self.numbers.fresh, []
            self._store(fresh)
        stop = np.array(stops, np.int64)
        mark = (numbers[1:] == 1) | (numbers[1:] == 2)
        odd = np.flatnonzero(mark & self.rough[numbers[:-1]])
        whole = sorted({*whole, *np.searchsorted(stop, odd, "right").tolist()})
        counts = self.count[numbers]
        after = np.cumsum(counts)
        ids = self.pool[np.repeat(self.begin[numbers] - after + counts, counts) + np.arange(int(after[-1]) if len(after) else 0)]
        ends = after[stop - 1] if len(stop) else after
        sentences = after[self.closes[numbers]]
        if not whole:
            return ids, np.diff(ends, prepend=0), sentences
        begins, parts, lengths, closing, at = np.concatenate(([0], ends[:-1])), [], [], [], 0
        for i, (a, b) in enumerate(zip(begins, ends, strict=True)):
            part = np.append(self._ids(texts[i].decode("utf-8", "replace")), np.uint32(self.end_id)) if i in whole else ids[a:b]
            if i not in whole:
                closing.append(sentences[(sentences > a) & (sentences <= b)] - a + at)
            parts.append(part)
            lengths.append(len(part))
            at += len(part)
        return np.concatenate(parts).astype(np.uint32), np.array(lengths, np.int64), np.concatenate([*closing, np.zeros(0, np.int64)])
