"""Ids through the memo of words against the library, over every code point and over random texts."""

from __future__ import annotations

import os
import random

import public_tokenizers

from tidemark.llm.wordtokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def same_ids(texts):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(PATH), WordTokens(PATH, 1)
    for a in range(0, len(texts), 4096):
        part = texts[a : a + 4096]
        want = [[*e.ids, 1] for e in library.encode_batch_fast(part, add_special_tokens=False)]
        ids, lengths, _ = own.encode([t.encode() for t in part])
        ids, at = ids.tolist(), 0
        for text, expected, n in zip(part, want, lengths.tolist(), strict=True):
            assert ids[at : at + n] == expected, text
            at += n


def test_every_code_point_before_and_after_marks():
    points = [c for plane in range(3) for c in range(plane << 16, (plane + 1) << 16) if not 0xD800 <= c < 0xE000]
    same_ids([f"a{chr(c)}, x {chr(c)}. y" for c in points])


def test_letters_that_normalise_to_marks():
    same_ids(["İ, x", "क़. y", "Aİ.\nB, c", "क़़, İ. ", "יִ, בֿ. z", "é, É. n"])


def test_random_texts():
    r = random.Random(3)
    pool = [*"aZ9 .,\n\t\"'()!?-", "İ", "क़", "́", "é", "漢", "б", "\U0001f600", "<|", "|>", "  ", ". ", ", ", "<|endoftext|>", "don't", "　", " ", " "]
    same_ids(["".join(r.choices(pool, k=r.randrange(40))) for _ in range(20_000)])


def test_rare_words_of_a_large_vocabulary_are_encoded_once(monkeypatch):
    r, own, stored = random.Random(4), WordTokens(PATH, 1), []
    keep = own._store
    monkeypatch.setattr(own, "_store", lambda words: stored.append(len(words)) or keep(words))
    words = ["".join(r.choices("abcdefghijkl", k=7)) for _ in range(240_000)]
    texts = [" ".join(words[a : a + 100]).encode() for a in range(0, len(words), 100)]
    once = [own.encode(texts[a : a + 400])[0] for a in range(0, len(texts), 400)]
    again = [own.encode(texts[a : a + 400])[0] for a in range(0, len(texts), 400)]
    assert sum(stored) <= len(set(words)) and all((x == y).all() for x, y in zip(once, again, strict=True))
    same_ids([t.decode() for t in texts[:50]])
