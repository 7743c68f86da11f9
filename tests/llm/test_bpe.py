"""BPE against the tokenizers library, and the cases the docstrings define."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablekeeper.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
WHOLE = Tokenizer.from_file(PATH)
WHOLE.no_truncation()
WHOLE.no_padding()


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(open(PATH, encoding="utf-8").read())


def ids_of(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


ODD = [
    "", " ", "\n\n \t x", "don't  we'LL 'tis it's", "a<|endoftext|> <|endoftext|><|endoftext|>b", "<|endoftext", "ab " * 3,
    "ÀÉ naïve été 東京都 مرحبا 😀😀 é", "x" * 5000, "ab" * 3000 + "c", "１２３ 12.5 ½ Ⅷ", "tail   ", "   　z", "\x00\x1c\x1d\x1f\x85 .",
]


def test_words_of_all_kinds(coder):
    for text in ODD:
        assert coder.encode(text).tolist() == ids_of(text), text[:40]
    pick = random.Random(5)
    letters = "abc eth'sn\n .,09éß東😀́​﻿"
    for _ in range(400):
        text = "".join(pick.choice(letters) for _ in range(pick.randrange(60)))
        assert coder.encode(text).tolist() == ids_of(text), text


def test_every_character_of_the_basic_plane(coder):
    """Which class a character has decides where words end; unassigned ones may differ by Unicode version."""
    import unicodedata

    known = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    lines = ["".join(f"a{c}1{c} {c}" for c in known[i : i + 256]) for i in range(0, len(known), 256)]
    wrong = [line for line in lines if coder.encode(line).tolist() != ids_of(line)]
    assert not wrong


def test_round_trip_and_broken_ids(coder):
    for text in ODD:
        raw, length = coder.decode(coder.encode(text))
        assert raw.tobytes().decode() == text and length.sum() == len(raw)
    pick = np.random.default_rng(1)
    for _ in range(200):
        ids = pick.integers(0, 50257, 12)
        assert coder.decode(ids)[0].tobytes().decode("utf-8", "replace") == WHOLE.decode(ids.tolist(), skip_special_tokens=False)


def test_a_very_long_word(coder):
    word = "".join(random.Random(2).choice("abcdefgh") for _ in range(100_000))
    assert coder.encode(word).tolist() == ids_of(word)


def test_forgets_words(coder, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    text = " ".join(f"word{i}" for i in range(50)) + "x" * 100
    assert bpe.Coder(open(PATH, encoding="utf-8").read()).encode(text).tolist() == ids_of(text)


def test_frequent_words_stay_remembered(monkeypatch):
    """Before, every full memory was forgotten as a whole, so a frequent word was merged again each time."""
    made, merge = [], bpe.Coder.merge
    monkeypatch.setattr(bpe, "KEPT_WORDS", 10)
    monkeypatch.setattr(bpe.Coder, "merge", lambda self, data: made.append(data) or merge(self, data))
    coder = bpe.Coder(open(PATH, encoding="utf-8").read())
    text = "".join(f" often x{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(100))
    assert coder.encode(text).tolist() == ids_of(text)
    assert made.count(b" often") == 1 and len(made) == 101
    assert len(coder.kept) + len(coder.kept.older) <= 10


def test_latin_texts_are_split_alike():
    pick = random.Random(7)
    for size in [1, 2, 3] * 400 + [300] * 100:
        text = "".join(chr(pick.choice((pick.randrange(256), 32, 39, 115))) for _ in range(size))
        assert bpe.split(text) == bpe._WORDS(text) and "".join(bpe.split(text)) == text, text
    assert bpe.split("é" + " 東'll " * 2) == ["é", " 東", "'ll", " ", " 東", "'ll", " "]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Coder(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_frames(spark):
    rows = [(1, "two words", "x"), (1, "two words", "x"), (None, "no id", "y"), (2, None, None), (3, "", "z"), (4, "é" * 70_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted([(r.doc_id, r.ids, r.text) for r in out], key=str) == sorted([(i, ids_of(t or ""), t or "") for i, t, _ in rows], key=str)
    assert bpe.encode(docs.limit(0), PATH).collect() == []
    given = spark.createDataFrame([(7, None, "old"), (8, [], "old"), (9, [50256, None, 99999, -4, 64], "old"), (10, [2], None)], "text long, ids array<long>, other string")
    back = bpe.decode(given, PATH, text_col="text").collect()
    assert [(r.other, r.text) for r in back] == [("old", ""), ("old", ""), ("old", "<|endoftext|>a"), (None, "#")]
    assert [r.ids for r in back] == [None, [], [50256, None, 99999, -4, 64], [2]]


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = set()
    for i, text in docs.items():
        ids = ids_of(text)
        want.add((i, len(ids), sha(",".join(map(str, ids))), sha(WHOLE.decode(ids, skip_special_tokens=False))))
    found = queries.QUERIES["op11_bpe"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(found) == len(docs) and {tuple(r) for r in found} == want
