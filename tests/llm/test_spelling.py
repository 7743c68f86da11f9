"""Spelling variants against plain Python, and the cases the docstrings define."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablekeeper.llm import queries, spelling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, word string, n int, root double, a int, near string"


def plain(rows, least=5):
    """{word: (form, root, n, n_near, form_n)} by the definition."""
    counts, fold = Counter(), {c: c + 32 for c in range(65, 91)}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += len(run) >= 6
    words = {w: n for w, n in counts.items() if n >= least}
    holes = {}
    for w in words:  # two words are near if they are equal with one code point left out of one of them, or at one place of both
        for i in range(len(w)):
            holes.setdefault((len(w), i, w[:i] + w[i + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    for w in words:
        for shorter in {w[:i] + w[i + 1 :] for i in range(len(w))} & words.keys():
            near[w].add(shorter)
            near[shorter].add(w)
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return {(w, f, root(w), words[w], len(near[w]), words.get(f)) for w, f in forms.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 0.5, 3, "y") for i, t in rows], SCHEMA)


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {tuple(r) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed):
    pick = random.Random(seed)
    base = ["handler", "réponse", "çavaêtre", "straße", "aabbcc", "question", "ÿÿÿÿÿÿÿ", "multiple" * 9, "z" * 70]
    texts = []
    for i in range(300):
        words = []
        for _ in range(40):
            w = base[min(int(pick.expovariate(0.5)), len(base) - 1)]
            for _ in range(pick.choice([0, 0, 0, 0, 0, 0, 1, 2, 3])):
                k = pick.randrange(len(w))
                w = pick.choice([w[:k] + w[k + 1 :], w[:k] + "e" + w[k:], w[:k] + "aé÷ÿ"[pick.randrange(4)] + w[k + 1 :]])
            words.append(w.upper() if pick.random() < 0.1 else w)
        texts.append((pick.choice([i, None, -i, i % 7]), pick.choice([" ", ", ", "1", "ĀÐ¿", "\n"]).join(words)))
    return texts


def test_against_plain_python(spark, monkeypatch):
    rows = corpus(8)
    want = plain(rows)
    assert len(want) > 100 and any(w[1] for w in want) and any(w[2] != w[0] and w[2] != w[1] for w in want)
    assert found(spelling.variants(frame(spark, rows))) == want
    monkeypatch.setattr(spelling, "PAGE_CELLS", 16)
    monkeypatch.setattr(spelling, "FILTER_BYTES", 300)  # passes of two pages
    monkeypatch.setattr(spelling, "_POSITIONS", 100)
    assert found(spelling.variants(frame(spark, rows))) == want


def test_filters_with_many_false_positives(spark, monkeypatch):
    monkeypatch.setattr(spelling, "KEY_BITS", 1)
    rows = corpus(9)
    assert found(spelling.variants(frame(spark, rows))) == plain(rows)


def test_defined_cases(spark):
    assert found(spelling.variants(frame(spark, []))) == set()
    assert found(spelling.variants(frame(spark, [(1, None), (2, ""), (None, None), (3, "short words only")]))) == set()
    rows = [(None, "alphabet " * 30), (1, "alphabeto " * 6), (1, "alphabeto " * 6), (2, "alphabetx " * 6 + "betaalpha " * 5), (3, "q" * 200_000)]
    rows += [(4, " ".join(["q" * 300] * 5)), (5, ("tiedaaaa tiedbbbb " * 6 + "tiedcbbb tiedabbb " * 40))]
    assert found(spelling.variants(frame(spark, rows))) == plain(rows)
    long = "q" * 100_000
    assert found(spelling.variants(frame(spark, [(6, long)] * 5))) == {(long, None, long, 5, 0, None)}
    with pytest.raises(ValueError, match="times"):
        spelling.variants(frame(spark, rows), times=1)


def test_checksums():
    pick = np.random.default_rng(3)
    raw = pick.integers(0, 256, 4000).astype(np.uint8)
    start = np.sort(pick.integers(0, 3000, 200))
    end = start + pick.integers(0, 300, 200)
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(200)], np.uint32)
    want = [zlib.crc32(f"{i}:".encode() + raw[a:b].tobytes()) for i, (a, b) in enumerate(zip(start, end, strict=True))]
    assert spelling.checksums(raw, start, end, before).tolist() == want
    assert spelling.checksums(raw, start[:0], end[:0], before[:0]).tolist() == []


def test_edits_have_the_hashes_of_what_they_make():
    words = spelling.Words(pa.array(["handler", "aab", "éàz"]))
    at, new, keys, length = words.edits(0, len(words.raw))
    word = np.searchsorted(words.bounds, at, "right") - 1
    made = [words.data[words.bounds[w] : k] + (bytes([c]) if c else b"") + words.data[k + 1 : words.bounds[w + 1]] for w, k, c in zip(word, at, new, strict=True)]
    again = spelling.Words(pa.array([m.decode("latin-1") for m in made]))
    assert again.hashes().tolist() == keys.tolist() and np.diff(again.bounds).tolist() == length.tolist()
    assert len({(w, m) for w, m in zip(word, made, strict=True)}) == len(made)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain(docs)
    assert len(want) > 100 and found(queries.QUERIES["op13_spelling_variants"](spark, SF)) == want
