"""The divergence audit against plain Python, and the cases its docstring defines."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablekeeper.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, value int, rank string, n double"


def plain(rows, least=3, top=200):
    """(lang, source, part, item, value, rank) by the definition, with whole numbers of any size."""
    terms = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    fold = {c: c + 32 for c in range(65, 91)}
    groups, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = terms.findall((text or "").translate(fold))
        groups[lang or "", source or ""].update(found)
        seen[lang or ""].update(set(found))
    out = []
    for lang in {lang for lang, _ in groups}:
        kept = {t for t, n in seen[lang].items() if n >= least}
        counts = {s: Counter({t: n for t, n in c.items() if t in kept}) for (name, s), c in groups.items() if name == lang}
        whole = sum(counts.values(), Counter())

        def share(c, t, size=len(kept)):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + size)

        p = {s: {t: share(c, t) for t in kept} for s, c in counts.items()}
        q = {t: share(whole, t) for t in kept}
        for s in counts:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in counts if o != s]
            own = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(1, t, lang, s, "x", 5, "y", 0.5) for t, lang, s in rows], SCHEMA)


def found(spark, rows, **options):
    out = divergence.audit(frame(spark, rows), **options)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(out.dtypes)["value"] == "bigint" and dict(out.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in out.collect())


def corpus(seed, n, sources):
    pick = random.Random(seed)
    words = ["ein", "Die", "naïve", "Été", "東京", "x", "it's", "b2b", "_", "🙂", "ZZ"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    rows = []
    for _ in range(n):
        source = "s0" if pick.random() < 0.4 else f"s{pick.randrange(sources)}"
        size = pick.choice([0, 1, 5, 60])
        text = " ".join(words[min(int(pick.expovariate(0.06)), len(words) - 1)] for _ in range(size))
        rows.append((text, pick.choice(["en", "de", None]), source))
    return rows


def test_against_plain_python(spark, monkeypatch):
    rows = corpus(3, 500, 21)
    assert found(spark, rows) == plain(rows)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    monkeypatch.setattr(divergence, "TILE", 3)
    assert found(spark, rows, top_terms=5) == plain(rows, top=5)


def test_a_worker_holds_little_beside_a_batch():
    """Arrays of a slice: before, over 150 MB for these 12 MB of text."""

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    pick = np.random.default_rng(6)
    texts = ["".join(map(chr, pick.choice([32, 97, 98, 99, 100, 101], 4000))) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3000), pa.array([f"s{i % 50}" for i in range(3000)]), pa.array(texts)], ["lang", "source", "text"])
    run = divergence.term_counts(Rows())
    tracemalloc.start()
    try:
        found = sum(part.num_rows for part in run([batch]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found and most < 100_000_000, most


def test_defined_cases(spark):
    rows = [
        (None, None, None), ("", "en", None), ("same same", "en", "a"), ("Same", "en", "b"), ("same", "en", "b"), ("same", "en", "b"),
        ("alone", "xx", "a"), ("other", "xx", "b"), ("12 34 --", "yy", "a"), ("a" * 100_000, "en", "c"),
        ("tie tip", "tt", "a"), ("tie tip", "tt", "a"), ("tie tip", "tt", "a"), ("top", "tt", "b"), ("top", "tt", "c"), ("top", "tt", "c"),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []
    assert found(spark, [(None, None, None)]) == []


def test_shares_do_not_overflow(spark):
    counts = np.array([0, 1, 10**15, 3 * 10**15])
    total = 4 * 10**15 + 7
    want = [1 + 10**9 * (int(c) + 1) // total for c in counts]
    assert divergence.shares(counts, total).tolist() == want
    column = divergence.share_column(F.col("id"), F.lit(total))
    assert [r[0] for r in spark.createDataFrame([(int(c),) for c in counts], "id long").select(column).collect()] == want


@pytest.mark.parametrize("seed", range(5))
def test_gallop(seed):
    pick = np.random.default_rng(seed)
    table = np.unique(pick.integers(0, 5000, pick.integers(0, 3000)))
    keys = np.unique(pick.integers(-10, 5100, pick.integers(0, 900)))
    assert divergence.gallop(keys, table).tolist() == np.searchsorted(table, keys).tolist()


def test_price_both_ways():
    pick = np.random.default_rng(4)
    for size in (0, 3, 400):
        sides = []
        for n in (size, 70):
            ids = np.sort(pick.choice(500, n, replace=False))
            sides.append(divergence.Side("s", 9_000, ids, pick.integers(1, 50, n)))
        a, b = sides
        p, q = ({i: int(s) for i, s in zip(x.ids, x.shares, strict=True)} for x in (a, b))
        met = {*p, *q}

        def far(x, y, absent_x, absent_y, met=met):
            return sum((x.get(i, absent_x) - y.get(i, absent_y)) ** 2 // y.get(i, absent_y) for i in met)

        forth, back = far(p, q, int(a.absent), int(b.absent)), far(q, p, int(b.absent), int(a.absent))
        assert divergence.price(a, b) == (forth, back, len(met)) and divergence.price(b, a) == (back, forth, len(met))
