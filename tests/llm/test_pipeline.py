"""Each stage of the pipeline on its own input against plain Python, then the whole run."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_operators import brute_components, brute_leaks, distance, prose, sentences
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from tablekeeper.llm import lines, packing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pick = random.Random(4)
    items = [(k, " ".join(prose(900 + k, 14))) for k in range(6)]
    texts = {k: "\n".join(sentences(k * 7 + j, 2) for j in range(3)) for k in range(60)}
    for k in range(60, 100):
        texts[k] = " ".join(w + "%%%" for w in prose(k, 80))
    for k in range(100, 120):  # near copies with another line order, so that lines survive in part
        words = texts[k - 100].replace("\n", " ").split()
        words[pick.randrange(len(words))] = "changed"
        texts[k] = " ".join(words)
    for k in range(120, 126):
        texts[k] = sentences(k, 4) + "\n" + items[k - 120][1] + "\n" + sentences(k + 50, 3)
    texts[126], texts[127] = texts[1], items[2][1]
    rows = [(k, t, "en", "s", len(t)) for k, t in texts.items()] + [(200, None, None, None, None), (201, "", "en", None, 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(k, int(k < 60), 0) for k in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_lines_are_cut_out_once(spark, folder, capsys):
    """A filter on the texts would take a second Python worker for each task, and its memory."""
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, folder[0]).explain()
    plan = capsys.readouterr().out
    final = plan.split("== Initial Plan ==")[-1]
    assert final.count("ArrowEvalPython") == 1


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, folder, monkeypatch):
    monkeypatch.setattr(quality, "LEAF_ROWS", 3)
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "packing"]

    kept = stages["quality_classifier"](spark, docs, path)
    assert kept.schema == docs.schema
    left = texts_of(kept)
    assert set(range(60)) <= set(left) and not set(range(60, 100)) & set(left) and all(left[k] == dict((r[0], r[1]) for r in rows)[k] for k in left)

    done = stages["line_dedup"](spark, docs, path)
    assert done.columns == docs.columns
    places = sorted((k, n, line.strip().encode()) for k, t, *_ in rows for n, line in enumerate((t or "").split("\n")) if line.strip())
    gone = {(k, n) for k, n, t in places if any((j, m) < (k, n) and abs(len(t) - len(u)) < 3 and distance(t, u) <= 2 for j, m, u in places)}
    want = {k: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in gone) for k, t, *_ in rows}
    assert texts_of(done) == {k: t for k, t in want.items() if t or not any(j == k for j, _ in gone)}
    assert all(r.n_chars == len(r.text) for r in done.collect() if r.text is not None)

    single = stages["minhash_near_dedup"](spark, docs, path)
    assert single.columns == docs.columns
    assert set(texts_of(single)) == {i for i, _, _, stays in brute_components([(r[0], r[1]) for r in rows], 5) if stays}

    clean = stages["benchmark_decontamination"](spark, docs, path)
    assert clean.columns == docs.columns
    left, hits = texts_of(clean), brute_leaks([r[1] for r in rows], items)
    assert 127 not in left and all(h == 0 for _, h, _ in brute_leaks(list(left.values()), items))
    assert all(left[r[0]] == r[1] for r, (_, h, _) in zip(rows, hits, strict=True) if not h)
    assert all(sentences(k, 4) in left[k] for k in range(120, 126))

    plain = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    pieces = {}
    for r in sorted(stages["packing"](spark, docs, path).collect(), key=lambda r: (r.doc_id, r.start)):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + r.ids
    ids = {r[0]: [*plain.encode(r[1] or "", add_special_tokens=False).ids, packing.END_ID] for r in rows}
    assert pieces == {k: np.array(x, "<u4").tobytes() for k, x in ids.items()}


def test_run(spark, folder):
    path, rows, _ = folder
    out = corpus_pipeline.run(spark, path).collect()
    ids = {r.doc_id for r in out}
    assert ids & set(range(60)) == set(range(60)) and not ids & set(range(60, 100)) and 126 not in ids
    assert all(r.sequence_length <= packing.MAX_TOKENS for r in out)
