"""Passages that repeat across documents, found by hashes of runs of sentences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage
from . import text as tx

RUN_SENTENCES, RUN_WORDS, LONE_WORDS = 2, 8, 50
"""A run has at least so many sentences and words; a sentence of LONE_WORDS words or more is a run by itself.

So a passage goes wherever it has two whole sentences of RUN_WORDS words together, though it starts and ends within others.
"""
_TABLES = tx.alphabet("nonspace")
_STOPS, _CLOSERS = ".!?。！？．｡؟۔।", "\"')]”’»」』）】》〉"


def _ends_with(raw: np.ndarray, start: np.ndarray, end: np.ndarray, characters: str) -> np.ndarray:
    """Bytes of the one of ``characters`` that ends each stretch, 0 if none does."""
    out = np.zeros(len(end), np.int64)
    for c in characters:
        code = c.encode()
        found = end - start >= len(code)
        for k, byte in enumerate(code):
            found &= raw[np.maximum(end - len(code) + k, 0)] == byte
        out[found] = len(code)
    return out


def words(raw: np.ndarray, bounds: np.ndarray):
    """Start, end and hash of every word, bounds of the rows within the words.

    White space parts words. A Chinese or Japanese character starts one, and so does what follows a full stop of
    those scripts (a closing quote or bracket may follow), unless it is such a mark itself.
    """
    inside, values = _TABLES
    start, end = tx.spans(inside[raw], bounds)
    if len(raw) and raw.max() >= 0xE3:
        one, two = np.zeros((2, len(raw)), np.uint8)
        one[:-1], two[:-2] = raw[1:], raw[2:]
        begins = (raw >= 0xE4) & (raw <= 0xE9) | (raw == 0xE3) & ((one >= 0x81) & (one != 0x83) | (one == 0x83) & (two != 0xBC))
        begins |= (raw == 0xF0) & ((one >= 0xA0) & (one <= 0xB3))
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        mark = (raw == 0xE3) & (one == 0x80) | (raw == 0xEF) & ((one == 0xBC) | (one == 0xBD)) | (raw == 0xE2) & (one == 0x80)
        mark |= np.isin(raw, np.frombuffer(b".!?\"')]", np.uint8))
        closed = _ends_with(raw, np.zeros(len(lead), np.int64), lead, _CLOSERS)
        stops = _ends_with(raw, np.zeros(len(lead), np.int64), lead - closed, "。！？．｡") > 0
        begins[lead] |= stops & ~mark[lead]
        begins &= inside[raw]
        begins[start] = True
        start = np.flatnonzero(begins)
        last = np.searchsorted(end, start, "right")
        end = np.minimum(end[last], np.append(start[1:], len(raw)))
    hashes = tx.range_hash(tx.prefix_sums(values[raw]), start, end)
    return start, end, hashes, np.searchsorted(start, bounds)


def sentences(raw: np.ndarray, bounds: np.ndarray):
    """First word of each sentence and one past its last, words' (start, end, hash), sentence bounds of the rows.

    A sentence ends behind a word with a full stop, question or exclamation mark (a closing quote or bracket may
    follow), at a line break, and with its row.
    """
    start, end, hashes, by_row = words(raw, bounds)
    if not len(start):
        return start, start, (start, end, hashes), np.zeros(len(bounds), np.int64)
    closed = _ends_with(raw, start, end, _CLOSERS)
    ends = _ends_with(raw, start, end - closed, _STOPS) > 0
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    ends[:-1] |= breaks[start[1:]] > breaks[end[:-1]]
    ends[by_row[1:][by_row[1:] > 0] - 1] = True
    stop = np.flatnonzero(ends) + 1
    first = np.concatenate([[0], stop[:-1]])
    return first, stop, (start, end, hashes), np.searchsorted(first, by_row)


def runs(first: np.ndarray, stop: np.ndarray, by_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) sentence of every run: the shortest from each sentence on, and the shortest up to each."""
    n = len(first)
    each = np.arange(n)
    row = tx.rows_of(by_row)
    alone = stop - first >= LONE_WORDS
    to = np.where(alone, each, np.maximum(each + RUN_SENTENCES - 1, np.searchsorted(stop, first + RUN_WORDS)))
    back = np.searchsorted(first, stop - RUN_WORDS, "right") - 1
    since = np.where(alone, each, np.minimum(each - RUN_SENTENCES + 1, back))
    good, good_back = to < by_row[1:][row], since >= by_row[:-1][row]
    pairs = np.concatenate([each[good] * n + to[good], since[good_back] * n + each[good_back]])
    pairs = np.unique(pairs)
    return pairs // max(1, n), pairs % max(1, n)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("copy"), F.col(text_col).alias("text")
    )


def _spans(rows: DataFrame) -> DataFrame:
    """span hash, doc_id, copy, first and last sentence of each run."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, raw, bounds in tx.slices(tx.column(batch, "text")):
                first, stop, (_, _, hashes), by_row = sentences(raw, bounds)
                i, j = runs(first, stop, by_row)
                row = np.searchsorted(by_row, i, "right") - 1
                span = tx.range_hash(tx.prefix_sums(hashes), first[i], stop[j]) if len(i) else np.zeros(0, tx.U64)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(span.view(np.int64)), batch.column(0).slice(a, b - a).take(take), batch.column(1).slice(a, b - a).take(take),
                     pa.array((i - by_row[row]).astype(np.int32)), pa.array((j - by_row[row]).astype(np.int32))],
                    ["span", "doc_id", "copy", "first", "last"],
                )

    return rows.mapInArrow(run, f"span long, doc_id {kind}, copy long, first int, last int")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy (hash of the text) and ``spans`` (first and last sentence) that repeat an earlier place."""
    spans = _spans(_keyed(docs, id_col, text_col))
    place = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("y"), F.col("copy").alias("z"), F.col("first").alias("s"))
    known = spans.groupBy("span").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1")
    known = stage(known.select("span", "origin"), "spans")
    again = spans.join(known, "span").where(place > F.col("origin")).select("doc_id", "copy", "first", "last")
    return again.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the sentences that a repeated run covers, except at the run's first place.

    One row per row of ``docs``: ``doc_id``, ``text``, ``n_sentences`` (before) and ``n_removed``. Words (in Chinese
    and Japanese: characters) are compared without case (A-Z) and white space; runs are described at RUN_SENTENCES. "First" is by id (NULL last), then by a
    hash of the text where an id repeats, then by place in the text.

    NULL and empty texts have no sentences; NULL stays NULL. Rows that repeat id and text are one place: all keep their
    sentences, or none. An empty table gives an empty result. Other columns are not read.

    Only 8-byte hashes and places are joined across documents. They are counted per hash on the map side first, and
    each place is checked against the single row of its hash, so a very frequent passage is never gathered.
    """
    rows = _keyed(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = stage(repeated_spans(docs, id_col, text_col), "repeats").select(
        F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), F.col("spans.first").alias("a"), F.col("spans.last").alias("b")
    )
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")), "left")

    def cut(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            begins, ends = batch.column(2), batch.column(3)
            for a, b, raw, bounds in tx.slices(tx.column(batch, "text")):
                first, _, (start, _, _), by_row = sentences(raw, bounds)
                out = texts.slice(a, b - a).to_pylist()
                n_removed = np.zeros(b - a, np.int64)
                for r in np.flatnonzero(begins.slice(a, b - a).is_valid().to_numpy(zero_copy_only=False)):
                    change = np.zeros(by_row[r + 1] - by_row[r] + 1, np.int64)
                    np.add.at(change, begins[a + int(r)].values.to_numpy(), 1)
                    np.add.at(change, ends[a + int(r)].values.to_numpy() + 1, -1)
                    gone = np.cumsum(change)[:-1] > 0
                    at = np.append(start[first[by_row[r] : by_row[r + 1]]], bounds[r + 1])
                    data = raw.tobytes()
                    kept = [data[at[k] : at[k + 1]] for k in np.flatnonzero(~gone)]
                    out[r] = b"".join(kept).strip().decode()
                    n_removed[r] = gone.sum()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(out, pa.string()), pa.array(np.diff(by_row)), pa.array(n_removed)],
                    ["doc_id", "text", "n_sentences", "n_removed"],
                )

    return joined.select("doc_id", "text", "a", "b").mapInArrow(cut, f"doc_id {kind}, text string, n_sentences long, n_removed long")
