"""Benchmark decontamination: an FM-index over each shard of the training text, searched for benchmark phrases."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

WINDOW = 10
BLOCK_CHARS = 8 << 20
"""Characters of test items that go to the tasks at once; a larger benchmark is searched block after block."""
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TABLES = tx.alphabet("alnum")


def item_words(text: str | None) -> list[str]:
    """Words of a text after lower-casing A-Z."""
    return _WORD.findall((text or "").translate(_LOWER))


# --- index of one shard ------------------------------------------------------

class WaveletMatrix:
    """Counts of a symbol before a position of a symbol sequence, one bit plane at a time."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.zeros, self.ones = [], []
        row = symbols
        for level in reversed(range(self.bits)):
            bit = (row >> level) & 1
            count = np.zeros(len(row) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(row) - int(count[-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in front of each position."""
        low, high = np.zeros_like(at), at
        for k, level in enumerate(reversed(range(self.bits))):
            is_one = ((symbol >> level) & 1).astype(bool)
            ones_low, ones_high = self.ones[k][low], self.ones[k][high]
            low = np.where(is_one, self.zeros[k] + ones_low, low - ones_low)
            high = np.where(is_one, self.zeros[k] + ones_high, high - ones_high)
        return high - low


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by doubling the compared length."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, step = len(symbols), 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        step *= 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order


class FMIndex:
    """Full-text index of stretches of symbols (1, 2, ...); no match reaches over the end of a stretch.

    The stretches stand one behind the other with a closing 0 each. Every ``sample``-th position and each first
    position of a stretch keeps its place in the text, so a walk back from any suffix ends after a few steps.
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, top: int, sample: int = 8):
        closing = symbols == 0
        alone = symbols.astype(np.int64) + int(closing.sum())
        alone[closing] = np.arange(int(closing.sum()))  # closings differ, so sorting ends within a stretch
        self.order = suffix_order(alone)
        last = symbols[self.order - 1]  # position 0 looks at the last symbol, a closing 0
        self.tree = WaveletMatrix(last, top)
        self.below = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=top + 1), out=self.below[1:])
        self.last = last
        kept = (np.arange(len(symbols)) % sample == 0) | closing
        kept[starts] = True
        self.sampled = np.where(kept[self.order], self.order, -1)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last suffix that begins with each phrase (rows; 0 pads the left side)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.order), np.int64)
        for k in reversed(range(phrases.shape[1])):
            symbol = phrases[:, k]
            on = np.flatnonzero((symbol > 0) & (low < high))
            if not len(on):
                continue
            s = symbol[on]
            low[on] = self.below[s] + self.tree.rank(s, low[on])
            high[on] = self.below[s] + self.tree.rank(s, high[on])
        return low, np.maximum(low, high)

    def locate(self, suffix: np.ndarray) -> np.ndarray:
        """Text position of each suffix."""
        at, steps = suffix.copy(), np.zeros(len(suffix), np.int64)
        while True:
            open_ = np.flatnonzero(self.sampled[at] < 0)
            if not len(open_):
                return self.sampled[at] + steps
            here = at[open_]
            s = self.last[here]
            at[open_] = self.below[s] + self.tree.rank(s, here)
            steps[open_] += 1


# --- phrases -------------------------------------------------------------------

class Phrases:
    """Windows of the test items as rows of symbols, and which items each window belongs to."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        windows: dict[tuple[str, ...], set[str]] = {}
        for item_id, text in items:
            words = item_words(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners = windows.setdefault(tuple(words[i : i + window]), set())
                if item_id is not None:
                    owners.add(item_id)
        vocabulary = sorted({w for key in windows for w in key})
        hashes = self._hash(vocabulary)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        symbol = {vocabulary[k]: i + 1 for i, k in enumerate(order)}
        self.rows = np.zeros((len(windows), window), np.int64)
        for i, key in enumerate(windows):
            self.rows[i, window - len(key) :] = [symbol[w] for w in key]
        self.lengths = np.array([len(key) for key in windows], np.int64)
        self.owners = [sorted(x) for x in windows.values()]
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    @staticmethod
    def _hash(vocabulary: list[str]) -> np.ndarray:
        data = [w.encode() for w in vocabulary]
        bounds = np.cumsum([0, *map(len, data)])
        raw = np.frombuffer(b"".join(data), np.uint8)
        return tx.range_hash(tx.prefix_sums(_TABLES[1][raw]), bounds[:-1], bounds[1:])

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word by its hash, 0 for words of no item."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.hashes):
            some = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
            out[some] = np.where(self.hashes[at] == hashes[some], at + 1, 0)
        return out

    def matches(self, symbols: np.ndarray, by_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, phrase) of each place where a phrase occurs in a shard of rows of words.

        A phrase lies within a stretch of words that items have, so shorter stretches than the shortest phrase and
        all other words need no place in the index.
        """
        start, end = tx.spans(symbols > 0, by_row)
        long = end - start >= max(1, self.shortest)
        start, length = start[long], (end - start)[long]
        if not len(start) or not len(self.rows):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = tx.ragged(start, length + 1)  # one word more for each closing
        first = np.cumsum(length + 1) - (length + 1)
        closing = first + length
        text = symbols[np.minimum(place, len(symbols) - 1)]
        text[closing] = 0
        index = FMIndex(text, first, len(self.hashes))
        low, high = index.search(self.rows)
        found = np.flatnonzero(high > low)
        suffix = tx.ragged(low[found], (high - low)[found])
        return place[index.locate(suffix)], np.repeat(found, (high - low)[found])


def _scan(phrases: Phrases, raw: np.ndarray, bounds: np.ndarray):
    """Per row: words, hit words, removal spans (row, begin, end in bytes) and (row, item) pairs."""
    start, end, hashes, by_row = tx.words(raw, bounds, _TABLES)
    at, phrase = phrases.matches(phrases.symbols(hashes), by_row)
    change = np.zeros(len(start) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + phrases.lengths[phrase], -1)
    hit = np.cumsum(change[:-1]) > 0
    row = tx.rows_of(by_row)
    n_hit = np.bincount(row[hit], minlength=len(by_row) - 1)
    first, last = tx.spans(hit, by_row)
    span_row = row[first] if len(first) else first
    begin, stop = start[first] - bounds[span_row], (end[last - 1] if len(last) else last) - bounds[span_row]
    pairs = np.unique(np.stack([row[at], phrase]), axis=1) if len(at) else np.zeros((2, 0), np.int64)
    return np.diff(by_row), n_hit, (span_row, begin, stop), pairs


FOUND = "n_words long, n_hit long, item_ids array<string>, spans array<struct<begin:int,stop:int>>"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    block, chars = [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        chars += len(text)
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Words of each document that lie in a window of a test item, and the items they come from.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window. One row per row of
    ``docs``: the id, ``text``, ``n_words``, ``n_hit``, ``item_ids`` (sorted strings) and ``spans`` (hit stretches as
    byte offsets into the UTF-8 text, merged and in order).

    NULL and empty texts have no words. An item without words or text has no window; the windows of an item without id
    hit, but name no item. Items that repeat an id count once. Repeated rows are searched each by itself. An empty
    table gives an empty result. Other columns of either table are not read.

    There is no shuffle. Each task indexes slices of its rows (a shard) and searches all windows in each; the windows
    of up to BLOCK_CHARS characters of items go to the tasks at once, and a larger benchmark takes more passes.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select(
        "*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("item_ids"),
        F.array().cast("array<struct<begin:int,stop:int>>").alias("spans"),
    )
    blocks = _blocks(benchmark, item_col, item_text_col)
    found = rows
    for k, block in enumerate([*blocks] or [[]]):
        found = _search(found, Phrases(block, window), first=k == 0)
    return found


def _search(rows: DataFrame, phrases: Phrases, first: bool) -> DataFrame:
    """Add what one block of phrases finds. With several blocks the words that earlier ones hit are kept as spans."""
    schema = T.StructType([rows.schema["doc_id"], rows.schema["text"], *T.StructType.fromDDL(FOUND).fields])

    def search(batches):
        for batch in batches:
            values = tx.column(batch, "text")
            doc_id = batch.column(batch.schema.get_field_index("doc_id"))
            texts = batch.column(batch.schema.get_field_index("text"))
            for a, b, raw, bounds in tx.slices(values):
                n_words, n_hit, (span_row, begin, stop), pairs = _scan(phrases, raw, bounds)
                items: list = [[] for _ in range(b - a)]
                for r in np.unique(pairs[0]):
                    items[r] = sorted({x for p in pairs[1][pairs[0] == r] for x in phrases.owners[p]})
                by_row = np.searchsorted(span_row, np.arange(b - a + 1))
                pairs_of = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(stop, pa.int32())], ["begin", "stop"])
                spans = tx.lists(pairs_of, by_row)
                if not first:
                    items, spans, n_hit = _merge(batch.slice(a, b - a), items, spans, raw, bounds)
                yield pa.RecordBatch.from_arrays(
                    [doc_id.slice(a, b - a), texts.slice(a, b - a), pa.array(n_words, pa.int64()),
                     pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), spans],
                    ["doc_id", "text", "n_words", "n_hit", "item_ids", "spans"],
                )

    return rows.mapInArrow(search, schema)


def _merge(before: pa.RecordBatch, items: list, spans: pa.Array, raw: np.ndarray, bounds: np.ndarray):
    """Union of the items and spans of earlier blocks and of this one."""
    old_items = before.column(before.schema.get_field_index("item_ids")).to_pylist()
    old_spans = before.column(before.schema.get_field_index("spans")).to_pylist()
    start, end, _, by_row = tx.words(raw, bounds, _TABLES)
    n_hit, merged = [], []
    for r, (was, now) in enumerate(zip(old_spans, spans.to_pylist(), strict=True)):
        at = start[by_row[r] : by_row[r + 1]] - bounds[r]
        to = end[by_row[r] : by_row[r + 1]] - bounds[r]
        hit = np.zeros(len(at), bool)
        for x in [*was, *now]:
            hit |= (at >= x["begin"]) & (to <= x["stop"])
        first, last = tx.spans(hit, np.array([0, len(hit)]))
        merged.append([{"begin": int(at[i]), "stop": int(to[j - 1])} for i, j in zip(first, last, strict=True)])
        n_hit.append(int(hit.sum()))
        items[r] = sorted({*items[r], *old_items[r]})
    return items, pa.array(merged, pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())]))), np.array(n_hit)


def remove_benchmark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit stretches of words cut out of the text; each cut leaves a line break.

    Texts are searched again after a cut until nothing is found, since a cut can bring the two ends of a split passage
    together. Rows, ids and other columns stay as they are; NULL texts stay NULL.
    """
    blocks = [Phrases(block, window) for block in _blocks(benchmark, "item_id", "text")]

    def clean(batches):
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            values = tx.column(batch, text_col)
            out = batch.column(k).to_pylist()
            for a, b, raw, bounds in tx.slices(values):
                hit = np.zeros(b - a, bool)
                for phrases in blocks:
                    hit |= _scan(phrases, raw, bounds)[1] > 0
                for r in np.flatnonzero(hit):
                    out[a + r] = _without(raw[bounds[r] : bounds[r + 1]].tobytes(), blocks).decode()
            columns = [pa.array(out, batch.schema.field(k).type) if i == k else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)


def _without(text: bytes, blocks: list[Phrases]) -> bytes:
    """The text without hit words of any block, until no block hits."""
    clean = 0
    while clean < len(blocks):
        clean = 0
        for phrases in blocks:
            raw = np.frombuffer(text, np.uint8)
            _, n_hit, (_, begin, stop), _ = _scan(phrases, raw, np.array([0, len(raw)]))
            if n_hit[0]:
                text = _cut(text, begin, stop)
            else:
                clean += 1
    return text


def _cut(text: bytes, begin, stop) -> bytes:
    parts, at = [], 0
    for i, j in zip(begin, stop, strict=True):
        parts.append(text[at:i].strip())
        at = j
    return b"\n".join(x for x in [*parts, text[at:].strip()] if x)
