"""Spelling variants: generated edits probe Bloom filters of the vocabulary, positives are joined with it exactly."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage
from . import text as tx

LEAST_POINTS, LEAST_COUNT, TIMES = 6, 5, 5
"""Words have so many code points and occurrences; a form has so many times the occurrences of its word."""
SLIP = 199
"""A run loses a code point where this divides its checksum."""
KEY_BITS = 24
"""Bits of filter per word. A word sets four bits of one 64-bit cell."""
PAGE_CELLS = 1 << 13
FILTER_BYTES = 32 << 20
"""Filters are broadcast in passes of so many bytes at most, whatever the size of the vocabulary."""
_LONG = 64
"""Words of so many code points and more share a filter."""
_POSITIONS = 1 << 16
_SLICE = 4 << 20
_CRC_BYTES = 48

LETTERS = np.concatenate([np.arange(97, 123), np.arange(0xC0, 0x100)]).astype(np.uint8)
_RANK = np.zeros(256, np.int64)
_RANK[LETTERS] = np.arange(len(LETTERS))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = tx.alphabet("nonspace", fold=False)[1]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


# --- words of texts ------------------------------------------------------------------

def runs(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each longest run of A-Z, a-z and U+00C0 to U+00FF (0xC3 and a byte from 0x80 on in UTF-8)."""
    letter = ((raw | 0x20) >= 97) & ((raw | 0x20) <= 122) & (raw < 128)
    lead = raw == 0xC3
    inside = letter | lead
    inside[1:] |= lead[:-1]
    return tx.spans(inside, bounds)


def checksums(raw: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each raw[start:end], continued from the checksum ``before`` it; byte by byte, all stretches at once."""
    order = np.argsort(start - end, kind="stable")
    at, length = start[order], (end - start)[order]
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    for k in range(min(_CRC_BYTES, int(length[0]) if len(length) else 0)):
        n = int(np.searchsorted(-length, -k, "left"))  # as many are longer than k
        state[:n] = _CRC[(state[:n] ^ raw[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > _CRC_BYTES):
        state[i] = zlib.crc32(raw[at[i] + _CRC_BYTES : at[i] + length[i]], int(state[i]))
    out = np.empty_like(state)
    out[order] = state
    return out


def word_counts(raw: np.ndarray, bounds: np.ndarray, ids: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(start, end, count) in the lowered bytes of the distinct words that stay whole, and the words that lose a code point."""
    raw = _LOWER[raw]
    start, end = runs(raw, bounds)
    leads = np.concatenate([[0], np.cumsum(raw == 0xC3)])
    points = end - start - (leads[end] - leads[start])
    long = points >= LEAST_POINTS  # what loses a code point of these may be too short; shorter ones stay too short
    start, end, points = start[long], end[long], points[long]
    row = np.searchsorted(bounds, start, "right") - 1
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = checksums(raw, start, end, heads[row])
    slips = crc % SLIP == 0
    lost = []
    for a, b, h, n in zip(start[slips], end[slips], crc[slips], points[slips], strict=True):
        if n > LEAST_POINTS:
            word, k = raw[a:b].tobytes().decode(), int(h % np.uint32(n))
            lost.append((word[:k] + word[k + 1 :]).encode())
    start, end = start[~slips], end[~slips]
    _, first, count = np.unique(tx.range_hash(tx.prefix_sums(_VALUES[raw]), start, end), return_index=True, return_counts=True)
    return raw, start[first], end[first], count, lost


def _strings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(raw[tx.ragged(start, end - start)]))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of LEAST_POINTS code points and more that occur ``least`` times.

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. With h the CRC-32 of
    "<id>:<run>", a run of n code points loses the one at h % n if SLIP divides h. NULL texts have no words, a NULL id
    is an empty string there. Repeated rows count each, an empty table has no words, other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))

    def count(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, bounds in tx.slices(tx.column(batch, "text"), _SLICE):
                raw, start, end, n, lost = word_counts(raw, bounds, ids.slice(a, b - a).to_pylist())
                words = pa.concat_arrays([_strings(raw, start, end), pa.array(lost, pa.binary()).cast(pa.string())])
                yield pa.RecordBatch.from_arrays([words, pa.array(np.append(n, np.ones(len(lost), np.int64)))], ["word", "n"])

    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- filters -------------------------------------------------------------------------

class Filters:
    """Where words of each length have their cells: one filter per length, one behind the other."""

    def __init__(self, counts: dict[int, int]):
        """``counts``: number of words by shard (see ``shard``)."""
        cells = {length: n * KEY_BITS // 64 + 1 for length, n in counts.items()}
        self.first, self.cells = np.zeros(_LONG + 1, np.int64), np.zeros(_LONG + 1, np.int64)
        total = 0
        for length, n in sorted(cells.items()):
            self.first[length], self.cells[length] = total, n
            total += n
        self.pages = -(-total // PAGE_CELLS)

    @staticmethod
    def shard(length: np.ndarray) -> np.ndarray:
        return np.minimum(length, _LONG)

    def cell(self, keys: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Cell of each word by its hash and length; -1 if no word has the length."""
        shard = self.shard(length)
        cells = self.cells[shard]
        share = keys >> tx.U64(32)
        high, low = cells >> 31, cells & (2**31 - 1)  # share * cells / 2**32, in two parts so that it fits 64 bits
        at = (share * low.astype(tx.U64) >> tx.U64(32)) + (share * high.astype(tx.U64) >> tx.U64(1))
        return np.where(cells > 0, self.first[shard] + np.minimum(at.astype(np.int64), cells - 1), -1)

    @staticmethod
    def mask(keys: np.ndarray) -> np.ndarray:
        """Four of 64 bits, by the lower half of the hash."""
        out = np.zeros(len(keys), tx.U64)
        for k in range(4):
            out |= tx.U64(1) << ((keys >> tx.U64(6 * k)) & tx.U64(63))
        return out


class Words:
    """Latin-1 bytes of words, one behind the other, and hashes of any word that one edit makes of them."""

    def __init__(self, words: pa.Array):
        raw = "".join(words.to_pylist()).encode("latin-1")
        length = np.fromiter((len(w) for w in words.to_pylist()), np.int64, len(words))
        self.raw, self.data = np.frombuffer(raw, np.uint8), raw
        self.bounds = np.concatenate([[0], np.cumsum(length)])
        self.sums = tx.prefix_sums(_VALUES[self.raw])
        self.power, self.inverse = tx.powers(len(raw))

    def hashes(self) -> np.ndarray:
        return tx.range_hash(self.sums, self.bounds[:-1], self.bounds[1:])

    def edits(self, first: int, last: int):
        """Edits at the characters [first, last): place, new letter (0: none, the character goes), hash, length of what results.

        Only one of two near words makes the other: the longer one by leaving a character out (the first of equal
        neighbours), else the one with the later letter by an earlier one. So each pair is found once.
        """
        at = np.arange(first, last)
        word = np.searchsorted(self.bounds, at, "right") - 1
        begin, end = self.bounds[word], self.bounds[word + 1]
        letter = self.raw[at]
        origin = self.inverse[begin]
        whole = (self.sums[end] - self.sums[begin]) * origin
        size = end - begin

        same = np.zeros(len(at), bool)
        inner = at > begin
        same[inner] = letter[inner] == self.raw[at[inner] - 1]
        out = np.flatnonzero(~same)
        left = (self.sums[at[out]] - self.sums[begin[out]]) * origin[out]
        right = (self.sums[end[out]] - self.sums[at[out] + 1]) * origin[out] * self.inverse[1]
        shorter = size[out] - 1
        gone = tx.mix(left + right + shorter.astype(tx.U64))

        ranks = _RANK[letter]
        which = np.repeat(np.arange(len(at)), ranks)
        new = LETTERS[tx.ragged(np.zeros(len(at), np.int64), ranks)]
        step = self.power[at[which] - begin[which]]
        other = tx.mix(whole[which] + (_VALUES[new] - _VALUES[letter[which]]) * step + size[which].astype(tx.U64))
        return (
            np.concatenate([at[out], at[which]]), np.concatenate([np.zeros(len(out), np.uint8), new]),
            np.concatenate([gone, other]), np.concatenate([shorter, size[which]]),
        )


def _filter_pages(words: DataFrame, filters: Filters) -> DataFrame:
    """(page, cells): the filters of the (word, n) rows in pages of PAGE_CELLS cells."""

    def place(batches):
        for batch in batches:
            taken = Words(batch.column(0))
            keys = taken.hashes()
            cell = filters.cell(keys, np.diff(taken.bounds))
            columns = [pa.array(cell // PAGE_CELLS), pa.array(cell % PAGE_CELLS), pa.array(filters.mask(keys).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["page", "cell", "bits"])

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        cells = np.zeros(PAGE_CELLS, np.int64)
        np.bitwise_or.at(cells, rows["cell"].to_numpy(), rows["bits"].to_numpy())
        return pa.Table.from_arrays([pa.array([key[0].as_py()]), pa.array([cells.tobytes()], pa.binary())], ["page", "cells"])

    placed = words.select("word").mapInArrow(place, "page long, cell long, bits long")
    return placed.groupBy("page").applyInArrow(fill, "page long, cells binary")


def _positives(words: DataFrame, filters: Filters, pages: DataFrame, first: int, last: int) -> DataFrame:
    """(word, n, near) for the edits of words that pass the filters' pages [first, last), which are broadcast."""
    cells = np.zeros((last - first) * PAGE_CELLS, np.int64)
    for page in pages.where(F.col("page").between(first, last - 1)).toLocalIterator():
        cells[(page.page - first) * PAGE_CELLS :][:PAGE_CELLS] = np.frombuffer(page.cells, np.int64)
    shared = words.sparkSession.sparkContext.broadcast(cells.view(tx.U64))
    begin = first * PAGE_CELLS

    def probe(batches):
        cells = shared.value
        for batch in batches:
            taken = Words(batch.column(0))
            for a in range(0, len(taken.raw), _POSITIONS):
                at, new, keys, length = taken.edits(a, min(a + _POSITIONS, len(taken.raw)))
                cell = filters.cell(keys, length) - begin
                here = np.flatnonzero((cell >= 0) & (cell < len(cells)))
                bits = filters.mask(keys[here])
                here = here[cells[cell[here]] & bits == bits]
                at, new = at[here], new[here]
                word = np.searchsorted(taken.bounds, at, "right") - 1
                near = [
                    (taken.data[i:k] + (bytes([c]) if c else b"") + taken.data[k + 1 : j]).decode("latin-1")
                    for i, j, k, c in zip(taken.bounds[word], taken.bounds[word + 1], at, new, strict=True)
                ]
                take = pa.array(word)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(near, pa.string())], ["word", "n", "near"]
                )

    return words.select("word", "n").mapInArrow(probe, "word string, n long, near string")


# --- grouping ------------------------------------------------------------------------

def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): the pairs of (word, n) rows that differ by one inserted, deleted or replaced code point, each once.

    Words must be unique, with code points below U+0100. Filters of KEY_BITS bits a word are made page by page and
    broadcast in passes of FILTER_BYTES; an edit is probed in the pass that has its cell. What passes is joined with the
    words, so false positives go, and nothing else of the neighbourhoods is shuffled.
    """
    length = F.least(F.length("word"), F.lit(_LONG))
    filters = Filters({r[0]: r[1] for r in words.groupBy(length.alias("length")).count().collect()})
    pages = stage(_filter_pages(words, filters), "word-filters")
    per_pass = max(1, FILTER_BYTES // (8 * PAGE_CELLS))
    found = None
    for first in range(0, max(filters.pages, 1), per_pass):
        some = stage(_positives(words, filters, pages, first, min(first + per_pass, max(filters.pages, 1))), "word-positives")
        found = some if found is None else found.unionAll(some)
    known = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    return found.join(known, F.col("near") == F.col("b")).select(F.col("word").alias("a"), F.col("n").alias("a_n"), "b", "b_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form) links: ways of double length in each round, so as many rounds as the logarithm of the longest."""
    ways = stage(links.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stage(ways.join(on, "root", "left").select("word", "root", "further"), "word-ways")
        if not longer.where("further IS NOT NULL").limit(1).count():
            return ways
        ways = longer.select("word", F.coalesce("further", "root").alias("root"))


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT, times: int = TIMES
) -> DataFrame:
    """The vocabulary of ``docs`` with the likely right spelling of each word.

    One row per word (see ``vocabulary``): word, n (occurrences), n_near (words that differ by exactly one inserted,
    deleted or replaced code point), form (the most frequent of these, the first in code-point order among equals, if
    it occurs ``times`` times as often; else NULL), form_n (its n or NULL), root (where forms lead in the end; the word
    itself if it has none).

    NULL and empty texts have no words, a NULL id is an empty string in the checksum, repeated rows count each, an empty
    table gives an empty result, and other columns are not read. A form has at least ``times`` times (more than once)
    the occurrences of its word, so the ways to roots have no cycles.

    Occurrences are added up within slices and before the shuffle, so no word is hot. A word has few near ones (less
    than 200 per code point), whatever the data, so no join key is hot either.
    """
    if times < 2:
        raise ValueError("times must be 2 or more")
    words = stage(vocabulary(docs, id_col, text_col, least), "words")
    pairs = near_words(words)
    one, two = F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(
        F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")
    )
    both = pairs.select(F.explode(F.array(one, two)).alias("way")).select("way.*")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("x"), F.col("near").alias("y"))).alias("best")
    )
    chosen = F.col("best.x") * -1 >= F.col("n") * times
    forms = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("best.y")).alias("form"),
        F.when(chosen, -F.col("best.x")).alias("form_n"),
    )
    forms = stage(forms, "word-forms")
    return forms.join(_roots(forms.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
