"""How far the term distributions of sources are apart: sorted (term id, count) arrays, merged pair by pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from . import text as tx

LEAST_DOCS, TOP_TERMS = 3, 200
SCALE_STEPS = 3
"""Shares are whole numbers of 1 / 1000 ** SCALE_STEPS."""
BLOCK, TILE = 1 << 15, 8
"""An array holds the terms of one of the blocks of so many ids; a task, the arrays of a block of so many sources and so many others."""
_ANCHORS = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE, _VALUES = tx.alphabet("alnum")
_LETTERS = _INSIDE & ~((np.arange(256) >= 48) & (np.arange(256) <= 57)), _VALUES
_SLOT = 1 << 33  # monotonically_increasing_id counts from here in each partition


# --- arithmetic, the same in numpy and in Spark -------------------------------------

def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / total), by long division, so that nothing overflows."""
    rest, out = counts + 1, np.zeros(len(counts), np.int64)
    for _ in range(SCALE_STEPS):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def share_column(count: Column, total: Column) -> Column:
    """The same of columns; NULL where the total is 0."""
    total = F.nullif(total, F.lit(0).cast("long"))
    rest, out = count + 1, _zero()
    for _ in range(SCALE_STEPS):
        scaled = rest * 1000
        out, rest = out * 1000 + F.call_function("div", scaled, total), scaled % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / q)."""
    return (p - q) * (p - q) // q


def divergence_column(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


# --- merging -----------------------------------------------------------------------

def gallop(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of the ascending ``keys`` in the ascending ``table``: of the first entry that is not smaller.

    Every _ANCHORS-th key is looked up in the whole table. The others start at the anchor before them and go on in
    steps that double until they have passed their key; a binary search of that last step ends it. So a key costs the
    logarithm of its distance from the anchor, not of the table.
    """
    anchors = np.searchsorted(table, keys[::_ANCHORS])
    low = np.repeat(anchors, _ANCHORS)[: len(keys)]
    high, step, going = low.copy(), 1, np.arange(len(keys))
    while len(going):
        inside = going[high[going] < len(table)]
        going = inside[table[high[inside]] < keys[inside]]
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step, len(table))
        step *= 2
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        smaller = table[middle] < keys[open_]
        low[open_] = np.where(smaller, middle + 1, low[open_])
        high[open_] = np.where(smaller, high[open_], middle)
    return low


class Side:
    """The terms of one source in a block: ids, shares, and the share of a term it lacks."""

    def __init__(self, source: str, total: int, ids: np.ndarray, counts: np.ndarray):
        self.source, self.ids = source, ids
        self.shares = shares(counts, total) if len(ids) else counts
        self.absent = shares(np.zeros(1, np.int64), total)[0] if total else np.int64(1)


def price(a: Side, b: Side) -> tuple[int, int, int]:
    """Sums of the divergence of a from b and of b from a over the terms either has, and the number of these."""
    short, long = (a, b) if len(a.ids) <= len(b.ids) else (b, a)
    at = gallop(short.ids, long.ids)
    met = at < len(long.ids)
    met[met] = long.ids[at[met]] == short.ids[met]
    at = at[met]
    lone = np.ones(len(long.ids), bool)
    lone[at] = False
    p = np.concatenate([short.shares[met], short.shares[~met], np.full(int(lone.sum()), short.absent)])
    q = np.concatenate([long.shares[at], np.full(int((~met).sum()), long.absent), long.shares[lone]])
    forth, back = int(divergence(p, q).sum()), int(divergence(q, p).sum())
    return (*((forth, back) if short is a else (back, forth)), len(p))


# --- on DataFrames -----------------------------------------------------------------

def _zero() -> Column:
    return F.lit(0).cast("long")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def term_counts(rows: DataFrame) -> DataFrame:
    """lang, source, term, occurrences and rows with the term, of (lang, source, text) rows; partial sums, to be added up."""

    def count(batches):
        for batch in batches:
            langs, sources = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            for a, _, raw, bounds in tx.slices(batch.column(2)):
                start, end, hashes, by_row = tx.words(raw, bounds, _LETTERS)
                if not len(start):
                    continue
                row = tx.rows_of(by_row)
                of = group[a + row]
                keys = hashes ^ tx.mix(of.astype(tx.U64) + tx.U64(1))
                order = np.argsort(keys, kind="stable")
                keys, row = keys[order], row[order]
                new = np.append(True, keys[1:] != keys[:-1])
                other_row = new | np.append(True, row[1:] != row[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(keys)))
                docs = np.add.reduceat(other_row.astype(np.int64), first)
                one = order[first]
                length = end[one] - start[one]
                letters = _LOWER[raw[tx.ragged(start[one], length)]]
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                terms = pa.StringArray.from_buffers(len(one), pa.py_buffer(ends), pa.py_buffer(letters))
                lang, source = np.divmod(of[one], len(sources.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(lang)), sources.dictionary.take(pa.array(source)), terms, pa.array(n), pa.array(docs)],
                    ["lang", "source", "term", "n", "docs"],
                )

    return rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def _numbered(terms: DataFrame) -> DataFrame:
    """Written with an ``id`` per row: 0, 1, 2, ... in the order of partitions."""
    spread = stage(terms.repartitionByRange("lang", "term").withColumn("slot", F.monotonically_increasing_id()), "terms")
    part = F.floor(F.col("slot") / _SLOT)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = spread.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))  # one row per partition
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    placed = spread.withColumn("part", part).join(F.broadcast(offsets), "part")
    return stage(placed.withColumn("id", F.col("offset") + F.col("slot") % _SLOT).drop("part", "offset", "slot"), "terms-numbered")


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, lang_col: str = "lang", source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """How far each source of a language is from each other one (part ``pair``), and by which terms from the whole language (``term``).

    Terms are longest runs of letters (A-Z, a-z, all from U+0080 on), with A-Z in lower case; those in at least
    ``least_docs`` rows of the language count. A share is 1 + floor(10**9 * (count + 1) / (all counts + terms)), the
    distance of p from q floor((p - q)**2 / q). Columns: lang, source, part, item (other source, or term), value (long),
    rank (from 1; by value descending, then item). Pairs are priced over all terms of the language and listed both ways;
    of terms, those that the source has with a larger share than the language, up to rank ``top_terms``.

    NULL in any of the three columns is ''. Texts without terms still make their source known; a language without such
    terms has pairs of value 0. Repeated rows count each; ties are ranked by item in UTF-8 order. An empty table gives
    an empty result. Other columns are not read.

    Counts are added up within slices and before the shuffle, so neither a frequent term nor a source with most rows
    weighs on one task. Each source has sorted (term id, count) arrays, one per block of ids. A task takes one block of
    two tiles of sources and merges each unordered pair of them once, both ways; terms neither has are priced together
    at the end. What a task holds is bounded by BLOCK and TILE, not by sources or terms.
    """
    rows = docs.select(_text(lang_col).alias("lang"), _text(source_col).alias("source"), _text(text_col).alias("text"))
    counts = term_counts(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = stage(counts, "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = _numbered(kept.drop("docs"))
    entries = stage(counts.drop("docs").join(kept, ["lang", "term"]), "term-entries")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_sum"))
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = (
        rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .withColumn("terms", F.coalesce("terms", _zero()))
        .withColumn("total", F.coalesce("n", _zero()) + F.col("terms"))
        .withColumn("lang_total", F.coalesce("lang_sum", _zero()) + F.col("terms"))
        .withColumn("tile", F.floor((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / TILE).cast("int"))
        .drop("n", "lang_sum")
    )
    groups = stage(groups, "sources")
    return _pairs(entries, groups, kept).unionAll(_terms(entries, groups, top_terms))


def _ranked(part: str, found: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = found.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(entries: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    priced = entries.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share_column(F.col("n"), F.col("total")).alias("p"),
        share_column(F.col("lang_n"), F.col("lang_total")).alias("q"),
    )
    return _ranked("term", priced.where("p > q").withColumn("value", divergence_column(F.col("p"), F.col("q"))), top)


def _pairs(entries: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    block = F.floor(F.col("id") / BLOCK).cast("int").alias("block")
    arrays = entries.groupBy("lang", "source", block).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("of"))
    # a source meets the others in every block of its language, whether it has terms there or not; -1 is for languages without
    blocks = kept.select("lang", block).distinct().unionAll(groups.select("lang", F.lit(-1)).distinct())
    laid = groups.select("lang", "source", "tile", "total").join(blocks, "lang").join(arrays, ["lang", "source", "block"], "left")
    laid = laid.select("lang", "source", "tile", "total", "block", F.col("of.id").alias("ids"), F.col("of.n").alias("counts"))
    laid = stage(laid, "term-arrays")

    tiles = groups.groupBy("lang").agg(F.max("tile").alias("last"))
    task, rest = ["lang", "block", "one", "two"], ["source", "total", "ids", "counts"]
    first = laid.join(tiles, "lang").withColumn("two", F.explode(F.sequence("tile", "last"))).withColumnRenamed("tile", "one")
    second = laid.withColumn("one", F.explode(F.sequence(F.lit(0), "tile"))).where("one < tile").withColumnRenamed("tile", "two")
    first, second = first.select(*task, *rest), second.select(*[F.col(c).alias(c) for c in [*task, *rest]])

    def sides(table: pa.Table) -> list[Side]:
        def numbers(value):
            return np.zeros(0, np.int64) if value is None else value.values.to_numpy()

        columns = (table.column(c).combine_chunks() for c in ("source", "total", "ids", "counts"))
        return sorted(
            (Side(s.as_py(), t.as_py(), numbers(i if i.is_valid else None), numbers(n if n.is_valid else None)) for s, t, i, n in zip(*columns, strict=True)),
            key=lambda side: side.source,
        )

    def merge(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, _, one, two = (k.as_py() for k in key)
        a, b = sides(left), sides(right)
        met = [(x, y) for i, x in enumerate(a) for y in (a[i + 1 :] if one == two else b)]
        priced = [(lang, x.source, y.source, *price(x, y)) for x, y in met]
        columns = zip(*priced, strict=True) if priced else [()] * 6
        kinds = [pa.string()] * 3 + [pa.int64()] * 3
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["lang", "a", "b", "ab", "ba", "seen"])

    merged = first.groupBy(*task).cogroup(second.groupBy(*task)).applyInArrow(
        merge, "lang string, a string, b string, ab long, ba long, seen long"
    )
    merged = merged.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("ab", "ba", "seen")])
    of = {x: groups.select("lang", F.col("source").alias(x), "terms", F.col("total").alias(f"total_{x}")) for x in "ab"}
    merged = merged.join(of["a"], ["lang", "a"]).join(of["b"].drop("terms"), ["lang", "b"])
    lacked = {x: share_column(_zero(), F.col(f"total_{x}")) for x in "ab"}
    rest = F.col("terms") - F.col("seen")

    def way(x: str, y: str) -> Column:
        absent = F.coalesce(rest * divergence_column(lacked[x], lacked[y]), F.lit(0))
        return F.struct(F.col(x).alias("source"), F.col(y).alias("item"), (F.col(x + y) + absent).alias("value"))

    both = merged.select("lang", F.explode(F.array(way("a", "b"), way("b", "a"))).alias("way")).select("lang", "way.*")
    return _ranked("pair", both)
