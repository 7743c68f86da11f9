"""Near-duplicates of word shingle sets: circulant MinHash, banding, exact Jaccard verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage
from . import text as tx
from .graph import components

BANDS, ROWS = 40, 5
"""A pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8^5)^40 = 1 - 1.2e-7."""
_TABLES = tx.alphabet("nonspace")
_SLICE = 1 << 18
_CHUNK = 1 << 16


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row, sorted within the row, and the rows' bounds.

    A row of fewer words than ``width`` has its whole sequence as one shingle; without words it has none.
    """
    _, _, hashes, by_row = tx.words(raw, bounds, _TABLES)
    n = np.diff(by_row)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    first = tx.ragged(by_row[:-1], count)
    last = np.minimum(first + width, np.repeat(by_row[1:], count))
    found = tx.range_hash(tx.prefix_sums(hashes), first, last)
    at = np.concatenate([[0], np.cumsum(count)])
    for i, j in zip(at[:-1], at[1:], strict=True):
        found[i:j].sort()
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    new[at[:-1][count > 0]] = True
    total = np.concatenate([[0], np.cumsum(new)])
    return found[new], total[at]


def fingerprints(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each set; equal sets have equal ones."""
    sums = np.concatenate([np.zeros(1, tx.U64), np.cumsum(tx.mix(sets ^ tx.U64(0x5851F42D4C957F2D)), dtype=tx.U64)])
    return tx.mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(tx.U64))


def _permuted(x: np.ndarray, shift: int, out: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    """The second permutation of 32-bit values, its domain shifted in a circle."""
    np.add(x, np.uint32(shift), out=out)
    for bits, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(out, np.uint32(bits), out=tmp)
        np.bitwise_xor(out, tmp, out=out)
        np.multiply(out, np.uint32(factor), out=out)
    np.right_shift(out, np.uint32(16), out=tmp)
    return np.bitwise_xor(out, tmp, out=out)


def band_keys(sets: np.ndarray, at: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Keys of the bands of each set (sets x bands); rows of empty sets hold nothing of use.

    Circulant MinHash: the first permutation spreads the shingles over 32 bits (the upper half of their hashes); each
    coordinate is the minimum of the second permutation shifted one step further.
    """
    full = np.flatnonzero(np.diff(at))
    keys = np.zeros((len(at) - 1, bands), tx.U64)
    spread = (tx.mix(sets) >> tx.U64(32)).astype(np.uint32)
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(at[full], at[full[i]] + _CHUNK, "right")) - 1)
        mine = full[i:j]
        x = spread[at[mine[0]] : at[mine[-1] + 1]]
        starts = at[mine] - at[mine[0]]
        out, tmp = np.empty_like(x), np.empty_like(x)
        for b in range(bands):
            key = np.full(len(mine), b + 1, tx.U64)
            for r in range(rows):
                low = np.minimum.reduceat(_permuted(x, b * rows + r, out, tmp), starts)
                key = tx.mix(key * tx.U64(0x9E3779B97F4A7C15) + low)
            keys[mine, b] = key
        i = j
    return keys


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def signatures(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, node (fingerprint of the set; NULL if it is empty) and band keys of each document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def sign(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, bounds in tx.slices(tx.column(batch, "text"), _SLICE):
                sets, at = shingle_sets(raw, bounds, width)
                n = np.diff(at)
                node = pa.array(fingerprints(sets, at).view(np.int64), mask=n == 0)
                keys = band_keys(sets, at)[n > 0]
                limits = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n), node, tx.lists(_signed(keys.ravel()), limits)],
                    ["doc_id", "n_shingles", "node", "bands"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {kind}, n_shingles long, node long, bands array<long>")


def _with_nodes(docs: DataFrame, width: int) -> DataFrame:
    """node and text of each (doc_id, text) row."""

    def name(batches):
        for batch in batches:
            texts = tx.column(batch, "text")
            for a, b, raw, bounds in tx.slices(texts, _SLICE):
                node = fingerprints(*shingle_sets(raw, bounds, width))
                yield pa.RecordBatch.from_arrays([_signed(node), texts.slice(a, b - a)], ["node", "text"])

    return docs.select("text").mapInArrow(name, "node long, text string")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """node, label and the shingle set of (node, label, text) rows."""

    def cut(batches):
        for batch in batches:
            for a, b, raw, bounds in tx.slices(tx.column(batch, "text"), _SLICE):
                sets, at = shingle_sets(raw, bounds, width)
                own = [batch.column(c).slice(a, b - a) for c in range(2)]
                yield pa.RecordBatch.from_arrays([*own, tx.lists(_signed(sets), at)], ["node", "label", "shingles"])

    return texts.select("node", "label", "text").mapInArrow(cut, "node long, label long, shingles array<long>")


def _compared(pairs: DataFrame, width: int) -> DataFrame:
    """a, b, the sizes of their shingle sets and of the common part, from the texts x and y."""

    def compare(batches):
        for batch in batches:
            size_x, size_y, common = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            x, y = tx.column(batch, "x"), tx.column(batch, "y")
            for a, b, raw, bounds in tx.slices(x, _SLICE):
                left, at = shingle_sets(raw, bounds, width)
                size_x[a:b] = np.diff(at)
                done = a
                for c, d, raw_y, bounds_y in tx.slices(y.slice(a, b - a), _SLICE):
                    right, to = shingle_sets(raw_y, bounds_y, width)
                    size_y[done : done + d - c] = np.diff(to)
                    for k in range(d - c):
                        r = done - a + k
                        both = np.concatenate([left[at[r] : at[r + 1]], right[to[k] : to[k + 1]]])
                        both.sort()
                        common[done + k] = np.count_nonzero(both[1:] == both[:-1])
                    done += d - c
            columns = [batch.column(0), batch.column(1), *map(pa.array, (size_x, size_y, common))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "na", "nb", "common"])

    return pairs.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, na long, nb long, common long")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """shingle, node, label, size and reach for the rarest shingles of each set.

    A set's shingles are ordered by the number of sets that hold them, then by hash. Two sets that are ``percent`` alike
    have one in common among the first ``size - ceil(percent * size / 100) + 1`` of either; ``reach`` is how many come
    from it on, so the first one in common bounds the common part. Shingles of one set alone come first, and are not given.
    """
    each = sets.select("node", F.explode("shingles").alias("shingle"))
    common = stage(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"), "shared-shingles")
    ordered = each.join(common, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("holders", "shingle"))).alias("order"))
    sized = sets.select("node", "label", F.size("shingles").cast("long").alias("size")).join(ordered, "node")
    own = F.col("size") - F.size("order")
    length = F.expr(f"(size * {100 - percent}) div 100 + 1")
    lead = sized.withColumn("own", own).withColumn("lead", F.slice("order", F.lit(1), F.greatest(length - own, F.lit(0)).cast("int")))
    at = lead.select("node", "label", "size", "own", F.posexplode("lead").alias("pos", "item"))
    return at.select("item.shingle", "node", "label", "size", (F.col("size") - F.col("own") - F.col("pos")).alias("reach"))


def _enough(reach_a: str, reach_b: str, size_a: str, size_b: str, percent: int) -> Column:
    """Whether sets of these sizes can be ``percent`` alike with a common part of at most these reaches."""
    most = F.least(F.col(reach_a), F.col(reach_b))
    return most * (100 + percent) >= (F.col(size_a) + F.col(size_b)) * percent


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "shingle"])


def _foremost(posts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, la, lb) of one node each of two components that share a shingle: those with the longest reach."""
    best = posts.groupBy("shingle", "label").agg(F.max(F.struct("reach", "node", "size")).alias("p")).select("shingle", "label", "p.*")
    met = _side(best, "a").join(_side(best, "b"), "shingle").where("label_a < label_b")
    met = met.where(_enough("reach_a", "reach_b", "size_a", "size_b", percent))
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("label_a").alias("la"), F.col("label_b").alias("lb")).distinct()


def _all_across(posts: DataFrame, percent: int) -> DataFrame:
    """Every pair (a, b, la, lb) of nodes of two components that share a shingle and have the reach.

    Components meet first, by their longest reach and smallest size, then the nodes of those that can: nodes of one
    component never meet.
    """
    groups = posts.groupBy("shingle", "label").agg(F.max("reach").alias("reach"), F.min("size").alias("size"))
    met = _side(groups, "a").join(_side(groups, "b"), "shingle").where("label_a < label_b")
    met = stage(met.where(_enough("reach_a", "reach_b", "size_a", "size_b", percent)).select("shingle", "label_a", "label_b", "reach_b", "size_b"), "met")
    half = met.join(_side(posts, "a"), ["shingle", "label_a"]).where(_enough("reach_a", "reach_b", "size_a", "size_b", percent))
    full = half.drop("reach_b", "size_b").join(_side(posts, "b"), ["shingle", "label_b"])
    full = full.where(_enough("reach_a", "reach_b", "size_a", "size_b", percent))
    return full.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("label_a").alias("la"), F.col("label_b").alias("lb")).distinct()


def _joined(df: DataFrame, merged: DataFrame) -> DataFrame:
    """``df`` with the labels that ``merged`` (node, label) has for its own."""
    step = merged.select(F.col("node").alias("label"), F.col("label").alias("merged"))
    return df.join(step, "label", "left").withColumn("label", F.coalesce("merged", "label")).drop("merged")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Components of the documents linked by a Jaccard similarity of ``percent`` (80 or more, as the bands are cut for 80).

    Words are the stretches without ASCII white space after lower-casing A-Z; a document's set has its distinct
    shingles of ``width`` words (see ``shingle_sets``). One row per row of ``docs``: ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest id that links lead to) and ``kept`` (it is the row's own).

    NULL and empty texts have no shingles and no links. Documents of equal sets are one node, so copies never meet in
    pairs, and only texts of nodes that share a band with another are moved. A row without id is linked with nothing:
    its ``component_id`` is NULL, and it is kept. Rows that repeat an id share its links. An empty table gives an empty
    result. Other columns are not read.

    Candidates are compared in three rounds. First each node of a band's bucket with the smallest node of the bucket, so
    a bucket of many copies costs as many comparisons as it has nodes. The nodes of buckets that still hold several
    components then meet by their rarest shingles (see ``_prefixes``), which two sets of ``percent`` must share: loosely
    similar texts do not, so a large group of them does not meet in all pairs. Of those that do, one node of each
    component goes first; most that can be linked are then, and the last round takes all pairs of nodes whose components
    are still apart. The rarest shingles lose no pair, a bucket misses one of similarity 0.8 with a probability near
    1e-7, and every link is verified on the full sets.
    """
    if percent < 80:
        raise ValueError("the bands find pairs of 80 percent and more")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage(signatures(rows, width), "signatures")
    linkable = signed.where("doc_id IS NOT NULL AND node IS NOT NULL")
    nodes = linkable.groupBy("node").agg(F.first("bands").alias("bands"))
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("most")).where("center <> most")
    members = stage(keys.join(shared.select("key", "center"), "key"), "members")

    wanted = members.select("node").distinct()
    holders = linkable.join(wanted, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    texts = stage(_with_nodes(rows.join(holders, "doc_id", "left_semi"), width).dropDuplicates(["node"]), "texts")

    def compared(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
        return stage(_compared(pairs.join(left, "a").join(right, "b"), width), "compared")

    linked = F.expr(f"100 * common >= {percent} * (na + nb - common)")
    def links(pairs: DataFrame) -> DataFrame:
        found = compared(pairs).where(linked).select("a", "b")
        return pairs.join(found, ["a", "b"]).select(F.col("la").alias("a"), F.col("lb").alias("b"))

    def merge(labels: DataFrame, merged: DataFrame) -> DataFrame:
        alone = merged.join(labels.select("node"), "node", "left_anti").select("node", "label")
        return stage(_joined(labels, merged).select("node", "label").unionAll(alone), "labels-all")

    stars = members.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    stars = compared(stars)
    labels = components(stars.where(linked).select("a", "b"))

    placed = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    mixed = placed.join(mixed.select("key"), "key").select("node", "label").distinct()
    posts = stage(_prefixes(stage(_sets(texts.join(mixed, "node"), width), "sets"), percent), "prefixes")

    known = stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for name, meet in (("foremost", _foremost), ("across", _all_across)):
        pairs = meet(posts, percent)
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "la", "lb")
        pairs = stage(pairs.join(known, ["a", "b"], "left_anti"), name)
        merged = components(links(pairs))
        labels, posts = merge(labels, merged), _joined(posts, merged)
        known = known.unionAll(pairs.select("a", "b"))

    placed_rows = (
        signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
        .join(labels, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("label", "node").alias("label"))
    )
    placed_rows = stage(placed_rows, "placed")
    smallest = placed_rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    smallest = stage(smallest, "smallest")  # so that a hot label can be split in the join
    return placed_rows.join(smallest, "label", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
