"""Quality classifier: histogram gradient-boosted trees over statistics of a document."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

SAMPLE_ROWS = 20_000
"""Labelled rows the model is fitted on at most: those with the smallest hash of the id, whatever the table's size."""
TREES, DEPTH, BINS, RATE, LEAF_ROWS, RIDGE = 120, 5, 64, 0.1, 10, 1.0
THRESHOLD = 0.3

_WORDS = tx.alphabet("nonspace")
_CLASSES = 12


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 6)  # other ASCII signs
    kind[0:32] = 10
    kind[127] = 10
    kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
    kind[[32, 9]], kind[[10, 13]] = 3, 4
    for c in b".,;:?'\"-()":
        kind[c] = 5
    kind[ord("!")] = 7
    kind[ord("|")] = 11
    kind[128:192], kind[192:256] = 8, 9  # continuation and first bytes of other characters
    return kind


_KIND = _byte_classes()
FEATURES = (
    "log_bytes", "log_words", "log_lines", "lower", "upper", "digit", "blank", "newline", "stop", "sign", "exclaim", "more",
    "first", "control", "bar", "mean_word", "sd_word", "short_words", "long_words", "distinct_words", "top_word",
    "distinct_pairs", "words_per_line", "distinct_lines", "short_lines", "sign_ends", "upper_words", "stop_ends",
)


def features(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Statistics of each row's text (rows x FEATURES); all are 0 for an empty text."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    kind = _KIND[raw]
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES)
    start, end, hashes, by_row = tx.words(raw, bounds, _WORDS)
    words, word_row = np.diff(by_row), tx.rows_of(by_row)
    some = np.maximum(words, 1)

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(word_row, values, minlength=n) / some

    length = end - start
    mean = per_word(length)
    last = kind[end - 1] if len(end) else end
    upper = np.concatenate([[0], np.cumsum(kind == 1)])
    all_upper = (upper[end] - upper[start]) * 2 > length
    seconds = hashes[1:] * tx.U64(0x9E3779B97F4A7C15) + hashes[:-1]
    pair_row = word_row[:-1]
    pairs = seconds[word_row[1:] == pair_row]
    pair_row = pair_row[word_row[1:] == pair_row]
    distinct, top = _distinct(hashes, word_row, n)
    pair_distinct, _ = _distinct(pairs, pair_row, n)
    line_start, line_end = tx.spans(raw != 10, bounds)
    line_row = np.searchsorted(bounds, line_start, "right") - 1
    lines = np.bincount(line_row, minlength=n)
    line_hash = tx.range_hash(tx.prefix_sums(_WORDS[1][raw]), line_start, line_end)
    line_distinct, _ = _distinct(line_hash, line_row, n)
    short = np.bincount(line_row[line_end - line_start < 30], minlength=n)
    total = np.maximum(size, 1)[:, None]
    share = counts[:, [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]] / total
    out = np.column_stack([
        np.log1p(size), np.log1p(words), np.log1p(lines), share, mean,
        np.sqrt(np.maximum(0, per_word(length.astype(float) ** 2) - mean**2)),
        per_word(length <= 3), per_word(length >= 12), distinct / some, top / some,
        pair_distinct / np.maximum(1, np.bincount(pair_row, minlength=n)), words / np.maximum(1, lines),
        line_distinct / np.maximum(1, lines), short / np.maximum(1, lines),
        per_word(last == 6), per_word(all_upper), per_word(last == 5),
    ])
    return out.astype(np.float32)


def _distinct(values: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values of each row and the count of the most frequent one."""
    if not len(values):
        return np.zeros(n), np.zeros(n)
    key = np.sort((tx.mix(values + row.astype(tx.U64) * tx.U64(0xA24BAED4963EE407)) >> tx.U64(24)) | (row.astype(tx.U64) << tx.U64(40)))
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    at = (key[edge] >> tx.U64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, at, np.diff(np.append(edge, len(key))))
    return np.bincount(at, minlength=n), top


@dataclass
class Trees:
    """Flattened trees: arrays over all nodes; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all rows go down all trees together, one level at a time."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(1))))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost TREES trees of DEPTH levels on the logistic loss, over at most BINS bins of each feature.

    Without rows of both labels the score is a constant: the share of label 1, or 0.5 without rows.
    """
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))

    def node(value: float) -> int:
        k = len(nodes["value"])
        for name, v in (("feature", 0), ("threshold", np.inf), ("left", k), ("right", k), ("value", value)):
            nodes[name].append(v)
        return k

    if len(y) and 0 < y.mean() < 1:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
        offset = np.arange(x.shape[1]) * BINS
        flat = binned + offset
        raw = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            roots.append(node(0.0))
            front = [(roots[-1], np.arange(len(y)), 0)]
            while front:
                k, mine, depth = front.pop()
                split = _best(flat[mine], g[mine], h[mine], x.shape[1]) if depth < DEPTH else None
                if split is None:
                    nodes["value"][k] = -RATE * float(g[mine].sum() / (h[mine].sum() + RIDGE))
                    raw[mine] += nodes["value"][k]
                    continue
                f, b = split
                nodes["feature"][k], nodes["threshold"][k] = f, float(cuts[f][b])
                low = binned[mine, f] <= b
                for side, rows in (("left", mine[low]), ("right", mine[~low])):
                    nodes[side][k] = child = node(0.0)
                    front.append((child, rows, depth + 1))
    return Trees(
        np.array(nodes["feature"], np.int64), np.array(nodes["threshold"], np.float32), np.array(nodes["left"], np.int64),
        np.array(nodes["right"], np.int64), np.array(nodes["value"], float), np.array(roots, np.int64), base,
    )


def _best(flat: np.ndarray, g: np.ndarray, h: np.ndarray, n_features: int) -> tuple[int, int] | None:
    """Feature and bin of the split with the largest gain, None if there is none."""
    size = n_features * BINS
    at = flat.ravel()

    def below(values: np.ndarray) -> np.ndarray:
        return np.bincount(at, np.repeat(values, n_features), minlength=size).reshape(n_features, BINS).cumsum(1)[:, :-1]

    gl, hl, nl = below(g), below(h), below(np.ones(len(g)))
    gt, ht = g.sum(), h.sum()
    gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
    gain[(nl < LEAF_ROWS) | (len(g) - nl < LEAF_ROWS)] = 0
    k = int(np.argmax(gain))
    return (k // (BINS - 1), k % (BINS - 1)) if gain.ravel()[k] > 1e-6 else None


# --- on DataFrames ---------------------------------------------------------------

def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Fit the trees on at most SAMPLE_ROWS labelled documents that are not held out.

    Rows without id or label, and ids with labels of both kinds, are left out. The sample's ids (bounded by
    SAMPLE_ROWS) are broadcast, and only its statistics, never texts, come to the driver.
    """
    sample = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).select("doc_id", "y")
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")

    def describe(batches):
        for batch in batches:
            for a, b, raw, bounds in tx.slices(tx.column(batch, "text")):
                x = features(raw, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), tx.lists(pa.array(x.ravel()), np.arange(len(x) + 1) * x.shape[1])],
                    ["doc_id", "y", "x"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", F.col("text"), F.col("y").cast("int").alias("y")).mapInArrow(describe, f"doc_id {kind}, y int, x array<float>")
    found = found.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) if found.num_rows else np.zeros((0, len(FEATURES)), np.float32)
    return fit(x, (found["y"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, probability of good quality) from its text alone; columns of that name give way.

    NULL and empty texts are scored by statistics of 0. Repeated rows are scored each by itself; there is no shuffle.
    """
    rows = docs.drop("score")
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            found = np.concatenate([
                np.zeros(0), *(trees.score(features(raw, bounds)) for _, _, raw, bounds in tx.slices(tx.column(batch, text_col)))
            ])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "score"])

    return rows.mapInArrow(run, schema)
