"""Near-duplicate lines: a segment-partition edit join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import small_side, spread_join
from ..sources.tables import stage
from . import text as tx

EDITS = 2
NEAR_CHARS = 20
"""In lines of fewer characters two edits change too much: they are copies of equal lines only."""
_VALUES = tx.alphabet("nonspace", fold=False)[1]
_NONSPACE = tx.alphabet("nonspace")[0]
_CELLS = 1 << 20
_SLICE = 1 << 18


def split_lines(raw: np.ndarray, bounds: np.ndarray):
    """Begin, end, row and number within the row of each line that is not blank, without outer white space."""
    start, end = tx.spans(raw != 10, bounds)
    solid = np.flatnonzero(_NONSPACE[raw])
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = b > a
    start, a, b = start[some], a[some], b[some]
    begin, stop = solid[a], solid[b - 1] + 1
    breaks = np.flatnonzero(raw == 10)
    row = np.searchsorted(bounds, start, "right") - 1
    number = np.searchsorted(breaks, start) - np.searchsorted(breaks, bounds[row])
    return begin, stop, row, number


def characters(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value and last byte of each UTF-8 character, and how many characters begin before each byte (and the end).

    Bytes that are no UTF-8 belong to the character before them in the same row.
    """
    lead = (raw & 0xC0) != 0x80
    lead[bounds[:-1][bounds[:-1] < len(raw)]] = True
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(lead, out=before[1:])
    if before[-1] == len(raw):
        return raw.astype(tx.U64), raw, before
    start = np.flatnonzero(lead)
    within = np.arange(len(raw)) - start[before[1:] - 1]
    shifted = raw.astype(tx.U64) << (8 * np.minimum(within, 7)).astype(tx.U64)
    return np.add.reduceat(shifted, start), raw[np.append(start[1:], len(raw)) - 1], before


def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(offset, size) of the edits + 1 segments of lines of such lengths, the longer ones last."""
    small, more = length // (edits + 1), length % (edits + 1)
    out, at = [], np.zeros_like(length)
    for i in range(edits + 1):
        size = small + (i >= edits + 1 - more)
        out.append((at, size))
        at = at + size
    return out


def _shifts(part: int, differ: int, edits: int) -> range:
    """Where a part met unchanged may stand: ``part`` edits at most before it, ``edits`` - part after it, ``differ`` in all."""
    return range(max(-part, differ - (edits - part)), min(part, differ + edits - part) + 1)


def line_keys(sums: np.ndarray, begin: np.ndarray, stop: np.ndarray, edits: int, deep: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index keys and probe keys of each line (lines x keys); 0 fills the places a line has no probe for.

    An index key names a length, a segment's number and the segment. A line probes the lengths from its own down to
    ``edits`` less with every substring that a segment of such a line could stand against: if the lines are within
    ``edits`` edits, then some segment i is met unchanged, with at most i edits before it and ``edits`` - i after it
    (take the first i up to whose segment there are no more than i edits). So it is shifted by at most i, seen from the
    left, and by at most ``edits`` - i against the difference of lengths, seen from the right.

    ``deep`` keys say the same of what is left on both sides: a rest within e edits is cut into e + 1 parts, one of
    which is met unchanged. A key then names the segment, a part of the left rest and a part of the right rest.
    """
    length = stop - begin

    def piece(tag: int, start, size):
        return tx.mix(tx.range_hash(sums, start, start + size) + tx.U64(tag))

    def key(of_length, i, start, size):
        return tx.mix(tx.range_hash(sums, start, start + size) + of_length.astype(tx.U64) * tx.U64(64) + tx.U64(i + 1))

    def met(base, left, right):
        """Keys of a segment with each part of both rests; parts are (hash, does it fit)."""
        return [
            np.where(a_fits & b_fits, tx.mix(base + a * tx.U64(3) + b * tx.U64(5)), tx.U64(0))
            for a, a_fits in left for b, b_fits in right
        ]

    always = np.ones(len(begin), bool)

    def cut(side: int, start, size, within: int):
        return [(piece(16 * side + j, start + at, n), always) for j, (at, n) in enumerate(segments(size, within))]

    def against(side: int, start, size, own, differ: int, within: int):
        """Substrings of the stretch of ``own`` characters that parts of a rest of ``size`` could stand against."""
        out = []
        for j, (at, n) in enumerate(segments(size, within)):
            for shift in _shifts(j, differ, within):
                fits = (at + shift >= 0) & (at + shift + n <= own)
                out.append((piece(16 * side + j, start + np.where(fits, at + shift, 0), np.where(fits, n, 0)), fits))
        return out

    index, probes = [], []
    for i, (at, size) in enumerate(segments(length, edits)):
        base = key(length, i, begin + at, size)
        if deep:
            index += met(base, cut(1, begin, at, i), cut(2, begin + at + size, length - at - size, edits - i))
        else:
            index.append(base)
    for less in range(edits + 1):
        shorter = length - less
        for i, (at, size) in enumerate(segments(shorter, edits)):
            for shift in _shifts(i, less, edits):
                start = at + shift
                fits = (start >= 0) & (start + size <= length) & (shorter > edits)
                start, size_ = np.where(fits, start, 0), np.where(fits, size, 0)
                base = key(shorter, i, begin + start, size_)
                if deep:
                    left = against(1, begin, np.where(fits, at, 0), start, shift, i)
                    rest = np.where(fits, shorter - at - size, 0)
                    right = against(2, begin + start + size_, rest, length - start - size_, less - shift, edits - i)
                    probes += [np.where(fits, found, tx.U64(0)) for found in met(base, left, right)]
                else:
                    probes.append(np.where(fits, base, tx.U64(0)))
    return np.column_stack(index), np.column_stack(probes)


def parities(last: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64 bits per line: is the number of characters of each kind (the last six bits) odd? An edit changes two bits at most."""
    bits = np.zeros(len(last) + 1, tx.U64)
    np.bitwise_xor.accumulate(tx.U64(1) << (last & 63).astype(tx.U64), out=bits[1:])
    return bits[stop] ^ bits[begin]


def within_edits(left: list[bytes], right: list[bytes], edits: int) -> np.ndarray:
    """Are the two UTF-8 strings of each pair at most ``edits`` edits of characters apart?

    Hyyrö's bit-parallel edit distance on the band of 2 * edits + 1 diagonals: each bit of a word is a cell of a
    column, and the pairs of a block go through the columns together.
    """
    left, m = _points(left)
    right, n = _points(right)
    out = np.zeros(len(left), bool)
    near = np.flatnonzero(np.abs(m - n) <= edits)
    near = near[np.argsort(n[near], kind="stable")]
    i = 0
    while i < len(near):
        j = i + 1
        while j < len(near) and (j + 1 - i) * (n[near[j]] + 3 * edits + 2) <= _CELLS:
            j += 1
        block = near[i:j]
        out[block] = _band([left[k] for k in block], [right[k] for k in block], m[block], n[block], edits) <= edits
        i = j
    return out


def _points(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    points, _, before = characters(np.frombuffer(b"".join(texts), np.uint8), bounds)
    at = before[bounds]
    points = points.astype(np.uint32)
    return [points[i:j] for i, j in zip(at[:-1], at[1:], strict=True)], np.diff(at)


def _band(left, right, m, n, edits):
    pairs, columns, width = len(m), int(n.max()), 2 * edits + 1

    def laid(texts, size, pad, shift, rows):
        out = np.full((rows, pairs), pad, np.uint32)
        data = np.concatenate(texts)
        out[tx.ragged(np.full(pairs, shift), size), np.repeat(np.arange(pairs), size)] = data
        return out

    a = laid(left, m, 256, edits, columns + 3 * edits + 2)  # row i + edits has the i-th character (from 0)
    b = laid(right, n, 257, 0, columns)
    mask = np.uint32((1 << width) - 1)
    vp = np.full(pairs, ((1 << width) - 1) & ~((1 << edits) - 1), np.uint32)
    vn = np.zeros(pairs, np.uint32)
    far = np.minimum(m, edits)
    for j in range(1, columns + 1):
        match = np.zeros(pairs, np.uint32)
        for k in range(width):
            match |= (a[j - 1 + k] == b[j - 1]).astype(np.uint32) << np.uint32(k)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & mask
        hp = (vn | ~(d0 | vp)) & mask
        hn = vp & d0
        place = m - j + edits  # bit of row m
        on_edge = place >= width - 1
        at = np.clip(place, 0, width - 1).astype(np.uint32)
        one = np.uint32(1)
        step = np.where(on_edge, one - ((d0 >> np.uint32(width - 1)) & one), (hp >> at) & one).astype(np.int64)
        step -= np.where(on_edge, 0, ((hn >> at) & one).astype(np.int64))
        far += np.where(j <= n, step, 0)
        down = d0 >> one
        vp, vn = (hn | ~(down | hp)) & mask, down & hp
    return far


# --- on DataFrames ---------------------------------------------------------------

def _lines(docs: DataFrame, extra: str, make) -> DataFrame:
    """One row per line: its hash, doc_id, copy (of the text), line_no and what ``make(slice of lines, their hashes)`` adds."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, copies = batch.column(0), batch.column(1)
            for a, b, raw, bounds in tx.slices(tx.column(batch, "text"), _SLICE):
                begin, stop, row, number = split_lines(raw, bounds)
                line = tx.range_hash(tx.prefix_sums(_VALUES[raw]), begin, stop)
                arrays, names = make(raw, bounds, begin, stop, line)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [_signed(line), ids.slice(a, b - a).take(take), copies.slice(a, b - a).take(take), pa.array(number), *arrays],
                    ["line", "doc_id", "copy", "line_no", *names],
                )

    return docs.mapInArrow(run, f"line long, doc_id {kind}, copy long, line_no long{extra}")


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _texts(raw, bounds, begin, stop, line):
    data = raw.tobytes()
    return [pa.array([data[i:j] for i, j in zip(begin, stop, strict=True)], pa.binary())], ["bytes"]


def _keyed(raw, bounds, begin, stop, edits, deep=False):
    """Parities and key lists of lines of NEAR_CHARS characters and more; NULL for shorter ones."""
    points, last, before = characters(raw, bounds)
    begin, stop = before[begin], before[stop]
    long = stop - begin >= NEAR_CHARS
    found = line_keys(tx.prefix_sums(tx.mix(points + tx.U64(1))), begin[long], stop[long], edits, deep)
    odd = np.zeros(len(long), np.int64)
    odd[long] = parities(last, begin[long], stop[long]).view(np.int64)
    lists = []
    for keys in found:
        ends = np.concatenate([[0], np.cumsum(np.where(long, keys.shape[1], 0))]).astype(np.int32)
        lists.append(pa.ListArray.from_arrays(pa.array(ends), _signed(keys.ravel())))
    return [pa.array(odd, mask=~long), *lists], ["odd", "segs", "probes"]


_KEYS = ", odd long, segs array<long>, probes array<long>"


def _place() -> F.Column:
    """Order of lines: by id (NULL last), then by number, then by a hash of the text they are in."""
    return F.struct(
        F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("y"), F.col("line_no").alias("z"), F.col("copy").alias("copy")
    )


def _copy(text_col: str) -> F.Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _shared(rows: DataFrame) -> DataFrame:
    """(key, line, of) of the keys that several lines have; ``of`` is 0 for index keys, 1 for probe keys.

    Each key's smallest and greatest index line are found first, so the probes, which are most of the rows, meet one row
    per key. A line's own index keys are among its probes: those rows stand for both kinds. A key with a single index
    line has that line's row from the others that probe it.
    """
    known = rows.select("line", F.explode("segs").alias("key")).groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high"))
    probes = rows.select("line", "segs", F.explode("probes").alias("key")).where("key <> 0")
    probes = probes.select("line", "key", F.array_contains("segs", F.col("key")).alias("own"))
    hits = stage(probes.join(known, "key").where("low <> high OR line <> low"), "line-hits")
    both = F.when(F.col("own"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    single = hits.where("low = high").select("key", F.col("low").alias("line"), F.lit(0).alias("of"))
    return hits.select("key", "line", F.explode(both).alias("of")).unionAll(single).distinct()


def _members(shared: DataFrame, numbers: DataFrame) -> DataFrame:
    """(no, odd, key, of, least, most, n): the last three are of the lines that have the key as the other kind."""
    rows = stage(shared.join(numbers, "line").select("no", "odd", "key", "of"), "line-shared")

    def kind(of: int, name: str) -> list[F.Column]:
        no = F.when(F.col("of") == of, F.struct("no", "odd"))
        return [F.min(no).alias(f"least_{name}"), F.max(no).alias(f"most_{name}"), F.count(no).alias(f"n_{name}")]

    keys = rows.groupBy("key").agg(*kind(0, "seg"), *kind(1, "probe"))
    of_other = [F.when(F.col("of") == 0, F.col(f"{c}_probe")).otherwise(F.col(f"{c}_seg")).alias(c) for c in ("least", "most", "n")]
    return stage(rows.join(keys, "key").select("no", "odd", "key", "of", *of_other).where("n > 0"), "line-members")


def _first_of_keys(members: DataFrame, edits: int) -> DataFrame:
    """(no, other): each line with the first one of each of its keys, if that is earlier and the parities allow it."""
    differ = F.bit_count(F.col("odd").bitwiseXOR(F.col("least.odd")))
    return members.where((F.col("least.no") < F.col("no")) & (differ <= 2 * edits)).select("no", F.col("least.no").alias("other"))


def _more(members: DataFrame) -> DataFrame:
    """Members with earlier lines at their key besides the first of these."""
    lone = (F.col("n") == 2) & (F.col("most.no") == F.col("no"))
    return members.where((F.col("least.no") < F.col("no")) & (F.col("n") > 1) & ~lone)


def _listed(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """(no) of the (no, other) pairs that are near."""
    pairs = stage(pairs.distinct(), "line-pairs")
    targets = texts.select(F.col("no").alias("other"), F.col("bytes").alias("y"))
    targets = stage(targets.join(pairs.select("other").distinct(), "other", "left_semi"), "line-targets")
    own = pairs.join(texts.select("no", F.col("bytes").alias("x")), "no")
    marked = small_side(targets)
    both = own.join(marked, "other") if marked is not targets else spread_join(own, targets, ["other"], salt_by=["no"], how="inner")

    def compare(batches):
        for batch in batches:
            near = within_edits(batch.column(1).to_pylist(), batch.column(2).to_pylist(), edits)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["no"]).filter(pa.array(near))

    return stage(both.select("no", "x", "y").mapInArrow(compare, "no long").distinct(), "line-listed")


def _near_earlier(rows: DataFrame, scan: DataFrame, entries: DataFrame, edits: int) -> DataFrame:
    """(line) of the lines that are within ``edits`` edits of a line with an earlier first place.

    One such line is enough. So a line is compared with the first one of each of its keys, and what is near is settled:
    as many comparisons as there are keys. Lines not settled go on with the lines of keys that hold more than that: all
    of them get deep keys, are compared with the first of these, and what is left then with all earlier ones of a deep
    key whose parities allow so few edits. Settled lines ask no more, but others may still be near to them.
    """
    shared = stage(_shared(scan.select("line", "segs", "probes")), "line-keys")
    lines = shared.select("line").distinct().join(scan.select("line", "odd"), "line").groupBy("line").agg(F.max("odd").alias("odd"))
    ordered = lines.join(entries.select("line", "first"), "line").repartitionByRange("first").sortWithinPartitions("first")
    numbers = stage(ordered.select("line", "odd", F.monotonically_increasing_id().alias("no")), "line-numbers")
    members = _members(shared, numbers)

    firsts = stage(_first_of_keys(members, edits).distinct(), "line-firsts")
    deep = members.join(_more(members).select("key").distinct(), "key", "left_semi").select("no").distinct()
    wanted = firsts.select("no").unionAll(firsts.select("other")).unionAll(deep).distinct()
    wanted = stage(numbers.join(wanted, "no").select("line", "no"), "line-wanted")
    texts = _lines(rows, ", bytes binary", _texts).select("line", "bytes").join(small_side(wanted), "line")
    texts = stage(texts.groupBy("no").agg(F.first("line").alias("line"), F.first("bytes").alias("bytes")), "line-texts")
    settled = _listed(firsts, texts, edits)

    asking = _more(members).join(settled, "no", "left_anti").select("key").distinct()
    deeper = members.join(asking, "key", "left_semi").select("no").distinct()

    def keyed(batches):
        for batch in batches:
            for a, b, raw, bounds in tx.slices(batch.column(1), _SLICE):
                arrays, names = _keyed(raw, bounds, bounds[:-1], bounds[1:], edits, deep=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *arrays], ["line", *names])

    deeper = texts.join(deeper, "no", "left_semi").select("line", "bytes")
    deeper = stage(deeper.mapInArrow(keyed, f"line long{_KEYS}"), "line-deep")
    members = _members(_shared(deeper), numbers)
    again = _listed(_first_of_keys(members, edits).join(settled, "no", "left_anti"), texts, edits)
    settled = stage(settled.unionAll(again), "line-settled")
    asking = _more(members).join(settled, "no", "left_anti").select("no", "odd", "key", "of")
    others = members.select(F.col("no").alias("other"), F.col("odd").alias("other_odd"), F.col("key").alias("other_key"), F.col("of").alias("other_of"))
    differ = F.bit_count(F.col("odd").bitwiseXOR(F.col("other_odd")))
    same_key = (F.col("key") == F.col("other_key")) & (F.col("of") + F.col("other_of") == 1)
    rest = asking.join(others, same_key & (F.col("other") < F.col("no")) & (differ <= 2 * edits))
    settled = settled.unionAll(_listed(rest.select("no", "other"), texts, edits))
    return numbers.join(settled, "no", "left_semi").select("line")


def duplicate_lines(docs: DataFrame, edits: int = EDITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no) of each line that an earlier line is within ``edits`` edits of.

    Lines are what line breaks part, without outer white space; blank ones are never listed. Edits are counted on
    characters, between lines of NEAR_CHARS characters and more; a shorter line is listed if an earlier one equals it.
    "Earlier" is by id, then by line number (from 0); rows without id come last. So of equal lines the first stays,
    unless an earlier line is nearly equal; whether that one stays itself does not matter, so the result depends on no
    order of work.

    NULL and empty texts have no lines. Rows that repeat id and text are one place: where their lines are first, all
    keep them. Rows of one id (or of none) with different texts are told apart by a hash of the text; where their lines
    are equal and at one number, the smallest hash is the earlier. An empty table gives an empty result. Other columns are not read.

    Equal lines are one entry (by a 64-bit hash); those that share a key are numbered by first place. A very frequent line
    meets others once. Only 8-byte keys and numbers are joined; texts are moved only to be compared, and only those of
    lines that share a key, as long as the list of these is small enough to broadcast.
    """
    return _repeats(docs, edits, id_col, text_col).select("doc_id", "line_no").distinct()


def _repeats(docs: DataFrame, edits: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, copy (hash of the text) and line_no of each line that duplicate_lines() lists; rows may repeat."""
    rows = docs.select(F.col(id_col).alias("doc_id"), _copy(text_col).alias("copy"), F.col(text_col).alias("text"))

    def keyed(raw, bounds, begin, stop, line):
        """Keys of the first of equal lines of a slice."""
        first = np.zeros(len(line), bool)
        first[np.unique(line, return_index=True)[1]] = True
        arrays, names = _keyed(raw, bounds, begin[first], stop[first], edits)
        at = np.cumsum(first) - 1
        return [a.take(pa.array(at, mask=~first)) for a in arrays], names

    scan = stage(_lines(rows, _KEYS, keyed), "line-scan")
    entries = scan.groupBy("line").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"))
    entries = stage(entries, "line-entries")
    near = _near_earlier(rows, scan, entries, edits).withColumn("near", F.lit(True))

    # of a line without a near earlier one, all places but the first are listed
    limits = entries.join(near, "line", "left").where("n > 1 OR near")
    limits = stage(limits.select("line", "first", "near"), "line-limits")  # so that a hot line can be split in the join
    places = scan.select("line", "doc_id", "copy", "line_no").join(limits, "line")
    return places.where((_place() > F.col("first")) | F.col("near")).select("doc_id", "copy", "line_no")


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    def cut(text: str, numbers: list[int] | None) -> str:
        lines, left_out = text.split("\n"), set(numbers or ())
        return "\n".join(line for k, line in enumerate(lines) if k not in left_out)

    return pa.array([t if n is None else cut(t, n) for t, n in zip(texts.to_pylist(), gone.to_pylist(), strict=True)], pa.string())


_without = _without.asNondeterministic()
"""So a filter on the new texts does not run it a second time, in a second Python worker beside the first."""


def remove_lines(docs: DataFrame, edits: int = EDITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines of ``duplicate_lines``; ``removed_lines`` (long) is added, or replaces its like.

    Rows, ids and all other columns stay, whatever their names. A text that loses no line stays as it is, and so do NULL
    and empty texts; an empty table stays empty. Line numbers are of one id and text, so neither rows without id nor
    those that repeat one lose lines of each other.
    """
    listed = _repeats(docs, edits, id_col, text_col).groupBy("doc_id", "copy").agg(F.collect_set("line_no").alias("gone"))
    columns = [c for c in docs.columns if c != "removed_lines"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(id_col).alias("id"), _copy(text_col).alias("of")
    )
    joined = rows.join(listed, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("copy")), "left")
    text = F.col("row").getField(text_col)
    return joined.select(
        *[(_without(text, F.col("gone")) if c == text_col else F.col("row").getField(c)).alias(c) for c in columns],
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed_lines"),
    )
