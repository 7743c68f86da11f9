"""Whole Arrow string columns as byte arrays: row slices, words and their 64-bit hashes, without a loop over rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
"""Rows are handled in slices of about so many bytes; a longer text is a slice of its own."""

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The named string column; nulls are empty."""
    values = batch.column(batch.schema.get_field_index(name))
    return values.fill_null("") if values.null_count else values


def slices(values: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row bounds within these bytes) for consecutive rows."""
    if not len(values):
        return
    large = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(values):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


_kept: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base and its inverse to the powers 0 .. n, at least. The longest asked for so far are kept."""
    if len(_kept[0]) <= n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(1 << max(16, int(n).bit_length()), base, U64)
            steps[0] = 1
            _kept[i] = np.cumprod(steps, dtype=U64)
    return _kept[0], _kept[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value times base to the position; range_hash() takes a hash of any stretch from them."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end]; equal stretches have equal hashes wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(U64))


def alphabet(word: str, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Byte tables: is it part of a word (``word``: 'alnum' ASCII letters and digits, 'nonspace'), and its hash value.

    Bytes from 0x80 on always belong to words. ``fold`` gives A-Z the values of a-z.
    """
    b = np.arange(256)
    letter = (b >= 97) & (b <= 122) | (b >= 65) & (b <= 90)
    if word == "alnum":
        inside = letter | (b >= 48) & (b <= 57) | (b >= 128)
    else:
        inside = ~((b == 32) | (b >= 9) & (b <= 13))
    values = mix(np.arange(1, 257, dtype=U64) * U64(0xA24BAED4963EE407))
    if fold:
        values = values.copy()
        values[65:91] = values[97:123]
    return inside, values


def spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each longest stretch of True that stays within one row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[bounds] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:-1]
    end[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def words(raw: np.ndarray, bounds: np.ndarray, tables: tuple[np.ndarray, np.ndarray]):
    """Start, end, hash and row of every word; bounds of the rows within the words."""
    inside, values = tables
    start, end = spans(inside[raw], bounds)
    hashes = range_hash(prefix_sums(values[raw]), start, end)
    by_row = np.searchsorted(start, bounds)
    return start, end, hashes, by_row


def rows_of(by_row: np.ndarray) -> np.ndarray:
    """Row number of each element, from the bounds of the rows."""
    return np.repeat(np.arange(len(by_row) - 1), np.diff(by_row))


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each length, one after the other."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.arange(total) + np.repeat(start - before, length)


def lists(values: pa.Array, bounds: np.ndarray) -> pa.ListArray:
    """List column whose row i is values[bounds[i]:bounds[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
