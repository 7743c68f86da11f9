"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: Sequence[str], what: str, *, skip_null: bool = False) -> None:
    """Raise when a key occurs twice.

    Reads the key columns only and counts map-side first, so a key that holds
    a large share of the rows costs no more than any other.
    """
    rows = df.select(*keys)
    if skip_null:
        rows = rows.dropna(how="any")
    found = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if found:
        raise ValueError(f"{what}: key {tuple(found[0])[:-1]} occurs {found[0]['count']} times")


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """``left.k <=> right.k`` for every key, for two aliased DataFrames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys],
    )


def free_name(base: str, *dfs: DataFrame) -> str:
    """``base``, made longer until no column of the DataFrames has the name in any case."""
    taken = {c.lower() for df in dfs for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


PER_SALT = 1_000_000
"""Rows of one key that one task takes."""


def spread_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], *, salt_by: Sequence[str], how: str = "left",
    per_salt: int = PER_SALT,
) -> DataFrame:
    """Left or inner equi join for a left side in which a key (or NULL) may hold most rows.

    Rows with a NULL key match nothing and bypass the join. Keys are counted first (map-side); one with more than
    ``per_salt`` rows gets as many salts as it has shares of that size, which its left rows draw from their ``salt_by``
    columns (an id), and only such keys of the right side - unique on ``on`` - are repeated. There is at most one such
    key per ``per_salt`` rows, so their list is broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in on])
    named = left.where(whole)
    rows, many, one = (free_name(name, left, right) for name in ("rows", "salts", "salt"))
    counts = named.groupBy(*on).agg(F.count(F.lit(1)).alias(rows)).where(F.col(rows) > per_salt)
    hot = counts.select(*on, F.ceil(F.col(rows) / per_salt).cast("int").alias(many))
    salts = F.coalesce(many, F.lit(1))
    salted = named.join(F.broadcast(hot), list(on), "left").withColumn(one, F.pmod(F.xxhash64(*salt_by), salts).cast("int")).drop(many)
    repeated = right.join(F.broadcast(hot), list(on), "left").withColumn(one, F.explode(F.sequence(F.lit(0), salts - 1))).drop(many)
    joined = salted.join(repeated, [*on, one], how).drop(one)
    if how == "inner":
        return joined
    return joined.unionByName(left.where(~whole), allowMissingColumns=True)


MARK_BYTES = 8 << 20


def small_side(keys: DataFrame, limit: int = MARK_BYTES) -> DataFrame:
    """Broadcast a side whose bytes, as counted now, stay below ``limit``; a larger one is left to adaptive execution."""
    size = keys.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + F.lit(32))).first()[0] or 0
    return F.broadcast(keys) if size <= limit else keys
