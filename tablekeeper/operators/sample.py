"""Leading rows: staged rollout samples and the TOP forms of T-SQL.

Orders are column names; a leading minus sign means descending.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import SMALL, keep_leading, sort_key


def prefix_sample(
    df: DataFrame, part: Sequence[str], order: Sequence[str], fraction: float, *, small: int = SMALL
) -> DataFrame:
    """First ``max(1, int(n * fraction))`` rows of each group, so a smaller fraction is a subset of a larger one.

    ``order`` must identify a row: only these columns are read to find the cut.
    """
    if fraction >= 1.0:
        return df

    def quota(n: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(n.cast("double") * F.lit(float(fraction))))

    return keep_leading(df, part, order, quota, unique=True, small=small)


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in order]


def top_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """``TOP n``: ties at the end are cut off in no fixed way unless the order is total."""
    return df.orderBy(*sort_columns(order)).limit(n)


def top_n_with_ties(
    df: DataFrame, n: int, order: Sequence[str], part: Sequence[str] = ()
) -> DataFrame:
    """``TOP n WITH TIES``, per group where ``part`` is given.

    Only the n-th sort key is ranked for, each task keeps at most n rows of a
    group for that; a filter then returns the rows, however many tie.
    """
    keyed = df.withColumn("_k", sort_key(df, order))
    if not part:
        last = keyed.select("_k").orderBy("_k").limit(n).agg(F.max("_k").alias("last"))
        return keyed.where(F.col("_k") <= last.scalar()).select(*df.columns)
    group = Window.partitionBy(*part).orderBy("_k")
    last = (
        keyed.select(*part, "_k").withColumn("_rn", F.row_number().over(group))
        .where(F.col("_rn") <= n).groupBy(*part).agg(F.max("_k").alias("_last"))
    )
    same = reduce(lambda a, b: a & b, [F.col(f"d.`{c}`").eqNullSafe(F.col(f"l.`{c}`")) for c in part])
    joined = keyed.alias("d").join(last.alias("l"), same & (F.col("d._k") <= F.col("l._last")))
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns])


def top_percent(
    df: DataFrame, percent: float, order: Sequence[str], part: Sequence[str] = (), *,
    unique: bool = False, small: int = SMALL,
) -> DataFrame:
    """``TOP p PERCENT``: the first ``ceil(n * p / 100)`` rows, overall or per group."""

    def quota(n: Column) -> Column:
        return F.ceil(n.cast("double") * F.lit(float(percent)) / F.lit(100.0))

    return keep_leading(df, part, order, quota, unique=unique, small=small)


def dependency_stage(column: Column, order: Sequence[str]) -> Column:
    """1-based place of a type in a fixed build order, 0 for types outside it."""
    return F.array_position(F.array(*[F.lit(o) for o in order]), column).cast("int")
