"""Keyed table maintenance: merge, append of new keys, replace by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import assert_unique, free_name, null_safe, small_side


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_exprs: Mapping[str, Column],
    *,
    target_pred: Column | None = None,
    check: bool = True,
) -> DataFrame:
    """MERGE with a matched-update branch only.

    ``set_exprs`` maps target columns to expressions over the aliases ``t``
    (target row) and ``s`` (source row), e.g. ``{"attempt": F.col("t.attempt") + 1}``.
    ``target_pred`` limits the rows that can match. Keys compare with ``=``, so
    NULL keys never match and such target rows pass by the join. The source must be unique on ``keys``.
    """
    if check:
        assert_unique(source, keys, "merge source", skip_null=True)
    unknown = set(set_exprs) - set(target.columns)
    if unknown:
        raise ValueError(f"not in target: {sorted(unknown)}")
    whole = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    t, mark = target.where(whole).alias("t"), free_name("hit", source)
    s = source.withColumn(mark, F.lit(True)).alias("s")
    on = F.lit(True) if target_pred is None else target_pred
    for k in keys:
        on = on & (F.col(f"t.`{k}`") == F.col(f"s.`{k}`"))
    hit = F.col(f"s.{mark}").isNotNull()

    def cell(field) -> Column:
        old = F.col(f"t.`{field.name}`")
        if field.name not in set_exprs:
            return old.alias(field.name)
        new = set_exprs[field.name].cast(field.dataType)
        return F.when(hit, new).otherwise(old).alias(field.name)

    return t.join(s, on, "left").select(*[cell(f) for f in target.schema]).unionByName(target.where(~whole))


def append_new(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus those rows whose key it does not hold yet; a NULL key is held like any other."""
    return target.unionByName(new_rows(target, rows, keys), allowMissingColumns=True)


def new_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows ``append_new`` adds; what to write when the target is a stored table."""
    held = target.select(*keys).distinct().alias("h")
    return rows.alias("r").join(held, null_safe("r", "h", keys), "left_anti").select(*rows.columns)


def replace_where(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows of every key value in ``rows``, then insert ``rows``.

    Few key values are broadcast, so whole target rows are not shuffled by a key of few values.
    """
    gone = small_side(rows.select(*keys).distinct())
    kept = target.join(gone, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(rows, allowMissingColumns=True)


def union_parts(spark, parts: Sequence[DataFrame], schema) -> DataFrame:
    """UNION ALL of the parts by column name; an empty relation of ``schema`` if there are none."""
    merged = None
    for part in parts:
        merged = part if merged is None else merged.unionByName(part)
    return spark.createDataFrame([], schema) if merged is None else merged
