"""Slowly changing dimension, type 2: history kept as half-open validity windows.

A history relation holds business columns plus ``start``, ``end`` and a
``current`` flag. The open version of a key ends at ``OPEN_END``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import assert_unique, free_name, null_safe

# Fixed values.
OPEN_END = "9999-12-31 23:59:59.999"
OPEN_FROM = "9999-12-31"
AUDIT_PREFIX = "ETL_"


@dataclass(frozen=True)
class Window:
    """Names of the three columns that make a relation a history."""

    start: str = "valid_from"
    end: str = "valid_to"
    current: str = "IsCurrent"

    @property
    def columns(self) -> list[str]:
        return [self.start, self.end, self.current]


def is_audit(name: str) -> bool:
    return name.upper().startswith(AUDIT_PREFIX)


def scd2_columns(columns: Sequence[dict], key: Sequence[str]) -> dict[str, list[str]]:
    """Column roles from column metadata (``name``, ``identity``, ``row_start``, ``row_end``).

    ``business`` are the source columns, ``track`` those whose change makes a
    new version: no key, period, identity or audit column.
    """
    business = [
        c["name"] for c in columns if not (c.get("row_start") or c.get("row_end") or c.get("identity"))
    ]
    track = [c for c in business if c not in key and not is_audit(c)]
    period = [c["name"] for c in columns if c.get("row_start")] + [c["name"] for c in columns if c.get("row_end")]
    return {"business": business, "track": track, "insert": [*business, *period, "IsCurrent"]}


def scd2_schema(columns: Sequence[dict]) -> T.StructType:
    """Schema of the history kept for a table described by ``columns``.

    Period columns become TIMESTAMP NOT NULL, an identity column BIGINT, and
    ``IsCurrent`` is added. ``type`` holds a Spark type name.
    """
    fields = []
    for c in columns:
        if c.get("row_start") or c.get("row_end"):
            fields.append(T.StructField(c["name"], T.TimestampType(), False))
        elif c.get("identity"):
            fields.append(T.StructField(c["name"], T.LongType(), not c.get("not_null")))
        else:
            kind = T.DataType.fromDDL(c["type"])
            fields.append(T.StructField(c["name"], kind, not c.get("not_null")))
    fields.append(T.StructField("IsCurrent", T.BooleanType(), False))
    return T.StructType(fields)


def _at(value, like: T.DataType) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast(like)


def open_history(
    source: DataFrame, effective_at, *, window: Window = Window(), time_type: str = "timestamp_ntz"
) -> DataFrame:
    """First load: every source row becomes an open version."""
    kind = T.DataType.fromDDL(time_type)
    return source.select(
        "*",
        _at(effective_at, kind).alias(window.start),
        _at(OPEN_END, kind).alias(window.end),
        F.lit(True).alias(window.current),
    )


def scd2_step(
    current: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    track: Sequence[str],
    effective_at,
    *,
    window: Window = Window(),
    deletes: str = "keep",
    check: bool = True,
) -> DataFrame:
    """Versions of the open rows after one source snapshot: kept, closed and new ones.

    One null-safe full outer join of two relations that are unique on the key,
    so no join partition can grow with a hot key. Each joined pair emits its
    old version (closed if a tracked column changed) and, where the source
    brings a new state, the new open version.
    """
    if deletes not in ("keep", "close"):
        raise ValueError("deletes must be 'keep' or 'close'")
    if check:
        assert_unique(source, key, "scd2 source")
        assert_unique(current, key, "open versions")
    schema = current.schema
    at = _at(effective_at, schema[window.start].dataType)
    forever = _at(OPEN_END, schema[window.end].dataType)

    hit = free_name("hit", current, source)
    t, s = current.withColumn(hit, F.lit(True)).alias("t"), source.withColumn(hit, F.lit(True)).alias("s")
    was, now = F.col(f"t.{hit}").isNotNull(), F.col(f"s.{hit}").isNotNull()
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"t.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in track],
        F.lit(False),
    )
    changed = was & now & differs
    closes = (changed | (was & ~now)) if deletes == "close" else changed
    backwards = closes & (at < F.col(f"t.`{window.start}`"))
    end_of_old = F.when(
        backwards, F.raise_error(F.lit("scd2: effective time lies before the start of an open version"))
    ).when(closes, at)

    def old(field: T.StructField) -> Column:
        column = F.col(f"t.`{field.name}`")
        if field.name == window.end:
            return F.coalesce(end_of_old.cast(field.dataType), column)
        if field.name == window.current:
            return column & ~closes
        return column

    def new(field: T.StructField) -> Column:
        if field.name == window.start:
            return at
        if field.name == window.end:
            return forever
        if field.name == window.current:
            return F.lit(True)
        if field.name in source.columns:
            return F.col(f"s.`{field.name}`").cast(field.dataType)
        return F.lit(None).cast(field.dataType)

    def version(make) -> Column:
        return F.struct(*[make(f).cast(f.dataType).alias(f.name) for f in schema])

    versions = F.array_compact(
        F.array(
            F.when(was, version(old)),
            F.when(now & (~was | changed), version(new)),
        )
    )
    joined = t.join(s, null_safe("t", "s", key), "full_outer")
    return joined.select(F.explode(versions).alias("v")).select("v.*")


def scd2_apply(
    dim: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    track: Sequence[str],
    effective_at,
    *,
    window: Window = Window(),
    deletes: str = "keep",
    check: bool = True,
) -> DataFrame:
    """History after one snapshot. Closed versions (also those whose flag is NULL) pass by the join untouched.

    Keys absent from the source stay open unless ``deletes="close"``; applying
    the same snapshot twice changes nothing.
    """
    is_open = F.coalesce(F.col(window.current), F.lit(False))
    current, closed = dim.where(is_open), dim.where(~is_open)
    step = scd2_step(
        current, source, key, track, effective_at, window=window, deletes=deletes, check=check
    )
    return closed.unionByName(step)


def scd2_backfill(current: DataFrame, history: DataFrame, *, window: Window = Window()) -> DataFrame:
    """Fold old history rows in: union of both, open where the window never ends."""
    return current.unionByName(history).withColumn(
        window.current, F.col(window.end) >= F.lit(OPEN_FROM).cast(current.schema[window.end].dataType)
    )


def scd2_changes(
    before: DataFrame, after: DataFrame, key: Sequence[str], *, window: Window = Window()
) -> DataFrame:
    """Row changes between two states of a history, one row per image.

    ``_change_type`` is insert, delete, update_preimage or update_postimage.
    """
    row_key = [*key, window.start]
    names = [c for c in before.columns if c not in row_key]
    hit = free_name("hit", before)
    b = before.withColumn(hit, F.lit(True)).alias("b")
    a = after.select(*before.columns).withColumn(hit, F.lit(True)).alias("a")
    was, now = F.col(f"b.{hit}").isNotNull(), F.col(f"a.{hit}").isNotNull()
    differs = reduce(
        lambda x, y: x | y,
        [~F.col(f"b.`{c}`").eqNullSafe(F.col(f"a.`{c}`")) for c in names],
        F.lit(False),
    )

    def image(side: str, kind: str) -> Column:
        return F.struct(
            *[F.col(f"{side}.`{c}`").alias(c) for c in before.columns], F.lit(kind).alias("_change_type")
        )

    images = F.array_compact(
        F.array(
            F.when(was & ~now, image("b", "delete")),
            F.when(~was & now, image("a", "insert")),
            F.when(was & now & differs, image("b", "update_preimage")),
            F.when(was & now & differs, image("a", "update_postimage")),
        )
    )
    joined = b.join(a, null_safe("b", "a", row_key), "full_outer")
    return joined.select(F.explode(images).alias("v")).select("v.*")
