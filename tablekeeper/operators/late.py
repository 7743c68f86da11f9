"""Snapshots that arrive after later ones: spliced into the windows of a history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage
from .joins import assert_unique, null_safe
from .scd2 import OPEN_END, Window


def scd2_splice(
    dim: DataFrame, source: DataFrame, key: Sequence[str], track: Sequence[str], effective_at, *, later: DataFrame | None = None,
    later_at: str = "at", window: Window = Window(), check: bool = True,
) -> DataFrame:
    """History as if the snapshot ``source`` had been applied at ``effective_at``, before those that were applied since.

    ``later`` holds the rows of the snapshots after ``effective_at`` that are in the history already, with their time in
    ``later_at``; of its other columns the key and those that ``dim`` has are read. It tells when an unchanged state was
    seen again: a window that the snapshot cuts goes on from there. Without it a new state lasts until the next version.

    The window of a key that holds the time is cut if its tracked columns differ: the old state ends, the new one lasts
    until the key was next seen, and then the old one returns, or the next version follows. If that has the new state
    already, the two are one version with the columns of the earlier. Keys without a window at the time get one up to
    their next version. Keys that ``source`` lacks stay as they are; the history is one kept without deletes.

    Keys may be NULL and match each other. Twice the same snapshot changes nothing. Repeated keys in ``source`` are an
    error, also windows of a key that overlap at the time (``check``). Empty sides give what there is to keep. Columns may
    have any names.

    Windows that ended before pass by. The others meet the snapshot once: the window at the time, the next version and
    the next sight of a key are one row per key each, found by aggregation on the map side, so no key can make a task
    large. Only the row that a merge replaces is taken out of the later windows by a join.
    """
    fields = [f.name for f in dim.schema]
    start, end, current = (F.col(f"`{c}`") for c in window.columns)
    kind = dim.schema[window.start].dataType
    at = (effective_at if isinstance(effective_at, Column) else F.lit(effective_at)).cast(kind)
    forever = F.lit(OPEN_END).cast(dim.schema[window.end].dataType)
    keys = [f"k{i}" for i in range(len(key))]

    def keyed(df: DataFrame, *columns: Column) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(key, keys, strict=True)], *columns)

    def packed(df: DataFrame, name: str) -> Column:
        """The columns of the history as one struct, those that ``df`` lacks as NULL."""
        has = {c.lower() for c in df.columns}
        return F.struct(
            *[(F.col(f"`{f.name}`") if f.name.lower() in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema]
        ).alias(name)

    holds = (start <= at) & (at < end)
    past, held, future = dim.where(end.isNotNull() & (end <= at)), dim.where(holds), dim.where(start > at)
    rest = dim.where(start.isNull() | end.isNull())
    if check:
        assert_unique(source, key, "late snapshot")
        assert_unique(held, key, "windows at the time")

    def first(df: DataFrame, time: Column, name: str) -> DataFrame:
        rows = keyed(df, packed(df, "row"), time.cast(kind).alias("time"))
        return rows.groupBy(*keys).agg(F.min_by("row", "time").alias(name), F.min("time").alias(f"{name}_at"))

    upcoming = first(future.where(end > start), start, "f")
    joined = (
        keyed(held, packed(held, "h")).alias("a").join(keyed(source, packed(source, "s")).alias("b"), null_safe("a", "b", keys), "full_outer")
        .select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys], "h", "s").alias("a")
        .join(upcoming.alias("b"), null_safe("a", "b", keys), "left").select("a.*", "f", "f_at")
    )
    if later is None:
        joined = joined.withColumns({"n": F.lit(None).cast(dim.schema), "n_at": F.lit(None).cast(kind)})
    else:
        seen = first(later.where(F.col(f"`{later_at}`").cast(kind) > at), F.col(f"`{later_at}`"), "n")
        joined = joined.alias("a").join(seen.alias("b"), null_safe("a", "b", keys), "left").select("a.*", "n", "n_at")

    def alike(x: str, y: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"{x}.`{c}`").eqNullSafe(F.col(f"{y}.`{c}`")) for c in track], F.lit(True))

    def window_of(row: str, since: Column, until: Column, is_open: Column) -> Column:
        made = {window.start: since, window.end: until, window.current: is_open}
        return F.struct(*[made.get(f.name, F.col(f"{row}.`{f.name}`")).cast(f.dataType).alias(f.name) for f in dim.schema])

    was, now = F.col("h").isNotNull(), F.col("s").isNotNull()
    enters = now & (~was | ~alike("h", "s"))
    h_start, h_end, h_open = (F.col(f"h.`{c}`") for c in window.columns)
    until = F.least(F.coalesce(h_end, forever), F.col("f_at"), F.col("n_at"))
    merges = F.coalesce(enters & (F.col("f_at") == until) & alike("s", "f"), F.lit(False))
    returns = F.coalesce(was & enters & (F.col("n_at") < h_end), F.lit(False))
    again = F.when(returns, window_of("n", F.col("n_at"), h_end, h_open))
    pieces = F.array_compact(
        F.array(
            F.when(was & ~enters, F.col("h")),
            F.when(was & enters, window_of("h", h_start, at, F.lit(False))),
            F.when(merges, window_of("s", at, F.col(f"f.`{window.end}`"), F.col(f"f.`{window.current}`"))),
            F.when(enters & ~merges, window_of("s", at, until, until == forever)),
            again,
        )
    )
    done = stage(joined.select(*keys, pieces.alias("v"), F.when(merges, F.col("f_at")).alias("merged")), "spliced")
    taken = done.where("merged IS NOT NULL").select(*keys, "merged")
    kept = (
        keyed(future, packed(future, "row"), F.when(end > start, start).alias("since")).alias("a")
        .join(taken.alias("b"), null_safe("a", "b", keys) & (F.col("a.since") == F.col("b.merged")), "left_anti").select("row.*")
    )
    spliced = done.select(F.explode("v").alias("v")).select("v.*")
    return reduce(DataFrame.unionAll, [part.select(*[f"`{c}`" for c in fields]) for part in (spliced, kept, rest)], past)
