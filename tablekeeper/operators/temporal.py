"""Facts joined to the version of a history that was valid at their time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import PER_SALT
from .scd2 import Window

TIME_BUCKETS = 64
"""The time of a key with more than ``per_task`` facts or versions is cut into so many stretches."""
_DAY = "timestamp_ntz"


def as_of(history: DataFrame, instant, window: Window = Window()) -> DataFrame:
    """The versions valid at ``instant``: start <= instant < end; an end of NULL is open, a start of NULL is never valid."""
    at = F.lit(instant).cast(history.schema[window.start].dataType)
    start, end = F.col(f"`{window.start}`"), F.col(f"`{window.end}`")
    return history.where((start <= at) & (end.isNull() | (at < end)))


def temporal_join(
    facts: DataFrame, history: DataFrame, on: Sequence[str], at: str, *, how: str = "left", window: Window = Window(), prefix: str = "",
    per_task: int = PER_SALT, buckets: int = TIME_BUCKETS,
) -> DataFrame:
    """Each fact with the history rows of its key that were valid at its time ``at``: start <= at < end.

    Result: the columns of ``facts``, then those of ``history`` but the key columns ``on``, their names after ``prefix``;
    names that would occur twice are an error. ``how`` is 'left' (facts without a valid row stay, with NULLs) or 'inner'.
    Windows of one key may overlap: a fact meets each row that is valid once. An end of NULL is open. Facts with NULL in
    a key column or in ``at``, and rows with a NULL key or start, meet nothing. Repeated rows meet like others; empty
    sides give what the join gives.

    Keys are counted on both sides, map-side. The time of a key with more than ``per_task`` rows is cut into ``buckets``
    stretches of days, and its windows are repeated in each stretch that they touch; if it has so many facts that a
    stretch may be too large still (all may be of one day), these draw salts and the windows are repeated for each.
    A fact is in one stretch and has one salt, so it meets a row once at most. All other keys have one stretch and are
    not repeated. There is at most one such key per ``per_task`` rows, so their list is broadcast.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    brought = [c for c in history.columns if c not in on]
    names = [*facts.columns, *[prefix + c for c in brought]]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("a column of the history has the name of one of the facts; give a prefix")

    keys = [f"k{i}" for i in range(len(on))]

    def packed(df: DataFrame, **more: Column) -> DataFrame:
        """The whole row as one struct beside the helper columns, so that no name of the user's is in the way."""
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
        return df.select(row, *[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)], *[c.alias(n) for n, c in more.items()])

    def day(time: Column) -> Column:
        return F.datediff(time.cast(_DAY).cast("date"), F.lit("1970-01-01").cast("date"))

    left = packed(facts, at=F.col(f"`{at}`").cast(_DAY))
    right = packed(history, start=F.col(f"`{window.start}`").cast(_DAY), end=F.col(f"`{window.end}`").cast(_DAY))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    named, right = left.where(whole & F.col("at").isNotNull()), right.where(whole & F.col("start").isNotNull())

    counts = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("facts"), F.min(day(F.col("at"))).alias("low"), F.max(day(F.col("at"))).alias("high"))
    versions = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"))
    counts = counts.join(versions, keys, "left").where((F.col("facts") > per_task) | (F.col("versions") > per_task))
    hot = counts.select(
        *keys, F.ceil(F.col("facts") / per_task).cast("int").alias("salts"), "low",
        F.ceil((F.col("high") - F.col("low") + 1) / buckets).alias("days"),
    )

    def stretch(time: Column) -> Column:
        """Number of the stretch of a time, before and after the facts of the key that of the first and the last."""
        own = F.floor((day(time) - F.col("low")) / F.col("days"))
        return F.greatest(F.lit(0), F.least(F.lit(buckets - 1), own)).cast("int")

    plain, zero = F.col("salts").isNull(), F.lit(0)
    dealt = named.join(F.broadcast(hot), keys, "left").withColumns({
        "stretch": F.when(plain, zero).otherwise(stretch(F.col("at"))),
        "salt": F.when(plain, zero).otherwise(F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")),
    }).select("row", *keys, "at", "stretch", "salt")
    until = F.coalesce("end", F.lit("9999-12-31").cast(_DAY))
    salts, first = F.coalesce("salts", F.lit(1)), F.when(plain, zero).otherwise(stretch(F.col("start")))
    touched = F.when(plain, F.lit(1)).otherwise(stretch(until) - first + 1)
    spread = right.where(F.col("end").isNull() | (F.col("start") < F.col("end"))).join(F.broadcast(hot), keys, "left")
    spread = spread.select("row", *keys, "start", "end", first.alias("first"), salts.alias("salts"), F.sequence(zero, touched * salts - 1).alias("copies"))
    spread = spread.withColumn("copy", F.explode("copies")).withColumns({
        "stretch": F.col("first") + F.floor(F.col("copy") / F.col("salts")).cast("int"), "salt": F.col("copy") % F.col("salts"),
    })

    f, h = dealt.alias("f"), spread.select("row", *keys, "start", "end", "stretch", "salt").alias("h")
    same = reduce(lambda a, b: a & b, [F.col(f"f.{k}") == F.col(f"h.{k}") for k in [*keys, "stretch", "salt"]])
    valid = (F.col("h.start") <= F.col("f.at")) & (F.col("h.end").isNull() | (F.col("f.at") < F.col("h.end")))
    joined = f.join(h, same & valid, how)
    result = joined.select(
        *[F.col("f.row").getField(c).alias(c) for c in facts.columns], *[F.col("h.row").getField(c).alias(prefix + c) for c in brought]
    )
    if how == "inner":
        return result
    alone = left.where(~(whole & F.col("at").isNotNull()))
    nothing = [F.lit(None).cast(history.schema[c].dataType).alias(prefix + c) for c in brought]
    return result.unionAll(alone.select(*[F.col("row").getField(c).alias(c) for c in facts.columns], *nothing))
