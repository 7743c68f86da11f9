"""Leading rows of an order, for groups of any size.

``row_number() <= k`` over whole rows sends a group, however wide, through one
task. Here only the cut is looked for: the sort key of the last row to keep. The
kept rows then come from a filter, so the data itself is neither shuffled nor
sorted. Groups of up to ``small`` rows have their keys ranked in a window; for
larger ones the range that holds the cut is first narrowed, pass by pass, by
counting rows between sampled split keys, until it is small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import stage
from .joins import small_side

SMALL = 1_000_000
SPLITS = 256


def _descending(column: Column, kind: T.DataType) -> list[Column]:
    """Columns whose ascending order is the descending order of ``column``, NULL last."""
    missing = column.isNull()
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return [missing, F.bitwise_not(column)]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [missing, ~F.isnan(column), -column]
    if isinstance(kind, T.DecimalType):
        return [missing, -column]
    if isinstance(kind, T.BooleanType):
        return [missing, ~column]
    if isinstance(kind, T.DateType):
        return [missing, F.bitwise_not(F.unix_date(column))]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [missing, F.bitwise_not(_micros(column, kind))]
    if isinstance(kind, T.StringType):
        # complement of the hex digits; the closing G ranks a prefix behind its extensions
        digits = F.hex(F.encode(column.cast("string"), "UTF-8"))
        return [missing, F.concat(F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
    raise TypeError(f"no descending order for {kind.simpleString()}")


def _micros(column: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970, which order as the timestamps do in any zone."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    day = F.unix_date(column.cast("date")).cast("long") * 86_400
    seconds = day + F.hour(column) * 3_600 + F.minute(column) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("long")


def sort_key(df: DataFrame, order: Sequence[str]) -> Column:
    """One ascending struct for an order such as ``["-l_quantity", "l_orderkey"]``; a minus sign means descending.

    NULLs come first in ascending and last in descending columns, as in Spark.
    """
    parts: list[Column] = []
    for item in order:
        name = item.removeprefix("-")
        column = F.col(f"`{name}`")
        if item.startswith("-"):
            parts += _descending(column, df.schema[name].dataType)
        elif isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
            parts.append(_micros(column, df.schema[name].dataType))
        else:
            parts.append(column)
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(parts)])


def keep_leading(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    quota: Callable[[Column], Column],
    *,
    unique: bool = False,
    small: int = SMALL,
    splits: int = SPLITS,
) -> DataFrame:
    """In each group of ``part`` the first ``quota(n)`` rows, ``n`` being the size of the group.

    Rows that tie in ``order`` where the cut falls are put in order by all other
    columns. With ``unique`` the order is taken to identify a row. The input is
    read more than once: costly or unrepeatable input should be staged first.
    """
    group = [F.col(f"`{c}`") for c in part] or [F.lit(0)]
    keyed = df.withColumns(
        {"_k": sort_key(df, order), "_p": F.struct(*[g.alias(f"p{i}") for i, g in enumerate(group)])}
    )
    kept, tied, most = _split(keyed, quota, unique, small, splits)
    kept = kept.select(*df.columns)
    if tied is None:
        return kept
    # the rows that tie at a cut: a first few of them complete the group
    named = {item.removeprefix("-") for item in order}
    others = [c for c in df.columns if c not in named and c not in part]
    if most <= small:
        place = F.row_number().over(Window.partitionBy("_p").orderBy(*[F.col(f"`{c}`") for c in others or ["_k"]]))
        chosen = tied.withColumn("_rn", place).where(F.col("_rn") <= F.col("_quota"))
        return kept.unionByName(chosen.select(*df.columns))
    if others:
        rest = tied.withColumn("_k", sort_key(df, others))
        more, tied, _ = _split(rest, lambda n: F.col("_quota"), False, small, splits, ["_quota"])
        kept = kept.unionByName(more.select(*df.columns))
    return kept if tied is None else kept.unionByName(_copies(tied, df.columns))


def _split(
    keyed: DataFrame, quota: Callable[[Column], Column], unique: bool, small: int, splits: int,
    extra: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame | None, int]:
    """Rows surely kept; rows tying at a cut of which only ``_quota`` fit, if any; the most of these in a group."""
    whole = keyed.columns
    keys = keyed.select("_p", "_k", *extra)
    sizes = keys.groupBy("_p", *extra).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    if largest is None:
        return keyed, None, 0

    if largest <= small:
        cuts = _cuts(keys.withColumn("below", F.lit(0).cast("long")), quota, unique)
    else:
        wanted = sizes.withColumn("k", F.least(quota(F.col("n")).cast("long"), F.col("n"))).where("k > 0")
        wanted = stage(wanted.select("_p", "n", "k"), "group-sizes")
        cuts = _narrowed_cuts(keys.select("_p", "_k"), wanted, small, splits, unique)
    cuts = stage(cuts, "cuts")
    at_cut = keyed.join(small_side(cuts), "_p")
    same = F.col("_k") == F.col("cut")
    if unique:
        return at_cut.where((F.col("_k") < F.col("cut")) | same).select(*whole), None, 0

    fits = F.col("take") == F.col("ties")
    kept = at_cut.where((F.col("_k") < F.col("cut")) | (same & fits)).select(*whole)
    most = cuts.where(~fits).agg(F.max("ties")).first()[0]
    if most is None:
        return kept, None, 0
    plain = [c for c in whole if c != "_quota"]
    return kept, at_cut.where(same & ~fits).select(*plain, F.col("take").alias("_quota")), most


def _copies(tied: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that tie in every column are copies of each other: write out as many as fit, in blocks."""
    block = 10_000
    once = tied.groupBy("_p", *columns).agg(F.max("_quota").alias("_quota"))
    blocks = once.withColumn(
        "_b", F.explode(F.sequence(F.lit(0), F.floor((F.col("_quota") - 1) / block)))
    ).repartition("_b", "_p")
    left = F.least(F.lit(block), F.col("_quota") - F.col("_b") * block).cast("int")
    return blocks.withColumn("_i", F.explode(F.sequence(F.lit(1), left))).select(*columns)


def _cuts(rows: DataFrame, quota: Callable[[Column], Column], unique: bool) -> DataFrame:
    """For each group the key of its last kept row (``cut``), how many rows share it (``ties``) and fit (``take``).

    ``rows`` holds a small range of each group: ``_p``, ``_k`` and the number of
    its rows ``below`` the range. ``quota`` is given the number of rows at hand.
    """
    group = Window.partitionBy("_p")
    order = group.orderBy("_k")
    if unique:
        placed = rows.withColumns(
            {
                "_upto": F.row_number().over(order) + F.col("below"), "_next": F.lead("_k").over(order),
                "_n": F.count(F.lit(1)).over(group),
            }
        )
        ties = F.raise_error(F.lit("the order does not identify a row: rows tie at the cut"))
        cut = F.when(F.col("_next") == F.col("_k"), ties).otherwise(F.col("_k"))
        k = F.least(quota(F.col("_n")).cast("long"), F.col("_n") + F.col("below"))
        return placed.where(F.col("_upto") == k).select("_p", cut.alias("cut"))
    # copies are counted before the running sum
    extra = [c for c in rows.columns if c not in ("_p", "_k")]
    counted = rows.groupBy("_p", "_k", *extra).agg(F.count(F.lit(1)).alias("ties"))
    placed = counted.withColumns(
        {"_upto": F.sum("ties").over(order) + F.col("below"), "_n": F.sum("ties").over(group)}
    )
    k = F.least(quota(F.col("_n")).cast("long"), F.col("_n") + F.col("below"))
    under = F.col("_upto") - F.col("ties")
    return placed.where((F.col("_upto") >= k) & (under < k)).select(
        "_p", F.col("_k").alias("cut"), "ties", (k - under).alias("take")
    )


def _narrowed_cuts(keys: DataFrame, wanted: DataFrame, small: int, splits: int, unique: bool) -> DataFrame:
    """The cuts of groups of any size (``wanted``: group, size ``n``, rows to keep ``k``)."""
    empty = F.lit(None).cast(keys.schema["_k"].dataType)
    count, no = F.lit(0).cast("long"), F.lit(False)
    # at most one group per ``small`` rows is larger than that, so their rows are few enough to broadcast
    large = wanted.where(F.col("n") > small).select("_p", "k")
    ranges = (
        keys.join(F.broadcast(large), "_p").groupBy("_p", "k")
        .agg(F.count(F.lit(1)).alias("inside"), *_range_stats())
        .select(
            "_p", "k", "inside", count.alias("below"), empty.alias("lo"), F.col("top").alias("hi"),
            "low", "kinds", (F.col("low") == F.col("top")).alias("single"),
        )
    )
    rest = wanted.where(F.col("n") <= small).select(
        "_p", "k", F.col("n").alias("inside"), count.alias("below"), empty.alias("lo"), empty.alias("hi"),
        empty.alias("low"), count.alias("kinds"), no.alias("single"),
    )
    state = stage(ranges.unionByName(rest), "cut-range")
    while state.where((F.col("inside") > small) & ~F.col("single")).limit(1).collect():
        inside = _within(keys, state.where((F.col("inside") > small) & ~F.col("single")), "low", "kinds")
        points = _split_points(inside, splits)
        counted = (
            inside.join(F.broadcast(points), "_p", "left")
            .withColumn("b", _bucket(F.col("_k"), F.col("points"), splits))
            .groupBy("_p", "b")
            .agg(F.count(F.lit(1)).alias("c"), *_range_stats())
        )
        up_to = Window.partitionBy("_p").orderBy("b")
        hit = (
            counted.withColumn("upto", F.sum("c").over(up_to))
            .withColumn("floor", F.lag("top").over(up_to))
            .join(state.drop("low", "kinds"), "_p")
            .where((F.col("below") + F.col("upto") >= F.col("k"))
                   & (F.col("below") + F.col("upto") - F.col("c") < F.col("k")))
            .select(
                "_p", "k", F.col("c").alias("inside"),
                (F.col("below") + F.col("upto") - F.col("c")).alias("below"),
                F.coalesce("floor", "lo").alias("lo"), F.col("top").alias("hi"), "low", "kinds",
                (F.col("low") == F.col("top")).alias("single"),
            )
        )
        done = state.where((F.col("inside") <= small) | F.col("single"))
        state = stage(done.unionByName(hit), "cut-range")

    found = _cuts(_within(keys, state.where("not single"), "k", "below"), lambda n: F.col("k"), unique)
    solved = state.where("single")
    if unique:
        # a range with one key left and more than one row in it breaks the promise
        broken = F.raise_error(F.lit("the order does not identify a row: rows tie at the cut"))
        cut = F.when(F.col("inside") > 1, broken).otherwise(F.col("hi"))
        return stage(found.unionByName(solved.select("_p", cut.alias("cut"))), "cuts")
    return found.unionByName(
        solved.select(
            "_p", F.col("hi").alias("cut"), F.col("inside").alias("ties"),
            (F.col("k") - F.col("below")).alias("take"),
        )
    )


def _range_stats() -> list[Column]:
    return [
        F.min("_k").alias("low"), F.max("_k").alias("top"),
        F.approx_count_distinct("_k").alias("kinds"),
    ]


def _within(keys: DataFrame, state: DataFrame, *extra: str) -> DataFrame:
    """Keys of the groups in ``state`` that lie in ``(lo, hi]``."""
    marks = small_side(state.select("_p", "lo", "hi", *extra))
    after = F.col("lo").isNull() | (F.col("_k") > F.col("lo"))
    upto = F.col("hi").isNull() | (F.col("_k") <= F.col("hi"))
    return keys.join(marks, "_p").where(after & upto).drop("lo", "hi")


def _split_points(inside: DataFrame, splits: int) -> DataFrame:
    """Up to ``splits`` distinct keys per group, from a sample chosen by the hash of the key.

    The lowest key is always one of the points: it gets a bucket of its own, so
    each pass leaves fewer kinds of keys.
    """
    per_split = 16
    every = F.greatest(F.lit(1), F.floor(F.col("kinds") / (splits * per_split)))
    chosen = (F.pmod(F.xxhash64("_k"), every) == 0) | (F.col("_k") == F.col("low"))
    sample = inside.where(chosen).select("_p", "_k").distinct()
    ranked = sample.withColumn("r", F.ntile(splits).over(Window.partitionBy("_p").orderBy("_k")))
    tops = ranked.groupBy("_p", "r").agg(F.max("_k").alias("_k"))
    return tops.groupBy("_p").agg(F.sort_array(F.collect_list("_k")).alias("points"))


def _bucket(key: Column, points: Column, splits: int) -> Column:
    """Number of split points below ``key``, by binary search."""
    steps = [1 << i for i in range(splits.bit_length(), -1, -1)]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size(points)) & (F.try_element_at(points, at + step) < key), at + step
        ).otherwise(at),
    )
    return F.when(points.isNull(), F.lit(0)).otherwise(found)
