"""T-SQL functions as Column functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# CONVERT styles as Spark date patterns (public T-SQL documentation).
STYLES = {
    23: "yyyy-MM-dd",
    101: "MM/dd/yyyy",
    102: "yyyy.MM.dd",
    103: "dd/MM/yyyy",
    104: "dd.MM.yyyy",
    105: "dd-MM-yyyy",
    106: "dd MMM yyyy",
    107: "MMM dd, yyyy",
    108: "HH:mm:ss",
    110: "MM-dd-yyyy",
    111: "yyyy/MM/dd",
    112: "yyyyMMdd",
    120: "yyyy-MM-dd HH:mm:ss",
    121: "yyyy-MM-dd HH:mm:ss.SSS",
    126: "yyyy-MM-dd'T'HH:mm:ss.SSS",
}
CELL_BYTES = 2**30
ELEMENT_BYTES = 64
"""What one element of a gathered array costs beside its values."""
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
UNITS = {
    "yy": "year", "yyyy": "year", "qq": "quarter", "q": "quarter", "mm": "month", "m": "month",
    "wk": "week", "ww": "week", "dd": "day", "d": "day", "hh": "hour", "mi": "minute", "n": "minute",
    "ss": "second", "s": "second",
}


def _unit(unit: str) -> str:
    unit = unit.lower()
    return UNITS.get(unit, unit)


def _whole(n: Column | int) -> Column:
    return n.cast("int") if isinstance(n, Column) else F.lit(int(n))


def isnull(a: Column, b: Column) -> Column:
    return F.coalesce(a, b)


def iif(condition: Column, a: Column, b: Column) -> Column:
    return F.when(condition, a).otherwise(b)


def getdate() -> Column:
    return F.current_timestamp()


def getutcdate() -> Column:
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())


def len_(text: Column, *, ignore_trailing: bool = False) -> Column:
    """Length in characters; ``ignore_trailing`` leaves trailing blanks out, as LEN does in T-SQL."""
    return F.length(F.rtrim(text) if ignore_trailing else text)


def datalength(text: Column, *, in_bytes: bool = False) -> Column:
    """Length in characters, as scripts mean it once text has no code page; ``in_bytes`` counts UTF-8 bytes."""
    return F.octet_length(text) if in_bytes else F.length(text)


def charindex(sub: Column | str, text: Column, start: Column | int = 1) -> Column:
    """1-based place of ``sub`` from ``start`` on, 0 if absent; a start below 1 counts as 1."""
    start = F.greatest(start if isinstance(start, Column) else F.lit(start), F.lit(1))
    sub = sub if isinstance(sub, Column) else F.lit(sub)
    return F.position(sub, text, start)


def plus(*texts: Column) -> Column:
    """String ``+``: NULL as soon as one part is."""
    return F.concat(*texts)


def convert(kind: str, value: Column, style: int | None = None) -> Column:
    """``CONVERT(kind, value[, style])``; values that do not fit become NULL.

    With a style, a string kind formats a date and a date kind reads a string.
    """
    if style is None:
        return value.try_cast(kind)
    pattern = STYLES[style]
    if kind == "string":
        return F.date_format(value, pattern)
    if kind == "date":
        return F.try_to_date(value, pattern)
    return F.try_to_timestamp(value, F.lit(pattern)).cast(kind)


def dateadd(unit: str, n: Column | int, value: Column, *, keep_time: bool = False) -> Column:
    """Add ``n`` whole units. Days and longer give a DATE unless ``keep_time``; shorter units a timestamp."""
    unit, n = _unit(unit), _whole(n)
    months = {"month": 1, "quarter": 3, "year": 12}
    days = {"day": 1, "week": 7}
    if unit in months:
        n = n * F.lit(months[unit])
        return value + F.make_interval(months=n) if keep_time else F.add_months(value, n)
    if unit in days:
        n = n * F.lit(days[unit])
        return value + F.make_interval(days=n) if keep_time else F.date_add(value, n)
    if unit == "hour":
        return value + F.make_interval(hours=n)
    if unit == "minute":
        return value + F.make_interval(mins=n)
    if unit == "second":
        return value + F.make_interval(secs=n)
    raise ValueError(f"dateadd: unknown unit {unit}")


def datediff(unit: str, a: Column, b: Column) -> Column:
    """Unit boundaries crossed from ``a`` to ``b`` (a new year's eve is one year from the day after)."""
    unit = _unit(unit)
    if unit == "year":
        return (F.year(b) - F.year(a)).cast("long")
    if unit == "quarter":
        return ((F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)).cast("long")
    if unit == "month":
        return ((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)).cast("long")
    days = F.date_diff(b, a).cast("long")
    if unit == "day":
        return days
    if unit == "week":
        # weeks begin on Sunday: count the Sundays after a up to b
        return ((days + F.dayofweek(a) - F.dayofweek(b)) / 7).cast("long")
    hours = days * 24 + F.hour(b) - F.hour(a)
    if unit == "hour":
        return hours
    minutes = hours * 60 + F.minute(b) - F.minute(a)
    if unit == "minute":
        return minutes
    if unit == "second":
        return minutes * 60 + F.second(b) - F.second(a)
    raise ValueError(f"datediff: unknown unit {unit}")


def datepart(unit: str, value: Column) -> Column:
    return F.date_part(F.lit(_unit(unit)), value).cast("int")


def format_(value: Column, pattern: str) -> Column:
    return F.date_format(value, pattern)


def date_literal(text: str) -> Column:
    return F.lit(text).cast("date")


def timestamp_literal(text: str, kind: str = "timestamp_ntz") -> Column:
    return F.lit(text).cast(kind)


def isnumeric(text: Column) -> Column:
    return F.coalesce(text.rlike(NUMERIC), F.lit(False)).cast("int")


def newid() -> Column:
    return F.uuid()


def offset(n: Column) -> Column:
    """A column as a whole-number offset for ``dateadd``."""
    return n.cast("int")


def string_agg(
    df: DataFrame, keys: Sequence[str], col: str, sep: str, order: Sequence[str], *, check: bool = True
) -> DataFrame:
    """One string per key, parts in order (``STUFF ... FOR XML PATH``). NULL parts are left out.

    The result of a key is one cell, so its parts must fit one. Sizes are summed
    first (map-side, one number per key; text, order columns and what an element
    costs in memory) and a key beyond the limit is refused before any task
    starts to gather it. ``string_agg_chunks`` takes keys of any size.
    """
    rows = df.where(F.col(col).isNotNull())
    if check:
        held = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (col, *order)]
        size = F.sum(reduce(add, held) + F.lit(len(sep.encode()) + ELEMENT_BYTES))
        wide = rows.groupBy(*keys).agg(size.alias("n")).where(F.col("n") > CELL_BYTES).limit(1).collect()
        if wide:
            raise ValueError(f"string_agg: key {tuple(wide[0])[:-1]} needs {wide[0]['n']} bytes in one cell")
    part = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(col).alias("part"))
    parts = F.transform(F.sort_array(F.collect_list(part)), lambda p: p["part"])
    return rows.groupBy(*keys).agg(F.array_join(parts, sep).alias(col))


def string_agg_chunks(
    df: DataFrame, keys: Sequence[str], col: str, sep: str, order: Sequence[str], *, rows_per_chunk: int = 100_000
) -> DataFrame:
    """The string of each key in numbered chunks: keys, ``part_no`` (increasing) and ``col``; NULL parts are left out.

    Chunks of a key joined by ``sep`` in the order of ``part_no`` are its ``string_agg``. The rows are sorted into
    ranges, and each range is cut into chunks of at most ``rows_per_chunk``, so a key of any size spreads over tasks and no
    chunk grows with it. Equal rows are told apart by a running number, so copies spread too. There are as many ranges as
    chunks, but no more than ``spark.sql.shuffle.partitions``: the driver holds a sample for each.
    """
    rows = df.where(F.col(col).isNotNull()).select(*keys, *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(col).alias("_part"))
    names = [f"_o{i}" for i in range(len(order))]
    place = [*keys, *names, "_part", "_number"]
    numbered = rows.withColumn("_number", F.monotonically_increasing_id())
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = numbered.repartitionByRange(min(1 + rows.count() // rows_per_chunk, most), *place).sortWithinPartitions(*place)
    at = F.monotonically_increasing_id()  # range number and place in it
    placed = ranges.withColumn("_at", at).withColumn("_chunk", F.col("_at") - F.col("_at").bitwiseAND((1 << 33) - 1) % rows_per_chunk)
    parts = F.transform(F.sort_array(F.collect_list(F.struct(*names, "_part"))), lambda p: p["_part"])
    chunks = placed.groupBy(*keys, "_chunk").agg(F.array_join(parts, sep).alias(col))
    return chunks.select(*keys, F.col("_chunk").alias("part_no"), col)


def pivot(df: DataFrame, keys: Sequence[str], for_col: str, values: Sequence, agg: Column) -> DataFrame:
    """``PIVOT(agg FOR for_col IN (values))``. The listed values spare the job that would discover them."""
    return df.groupBy(*keys).pivot(for_col, list(values)).agg(agg)


def unpivot(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name_col: str, value_col: str,
    *, keep_nulls: bool = False,
) -> DataFrame:
    """``UNPIVOT``: one row per id and listed column, without NULL cells unless asked."""
    rows = df.unpivot(list(ids), list(values), name_col, value_col)
    return rows if keep_nulls else rows.where(F.col(value_col).isNotNull())
