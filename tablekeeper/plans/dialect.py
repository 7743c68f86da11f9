"""Registered queries: T-SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tsql
from .common import table


def q_null(spark, sf):
    p, size = table(spark, sf, "part"), F.col("p_size")
    odd = F.when(size % 2 == 1, size)
    return p.select(
        "p_partkey", tsql.isnull(odd, F.lit(-1)).alias("size_or"),
        tsql.iif(size > 25, F.lit("big"), F.lit("small")).alias("kind"),
        tsql.isnull(F.when(size > 40, F.col("p_brand")), F.col("p_type")).alias("label"),
    )


def q_strings(spark, sf):
    p, name = table(spark, sf, "part"), F.col("p_name")
    padded = F.concat(name, F.lit("   "))
    return p.select(
        "p_partkey", tsql.len_(padded).alias("len_all"), tsql.len_(padded, ignore_trailing=True).alias("len_trim"),
        tsql.datalength(name).alias("bytes"), tsql.charindex("e", name).alias("at"),
        tsql.charindex("e", name, F.col("p_size") % 5 + 1).alias("at_from"),
        tsql.plus(name, F.lit("/"), F.when(F.col("p_size") > 10, F.col("p_brand"))).alias("joined"),
    )


def q_dateadd(spark, sf):
    o, d = table(spark, sf, "orders"), F.col("o_orderdate")
    n = F.col("o_custkey") % 40 - 20
    t = d + F.make_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return o.select(
        "o_orderkey", tsql.dateadd("day", n, d).alias("d_day"), tsql.dateadd("week", 2, d).alias("d_week"),
        tsql.dateadd("month", n, d).alias("d_month"), tsql.dateadd("yy", n, d).alias("d_year"),
        tsql.dateadd("hour", tsql.offset(n * 1.0), t).alias("d_hour"),
        tsql.dateadd("mi", n, t).alias("d_minute"), tsql.dateadd("ss", -30, t).alias("d_second"),
        tsql.dateadd("day", n, t, keep_time=True).alias("d_keep"),
    )


def q_datediff(spark, sf):
    e, a = table(spark, sf, "events"), F.col("ts")
    b = tsql.dateadd("minute", F.col("user_id") * 977 - 40000, a)
    units = ["year", "quarter", "month", "week", "day", "hour", "minute", "second"]
    return e.select("event_id", *[tsql.datediff(u, a, b).alias(f"n_{u}") for u in units])


def q_datepart(spark, sf):
    d = F.col("ts")
    units = ["year", "quarter", "month", "day", "hour", "minute"]
    rows = table(spark, sf, "events")
    return rows.select(
        "event_id", *[tsql.datepart(u, d).alias(f"p_{u}") for u in units],
        tsql.format_(d, "yyyy/MM/dd HH:mm").alias("shown"),
        (d >= tsql.timestamp_literal("2024-01-15 12:00:00")).alias("late"),
        (tsql.convert("date", d) == tsql.date_literal("2024-01-15")).alias("that_day"),
    )


_STYLES = {23: "%Y-%m-%d", 101: "%m/%d/%Y", 102: "%Y.%m.%d", 103: "%d/%m/%Y", 104: "%d.%m.%Y", 105: "%d-%m-%Y",
           106: "%d %b %Y", 107: "%b %d, %Y", 108: "%H:%M:%S", 110: "%m-%d-%Y", 111: "%Y/%m/%d", 112: "%Y%m%d",
           120: "%Y-%m-%d %H:%M:%S", 121: "%Y-%m-%d %H:%M:%S.%g", 126: "%Y-%m-%dT%H:%M:%S.%g"}


def q_convert(spark, sf):
    rows = table(spark, sf, "events")
    ts = F.col("ts")
    return rows.select(
        "event_id", *[tsql.convert("string", ts, s).alias(f"s{s}") for s in _STYLES],
        tsql.convert("int", F.regexp_extract("props", r"(\d+)\}", 1)).alias("k"),
        tsql.convert("int", F.col("event_type")).alias("bad"),
        tsql.convert("date", tsql.convert("string", ts, 103), 103).alias("back"),
    )


_NUMERIC = (
    "CASE o_orderkey % 9 WHEN 0 THEN CAST(o_orderkey AS STRING) WHEN 1 THEN '-1.5e3' WHEN 2 THEN '.5' WHEN 3 THEN '1.' "
    "WHEN 4 THEN 'e5' WHEN 5 THEN o_orderpriority WHEN 6 THEN '' WHEN 7 THEN '+' || CAST(o_custkey AS STRING) END"
)


def q_isnumeric(spark, sf):
    rows = table(spark, sf, "orders")
    return rows.select("o_orderkey", tsql.isnumeric(F.expr(_NUMERIC)).alias("is_number"))


def q_string_agg(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("item", F.col("l_partkey").cast("string"))
    return tsql.string_agg(rows, ["l_orderkey"], "item", ", ", ["l_linenumber", "l_partkey"])


def q_string_agg_chunks(spark, sf):
    """Three keys of many rows each; the chunks of a key are measured together."""
    rows = table(spark, sf, "lineitem").withColumn("item", F.col("l_partkey").cast("string"))
    chunks = tsql.string_agg_chunks(rows, ["l_returnflag"], "item", ", ", ["l_orderkey", "l_linenumber", "l_partkey"], rows_per_chunk=5_000)
    ends = F.struct("part_no", F.substring_index("item", ",", 1)), F.struct("part_no", F.substring_index("item", " ", -1))
    return chunks.groupBy("l_returnflag").agg(
        (F.sum(F.length("item") + 2) - 2).alias("chars"), F.min(ends[0])["col2"].alias("first"), F.max(ends[1])["col2"].alias("last")
    )


def q_pivot(spark, sf):
    return tsql.pivot(
        table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", ["A", "N", "R"], F.sum("l_quantity")
    )


def q_pivot_reagg(spark, sf):
    """An aggregate over pivoted columns is a second step around the pivot."""
    inner = tsql.pivot(
        table(spark, sf, "lineitem"), ["l_suppkey", "l_linestatus"], "l_returnflag", ["A", "N"], F.sum("l_quantity")
    )
    return inner.groupBy("l_linestatus").agg(F.max("A").alias("max_a"), F.min("N").alias("min_n"))


def q_unpivot(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax"
    )
    return tsql.unpivot(rows, ["l_orderkey", "l_partkey"], ["l_quantity", "l_discount", "l_tax"], "measure", "amount")


def q_now(spark, sf):
    """Clock and random functions: their values differ from run to run, so no SQL stands beside them."""
    rows = table(spark, sf, "part")
    return rows.select(
        "p_partkey", (tsql.getdate() == tsql.getdate()).alias("one_clock"),
        tsql.getutcdate().isNotNull().alias("has_utc"), F.length(tsql.newid()).alias("id_chars"),
    )


QUERIES = {
    "tsql_null_logic": q_null, "tsql_strings": q_strings, "tsql_dateadd": q_dateadd, "tsql_datediff": q_datediff,
    "tsql_datepart_format": q_datepart, "tsql_convert": q_convert, "tsql_isnumeric": q_isnumeric,
    "tsql_string_agg": q_string_agg, "tsql_string_agg_chunks": q_string_agg_chunks, "tsql_pivot": q_pivot, "tsql_pivot_reagg": q_pivot_reagg,
    "tsql_unpivot": q_unpivot, "tsql_clock": q_now,
}
_N = "(o_custkey % 40 - 20)"
_T = "(o_orderdate + to_minutes(o_orderkey % 1440))"
ORACLE = {
    "tsql_null_logic": """SELECT p_partkey, coalesce(CASE WHEN p_size % 2 = 1 THEN p_size END, -1) AS size_or,
        CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS kind, CASE WHEN p_size > 40 THEN p_brand ELSE p_type END AS label FROM part""",
    "tsql_strings": """SELECT p_partkey, length(p_name || '   ') AS len_all, length(rtrim(p_name || '   ')) AS len_trim,
        length(p_name) AS bytes, strpos(p_name, 'e') AS at,
        CASE WHEN strpos(substr(p_name, p_size % 5 + 1), 'e') = 0 THEN 0 ELSE strpos(substr(p_name, p_size % 5 + 1), 'e') + p_size % 5 END AS at_from,
        p_name || '/' || CASE WHEN p_size > 10 THEN p_brand END AS joined FROM part""",
    "tsql_dateadd": f"""SELECT o_orderkey, CAST(o_orderdate + to_days(CAST({_N} AS INT)) AS DATE) AS d_day,
        CAST(o_orderdate + INTERVAL 14 DAY AS DATE) AS d_week, CAST(o_orderdate + to_months(CAST({_N} AS INT)) AS DATE) AS d_month,
        CAST(o_orderdate + to_years(CAST({_N} AS INT)) AS DATE) AS d_year, {_T} + to_hours({_N}) AS d_hour,
        {_T} + to_minutes({_N}) AS d_minute, {_T} - INTERVAL 30 SECOND AS d_second, {_T} + to_days(CAST({_N} AS INT)) AS d_keep FROM orders""",
    "tsql_datediff": """WITH e AS (SELECT event_id, ts AS a, ts + to_minutes(user_id * 977 - 40000) AS b FROM events)
        SELECT event_id, date_diff('year', a, b) AS n_year, date_diff('quarter', a, b) AS n_quarter, date_diff('month', a, b) AS n_month,
        date_diff('day', date_trunc('week', a + INTERVAL 1 DAY), date_trunc('week', b + INTERVAL 1 DAY)) // 7 AS n_week, date_diff('day', a, b) AS n_day,
        date_diff('hour', a, b) AS n_hour, date_diff('minute', a, b) AS n_minute, date_diff('second', a, b) AS n_second FROM e""",
    "tsql_datepart_format": """SELECT event_id, CAST(year(ts) AS INT) AS p_year, CAST(quarter(ts) AS INT) AS p_quarter,
        CAST(month(ts) AS INT) AS p_month, CAST(day(ts) AS INT) AS p_day, CAST(hour(ts) AS INT) AS p_hour,
        CAST(minute(ts) AS INT) AS p_minute, strftime(ts, '%Y/%m/%d %H:%M') AS shown,
        ts >= TIMESTAMP '2024-01-15 12:00:00' AS late, CAST(ts AS DATE) = DATE '2024-01-15' AS that_day FROM events""",
    "tsql_convert": "SELECT event_id, " + ", ".join(f"strftime(ts, '{f}') AS s{s}" for s, f in _STYLES.items())
        + ", CAST(regexp_extract(props, '(\\d+)\\}', 1) AS INT) AS k, CAST(NULL AS INT) AS bad, CAST(ts AS DATE) AS back FROM events",
    "tsql_isnumeric": f"""SELECT o_orderkey, CASE WHEN regexp_matches({_NUMERIC}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')
        THEN 1 ELSE 0 END AS is_number FROM orders""",
    "tsql_string_agg": """SELECT l_orderkey, string_agg(CAST(l_partkey AS STRING), ', ' ORDER BY l_linenumber, l_partkey) AS item
        FROM lineitem GROUP BY l_orderkey""",
    "tsql_string_agg_chunks": """SELECT l_returnflag, CAST(sum(length(CAST(l_partkey AS STRING)) + 2) - 2 AS BIGINT) AS chars,
        CAST(arg_min(l_partkey, {'o': l_orderkey, 'n': l_linenumber, 'p': l_partkey}) AS STRING) AS first,
        CAST(arg_max(l_partkey, {'o': l_orderkey, 'n': l_linenumber, 'p': l_partkey}) AS STRING) AS last FROM lineitem GROUP BY 1""",
    "tsql_clock": "SELECT p_partkey, TRUE AS one_clock, TRUE AS has_utc, 36 AS id_chars FROM part",
    "tsql_pivot": """SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS A,
        sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS N, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS R
        FROM lineitem GROUP BY l_suppkey""",
    "tsql_pivot_reagg": """SELECT l_linestatus, max(a) AS max_a, min(n) AS min_n FROM (SELECT l_suppkey, l_linestatus,
        sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS n
        FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
    "tsql_unpivot": " UNION ALL ".join(
        f"SELECT l_orderkey, l_partkey, '{c}' AS measure, {e} AS amount FROM lineitem WHERE {e} IS NOT NULL"
        for c, e in (("l_quantity", "l_quantity"), ("l_discount", "nullif(l_discount, 0)"), ("l_tax", "l_tax"))
    ),
}
