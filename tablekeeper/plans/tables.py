"""Registered queries: keyed maintenance and leading rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.merge import append_new, merge_update, replace_where, union_parts
from ..operators.ranking import keep_leading
from ..operators.sample import dependency_stage, prefix_sample, top_n, top_n_with_ties, top_percent
from ..sources.tables import (
    append_table, read_table, read_version, replace_partitions, rewrite_table, stage_folder, write_table,
)
from .common import cols, sql_cols, table

_TARGET = {
    "o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus", "o_totalprice": "o_totalprice",
    "o_orderpriority": "o_orderpriority", "attempt": "1",
}
_UPDATE = {"o_orderkey": "o_orderkey", "price": "o_totalprice * 2"}
_ROWS = {**_TARGET, "o_orderkey": "o_orderkey + 7500", "attempt": "9"}
_RUN = {**_TARGET, "o_totalprice": "CAST(0 AS DOUBLE)", "attempt": "2"}


def _orders(spark, sf, exprs, where=None):
    df = table(spark, sf, "orders")
    return cols(df if where is None else df.where(where), exprs)


def q_merge(spark, sf):
    return merge_update(
        _orders(spark, sf, _TARGET), _orders(spark, sf, _UPDATE, "o_orderkey % 7 = 0"), ["o_orderkey"],
        {"o_totalprice": F.col("s.price"), "attempt": F.col("t.attempt") + 1, "o_orderpriority": F.lit("merged")},
    )


def q_merge_pred(spark, sf):
    return merge_update(
        _orders(spark, sf, _TARGET), _orders(spark, sf, _UPDATE, "o_orderkey % 3 = 0"), ["o_orderkey"],
        {"o_totalprice": F.col("s.price")}, target_pred=F.col("t.o_orderstatus") == "F",
    )


def q_append_new(spark, sf):
    return append_new(_orders(spark, sf, _TARGET), _orders(spark, sf, _ROWS), ["o_orderkey"])


def q_replace(spark, sf):
    rows = _orders(spark, sf, _RUN, "o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey % 2 = 0")
    return replace_where(_orders(spark, sf, _TARGET), rows, ["o_orderpriority"])


def _folder(spark, tag):
    return f"{stage_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def q_replace_stored(spark, sf):
    """The same on a stored table: only the partitions of the new rows are written."""
    path = _folder(spark, "runs")
    write_table(_orders(spark, sf, _TARGET), path, ["o_orderpriority"])
    rows = _orders(spark, sf, _RUN, "o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey % 2 = 0")
    replace_partitions(rows, path, ["o_orderpriority"])
    return spark.read.parquet(path)


def q_rewrite(spark, sf):
    """Read, change and overwrite one table; readers follow the committed version."""
    path = _folder(spark, "rewritten")
    rewrite_table(spark, path, df=_orders(spark, sf, _TARGET))
    rewrite_table(spark, path, lambda df: df.withColumn("attempt", F.col("attempt") + 1))
    return read_version(spark, path)


def q_evolve(spark, sf):
    """Append rows that bring a column the table does not have yet."""
    path = _folder(spark, "evolved")
    write_table(_orders(spark, sf, _TARGET), path)
    append_table(_orders(spark, sf, {**_RUN, "note": "'late'"}, "o_orderkey % 5 = 0"), path)
    return read_table(spark, path)


def q_union(spark, sf):
    parts = [_orders(spark, sf, _TARGET, f"o_orderstatus = '{s}'") for s in ("O", "F", "P")]
    return union_parts(spark, parts, parts[0].schema)


_KEYS = ["o_orderstatus", "o_orderkey", "o_orderpriority"]


def _sample(fraction, small):
    def run(spark, sf):
        rows = table(spark, sf, "orders").select(*_KEYS)
        return prefix_sample(rows, ["o_orderstatus"], ["o_orderkey"], fraction, small=small)

    return run


def _sample_sql(fraction):
    return f"""SELECT {', '.join(_KEYS)} FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
      WHERE rn <= greatest(1, CAST(floor(CAST(n AS DOUBLE) * CAST({fraction} AS DOUBLE)) AS BIGINT))"""


_LINE = ["l_extendedprice", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"]
_LINE_ORDER = ["-l_extendedprice", *_LINE[1:]]
_PART = ["p_partkey", "p_brand", "p_size"]


def q_top_n(spark, sf):
    return top_n(table(spark, sf, "lineitem").select(*_LINE), 100, _LINE_ORDER)


def q_ties(spark, sf):
    return top_n_with_ties(table(spark, sf, "part").select(*_PART), 25, ["-p_size"])


def q_ties_group(spark, sf):
    return top_n_with_ties(table(spark, sf, "part").select(*_PART), 3, ["-p_size"], ["p_brand"])


def q_percent(spark, sf):
    return top_percent(table(spark, sf, "lineitem").select(*_LINE), 5, ["-l_extendedprice"])


def q_percent_group(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE)
    return top_percent(rows, 2.5, ["-l_quantity"], ["l_returnflag"], small=5000)


def q_copies(spark, sf):
    """A cut inside copies of one row: as many are kept as fit."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    return keep_leading(rows, [], ["-l_returnflag"], lambda n: F.floor(n / 3), small=1000)




def q_stage(spark, sf):
    order = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
    rows = table(spark, sf, "orders")
    return rows.select("o_orderkey", dependency_stage(F.col("o_orderpriority"), order).alias("stage_no"))


QUERIES = {
    "merge_update": q_merge, "merge_update_predicate": q_merge_pred, "append_new": q_append_new,
    "replace_where": q_replace, "replace_stored_partitions": q_replace_stored, "rewrite_table": q_rewrite,
    "append_evolving": q_evolve, "union_parts": q_union,
    "prefix_sample_25": _sample(0.25, 1_000_000), "prefix_sample_50_by_cut": _sample(0.5, 1000),
    "top_n": q_top_n, "top_n_with_ties": q_ties, "top_n_with_ties_per_group": q_ties_group,
    "top_percent": q_percent, "top_percent_per_group": q_percent_group, "top_rows_among_copies": q_copies,
    "dependency_stage": q_stage,
}
_REPLACED = f"""
  SELECT {sql_cols(_TARGET)} FROM orders WHERE o_orderpriority NOT IN
    (SELECT o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey % 2 = 0)
  UNION ALL SELECT {sql_cols(_RUN)} FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey % 2 = 0"""
_LINE_SQL = f"l_extendedprice DESC, {', '.join(_LINE[1:])}"
_REST = [c for c in _LINE if c != "l_quantity"]
ORACLE = {
    "merge_update": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 2 ELSE o_totalprice END
        AS o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN 'merged' ELSE o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS attempt FROM orders""",
    "merge_update_predicate": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 AND o_orderstatus = 'F'
        THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderpriority, 1 AS attempt FROM orders""",
    "append_new": f"""WITH t AS (SELECT {sql_cols(_TARGET)} FROM orders), r AS (SELECT {sql_cols(_ROWS)} FROM orders)
        SELECT * FROM t UNION ALL SELECT * FROM r WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""",
    "replace_where": _REPLACED,
    "replace_stored_partitions": _REPLACED,
    "rewrite_table": f"SELECT {sql_cols({**_TARGET, 'attempt': '2'})} FROM orders",
    "append_evolving": f"""SELECT {sql_cols({**_TARGET, 'note': 'NULL'})} FROM orders
        UNION ALL SELECT {sql_cols({**_RUN, 'note': "'late'"})} FROM orders WHERE o_orderkey % 5 = 0""",
    "union_parts": f"SELECT {sql_cols(_TARGET)} FROM orders WHERE o_orderstatus IN ('O', 'F', 'P')",
    "prefix_sample_25": _sample_sql(0.25),
    "prefix_sample_50_by_cut": _sample_sql(0.5),
    "top_n": f"SELECT {', '.join(_LINE)} FROM lineitem ORDER BY {_LINE_SQL} LIMIT 100",
    "top_n_with_ties": f"""SELECT {', '.join(_PART)} FROM (SELECT *, rank() OVER (ORDER BY p_size DESC) AS r FROM part)
        WHERE r <= 25""",
    "top_n_with_ties_per_group": f"""SELECT {', '.join(_PART)} FROM (SELECT *, rank() OVER (PARTITION BY p_brand
        ORDER BY p_size DESC) AS r FROM part) WHERE r <= 3""",
    "top_percent": f"""SELECT {', '.join(_LINE)} FROM (SELECT *, row_number() OVER (ORDER BY {_LINE_SQL}) AS rn,
        count(*) OVER () AS n FROM lineitem) WHERE rn <= ceil(CAST(n AS DOUBLE) * 5 / 100)""",
    "top_percent_per_group": f"""SELECT {', '.join(_LINE)} FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag
        ORDER BY l_quantity DESC, {', '.join(_REST)}) AS rn, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
        WHERE rn <= ceil(CAST(n AS DOUBLE) * 2.5 / 100)""",
    "top_rows_among_copies": """SELECT l_returnflag, l_linestatus FROM (SELECT l_returnflag, l_linestatus,
        row_number() OVER (ORDER BY l_returnflag DESC, l_linestatus) AS rn, count(*) OVER () AS n FROM lineitem)
        WHERE rn <= n // 3""",
    "dependency_stage": """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
        WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 0 END AS stage_no FROM orders""",
}
