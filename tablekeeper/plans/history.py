"""Registered queries: SCD Type 2 history and its metadata."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.conform import (
    conform_report, conform_types, infer_business_key, register_companions, select_temporal,
)
from ..operators.report import pair_companions
from ..operators.scd2 import open_history, scd2_apply, scd2_backfill, scd2_changes
from ..sources.history import HistoryTable
from ..sources.tables import stage_folder
from .common import cols, sql_cols, table

KEY, TRACK = ["c_custkey"], ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"

_FIRST = {
    "c_custkey": "c_custkey", "c_name": "c_name",
    "c_nationkey": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END",
    "c_acctbal": "c_acctbal", "c_mktsegment": "c_mktsegment", "ETL_batch": "1",
}
_CHANGED = {
    **_FIRST,
    "c_nationkey": "CASE WHEN c_custkey % 26 = 0 THEN NULL ELSE c_nationkey END",
    "c_mktsegment": "CASE WHEN c_custkey % 10 = 0 THEN 'CHANGED' ELSE c_mktsegment END",
    "ETL_batch": "2",
}
_NEW = {**_FIRST, "c_custkey": "c_custkey + 1000000000000", "ETL_batch": "2"}
_THIRD = {
    **_CHANGED,
    "c_acctbal": "CASE WHEN c_custkey % 15 = 0 THEN c_acctbal + 1 ELSE c_acctbal END",
    "ETL_batch": "3",
}


def first_source(spark, sf) -> DataFrame:
    return cols(table(spark, sf, "customer"), _FIRST)


def second_source(spark, sf) -> DataFrame:
    """Some rows changed, some absent, some new; the ETL_ column alone makes no new version."""
    customer = table(spark, sf, "customer")
    return cols(customer.where("c_custkey % 97 <> 0"), _CHANGED).unionByName(
        cols(customer.where("c_custkey % 30 = 0"), _NEW)
    )


def third_source(spark, sf) -> DataFrame:
    return cols(table(spark, sf, "customer"), _THIRD)


def shown(history: DataFrame) -> DataFrame:
    """Window bounds as text, so the open end prints alike everywhere."""
    as_text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS") for c in ("valid_from", "valid_to")}
    return history.withColumns(as_text)


def _loaded(spark, sf):
    return open_history(first_source(spark, sf), T0)


def q_apply(spark, sf):
    return shown(scd2_apply(_loaded(spark, sf), second_source(spark, sf), KEY, TRACK, T1))


def q_reapply(spark, sf):
    source = second_source(spark, sf)
    once = scd2_apply(_loaded(spark, sf), source, KEY, TRACK, T1)
    return shown(scd2_apply(once, source, KEY, TRACK, T2))


def q_three(spark, sf):
    once = scd2_apply(_loaded(spark, sf), second_source(spark, sf), KEY, TRACK, T1)
    return shown(scd2_apply(once, third_source(spark, sf), KEY, TRACK, T2))


def q_close(spark, sf):
    return shown(
        scd2_apply(_loaded(spark, sf), second_source(spark, sf), KEY, TRACK, T1, deletes="close")
    )


def q_stored(spark, sf):
    folder = f"{stage_folder(spark)}/history-{uuid.uuid4().hex}"
    kept = HistoryTable(spark, folder, KEY, TRACK)
    kept.load(first_source(spark, sf), T0)
    kept.apply(second_source(spark, sf), T1)
    kept.apply(third_source(spark, sf), T2)
    return shown(kept.read())


def q_backfill(spark, sf):
    done = scd2_apply(_loaded(spark, sf), second_source(spark, sf), KEY, TRACK, T1)
    current = done.where("IsCurrent").drop("IsCurrent")
    old = done.where("not IsCurrent").drop("IsCurrent")
    return shown(scd2_backfill(current, old))


def q_changes(spark, sf):
    before = _loaded(spark, sf)
    after = scd2_apply(before, second_source(spark, sf), KEY, TRACK, T1)
    return shown(scd2_changes(before, after, KEY))


# The oracle closes and inserts in two statements' worth of SELECTs.
_OPEN = "9999-12-31 23:59:59.999"
_BUS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "ETL_batch"]
_SOURCES = f"""
src1 AS (SELECT {sql_cols(_FIRST)} FROM customer),
src2 AS (SELECT {sql_cols(_CHANGED)} FROM customer WHERE c_custkey % 97 <> 0
         UNION ALL SELECT {sql_cols(_NEW)} FROM customer WHERE c_custkey % 30 = 0),
src3 AS (SELECT {sql_cols(_THIRD)} FROM customer),
dim1 AS (SELECT *, TIMESTAMP '{T0}' AS valid_from, TIMESTAMP '{_OPEN}' AS valid_to, TRUE AS IsCurrent FROM src1)"""


def _step(dim: str, src: str, at: str, out: str, close: bool = False) -> str:
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in TRACK)
    gone = "s.c_custkey IS NULL OR" if close else "s.c_custkey IS NOT NULL AND"
    closes = f"t.IsCurrent AND ({gone} ({differs}))"
    return f""",
{out} AS (
  SELECT {', '.join('t.' + c for c in _BUS)}, t.valid_from,
         CASE WHEN {closes} THEN TIMESTAMP '{at}' ELSE t.valid_to END AS valid_to,
         t.IsCurrent AND NOT ({closes}) AS IsCurrent
  FROM {dim} t LEFT JOIN {src} s ON t.c_custkey = s.c_custkey
  UNION ALL
  SELECT {', '.join('s.' + c for c in _BUS)}, TIMESTAMP '{at}', TIMESTAMP '{_OPEN}', TRUE
  FROM {src} s LEFT JOIN {dim} t ON t.c_custkey = s.c_custkey AND t.IsCurrent
  WHERE t.c_custkey IS NULL OR {differs})"""


def _shown_sql(relation: str, extra: str = "") -> str:
    fmt = "'%Y-%m-%d %H:%M:%S.%g'"
    return (
        f"SELECT {', '.join(_BUS)}, strftime(valid_from, {fmt}) AS valid_from, "
        f"strftime(valid_to, {fmt}) AS valid_to, IsCurrent{extra} FROM {relation}"
    )


_ONE = f"WITH {_SOURCES}{_step('dim1', 'src2', T1, 'dim2')}"
_THREE = f"{_ONE}{_step('dim2', 'src3', T2, 'dim3')} {_shown_sql('dim3')}"
_CHANGES = f"""{_ONE},
pairs AS (SELECT a, b FROM dim1 b FULL JOIN dim2 a ON a.c_custkey = b.c_custkey AND a.valid_from = b.valid_from),
images AS (
  SELECT unnest(a), 'insert' AS _change_type FROM pairs WHERE b.c_custkey IS NULL
  UNION ALL SELECT unnest(b), 'update_preimage' FROM pairs WHERE a.c_custkey = b.c_custkey AND a <> b
  UNION ALL SELECT unnest(a), 'update_postimage' FROM pairs WHERE a.c_custkey = b.c_custkey AND a <> b)
{_shown_sql('images', ', _change_type')}"""

# --- metadata ---------------------------------------------------------------
# One order stands for a table, its lines for the columns.

_COLUMNS_META = {
    "table": "CAST(l_orderkey AS STRING)",
    "name": "CASE WHEN l_suppkey % 7 = 0 THEN 'Etl_' ELSE 'Col_' END || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING)",
    "ordinal": "l_linenumber",
    "identity": "l_returnflag = 'R'",
    "row_start": "l_linenumber = 6",
    "row_end": "l_linenumber = 7",
}


def _columns_meta(spark, sf):
    return cols(table(spark, sf, "lineitem"), _COLUMNS_META)


def _keys_meta(spark, sf):
    # built map-side first: each table keeps only its least and greatest name
    named = _columns_meta(spark, sf).groupBy("table").agg(F.min("name").alias("lo"), F.max("name").alias("hi"))
    number = F.col("table").cast("long")
    none = F.array().cast("array<string>")
    return named.select(
        "table",
        F.when(number % 3 == 0, none).otherwise(F.array(F.upper("hi"), "lo")).alias("pk"),
        F.when(number % 2 == 0, F.array("lo", "hi")).otherwise(none).alias("unique"),
    )


def q_business_key(spark, sf):
    return infer_business_key(_columns_meta(spark, sf), _keys_meta(spark, sf))


_BUSINESS_KEY = f"""
WITH cm AS (SELECT {sql_cols(_COLUMNS_META).replace(' AS table', ' AS tbl')} FROM lineitem),
k AS (SELECT tbl, min(name) AS lo, max(name) AS hi, CAST(tbl AS BIGINT) AS num FROM cm GROUP BY tbl),
pk AS (SELECT tbl, 0 AS position, upper(hi) AS col FROM k WHERE num % 3 <> 0
       UNION ALL SELECT tbl, 1, lo FROM k WHERE num % 3 <> 0),
nat AS (SELECT tbl, position, col FROM pk
        WHERE NOT EXISTS (SELECT 1 FROM cm WHERE cm.tbl = pk.tbl AND cm.identity AND lower(cm.name) = lower(pk.col))),
uni AS (SELECT * FROM (SELECT tbl, 0 AS position, lo AS col FROM k WHERE num % 2 = 0
                       UNION ALL SELECT tbl, 1, hi FROM k WHERE num % 2 = 0)
        WHERE tbl NOT IN (SELECT tbl FROM nat)),
rest AS (SELECT tbl, ordinal AS position, name AS col FROM cm
         WHERE NOT identity AND NOT row_start AND NOT row_end AND NOT starts_with(upper(name), 'ETL_')
           AND tbl NOT IN (SELECT tbl FROM nat) AND tbl NOT IN (SELECT tbl FROM uni))
SELECT tbl AS "table", position, col AS "column", 'primary_key' AS rule FROM nat
UNION ALL SELECT tbl, position, col, 'unique_constraint' FROM uni
UNION ALL SELECT tbl, position, col, 'all_columns_review' FROM rest"""

# One customer stands for a table object.
_OBJECTS = {
    "object_id": "CAST(c_custkey AS STRING)",
    "object_type": "CASE WHEN c_custkey % 5 = 0 THEN 'VIEW' ELSE 'TABLE' END",
    "schema_name": "'s' || CAST(c_nationkey AS STRING)",
    "object_name": "c_name",
    "full_name": "'s' || CAST(c_nationkey AS STRING) || '.' || c_name",
    "sig_has_temporal": "c_custkey % 2 = 0",
    "method": "CASE WHEN c_custkey % 6 = 0 THEN 'scd2_generator' ELSE 'ai' END",
    "valid_status": "CASE WHEN c_custkey % 8 = 0 THEN 'fail' ELSE 'pass' END",
}


def _objects(spark, sf):
    return cols(table(spark, sf, "customer"), _OBJECTS)


def q_select_temporal(spark, sf):
    o = _objects(spark, sf)
    meta = o.where("CAST(object_id AS BIGINT) % 3 = 0")
    return select_temporal(o.select("object_id", "object_type", "full_name"), o, meta)


def q_register(spark, sf):
    made = register_companions(_objects(spark, sf).where("object_type = 'TABLE' and sig_has_temporal"))
    return made.select("object_id", "object_type", "schema_name", "object_name", "full_name", "method", "attempt")


def q_pair(spark, sf):
    o = _objects(spark, sf)
    own = o.where("CAST(object_id AS BIGINT) % 7 <> 0").select("object_type", "full_name", "valid_status")
    companions = o.where("CAST(object_id AS BIGINT) % 3 = 0 and object_type = 'TABLE'").select(
        F.lit("PROCEDURE").alias("object_type"),
        F.upper(F.concat("full_name", F.lit("_scd2_apply"))).alias("full_name"), "valid_status",
    )
    tables = o.where("object_type = 'TABLE' and sig_has_temporal")
    return pair_companions(tables, o, own.unionByName(companions))


_DECLARED = {
    "l_quantity": "int", "l_extendedprice": "money", "l_discount": "decimal(10, 1)", "l_tax": "real",
    "l_linenumber": "tinyint", "l_partkey": "smallint", "l_returnflag": "nvarchar(1)", "l_shipdate": "date",
    "l_linestatus": "bigint",
}
_RAW = {
    "l_orderkey": "l_orderkey", "l_suppkey": "l_suppkey",
    "l_quantity": "CAST(CAST(l_quantity AS INT) AS STRING) || CASE WHEN l_orderkey % 50 = 0 THEN 'x' ELSE '' END",
    "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "l_tax": "l_tax",
    "l_linenumber": "l_linenumber", "l_partkey": "l_partkey * 20", "l_returnflag": "l_returnflag",
    "l_shipdate": "l_shipdate",
    "l_linestatus": "CASE WHEN l_linestatus = 'F' THEN '12' ELSE l_linestatus END",
}
_CAST_SQL = {
    "l_quantity": "INT", "l_extendedprice": "DECIMAL(19,4)", "l_discount": "DECIMAL(10,1)", "l_tax": "FLOAT",
    "l_linenumber": "TINYINT", "l_partkey": "SMALLINT", "l_returnflag": "VARCHAR", "l_shipdate": "DATE",
    "l_linestatus": "BIGINT",
}
_ENGINE = {
    "l_quantity": "INT", "l_extendedprice": "DECIMAL(19,4)", "l_discount": "DECIMAL(10,1)", "l_tax": "FLOAT",
    "l_linenumber": "TINYINT", "l_partkey": "SMALLINT", "l_returnflag": "STRING", "l_shipdate": "DATE",
    "l_linestatus": "BIGINT",
}


def q_conform(spark, sf):
    rows = conform_types(cols(table(spark, sf, "lineitem"), _RAW), _DECLARED, failures="lost")
    # decimals as doubles and the list as text: value types both engines print alike
    return rows.withColumns(
        {
            "l_extendedprice": F.col("l_extendedprice").cast("double"),
            "l_discount": F.col("l_discount").cast("double"),
            "l_tax": F.round(F.col("l_tax").cast("double"), 4),
            "lost": F.array_join("lost", ","),
        }
    )


def q_conform_report(spark, sf):
    return conform_report(cols(table(spark, sf, "lineitem"), _RAW), _DECLARED)


_RAW_SQL = f"raw AS (SELECT {sql_cols(_RAW)} FROM lineitem)"
_LOST = ", ".join(
    f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL THEN '{c}' END" for c, t in _CAST_SQL.items()
)
_CONFORM = f"""WITH {_RAW_SQL}
SELECT l_orderkey, l_suppkey, TRY_CAST(l_quantity AS INT) AS l_quantity,
  CAST(TRY_CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS l_extendedprice,
  CAST(TRY_CAST(l_discount AS DECIMAL(10,1)) AS DOUBLE) AS l_discount,
  round(CAST(TRY_CAST(l_tax AS FLOAT) AS DOUBLE), 4) AS l_tax,
  TRY_CAST(l_linenumber AS TINYINT) AS l_linenumber, TRY_CAST(l_partkey AS SMALLINT) AS l_partkey,
  l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate, TRY_CAST(l_linestatus AS BIGINT) AS l_linestatus,
  concat_ws(',', {_LOST}) AS lost FROM raw"""
_CONFORM_REPORT = f"WITH {_RAW_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_ENGINE[c]}' AS engine_type, count({c}) AS n_values, "
    f"count({c}) - count(TRY_CAST({c} AS {t})) AS n_failed FROM raw" for c, t in _CAST_SQL.items()
)

QUERIES = {
    "scd2_apply": q_apply, "scd2_reapply_noop": q_reapply, "scd2_three_snapshots": q_three,
    "scd2_close_missing": q_close, "scd2_stored_history": q_stored, "scd2_backfill": q_backfill,
    "scd2_changes": q_changes, "infer_business_key": q_business_key, "select_temporal": q_select_temporal,
    "register_companions": q_register, "pair_companions": q_pair, "conform_types": q_conform,
    "conform_report": q_conform_report,
}
_O = f"WITH o AS (SELECT {sql_cols(_OBJECTS)} FROM customer)"
ORACLE = {
    "scd2_apply": f"{_ONE} {_shown_sql('dim2')}",
    "scd2_reapply_noop": f"{_ONE} {_shown_sql('dim2')}",
    "scd2_three_snapshots": _THREE,
    "scd2_stored_history": _THREE,
    "scd2_close_missing": f"WITH {_SOURCES}{_step('dim1', 'src2', T1, 'dim2', close=True)} {_shown_sql('dim2')}",
    "scd2_backfill": f"{_ONE} {_shown_sql('dim2')}",
    "scd2_changes": _CHANGES,
    "infer_business_key": _BUSINESS_KEY,
    "select_temporal": f"""{_O} SELECT object_id, object_type, full_name, CAST(object_id AS BIGINT) % 3 = 0 AS has_meta
        FROM o WHERE object_type = 'TABLE' AND sig_has_temporal""",
    "register_companions": f"""{_O} SELECT substr(sha1('PROCEDURE/' || full_name || '_scd2_apply'), 1, 16) AS object_id,
        'PROCEDURE' AS object_type, schema_name, object_name || '_scd2_apply' AS object_name,
        full_name || '_scd2_apply' AS full_name, 'scd2_generator' AS method, 1 AS attempt
        FROM o WHERE object_type = 'TABLE' AND sig_has_temporal""",
    "pair_companions": f"""{_O},
        vp AS (SELECT upper(full_name || '_scd2_apply') AS full_name, valid_status FROM o
               WHERE CAST(object_id AS BIGINT) % 3 = 0 AND object_type = 'TABLE'),
        vt AS (SELECT full_name, valid_status FROM o WHERE CAST(object_id AS BIGINT) % 7 <> 0 AND object_type = 'TABLE')
        SELECT tt.full_name AS source_table, tbl.method AS scd2_method, vt.valid_status AS scd2_table_status,
          vp.valid_status AS scd2_apply_proc_status, tt.object_name || '_scd2_apply' AS apply_procedure
        FROM (SELECT * FROM o WHERE object_type = 'TABLE' AND sig_has_temporal) tt
        LEFT JOIN (SELECT * FROM o WHERE object_type = 'TABLE') tbl ON lower(tbl.full_name) = lower(tt.full_name)
        LEFT JOIN vt ON lower(vt.full_name) = lower(tt.full_name)
        LEFT JOIN vp ON lower(vp.full_name) = lower(tt.schema_name || '.' || tt.object_name || '_scd2_apply')""",
    "conform_types": _CONFORM,
    "conform_report": _CONFORM_REPORT,
}
