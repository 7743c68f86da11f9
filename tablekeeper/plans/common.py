"""Inputs shared by the registered queries.

The provided tables hold no migration corpus, so relations of that shape are
derived from them. The deriving expressions are plain SQL text that Spark and
the checking engine both read, so each exists once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A text table. How many tasks read it is set by the session (``spark.sql.files.*``)."""
    return table(spark, sf_dir, name)


def cols(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Projection from a dict of name -> SQL text."""
    return df.select(*[F.expr(e).alias(n) for n, e in exprs.items()])


def sql_cols(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items())


NL = "chr(10)"
Q = "chr(39)"

# --- results: one event is one checked object ------------------------------

_ERRORS = [
    "'[DELTA_INVALID_CHARACTERS_IN_COLUMN_NAMES] a b'",
    f"'[PARSE_SYNTAX_ERROR] Syntax error at or near' || {NL} || 'MATCHED'",
    "'[PARSE_SYNTAX_ERROR] missing semicolon'",
    "'[PARSE_SYNTAX_ERROR] end of input'",
    "'PYTHON_SYNTAX: invalid syntax'",
    "'[PARSE SYNTAX ERROR] blank where the pattern has a wildcard'",
    "'[UNRESOLVED_COLUMN.WITH_SUGGESTION] x'",
    "'[TABLE_OR_VIEW_NOT_FOUND] y'",
    "'[IDENTIFIER_TOO_MANY_NAME_PARTS] a.b.c.d'",
    "'[ONLY_AT_BEGINNING] DECLARE then MATCHED'",
    "'[UNRESOLVABLE_TABLE_VALUED_FUNCTION] f'",
    "'Missing in capitals'",
]
_ERROR = "CASE event_id % 12 " + " ".join(f"WHEN {i} THEN {e}" for i, e in enumerate(_ERRORS)) + " END"
_STATUS = (
    "CASE WHEN value < 40 THEN 'pass' WHEN value < 55 THEN 'sound_dep' "
    "WHEN value < 70 THEN 'unresolved_ext_dep' WHEN value < 80 THEN 'timeout' ELSE 'fail' END"
)
RESULTS = {
    "run_ts": "CAST(CAST(ts AS DATE) AS STRING)",
    "fraction": "(EXTRACT(DAY FROM ts) % 4 + 1) * CAST(0.25 AS DOUBLE)",
    "object_id": "CAST(event_id AS STRING)",
    "object_type": "event_type",
    "full_name": "event_type || '.' || CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING)",
    "valid_status": _STATUS,
    "valid_error": f"CASE WHEN value < 40 THEN '' ELSE {_ERROR} || ' #' || CAST(event_id AS STRING) END",
}
RESULTS_SQL = f"results AS (SELECT {sql_cols(RESULTS)} FROM events)"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols(table(spark, sf_dir, "events"), RESULTS)


# --- scripts: one document is one source object -----------------------------

TYPE = (
    "CASE doc_id % 6 WHEN 0 THEN 'SCHEMA' WHEN 1 THEN 'SYNONYM' WHEN 2 THEN 'TABLE' "
    "WHEN 3 THEN 'FUNCTION' WHEN 4 THEN 'VIEW' ELSE 'PROCEDURE' END"
)


def _every(n: int, text: str) -> str:
    return f"CASE WHEN doc_id % {n} = 0 THEN {text} ELSE '' END"


SCRIPT = " || ".join(
    [
        f"'/* WHILE in a comment ' || {NL} || text || ' */' || {NL}",
        f"'CREATE ' || ({TYPE}) || ' [dbo].[obj' || CAST(doc_id AS STRING) || ']' || {NL}",
        _every(4, f"'DECLARE cur CURSOR FOR SELECT 1;' || {NL}"),
        _every(3, f"'WHILE @i < 10 SET @s = ' || {Q} || 'it' || {Q} || {Q} || 's MERGE INTO' || {Q} || ';' || {NL}"),
        _every(5, f"'SELECT a INTO #tmp FROM t -- BEGIN TRY' || {NL}"),
        _every(7, f"'MERGE INTO x USING y ON x.a = y.a' || {NL}"),
        _every(8, f"'BEGIN TRY' || {NL} || 'BEGIN TRAN' || {NL}"),
        _every(9, f"'EXEC (sp_helptext)' || {NL}"),
        _every(10, f"'SELECT * FROM q PIVOT (SUM(v) FOR k IN ([1])) p' || {NL}"),
        _every(11, f"'DECLARE @t TABLE (a INT IDENTITY(1,1))' || {NL}"),
        _every(13, f"'PERIOD FOR SYSTEM_TIME (a, b)' || {NL}"),
        _every(14, f"'@p INT OUTPUT' || {NL} || 'WITH c AS (SELECT 1)' || {NL}"),
        f"text || {NL} || text",
    ]
)
SCRIPTS = {"doc_id": "doc_id", "object_type": TYPE, "source_sql": SCRIPT}
SCRIPTS_SQL = f"scripts AS (SELECT {sql_cols(SCRIPTS)} FROM documents)"


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols(corpus(spark, sf_dir, "documents"), SCRIPTS)
