"""Registered queries: routing rows through batch functions, checking and repairing them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import outcome as O
from ..operators import repair as Fix
from ..operators import route as R
from ..sources.tables import map_table, observe_counts, rows_df, stage
from .common import RESULTS_SQL, TYPE, cols, results, sql_cols, corpus, table

# One document stands for one request.
_REQUEST = {
    "object_id": "CAST(doc_id AS STRING)",
    "object_type": TYPE,
    "complexity_tier": "CASE WHEN n_chars < 300 THEN 'trivial' WHEN n_chars < 1000 THEN 'simple' WHEN n_chars < 5000 THEN 'medium' ELSE 'complex' END",
    "source_bytes": "n_chars",
    "prompt": "CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'ERROR: no form' "
              "WHEN doc_id % 23 = 0 THEN 'FAULT ' || text ELSE text END",
}


def _requests(spark, sf):
    return cols(corpus(spark, sf, "documents"), _REQUEST)


def _done(spark, sf):
    return table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("object_id"))


def q_misses(spark, sf):
    rows = R.route_misses(
        _requests(spark, sf), _done(spark, sf), "object_id", template="prompt", error_prefix="ERROR",
    )
    return rows.select("object_id", "complexity_tier", "source_bytes")


def q_lookup(spark, sf):
    rows = _requests(spark, sf)
    ends = {"trivial": "small-model", "simple": "mid-model", "medium": "mid-model"}
    return rows.select("object_id", L.lookup(F.col("complexity_tier"), ends).alias("endpoint"))


def _deterministic(spark, sf):
    """A batch function that fails for some texts and finds nothing in others."""

    def mark(texts):
        if texts.str.startswith("FAULT").any():
            raise ValueError("injected fault")
        return [">" + t + "<" if "tion" in t else "" for t in texts]

    return R.try_map(_requests(spark, sf), mark, "prompt", F.col("object_type").isin("TABLE", "VIEW", "SCHEMA"))


def q_try_map(spark, sf):
    return _deterministic(spark, sf).select("object_id", F.md5(F.col("value").cast("binary")).alias("value"), "error")


def _functions():
    def measured(name):
        def call(texts, cap):
            if texts.str.startswith("FAULT").any():
                raise ValueError(f"injected fault under {cap}")
            return [f"{name}:{cap}:{len(t)}" for t in texts]

        return call

    return {name: measured(name) for name in ("trivial", "simple", "medium", "complex")}


def _inferred(spark, sf):
    rows = _requests(spark, sf).where("prompt is not null")
    called = map_table(
        rows, lambda df: R.batch_infer(df, _functions(), "complexity_tier", "prompt"), 8
    )
    return called.select("object_id", "complexity_tier", "resp.*")


def q_infer(spark, sf):
    return _inferred(spark, sf)


def q_provenance(spark, sf):
    det = stage(_deterministic(spark, sf).select("object_id", "value", "error"), "deterministic")
    inf = stage(_inferred(spark, sf), "inferred")
    merged = R.merge_outputs(_requests(spark, sf), det, inf, "object_id")
    return merged.select(
        "object_id", "method", F.md5(F.col("raw_code").cast("binary")).alias("raw_code"), "convert_error"
    )


def q_observed(spark, sf):
    """Counts taken on the way, while another aggregate runs."""
    rows, seen = observe_counts(_requests(spark, sf), f"requests-{uuid.uuid4().hex}", chars=F.sum("source_bytes"))
    tiers = rows.groupBy("complexity_tier").agg(F.count(F.lit(1)).alias("n")).count()
    return rows_df(spark, [(seen.get["n"], seen.get["chars"], tiers)], "n long, chars long, tiers long")


def q_audit(spark, sf):
    audited = R.with_audit(_requests(spark, sf).select("object_id"), attempt=2)
    return audited.select("object_id", "attempt", (F.col("converted_at") > "2020-01-01").alias("stamped"))


# --- outcomes ---------------------------------------------------------------

_MISSING = (
    "'[' || CASE event_id % 4 WHEN 0 THEN 'TABLE_OR_VIEW_NOT_FOUND' WHEN 1 THEN 'ROUTINE_NOT_FOUND' "
    "WHEN 2 THEN 'UNRESOLVED_ROUTINE' ELSE 'SYNTAX' END || '] cannot find `' || CASE WHEN event_id % 5 = 0 THEN 'plain' "
    "ELSE '_tmp__dbo`.`' || CASE WHEN event_id % 3 = 0 THEN 'Hot' ELSE 'Obj' || CAST(user_id AS STRING) END END || '` here'"
)
_OUTCOME = {
    "object_id": "CAST(event_id AS STRING)", "object_type": "event_type",
    "full_name": "'dbo.' || CAST(event_id AS STRING)",
    "state": "CASE WHEN value < 20 THEN 'SUCCEEDED' WHEN value < 25 THEN 'CANCELED' WHEN value < 28 THEN 'SUBMIT_ERR' ELSE 'FAILED' END",
    # every seventh error is long, and what counts stands at its end
    "error": f"CASE WHEN value < 20 THEN NULL WHEN event_id % 7 = 0 THEN repeat('trace line ', 300) || {_MISSING} ELSE {_MISSING} END",
}
_INVENTORY = "SELECT 'OBJ' || CAST(c_custkey AS STRING) AS object_name FROM customer WHERE c_custkey % 2 = 0"


def _classified(spark, sf):
    outcomes = cols(table(spark, sf, "events"), _OUTCOME)
    names = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(
        F.concat(F.lit("OBJ"), F.col("c_custkey").cast("string")).alias("object_name")
    )
    return O.classify_outcomes(outcomes, names, name="object_name", pattern=O.missing_name_pattern("_tmp__"))


def q_classify(spark, sf):
    return _classified(spark, sf).select("object_id", "state", "valid_status")


def q_to_results(spark, sf):
    return O.to_results(_classified(spark, sf), "2024-01-31", 0.5)


def q_retry(spark, sf):
    return O.retry_set(results(spark, sf), "PARSE_SYNTAX", object_type="click").select("object_id", "valid_status")


_OBJECT = {
    **_REQUEST, "object_type": f"CASE WHEN doc_id % 31 = 0 THEN 'TRIGGER' ELSE {TYPE} END",
    "converted_code": "CASE WHEN doc_id % 23 <> 0 THEN text END",
}


def q_validation_set(spark, sf):
    return O.validation_set(cols(corpus(spark, sf, "documents"), _OBJECT), 0.5).select("object_id", "object_type", "stage_no")


_PY = "CASE doc_id % 3 WHEN 0 THEN 'create or  replace function f() ' || text WHEN 1 THEN text ELSE 'CREATE PROCEDURE IF ' || text END"


def q_is_python(spark, sf):
    rows = corpus(spark, sf, "documents").select("doc_id", F.expr(_PY).alias("code"))
    return rows.select("doc_id", Fix.is_python(F.col("code")).alias("is_python"))


# --- repair -----------------------------------------------------------------

_STATE = {
    "object_id": "CAST(doc_id AS STRING)", "object_type": TYPE, "full_name": "'dbo.' || CAST(doc_id AS STRING)",
    "converted_code": "text", "attempt": "1",
}
_CHECKED = {
    "run_ts": "'2024-01-31'", "object_id": "CAST(doc_id AS STRING)",
    "valid_status": "CASE doc_id % 5 WHEN 0 THEN 'fail' WHEN 1 THEN 'timeout' ELSE 'pass' END",
    "valid_error": "CASE WHEN doc_id % 5 < 2 THEN 'bad _tmp__dbo' ELSE '' END",
}
_OLD_RUN = {**_CHECKED, "run_ts": "'2024-01-30'"}


def q_repair(spark, sf):
    """Even ids pass after one repair, odd ones after two, every third never; every seventh answer is cut off."""
    docs = corpus(spark, sf, "documents")
    number = F.col("object_id").cast("long")

    def repair(context, pass_no):
        done = F.concat(F.lit(f"```sql\nSELECT {pass_no} /* _tmp___tmp__"), F.col("object_id"), F.lit(" */;\n```"))
        return context.select(
            "object_id", "object_type", F.when(number % 7 == 0, F.lit("SELECT")).otherwise(done).alias("fixed")
        )

    def check(fixes):
        good = (number % 3 != 0) & ((number % 2 == 0) | F.col("code").startswith("SELECT 1"))
        return fixes.select(
            "object_id", F.when(good, "pass").otherwise("fail").alias("valid_status"),
            F.when(good, "").otherwise(F.concat(F.lit("still bad: "), F.col("code"))).alias("valid_error"),
        )

    checked = cols(docs, _CHECKED).unionByName(cols(docs, _OLD_RUN))
    code, state = Fix.repair_until(
        cols(docs, _STATE), checked, "2024-01-31", repair, check, passes=2, prefix="_tmp__"
    )
    return code.join(state, "object_id").select(
        "object_id", "run_ts", "attempt", F.md5(F.col("converted_code").cast("binary")).alias("code"),
        "valid_status", "valid_error",
    )


def q_context(spark, sf):
    docs = corpus(spark, sf, "documents").where("doc_id % 5 < 2")
    failing = cols(docs, _STATE).join(cols(docs, _CHECKED), "object_id")
    failing = failing.withColumn("converted_code", F.concat(F.lit("_tmp___tmp__"), F.col("converted_code")))
    kinds = {k: k.lower() for k in Fix.DIRECTIVES}
    ctx = Fix.repair_context(failing, "_tmp__", kinds)
    return ctx.withColumn("code", F.md5(F.col("code").cast("binary")))


QUERIES = {
    "route_misses": q_misses, "tier_lookup": q_lookup, "try_map": q_try_map, "batch_infer": q_infer,
    "merge_provenance": q_provenance, "observe_counts": q_observed, "with_audit": q_audit, "classify_outcomes": q_classify,
    "to_results": q_to_results, "retry_set": q_retry, "validation_set": q_validation_set, "is_python": q_is_python,
    "repair_until": q_repair, "repair_context": q_context,
}
_REQ = f"req AS (SELECT {sql_cols(_REQUEST)} FROM documents)"
_ELIGIBLE = "object_type IN ('TABLE', 'VIEW', 'SCHEMA') AND length(prompt) > 0"
_DET = f"""det AS (SELECT object_id,
  CASE WHEN {_ELIGIBLE} AND prompt NOT LIKE 'FAULT%' AND contains(prompt, 'tion') THEN '>' || prompt || '<' END AS value,
  CASE WHEN ({_ELIGIBLE}) IS NOT TRUE THEN 'skipped' WHEN prompt LIKE 'FAULT%' THEN 'injected fault'
       WHEN NOT contains(prompt, 'tion') THEN 'empty' END AS error FROM req)"""
_CAP = "CASE complexity_tier WHEN 'trivial' THEN '4096' WHEN 'simple' THEN '8192' WHEN 'medium' THEN '16000' ELSE '32000' END"
_INF = f"""inf AS (SELECT object_id, complexity_tier,
  CASE WHEN prompt NOT LIKE 'FAULT%' THEN complexity_tier || ':' || {_CAP} || ':' || CAST(length(prompt) AS STRING) END AS result,
  CASE WHEN prompt LIKE 'FAULT%' THEN 'injected fault under ' || {_CAP} END AS errorMessage FROM req WHERE prompt IS NOT NULL)"""
_CLASSIFIED = f"""WITH o AS (SELECT {sql_cols(_OUTCOME)} FROM events), inv AS (SELECT DISTINCT lower(object_name) AS name FROM ({_INVENTORY})),
n AS (SELECT *, CASE WHEN contains(error, 'TABLE_OR_VIEW_NOT_FOUND') OR contains(error, 'ROUTINE_NOT_FOUND') OR contains(error, 'UNRESOLVED_ROUTINE')
      THEN nullif(lower(regexp_extract(error, '_tmp__[A-Za-z0-9_]+`?\\s*\\.\\s*`?([A-Za-z0-9_]+)', 1)), '') END AS missing FROM o),
c AS (SELECT *, CASE WHEN state = 'SUCCEEDED' THEN 'pass' WHEN state IN ('CANCELED', 'CLOSED', 'SUBMIT_ERR') THEN 'fail'
      WHEN missing IS NULL THEN 'fail' WHEN missing IN (SELECT name FROM inv) THEN 'sound_dep' ELSE 'unresolved_ext_dep' END AS valid_status FROM n)"""
_FIX = "'SELECT {0} /* ' || CAST(doc_id AS STRING) || ' */;'"
_REPAIRED = f"""WITH d AS (SELECT doc_id, text, doc_id % 5 < 2 AS failing, doc_id % 5 < 2 AND doc_id % 7 <> 0 AS fixable,
  doc_id % 3 <> 0 AND doc_id % 2 = 0 AS one, doc_id % 3 <> 0 AS two FROM documents),
e AS (SELECT *, CASE WHEN NOT fixable THEN text WHEN one THEN {_FIX.format(0)} ELSE {_FIX.format(1)} END AS code FROM d),
runs AS (SELECT {sql_cols(_CHECKED)}, doc_id FROM documents UNION ALL SELECT {sql_cols(_OLD_RUN)}, doc_id FROM documents)
SELECT object_id, run_ts, CASE WHEN NOT fixable THEN 1 WHEN one THEN 2 ELSE 3 END AS attempt, md5(code) AS code,
  CASE WHEN run_ts < '2024-01-31' OR NOT fixable THEN valid_status WHEN two THEN 'pass' ELSE 'fail' END AS valid_status,
  CASE WHEN run_ts < '2024-01-31' OR NOT fixable THEN valid_error WHEN two THEN '' ELSE 'still bad: ' || code END AS valid_error
FROM e JOIN runs USING (doc_id)"""
_W = f"WITH {_REQ}"
ORACLE = {
    "route_misses": f"""{_W} SELECT object_id, complexity_tier, source_bytes FROM req
        WHERE prompt NOT LIKE 'ERROR%' AND object_id NOT IN (SELECT CAST(doc_id AS STRING) FROM labels WHERE quality = 1)""",
    "tier_lookup": f"""{_W} SELECT object_id, CASE complexity_tier WHEN 'trivial' THEN 'small-model' WHEN 'complex' THEN NULL ELSE 'mid-model' END
        AS endpoint FROM req""",
    "try_map": f"{_W}, {_DET} SELECT object_id, md5(value) AS value, error FROM det",
    "batch_infer": f"{_W}, {_INF} SELECT object_id, complexity_tier, result, errorMessage FROM inf",
    "merge_provenance": f"""{_W}, {_DET}, {_INF} SELECT object_id, CASE WHEN value IS NOT NULL THEN 'sqlglot' WHEN result IS NOT NULL THEN 'ai' END AS method,
        md5(coalesce(value, result)) AS raw_code, errorMessage AS convert_error
        FROM req LEFT JOIN det USING (object_id) LEFT JOIN inf USING (object_id)""",
    "observe_counts": f"""{_W} SELECT count(*) AS n, CAST(sum(source_bytes) AS BIGINT) AS chars,
        count(DISTINCT complexity_tier) AS tiers FROM req""",
    "with_audit": f"{_W} SELECT object_id, 2 AS attempt, TRUE AS stamped FROM req",
    "classify_outcomes": f"{_CLASSIFIED} SELECT object_id, state, valid_status FROM c",
    "to_results": f"""{_CLASSIFIED} SELECT '2024-01-31' AS run_ts, CAST(0.5 AS DOUBLE) AS fraction, object_id, object_type, full_name,
        valid_status, coalesce(error, '') AS valid_error FROM c""",
    "retry_set": f"""WITH {RESULTS_SQL} SELECT object_id, valid_status FROM results WHERE object_type = 'click'
        AND valid_status IN ('fail', 'timeout') AND contains(valid_error, 'PARSE_SYNTAX')""",
    "validation_set": f"""WITH o AS (SELECT {sql_cols(_OBJECT)} FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY object_type ORDER BY object_id) AS rn, count(*) OVER (PARTITION BY object_type) AS n
              FROM o WHERE converted_code IS NOT NULL)
        SELECT object_id, object_type, CASE object_type WHEN 'SCHEMA' THEN 1 WHEN 'TABLE' THEN 2 WHEN 'SYNONYM' THEN 3 WHEN 'FUNCTION' THEN 4
        WHEN 'VIEW' THEN 5 WHEN 'PROCEDURE' THEN 6 ELSE 7 END AS stage_no FROM r WHERE rn <= greatest(1, n // 2)""",
    "is_python": f"""SELECT doc_id, NOT regexp_matches({_PY}, '(?is)\\bCREATE\\s+(?:OR\\s+REPLACE\\s+)?(?:IF\\s+NOT\\s+EXISTS\\s+)?(?:PROCEDURE|FUNCTION)\\b')
        AS is_python FROM documents""",
    "repair_until": _REPAIRED,
    "repair_context": f"""SELECT CAST(doc_id AS STRING) AS object_id, {TYPE} AS object_type, 'dbo.' || CAST(doc_id AS STRING) AS full_name,
        CASE doc_id % 6 WHEN 4 THEN 'view' WHEN 2 THEN 'table' ELSE 'python' END AS directive, 'bad dbo' AS error, md5(text) AS code
        FROM documents WHERE doc_id % 5 < 2""",
}
