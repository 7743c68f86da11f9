"""Registered queries: reports over results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import report as R
from .common import RESULTS_SQL, cols, results, sql_cols, corpus, table

# --- SQL of the reports, with the labels written out ---
_SUCCESS = "valid_status IN ('pass', 'unresolved_ext_dep', 'sound_dep')"
_OPEN = "valid_status IN ('fail', 'timeout')"


def _first_of(ladder, timeout):
    """Label of the first place whose pattern hits; a timeout is asked after the text."""
    hit = f"SELECT arg_min(label, place) FROM (VALUES {ladder}) AS ladder(place, pattern, label) WHERE valid_error LIKE pattern"
    return f"coalesce(({hit}), CASE WHEN valid_status = 'timeout' THEN '{timeout}' ELSE 'other' END)"


# Patterns and labels of the two ladders, in order.
_CASE_A = _first_of("""(1, '%ONLY_AT_BEGINNING%', 'declare_placement'), (2, '%MATCHED%', 'merge_syntax'),
  (3, '%DELTA_INVALID_CHARACTERS%', 'column_name_chars'), (4, '%missing%', 'statement_termination'),
  (5, '%end of input%', 'unclosed_block'), (6, '%PYTHON_SYNTAX%', 'pyspark_syntax'), (7, '%PARSE_SYNTAX%', 'parse_other'),
  (8, '%UNRESOLVED_COLUMN%', 'unresolved_column'), (9, '%NOT_FOUND%', 'missing_dependency')""", "timeout")
_CASE_B = _first_of("""(1, '%PARSE_SYNTAX_ERROR%', 'parse syntax'), (2, '%PYTHON_SYNTAX%', 'python syntax'),
  (3, '%UNRESOLVED_COLUMN%', 'unresolved column'), (4, '%IDENTIFIER_TOO_MANY_NAME_PARTS%', 'cross-db 3-part name'),
  (5, '%UNRESOLVABLE_TABLE_VALUED_FUNCTION%', 'TVF unresolved')""", "timeout (transient)")
# the rows of the latest run among those of the largest fraction: first place by fraction, then by run
_FULL = "full_run AS (SELECT * EXCLUDE (place) FROM (SELECT *, dense_rank() OVER (ORDER BY fraction DESC, run_ts DESC) AS place FROM results) WHERE place = 1)"
_SUMMARY = f"""summary AS (FROM results SELECT run_ts, fraction, object_type, count(*) AS n, count(*) FILTER ({_SUCCESS}) AS success,
  round(100 * avg(CAST({_SUCCESS} AS INT)), 1) AS pct_success, count(*) FILTER (valid_status = 'pass') AS n_pass,
  count(*) FILTER (valid_status LIKE '%_dep') AS n_sound, count(*) FILTER (valid_status = 'fail') AS n_fail,
  count(*) FILTER (valid_status = 'timeout') AS n_timeout GROUP BY ALL)"""
_CONVERTED = {
    "object_id": "CAST(event_id AS STRING)",
    "method": "CASE event_id % 3 WHEN 0 THEN 'sqlglot' WHEN 1 THEN 'ai' END",
}
_FUNNEL_C = {"object_type": "o_orderpriority", "converted_code": "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus END"}
_FUNNEL_V = {
    "object_type": "o_orderpriority",
    "valid_status": "CASE WHEN o_totalprice < 200000 THEN 'pass' WHEN o_totalprice < 300000 THEN 'sound_dep' ELSE 'fail' END",
}
_C_WHERE, _V_WHERE = "o_orderpriority <> '5-LOW'", "o_orderkey % 4 = 0 AND o_orderpriority < '4'"


def q_funnel(spark, sf):
    orders = table(spark, sf, "orders")
    return R.reconcile(
        orders.select(F.col("o_orderpriority").alias("object_type")),
        cols(orders.where(_C_WHERE), _FUNNEL_C), cols(orders.where(_V_WHERE), _FUNNEL_V),
    )


def q_generated(spark, sf):
    """Orders without an even key count as generated."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("object_id"), F.col("o_orderpriority").alias("object_type")
    )
    return R.generated_only(orders.where("object_id % 2 = 0"), orders)


def q_review_queue(spark, sf):
    return R.review_queue(results(spark, sf), cols(table(spark, sf, "events"), _CONVERTED))


def q_excerpt(spark, sf):
    text = F.col("text")
    return corpus(spark, sf, "documents").select("doc_id", F.md5(L.excerpt(text, 220).cast("binary")).alias("excerpt"))


_TEMPLATE = (
    "CASE WHEN conv_id % 11 = 0 THEN NULL ELSE 'Type {role}, turn {turn} of {conv}: ' || "
    "CASE WHEN turn % 2 = 0 THEN '{text}' ELSE '({text})' END END"
)


def q_template(spark, sf):
    c = corpus(spark, sf, "conversations").withColumn("template", F.expr(_TEMPLATE))
    filled = L.render_template(
        F.col("template"),
        {"role": F.col("role"), "turn": F.col("turn"), "conv": F.col("conv_id"), "text": F.col("text")},
    )
    return c.select("conv_id", "turn", F.md5(filled.cast("binary")).alias("prompt"))


def _of(fn):
    return lambda spark, sf: fn(results(spark, sf))


QUERIES = {
    "inventory_by_type": _of(lambda r: R.inventory(r, ["object_type", "valid_status"])),
    "run_summary": _of(R.run_summary),
    "overall_rate": _of(lambda r: R.overall(R.run_summary(r), ["run_ts"])),
    "latest_run": _of(lambda r: R.run_summary(R.latest_run(r))),
    "latest_full_run": _of(lambda r: R.run_summary(R.latest_full_run(r))),
    "kpi": _of(lambda r: R.kpi(R.latest_full_run(r))),
    "status_by_type": _of(lambda r: R.status_by_type(R.latest_full_run(r))),
    "rollout_trend": _of(lambda r: R.rollout_trend(R.run_summary(r))),
    "failure_classes_review": _of(lambda r: R.failure_classes(r, L.REVIEW_CLASSES, "timeout")),
    "failure_classes_chart": _of(lambda r: R.failure_classes(R.latest_full_run(r))),
    "review_queue": q_review_queue,
    "review_list": _of(lambda r: R.review_list(R.latest_full_run(r))),
    "reconcile_funnel": q_funnel,
    "generated_only": q_generated,
    "excerpt": q_excerpt,
    "render_template": q_template,
}
_R = f"WITH {RESULTS_SQL}"
ORACLE = {
    "inventory_by_type": f"{_R} SELECT object_type, valid_status, count(*) AS n FROM results GROUP BY 1, 2",
    "run_summary": f"{_R}, {_SUMMARY} SELECT * FROM summary",
    "overall_rate": f"""{_R} FROM results SELECT run_ts, count(*) FILTER ({_SUCCESS}) AS success, count(*) AS n,
        round(100.0 * success / n, 1) AS pct_success GROUP BY run_ts""",
    "latest_run": f"{_R}, {_SUMMARY} SELECT * FROM summary QUALIFY dense_rank() OVER (ORDER BY run_ts DESC) = 1",
    "latest_full_run": f"{_R}, {_FULL}, {_SUMMARY.replace('FROM results', 'FROM full_run')} SELECT * FROM summary",
    "kpi": f"""{_R}, {_FULL} FROM full_run SELECT count(*) AS total, count(*) FILTER ({_SUCCESS}) AS success,
        round(100.0 * success / total, 1) AS pct_success, count(*) FILTER ({_OPEN}) AS needs_review""",
    "status_by_type": f"""{_R}, {_FULL}, names(valid_status, status) AS (VALUES ('pass', '1 pass'), ('sound_dep', '2 sound (dep)'),
        ('unresolved_ext_dep', '2 sound (dep)'), ('timeout', '3 timeout'), ('fail', '4 fail'))
        FROM full_run JOIN names USING (valid_status) SELECT object_type, status, count(*) AS n GROUP BY ALL""",
    "rollout_trend": f"""{_R} SELECT CAST(f AS STRING) AS fraction, round(100.0 * good / n, 1) AS pct_success, n
        FROM (SELECT fraction AS f, count(*) AS n, count(*) FILTER ({_SUCCESS}) AS good FROM results GROUP BY 1)""",
    "failure_classes_review": f"""{_R} SELECT {_CASE_A} AS errclass, count(*) AS n FROM results
        WHERE {_OPEN} GROUP BY 1""",
    "failure_classes_chart": f"""{_R}, {_FULL} SELECT {_CASE_B} AS errclass, count(*) AS n FROM full_run
        WHERE {_OPEN} GROUP BY 1""",
    "review_queue": f"""{_R}, c AS (SELECT {sql_cols(_CONVERTED)} FROM events)
        SELECT object_type, full_name, method, {_CASE_A} AS error_class, valid_status,
        substr(regexp_replace(valid_error, '[\\n]', ' ', 'g'), 1, 1000) AS error_detail
        FROM results JOIN c USING (object_id) WHERE valid_status IN ('fail', 'timeout')""",
    "review_list": f"""{_R}, {_FULL} SELECT object_type, full_name,
        substr(regexp_replace(valid_error, '[\\n]', ' ', 'g'), 1, 220) AS error
        FROM full_run WHERE valid_status IN ('fail', 'timeout')""",
    "reconcile_funnel": f"""WITH every AS (SELECT o_orderpriority AS object_type, TRUE AS s, {_C_WHERE} AND o_orderkey % 9 <> 0 AS c,
        {_V_WHERE} AS v, {_V_WHERE} AND o_totalprice < 300000 AS good FROM orders)
        SELECT object_type, count(*) FILTER (s) AS source_n, count(*) FILTER (c) AS converted_n, count(*) FILTER (v) AS validated_n,
        count(*) FILTER (good) AS success_n FROM every GROUP BY 1""",
    "generated_only": "SELECT o_orderpriority AS object_type, count(*) AS generated_n FROM orders WHERE o_orderkey % 2 <> 0 GROUP BY 1",
    "excerpt": "SELECT doc_id, md5(substr(replace(text, chr(10), ' '), 1, 220)) AS excerpt FROM documents",
    "render_template": """SELECT conv_id, turn, CASE WHEN conv_id % 11 <> 0 THEN md5('Type ' || role || ', turn ' || CAST(turn AS STRING)
        || ' of ' || CAST(conv_id AS STRING) || ': ' || CASE WHEN turn % 2 = 0 THEN text ELSE '(' || text || ')' END) END AS prompt
        FROM conversations""",
}
