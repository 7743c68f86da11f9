"""Registered queries: table upkeep, roles of columns, and a whole run over a corpus."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import report as R
from ..operators.merge import union_parts
from ..operators.outcome import missing_name_pattern
from ..operators.scd2 import Window, open_history, scd2_columns, scd2_schema
from ..sources import tables as S
from .common import RESULTS_SQL, TYPE, results, table
from .reports import _SUMMARY
from .stages import Workspace, convert, ingest, normalize, repair, report, validate


def _folder(spark, name):
    return f"{S.stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def q_ensure_table(spark, sf):
    """A table that is made empty, filled, and left alone when it is made again."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    path = _folder(spark, "ensured")
    S.ensure_table(spark, path, rows.schema)
    S.append_table(rows, path)
    S.ensure_table(spark, path, "other string")
    return S.read_table(spark, path)


def q_probes(spark, sf):
    """Catalog probes around a table that holds the customers of each nation."""
    counts = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    name = f"probe_{uuid.uuid4().hex}"
    before = S.has_table(spark, name)
    S.ensure_schema(spark, "default", use=False)
    counts.write.option("path", _folder(spark, name)).saveAsTable(name)
    stored = spark.table(name)
    flags = {"was": before, "is": S.has_table(spark, name), "with_n": S.has_column(stored, "n"), "with_m": S.has_column(stored, "m")}
    return stored.withColumns({k: F.lit(v) for k, v in flags.items()})


def q_union_empty(spark, sf):
    """No part at all, then one: the empty relation has the columns of the other."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    none = union_parts(spark, [], rows.schema)
    return union_parts(spark, [none, rows], rows.schema).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


_META = [
    {"name": "c_custkey", "type": "bigint", "not_null": True}, {"name": "c_name", "type": "string"},
    {"name": "c_acctbal", "type": "double"}, {"name": "surrogate", "type": "int", "identity": True},
    {"name": "valid_from", "type": "timestamp", "row_start": True}, {"name": "valid_to", "type": "timestamp", "row_end": True},
]


def q_scd2_schema(spark, sf):
    """A first load in the described schema; the identity column is filled elsewhere."""
    roles, schema = scd2_columns(_META, ["c_custkey"]), scd2_schema(_META)
    loaded = open_history(table(spark, sf, "customer").select(*roles["business"]), "2024-01-01", window=Window("valid_from", "valid_to", "IsCurrent"), time_type="timestamp")
    full = loaded.select(*[F.col(f.name).cast(f.dataType) if f.name in loaded.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    return full.select(*roles["insert"], F.lit(",".join(roles["track"])).alias("track"), F.col("surrogate").isNull().alias("open")).drop("valid_from", "valid_to")


def q_ordered(spark, sf):
    """The first rows of a report in its order."""
    return R.ordered(R.run_summary(results(spark, sf)), ["-n", "run_ts"]).limit(20)


def q_whole_run(spark, sf):
    """Ingest, convert, normalize, validate, repair and report over all documents as scripts.

    The conversion writes a text's length; a check fails where 3 does not divide it, an even object is repaired.
    """
    docs = table(spark, sf, "documents")
    files = docs.select(
        F.concat(F.lit("/"), F.expr(TYPE), F.lit("/dbo.o"), F.col("doc_id").cast("string"), F.lit(".sql")).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )
    ws = Workspace(spark, _folder(spark, "run"))

    def measure(texts, cap=None):
        return [f"SELECT {len(t)};" for t in texts]

    tiers = {t: measure for t in ("trivial", "simple", "medium", "complex")}
    ingest(ws, files, {f: "{source}" for f in ("sql_ddl", "sql_view", "sql_function", "sql_scripting", "pyspark")}, {}, partitions=8)
    convert(ws, measure, tiers, partitions=8)
    normalize(ws)

    def check(rows):
        good = F.regexp_extract("code", "([0-9]+)", 1).cast("long") % 3 == 0
        return rows.withColumns({"state": F.when(good, "SUCCEEDED").otherwise("FAILED"), "error": F.when(~good, "[PARSE_SYNTAX_ERROR]")})

    def mend(context, pass_no):
        even = F.substring_index("full_name", ".o", -1).cast("long") % 2 == 0
        return context.select("object_id", "object_type", F.when(even, "SELECT 3;").otherwise("SELECT").alias("fixed"))

    miss = missing_name_pattern("_tmp__")
    validate(ws, "2024-01-31", 1.0, check, miss)
    repair(ws, "2024-01-31", mend, check, miss, passes=1, prefix="_tmp__")
    return report(ws)["run_summary"].drop("reported_at").withColumn("run_ts", F.col("run_ts").cast("string"))


QUERIES = {
    "ensure_table": q_ensure_table, "catalog_probes": q_probes, "union_empty": q_union_empty, "scd2_schema": q_scd2_schema,
    "ordered_report": q_ordered, "whole_run": q_whole_run,
}
ORACLE = {
    "ensure_table": "SELECT c_custkey, c_name FROM customer",
    "catalog_probes": """SELECT c_nationkey, count(*) AS n, FALSE AS "was", TRUE AS "is", TRUE AS with_n, FALSE AS with_m FROM customer GROUP BY 1""",
    "union_empty": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1",
    "scd2_schema": "SELECT c_custkey, c_name, c_acctbal, TRUE AS IsCurrent, 'c_name,c_acctbal' AS track, TRUE AS open FROM customer",
    "ordered_report": f"WITH {RESULTS_SQL}, {_SUMMARY} SELECT * FROM summary ORDER BY n DESC, run_ts, fraction, object_type LIMIT 20",
    "whole_run": f"""WITH o AS (SELECT {TYPE} AS object_type, length(text) % 3 = 0 OR doc_id % 2 = 0 AS good FROM documents)
        SELECT '2024-01-31' AS run_ts, CAST(1 AS DOUBLE) AS fraction, object_type, count(*) AS n, count(*) FILTER (good) AS success,
        round(100.0 * count(*) FILTER (good) / count(*), 1) AS pct_success, count(*) FILTER (good) AS n_pass, 0 AS n_sound,
        count(*) FILTER (NOT good) AS n_fail, 0 AS n_timeout FROM o GROUP BY object_type""",
}
