"""A whole run over a small corpus of files, then a second one over its results."""

from pyspark.sql import functions as F

from tablekeeper.operators.outcome import missing_name_pattern
from tablekeeper.plans import stages as S

FILES = {
    "TABLE/dbo.plain.sql": "CREATE TABLE dbo.plain (a INT NULL, b INT DEFAULT 1)",
    "TABLE/dbo.hist.sql": "CREATE TABLE dbo.hist (a INT) WITH (SYSTEM_VERSIONING = ON)",
    "VIEW/dbo.v.sql": "CREATE VIEW dbo.v AS SELECT * FROM dbo.gone",
    "VIEW/dbo.leak.sql": "CREATE VIEW dbo.leak AS SELECT [x] FROM t",
    "PROCEDURE/dbo.p.sql": "CREATE PROCEDURE dbo.p AS BEGIN EXEC (x) END",
    "PROCEDURE/dbo.big.sql": "-- " + "x" * 5000,
    "SCHEMA/dbo.sql": "CREATE SCHEMA dbo",
}


def callables():
    # nested, so that they travel to the workers by value
    def deterministic(texts):
        return [None if "[" in t else t.replace("dbo.", "main.dbo.") + ";" for t in texts]

    def infer(texts, cap):
        return [f"Sure:\n```sql\nCREATE PROCEDURE main.dbo.x AS BEGIN SELECT {len(t) > 0}; END;\n```" for t in texts]

    return deterministic, infer


def check(rows):
    code = F.col("code")
    error = (
        F.when(code.contains("gone"), "TABLE_OR_VIEW_NOT_FOUND `tmp__dbo`.`gone`")
        .when(code.contains("SELECT true") | code.contains("SELECT True"), "PARSE_SYNTAX missing ; at tmp__dbo")
    )
    return rows.withColumn("error", error).withColumn("state", F.when(error.isNull(), "SUCCEEDED").otherwise("FAILED"))


def repair(context, number):
    return context.select("object_id", "object_type", F.lit(f"CREATE PROCEDURE p AS BEGIN SELECT {number}; END;").alias("fixed"))


def test_run(spark, tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode("utf-16") if "hist" in name else text.encode())
    deterministic, infer = callables()
    ws = S.Workspace(spark, str(tmp_path / "ws"))
    templates = {f: "To {schema}.{object}:\n{source}" for f in ("sql_ddl", "sql_view", "sql_function", "sql_scripting", "pyspark")}
    requests = S.ingest(ws, str(tmp_path / "in"), templates, {"complex": "large"}, max_bytes=4000, partitions=4)
    assert requests.where("oversized").count() == 1 and requests.where("prompt is null").count() == 0
    tiers = {t: infer for t in ("trivial", "simple", "medium", "complex")}
    converted = S.convert(ws, deterministic, tiers, partitions=4)
    methods = {r.object_name: r.method for r in converted.collect()}
    assert methods == {"plain": "sqlglot", "hist": "sqlglot", "v": "sqlglot", "leak": "ai", "p": "ai", "big": None, "dbo": "sqlglot"}

    meta = spark.createDataFrame([("dbo.hist", "CREATE TABLE main.dbo.hist (a INT, IsCurrent BOOLEAN);", "CREATE PROCEDURE a AS BEGIN SELECT 1; END;")],
                                 "full_name string, table_code string, apply_code string")
    for _ in range(2):
        normal = S.normalize(ws, temporal_meta=meta)
        rows = {r.object_name: r for r in normal.collect()}
        assert len(rows) == 8 and rows["hist_scd2_apply"].method == "scd2_generator" and "IsCurrent" in rows["hist"].converted_code
    assert rows["plain"].converted_code == (
        "CREATE TABLE main.dbo.plain (a INT, b INT DEFAULT 1) TBLPROPERTIES ('delta.feature.allowColumnDefaults' = 'supported');")
    assert rows["p"].converted_code.startswith("CREATE PROCEDURE") and "SQL SECURITY INVOKER" in rows["p"].converted_code
    assert rows["dbo"].converted_code == "CREATE SCHEMA IF NOT EXISTS dbo;"

    pattern = missing_name_pattern("tmp__")
    S.validate(ws, "2024-01-01", 0.25, check, pattern)
    results = S.validate(ws, "2024-01-02", 1.0, check, pattern)
    status = {r.full_name: r.valid_status for r in results.collect()}
    assert len(status) == 7 and status["dbo.v"] == "unresolved_ext_dep" and status["dbo.p"] == status["dbo.leak"] == "fail"
    S.repair(ws, "2024-01-02", repair, check, pattern, prefix="tmp__")
    for _ in range(2):
        out = S.report(ws)
        summary = {r.object_type: (r.n, r.success) for r in out["run_summary"].where("run_ts = '2024-01-02'").collect()}
        assert summary == {"SCHEMA": (1, 1), "TABLE": (2, 2), "VIEW": (2, 2), "PROCEDURE": (2, 2)}
        assert out["manual_review"].count() == 0
    funnel = {r.object_type: tuple(r)[1:] for r in out["recon_inventory"].collect()}
    assert funnel["PROCEDURE"] == (2, 2, 2, 2) and funnel["TABLE"] == (2, 2, 2, 2)
    assert tuple(out["temporal_tables"].first()) == ("dbo.hist", "scd2_generator", "pass", "pass", "hist_scd2_apply")
    assert ws.read("converted_objects").where("object_name = 'p'").first().attempt == 2
    assert ws.runs("validation_results", S.RESULT_SCHEMA).select("run_ts").distinct().count() == 2
