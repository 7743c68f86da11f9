import pytest
from pyspark.sql import functions as F

from tablekeeper.operators import outcome as O
from tablekeeper.operators import report as R
from tablekeeper.operators import route
from tablekeeper.operators.repair import directive, repair_until


def test_try_map_keeps_errors_with_their_row(spark):
    df = spark.createDataFrame([(1, "ok", True), (2, "bad", True), (3, "none", True), (4, "ok", False), (5, None, True), (6, "", True), (7, "ok", None)],
                               "id int, t string, e boolean").coalesce(1)

    def fn(texts):
        if (texts == "bad").any():
            raise RuntimeError("x" * 400)
        return [None if t == "none" else t.upper() for t in texts]

    got = {r.id: (r.value, r.error) for r in route.try_map(df, fn, "t", F.col("e")).collect()}
    assert got == {1: ("OK", None), 2: (None, "x" * 400), 3: (None, "empty"), 4: (None, "skipped"), 5: (None, "skipped"),
                   6: (None, "skipped"), 7: (None, "skipped")}


def test_infer_failure_is_data(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "boom"), (3, "b", "y"), (4, None, "z")], "id int, tier string, t string")

    def fn(texts, cap):
        if (texts == "boom").any():
            raise ValueError("no")
        return [f"{t}{cap}" for t in texts]

    got = {r.id: tuple(r.resp) for r in route.batch_infer(df, {"a": fn}, "tier", "t", caps={"a": 5}, partitions=2).collect()}
    assert got[1] == ("x5", None) and got[2] == (None, "no") and got[3][1] == "no function for tier b" and got[4][0] is None


def test_route_and_merge(spark):
    req = spark.createDataFrame([("a", False, "p"), ("b", True, "p"), ("c", False, None), ("d", False, "ERR x"), ("e", False, "p")],
                                "object_id string, big boolean, prompt string")
    done = spark.createDataFrame([("e",), ("e",)], "object_id string")
    got = route.route_misses(req, done, "object_id", oversized="big", template="prompt", error_prefix="ERR")
    assert [r.object_id for r in got.collect()] == ["a"]
    det = spark.createDataFrame([("e", "E")], "object_id string, value string")
    inf = spark.createDataFrame([("a", "A", None), ("d", None, "why"), ("e", "no", None)], "object_id string, result string, errorMessage string")
    merged = {r.object_id: (r.method, r.raw_code, r.convert_error) for r in route.merge_outputs(req, det, inf, "object_id").collect()}
    assert merged == {"a": ("ai", "A", None), "b": (None, None, None), "c": (None, None, None), "d": (None, None, "why"), "e": ("sqlglot", "E", None)}


def test_classify(spark):
    pattern = O.missing_name_pattern("tmp__")
    rows = [("1", "SUCCEEDED", None, "pass"), ("2", "CANCELED", "TABLE_OR_VIEW_NOT_FOUND tmp__s.known", "fail"),
            ("3", "FAILED", "TABLE_OR_VIEW_NOT_FOUND `tmp__s`.`Known`", "sound_dep"), ("4", "FAILED", "ROUTINE_NOT_FOUND tmp__s.other x", "unresolved_ext_dep"),
            ("5", "FAILED", "TABLE_OR_VIEW_NOT_FOUND plain", "fail"), ("6", "FAILED", "syntax tmp__s.known", "fail"), ("7", "FAILED", None, "fail"), ("8", "SUBMIT_ERR", "", "fail")]
    df = spark.createDataFrame(rows, "object_id string, state string, error string, want string")
    names = spark.createDataFrame([("KNOWN",), ("known",), (None,)], "object_name string")
    got = O.classify_outcomes(df, names, name="object_name", pattern=pattern)
    assert got.count() == 8 and got.where("want <> valid_status").count() == 0


def test_references_and_retry(spark):
    df = spark.createDataFrame([(1, "x.A x.b x.a"), (2, "x.zz"), (3, "none")], "id int, t string")
    names = spark.createDataFrame([("a",), ("B",)], "n string")
    got = {r.id: (r.n_refs, r.n_known, r.all_known) for r in O.resolve_references(df, ["id"], "t", r"x\.(\w+)", names, name="n").collect()}
    assert got == {1: (2, 2, True), 2: (1, 0, False), 3: (0, 0, True)}
    spaces = O.referenced_namespaces(spark.createDataFrame([("m.a b.x m. c .y m.d.z m.d.q",)], "t string"), "t", r"m\s*\.([A-Za-z0-9_ ]+?)\s*\.")
    assert sorted(r[0] for r in spaces.collect()) == ["c", "d"]
    results = spark.createDataFrame([("fail", f"x {O.TRANSIENT} y"), ("pass", O.TRANSIENT), ("timeout", "cap"), ("fail", None)], "valid_status string, valid_error string")
    assert O.retry_set(results).count() == 1


def test_latest_rules_differ(spark):
    rows = [("2024-01-01", 1.0, "a"), ("2024-01-02", 1.0, "b"), ("2024-01-02", 1.0, "c"), ("2024-01-03", 0.25, "d"), ("2024-01-04", None, "e")]
    df = spark.createDataFrame(rows, "run_ts string, fraction double, object_id string")
    assert [r.object_id for r in R.latest_run(df).collect()] == ["e"]
    assert sorted(r.object_id for r in R.latest_full_run(df).collect()) == ["b", "c"]


def test_empty_reports(spark):
    empty = spark.createDataFrame([], "run_ts string, fraction double, object_type string, valid_status string, valid_error string, object_id string, full_name string")
    assert tuple(R.kpi(empty).first()) == (0, 0, None, 0)
    assert R.run_summary(empty).count() == 0 and R.latest_full_run(empty).count() == 0


def test_pairing_refuses_names_that_differ_in_case_only(spark):
    tables = spark.createDataFrame([("s.t", "s", "t")], "full_name string, schema_name string, object_name string")
    converted = spark.createDataFrame([("TABLE", "s.T", "x"), ("TABLE", "S.t", "y")], "object_type string, full_name string, method string")
    results = spark.createDataFrame([], "object_type string, full_name string, valid_status string")
    with pytest.raises(ValueError):
        R.pair_companions(tables, converted, results)


def test_repair_stops_and_truncated_fixes_are_dropped(spark):
    converted = spark.createDataFrame([("1", "VIEW", "a", "old", 1), ("2", "VIEW", "b", "old", 1), ("3", "VIEW", "c", "old", 1)],
                                      "object_id string, object_type string, full_name string, converted_code string, attempt int")
    results = spark.createDataFrame([("r", "1", "fail", "e"), ("r", "2", "timeout", None), ("r", "3", "pass", ""), ("q", "1", "fail", "e")],
                                    "run_ts string, object_id string, valid_status string, valid_error string")
    calls = []

    def repair(context, number):
        calls.append(number)
        return context.select("object_id", "object_type", F.when(F.col("object_id") == "1", "SELECT 1;").otherwise("SELECT").alias("fixed"))

    def check(fixes):
        return fixes.select("object_id", F.lit("pass").alias("valid_status"), F.lit(None).cast("string").alias("valid_error"))

    code, state = repair_until(converted, results, "r", repair, check, passes=3)
    assert calls == [0, 1, 2]
    assert sorted((r.object_id, r.converted_code, r.attempt) for r in code.collect()) == [("1", "SELECT 1;", 2), ("2", "old", 1), ("3", "old", 1)]
    assert sorted((r.run_ts, r.object_id, r.valid_status) for r in state.collect()) == [
        ("q", "1", "fail"), ("r", "1", "pass"), ("r", "2", "timeout"), ("r", "3", "pass")]
    calls.clear()
    repair_until(code, state.where("object_id <> '2'"), "r", repair, check)
    assert calls == []


def test_directive(spark):
    df = spark.createDataFrame([("VIEW", "x"), ("FUNCTION", "CREATE FUNCTION f"), ("PROCEDURE", "create procedure p"), ("PROCEDURE", "def run()")], "k string, c string")
    kinds = {k: k for k in ("VIEW", "TABLE", "PYTHON", "PROCEDURE", "FUNCTION")}
    assert [r[0] for r in df.select(directive(F.col("k"), F.col("c"), kinds)).collect()] == ["VIEW", "FUNCTION", "PROCEDURE", "PYTHON"]
