"""Rows and texts at the edge: NULL flags and keys, hot keys, line ends, long errors, callers' own patterns."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablekeeper.functions import profile as P
from tablekeeper.functions import rewrite as W
from tablekeeper.functions import tsql as T
from tablekeeper.operators import joins, merge, outcome, report, route
from tablekeeper.operators.ranking import sort_key
from tablekeeper.operators.scd2 import open_history, scd2_apply
from tablekeeper.sources import tables as S
from tablekeeper.sources.history import HistoryTable


def test_history_keeps_rows_without_flag(spark):
    rows = [("a", 1, None), ("a", 2, True), ("b", 1, True)]
    dim = spark.createDataFrame(rows, "k string, v int, IsCurrent boolean")
    dim = dim.withColumn("valid_from", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("valid_to", F.lit("9999-12-31").cast("timestamp_ntz"))
    source = spark.createDataFrame([("a", 3), ("b", 1)], "k string, v int")
    out = scd2_apply(dim, source, ["k"], ["v"], "2024-02-01")
    assert sorted((r.k, r.v, r.IsCurrent) for r in out.collect() if r.IsCurrent is not None) == [("a", 2, False), ("a", 3, True), ("b", 1, True)]
    assert out.where("IsCurrent IS NULL").count() == 1


def test_two_open_versions_are_refused(spark):
    source = spark.createDataFrame([("a", 1)], "k string, v int")
    dim = open_history(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), "2024-01-01")
    with pytest.raises(ValueError, match="open versions"):
        scd2_apply(dim, source, ["k"], ["v"], "2024-02-01")


def test_stored_history_writes_touched_buckets_only(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), ["k"], ["v"], buckets=8)
    rows = [(f"k{i}", 1) for i in range(40)]
    table.load(spark.createDataFrame(rows, "k string, v int"), "2024-01-01")
    table.apply(spark.createDataFrame([("k0", 2), *rows[1:]], "k string, v int"), "2024-02-01")
    table.apply(spark.createDataFrame([("k0", 2), *rows[1:]], "k string, v int"), "2024-03-01")
    table.apply(spark.createDataFrame(rows[5:], "k string, v int"), "2024-04-01", deletes="close")
    opened = {n: len(list((tmp_path / "h" / f"tk_version={n}").glob("IsCurrent=true/tk_bucket=*"))) for n in (1, 2, 3)}
    assert opened == {1: 8, 2: 1, 3: 0}
    before = sorted(map(str, table.read().collect()))
    assert len(before) == 41 and table.current().count() == 35
    assert table.drop_stale() and not table.drop_stale()
    assert sorted(map(str, table.read().collect())) == before


def test_a_version_is_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    S.publish(spark.range(1), path, 1)
    with pytest.raises(FileExistsError):
        S.publish(spark.range(2), path, 1)
    assert S.versions(spark, path) == [1] and S.read_version(spark, path).count() == 1


@pytest.mark.parametrize("per_salt", [3, 1_000])
def test_spread_join(spark, per_salt):
    left = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(60)], "id int, name string")
    right = spark.createDataFrame([("hot", 1), ("k6", 2), (None, 3)], "name string, x int")
    out = {r.id: r.x for r in joins.spread_join(left, right, ["name"], salt_by=["id"], per_salt=per_salt).collect()}
    assert out == {i: 1 if i % 3 else 2 if i == 6 else None for i in range(60)}
    inner = joins.spread_join(left, right, ["name"], salt_by=["id"], how="inner", per_salt=per_salt)
    assert inner.count() == 41


def test_null_keys(spark):
    target = spark.createDataFrame([(None, 1), (2, 1)], "k int, v int")
    rows = spark.createDataFrame([(None, 9), (2, 9), (3, 9)], "k int, v int")
    assert sorted(map(str, merge.append_new(target, rows, ["k"]).collect())) == sorted(map(str, [*target.collect(), rows.collect()[2]]))
    merged = merge.merge_update(target, rows.dropna(), ["k"], {"v": F.col("s.v")})
    assert {r.k: r.v for r in merged.collect()} == {None: 1, 2: 9}
    replaced = merge.replace_where(target, rows.where("k = 2"), ["k"])
    assert sorted((r.k or 0, r.v) for r in replaced.collect()) == [(0, 1), (2, 9)]


def test_failing_batch_is_halved(spark):
    seen = spark.sparkContext.accumulator(0)

    def fn(texts):
        seen.add(1)
        if (texts == "bad").any():
            raise ValueError("x" * 5_000 + " end")
        return list(texts)

    df = spark.createDataFrame([(i, "bad" if i == 777 else f"t{i}") for i in range(2_000)], "id int, t string").coalesce(1)
    out = {r.id: (r.value, r.error) for r in route.try_map(df, fn, "t", F.lit(True)).collect()}
    assert out[777] == (None, "x" * 5_000 + " end") and all(out[i] == (f"t{i}", None) for i in range(2_000) if i != 777)
    assert seen.value <= 1 + 2 * 11


def test_oversized_rows_stay_with_a_reason(spark):
    requests = spark.createDataFrame([("a", False), ("b", True)], "object_id string, oversized boolean")
    nothing = spark.createDataFrame([], "object_id string, value string")
    inferred = spark.createDataFrame([("a", "x", None)], "object_id string, result string, errorMessage string")
    out = {r.object_id: (r.raw_code, r.convert_error) for r in route.merge_outputs(requests, nothing, inferred, "object_id").collect()}
    assert out == {"a": ("x", None), "b": (None, "oversized")}


def test_unknown_types_and_states(spark):
    rows = spark.createDataFrame([("1", "TRIGGER", "x"), ("2", "VIEW", "x"), ("3", None, "x"), ("4", "VIEW", None)], "object_id string, object_type string, converted_code string")
    assert {r.object_id: r.stage_no for r in outcome.validation_set(rows, 1.0).collect()} == {"1": 7, "2": 5, "3": 7}
    names = spark.createDataFrame([("known",)], "object_name string")
    case = spark.createDataFrame([("1", None, "TABLE_OR_VIEW_NOT_FOUND p_s.known"), ("2", None, None)], "object_id string, state string, error string")
    got = outcome.classify_outcomes(case, names, name="object_name", pattern=outcome.missing_name_pattern("p_"))
    assert {r.object_id: r.valid_status for r in got.collect()} == {"1": "sound_dep", "2": "fail"}


def test_review_queue_keeps_unconverted_and_reads_whole_errors(spark):
    error = "x" * 3_000 + " end of input"
    results = spark.createDataFrame([("1", "VIEW", "f", "fail", error)], "object_id string, object_type string, full_name string, valid_status string, valid_error string")
    converted = spark.createDataFrame([], "object_id string, method string")
    row = report.review_queue(results, converted, n=10).first()
    assert (row.method, row.error_class, row.error_detail) == (None, "unclosed_block", "x" * 10)


def test_texts(spark):
    one = spark.range(1)
    cases = {"SELECT 1;\r\n-- note\r\n": False, "SELECT 1\r\n": True, "x\r\nEND\r\n": False, "-- a\r\n": True}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.x for r in df.select("t", W.looks_truncated(F.col("t")).alias("x")).collect()} == cases
    table = spark.createDataFrame([("TABLE", "a \x01 b \x02 c not  null, d null, e default  Null)")], "object_type string, code string")
    assert W.apply_rules(table, "code", "object_type", W.NORMALIZE_RULES).first().code == (
        "a \x01 b \x02 c NOT NULL, d, e DEFAULT NULL) TBLPROPERTIES (" + W.DEFAULTS_PROPERTY + ");"
    )
    own = P.profile_text(df.withColumn("kind", F.lit("VIEW")), "t", "kind", {"has_merge": r"\bnote\b"}, weights={"has_merge": 5})
    assert {(r.sig_has_merge, r.complexity_tier) for r in own.collect()} == {(False, "simple")}  # it stands in a comment
    assert one.select(P.force_flag({}).alias("x")).first().x is False
    assert one.select(T.charindex("a", F.lit("ba"), 0).alias("x"), T.datalength(F.lit("é"), in_bytes=True).alias("y")).first()[:] == (2, 2)


def test_timestamps_order_in_any_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(i, datetime(2024, 11, 3, 5)) for i in range(4)], "i int, t timestamp_ntz")
        df = df.withColumn("z", F.timestamp_seconds(F.lit(1_730_608_200) + F.col("i") * 1_800)).withColumn("n", F.col("t") + F.make_dt_interval(mins=F.col("i")))
        for order in (["z"], ["n"]):
            assert [r.i for r in df.orderBy(sort_key(df, order)).collect()] == [0, 1, 2, 3]
            assert [r.i for r in df.orderBy(sort_key(df, ["-" + order[0]])).collect()] == [3, 2, 1, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
