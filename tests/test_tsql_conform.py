from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablekeeper.functions import tsql
from tablekeeper.operators.conform import conform_report, conform_types, engine_type, infer_business_key


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def ts(text):
    return tsql.timestamp_literal(text)


@pytest.mark.parametrize("unit,a,b,want", [
    ("year", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1), ("month", "2024-01-31 00:00:00", "2024-02-01 00:00:00", 1),
    ("quarter", "2024-03-31 00:00:00", "2024-04-01 00:00:00", 1), ("week", "2024-01-06 00:00:00", "2024-01-07 00:00:00", 1),
    ("week", "2024-01-07 00:00:00", "2024-01-13 00:00:00", 0), ("week", "2024-01-07 00:00:00", "2024-01-06 00:00:00", -1),
    ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1), ("hh", "2024-01-01 00:59:59", "2024-01-01 01:00:00", 1),
    ("mi", "2024-01-01 00:00:59", "2023-12-31 23:59:00", -1), ("ss", "2024-01-01 00:00:00", "2024-01-02 00:00:01", 86401),
])
def test_datediff(spark, unit, a, b, want):
    assert value(spark, tsql.datediff(unit, ts(a), ts(b))) == want


def test_dateadd(spark):
    t = ts("2024-01-31 10:30:00")
    assert value(spark, tsql.dateadd("month", 1, t)) == date(2024, 2, 29)
    assert value(spark, tsql.dateadd("day", -1, t)) == date(2024, 1, 30)
    assert value(spark, tsql.dateadd("day", -1, t, keep_time=True)) == datetime(2024, 1, 30, 10, 30)
    assert value(spark, tsql.dateadd("hour", F.lit(-11), t)) == datetime(2024, 1, 30, 23, 30)
    assert value(spark, tsql.dateadd("qq", 1, t)) == date(2024, 4, 30)
    with pytest.raises(ValueError):
        tsql.dateadd("fortnight", 1, t)


def test_scalar_forms(spark):
    assert value(spark, tsql.len_(F.lit("ab  "))) == 4 and value(spark, tsql.len_(F.lit("ab  "), ignore_trailing=True)) == 2
    assert value(spark, tsql.charindex("b", F.lit("abcb"))) == 2 and value(spark, tsql.charindex("b", F.lit("abcb"), 3)) == 4
    assert value(spark, tsql.plus(F.lit("a"), F.lit(None).cast("string"))) is None
    for text, want in {"1": 1, "-1.5e3": 1, ".5": 1, "1.": 1, "+ 1": 0, "e5": 0, "": 0}.items():
        assert value(spark, tsql.isnumeric(F.lit(text))) == want, text
    assert value(spark, tsql.isnumeric(F.lit(None).cast("string"))) == 0
    assert value(spark, tsql.convert("date", F.lit("31/12/2024"), 103)) == date(2024, 12, 31)
    assert value(spark, tsql.convert("date", F.lit("nonsense"), 103)) is None
    assert value(spark, tsql.convert("string", ts("2024-02-03 04:05:06"), 107)) == "Feb 03, 2024"
    assert value(spark, tsql.convert("int", F.lit("12x"))) is None


def test_string_agg_and_unpivot(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, "z")], "k int, o int, v string")
    assert {r.k: r.v for r in tsql.string_agg(df, ["k"], "v", "-", ["o"]).collect()} == {1: "a-b", 2: "z"}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tsql, "CELL_BYTES", 3)
        with pytest.raises(ValueError, match=r"key \(1,\) needs \d+ bytes"):
            tsql.string_agg(df, ["k"], "v", "-", ["o"])
    wide = spark.createDataFrame([(1, 5, None)], "k int, a int, b int")
    assert tsql.unpivot(wide, ["k"], ["a", "b"], "n", "x").collect() == [(1, "a", 5)]
    assert tsql.unpivot(wide, ["k"], ["a", "b"], "n", "x", keep_nulls=True).count() == 2


@pytest.mark.parametrize("declared,want", [
    ("NVARCHAR(max)", "STRING"), ("bit", "BOOLEAN"), ("decimal", "DECIMAL(38,18)"), ("Decimal(10, 2)", "DECIMAL(10,2)"),
    ("numeric(max)", "DECIMAL(38,18)"), ("money", "DECIMAL(19,4)"), ("timestamp", "BINARY"), ("hierarchyid", "STRING"),
    ("datetime2(7)", "TIMESTAMP"), ("tinyint", "TINYINT")])
def test_engine_types(declared, want):
    assert engine_type(declared) == want


def test_conform(spark):
    df = spark.createDataFrame(
        [("1", 200, 2**40, -(2**63), "x"), (" 2 ", 100, 5, 7, None), ("3.5", -129, -5, 2**63 - 1, "2024-01-01"), ("9" * 30, None, None, None, "no")],
        "a string, b int, c long, d long, e string")
    declared = {"a": "int", "b": "tinyint", "c": "smallint", "d": "bigint", "e": "date"}
    plain = df.select(*[F.col(c).try_cast(engine_type(t)).alias(c) for c, t in declared.items()]).collect()
    got = conform_types(df, declared, failures="lost")
    assert [tuple(r)[:5] for r in got.collect()] == [tuple(r) for r in plain]
    assert [sorted(r.lost) for r in got.collect()] == [["b", "c", "e"], [], ["a", "b"], ["a", "e"]]
    assert conform_types(df, declared, widen_tinyint=True).first().b == 200
    report = {r.column_name: (r.n_values, r.n_failed) for r in conform_report(df, declared).collect()}
    assert report == {"a": (4, 2), "b": (3, 2), "c": (3, 1), "d": (3, 0), "e": (3, 2)}


def test_business_keys(spark):
    columns = spark.createDataFrame(
        [("n", "Code", 1, False, False, False), ("n", "v", 2, False, False, False),
         ("u", "Id", 1, True, False, False), ("u", "x", 2, False, False, False),
         ("r", "id", 1, True, False, False), ("r", "a", 2, False, False, False), ("r", "etl_b", 3, False, False, False),
         ("r", "s", 4, False, True, False), ("r", "e", 5, False, False, True), ("r", "c", 6, False, False, False)],
        "table string, name string, ordinal int, identity boolean, row_start boolean, row_end boolean")
    keys = spark.createDataFrame([("n", ["Code"], ["v"]), ("u", ["ID"], ["x"]), ("r", ["id"], [])],
                                 "table string, pk array<string>, unique array<string>")
    got = sorted(map(tuple, infer_business_key(columns, keys).collect()))
    assert got == [("n", 0, "Code", "primary_key"), ("r", 2, "a", "all_columns_review"), ("r", 6, "c", "all_columns_review"),
                   ("u", 0, "x", "unique_constraint")]
