import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablekeeper.operators.ranking import keep_leading, sort_key
from tablekeeper.operators.sample import dependency_stage, prefix_sample, sort_columns, top_n_with_ties, top_percent


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    # one group holds a third of the rows, one value repeats, some are NULL
    rows = [
        (i, "hot" if i % 3 == 0 else f"g{rng.randrange(30)}", rng.choice([None, 0.5, 0.5, 0.5, rng.random()]),
         rng.choice(["a", "ab", "é", "", None, "b"]))
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id long, g string, x double, s string").cache()


def brute(df, part, order, quota):
    w = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(1))
    ranked = df.withColumn("rn", F.row_number().over(w.orderBy(*sort_columns(order)))).withColumn("n", F.count(F.lit(1)).over(w))
    return ranked.where(F.col("rn") <= quota(F.col("n"))).drop("rn", "n")


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("order", [["x", "-id"], ["-s", "-x", "id"]])
@pytest.mark.parametrize("part", [[], ["g"]])
def test_cut_equals_window(spark, data, order, part):
    def quota(n):
        return F.floor(n * 0.3)

    want = brute(data, part, order, quota)
    same(keep_leading(data, part, order, quota, small=150, splits=64), want)
    same(keep_leading(data, part, order, quota), want)


def test_copies_at_the_cut(spark):
    rows = spark.range(30000).select((F.col("id") % 2).alias("a"), F.lit("x").alias("b"))
    got = keep_leading(rows, [], ["a"], lambda n: F.lit(25001), small=100, splits=4)
    assert {r.a: r["count"] for r in got.groupBy("a").count().collect()} == {0: 15000, 1: 10001}


def test_null_group(spark, data):
    for small in (100, 10_000):
        same(keep_leading(data, ["s"], ["id"], lambda n: F.floor(n / 2), unique=True, small=small, splits=64),
             brute(data, ["s"], ["id"], lambda n: F.floor(n / 2)))


def test_unique_order(spark, data):
    same(keep_leading(data, ["g"], ["-id"], lambda n: F.floor(n / 2), unique=True, small=200, splits=16),
         brute(data, ["g"], ["-id"], lambda n: F.floor(n / 2)))
    for small in (100, 10_000):
        with pytest.raises(Exception, match="tie at the cut"):
            keep_leading(data, [], ["s"], lambda n: F.lit(10), unique=True, small=small).collect()


def test_quota_of_nothing_and_everything(spark, data):
    assert keep_leading(data, ["g"], ["id"], lambda n: F.lit(0), small=100).count() == 0
    assert keep_leading(data, ["g"], ["id"], lambda n: n + 5, small=100).count() == 3000


@pytest.mark.parametrize("n,fraction,want", [(1, 0.25, 1), (3, 0.25, 1), (100, 0.29, 28), (100, 0.25, 25), (100, 1.0, 100)])
def test_prefix_counts(spark, n, fraction, want):
    df = spark.range(n).select(F.lit("t").alias("t"), "id")
    assert prefix_sample(df, ["t"], ["id"], fraction).count() == want


def test_prefix_is_nested(spark, data):
    small, large = (prefix_sample(data, ["g"], ["id"], f) for f in (0.25, 0.5))
    assert small.select("id").subtract(large.select("id")).count() == 0


def test_ties(spark, data):
    w = Window.partitionBy("g").orderBy(F.desc("x"))
    want = data.withColumn("r", F.rank().over(w)).where("r <= 2").drop("r")
    same(top_n_with_ties(data, 2, ["-x"], ["g"]), want)
    nulls = data.withColumn("g", F.when(F.col("g") != "hot", F.col("g")))
    want = nulls.withColumn("r", F.rank().over(w)).where("r <= 2").drop("r")
    same(top_n_with_ties(nulls, 2, ["-x"], ["g"]), want)
    assert top_n_with_ties(data.where("x = 0.5"), 1, ["x"]).count() == data.where("x = 0.5").count()


def test_percent_rounds_up(spark):
    assert top_percent(spark.range(7), 15, ["id"]).count() == 2
    assert top_percent(spark.range(0), 15, ["id"]).count() == 0


@pytest.mark.parametrize("kind", ["int", "double", "decimal(10,2)", "boolean", "date", "timestamp", "timestamp_ntz", "string"])
def test_descending_key(spark, kind):
    texts = {"boolean": ["true", "false"], "date": ["2024-01-02", "1969-05-01", "2024-01-01"], "string": ["a", "ab", "", "é", "Z"],
             "timestamp": ["2024-01-01 00:00:00.1", "2024-01-01 00:00:00", "1960-01-01 10:00:00.15"]}
    texts["timestamp_ntz"] = texts["timestamp"]
    values = texts.get(kind, ["1", "-2", "10", "0"]) + [None]
    if kind == "double":
        values += ["NaN", "Infinity", "-Infinity"]
    df = spark.createDataFrame([(v,) for v in values], "t string").select(F.col("t").cast(kind).alias("v"))
    for sign, order in (("-", F.desc("v")), ("", F.asc("v"))):
        by_key = [str(r.v) for r in df.orderBy(sort_key(df, [sign + "v"])).collect()]
        assert by_key == [str(r.v) for r in df.orderBy(order).collect()]


def test_stage_number(spark):
    df = spark.createDataFrame([("B",), ("A",), ("?",)], "t string")
    assert [r[0] for r in df.select(dependency_stage(F.col("t"), ["A", "B"])).collect()] == [2, 1, 0]
