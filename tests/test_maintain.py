import pytest
from pyspark.sql import functions as F

from tablekeeper.operators.joins import spread_join
from tablekeeper.operators.merge import append_new, merge_update, new_rows, replace_where, union_parts
from tablekeeper.sources import tables as S


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "r1", 1), (2, "r1", 1), (2, "r2", 1), (None, "r1", 1)], "id int, run string, attempt int")


def test_merge_self_increment_and_predicate(spark, target):
    source = spark.createDataFrame([(2, "x"), (9, "y"), (None, "n"), (None, "m")], "id int, tag string")
    got = merge_update(target, source, ["id"], {"attempt": F.col("t.attempt") + 1}, target_pred=F.col("t.run") == "r2")
    assert rows(got) == rows(spark.createDataFrame([(1, "r1", 1), (2, "r1", 1), (2, "r2", 2), (None, "r1", 1)], target.schema))
    assert got.schema == target.schema
    twice = merge_update(got, source, ["id"], {"attempt": F.col("t.attempt") + 1}, target_pred=F.col("t.run") == "r2")
    assert twice.where("run = 'r2'").first().attempt == 3


def test_merge_refuses_two_matches_and_unknown_columns(spark, target):
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "id int, tag string")
    with pytest.raises(ValueError, match="occurs 2 times"):
        merge_update(target, twice, ["id"], {"attempt": F.lit(0)})
    with pytest.raises(ValueError, match="not in target"):
        merge_update(target, twice.limit(1), ["id"], {"nope": F.lit(0)})


def test_append_new_twice(spark, target):
    more = spark.createDataFrame([(2, "r3", 5), (7, "r3", 5)], target.schema)
    once = append_new(target, more, ["id"])
    assert once.count() == 5 and append_new(once, more, ["id"]).count() == 5
    assert new_rows(target, more, ["id"]).collect()[0].id == 7


def test_replace_where_twice(spark, target):
    more = spark.createDataFrame([(8, "r1", 2)], target.schema)
    once = replace_where(target, more, ["run"])
    assert rows(once) == [(2, "r2", 1), (8, "r1", 2)]
    assert rows(replace_where(once, more, ["run"])) == rows(once)


def test_union_parts(spark, target):
    assert union_parts(spark, [], target.schema).schema == target.schema
    swapped = target.select("attempt", "run", "id")
    assert union_parts(spark, [target, swapped], target.schema).count() == 8


def test_spread_join_with_hot_and_null_keys(spark):
    left = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("4", 2), ("zzz", 3)], "k string, v int")
    got = spread_join(left, right, ["k"], salt_by=["id"])
    want = left.join(right, "k", "left")
    assert rows(got.select("id", "k", "v")) == rows(want.select("id", "k", "v"))


def test_versions(spark, target, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        S.read_version(spark, path)
    assert S.rewrite_table(spark, path, df=target) == 1
    for want in (2, 3):
        assert S.rewrite_table(spark, path, lambda d: d.withColumn("attempt", F.col("attempt") + 1)) == want
    assert S.read_version(spark, path).agg(F.max("attempt")).first()[0] == 3
    assert S.read_version(spark, path, 1).agg(F.max("attempt")).first()[0] == 1
    (tmp_path / "t" / "tk_version=3" / "_SUCCESS").unlink()
    assert S.read_version(spark, path).agg(F.max("attempt")).first()[0] == 2
    S.rewrite_table(spark, path, lambda d: d)
    assert S.drop_old_versions(spark, path, keep=1) == [1, 2]
    assert S.read_version(spark, path).count() == 4


def test_sinks(spark, target, tmp_path):
    path = str(tmp_path / "a")
    S.ensure_table(spark, path, target.schema)
    assert S.read_table(spark, path).count() == 0
    S.append_table(target.withColumn("note", F.lit("n")), path)
    S.ensure_table(spark, path, target.schema)
    got = S.read_table(spark, path)
    assert got.columns == ["id", "run", "attempt", "note"] and got.count() == 4
    assert S.materialize(target, path).columns == target.columns
    part = str(tmp_path / "p")
    S.write_table(target, part, ["run"])
    S.replace_partitions(target.where("run = 'r2'").withColumn("id", F.lit(99)), part, ["run"])
    assert sorted(r.id or 0 for r in spark.read.parquet(part).collect()) == [0, 1, 2, 99]


def test_probes_and_metrics(spark, target):
    assert S.ensure_schema(spark, "probe_db") == "probe_db"
    assert not S.has_table(spark, "nowhere") and S.has_column(target, "run") and not S.has_column(target, "x")
    target.write.mode("overwrite").saveAsTable("probe_t")
    assert S.has_table(spark, "probe_t")
    spark.catalog.setCurrentDatabase("default")
    seen_rows, seen = S.observe_counts(target, "seen", top=F.max("id"))
    seen_rows.collect()
    assert seen.get == {"n": 4, "top": 2}
    assert S.rows_df(spark, [(1,)], "a int").first().a == 1
    assert S.map_table(target, lambda d: d.where("id = 2"), 3).count() == 2
    assert S.stage(target, "t").count() == 4
