"""Late snapshots: whatever the order of arrival, the history is that of the right order."""

import random

import pytest
from pyspark.sql import functions as F

from tablekeeper.operators.late import scd2_splice
from tablekeeper.operators.scd2 import open_history, scd2_apply

SCHEMA = "k int, k0 string, h string, batch int"
AT = [f"2024-0{n}-01 00:00:00" for n in range(1, 7)]


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select("k", "k0", "h", "batch", "valid_from", "valid_to", "IsCurrent").collect())


def snapshots(spark, seed, keys=60, times=5):
    pick = random.Random(seed)
    out = []
    for n in range(times):
        rows = [(k or None, "x" if k % 2 else None, pick.choice(["a", "b", None]), n) for k in range(keys) if pick.random() < 0.7]
        out.append(spark.createDataFrame(rows, SCHEMA))
    return out


def in_order(spark, snaps, times):
    dim = open_history(snaps[0], times[0])
    for snap, at in zip(snaps[1:], times[1:], strict=True):
        dim = scd2_apply(dim, snap, ["k", "k0"], ["h"], at)
    return dim


def with_times(spark, snaps, times):
    parts = [s.withColumn("at", F.lit(t).cast("timestamp_ntz")) for s, t in zip(snaps, times, strict=True)]
    whole = spark.createDataFrame([], f"{SCHEMA}, at timestamp_ntz")
    for part in parts:
        whole = whole.unionByName(part)
    return whole


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("missing", [1, 2, 4])
def test_any_order_gives_one_history(spark, seed, missing):
    """NULL keys and states, keys that come and go, states that return; helper names as columns."""
    snaps, times = snapshots(spark, seed), AT[:5]
    known = [n for n in range(5) if n != missing]
    dim = in_order(spark, [snaps[n] for n in known], [times[n] for n in known])
    after = [n for n in known if n > missing]
    later = with_times(spark, [snaps[n] for n in after], [times[n] for n in after])
    done = scd2_splice(dim, snaps[missing], ["k", "k0"], ["h"], times[missing], later=later)
    want = rows_of(in_order(spark, snaps, times))
    assert rows_of(done) == want
    assert rows_of(scd2_splice(done, snaps[missing], ["k", "k0"], ["h"], times[missing], later=later)) == want


def test_two_late_ones(spark):
    snaps, times = snapshots(spark, 3), AT[:5]
    dim = in_order(spark, [snaps[n] for n in (0, 2, 4)], [times[n] for n in (0, 2, 4)])
    dim = scd2_splice(dim, snaps[3], ["k", "k0"], ["h"], times[3], later=with_times(spark, snaps[4:], times[4:]))
    dim = scd2_splice(dim, snaps[1], ["k", "k0"], ["h"], times[1], later=with_times(spark, snaps[2:], times[2:]))
    assert rows_of(dim) == rows_of(in_order(spark, snaps, times))


def test_before_the_first_load(spark):
    """A key may begin earlier; one with the same state begins earlier as the same version."""
    first = spark.createDataFrame([(1, None, "a", 9), (2, None, "b", 9)], SCHEMA)
    early = spark.createDataFrame([(1, None, "a", 0), (2, None, "z", 0), (3, None, "q", 0)], SCHEMA)
    dim = scd2_splice(open_history(first, AT[2]), early, ["k", "k0"], ["h"], AT[0], later=with_times(spark, [first], [AT[2]]))
    assert rows_of(dim) == rows_of(in_order(spark, [early, first], [AT[0], AT[2]]))


def test_empty_sides_and_repeated_keys(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, None, "a", 0)], SCHEMA)
    dim = open_history(some, AT[1])
    assert rows_of(scd2_splice(dim, none, ["k", "k0"], ["h"], AT[0])) == rows_of(dim)
    assert rows_of(scd2_splice(dim.limit(0), some, ["k", "k0"], ["h"], AT[1])) == rows_of(dim)
    with pytest.raises(ValueError, match="late snapshot"):
        scd2_splice(dim, some.unionAll(some), ["k", "k0"], ["h"], AT[0])
