"""Registered queries: histories in time."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.late import scd2_splice
from ..operators.scd2 import scd2_apply
from ..operators.temporal import temporal_join
from ..sources.history import CHANGE, HistoryTable
from ..sources.tables import VERSION, stage_folder
from ..streaming.scd2 import stream_scd2
from . import history as H
from .common import cols, table

_ORDERS = {"o_orderkey": "o_orderkey", "c_custkey": "o_custkey", "at": "TIMESTAMP_NTZ '2023-12-10 12:00:00' + make_dt_interval(CAST(o_orderkey % 120 AS INT))"}
SNAPSHOTS = ((H.first_source, H.T0), (H.second_source, H.T1), (H.third_source, H.T2))
INSTANT = "2024-02-15 00:00:00"


def _folder(spark, name):
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _kept(spark, sf):
    kept = HistoryTable(spark, _folder(spark, "history"), H.KEY, H.TRACK)
    kept.load(H.first_source(spark, sf), H.T0)
    kept.apply(H.second_source(spark, sf), H.T1)
    kept.apply(H.third_source(spark, sf), H.T2)
    return kept


def q_join(spark, sf):
    """Orders with what their customer was like at their time."""
    orders, kept = cols(table(spark, sf, "orders"), _ORDERS), _kept(spark, sf).read()
    joined = temporal_join(orders, kept, ["c_custkey"], "at", per_task=200_000)
    return joined.select("o_orderkey", "c_custkey", "c_mktsegment", "c_acctbal", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"))


def q_as_of(spark, sf):
    return H.shown(_kept(spark, sf).as_of(INSTANT))


def q_changes(spark, sf):
    return H.shown(_kept(spark, sf).changes(1))


def q_stream(spark, sf):
    """Three snapshots that arrive one after the other."""
    folder, checkpoint = _folder(spark, "arriving"), _folder(spark, "stream")
    kept = HistoryTable(spark, _folder(spark, "history"), H.KEY, H.TRACK)
    for source, at in SNAPSHOTS:
        rows = source(spark, sf).withColumn("effective", F.lit(at).cast("timestamp_ntz"))
        rows.write.mode("append").parquet(folder)
        stream_scd2(spark, folder, rows.schema, kept, "effective", checkpoint).awaitTermination()
    return H.shown(kept.read())


def q_late(spark, sf):
    """The second snapshot arrives after the third."""
    third = H.third_source(spark, sf)
    dim = scd2_apply(H._loaded(spark, sf), third, H.KEY, H.TRACK, H.T2)
    later = third.withColumn("at", F.lit(H.T2).cast("timestamp_ntz"))
    return H.shown(scd2_splice(dim, H.second_source(spark, sf), H.KEY, H.TRACK, H.T1, later=later))


_DIM3 = f"{H._ONE}{H._step('dim2', 'src3', H.T2, 'dim3')}"
QUERIES = {"temporal_join": q_join, "history_as_of": q_as_of, "history_changes": q_changes, "stream_scd2": q_stream, "scd2_late": q_late}
ORACLE = {
    "temporal_join": f"""{_DIM3},
o AS (SELECT o_orderkey, o_custkey, TIMESTAMP '2023-12-10 12:00:00' + to_days(CAST(o_orderkey % 120 AS INTEGER)) AS placed FROM orders)
SELECT o_orderkey, o_custkey AS c_custkey, c_mktsegment, c_acctbal, strftime(valid_from, '%Y-%m-%d') AS valid_from
FROM o LEFT JOIN dim3 ON o_custkey = c_custkey AND valid_from <= placed AND placed < valid_to""",
    "history_as_of": f"{_DIM3} {H._shown_sql('dim3')} WHERE dim3.valid_from <= TIMESTAMP '{INSTANT}' AND TIMESTAMP '{INSTANT}' < dim3.valid_to",
    "history_changes": f"""{_DIM3},
feed AS (
  SELECT *, 'closed' AS {CHANGE}, CASE valid_to WHEN TIMESTAMP '{H.T1}' THEN 2 ELSE 3 END AS {VERSION} FROM dim3 WHERE NOT IsCurrent
  UNION ALL
  SELECT * REPLACE (TIMESTAMP '{H._OPEN}' AS valid_to, TRUE AS IsCurrent), 'opened', CASE valid_from WHEN TIMESTAMP '{H.T1}' THEN 2 ELSE 3 END
  FROM dim3 WHERE valid_from > TIMESTAMP '{H.T0}')
{H._shown_sql('feed', f', {CHANGE}, {VERSION}')}""",
    "stream_scd2": H._THREE,
    "scd2_late": H._THREE,
}
