"""Exact deduplication against a digest index that persists between runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import stage, stage_folder

_BLANK = r"[\x20\x09-\x0D]+"


def digest(text) -> F.Column:
    """SHA-256 of the text with each run of white space as one space; NULL counts as empty."""
    return F.sha2(F.encode(F.regexp_replace(F.coalesce(text, F.lit("")), _BLANK, " "), "UTF-8"), 256)


class DigestIndex:
    """Table of the digests seen so far, in buckets by hash and sorted within each.

    One bucketed table of (digest, keep_id, batch); each batch appends one sorted file to a bucket at most. A join on the
    digest reads the buckets as they are, so only the new batch is shuffled, and the anti join that finds new digests is
    a merge of sorted buckets. Appending twice after a failure changes nothing: digests that are there already are not
    new any more.
    """

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int = 64):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int = 64) -> DigestIndex:
        """An empty index in the shared folder."""
        name = f"digests_{uuid.uuid4().hex}"
        return cls(spark, name, f"{stage_folder(spark)}/{name}", buckets)

    def _save(self, rows: DataFrame) -> None:
        writer = rows.write.mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)

    def ensure(self, like: DataFrame) -> None:
        """Make an empty index with the id type of ``like`` (digest, keep_id) unless there is one."""
        if not self.spark.catalog.tableExists(self.name):
            self._save(like.select("digest", "keep_id", F.lit("").alias("batch")).limit(0))

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, new: DataFrame, batch: str) -> None:
        """Add (digest, keep_id) rows whose digests the index lacks."""
        dealt = new.select("digest", "keep_id", F.lit(batch).alias("batch"))
        self._save(dealt.repartition(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets))))


def deduplicate(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None
) -> DataFrame:
    """Mark copies within ``docs`` and of texts in the index, and append the new digests to the index.

    One row per row of ``docs``: the id, ``keep_id`` (id of the text that stays: the indexed one, else the smallest id
    among the equal texts), ``group_size`` (rows of ``docs`` with the text), ``kept`` and ``text_sha256``. ``batch`` names
    this batch in the index: run again under its name, it gives the same result as the first time.

    NULL and empty texts are equal texts. A NULL id ranks behind all others: such a row stays only if no row of its
    group has an id, and then all such rows stay. Rows that repeat an id stay or go together. An empty table gives an
    empty result. Other columns of ``docs``, whatever their names, are not read.

    Digests that the index lacks are found by the merge anti join and appended; then every digest of the batch takes its
    ``keep_id`` from the index by a merge join. Only ids and digests are shuffled, never texts; copies are counted on the
    map side, and a digest that a large part of the rows share joins its single group row, which adaptive execution may
    split.
    """
    batch = batch or uuid.uuid4().hex
    rows = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("text_sha256"))
    rows = stage(rows, "digests")
    groups = stage(
        rows.groupBy(F.col("text_sha256").alias("digest")).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "digest-groups",
    )
    index.ensure(groups)
    index.append(groups.join(index.read().hint("merge"), "digest", "left_anti"), batch)
    settled = groups.drop("keep_id").join(index.read().hint("merge"), "digest")
    repeated = settled.select("digest", "keep_id", "group_size", (F.col("batch") != batch).alias("is_old")).where("group_size > 1 OR is_old")
    # written, so both sides of the join are dealt out for it alone and adaptive execution can split a hot digest
    repeated = stage(repeated, "repeated")
    found = F.col("group_size").isNotNull()
    return rows.join(repeated, rows["text_sha256"] == repeated["digest"], "left").select(
        "doc_id",
        F.when(found, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (~F.coalesce("is_old", F.lit(False)) & (~found | F.col("doc_id").eqNullSafe(F.col("keep_id")))).alias("kept"),
        "text_sha256",
    )
