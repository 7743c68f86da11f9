"""A training corpus from raw documents: filter, deduplicate, decontaminate and pack."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeeper.llm import leaks, lines, minhash, packing, quality
from tablekeeper.sources.tables import stage

TOKENIZER = "word_bpe_49k.json"
BATCH_ROWS = 2_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(step):
    """Let the stage hand its rows to Python a few megabytes at a time: whole texts are large rows, and an executor keeps
    the memory of its largest batches, in the JVM and in each Python worker.
    """

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return step(spark, docs, sf_dir)

    return run_step


@small_batches
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    trees = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, trees).where(F.col("score") >= quality.THRESHOLD).select(docs.columns)


@small_batches
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that are nearly equal to an earlier one; a document that loses all it had goes."""
    done = lines.remove_lines(docs)
    changed = F.col("removed_lines") > 0
    left = F.length(F.trim(F.col("text"))) > 0
    return (
        done.where(~changed | left)
        .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(docs.columns)
    )


@small_batches
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    found = minhash.near_duplicates(docs)
    dropped = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept")
    return docs.join(stage(dropped.select("doc_id"), "dropped"), "doc_id", "left_anti").select(docs.columns)


@small_batches
def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark; a document that holds nothing else goes."""
    done = leaks.remove_benchmark(docs, _table(spark, sf_dir, "benchmark"))
    return done.where((F.col("text") != "") | F.col("text").isNull() | ~(F.col("n_chars") > 0)).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    )


@small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", cut_benchmark),
    ("packing", pack),
]

ORACLE_SQL = None  # the classifier and the tokenizer are not SQL; tests hold the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each result but the last written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
