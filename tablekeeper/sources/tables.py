"""Sinks and stored tables on plain Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- plain writes -----------------------------------------------------------

def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite the table and its schema. The target must not be among the inputs (see ``rewrite_table``)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Create or replace the table from a query and read it back: one evaluation for many readers."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; the rows may bring new columns, ``read_table`` shows them as NULL in older rows."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType | str) -> None:
    """Create an empty table unless one is there."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def replace_partitions(df: DataFrame, path: str, part_cols: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows for; all others stay as they are."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*part_cols)
        .parquet(path)
    )


def map_table(df: DataFrame, fn: Callable[[DataFrame], DataFrame], partitions: int) -> DataFrame:
    """Apply ``fn`` over a fixed number of partitions, for rows that are few but costly."""
    return fn(df.repartition(partitions))


def rows_df(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def observe_counts(
    df: DataFrame, name: str, **extra: Column
) -> tuple[DataFrame, Observation]:
    """Row count (and more aggregates) gathered while the first action runs, with no second scan."""
    seen = Observation(name)
    columns = [F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in extra.items()]]
    return df.observe(seen, *columns), seen


# --- catalog probes ---------------------------------------------------------

def ensure_schema(spark: SparkSession, name: str, use: bool = True) -> str:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    if use:
        spark.catalog.setCurrentDatabase(name)
    return spark.catalog.currentDatabase()


def has_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


# --- cutting lineage --------------------------------------------------------

def stage_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Without the setting, a local session stages in its warehouse folder; on a cluster that may be a folder of the driver's
    machine alone, so it is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stage"


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there."""
    path = f"{stage_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    return materialize(df, path)


# --- versioned tables -------------------------------------------------------
# A table folder holds one sub-folder per version. A version counts once its
# write has left the commit marker, so readers never see a half-written one.
VERSION = "tk_version"


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{VERSION}=") and fs.exists(marker):
            found.append(int(name.partition("=")[2]))
    return sorted(found)


def version_path(path: str, version: int) -> str:
    return f"{path}/{VERSION}={version}"


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.parquet(version_path(path, known[-1] if version is None else version))


def rewrite_table(
    spark: SparkSession,
    path: str,
    fn: Callable[[DataFrame], DataFrame] | None = None,
    *,
    df: DataFrame | None = None,
) -> int:
    """Write the next version: ``fn`` of the present one, or ``df`` for a first load."""
    known = versions(spark, path)
    new = df if fn is None else fn(read_version(spark, path))
    number = known[-1] + 1 if known else 1
    publish(new, path, number)
    return number


def publish(
    df: DataFrame, path: str, number: int, partition_by: Sequence[str] = (), notes: dict[str, DataFrame] | None = None,
    beside: dict[str, DataFrame] | None = None,
) -> None:
    """Write a version to a folder of its own, then give that its final name: seen whole or not at all.

    A second writer that has taken the number meanwhile keeps it, and this one raises. ``notes`` are small tables kept
    beside the rows, by names that begin with an underscore; ``beside`` are such tables of any size.
    """
    spark, draft = df.sparkSession, f"{path}/_draft-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(draft)
    for name, table in (notes or {}).items():
        table.coalesce(1).write.parquet(f"{draft}/{name}")
    for name, table in (beside or {}).items():
        table.write.parquet(f"{draft}/{name}")
    fs, done = _file_system(spark, version_path(path, number))
    source = spark._jvm.org.apache.hadoop.fs.Path(draft)
    if fs.exists(done) and not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(done, "_SUCCESS")):
        fs.delete(done, True)  # what an older release left unfinished
    if fs.exists(done) or not fs.rename(source, done):
        fs.delete(source, True)
        raise FileExistsError(f"version {number} of {path} was written by someone else")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` committed versions of a fully rewritten table."""
    old = versions(spark, path)[:-keep]
    for number in old:
        fs, folder = _file_system(spark, version_path(path, number))
        fs.delete(folder, True)
    return old
