"""Stored SCD Type 2 history that never rewrites closed versions, and open ones only where something changed.

Rows are in buckets by the hash of their key. Version N of the table folder holds the rows closed by step N
(``IsCurrent=false``) and the open rows (``IsCurrent=true``) of the buckets that step N touched, which it lists. The
history is the closed rows of every version plus each bucket's open rows of the last version that touched it.

Beside its rows a version notes the least start and the greatest end in each of its folders, the rows that it closed and
opened (its changes), and the tag of what was applied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scd2 import Window, open_history, scd2_step
from ..operators.temporal import as_of
from .tables import VERSION, _file_system, publish, stage, version_path, versions


BUCKET, TOUCHED = "tk_bucket", "_touched"
CHANGE, CHANGES, BOUNDS, TAG = "tk_change", "_changes", "_bounds", "_tag"


class HistoryTable:
    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], track: Sequence[str], window: Window = Window(),
        buckets: int = 32,
    ):
        """``buckets`` must stay what it was at the first load."""
        self.spark, self.path, self.window, self.buckets = spark, path, window, buckets
        self.key, self.track = list(key), list(track)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, touched: DataFrame, number: int, tag: str | None, changes: DataFrame | None = None) -> None:
        start, end = F.col(f"`{self.window.start}`"), F.col(f"`{self.window.end}`")
        folder = [F.col(self.window.current).alias("open"), F.col(BUCKET).cast("int").alias(BUCKET)]
        notes = {
            TOUCHED: touched.select(F.col(BUCKET).cast("int").alias(BUCKET), F.lit(number).alias(VERSION)),
            BOUNDS: rows.groupBy(*folder).agg(F.min(start).alias("least"), F.max(end).alias("greatest"), F.lit(number).alias(VERSION)),
            TAG: self.spark.createDataFrame([(number, tag)], f"{VERSION} int, tag string"),
        }
        beside = {} if changes is None else {CHANGES: changes.withColumn(VERSION, F.lit(number))}
        publish(rows, self.path, number, [self.window.current, BUCKET], notes, beside)

    def _with_note(self, known: Sequence[int], name: str) -> list[str]:
        """The folders of a note in those versions that have it (older releases wrote fewer)."""
        folders = [f"{version_path(self.path, n)}/{name}" for n in known]
        return [folder for folder in folders if (found := _file_system(self.spark, folder))[0].exists(found[1])]

    def is_loaded(self) -> bool:
        return bool(versions(self.spark, self.path))

    def tags(self) -> set[str]:
        """What ``load`` and ``apply`` were tagged with; one per version."""
        folders = self._with_note(versions(self.spark, self.path), TAG)
        return {r.tag for r in self.spark.read.parquet(*folders).where("tag IS NOT NULL").collect()} if folders else set()

    def as_of(self, instant) -> DataFrame:
        """The versions of keys that were valid at ``instant``, read from the folders whose bounds allow it only."""
        known = versions(self.spark, self.path)
        folders = self._with_note(known, BOUNDS)
        if not known or len(folders) < len(known):
            return as_of(self.read(), instant, self.window)
        notes = self.spark.read.parquet(*folders)
        at, last = F.lit(instant).cast(notes.schema["least"].dataType), self._last_touch(known)
        holds = notes.where((F.col("least") <= at) & (at < F.col("greatest"))).select(VERSION, "open", BUCKET).collect()
        paths = [
            f"{version_path(self.path, r[VERSION])}/{self.window.current}={str(r.open).lower()}/{BUCKET}={r[BUCKET]}"
            for r in holds if not r.open or last[r[BUCKET]] == r[VERSION]
        ]
        if not paths:
            return self.read().where(F.lit(False))
        rows = self.spark.read.option("basePath", self.path).parquet(*paths).drop(VERSION, BUCKET)
        rows = rows.withColumn(self.window.current, F.col(self.window.current).cast("boolean"))
        return as_of(rows, instant, self.window)

    def changes(self, after: int, until: int | None = None) -> DataFrame:
        """The rows that versions ``after`` + 1 to ``until`` (default: the last) closed and opened, as they were then.

        ``tk_change`` is 'closed' or 'opened', ``tk_version`` the version; a key that got a new version has one of each.
        Nothing but the change rows of these versions is read. The first load has none: ``after`` is 1 at least.
        """
        known = versions(self.spark, self.path)
        wanted = [n for n in known if after < n <= (known[-1] if until is None else until)]
        folders = self._with_note(wanted, CHANGES)
        if after < 1 or len(folders) < len(wanted) or (until is not None and until not in known):
            raise ValueError(f"changes after {after} until {until} are not recorded")
        if not wanted:
            none = self.read().where(F.lit(False))
            return none.withColumns({CHANGE: F.lit("").cast("string"), VERSION: F.lit(0)})
        return self.spark.read.parquet(*folders)

    def _last_touch(self, known: Sequence[int]) -> dict[int, int]:
        """The last version that touched each bucket; as many entries as there are buckets."""
        notes = self.spark.read.parquet(*[f"{version_path(self.path, n)}/{TOUCHED}" for n in known])
        return {r[0]: r[1] for r in notes.groupBy(BUCKET).agg(F.max(VERSION)).collect()}

    def read(self, *, with_version: bool = False) -> DataFrame:
        """The whole history, pruned to the partitions that belong to it."""
        known = versions(self.spark, self.path)
        if not known:
            raise FileNotFoundError(f"no committed version under {self.path}")
        # an unfinished write may have left a folder behind: name the committed ones
        folders = [version_path(self.path, n) for n in known]
        rows = self.spark.read.option("basePath", self.path).parquet(*folders)
        # partition values are read back as text
        rows = rows.withColumn(self.window.current, F.col(self.window.current).cast("boolean"))
        open_row = F.coalesce(F.col(self.window.current), F.lit(False))
        last = F.create_map(*[F.lit(x) for item in sorted(self._last_touch(known).items()) for x in item])
        rows = rows.where(~open_row | (F.col(VERSION) == F.element_at(last, F.col(BUCKET)))).drop(BUCKET)
        return rows if with_version else rows.drop(VERSION)

    def drop_stale(self) -> list[tuple[int, int]]:
        """Delete open rows that a later version replaced, as (version, bucket); closed rows, the history, stay."""
        known = versions(self.spark, self.path)
        last, gone = self._last_touch(known), []
        for number in known:
            for bucket in range(self.buckets):
                name = f"{version_path(self.path, number)}/{self.window.current}=true/{BUCKET}={bucket}"
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(name)
                fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
                if number < last.get(bucket, 0) and fs.exists(folder):
                    fs.delete(folder, True)
                    gone.append((number, bucket))
        return gone

    def current(self) -> DataFrame:
        return self.read().where(F.col(self.window.current))

    def load(self, source: DataFrame, effective_at, time_type: str = "timestamp_ntz", tag: str | None = None) -> int:
        """First load; refuses a table that has versions."""
        if versions(self.spark, self.path):
            raise ValueError(f"{self.path} is already loaded")
        rows = open_history(source, effective_at, window=self.window, time_type=time_type)
        touched = self.spark.range(self.buckets).select(F.col("id").alias(BUCKET))
        self._write(rows.withColumn(BUCKET, self._bucket()), touched, 1, tag)
        return 1

    def apply(self, source: DataFrame, effective_at, *, deletes: str = "keep", tag: str | None = None) -> int:
        """Apply one snapshot as the next version; ``tag`` is kept with it (see ``tags``)."""
        number = versions(self.spark, self.path)[-1] + 1
        step = scd2_step(
            self.current(), source, self.key, self.track, effective_at,
            window=self.window, deletes=deletes,
        )
        step = stage(step.withColumn(BUCKET, self._bucket()), "step")
        start = F.col(f"`{self.window.start}`")
        at = F.lit(effective_at).cast(step.schema[self.window.start].dataType)
        changed = step.where(~F.col(self.window.current) | (start == at))
        touched = changed.select(BUCKET).distinct()
        kind = F.when(F.col(self.window.current), F.lit("opened")).otherwise(F.lit("closed"))
        rows = step.join(F.broadcast(touched), BUCKET, "left_semi").select(step.columns)
        self._write(rows, touched, number, tag, changed.drop(BUCKET).withColumn(CHANGE, kind))
        return number
