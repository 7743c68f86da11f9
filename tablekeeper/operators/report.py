"""Counts, rates, funnels and queues over result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import (
    CHART_CHARS, CHART_CLASSES, FAILING, REVIEW_CHARS, REVIEW_CLASSES, SOUND,
    axis_label, ci_eq, classify_text, excerpt, is_success, status_label,
)
from .conform import COMPANION_SUFFIX
from .joins import assert_unique
from .sample import sort_columns


def _sum_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def _percent(part: Column, whole: Column) -> Column:
    """Rounded share in percent, NULL for nothing of nothing."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), 1)


def inventory(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count per combination of the keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def run_summary(
    results: DataFrame, keys: Sequence[str] = ("run_ts", "fraction", "object_type")
) -> DataFrame:
    """Counts by status and the success rate for each run and type."""
    status = F.col("valid_status")
    counted = results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        _sum_if(is_success(status)).alias("success"),
        _sum_if(status == "pass").alias("n_pass"),
        _sum_if(status.isin(*SOUND)).alias("n_sound"),
        _sum_if(status == "fail").alias("n_fail"),
        _sum_if(status == "timeout").alias("n_timeout"),
    )
    return counted.withColumn("pct_success", _percent(F.col("success"), F.col("n"))).select(
        *keys, "n", "success", "pct_success", "n_pass", "n_sound", "n_fail", "n_timeout"
    )


def overall(summary: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rate over all groups: sum of successes by sum of rows, not the mean of the rates."""
    return (
        summary.groupBy(*keys)
        .agg(F.sum("success").alias("success"), F.sum("n").alias("n"))
        .withColumn("pct_success", _percent(F.col("success"), F.col("n")))
    )


def latest_run(results: DataFrame) -> DataFrame:
    """Rows of the greatest run."""
    newest = results.agg(F.max("run_ts").alias("r"))
    return results.where(F.col("run_ts") == newest.scalar())


def latest_full_run(results: DataFrame) -> DataFrame:
    """Rows of the greatest run among those at the greatest fraction. One small aggregate finds it."""
    best = (
        results.where(F.col("fraction").isNotNull())
        .agg(F.max(F.struct("fraction", "run_ts")).alias("m")).select("m.run_ts")
    )
    return results.where(F.col("run_ts") == best.scalar())


def kpi(rows: DataFrame) -> DataFrame:
    status = F.col("valid_status")
    return rows.agg(
        F.count(F.lit(1)).alias("total"), _sum_if(is_success(status)).alias("success"),
        _sum_if(status.isin(*FAILING)).alias("needs_review"),
    ).select("total", "success", _percent(F.col("success"), F.col("total")).alias("pct_success"), "needs_review")


def status_by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("object_type", status_label(F.col("valid_status")).alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )


def rollout_trend(summary: DataFrame) -> DataFrame:
    """Pooled success rate of every fraction, over all its runs."""
    pooled = overall(summary, ["fraction"])
    return pooled.select(axis_label(F.col("fraction")).alias("fraction"), "pct_success", "n")


def failure_classes(rows: DataFrame, rules=CHART_CLASSES, timeout_label: str = "timeout (transient)") -> DataFrame:
    """Failing rows per error class."""
    status = F.col("valid_status")
    label = classify_text(F.col("valid_error"), rules, status=status, timeout_label=timeout_label)
    return (
        rows.where(status.isin(*FAILING)).groupBy(label.alias("errclass")).agg(F.count(F.lit(1)).alias("n"))
    )


def reconcile(source: DataFrame, converted: DataFrame, results: DataFrame, key: str = "object_type") -> DataFrame:
    """Funnel per type from the source side: each relation is counted first, then the counts are joined."""
    s = source.groupBy(key).agg(F.count(F.lit(1)).alias("source_n"))
    c = converted.where(F.col("converted_code").isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("converted_n"))
    v = results.groupBy(key).agg(
        F.count(F.lit(1)).alias("validated_n"), _sum_if(is_success(F.col("valid_status"))).alias("success_n")
    )
    return s.join(c, key, "left").join(v, key, "left").fillna(0, ["converted_n", "validated_n", "success_n"])


def generated_only(source: DataFrame, converted: DataFrame, key: str = "object_id") -> DataFrame:
    """Converted objects that no source object stands behind (generated companions), counted per type."""
    extra = converted.join(source.select(key), key, "left_anti")
    return extra.groupBy("object_type").agg(F.count(F.lit(1)).alias("generated_n"))


def ordered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """A report in a total order: the given columns (a leading minus sign: descending), then all others."""
    named = {o.removeprefix("-") for o in order}
    return rows.orderBy(*sort_columns([*order, *[c for c in rows.columns if c not in named]]))


def review_queue(results: DataFrame, converted: DataFrame, n: int = REVIEW_CHARS) -> DataFrame:
    """Every failing object with its method (NULL if it is not among ``converted``), error class and one-line error."""
    failing = results.where(F.col("valid_status").isin(*FAILING))
    label = classify_text(F.col("valid_error"), REVIEW_CLASSES, status=F.col("valid_status"))
    return failing.join(converted.select("object_id", "method"), "object_id", "left").select(
        "object_type", "full_name", "method", label.alias("error_class"), "valid_status",
        excerpt(F.col("valid_error"), n).alias("error_detail"),
    )


def review_list(rows: DataFrame, n: int = CHART_CHARS) -> DataFrame:
    """Failing objects with a short error, for a table on a screen."""
    return rows.where(F.col("valid_status").isin(*FAILING)).select(
        "object_type", "full_name", excerpt(F.col("valid_error"), n).alias("error")
    )


def pair_companions(
    tables: DataFrame, converted: DataFrame, results: DataFrame, *, suffix: str = COMPANION_SUFFIX, check: bool = True
) -> DataFrame:
    """Temporal tables with the status of the table and of its companion, NULL where there is none.

    Names compare without regard to case; two that differ in nothing else would
    multiply rows, so that is refused.
    """
    folded = F.lower("full_name")
    method = converted.where(F.col("object_type") == "TABLE").select(folded.alias("_c"), F.col("method"))
    own = results.where(F.col("object_type") == "TABLE").select(
        folded.alias("_t"), F.col("valid_status").alias("scd2_table_status")
    )
    companion = results.select(folded.alias("_p"), F.col("valid_status").alias("scd2_apply_proc_status"))
    # only the rows that can be a companion go on
    companion = companion.where(F.col("_p").endswith(suffix.lower()))
    if check:
        assert_unique(method, ["_c"], "converted tables", skip_null=True)
        assert_unique(own, ["_t"], "table results", skip_null=True)
        assert_unique(companion, ["_p"], "companion results", skip_null=True)
    tt = tables.select("full_name", "schema_name", "object_name")
    apply_full = F.concat(F.col("schema_name"), F.lit("."), F.col("object_name"), F.lit(suffix))
    return (
        tt.join(method, F.lower("full_name") == F.col("_c"), "left")
        .join(own, F.lower("full_name") == F.col("_t"), "left")
        .join(companion, ci_eq(apply_full, F.col("_p")), "left")
        .select(
            F.col("full_name").alias("source_table"), F.col("method").alias("scd2_method"),
            "scd2_table_status", "scd2_apply_proc_status",
            F.concat(F.col("object_name"), F.lit(suffix)).alias("apply_procedure"),
        )
    )
