"""Row-wise batch functions: cheap deterministic pass first, tiers of costly functions for the misses."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output caps per tier, the reasons a row has no value, and the
# labels of the two ways a value can come about.
CAPS = {"trivial": 4096, "simple": 8192, "medium": 16000, "complex": 32000}
DEFAULT_CAP = 8192
SKIPPED = "skipped"
EMPTY = "empty"
DETERMINISTIC, INFERRED = "sqlglot", "ai"

OVERSIZED = "oversized"

BatchFn = Callable[[pd.Series], Sequence]


def call_halving(fn: BatchFn, batch: pd.Series, values: pd.Series, errors: pd.Series) -> None:
    """Fill ``values`` and ``errors`` for a batch; a batch that fails is tried in halves.

    One failing row of n thus costs about 2 * log2(n) calls more.
    """
    try:
        values.loc[batch.index] = list(fn(batch))
    except Exception as failure:
        if len(batch) == 1:
            errors.loc[batch.index] = str(failure)
            return
        middle = len(batch) // 2
        call_halving(fn, batch.iloc[:middle], values, errors)
        call_halving(fn, batch.iloc[middle:], values, errors)


def _nothing(n: int) -> pd.Series:
    return pd.Series([None] * n, dtype=object)


def try_map(
    df: DataFrame, fn: BatchFn, col: str, eligible: Column, *, value: str = "value", error: str = "error"
) -> DataFrame:
    """Map a text column by a batch function that may fail, as columns ``value`` and ``error``.

    Rows that are not eligible (or empty) are ``skipped`` and never reach Python.
    Only the text column travels there, in Arrow batches. If a batch raises, it is
    tried in halves, so an error stays with the row that caused it.
    """

    def run(texts: pd.Series) -> pd.DataFrame:
        values, errors = _nothing(len(texts)), _nothing(len(texts))
        live = texts.reset_index(drop=True).dropna()
        if len(live):
            call_halving(fn, live, values, errors)
            missing = values.loc[live.index].isin([None, ""]) & errors.loc[live.index].isna()
            hit = missing[missing].index
            values.loc[hit] = None
            errors.loc[hit] = EMPTY
        return pd.DataFrame({"value": values, "error": errors})

    mapper = F.pandas_udf(run, "value string, error string").asNondeterministic()
    usable = F.coalesce(eligible & (F.length(F.col(col)) > 0), F.lit(False))
    mapped = df.withColumn("_ok", usable).withColumn("_out", mapper(F.when(F.col("_ok"), F.col(col))))
    return mapped.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_out.value").alias(value),
        F.when(F.col("_ok"), F.col("_out.error")).otherwise(F.lit(SKIPPED)).alias(error),
    )


def route_misses(
    requests: DataFrame, done: DataFrame, key: str, *, oversized: str | None = None,
    template: str | None = None, error_prefix: str | None = None,
) -> DataFrame:
    """Requests still to do: template present and no error marker, key not done.

    Rows that ``oversized`` marks are left out of the calls; ``merge_outputs`` keeps them with that as their error.
    """
    rows = requests
    if oversized:
        rows = rows.where(~F.col(oversized))
    if template:
        rows = rows.where(F.col(template).isNotNull())
        if error_prefix:
            rows = rows.where(~F.col(template).startswith(error_prefix))
    return rows.join(done.select(key), key, "left_anti")


def batch_infer(
    df: DataFrame,
    fn_by_tier: Mapping[str, Callable[[pd.Series, int], Sequence]],
    tier_col: str,
    text_col: str,
    *,
    caps: Mapping[str, int] = CAPS,
    partitions: int | None = None,
    out: str = "resp",
) -> DataFrame:
    """Call the function of a row's tier; add a struct of ``result`` and ``errorMessage``.

    All tiers run in one pass. The functions are the user's: they take a batch
    of texts and the output cap of the tier. A failure is data, never an error.
    The outcome should be written before it is used twice (``sources.tables.stage``).
    """
    functions, limits = dict(fn_by_tier), {t: caps.get(t, DEFAULT_CAP) for t in fn_by_tier}

    def run(tiers: pd.Series, texts: pd.Series) -> pd.DataFrame:
        tiers, texts = tiers.reset_index(drop=True), texts.reset_index(drop=True)
        values, errors = _nothing(len(texts)), _nothing(len(texts))
        for name, batch in texts.groupby(tiers, dropna=False):
            fn = functions.get(name)
            if fn is None:
                errors.loc[batch.index] = f"no function for tier {name}"
            else:
                call_halving(lambda rows, fn=fn, cap=limits[name]: fn(rows, cap), batch, values, errors)
        return pd.DataFrame({"result": values, "errorMessage": errors})

    infer = F.pandas_udf(run, "result string, errorMessage string").asNondeterministic()
    rows = df.repartition(partitions) if partitions else df
    return rows.withColumn(out, infer(F.col(tier_col), F.col(text_col)))


def coalesce_with_provenance(sources: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """First non-NULL of the labelled columns, and the label it came from (NULL if none)."""
    label = None
    for name, column in sources:
        present = column.isNotNull()
        label = F.when(present, name) if label is None else label.when(present, name)
    return F.coalesce(*[c for _, c in sources]), label


def with_audit(df: DataFrame, *, attempt: int = 1, stamp: str = "converted_at") -> DataFrame:
    return df.withColumns({"attempt": F.lit(attempt), stamp: F.current_timestamp()})


def merge_outputs(requests: DataFrame, deterministic: DataFrame, inferred: DataFrame, key: str) -> DataFrame:
    """Requests with the value of the deterministic pass, else of inference, and where it came from.

    ``deterministic`` holds key and ``value``; ``inferred`` key, ``result`` and ``errorMessage``. Requests marked in a
    column ``oversized`` that got no value have that as their ``convert_error``.
    """
    first = deterministic.select(key, F.col("value").alias("_det"))
    second = inferred.select(key, F.col("result").alias("_inf"), F.col("errorMessage").alias("convert_error"))
    value, method = coalesce_with_provenance([(DETERMINISTIC, F.col("_det")), (INFERRED, F.col("_inf"))])
    joined = requests.join(first, key, "left").join(second, key, "left")
    columns = {"method": method, "raw_code": value}
    if OVERSIZED in requests.columns:
        too_large = F.when(F.col(OVERSIZED) & value.isNull(), F.lit(OVERSIZED))
        columns["convert_error"] = F.coalesce("convert_error", too_large)
    return joined.withColumns(columns).drop("_det", "_inf")
