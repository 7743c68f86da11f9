"""A whole run over a corpus of object scripts, stage by stage.

Every stage reads tables of a workspace folder and writes the next ones, so a
stage can be repeated by itself. What converts, checks and repairs is passed in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import flag_oversized, lookup, render_template
from ..functions.profile import SIGNALS
from ..functions.rewrite import NORMALIZE_RULES, SCRIPT_RULES, Rule, apply_rules, clean_output, leak_check, rewrite_namespace
from ..operators.conform import register_companions, select_temporal
from ..operators.merge import append_new, merge_update
from ..operators.outcome import classify_outcomes, referenced_namespaces, retry_set, to_results, validation_set
from ..operators.repair import repair_until
from ..operators.report import latest_run, pair_companions, reconcile, review_queue, run_summary
from ..operators.route import batch_infer, merge_outputs, route_misses, try_map, with_audit
from ..sources.files import ingest_objects, scan_files
from ..sources.tables import read_version, replace_partitions, rewrite_table, stage

# Types the deterministic pass takes, and the numbers of partitions
# costly calls are spread over.
DETERMINISTIC_TYPES = ("TABLE", "VIEW", "SCHEMA")
REQUEST_PARTITIONS = 48
CALL_PARTITIONS = 64

RESULT_SCHEMA = (
    "fraction double, object_id string, object_type string, full_name string, "
    "valid_status string, valid_error string, run_ts string"
)
SUMMARY_SCHEMA = (
    "fraction double, object_type string, n bigint, success bigint, pct_success double, n_pass bigint, "
    "n_sound bigint, n_fail bigint, n_timeout bigint, reported_at timestamp, run_ts string"
)


@dataclass
class Workspace:
    """Tables of a run below one folder; each write of a table is a new version of it."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return read_version(self.spark, self.path(name))

    def save(self, name: str, df: DataFrame) -> DataFrame:
        rewrite_table(self.spark, self.path(name), df=df)
        return self.read(name)

    # Tables that grow by run are partitioned by it; a given schema keeps run ids text.
    def runs(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def save_run(self, name: str, df: DataFrame) -> None:
        replace_partitions(df, self.path(name), ["run_ts"])


def ingest(
    ws: Workspace, source: str | DataFrame, templates: Mapping[str, str], endpoints: Mapping[str, str],
    *, max_bytes: int | None = None, partitions: int = REQUEST_PARTITIONS, patterns: Mapping[str, str] = SIGNALS,
) -> DataFrame:
    """Files (a folder, or rows of ``path`` and ``content``) to ``source_objects`` and ``convert_requests`` (size flag, endpoint, prompt).

    Objects above ``max_bytes``, if given, are not converted but stay, with that as their error.
    """
    files = scan_files(ws.spark, source) if isinstance(source, str) else source
    objects = ws.save("source_objects", ingest_objects(files, patterns))
    prompt = render_template(
        lookup(F.col("target_form"), templates),
        {
            "schema": F.coalesce("schema_name", F.lit("dbo")), "object": F.coalesce("object_name", F.lit("obj")),
            "source": F.col("source_sql"),
        },
    )
    requests = objects.withColumns(
        {
            "oversized": flag_oversized(F.col("source_bytes"), max_bytes),
            "model_endpoint": lookup(F.col("complexity_tier"), endpoints),
            "prompt": prompt,
        }
    )
    return ws.save("convert_requests", requests.repartition(partitions))


def convert(
    ws: Workspace, deterministic_fn: Callable, fn_by_tier: Mapping[str, Callable],
    *, partitions: int = CALL_PARTITIONS,
) -> DataFrame:
    """Deterministic pass, inference for its misses, and the merge of both: ``converted_objects``.

    The deterministic function gets scripts without batch separators and session options. Its value counts as a miss
    where it still shows unconverted identifiers.
    """
    requests = ws.read("convert_requests")
    tried = try_map(
        apply_rules(requests, "source_sql", None, SCRIPT_RULES), deterministic_fn, "source_sql",
        F.col("object_type").isin(*DETERMINISTIC_TYPES) & ~F.col("oversized"),
    )
    tested = tried.withColumn("_leak", leak_check(F.col("value")))
    first = ws.save(
        "deterministic",
        tested.select("object_id", F.col("_leak.value").alias("value"), F.coalesce("_leak.error", "error").alias("error")),
    )
    misses = route_misses(
        requests, first.where("value is not null"), "object_id", oversized="oversized", template="prompt"
    )
    called = batch_infer(misses, fn_by_tier, "complexity_tier", "prompt", partitions=partitions)
    second = ws.save("inferred", called.select("object_id", "resp.*"))
    merged = merge_outputs(requests, first, second, "object_id")
    cleaned = with_audit(merged).withColumn("converted_code", clean_output(F.col("raw_code")))
    return ws.save(
        "converted_objects",
        cleaned.select(
            "object_id", "object_type", "schema_name", "object_name", "full_name", "target_form",
            "complexity_tier", "source_bytes", "oversized", "method", "model_endpoint", "convert_error",
            "raw_code", "attempt", "converted_at", "converted_code",
        ),
    )


def normalize(
    ws: Workspace, rules: tuple[Rule, ...] = NORMALIZE_RULES, *,
    temporal_meta: DataFrame | None = None,
) -> DataFrame:
    """Rewrite rules over the converted code; temporal tables get their generated code and companion.

    ``temporal_meta`` holds ``full_name``, ``table_code`` and ``apply_code`` of
    the temporal tables that could be described; the others stay as they are.
    """
    converted = apply_rules(ws.read("converted_objects"), "converted_code", "object_type", rules)
    if temporal_meta is not None:
        chosen = select_temporal(converted, ws.read("source_objects"), temporal_meta)
        known = stage(chosen.where("has_meta").join(temporal_meta, "full_name"), "temporal")
        converted = merge_update(
            converted, known, ["object_id"],
            {
                "converted_code": F.col("s.table_code"), "method": F.lit("scd2_generator"),
                "convert_error": F.lit(None).cast("string"),
            },
        )
        made = register_companions(known, F.col("apply_code")).withColumn("converted_at", F.current_timestamp())
        converted = append_new(converted, made, ["object_id"])
    return ws.save("converted_objects", converted)


def _checker(ws: Workspace, check_fn: Callable[[DataFrame], DataFrame], miss_pattern: str):
    """``check_fn`` followed by the classification of what it reports."""
    names = ws.read("source_objects")

    def check(rows: DataFrame) -> DataFrame:
        outcomes = check_fn(rows)
        return classify_outcomes(outcomes, names, name="object_name", pattern=miss_pattern)

    return check


def validate(
    ws: Workspace, run_ts: str, fraction: float, check_fn: Callable[[DataFrame], DataFrame], miss_pattern: str,
    *, isolate: tuple[str, str, str] | None = None, retry: bool = True,
) -> DataFrame:
    """Check the leading fraction of each type; ``check_fn`` adds ``state`` and ``error`` to the rows it gets.

    ``isolate`` (source catalog, scratch catalog, prefix) moves the names in the code to scratch namespaces before the
    check; ``scratch_namespaces`` lists those to be there. Objects whose check only met an overload are checked once more.
    """
    code = F.col("converted_code") if isolate is None else rewrite_namespace(F.col("converted_code"), *isolate)
    chosen = validation_set(ws.read("converted_objects"), fraction)
    rows = chosen.select("object_id", "object_type", "full_name", "stage_no", code.alias("code"))
    check = _checker(ws, check_fn, miss_pattern)
    outcomes = to_results(check(rows), run_ts, fraction)
    if retry:
        outcomes = stage(outcomes, "outcomes")
        again = rows.join(retry_set(outcomes).select("object_id"), "object_id", "left_semi").select(rows.columns)
        second = stage(to_results(check(again), run_ts, fraction), "outcomes-again")
        outcomes = outcomes.join(second.select("object_id"), "object_id", "left_anti").select(outcomes.columns).unionByName(second)
    ws.save_run("validation_results", outcomes)
    return ws.runs("validation_results", RESULT_SCHEMA).where(F.col("run_ts") == run_ts)


def scratch_namespaces(ws: Workspace, source_catalog: str, prefix: str) -> DataFrame:
    """Names of the scratch namespaces that the converted code needs once it is isolated."""
    pattern = rf"`?{source_catalog}`?\s*\.\s*`?([A-Za-z0-9_]+)`?\s*\."
    found = referenced_namespaces(ws.read("converted_objects"), "converted_code", pattern)
    return found.select(F.concat(F.lit(prefix), "namespace").alias("namespace"))


def repair(
    ws: Workspace, run_ts: str, repair_fn: Callable, check_fn: Callable[[DataFrame], DataFrame],
    miss_pattern: str, *, passes: int = 2, prefix: str,
) -> None:
    """Bounded repair of the failing objects of a run; writes the run and the converted objects back."""
    check = _checker(ws, check_fn, miss_pattern)

    def recheck(fixes: DataFrame) -> DataFrame:
        return check(fixes).withColumnRenamed("error", "valid_error")

    results = ws.runs("validation_results", RESULT_SCHEMA).where(F.col("run_ts") == run_ts)
    converted, checked = repair_until(
        ws.read("converted_objects"), results, run_ts, repair_fn, recheck, passes=passes, prefix=prefix
    )
    ws.save("converted_objects", converted)
    ws.save_run("validation_results", stage(checked, "run"))


def report(ws: Workspace, run_ts: str | None = None) -> dict[str, DataFrame]:
    """Summary of the run (the latest by default), funnel, review queue and temporal tables."""
    every = ws.runs("validation_results", RESULT_SCHEMA)
    results = latest_run(every) if run_ts is None else every.where(F.col("run_ts") == run_ts)
    source, converted = ws.read("source_objects"), ws.read("converted_objects")
    ws.save_run("run_summary", run_summary(results).withColumn("reported_at", F.current_timestamp()))
    out = {
        "run_summary": ws.runs("run_summary", SUMMARY_SCHEMA),
        "recon_inventory": ws.save("recon_inventory", reconcile(source, converted, results)),
        "manual_review": ws.save("manual_review", review_queue(results, converted)),
    }
    if "sig_has_temporal" in source.columns:
        temporal = source.where((F.col("object_type") == "TABLE") & F.col("sig_has_temporal"))
        out["temporal_tables"] = ws.save("temporal_tables", pair_companions(temporal, converted, results))
    return out
