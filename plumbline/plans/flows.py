"""The flows a user runs on a table, from load to model gate."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.domain import CREDIT, Domain
from plumbline.operators import corrupt, drift, repair
from plumbline.operators.expectations import Suite, failed_expectations, run_suite, statistics
from plumbline.sources import results as result_tables
from plumbline.sources.csv import PLACES, read_csv
from plumbline.sources.layers import LayerStore
from plumbline.sources.staging import staged

ORIGINAL = "original_csv"
TRAIN, REMEDIATE = "ml", "remediate"
FINAL_THRESHOLD = 90.0  # a repaired table must reach this (fixed value)


def initial_load(store: LayerStore, path: str, schema: str, *, dataset_id: str, run_id: str, source: str = ORIGINAL,
                 key: str | None = None, **csv) -> DataFrame:
    """Read a delimited file into the raw layer and say how many rows that were.

    A file without a key gets one here: the row's place in its files, after the highest key of the
    layer. It is written with the rows, every later step reads it back, and a repeated load gives
    every row the same key again."""
    df = read_csv(store.spark, path, schema, places=key is None, **csv)
    if key is None:
        df, key = numbered(df, _first_key(store, dataset_id, run_id)), "id"
    store.save_raw(df, dataset_id, source, run_id, key)
    loaded = store.read("raw").filter((F.col("dataset_id") == dataset_id) & (F.col("run_id") == run_id))
    store.record("raw", dataset_id, loaded.count(), len(df.columns))
    return loaded.groupBy("dataset_id", "run_id", "data_source").agg(F.count(F.lit(1)).alias("rows_loaded"))


def numbered(df: DataFrame, start: int, output: str = "id") -> DataFrame:
    """Number the rows of a file scan with PLACES from ``start``, in the order of files and rows.

    Rows are counted per block, the counts summed up over the blocks, and each row takes its place
    within its block. How the files were cut into blocks changes nothing."""
    rows = staged(df, "rows")  # fixes the order within a block
    file, block, place = PLACES
    blocks = rows.groupBy(file, block).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_least"))
    within = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy(file).agg(F.sum("_n").alias("_rows"))
    above = files.select(file, F.coalesce(F.sum("_rows").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_above"))  # one row a file
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(above, file)
    blocks = staged(blocks.select(file, block, (F.lit(start) + F.col("_above") + F.col("_before") - F.col("_least")).alias("_shift")), "blocks")
    return rows.join(blocks, [file, block]).withColumn(output, F.col("_shift") + F.col(place)).drop(*PLACES, "_shift")


def _first_key(store: LayerStore, dataset_id: str, run_id: str) -> int:
    """Where the keys of a load begin: where they began when it ran before, else after the highest one."""
    if not store.exists("raw"):
        return 0
    own = (F.col("dataset_id") == dataset_id) & (F.col("run_id") == run_id)
    found = store.read("raw").agg(F.min(F.when(own, F.col("id"))).alias("own"), F.max("id").alias("last")).first()
    if found["own"] is not None:
        return found["own"]
    return 0 if found["last"] is None else found["last"] + 1


def validate(df: DataFrame, suite: Suite, store: LayerStore | None = None, *, dataset_id: str = "", run_id: str = "",
             domain: Domain = CREDIT) -> DataFrame:
    """Result rows of a suite; with a store the summary is appended to its validation log."""
    started = time.monotonic()
    found = run_suite(df, suite)
    if store is None:
        return found
    # as many rows as the suite has rules: fix them, so that saving and judging share one scan
    fixed = df.sparkSession.createDataFrame(found.collect(), found.schema)
    store.append("dq_results", result_tables.dq_result_rows(
        fixed, suite.name, domain.key_columns, dataset_id=dataset_id, run_id=run_id,
        duration=round(time.monotonic() - started, 3)))
    return fixed


def gate(results: DataFrame, threshold: float = 90.0, keys: Sequence[str] = ()) -> DataFrame:
    """(success_rate, decision, failed): train when the success rate reaches the threshold, repair
    otherwise. ``failed`` lists the failed rules that name a column."""
    failed = F.sort_array(F.collect_list(F.when(
        ~F.col("success") & F.col("column").isNotNull(),
        F.struct(F.col("expectation_type").alias("type"), F.col("column").alias("column")))))
    rate = F.coalesce(F.try_divide(F.count_if("success"), F.count(F.lit(1))) * 100, F.lit(0.0))
    return results.groupBy(*keys).agg(rate.alias("success_rate"), failed.alias("failed")).withColumn(
        "decision", F.when(F.col("success_rate") >= F.lit(float(threshold)), TRAIN).otherwise(REMEDIATE))


def run_experiment(store: LayerStore, corruption: str, scenario: str, suite: Suite, *, dataset_id: str, run_id: str,
                   source: str = ORIGINAL, source_dataset: str | None = None, seed: int = 42,
                   as_saved: bool = False) -> DataFrame:
    """Corrupt the raw rows of a source, save the result as a dataset and validate it.

    The rows are judged as corrupted; ``as_saved`` judges them as the stored types keep them."""
    if corruption not in corrupt.CORRUPTORS:
        raise ValueError(f"unknown corruption: {corruption}")
    raw = store.load("raw", ordered=False, data_source=source, dataset_id=source_dataset)
    changed = staged(corrupt.CORRUPTORS[corruption](raw, scenario, store.domain, seed=seed), "corrupted")  # saved and judged
    store.save_derived("corrupted", changed, dataset_id, corruption, scenario, run_id)
    judged = store.load("corrupted", ordered=False, dataset_id=dataset_id, run_id=run_id) if as_saved else changed
    return validate(judged, suite, store, dataset_id=dataset_id, run_id=run_id, domain=store.domain)


def improvement(initial: DataFrame, final: DataFrame) -> DataFrame:
    """Before and after of two validations, one row."""
    before = statistics(initial).select(
        F.col("success_percent").alias("initial_success_rate"), F.col("unsuccessful_expectations").alias("initial_failures"))
    after = statistics(final).select(
        F.col("success_percent").alias("final_success_rate"), F.col("unsuccessful_expectations").alias("final_failures"))
    gained = F.col("final_success_rate") - F.col("initial_success_rate")
    return before.crossJoin(after).select(  # one row each
        "initial_success_rate", "final_success_rate", gained.alias("improvement"), "initial_failures", "final_failures",
        (F.col("initial_failures") - F.col("final_failures")).alias("failures_fixed"),
        F.coalesce(F.try_divide(gained, F.col("initial_success_rate")) * 100, F.lit(0.0)).alias("improvement_percentage"),
    )


def remediate(df: DataFrame, failed: Iterable, suite: Suite, *, baseline: DataFrame | None = None,
              domain: Domain = CREDIT, seed: int = 42, advanced: bool = True, bins: str = "shared", **repair_options):
    """Repair what failed, measure the drift this causes and validate again.

    Returns the repaired table (written once), the drift report (None without a baseline) and the
    result rows of the second validation."""
    repaired = staged(repair.improve(df, failed, suite, domain, seed=seed, advanced=advanced, **repair_options), "repaired")
    report = drift.report(baseline, repaired, domain.features, bins) if baseline is not None else None
    return repaired, report, run_suite(repaired, suite)


def remediate_and_gate(store: LayerStore, suite: Suite, *, dataset_id: str, run_id: str, initial: DataFrame,
                       source: str = ORIGINAL, threshold: float = FINAL_THRESHOLD, as_saved: bool = False,
                       include_pairs: bool = False, **options) -> dict[str, DataFrame]:
    """Remediate one corrupted dataset into the remediated layer and decide on it.

    ``initial`` are the result rows of its validation. Gives the drift report and its alerts, the
    improvement, and the verdict (one row: success_rate, passed)."""
    corrupted = store.load("corrupted", ordered=False, dataset_id=dataset_id)
    failed = failed_expectations(initial, include_pairs).collect()  # at most one row per rule
    about = corrupted.select("corruption_type", "corruption_scenario").first()
    baseline = store.load("raw", ordered=False, data_source=source)
    repaired, report, final = remediate(corrupted, failed, suite, baseline=baseline, domain=store.domain, **options)
    target = dataset_id.replace("corrupt", "remed")
    kind, scenario = (about["corruption_type"], about["corruption_scenario"]) if about else (None, None)
    store.save_derived("remediated", repaired, target, kind, scenario, run_id)
    if as_saved:
        repaired = store.load("remediated", ordered=False, dataset_id=target, run_id=run_id)
    final = validate(repaired, suite, store, dataset_id=target, run_id=run_id, domain=store.domain)
    verdict = statistics(final).select(
        F.col("success_percent").alias("success_rate"), (F.col("success_percent") >= F.lit(threshold)).alias("passed"))
    return {"drift": report, "alerts": drift.alerts(report), "improvement": improvement(initial, final),
            "final": final, "verdict": verdict}
