"""Files, layers, metadata, flows and the stream."""

import pytest
from pyspark.sql import functions as F

from plumbline.domain import CREDIT, credit_suite
from plumbline.functions.cleaning import nan_to_null, normalize_name, normalize_names, to_number, truncated_int
from plumbline.operators import corrupt
from plumbline.operators.expectations import run_suite
from plumbline.plans import flows
from plumbline.sources import layers, results, staging
from plumbline.streaming import gate as arrivals

SUITE = credit_suite()
DDL = ", ".join(f"{c} {t}" for c, t in CREDIT.columns.items())


@pytest.mark.parametrize("name,want", [
    (" Credit Amount ", "credit_amount"), ("Status & Sex", "status_sex"), ("a/b\\c-d", "a_b_c_d"), ("__x__y__", "x_y"),
    ("Age (in\tyears)", "age_in_years"), ("a$b", "ab"), ("1%", "1")])
def test_normalized_names(name, want):
    assert normalize_name(name) == want


def test_colliding_names_are_refused(spark):
    with pytest.raises(ValueError):
        normalize_names(spark.createDataFrame([(1, 2)], ["A b", "a_B"]))


def test_cleaning(spark):
    df = spark.createDataFrame([(float("nan"), "1.5"), (-2.9, "x"), (2.9, "NaN"), (None, None)], "x double, s string")
    assert [r[0] for r in nan_to_null(df).select("x").collect()] == [None, -2.9, 2.9, None]
    assert [r[0] for r in df.select(truncated_int(F.col("x"))).collect()] == [None, -2, 2, None]
    assert [r[0] for r in df.select(to_number(F.col("s"))).collect()] == [1.5, None, None, None]


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "credit.csv")
    names = [c.upper().replace("_", "-") for c in CREDIT.columns]
    lines = [";".join(names)]
    for i in range(200):
        cells = []
        for c, t in CREDIT.columns.items():
            if t == "string":
                cells.append({"checking_account_status": "A11", "foreign_worker": "A201"}.get(c, "A30" if c == "credit_history" else "A40"))
            else:
                cells.append(str({"credit_amount": 1000 + i, "duration_in_month": 12, "age_in_years": 30, "category": i % 2 + 1}.get(c, 1)))
        lines.append(";".join(cells))
    open(path, "w").write("\n".join(lines))
    return path


@pytest.fixture(scope="module")
def store(spark, csv, tmp_path_factory):
    store = layers.LayerStore(spark, str(tmp_path_factory.mktemp("store")))
    loaded = flows.initial_load(store, csv, DDL, dataset_id="il_1", run_id="r1").first()
    assert loaded["rows_loaded"] == 200
    return store


def test_keys_given_at_load_are_unique_and_stay(store):
    assert store.read("raw").select("id").distinct().count() == 200
    assert store.load("raw").exceptAll(store.load("raw")).count() == 0


def test_filters_and_pruning(store):
    assert store.load("raw", data_source="nothing").count() == 0
    plan = store.load("raw", ordered=False, dataset_id="il_1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset_id" in plan
    assert store.load_features("raw", limit=7).count() == 7
    assert store.load_features("raw").columns == ["id", *CREDIT.columns]


def test_contract(store, spark):
    with pytest.raises(ValueError, match="missing required"):
        store.save_raw(spark.range(3), "x", "y", "z")
    with pytest.raises(ValueError, match="unknown layer"):
        store.path("other")


def test_experiment_remediation_and_log(store):
    initial = flows.run_experiment(store, "missing_values", "light", SUITE, dataset_id="corrupt_1", run_id="r1")
    assert store.read("corrupted").filter("credit_history is null").count() == 30
    out = flows.remediate_and_gate(store, SUITE, dataset_id="corrupt_1", run_id="r1", initial=initial, advanced=False)
    saved = store.read("remediated").filter("dataset_id = 'remed_1'")
    assert saved.count() == 200 and saved.filter("credit_history is null").count() == 0
    ids = store.read("raw").select(F.col("id").alias("original_row_id"))
    assert saved.select("original_row_id").exceptAll(ids).count() == 0
    assert out["improvement"].first()["failures_fixed"] > 0
    assert {r["dataset_id"] for r in store.read_log("dq_results").collect()} >= {"corrupt_1", "remed_1"}
    assert store.latest("remediated") == "remed_1"
    assert results.recent_failures(store.read_log("dq_results"), "corrupt_1").count() == 1
    with pytest.raises(ValueError):
        flows.run_experiment(store, "nothing", "light", SUITE, dataset_id="x", run_id="r")


def test_gate_uses_the_given_threshold(spark):
    df = spark.createDataFrame([(1, "A11")], "id int, checking_account_status string")
    from plumbline.operators.expectations import Expectation, Suite
    bad = Suite((Expectation("expect_column_values_to_be_null", {"column": "id"}),))
    got = run_suite(df, bad)
    assert flows.gate(got, 0).first()["decision"] == "ml"
    verdict = flows.gate(got, 90).first()
    assert verdict["decision"] == "remediate" and verdict["failed"][0]["column"] == "id"


def test_metadata_upsert_and_log(store, spark):
    store.record("raw", "il_1", 200, 21)
    store.record("raw", "il_1", 250, 21)
    store.record("odd", "v", 1, 1)
    got = {r["dataset_name"]: r for r in store.metadata().collect()}
    assert got["raw_il_1"]["row_count"] == 250 and got["raw_il_1"]["created_at"] < got["raw_il_1"]["updated_at"]
    assert got["unknown_v"]["dataset_type"] == "unknown"
    merged = layers.upsert_metadata(store.metadata(), layers.metadata_entry(spark, "raw", "il_1", 300, 22))
    row = merged.filter("dataset_name = 'raw_il_1'").first()
    assert row["row_count"] == 300 and row["created_at"] == got["raw_il_1"]["created_at"] and merged.count() == 2


def test_stream_equals_batch_and_a_repeated_batch_counts_once(store, spark, tmp_path):
    schema, source = store.schema("corrupted"), store.path("corrupted")
    args = (spark, source, schema, SUITE, str(tmp_path / "sink"), str(tmp_path / "check"))
    arrivals.validate_arrivals(*args).awaitTermination()
    arrivals.validate_arrivals(*args).awaitTermination()  # nothing new
    batch = run_suite(store.read("corrupted"), SUITE, ["dataset_id"])
    streamed = arrivals.arrived_results(spark, schema, SUITE, str(tmp_path / "sink"))
    assert batch.exceptAll(streamed).count() == 0 and streamed.exceptAll(batch).count() == 0
    import shutil
    shutil.copytree(tmp_path / "sink", tmp_path / "sink2")
    again = (spark, source, schema, SUITE, str(tmp_path / "sink"), str(tmp_path / "check-lost"))
    arrivals.validate_arrivals(*again).awaitTermination()  # the same batch once more
    assert arrivals.arrived_results(spark, schema, SUITE, str(tmp_path / "sink")).exceptAll(streamed).count() == 0


class Session:
    """Just enough of a session to ask for its folder."""

    def __init__(self, setting=None, master="local[2]"):
        setting = {"spark.checkpoint.dir": setting} if setting else {}
        self.conf = self
        self.get = lambda name, default=None: setting.get(name, default)
        self.sparkContext = self
        self.getConf = lambda: self
        self.getCheckpointDir = lambda: None
        self.master, self.applicationId = master, f"test-{master}"


def test_shared_folder_is_the_sessions_and_never_local_on_a_cluster():
    assert staging.fresh_path(Session("/shared/x"), "t").startswith("/shared/x/plumbline/t-")
    for master in ("local[2]", "yarn"):
        with pytest.raises(RuntimeError):
            staging.shared_folder(Session(master=master))


def test_corrupted_rows_keep_the_first_key(store, spark):
    df = store.load("corrupted", ordered=False).withColumn("id", F.col("id") + 10**6)
    rows = layers.derived_rows(df, "remed_x", "t", "s", "r")
    assert rows.select("original_row_id").exceptAll(store.read("raw").select("id")).count() == 0
    assert corrupt.CORRUPTORS.keys() == {"missing_values", "outliers", "categorical_errors", "label_errors",
                                         "relationship_violation", "conjoined_corruption"}


def test_keys_are_places_in_the_files_however_they_are_cut(spark, tmp_path):
    """The same keys with whole files and with blocks of a few rows; a second load goes on after the first."""
    path = str(tmp_path / "rows")
    spark.range(3000).select(F.col("id").alias("n"), F.repeat(F.lit("x"), 20).alias("t")).repartition(3).write.option("header", True).option("sep", ";").csv(path)
    found = []
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = flows.numbered(flows.read_csv(spark, path, "n bigint, t string", places=True), 10)
            found.append(sorted((r["id"], r["n"]) for r in rows.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and [i for i, _ in found[0]] == list(range(10, 3010))
