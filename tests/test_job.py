"""The job around the fits: column roles, saved segmentations, what a write counts, rejected
lines, agreement, releases, journal, scratch, and how many Spark jobs steps take."""

import itertools
import os
import random
from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.sql import functions as F

from conftest import TESTDATA
from tessella.config import SegmentationConfig
from tessella.operators import agreement, clustering, evaluation, inspection, profiles, quality
from tessella.operators.features import SCALED, fit_features
from tessella.operators.labels import rank_labels
from tessella.plans.bundle import SchemaMismatch, load_bundle, read_new_customers, save_bundle
from tessella.plans.segmentation import REPORTED, run_job, segment_customers
from tessella.sinks.releases import log_of, prune, read_released, release
from tessella.sinks.tables import write_by_label, write_csv, write_parquet
from tessella.sources.customers import read_customers_checked
from tessella.sources.order_history import bank_customers, dirty_customers

FOLDER = str(TESTDATA / "sf0.001")
SMALL = SegmentationConfig(invalid="skip", numeric=("age", "balance"), categorical=("country",), min_k=2, max_k=3, max_iter=5)


@pytest.fixture(scope="module")
def customers(spark):
    return bank_customers(spark, FOLDER).cache()


@contextmanager
def jobs(spark, name):
    """The Spark jobs started inside the block, by their ids."""
    found = []
    spark.sparkContext.setJobGroup(name, name)
    try:
        yield found
    finally:
        found += spark.sparkContext.statusTracker().getJobIdsForGroup(name)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# Column roles -------------------------------------------------------------------------


def test_own_roles_give_a_report(customers):
    with segment_customers(customers, SMALL, k=2) as result:
        assert set(result.report.columns) == {"cluster", "segment_name", "size", "share_percent", "avg_age", "avg_balance"}
        assert result.profiles.columns == ["cluster", "size", "avg_age", "avg_balance", "country_mode"]
        table = profiles.clustered_customers(result.labelled, SMALL)
        assert table.columns == ["customer_id", "cluster", "country", "age", "balance", "churn"]
        assert sum(r["size"] for r in result.report.collect()) == 150
        assert set(result.tables()) == {"kmeans_evaluation", "cluster_profiles", "churn_by_cluster", "clustered_customers"}


def test_described_and_carried_columns_are_no_features(customers):
    config = replace(SMALL, described=("credit_card", "tenure"), carried=("gender",), outcome=None)
    with segment_customers(customers, SMALL, k=2) as plain, segment_customers(customers, config, k=2) as result:
        assert result.report.columns[-2:] == ["avg_tenure", "credit_card_percent"]
        assert "gender" in profiles.clustered_customers(result.labelled, config).columns
        assert {r["churn_rate"] for r in result.churn.collect()} == {None}
        pick = lambda r: sorted(map(tuple, r.labelled.select("customer_id", "cluster").collect()))
        assert pick(plain) == pick(result)


def test_an_absent_column_is_named(customers):
    with pytest.raises(ValueError, match="loyalty"):
        segment_customers(customers, replace(SMALL, described=("loyalty",)), k=2)


def test_rules_of_absent_columns_are_left_out(spark):
    rows = [(0, 30.0, 2.0, 5.0), (1, 50.0, 9.0, 1.0), (2, 50.0, 9.0, 9.0)]
    table = spark.createDataFrame(rows, "cluster int, avg_age double, avg_tenure double, avg_balance double")
    names = {r["cluster"]: r["segment_name"] for r in profiles.with_names(table).collect()}
    assert names == {0: "Young Newcomers", 1: "Low-Balance Savers", 2: "Standard Segment 2"}


# Inspection by the write --------------------------------------------------------------


def test_the_write_counts_what_a_scan_would(spark):
    dirty = dirty_customers(spark, FOLDER)
    config = SegmentationConfig(invalid="skip", min_k=2, max_k=2)
    with clustering.fit_table(dirty, config) as fit:
        told, kinds = fit.summary, fit.customers.schema
    pairs = [
        (inspection.schema_table(told, kinds), inspection.schema_report(dirty)),
        (inspection.string_table(told, kinds), inspection.describe_strings(dirty)),
        (quality.left_out_table(told), quality.left_out(dirty, config.numeric)),
        (quality.missing_table(told.select("_rows", *[F.col(f"{c}.count").alias(c) for c in kinds.names]), kinds.names), quality.missing_values(dirty)),
    ]
    for counted, scanned in pairs:
        assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, scanned.collect()))
    scanned = {r[0]: r[1:] for r in inspection.describe_numeric(dirty).collect()}
    for name, *values in inspection.numeric_table(told, kinds).collect():
        assert values == pytest.approx(list(scanned[name]))


def test_the_report_reads_the_customers_for_the_head_alone(customers):
    with segment_customers(customers, SMALL, k=2) as result:
        scans = [n for n in REPORTED if "FileScan" in getattr(result, n)._jdf.queryExecution().toString()]
        assert scans == ["head"]


# Jobs ---------------------------------------------------------------------------------


def write_to(df, folder):
    df.write.parquet(f"{folder}/table")
    return f"{folder}/table"


def test_encoding_takes_five_jobs(spark, customers, tmp_path):
    customers = spark.read.parquet(write_to(customers, tmp_path))
    with jobs(spark, "labels") as found:
        ranked = rank_labels(customers, ["country", "gender"])
        hot = ranked.hot()
    assert len(found) <= 5
    assert len(hot["country"]) == 5 == ranked.n_labels["country"]
    # Every label is looked up in the row, so no join is planned.
    plan = fit_features(customers, SMALL).transform(customers)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_scores_of_a_sweep_take_two_passes(spark, customers):
    df = fit_features(customers, SMALL).transform(customers).select(SCALED, *[(F.col("customer_id") % k).alias(f"c{k}") for k in range(2, 11)])
    df = df.cache()
    assert df.count() == 150
    with jobs(spark, "scores") as found:
        scores, sizes = evaluation.silhouettes(df, {k: f"c{k}" for k in range(2, 11)})
    assert len(found) <= 4  # two passes, an exchange each
    assert all(sum(sizes[k].values()) == 150 and -1 <= scores[k] <= 1 for k in range(2, 11))


# Saved segmentations ------------------------------------------------------------------


@pytest.fixture(scope="module")
def saved(spark, customers, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bundle"))
    result = segment_customers(customers, SMALL, k=3)
    save_bundle(result, folder)
    return folder, result


def test_a_loaded_bundle_labels_as_the_job_did(spark, customers, saved):
    folder, result = saved
    bundle = load_bundle(spark, folder)
    assert bundle.config == SMALL
    with jobs(spark, "apply") as found:
        labelled = bundle.apply(customers.drop("churn", "credit_score"))
    assert not found  # nothing runs until the labels are read
    names = {r["cluster"]: r["segment_name"] for r in result.names.collect()}
    want = {(r["customer_id"], r["cluster"], names[r["cluster"]]) for r in result.labelled.collect()}
    assert {tuple(r) for r in labelled.select("customer_id", "cluster", "segment_name").collect()} == want
    sizes = [r["size"] for r in result.report.orderBy("cluster").collect()]
    assert sizes == sorted(sizes, reverse=True)


def test_new_customers_are_checked(spark, customers, saved):
    bundle = load_bundle(spark, saved[0])
    with pytest.raises(SchemaMismatch, match="age: absent; balance: string is no number"):
        bundle.apply(customers.drop("age").withColumn("balance", F.lit("x")))
    with pytest.raises(SchemaMismatch, match="cluster: taken"):
        bundle.apply(customers.withColumn("cluster", F.lit(1)))
    unseen = customers.withColumn("country", F.lit("Atlantis")).withColumn("extra", F.lit(1))
    assert bundle.apply(unseen).filter("cluster IS NULL").count() == 0
    assert bundle.apply(customers.limit(0)).count() == 0


def test_new_customers_in_any_order_of_columns(spark, customers, saved, tmp_path):
    bundle, path = load_bundle(spark, saved[0]), str(tmp_path / "csv")
    write_csv(customers.select("balance", F.lit("n").alias("note"), "country", "customer_id", "age"), path)
    new = read_new_customers(spark, bundle, path)
    assert dict(new.dtypes)["age"] == "int" and dict(new.dtypes)["note"] == "string"
    have = {tuple(r) for r in bundle.apply(new).select("customer_id", "cluster").collect()}
    assert have == {tuple(r) for r in bundle.apply(customers).select("customer_id", "cluster").collect()}


def test_half_a_bundle_is_none(spark, saved, tmp_path, monkeypatch):
    folder = str(tmp_path / "half")
    monkeypatch.setattr("tessella.plans.bundle.VERSION", 2)
    save_bundle(saved[1], folder)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="version 2"):
        load_bundle(spark, folder)
    monkeypatch.setattr("tessella.plans.bundle.asdict", lambda _: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        save_bundle(saved[1], folder)
    with pytest.raises(ValueError, match="no whole bundle"):
        load_bundle(spark, folder)


# Rejected lines -----------------------------------------------------------------------


def test_malformed_lines_are_told_from_nulls(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(
        "id,name,age\n1,a,5\n2,,\n3,\"x, y\",6\n4,b,old\n5,c\n6,d,7,8\nseven,e,9\n8,\"q\\\"r\",\n9,,,\n,,\n"
    )
    schema = spark.createDataFrame([], "id long, name string, age int").schema
    files = read_customers_checked(spark, str(path), schema)
    assert sorted(map(tuple, files.customers.collect()), key=str) == [
        (1, "a", 5), (2, None, None), (3, "x, y", 6), (8, 'q"r', None), (None, None, None),
    ]
    assert {(r["line"], r["reason"]) for r in files.rejected.collect()} == {
        ("4,b,old", "age is no int"), ("5,c", "too few fields"), ("6,d,7,8", "too many fields"),
        ("seven,e,9", "id is no bigint"), ("9,,,", "too many fields"),
    }
    assert {r["reason"]: r["n"] for r in files.counts().collect()}["too many fields"] == 2


def test_the_job_keeps_rejected_lines_apart(spark, customers, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(customers.coalesce(1), source)
    (part,) = [f for f in os.listdir(source) if f.endswith(".csv")]
    with open(f"{source}/{part}", "a") as file:
        file.write("nobody,1\n")
    os.remove(f"{source}/.{part}.crc")
    with run_job(spark, source, target, SMALL, k=2) as result:
        assert result.labelled.count() == 150
    assert read_released(spark, target, "rejected_counts").collect()[0]["reason"] == "too few fields"
    assert read_released(spark, target, "report_schema").first()["n_rows"] == 150
    assert read_released(spark, target, "report_left_out").first()["clustered"] == 150


# Agreement ----------------------------------------------------------------------------


def rand_by_pairs(a, b):
    pairs = list(itertools.combinations(range(len(a)), 2))
    both = sum(a[i] == a[j] and b[i] == b[j] for i, j in pairs)
    one, two = sum(a[i] == a[j] for i, j in pairs), sum(b[i] == b[j] for i, j in pairs)
    expected, most = one * two / len(pairs), (one + two) / 2
    alike = (both + sum(a[i] != a[j] and b[i] != b[j] for i, j in pairs)) / len(pairs)
    return alike, 1.0 if most == expected else (both - expected) / (most - expected)


@pytest.mark.parametrize("seed", range(4))
def test_adjusted_rand_against_all_pairs(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, seed), rnd.randint(0, 2)) for _ in range(40)]
    df = spark.createDataFrame([*rows, (None, 1), (1, None)], "a int, b int")
    got = agreement.adjusted_rand(agreement.contingency(df, "a", "b")).first()
    assert got["n"] == 40
    assert tuple(got)[1:] == pytest.approx(rand_by_pairs(*zip(*rows)))


def test_agreement_of_renamed_and_of_no_rows(spark):
    df = spark.createDataFrame([(i % 3, (i % 3 + 1) % 3) for i in range(30)], "a int, b int")
    assert agreement.adjusted_rand(agreement.contingency(df, "a", "b")).first()["adjusted_rand_index"] == 1.0
    assert agreement.adjusted_rand(agreement.contingency(df.limit(0), "a", "b")).first()["rand_index"] is None


@pytest.mark.parametrize("k", [1, 2, 3, 5, 6])
def test_heaviest_pairing_against_all(k):
    rnd = random.Random(k)
    for _ in range(30):
        weights = [[rnd.randint(0, 12) for _ in range(k)] for _ in range(k)]
        pairing = agreement.heaviest_pairing(weights)
        assert sorted(pairing) == list(range(k))
        total = sum(weights[i][j] for i, j in enumerate(pairing))
        assert total == max(sum(weights[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(k)))


def test_matching_of_unlike_numbers_of_labels(spark):
    df = spark.createDataFrame([(0, 5)] * 4 + [(1, 5)] * 3 + [(1, 6)], "a int, b int")
    assert set(map(tuple, agreement.best_matching(agreement.contingency(df, "a", "b")).collect())) == {(0, 5, 4), (1, 6, 1)}
    alone = agreement.best_matching(agreement.contingency(df.filter("b = 5"), "a", "b")).collect()
    assert set(map(tuple, alone)) == {(0, 5, 4), (1, None, 0)}


def test_canonical_numbers_do_not_depend_on_the_fits_own():
    centres, sizes = [[0.0], [1.0], [-1.0], [2.0]], [5, 9, 5, 1]
    for order in itertools.permutations(range(4)):
        numbers = agreement.canonical_numbers([centres[i] for i in order], {n: sizes[i] for n, i in enumerate(order)})
        assert [numbers[order.index(i)] for i in range(4)] == [2, 0, 1, 3]


# Releases, journal, scratch -----------------------------------------------------------


def test_a_release_that_fails_leaves_the_old_one(spark, tmp_path):
    folder = str(tmp_path / "out")
    tables = lambda n: {f"t{i}": (spark.range(n), write_parquet, "parquet") for i in range(4)}
    with pytest.raises(ValueError, match="nothing"):
        read_released(spark, folder, "t0")
    release(spark, folder, tables(3))

    def fails(df, path):
        raise OSError("disk full")

    with pytest.raises(OSError):
        release(spark, folder, tables(5) | {"t3": (spark.range(5), fails, "parquet")})
    assert [read_released(spark, folder, f"t{i}").count() for i in range(4)] == [3] * 4
    release(spark, folder, tables(7))
    assert [read_released(spark, folder, f"t{i}").count() for i in range(4)] == [7] * 4
    assert [e["number"] for e in log_of(spark, folder)] == [0, 1]
    assert prune(spark, folder) == 1
    assert read_released(spark, folder, "t0").count() == 7
    assert sum(f.startswith("release-1-") for f in os.listdir(folder)) == 2  # one of them the failed one


def test_a_failed_job_takes_up_its_fits(spark, customers, tmp_path, monkeypatch):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_csv(customers, source)

    def stop(*_):
        raise KeyboardInterrupt("the driver is lost")

    monkeypatch.setattr("tessella.plans.segmentation.release", stop)
    with pytest.raises(KeyboardInterrupt):
        run_job(spark, source, target, SMALL, resume=True)
    monkeypatch.undo()

    def no_fit(*_):
        raise AssertionError("fitted again")

    monkeypatch.setattr(KMeans, "_fit", no_fit)
    monkeypatch.setattr(BisectingKMeans, "_fit", no_fit)
    with run_job(spark, source, target, SMALL, resume=True) as result:
        report = result.report.collect()
    assert sum(r["size"] for r in report) == 150
    assert not os.path.exists(f"{target}/journal") or not os.listdir(f"{target}/journal")
    # Another config is another run.
    with pytest.raises(AssertionError, match="fitted again"):
        run_job(spark, source, target, replace(SMALL, seed=7), resume=True)


def test_nothing_is_left_after_closing(spark, customers):
    shared = spark.conf.get("spark.checkpoint.dir")
    below = lambda: {f"{d}/{f}" for d, _, files in os.walk(f"{shared}/tessella") for f in files}
    before = below()
    result = segment_customers(customers, SMALL, k=2)
    assert below() > before
    result.close()
    result.close()
    assert below() == before
    with pytest.raises(ValueError):
        segment_customers(customers, replace(SMALL, carried=("absent",)), k=2)
    assert below() == before


# Sinks --------------------------------------------------------------------------------


def test_segments_in_bounded_files(spark, tmp_path):
    path = str(tmp_path / "segments")
    df = spark.range(5000).withColumn("cluster", F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(7).cast("int"))
    sizes = {r["cluster"]: r["count"] for r in df.groupBy("cluster").count().collect()}
    write_by_label(df, path, "cluster", sizes, rows_per_file=500)
    files = {c: [f for f in os.listdir(f"{path}/cluster={c}") if f.endswith(".parquet")] for c in sizes}
    assert 9 <= len(files[7]) <= 18 and all(len(files[c]) == 1 for c in (0, 1, 2))
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("id", "cluster").collect())) == sorted(map(tuple, df.collect()))
    counts = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert counts <= 500
    plan = back.filter("cluster = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cluster" in plan


def test_segment_grid(spark):
    rows = [(float(b), b % 2, 0) for b in range(101)] + [(None, 1, 1), (float("nan"), 1, 1)]
    df = spark.createDataFrame(rows, "balance double, products_number int, cluster int")
    grid = profiles.segment_grid(df, bins=10).collect()
    assert sum(r["n"] for r in grid) == 103
    assert {r["x_bin"] for r in grid} == {None, *range(10)}
    assert {(r["x_from"], r["n"]) for r in grid if r["x_bin"] == 9} == {(90.0, 6), (90.0, 5)}
    assert [r["n"] for r in grid if r["x_bin"] is None] == [2]
    equal = profiles.segment_grid(df.filter("balance = 5")).collect()
    assert [(r["x_bin"], r["x_from"], r["n"]) for r in equal] == [(0, 5.0, 1)]
    assert profiles.segment_grid(df.limit(0)).count() == 0


def test_the_session_adapts_at_run_time(spark):
    from tessella.session import get_session

    session = get_session("another name")
    assert session.sparkContext is spark.sparkContext
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
