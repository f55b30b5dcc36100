"""One query per operator, over customers derived from the given tables.

Doubles that are sums of fractions are rounded to six places, as the order of
addition differs between engines; everything else is returned as computed.
Seven columns of ``bank_customers`` are NULL for a customer without orders, so
the queries use the "skip" policy: such a customer has no features to cluster.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.config import SegmentationConfig
from tessella.operators import agreement, clustering, evaluation, inspection, profiles, quality
from tessella.operators.features import (
    RAW,
    SCALED,
    assembler,
    feature_projection,
    fit_encoder,
    fit_features,
    long_form,
    wide_form,
)
from tessella.operators.layout import materialised, persisted
from tessella.plans.bundle import load_bundle, save_bundle
from tessella.plans.segmentation import run_job, segment_customers
from tessella.session import scratch_path
from tessella.sinks.releases import read_released
from tessella.sinks.tables import write_by_label, write_csv, write_parquet
from tessella.sources.customers import CheckedFiles, read_customers_checked, read_customers_csv, read_customers_parquet
from tessella.sources.order_history import bank_customers, dirty_customers

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = SegmentationConfig(invalid="skip")
ID = CONFIG.id_col
# Declared start centres: the feature vectors of these customers. They make a
# clustering of all customers that any engine can reproduce.
SEEDS = tuple(range(CONFIG.max_k))
K = 4
ROUNDS = 5


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Inputs -----------------------------------------------------------------------


def prepared(spark: SparkSession, folder: str) -> tuple[DataFrame, PipelineModel]:
    """All customers, and the fitted model that gives them features."""
    customers = materialised(bank_customers(spark, folder))
    return customers, fit_features(customers, CONFIG)


def features(spark: SparkSession, folder: str) -> DataFrame:
    customers, model = prepared(spark, folder)
    return model.transform(customers)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """All customers, labelled with the nearest of the first K seeds."""
    customers, model = prepared(spark, folder)
    centres = clustering.vectors_of(customers, model, ID, SEEDS[:K])
    return clustering.assign_to_centres(model.transform(customers), centres)


def labelled_by_k(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[int, str]]:
    """All customers with a label per k, the first k seeds being the centres."""
    customers, model = prepared(spark, folder)
    centres = clustering.vectors_of(customers, model, ID, SEEDS)
    labels = clustering.label_names(CONFIG.ks)
    return clustering.assign_to_first(model.transform(customers), centres, labels), labels


def seeded_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Silhouettes of ``labelled_by_k``."""
    df, labels = labelled_by_k(spark, folder)
    with persisted(df.select(SCALED, *labels.values())) as scored:
        return evaluation.score_labels(scored, labels)[0]


def labelled_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.cluster_profiles(labelled(spark, folder))


# Sources and inspection -------------------------------------------------------


def scan_csv(spark, folder):
    path = scratch_path(spark, "customers_csv")
    write_csv(bank_customers(spark, folder), path)
    return read_customers_csv(spark, path)


def scan_csv_inferred(spark, folder):
    path = scratch_path(spark, "customers_csv")
    write_csv(bank_customers(spark, folder), path)
    return read_customers_csv(spark, path, schema=None)


def row_count(spark, folder):
    return inspection.row_count(bank_customers(spark, folder))


def schema_report(spark, folder):
    return inspection.schema_report(bank_customers(spark, folder))


def head_records(spark, folder):
    return inspection.head_records(bank_customers(spark, folder), ID)


def describe_numeric(spark, folder):
    return rounded(inspection.describe_numeric(bank_customers(spark, folder)), "mean", "stddev")


def describe_strings(spark, folder):
    return inspection.describe_strings(dirty_customers(spark, folder))


# Quality ----------------------------------------------------------------------


def non_null_counts(spark, folder):
    return quality.non_null_counts(dirty_customers(spark, folder))


def missing_values(spark, folder):
    return quality.missing_values(dirty_customers(spark, folder))


def missing_columns(spark, folder):
    return quality.missing_columns(dirty_customers(spark, folder))


# Features ---------------------------------------------------------------------


def encoded(customers: DataFrame) -> DataFrame:
    return fit_encoder(customers, CONFIG).transform(customers)


def index_country(spark, folder):
    df = encoded(materialised(dirty_customers(spark, folder)))
    return df.select(ID, "country", "country_index")


def index_gender(spark, folder):
    df = encoded(materialised(dirty_customers(spark, folder)))
    return df.select(ID, "gender", "gender_index")


def feature_columns(spark, folder):
    return feature_projection(encoded(materialised(bank_customers(spark, folder))), CONFIG)


def assemble_features(spark, folder):
    df = assembler(CONFIG).transform(encoded(materialised(dirty_customers(spark, folder))))
    return long_form(df, ID, RAW, CONFIG.feature_cols)


def standardize_features(spark, folder):
    df = long_form(features(spark, folder), ID, SCALED, CONFIG.feature_cols)
    return rounded(df, "value")


def feature_pipeline(spark, folder):
    df = wide_form(features(spark, folder), ID, SCALED, CONFIG.feature_cols)
    return rounded(df, *CONFIG.feature_cols)


# Clustering with declared centres ---------------------------------------------


def assign_clusters(spark, folder):
    return labelled(spark, folder).select(ID, "cluster")


def kmeans_lloyd_step(spark, folder):
    customers, model = prepared(spark, folder)
    centres = clustering.vectors_of(customers, model, ID, SEEDS[:K])
    with persisted(model.transform(customers).select(ID, SCALED)) as df:
        moved = clustering.lloyd_rounds(df, centres, ROUNDS)
    rows = [
        (cluster, name, value)
        for cluster, centre in enumerate(moved)
        for name, value in zip(CONFIG.feature_cols, centre)
    ]
    result = spark.createDataFrame(rows, "cluster int, feature string, centre double")
    return rounded(result, "centre")


def silhouette_score(spark, folder):
    with persisted(labelled(spark, folder).select(SCALED, "cluster")) as df:
        return rounded(evaluation.score_labels(df, {K: "cluster"})[0], "silhouette_score")


def cluster_sizes(spark, folder):
    return evaluation.cluster_sizes(labelled(spark, folder))


def sizes_by_k(spark, folder):
    return evaluation.sizes_by_k(*labelled_by_k(spark, folder))


def best_k(spark, folder):
    return rounded(evaluation.best_k(seeded_scores(spark, folder)), "silhouette_score")


def silhouette_series(spark, folder):
    return rounded(evaluation.score_series(seeded_scores(spark, folder)), "silhouette_score")


def silhouette_band(spark, folder):
    return evaluation.score_series(seeded_scores(spark, folder)).select("k", "band")


def compare_rule(spark, folder):
    df = labelled(spark, folder).withColumn("by_id", (F.col(ID) % K).cast("int"))
    with persisted(df.select(SCALED, "cluster", "by_id")) as scored:
        rows = [
            ("kmeans", evaluation.silhouette(scored, "cluster")),
            ("bisecting_kmeans", evaluation.silhouette(scored, "by_id")),
        ]
    scores = spark.createDataFrame(rows, "algorithm string, silhouette_score double")
    return rounded(evaluation.compare(scores), "kmeans", "bisecting_kmeans", "delta")


# Profiles and churn -----------------------------------------------------------


def cluster_profiles(spark, folder):
    return rounded(labelled_profiles(spark, folder), "avg_balance", "avg_salary")


def profile_lookup(spark, folder):
    profile = profiles.profile_lookup(labelled_profiles(spark, folder), K - 1)
    return rounded(profile, "avg_balance", "avg_salary")


def segment_share(spark, folder):
    return profiles.segment_share(labelled_profiles(spark, folder))


def profile_medians(spark, folder):
    medians = profiles.profile_medians(labelled_profiles(spark, folder))
    return rounded(medians, *medians.columns)


def segment_names(spark, folder):
    return profiles.segment_names(labelled_profiles(spark, folder))


def segment_report(spark, folder):
    report = profiles.segment_report(labelled_profiles(spark, folder))
    return rounded(report, "avg_balance", "avg_salary")


def churn_by_cluster(spark, folder):
    return profiles.churn_by_cluster(labelled(spark, folder))


def churn_percent(spark, folder):
    return profiles.churn_percent(profiles.churn_by_cluster(labelled(spark, folder)))


def clustered_customers(spark, folder):
    return profiles.clustered_customers(labelled(spark, folder))


def segment_projection(spark, folder):
    return profiles.segment_projection(labelled(spark, folder))


# Sinks: write, then read back -------------------------------------------------


def sink_evaluation(spark, folder):
    path = scratch_path(spark, "kmeans_evaluation")
    write_csv(seeded_scores(spark, folder), path, files=1)
    back = spark.read.schema(evaluation.SCORES).option("header", True).csv(path)
    return rounded(back, "silhouette_score")


def sink_profiles(spark, folder):
    path = scratch_path(spark, "cluster_profiles")
    profile = labelled_profiles(spark, folder)
    write_csv(profile, path, files=1)
    back = spark.read.schema(profile.schema).option("header", True).csv(path)
    return rounded(back, "avg_balance", "avg_salary")


def sink_churn(spark, folder):
    path = scratch_path(spark, "churn_by_cluster")
    churn = profiles.churn_by_cluster(labelled(spark, folder))
    write_csv(churn, path, files=1)
    return spark.read.schema(churn.schema).option("header", True).csv(path)


def sink_clustered(spark, folder):
    path = scratch_path(spark, "clustered_customers")
    write_parquet(profiles.clustered_customers(labelled(spark, folder)), path)
    return read_customers_parquet(spark, path)


def sink_clustered_csv(spark, folder):
    path = scratch_path(spark, "clustered_customers_csv")
    table = profiles.clustered_customers(labelled(spark, folder))
    write_csv(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


def sink_by_segment(spark, folder):
    """Written by cluster, in files of 100 rows at most; one segment is read back."""
    path = scratch_path(spark, "customers_by_segment")
    df = labelled(spark, folder)
    sizes = {r["cluster"]: r["size"] for r in evaluation.cluster_sizes(df).collect()}
    table = profiles.clustered_customers(df)
    write_by_label(table, path, "cluster", sizes, rows_per_file=100)
    return spark.read.schema(table.schema).parquet(path).filter(F.col("cluster") == K - 1)


# Malformed lines: every 19th customer has no number for an age, others of every 23rd
# lack the last field, others of every 29th have one too many.


def broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    customers = bank_customers(spark, folder)
    id_is = lambda n: F.col(ID) % n == 0
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in customers.columns]
    age = customers.columns.index("age")
    bad_age = [*fields[:age], F.lit("x"), *fields[age + 1 :]]
    line = (
        F.when(id_is(19), F.concat_ws(",", *bad_age))
        .when(id_is(23), F.concat_ws(",", *fields[:-1]))
        .when(id_is(29), F.concat_ws(",", *fields, F.lit("more")))
    )
    return customers.select(F.coalesce(line, F.concat_ws(",", *fields)).alias("value"))


def checked(spark: SparkSession, folder: str) -> CheckedFiles:
    path = scratch_path(spark, "broken_csv")
    broken_lines(spark, folder).write.text(path)
    return read_customers_checked(spark, path, header=False)


def rejected_counts(spark, folder):
    return checked(spark, folder).counts()


def accepted_lines(spark, folder):
    return checked(spark, folder).customers


# NULLs through the chain: customers without a feature are left out, and counted --


def dirty_features(spark: SparkSession, folder: str) -> DataFrame:
    customers = materialised(dirty_customers(spark, folder))
    return fit_features(customers, CONFIG).transform(customers)


def standardize_dirty(spark, folder):
    df = long_form(dirty_features(spark, folder), ID, SCALED, CONFIG.feature_cols)
    return rounded(df, "value")


def left_out(spark, folder):
    customers = materialised(dirty_customers(spark, folder))
    return quality.left_out(customers, CONFIG.numeric)


# Fits whose answer is unique: with country as the only feature, a fit with as many
# clusters as countries has one per country, whatever its start.
BY_COUNTRY = replace(CONFIG, numeric=(), categorical=("country",), min_k=4, max_k=6)
COUNTRIES = 5


def first_members(df: DataFrame) -> DataFrame:
    """Clusters named by their smallest customer, as their numbers are arbitrary."""
    first = df.groupBy("cluster").agg(F.min(ID).alias("first_member"), F.count("*").alias("size"))
    return df.select(ID, "cluster").join(first, "cluster").select(ID, "first_member", "size")


def kmeans_by_country(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), BY_COUNTRY) as fit:
        model = clustering.fit_kmeans(fit.table, COUNTRIES, BY_COUNTRY)
    return first_members(clustering.assign(fit.features, model))


def bisecting_by_country(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), BY_COUNTRY) as fit:
        model = clustering.fit_bisecting(fit.table, fit.model, COUNTRIES, BY_COUNTRY)
    return first_members(clustering.assign_bisecting(fit.features, fit.model, model))


def sweep_by_country(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), BY_COUNTRY) as fit:
        scores = clustering.sweep(fit, BY_COUNTRY).scores
    return rounded(evaluation.best_k(scores), "silhouette_score")


def compare_by_country(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), BY_COUNTRY) as fit:
        model = clustering.fit_kmeans(fit.table, COUNTRIES, BY_COUNTRY)
        score = evaluation.silhouette(clustering.assign(fit.table, model), "cluster")
        compared = clustering.compare_algorithms(fit, score, COUNTRIES, BY_COUNTRY)
    return rounded(compared, "kmeans", "bisecting_kmeans", "delta")


# The same fixture through the whole job; clusters are numbered by size, then centre.
JOB_BY_COUNTRY = replace(BY_COUNTRY, described=CONFIG.numeric, carried=("gender",))


def final_by_country(spark, folder):
    """The labelled customers of the final model, all columns."""
    result = segment_customers(bank_customers(spark, folder), JOB_BY_COUNTRY, k=COUNTRIES)
    return profiles.clustered_customers(result.labelled, JOB_BY_COUNTRY)


def segmentation_by_country(spark, folder):
    """The whole job from CSV files: sweep, best k, saved tables, report."""
    source, target = scratch_path(spark, "customers_csv"), scratch_path(spark, "segments")
    write_csv(bank_customers(spark, folder), source)
    with run_job(spark, source, target, JOB_BY_COUNTRY):
        report = read_released(spark, target, "report_report")
    return rounded(report, *[c for c in report.columns if c.startswith("avg_")])


def scored_by_bundle(spark, folder):
    """Fitted on the customers with an even id, saved, loaded and applied to all."""
    customers = bank_customers(spark, folder)
    path = scratch_path(spark, "bundle")
    save_bundle(segment_customers(customers.filter(F.col(ID) % 2 == 0), BY_COUNTRY, k=COUNTRIES), path)
    return load_bundle(spark, path).apply(customers).select(ID, "country", "cluster", "segment_name")


def clustering_agreement(spark, folder):
    """Rand index of two declared labellings, the nearest seed and the id modulo K."""
    df = labelled(spark, folder).select("cluster", (F.col(ID) % K).cast("int").alias("by_id"))
    result = agreement.adjusted_rand(agreement.contingency(df, "cluster", "by_id"))
    return rounded(result, "rand_index", "adjusted_rand_index")


def matched_labels(spark, folder):
    """Clusters of the country fixture matched with the countries' names."""
    with clustering.fit_table(bank_customers(spark, folder), BY_COUNTRY) as fit:
        model = clustering.fit_kmeans(fit.table, COUNTRIES, BY_COUNTRY)
    table = agreement.contingency(clustering.assign(fit.features, model), "country", "cluster")
    return agreement.best_matching(table).select(F.col("a").alias("country"), "n")


def segment_grid(spark, folder):
    return rounded(profiles.segment_grid(labelled(spark, folder)), "x_from", "x_to")


# Fitted models: no SQL says what they find, tests check what must hold --------


def kmeans_fit(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), CONFIG) as fit:
        model = clustering.fit_kmeans(fit.table, K, CONFIG)
    return clustering.centres_table(fit.features, model, CONFIG.feature_cols)


def kmeans_sweep(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), CONFIG) as fit:
        return clustering.sweep(fit, CONFIG).scores.orderBy("k")


def final_model(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), CONFIG) as fit:
        model = clustering.fit_kmeans(fit.table, K, CONFIG)
    return profiles.clustered_customers(clustering.assign(fit.features, model))


def bisecting_kmeans(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), CONFIG) as fit:
        model = clustering.fit_bisecting(fit.table, fit.model, K, CONFIG)
    df = clustering.assign_bisecting(fit.features, fit.model, model)
    return evaluation.cluster_sizes(df)


def compare_algorithms(spark, folder):
    with clustering.fit_table(bank_customers(spark, folder), CONFIG) as fit:
        model = clustering.fit_kmeans(fit.table, K, CONFIG)
        labelled = clustering.assign(fit.table, model)
        score = evaluation.silhouette(labelled, "cluster")
        return clustering.compare_algorithms(fit, score, K, CONFIG)


def segmentation_job(spark, folder):
    """The whole job: from CSV files to the four saved tables and the report."""
    source, target = scratch_path(spark, "customers_csv"), scratch_path(spark, "segments")
    write_csv(bank_customers(spark, folder), source)
    with run_job(spark, source, target, CONFIG):
        return read_released(spark, target, "report_report")


QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "scan_csv_inferred": scan_csv_inferred,
    "row_count": row_count,
    "schema_report": schema_report,
    "head_records": head_records,
    "describe_numeric": describe_numeric,
    "describe_strings": describe_strings,
    "non_null_counts": non_null_counts,
    "missing_values": missing_values,
    "missing_columns": missing_columns,
    "index_country": index_country,
    "index_gender": index_gender,
    "feature_projection": feature_columns,
    "assemble_features": assemble_features,
    "standardize_features": standardize_features,
    "feature_pipeline": feature_pipeline,
    "assign_clusters": assign_clusters,
    "kmeans_lloyd_step": kmeans_lloyd_step,
    "silhouette_score": silhouette_score,
    "cluster_sizes": cluster_sizes,
    "sizes_by_k": sizes_by_k,
    "best_k": best_k,
    "silhouette_series": silhouette_series,
    "silhouette_band": silhouette_band,
    "compare_rule": compare_rule,
    "cluster_profiles": cluster_profiles,
    "profile_lookup": profile_lookup,
    "segment_share": segment_share,
    "profile_medians": profile_medians,
    "segment_names": segment_names,
    "segment_report": segment_report,
    "churn_by_cluster": churn_by_cluster,
    "churn_percent": churn_percent,
    "clustered_customers": clustered_customers,
    "segment_projection": segment_projection,
    "sink_evaluation": sink_evaluation,
    "sink_profiles": sink_profiles,
    "sink_churn": sink_churn,
    "sink_clustered": sink_clustered,
    "sink_clustered_csv": sink_clustered_csv,
    "sink_by_segment": sink_by_segment,
    "rejected_counts": rejected_counts,
    "accepted_lines": accepted_lines,
    "standardize_dirty": standardize_dirty,
    "left_out": left_out,
    "kmeans_by_country": kmeans_by_country,
    "bisecting_by_country": bisecting_by_country,
    "sweep_by_country": sweep_by_country,
    "compare_by_country": compare_by_country,
    "final_by_country": final_by_country,
    "segmentation_by_country": segmentation_by_country,
    "scored_by_bundle": scored_by_bundle,
    "clustering_agreement": clustering_agreement,
    "matched_labels": matched_labels,
    "segment_grid": segment_grid,
    "kmeans_fit": kmeans_fit,
    "kmeans_sweep": kmeans_sweep,
    "final_model": final_model,
    "bisecting_kmeans": bisecting_kmeans,
    "compare_algorithms": compare_algorithms,
    "segmentation_job": segmentation_job,
}
