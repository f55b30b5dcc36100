"""The whole job: from a customer table to named, profiled segments."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.config import SegmentationConfig
from tessella.operators import evaluation, inspection, profiles, quality
from tessella.operators.agreement import canonical_numbers, renumbered
from tessella.operators.clustering import (
    assign,
    compare_algorithms,
    customer_aggregates,
    kept_kmeans,
    fit_table,
    sweep,
)
from tessella.operators.layout import gathered
from tessella.operators.journal import NO_JOURNAL, Journal, NoJournal, fingerprint
from tessella.session import Scratch
from tessella.sinks.releases import release
from tessella.sinks.tables import write_by_label, write_csv, write_parquet
from tessella.sources.customers import CUSTOMER_SCHEMA, LINE, read_customers_checked


@dataclass(frozen=True)
class Segmentation:
    """Fitted models and, as DataFrames, everything derived from them.

    ``labelled`` is row-wise on the materialised input. Tables of a row per
    cluster or k were computed once and are held as they are. Clusters have canonical
    numbers, the largest first; ``numbers`` has them by the model's own.
    """

    config: SegmentationConfig
    features_model: PipelineModel
    model: KMeansModel
    numbers: list[int]
    customers_schema: StructType
    best_k: int
    schema: DataFrame
    head: DataFrame
    statistics: DataFrame
    strings: DataFrame
    missing: DataFrame
    left_out: DataFrame
    scores: DataFrame
    sizes: DataFrame
    comparison: DataFrame
    labelled: DataFrame
    profiles: DataFrame
    names: DataFrame
    report: DataFrame
    churn: DataFrame
    scratch: Scratch

    def close(self) -> None:
        """Remove the intermediate tables; ``labelled`` and ``head`` read them."""
        self.scratch.close()

    def __enter__(self) -> Segmentation:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def tables(self, labelled_as: str = "parquet") -> dict[str, tuple[DataFrame, Callable, str]]:
        """The four result tables by their published names: rows, how they are written, format.

        ``labelled_as`` is "parquet", "csv", or "segments" for Parquet by cluster.
        """
        one_file = partial(write_csv, files=1)
        labelled = profiles.clustered_customers(self.labelled, self.config)
        sizes = {r["cluster"]: r["size"] for r in self.profiles.select("cluster", "size").collect()}
        by_cluster = lambda df, path: write_by_label(df, path, "cluster", sizes)
        how = {"csv": (write_csv, "csv"), "parquet": (write_parquet, "parquet"), "segments": (by_cluster, "parquet")}
        return {
            "kmeans_evaluation": (self.scores, one_file, "csv"),
            "cluster_profiles": (self.profiles, one_file, "csv"),
            "churn_by_cluster": (self.churn, one_file, "csv"),
            "clustered_customers": (labelled, *how[labelled_as]),
        }

    def save(self, folder: str, labelled_as: str = "parquet") -> None:
        """Write the four result tables below ``folder``, one after the other.

        The labelled table is as long as the input, so it is written as
        Parquet unless CSV is asked for.
        """
        for name, (df, write, _) in self.tables(labelled_as).items():
            write(df, f"{folder}/{name}")


def segment_customers(
    df: DataFrame,
    config: SegmentationConfig | None = None,
    k: int | None = None,
    sweep_too: bool = False,
    journal: Journal | NoJournal = NO_JOURNAL,
    summary: DataFrame | None = None,
    scratch: Scratch | None = None,
) -> Segmentation:
    """Segment the customers of ``df`` into the best k of a sweep.

    A given ``k`` is fitted without a sweep, and scored alone, unless ``sweep_too``. The
    final model is the sweep's own for its k: same rows, layout and seed give the same
    fit, so it is not fitted again. ``journal`` keeps finished steps; ``summary`` says that
    ``df`` is written and counted already (``fit_table``). The result owns its intermediate
    tables, in ``scratch`` or one of its own.
    """
    config = config or SegmentationConfig()
    scratch = scratch or Scratch(df.sparkSession)
    try:
        with scratch.owning():
            return _segment(df, config, k, sweep_too, journal, summary, scratch)
    except BaseException:
        scratch.close()
        raise


def _segment(df, config, k, sweep_too, journal, summary, scratch) -> Segmentation:
    only = k is not None and not sweep_too
    swept_config = replace(config, min_k=k, max_k=k) if only else config
    with fit_table(df, config, journal, summary) as fit:
        swept = sweep(fit, swept_config)
        chosen = k or evaluation.best_k(swept.scores).first()["k"]
        if chosen in swept.models:
            model, score, sizes = swept.models[chosen], swept.score_of[chosen], swept.size_of[chosen]
        else:
            model = kept_kmeans(fit, chosen, config)
            scored, sized = evaluation.silhouettes(assign(fit.table, model), {chosen: "cluster"})
            score, sizes = scored[chosen], sized[chosen]
        comparison = compare_algorithms(fit, score, chosen, config)
    numbers = canonical_numbers([c.tolist() for c in model.clusterCenters()], sizes)
    labelled = renumbered(assign(fit.features, model), numbers)
    summary = gathered(profiles.cluster_summary(labelled, config))
    profile = summary.drop("churn_rate")
    # The write of the customers has counted all this; only the head is read.
    told, kinds = fit.summary, fit.customers.schema
    counts = told.select("_rows", *[F.col(f"{c}.count").alias(c) for c in kinds.names])
    return Segmentation(
        config=config,
        features_model=fit.model,
        model=model,
        numbers=numbers,
        customers_schema=kinds,
        best_k=chosen,
        schema=inspection.schema_table(told, kinds),
        head=inspection.head_records(fit.customers, config.id_col),
        statistics=inspection.numeric_table(told, kinds),
        strings=inspection.string_table(told, kinds),
        missing=quality.missing_table(counts, kinds.names).filter("missing > 0"),
        left_out=quality.left_out_table(told),
        scores=swept.scores,
        sizes=swept.sizes,
        comparison=comparison,
        labelled=labelled,
        profiles=profile,
        names=profiles.segment_names(profile),
        report=profiles.segment_report(profile),
        churn=profiles.churn_of(summary),
        scratch=scratch,
    )


# What the job tells about its input and result, beside the tables it saves.
REPORTED = ("schema", "head", "statistics", "strings", "missing", "left_out", "sizes", "comparison", "names", "report")


def run_job(
    spark: SparkSession,
    source: str,
    target: str,
    config: SegmentationConfig | None = None,
    k: int | None = None,
    labelled_as: str = "csv",
    schema: StructType = CUSTOMER_SCHEMA,
    resume: bool = False,
) -> Segmentation:
    """From customer CSV files to one release below ``target``: the four result tables, one
    small table for each step that informs about the data (``report_*``), the malformed
    lines and how many there are of each reason. ``read_released`` reads them.

    With ``resume`` finished steps are kept below ``target``/journal until the release is
    there, and a run of the same config over the same files takes them up.
    """
    config = config or SegmentationConfig()
    journal = Journal(spark, f"{target}/journal", fingerprint(spark, config, source)) if resume else NO_JOURNAL
    scratch, counted = Scratch(spark), []

    def store(rows: DataFrame) -> DataFrame:
        table, summary = journal.observed("checked", rows, customer_aggregates(rows, config, F.col(LINE).isNull()))
        counted.append(summary)
        return table

    with scratch.owning():
        files = read_customers_checked(spark, source, schema, store=store)
    result = segment_customers(files.customers, config, k, journal=journal, summary=counted[0], scratch=scratch)
    parquet = lambda df: (df, write_parquet, "parquet")
    report = {f"report_{name}": parquet(getattr(result, name)) for name in REPORTED}
    rejected = {"rejected_lines": parquet(files.rejected), "rejected_counts": parquet(files.counts())}
    release(spark, target, result.tables(labelled_as) | report | rejected)
    journal.clear()
    return result
