"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of each whole text are standardised and mapped to random Fourier features,
whose inner products approximate a Gaussian kernel. The normal equations of the ridge
fit are sums over rows: each task sums its own, Spark adds them up, and the driver
solves one small system. Scores of rows the fit has not seen are then binned, and
isotonic regression on the bins turns a raw score into a share of good texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import written

SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
PUNCTUATION = b"!\"'(),-.:;?"
N_STATISTICS = 14


@dataclass(frozen=True)
class QualitySettings:
    features: int = 192  # random features
    bandwidth: float = 3.0  # of the Gaussian kernel, on standardised statistics
    ridge: float = 1e-3  # times the number of rows
    bins: int = 500  # of raw scores per unit, for the calibration
    seed: int = 17
    threshold: float = 0.3  # a text with a lower score is rejected


SETTINGS = QualitySettings()


def statistics(text: str) -> list[float]:
    """What is measured on a whole text; all zero for an empty one."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * N_STATISTICS
    n, size = len(words), len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = lambda codes: float(seen[np.frombuffer(codes, np.uint8)].sum()) / size
    different = len(set(words))
    lines = raw.split(b"\n")
    return [
        np.log1p(size),
        np.log1p(n),
        size / n,
        np.log1p(1000 * share(SYMBOLS)),
        np.log1p(1000 * share(b"|")),
        np.log1p(1000 * share(PUNCTUATION)),
        np.log1p(1000 * share(b"0123456789")),
        np.log1p(1000 * float(seen[65:91].sum()) / size),
        float(seen[128:].sum()) / size,
        different / n,
        np.log1p(n / different),
        np.log1p(1000 * float(seen[46]) / size),
        np.log1p(1000 * float(seen[10]) / size),
        len(set(lines)) / len(lines),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text; a null text counts as empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [statistics(x) for x in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "stats": found})

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, stats array<double>")


def fold(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    std: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray  # of the random features, then the constant
    bounds: np.ndarray  # calibration: raw score ...
    shares: np.ndarray  # ... to share of good texts

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.std, -6, 6)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(scaled @ self.frequency + self.phase)
        return np.c_[waves, np.ones(len(stats))]

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.bounds, self.shares)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, N_STATISTICS))


def normal_equations(rows: DataFrame, model: QualityModel) -> np.ndarray:
    """Sum over the rows of (z, 1, y)ᵀ(z, 1, y): one matrix per task, added up by Spark."""
    width = len(model.phase) + 2

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in frames:
            both = np.c_[model.features(matrix(frame["stats"])), frame["target"].to_numpy()]
            total += both.T @ both
        yield pd.DataFrame({"i": range(width), "sums": list(total)})

    parts = rows.select("stats", "target").mapInPandas(run, "i int, sums array<double>")
    summed = parts.groupBy("i").agg(Summarizer.sum(array_to_vector("sums")).alias("v"))
    out = np.zeros((width, width))
    for row in summed.select("i", vector_to_array("v").alias("v")).collect():  # width rows
        out[row["i"]] = row["v"]
    return out


def raw_scores(rows: DataFrame, model: QualityModel, *keep: str) -> DataFrame:
    kept = [f for f in rows.schema if f.name in keep]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[[f.name for f in kept]].assign(raw=model.raw(matrix(frame["stats"])))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.select("stats", *keep).mapInPandas(run, f"{schema}, raw double")


def fit(stats: DataFrame, labels: DataFrame, settings: QualitySettings = SETTINGS) -> QualityModel | None:
    """The model, learned from labelled rows whose fold is not 0; None without any.

    Folds 2 to 4 fit the regression, fold 1 the calibration. A document labelled
    several times counts with the mean of its labels; null labels don't count.
    """
    named = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    target = named.groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("target"))
    learn = written(
        stats.join(target, "doc_id").where(fold() != 0).select("stats", "target", fold().alias("fold")), "learn"
    )
    columns = [F.col("stats")[i] for i in range(N_STATISTICS)]
    total = learn.agg(
        F.count("*").alias("n"), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]
    ).first()
    if not total["n"]:
        return None
    mean, std = np.array(total[1 : N_STATISTICS + 1]), np.array(total[N_STATISTICS + 1 :])
    random = np.random.default_rng(settings.seed)
    model = QualityModel(
        mean=mean,
        std=np.where(std > 1e-9, std, 1.0),
        frequency=random.normal(size=(N_STATISTICS, settings.features)) / settings.bandwidth,
        phase=random.uniform(0, 2 * np.pi, settings.features),
        weight=np.zeros(settings.features + 1),
        bounds=np.array([0.0]),
        shares=np.array([0.0]),
    )
    sums = normal_equations(learn.where("fold != 1"), model)
    n = max(sums[-2, -2], 1.0)
    penalty = settings.ridge * n * np.eye(settings.features + 1)
    penalty[-1, -1] = 1e-9
    weight = np.linalg.solve(sums[:-1, :-1] + penalty, sums[:-1, -1])
    model = QualityModel(**{**model.__dict__, "weight": weight})
    # A bounded table: at most two units of raw score, ``bins`` to a unit.
    place = F.floor(F.least(F.greatest("raw", F.lit(-0.5)), F.lit(1.5)) * settings.bins)
    bins = (
        raw_scores(learn.where("fold = 1"), model, "target")
        .groupBy((place / settings.bins).cast("double").alias("features"))
        .agg(F.avg("target").alias("label"), F.count("*").cast("double").alias("weight"))
    )
    if bins.isEmpty():
        bounds, shares = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        rising = IsotonicRegression(featuresCol="features", weightCol="weight").fit(bins)
        bounds, shares = rising.boundaries.toArray(), rising.predictions.toArray()
    return QualityModel(**{**model.__dict__, "bounds": bounds, "shares": np.clip(shares, 0, 1)})


def accepted(docs: DataFrame, labels: DataFrame, settings: QualitySettings = SETTINGS) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold.

    The score is computed beside each row: nothing is joined or shuffled for it, and
    rows that repeat an id or have none are judged by their own text.
    """
    model = fit(written(measured(docs), "statistics"), labels, settings)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            stats = np.array([statistics(x) for x in batch]).reshape(-1, N_STATISTICS)
            yield pd.Series(model.score(stats) if model else np.full(len(batch), 0.5))

    return docs.where(score(F.coalesce("text", F.lit(""))) >= settings.threshold)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: QualitySettings = SETTINGS) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text.

    One row per input row; an empty or null text is scored by its (zero) statistics.
    Without any labelled row to learn from, every score is 0.5. ``held_out`` is true
    where fold is 0, false for a null id. Only doc_id and text of ``docs``, doc_id and
    quality of ``labels`` are read. The text is read once: the statistics are written.
    """
    stats = written(measured(docs), "statistics")
    model = fit(stats, labels, settings)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            score = model.score(matrix(frame["stats"])) if model else np.full(len(frame), 0.5)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": score})

    scored = stats.mapInPandas(run, "doc_id long, score double")
    held_out = F.coalesce(fold() == 0, F.lit(False))
    predicted = (F.col("score") >= settings.threshold).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))
