"""Clusters of places and of demand patterns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.functions.geo import haversine_km
from tilecast.operators.block_mixtures import BlockMixture, BlockMixtureModel, fit_side_by_side
from tilecast.operators.statistics import place_points

PATTERN = ["lat", "long", "dow", "hour", "median_demand_per_gdowh", "mean_demand_per_gdowh"]
SEED = 1
GAIN_PER_POINT = 1e-3
_VECTOR, _WHOLE = "_vector", "_whole"


def with_vector(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the columns as one vector, and whether none of them is missing (missing ones count as 0)."""
    values = [F.col(c).cast("double") for c in columns]
    present = [v.isNotNull() & ~F.isnan(v) for v in values]
    df = df.select(
        "*",
        reduce(lambda a, b: a & b, present).alias(_WHOLE),
        *[F.nanvl(F.coalesce(v, F.lit(0.0)), F.lit(0.0)).alias(f"_v_{c}") for c, v in zip(columns, values, strict=True)],
    )
    assembler = VectorAssembler(inputCols=[f"_v_{c}" for c in columns], outputCol=_VECTOR)
    return assembler.transform(df).drop(*[f"_v_{c}" for c in columns])


def _order_of(centres: Sequence[Sequence[float]]) -> list[int]:
    """The rank of each centre among all, smallest first, so that ids do not depend on the seed."""
    ranked = sorted(range(len(centres)), key=lambda i: list(centres[i]))
    return [ranked.index(i) for i in range(len(centres))]


def _centres(model: Model) -> list[list[float]]:
    if hasattr(model, "clusterCenters"):
        return [list(map(float, c)) for c in model.clusterCenters()]
    return [list(map(float, g.mean.toArray())) for g in model.gaussians]


def _vectors(points: DataFrame, columns: Sequence[str], partitions: int | None) -> DataFrame:
    """The vectors of the rows that lack nothing, in ``partitions`` tasks if that is given.

    A fit makes many short passes; on a table known to be small, few tasks are faster.
    """
    vectors = with_vector(points, columns).filter(_WHOLE).select(_VECTOR)
    return vectors if partitions is None else vectors.coalesce(partitions)


def fit_cluster(
    estimator, points: DataFrame, columns: Sequence[str], partitions: int | None = None
) -> Model:
    """Fit a clustering estimator on the chosen columns of ``points``; rows that lack one are left out."""
    return estimator.setFeaturesCol(_VECTOR).fit(_vectors(points, columns, partitions))


def label_rows(
    model: Model, df: DataFrame, columns: Sequence[str], id_col: str, prob_col: str | None = None
) -> DataFrame:
    """Add each row's cluster id and, if wanted, its largest membership probability.

    Rows are scored where they lie. A label depends on ``columns`` alone, so this gives what joining
    labelled groups back would, without the shuffle. A row that lacks one of them has a NULL label.
    """
    rank = F.array(*[F.lit(i) for i in _order_of(_centres(model))])
    scored = model.transform(with_vector(df, columns))
    new = {id_col: F.when(F.col(_WHOLE), F.get(rank, F.col(model.getPredictionCol())))}
    extra = [_VECTOR, _WHOLE, model.getPredictionCol()]
    if prob_col:
        p = F.col(model.getProbabilityCol())
        largest = F.array_max(p if isinstance(model, BlockMixtureModel) else vector_to_array(p))
        new[prob_col] = F.when(F.col(_WHOLE), largest)
    if hasattr(model, "getProbabilityCol"):
        extra.append(model.getProbabilityCol())
    return scored.withColumns(new).drop(*extra)


def add_cluster(
    estimator,
    points: DataFrame,
    df: DataFrame,
    columns: Sequence[str],
    id_col: str,
    prob_col: str | None = None,
) -> DataFrame:
    """Fit on ``points`` (usually one row per group) and label the rows of ``df``."""
    model = fit_cluster(estimator, points, columns)
    return label_rows(model, df, columns, id_col, prob_col)


def fit_geo_centres(df: DataFrame, k: int = 2, seed: int = SEED) -> list[list[float]]:
    """Centres of k-means over the distinct places of ``df``, in (lat, long) order.

    Busy places weigh no more than quiet ones.
    """
    kmeans = KMeans(k=k, seed=seed, maxIter=300, tol=1e-5)
    return sorted(_centres(fit_cluster(kmeans, place_points(df), ["lat", "long"])))


def add_geo_cluster(df: DataFrame, centres: Sequence[Sequence[float]]) -> DataFrame:
    """``cluster_geo``, its centre, and ``dist_to_center_km``.

    The centres are a few constants, so the nearest one is plain column arithmetic on each row.
    """

    def off(centre: Sequence[float]) -> Column:
        d_lat, d_long = F.col("lat") - centre[0], F.col("long") - centre[1]
        return d_lat * d_lat + d_long * d_long

    nearest = F.array_min(
        F.array(
            *[
                F.struct(off(c).alias("off"), F.lit(i).alias("id"))
                for i, c in enumerate(centres)
            ]
        )
    )
    nearest = F.when(F.col("lat").isNotNull() & F.col("long").isNotNull(), nearest)
    mid = [F.array(*[F.lit(float(c[axis])) for c in centres]) for axis in (0, 1)]
    df = df.withColumn("cluster_geo", nearest["id"])
    df = df.withColumns(
        {
            "cluster_geo_mid_lat": F.get(mid[0], F.col("cluster_geo")),
            "cluster_geo_mid_long": F.get(mid[1], F.col("cluster_geo")),
        }
    )
    distance = haversine_km(
        F.col("lat"), F.col("long"), F.col("cluster_geo_mid_lat"), F.col("cluster_geo_mid_long")
    )
    return df.withColumn("dist_to_center_km", distance)


def mixture(k: int, n_points: int, seed: int = SEED, max_iter: int = 100) -> BlockMixture:
    """A Gaussian mixture that stops once an iteration gains under 0.001 per point.

    The gain over all points is compared with the tolerance, as in Spark ML, hence the factor.
    """
    return BlockMixture(k, seed, max_iter, GAIN_PER_POINT * max(n_points, 1))


def fit_pattern_mixture(
    patterns: DataFrame,
    k: int = 8,
    seed: int = SEED,
    max_iter: int = 100,
    partitions: int | None = None,
) -> Model:
    """Mixture over demand patterns: one row per place, day of week and hour."""
    estimator = mixture(k, patterns.count(), seed, max_iter)
    return fit_cluster(estimator, patterns, PATTERN, partitions)


def _one_gaussian_log_likelihood(points: DataFrame, columns: Sequence[str]) -> tuple[float, int]:
    """Log-likelihood of a single Gaussian at its maximum, from the covariances alone."""
    d = len(columns)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = points.agg(
        F.count("*").alias("n"),
        *[
            F.covar_pop(F.col(columns[i]).cast("double"), F.col(columns[j]).cast("double")).alias(
                f"c_{i}_{j}"
            )
            for i, j in pairs
        ],
    ).first()
    covariance = np.zeros((d, d))
    for i, j in pairs:
        covariance[i, j] = covariance[j, i] = row[f"c_{i}_{j}"]
    # Directions without variance are left out, as the mixture estimator does.
    spectrum = np.linalg.eigvalsh(covariance)
    spectrum = spectrum[spectrum > spectrum.max() * d * np.finfo(float).eps]
    log_det = float(np.sum(np.log(spectrum)))
    n = row["n"]
    return -n / 2 * (d * math.log(2 * math.pi) + log_det + len(spectrum)), n


def mixture_scores(
    points: DataFrame,
    columns: Sequence[str],
    max_component: int = 10,
    seed: int = SEED,
    max_iter: int = 100,
    partitions: int | None = None,
) -> DataFrame:
    """AIC and BIC of mixtures with 1 to ``max_component - 1`` components: k, aic, bic.

    All are fitted side by side. ``points`` is read a few times per k for the start, and once for all
    iterations; hand in a cached or written table.
    """
    d = len(columns)
    first, n = _one_gaussian_log_likelihood(points.dropna(subset=list(columns)), columns)
    estimators = [mixture(k, n, seed, max_iter).setFeaturesCol(_VECTOR) for k in range(2, max_component)]
    models = fit_side_by_side(estimators, _vectors(points, columns, partitions)) if estimators else []
    scores = []
    for k, log_likelihood in enumerate([first, *[m.log_likelihood for m in models]][: max_component - 1], 1):
        free = (k - 1) + k * d + k * d * (d + 1) // 2
        scores.append(
            (k, 2.0 * free - 2 * log_likelihood, free * math.log(n) - 2 * log_likelihood)
        )
    return points.sparkSession.createDataFrame(scores, "k int, aic double, bic double")
