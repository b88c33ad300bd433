"""Spark ML pipelines for the regressors.

Each function gets the feature lists and returns unfitted stages that turn a feature table with a
``label`` column into ``y_hat``. Any function of that form can be handed to a forecaster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression

from tilecast.plans.block_forest import Forest
from tilecast.plans.boosting import BoostedTrees

LABEL = "label"
PREDICTION = "y_hat"
SEED = 1
_COLUMNS = {"labelCol": LABEL, "predictionCol": PREDICTION}


def _cast_stage(columns: dict[str, str]) -> SQLTransformer:
    """Add columns given as SQL."""
    new = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return SQLTransformer(statement=f"SELECT *, {new} FROM __THIS__")


def _zero_filled(numerical: Sequence[str]) -> dict[str, str]:
    return {f"num_{c}": f"coalesce(CAST(`{c}` AS DOUBLE), 0D)" for c in numerical}


def _mean_imputed(categorical: Sequence[str], numerical: Sequence[str]) -> list:
    """Categorical columns get their mean where missing, numerical ones 0."""
    casts = {f"cat_{c}": f"CAST(`{c}` AS DOUBLE)" for c in categorical}
    names = list(casts)
    stages = [_cast_stage(casts | _zero_filled(numerical))]
    if names:
        stages.append(Imputer(inputCols=names, outputCols=names, strategy="mean"))
    return stages


def _indexed(categorical: Sequence[str], numerical: Sequence[str]) -> list:
    """Categorical columns of any type as level numbers; a missing or unseen level has one of its own.

    Numbers are spelled as doubles, since a level looked up as a mean comes back as one.
    """
    casts = {
        f"txt_{c}": f"CASE WHEN typeof(`{c}`) = 'string' THEN CAST(`{c}` AS STRING) "
        f"ELSE CAST(CAST(`{c}` AS DOUBLE) AS STRING) END"
        for c in categorical
    }
    indexer = StringIndexer(
        inputCols=list(casts),
        outputCols=[f"cat_{c}" for c in categorical],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    return [_cast_stage(casts | _zero_filled(numerical)), *([indexer] if casts else [])]


def _assembled(categorical: Sequence[str], numerical: Sequence[str]) -> list:
    inputs = [f"cat_{c}" for c in categorical] + [f"num_{c}" for c in numerical]
    return [
        *_mean_imputed(categorical, numerical),
        VectorAssembler(inputCols=inputs, outputCol="features"),
    ]


def boosted_trees(
    categorical: Sequence[str],
    numerical: Sequence[str],
    n_trees: int = 100,
    depth: int = 3,
    rate: float = 0.1,
    seed: int = SEED,
) -> list:
    """Gradient-boosted trees on plain numbers."""
    trees = BoostedTrees(n_trees, depth, rate, seed, LABEL, PREDICTION)
    return [*_assembled(categorical, numerical), trees]


def boosted_trees_categorical(
    categorical: Sequence[str],
    numerical: Sequence[str],
    n_trees: int = 100,
    depth: int = 3,
    rate: float = 0.1,
    max_levels: int = 32,
    seed: int = SEED,
) -> list:
    """Gradient-boosted trees that split categorical columns, numbers or text, by sets of levels.

    A column with more than ``max_levels`` levels makes the fit fail; it is never taken for a number.
    ``max_levels`` also bounds the bins of numerical columns, so raise it no further than needed.
    """
    trees = BoostedTrees(n_trees, depth, rate, seed, LABEL, PREDICTION, max_levels + 1)
    inputs = [f"cat_{c}" for c in categorical] + [f"num_{c}" for c in numerical]
    return [
        *_indexed(categorical, numerical),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        trees,
    ]


def forest(
    categorical: Sequence[str],
    numerical: Sequence[str],
    n_trees: int = 100,
    depth: int = 10,
    seed: int = SEED,
) -> list:
    """Averaged randomized trees of ``depth`` levels at most; Spark ML allows 30."""
    trees = Forest(n_trees, depth, seed, LABEL, PREDICTION)
    return [*_assembled(categorical, numerical), trees]


def _one_hot(categorical: Sequence[str], numerical: Sequence[str]) -> list:
    """One column per level; a level unseen in training, or missing, gets a column of its own."""
    return [
        *_indexed(categorical, numerical),
        OneHotEncoder(
            inputCols=[f"cat_{c}" for c in categorical],
            outputCols=[f"hot_{c}" for c in categorical],
            dropLast=False,
            handleInvalid="keep",
        ),
        VectorAssembler(
            inputCols=[f"hot_{c}" for c in categorical] + [f"num_{c}" for c in numerical],
            outputCol="features",
        ),
    ]


def stump(categorical: Sequence[str], numerical: Sequence[str], seed: int = SEED) -> list:
    """One tree with one split: the mean of the target on either side."""
    return boosted_trees(categorical, numerical, n_trees=1, depth=1, seed=seed)


def least_squares(categorical: Sequence[str], numerical: Sequence[str]) -> list:
    """A plain line on plain numbers, without penalty."""
    line = LinearRegression(regParam=0.0, **_COLUMNS)
    return [*_assembled(categorical, numerical), line]


def least_squares_one_hot(categorical: Sequence[str], numerical: Sequence[str]) -> list:
    """Least squares on one-hot columns, without penalty: with one category, its levels' means.

    There is no intercept, since the columns of a category add up to one.
    """
    line = LinearRegression(regParam=0.0, fitIntercept=False, **_COLUMNS)
    return [*_one_hot(categorical, numerical), line]


def categorical_stump(categorical: Sequence[str], numerical: Sequence[str], seed: int = SEED) -> list:
    """One tree with one split, of a category's levels into two sets or of a number at a value."""
    return boosted_trees_categorical(categorical, numerical, n_trees=1, depth=1, seed=seed)


def one_hot_stump(categorical: Sequence[str], numerical: Sequence[str], seed: int = SEED) -> list:
    """One tree with one split of one-hot columns: one level against all others."""
    return boosted_trees_one_hot(categorical, numerical, n_trees=1, depth=1, seed=seed)


def elastic_net(
    categorical: Sequence[str],
    numerical: Sequence[str],
    penalty: float = 1.0,
    l1_share: float = 0.5,
) -> list:
    """Elastic net on one-hot columns."""
    line = LinearRegression(
        regParam=penalty, elasticNetParam=l1_share, standardization=False, **_COLUMNS
    )
    return [*_one_hot(categorical, numerical), line]


def boosted_trees_one_hot(
    categorical: Sequence[str],
    numerical: Sequence[str],
    n_trees: int = 100,
    depth: int = 3,
    rate: float = 0.1,
    seed: int = SEED,
) -> list:
    """Gradient-boosted trees on one-hot columns."""
    trees = BoostedTrees(n_trees, depth, rate, seed, LABEL, PREDICTION)
    return [*_one_hot(categorical, numerical), trees]
