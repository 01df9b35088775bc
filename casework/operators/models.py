"""Classifiers, search and validation on MLlib. Frames carry ``features`` (vector) and ``label``."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casework.operators.features import fold
from casework.session import materialise

# Search grids.
FOREST_GRID = {"numTrees": [25, 50, 100], "maxDepth": [3, 5, 7]}
TREE_GRID = {"impurity": ["gini", "entropy"], "maxDepth": [10, 20], "minInstancesPerNode": [2, 5, 9], "minInfoGain": [0.001, 0.004]}
METRICS = {"accuracy": "accuracy", "precision": "precisionByLabel", "recall": "recallByLabel"}


def assemble(df: DataFrame, columns: Sequence[str], label: Column, keep: Sequence[str] = ()) -> DataFrame:
    """``features`` and ``label`` (double), rows with nulls skipped."""
    slim = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns], label.cast("double").alias("label"))
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(slim).select(*keep, "features", "label")


def fit_logistic(
    df: DataFrame, penalty: str | None = "l2", C: float = 1.0, l1_ratio: float = 0.5, weight: str | None = None, max_iter: int = 100
) -> LogisticRegressionModel:
    """Penalty ``None``, ``l1``, ``l2`` or ``elasticnet``. ``regParam`` is 1 / (C · n); inputs are used unscaled."""
    mix = {None: 0.0, "l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio}[penalty]
    reg = 0.0 if penalty is None else 1.0 / (C * max(1, df.count()))
    lr = LogisticRegression(regParam=reg, elasticNetParam=mix, maxIter=max_iter, standardization=False)
    return (lr.setWeightCol(weight) if weight else lr).fit(df)


def logit_summary(df: DataFrame, names: Sequence[str], max_iter: int = 25) -> DataFrame:
    """Coefficient, standard error, z and p per term (intercept last), as a maximum-likelihood logit."""
    model = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=max_iter).fit(df)
    s = model.summary
    coefficients = [*model.coefficients.toArray().tolist(), model.intercept]
    rows = list(zip([*names, "intercept"], coefficients, s.coefficientStandardErrors, s.tValues, s.pValues))
    return df.sparkSession.createDataFrame(
        [(n, float(c), float(e), float(z), float(p)) for n, c, e, z, p in rows], "term string, coefficient double, std_error double, z double, p double"
    )


def fit_tree(df: DataFrame, seed: int = 42, **params) -> Model:
    return DecisionTreeClassifier(seed=seed, **params).fit(df)


def fit_forest(df: DataFrame, seed: int = 42, weight: str | None = None, **params) -> Model:
    rf = RandomForestClassifier(seed=seed, **({"numTrees": 50, "maxDepth": 7} | params))
    return (rf.setWeightCol(weight) if weight else rf).fit(df)


def importances(model: Model, names: Sequence[str], spark) -> DataFrame:
    """Feature importances of a tree model."""
    values = model.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")


def fit_mlp(df: DataFrame, hidden: Sequence[int] = (8,), classes: int = 2, max_iter: int = 100, step: float = 0.1, seed: int = 1) -> Model:
    """Sigmoid network with one to three hidden layers, trained by gradient descent (``step`` is its rate)."""
    size = len(df.select("features").first().features)
    return MultilayerPerceptronClassifier(layers=[size, *hidden, classes], maxIter=max_iter, stepSize=step, solver="gd", seed=seed).fit(df)


def fit_gbt(df: DataFrame, rounds: int = 100, rate: float = 0.1, depth: int = 6, seed: int = 42) -> Model:
    """Boosted trees."""
    return GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed).fit(df)


def positive_score(df: DataFrame, probability: str = "probability") -> Column:
    return vector_to_array(probability)[1]


def fit_stack(df: DataFrame, bases: Mapping[str, Estimator], key: str, folds: int = 5, seed: int = 42):
    """Stacking: out-of-fold base scores train a logistic meta-model; bases are refitted on all rows.

    Folds come from a hash of ``key``, worked out once: the trainers read the rows many times. Returns a function
    that scores a frame.
    """
    folded = materialise(df.select("features", "label", fold(key, folds, seed).alias("__fold")), "stack-folds")
    parts = []
    for i in range(folds):
        train, held = folded.where(F.col("__fold") != i), folded.where(F.col("__fold") == i)
        parts.append(_base_scores({n: b.fit(train) for n, b in bases.items()}, held))
    out_of_fold = reduce(DataFrame.unionByName, parts)
    names = list(bases)
    meta = LogisticRegression(maxIter=50).fit(materialise(_meta(out_of_fold, names).select("features", "label"), "stack-scores"))
    fitted = {n: b.fit(folded) for n, b in bases.items()}

    def transform(frame: DataFrame) -> DataFrame:
        return meta.transform(_meta(_base_scores(fitted, frame), names))

    transform.meta = meta
    return transform


def _base_scores(models: Mapping[str, Model], df: DataFrame) -> DataFrame:
    for name, model in models.items():
        df = model.transform(df).withColumn(f"__{name}", positive_score(df)).drop("rawPrediction", "probability", "prediction")
    return df


def _meta(df: DataFrame, names: Sequence[str]) -> DataFrame:
    packed = VectorAssembler(inputCols=[f"__{n}" for n in names], outputCol="__meta").transform(df)
    return packed.drop("features").withColumnRenamed("__meta", "features")


def rfe(df: DataFrame, columns: Sequence[str], label: Column, keep: int = 1, **forest) -> DataFrame:
    """Recursive feature elimination: rank 1 for the kept features, then in reverse order of removal."""
    left, ranks = list(columns), {}
    while len(left) > keep:
        model = fit_forest(assemble(df, left, label), **forest)
        weakest = left[int(np.argmin(model.featureImportances.toArray()))]
        ranks[weakest] = len(left) - keep + 1
        left.remove(weakest)
    ranks |= {c: 1 for c in left}
    return df.sparkSession.createDataFrame([(c, int(r)) for c, r in ranks.items()], "feature string, rank long")


def _evaluator(metric: str) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName=METRICS.get(metric, metric), metricLabel=1.0)


def grid_search(df: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence] | None = None, folds: int = 5, metric: str = "accuracy", parallelism: int = 4, seed: int = 42) -> CrossValidatorModel:
    """Cross-validated search over a full grid of parameter names and values.

    Trees and forests have a default grid.
    """
    if grid is None:
        grid = TREE_GRID if isinstance(estimator, DecisionTreeClassifier) else FOREST_GRID
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return _validated(df, estimator, builder.build(), folds, metric, parallelism, seed)


def random_search(df: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence], n: int = 10, folds: int = 5, metric: str = "accuracy", parallelism: int = 4, seed: int = 42) -> CrossValidatorModel:
    """The same over ``n`` settings drawn from the grid."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    return _validated(df, estimator, random.Random(seed).sample(maps, min(n, len(maps))), folds, metric, parallelism, seed)


def _validated(df, estimator, maps, folds, metric, parallelism, seed) -> CrossValidatorModel:
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=_evaluator(metric), numFolds=folds, parallelism=parallelism, seed=seed)
    return cv.fit(df)


def search_table(model: CrossValidatorModel, spark) -> DataFrame:
    """Setting, mean and standard deviation of the metric, best marked."""
    best = int(np.argmax(model.avgMetrics))
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(a), float(s), i == best)
        for i, (m, a, s) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics))
    ]
    return spark.createDataFrame(rows, "setting string, mean double, std double, best boolean")


def fold_rates(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Mean and population deviation over folds: ``(metric, mean, std)`` of rows ``label, fold, prediction``; 0 where undefined."""
    says, yes = F.col(prediction) == 1, F.col("label") == 1
    ratio = lambda a, b: F.coalesce(F.try_divide(F.count_if(a), F.count_if(b)), F.lit(0.0))
    per = scored.groupBy("fold").agg(
        F.avg((says == yes).cast("double")).alias("accuracy"), ratio(says & yes, says).alias("precision"), ratio(says & yes, yes).alias("recall")
    )
    long = per.select(F.expr("stack(3, 'accuracy', accuracy, 'precision', precision, 'recall', recall) as (metric, value)"))
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def cross_val(df: DataFrame, models: Mapping[str, Estimator], key: str, folds: int = 5, metrics: Sequence[str] = tuple(METRICS), seed: int = 42) -> DataFrame:
    """Mean and standard deviation (population) over folds per model and metric.

    All metrics of a fold come from one scored pass.
    """
    folded = df.withColumn("__fold", fold(key, folds, seed))
    rows = []
    for name, estimator in models.items():
        scores: dict[str, list[float]] = {m: [] for m in metrics}
        for i in range(folds):
            fitted = estimator.fit(folded.where(F.col("__fold") != i))
            counts = {
                (r.label, r.prediction): r.n
                for r in fitted.transform(folded.where(F.col("__fold") == i)).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")).collect()
            }
            tp, n = counts.get((1.0, 1.0), 0), sum(counts.values())
            right = sum(v for (a, b), v in counts.items() if a == b)
            predicted, actual = sum(v for (_, b), v in counts.items() if b == 1.0), sum(v for (a, _), v in counts.items() if a == 1.0)
            values = {"accuracy": right / n if n else 0.0, "precision": tp / predicted if predicted else 0.0, "recall": tp / actual if actual else 0.0}
            for m in metrics:
                scores[m].append(values[m])
        rows += [(name, m, float(np.mean(v)), float(np.std(v))) for m, v in scores.items()]
    return df.sparkSession.createDataFrame(rows, "model string, metric string, mean double, std double")
