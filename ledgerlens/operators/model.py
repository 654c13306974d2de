"""Model fitting with MLlib: out-of-fold predictions, class weights, fold
importance; feature selection and seeded draws of parameters. Training is
distributed by MLlib (tree aggregation per iteration); predictions stay
DataFrames keyed by id. Leaf-wise boosting is in ``boosting.py``.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import forest
from ledgerlens.operators.evaluate import class_weights, with_class_weight
from ledgerlens.operators.selection import correlated_columns, percentile_filter
from ledgerlens.session import cut_lineage


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def positive_score(pred: DataFrame, out: str = "score") -> DataFrame:
    return pred.withColumn(out, vector_to_array(F.col("probability")).getItem(1))


#: settings of a full run; a caller may pass others (fixed values of SURVEY 2.16)
DEFAULTS = {
    "logistic": {"maxIter": 1000},
    "forest": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "gbt": {"maxIter": 1000, "maxDepth": 7, "stepSize": 0.02, "seed": 42},
}


def make_estimator(kind: str, label: str, weight: str | None = None, **params):
    common = dict(featuresCol="features", labelCol=label)
    if weight:
        common["weightCol"] = weight
    cls = {"logistic": LogisticRegression, "forest": RandomForestClassifier, "gbt": GBTClassifier}[kind]
    return cls(**common, **{**DEFAULTS[kind], **params})


def fit_predict(df: DataFrame, features: Sequence[str], label: str, kind: str, keep: Sequence[str],
                balanced: bool = True, **params) -> DataFrame:
    if kind == "forest":        # MLlib's takes every row through every tree at every level
        return _forest_fit_predict(df, features, label, keep, balanced, **{**DEFAULTS[kind], **params})
    d = with_class_weight(df, label, "_w") if balanced else df
    d = assemble(d, features)
    model = make_estimator(kind, label, "_w" if balanced else None, **params).fit(d)
    return positive_score(model.transform(d)).select(*keep, label, "score")


def _forest_fit_predict(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str], balanced: bool,
                        numTrees: int, maxDepth: int, seed: int, maxBins: int = 32) -> DataFrame:
    """A forest on cells (``forest.py``), with MLlib's names of parameters."""
    classes = {r[label]: r["weight"] for r in class_weights(df, label).collect() if r[label] is not None}
    if not set(classes) <= {0, 1}:
        raise ValueError(f"labels other than 0 and 1: {sorted(classes)}")
    weights = tuple(float(classes.get(y, 1.0)) if balanced else 1.0 for y in (0, 1))
    d = df.filter(F.col(label).isNotNull())
    model = forest.fit(d, features, label, weights, numTrees, maxDepth, maxBins, seed)
    return forest.predict(d, model, [*keep, label])


@dataclass
class FoldModels:
    """One model per fold, fitted on the other folds, and the frame they saw."""

    models: list
    frame: DataFrame
    features: list[str]
    label: str
    fold_col: str

    def oof(self, keep: Sequence[str]) -> DataFrame:
        """Every row scored once, by the model that was not fitted on it."""
        out = None
        for i, m in enumerate(self.models):
            part = positive_score(m.transform(self.frame.filter(F.col(self.fold_col) == i)))
            part = part.select(*keep, self.fold_col, self.label, "score")
            out = part if out is None else out.unionByName(part)
        return out

    def test_average(self, test: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Mean of the fold models' scores on another frame, in one pass."""
        d = assemble(test, self.features)
        for i, m in enumerate(self.models):
            m = m.copy()
            m.setProbabilityCol(f"_p{i}")
            m.setRawPredictionCol(f"_r{i}")
            m.setPredictionCol(f"_c{i}")
            d = m.transform(d)
        total = sum((vector_to_array(F.col(f"_p{i}")).getItem(1) for i in range(len(self.models))), F.lit(0.0))
        return d.select(*keep, (total / F.lit(float(len(self.models)))).alias("score"))

    def importances(self) -> list[tuple[int, str, float]]:
        """(fold, feature, importance) of models that have importances."""
        return [(i, f, float(v)) for i, m in enumerate(self.models) if hasattr(m, "featureImportances")
                for f, v in zip(self.features, m.featureImportances.toArray())]


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of rounds up to the least loss, and whether ``patience`` rounds
    without a gain follow it; what comes after those is not looked at."""
    best = 0
    for i, v in enumerate(losses):
        if v < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_stopped(estimator: GBTClassifier, train: DataFrame, held: DataFrame, patience: int):
    """Boosting that ends when the loss on ``held`` has not fallen for ``patience``
    rounds, with the trees up to the least loss.  MLlib's own rule has no
    patience and cannot go on with a model, so the rounds are doubled until the
    end is seen; the first trees of a longer run are those of a shorter one."""
    most = estimator.getMaxIter()
    rounds = min(most, patience + 1)
    while True:
        model = estimator.copy({estimator.maxIter: rounds}).fit(train)
        best, ended = best_round(model.evaluateEachIteration(held), patience)
        if ended or rounds >= most:
            break
        rounds = min(most, 2 * rounds)
    return model if best == rounds else estimator.copy({estimator.maxIter: best}).fit(train)


def fit_folds(df: DataFrame, features: Sequence[str], label: str, fold_col: str, k: int, kind: str,
              balanced: bool = True, early_stopping: bool = False, patience: int = 100, **params) -> FoldModels:
    """Fit one model per fold.  The assembled frame is written to the shared
    folder once, so no fit recomputes weights, folds or features.  With
    ``early_stopping`` (gbt) the left-out fold is the validation set that ends
    the boosting after ``patience`` rounds without gain."""
    d = with_class_weight(df, label, "_w") if balanced else df
    d = cut_lineage(assemble(d, features))
    models = []
    for i in range(k):
        est = make_estimator(kind, label, "_w" if balanced else None, **params)
        train = d.filter(F.col(fold_col) != i)
        if early_stopping and kind == "gbt":
            models.append(fit_stopped(est, train, d.filter(F.col(fold_col) == i), patience))
        else:
            models.append(est.fit(train))
    return FoldModels(models, d, list(features), label, fold_col)


def oof_predict(df: DataFrame, features: Sequence[str], label: str, fold_col: str, k: int, kind: str,
                keep: Sequence[str], balanced: bool = True, importances: list | None = None,
                **params) -> DataFrame:
    """Out-of-fold scores: model i is fitted on folds != i and scores fold i."""
    f = fit_folds(df, features, label, fold_col, k, kind, balanced, **params)
    if importances is not None:
        importances.extend(f.importances())
    return f.oof(keep)


def select_features(df: DataFrame, importances: Sequence[tuple[int, str, float]], q: float = 0.25, threshold: float = 0.95) -> list[str]:
    """The percentile filter on the mean of fold importances (fold, feature,
    importance), then the correlation filter in importance order.  Only lists of
    feature names and their importances pass through the driver."""
    t = df.sparkSession.createDataFrame(list(importances), "fold int, feature string, importance double")
    mean = t.groupBy("feature").agg(F.avg("importance").alias("importance"))
    kept = [r["feature"] for r in percentile_filter(mean, "importance", q).orderBy(F.desc("importance"), "feature").collect()]
    dropped = {r["feature"] for r in correlated_columns(df, kept, threshold).collect()} if len(kept) > 1 else set()
    return [f for f in kept if f not in dropped]


def sample_params(space: dict, n: int, seed: int = 42) -> list[dict]:
    """Seeded random draws; ('log', lo, hi) is log-uniform, ('int', lo, hi) integer, ('float', lo, hi) uniform."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        p = {}
        for name, (kind, lo, hi) in space.items():
            if kind == "int":
                p[name] = rng.randint(lo, hi)
            elif kind == "log":
                p[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                p[name] = rng.uniform(lo, hi)
        out.append(p)
    return out
