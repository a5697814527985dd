"""Salary regression, hot-job and disclosure classification, market segments."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.operators import evaluate, kmeans
from vacancia.operators.keys import top_bottom, top_k
from vacancia.operators.prepare import Features, balanced_weights, impute_median, standardize


@dataclass
class Scorer:
    """A fitted model with its feature preparation. ``log_target`` models answer in log space."""

    features: Features
    model: Transformer
    kind: str  # "regression" or "classification"
    log_target: bool = False

    def predict(self, df: DataFrame, name: str, prob: str | None = None) -> DataFrame:
        """Adds the prediction (and for classes the probability of class 1); lazy, no shuffle.

        Rows that carry their vector already (made once for several models) keep it.
        """
        out = self.model.transform(_ready(df, self.features))
        value = F.expm1("prediction") if self.log_target else F.col("prediction")
        cols = {name: value.cast("int") if self.kind == "classification" else value}
        if prob:
            cols[prob] = vector_to_array("probability")[1]
        extra = [c for c in out.columns if c not in df.columns]
        return out.withColumns(cols).drop(*[c for c in extra if c not in cols])

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        meta = json.dumps({"kind": self.kind, "log_target": self.log_target})
        spark = SparkSession.active()
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(path: str) -> Scorer:
        meta = json.loads(SparkSession.active().read.text(f"{path}/meta").first()[0])
        return Scorer(Features.load(f"{path}/features"), PipelineModel.load(f"{path}/model").stages[0], **meta)


def _ready(train: DataFrame, features: Features) -> DataFrame:
    """The training rows with their vector; rows that carry one already (kept for several fits) stay as they are."""
    return train if "features" in train.columns else features.transform(train)


NORMAL_FEATURES = 4096  # Spark solves the normal equations up to here


def fit_ridge(train: DataFrame, target: str, features: Features, alpha: float = 10.0, log_target: bool = True):
    """Least squares plus alpha times the squared coefficients, on log1p of the target.

    Spark scales the label before it penalizes, so alpha is scaled by the label's deviation: the population's for the
    normal equations (one pass, up to 4,096 features), the sample's for the iterative fit that wider vectors take.
    """
    label = F.log1p(target) if log_target else F.col(target)
    ready = _ready(train, features).select("features", label.alias("_y"))
    row = ready.select("features").first()
    wide = row is not None and row["features"].size > NORMAL_FEATURES
    n, std = ready.agg(F.count("*"), F.stddev_samp("_y") if wide else F.stddev_pop("_y")).first()
    fit = LinearRegression(
        labelCol="_y", regParam=alpha * (std or 0.0) / n, elasticNetParam=0.0, standardization=False,
        solver="l-bfgs" if wide else "normal", maxIter=1000, tol=1e-10,
    )
    return Scorer(features, fit.fit(ready), "regression", log_target)


def _fit_reg(est, train: DataFrame, target: str, features: Features) -> Scorer:
    ready = _ready(train, features).select("features", F.col(target).alias("_y"))
    return Scorer(features, est.setLabelCol("_y").fit(ready), "regression")


def fit_forest_reg(train, target, features, trees: int = 300, depth: int = 12, leaf: int = 2, seed: int = 42) -> Scorer:
    est = RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed)
    return _fit_reg(est.setFeatureSubsetStrategy("all"), train, target, features)


def fit_tree(train, target, features, depth: int = 10, seed: int = 42) -> Scorer:
    return _fit_reg(DecisionTreeRegressor(maxDepth=depth, seed=seed), train, target, features)


def fit_gbt(
    train, target, features, iters: int = 100, step: float = 0.1, depth: int = 6, bins: int = 32, leaf: int = 1, seed: int = 42
) -> Scorer:
    est = GBTRegressor(maxIter=iters, stepSize=step, maxDepth=depth, maxBins=bins, minInstancesPerNode=leaf, seed=seed)
    return _fit_reg(est, train, target, features)


def _without_summary(model):
    """A class model as tasks get it: its training summary holds the session, which cannot be sent once it has observed a query."""
    model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def fit_logistic(train, label, features, balanced: bool = True, c: float = 1.0, iters: int = 1000) -> Scorer:
    """L2 logistic regression with penalty 1 / C, classes weighted alike if ``balanced``."""
    rows = balanced_weights(train, label, "_weight") if balanced else train.withColumn("_weight", F.lit(1.0))
    ready = _ready(rows, features).select("features", F.col(label).cast("double").alias("_y"), "_weight")
    total = ready.agg(F.sum("_weight")).first()[0]
    est = LogisticRegression(
        labelCol="_y", weightCol="_weight", regParam=1.0 / (c * total), standardization=False, maxIter=iters
    )
    return Scorer(features, _without_summary(est.fit(ready)), "classification")


def fit_forest_clf(
    train, label, features, trees: int = 100, depth: int = 15, balanced: bool = True, seed: int = 42
) -> Scorer:
    rows = balanced_weights(train, label, "_weight") if balanced else train.withColumn("_weight", F.lit(1.0))
    ready = _ready(rows, features).select("features", F.col(label).cast("double").alias("_y"), "_weight")
    est = RandomForestClassifier(labelCol="_y", weightCol="_weight", numTrees=trees, maxDepth=depth, seed=seed)
    return Scorer(features, _without_summary(est.fit(ready)), "classification")


def _one_preparation(models: Mapping[str, Scorer]) -> Features | None:
    """The feature preparation that all the models share, if they do."""
    found = [m.features for m in models.values()]
    return found[0] if found and all(f is found[0] for f in found) else None


def _score_all(df: DataFrame, models: Mapping[str, Scorer], prefix: str) -> DataFrame:
    """``<prefix><name>`` of every model; a preparation that they share is done once per row."""
    shared = _one_preparation(models) if "features" not in df.columns else None
    out = df if shared is None else shared.transform(df)
    for name, m in models.items():
        out = m.predict(out, f"{prefix}{name}")
    return out if shared is None else out.drop("features")


def benchmark(models: Mapping[str, Scorer], test: DataFrame, target: str) -> DataFrame:
    """One row of test metrics per model."""
    if models and all(m.kind == "regression" for m in models.values()):
        scored = _score_all(test, models, "_p_")
        return evaluate.regression_table(scored, target, {n: f"_p_{n}" for n in models})

    def line(name: str, m: Scorer) -> DataFrame:
        if m.kind == "regression":
            scored = m.predict(test, "_p").select(target, "_p")
            return evaluate.regression_metrics(scored, target, "_p").select(F.lit(name).alias("model"), "*")
        scored = m.predict(test, "_p", "_prob").select(target, "_p", "_prob")
        area = evaluate.auc(scored, target, "_prob").scalar()
        return evaluate.classification_metrics(scored, target, "_p").select(
            F.lit(name).alias("model"), "*", area.alias("roc_auc")
        )

    return reduce(DataFrame.unionByName, (line(n, m) for n, m in models.items()))


def choose_champion(metrics: DataFrame, by: str) -> DataFrame:
    """The model with the highest metric; among equals the first by name."""
    return top_k(metrics, [F.desc_nulls_last(by), "model"], 1)


def _feature_rows(spark: SparkSession, names: Sequence[str], values: Sequence[float], col: str) -> DataFrame:
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], f"feature string, {col} double")


def feature_importance(scorer: Scorer, n: int = 20) -> DataFrame:
    """The n features a tree model used most, by name."""
    table = _feature_rows(
        SparkSession.active(), scorer.features.names(), scorer.model.featureImportances.toArray(), "importance"
    )
    return top_k(table, [F.desc("importance"), "feature"], n)


def coefficients(scorer: Scorer) -> DataFrame:
    """Signed coefficients by feature name, the strongest push first."""
    table = _feature_rows(
        SparkSession.active(), scorer.features.names(), scorer.model.coefficients.toArray(), "coefficient"
    )
    return table.orderBy(F.desc("coefficient"), "feature")


def drivers(scorer: Scorer, n: int = 10) -> DataFrame:
    return top_bottom(coefficients(scorer), "coefficient", n, ["feature"])


def score_salaries(df: DataFrame, models: Mapping[str, Scorer], best: str, target: str = "normalized_salary"):
    """``pred_salary_<name>`` of every model, ``pred_salary_best`` and the residual."""
    out = _score_all(df, models, "pred_salary_")
    out = out.withColumn("pred_salary_best", F.col(f"pred_salary_{best}"))
    return out.withColumn("residual_best", F.col(target) - F.col("pred_salary_best")) if target in df.columns else out


def score_hot(df: DataFrame, model: Scorer) -> DataFrame:
    return model.predict(df, "hot_job_pred", "hot_job_prob")


def score_what_if(rows: DataFrame, defaults: Mapping[str, object], salary: Scorer, hot: Scorer) -> DataFrame:
    """Hypothetical postings through both models; fields left out or null take the declared defaults."""
    have = set(rows.columns)
    filled = rows.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) if c in have else F.lit(v) for c, v in defaults.items()}
    )
    return hot_advice(salary_range(score_hot(salary.predict(filled, "pred_salary"), hot)))


def salary_range(df: DataFrame, pct: float = 0.10, col: str = "pred_salary") -> DataFrame:
    return df.withColumns({"salary_low": F.col(col) * (1 - pct), "salary_high": F.col(col) * (1 + pct)})


def hot_advice(df: DataFrame, cut: float = 0.6, col: str = "hot_job_prob") -> DataFrame:
    return df.withColumn("hot_advice", F.when(F.col(col) > cut, "strong").otherwise("improve"))


# --- segments ---------------------------------------------------------------


@dataclass
class Segments:
    """The cheapest run of K-means per k with its figures, and the best k by silhouette."""

    models: dict[int, kmeans.Run]
    table: DataFrame
    best_k: int

    def assign(self, scaled: DataFrame, name: str = "cluster") -> DataFrame:
        return kmeans.nearest(scaled, self.models[self.best_k].centres, name)


def segment_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Median-filled, standardized ``features`` vector beside the original columns."""
    work = {f"_z_{c}": F.col(c).cast("double") for c in cols}
    z = list(work)
    ready = standardize(impute_median(df.withColumns(work), z), z)
    return VectorAssembler(inputCols=z, outputCol="features").transform(ready).drop(*z)


def fit_kmeans(
    scaled: DataFrame,
    keys: Sequence[str],
    ks: Sequence[int] = range(2, 8),
    n_init: int = 10,
    seed: int = 42,
    sample: int | None = None,
) -> Segments:
    """K-means for every k, the cheapest of ``n_init`` starts each, and the k with the best silhouette.

    All runs share their scans. The silhouette is the squared Euclidean one of all rows (as ``evaluate.silhouette_all`` has it), of
    every k in one more scan of the points; ``sample`` rows give the Euclidean one instead.
    """
    runs, cheapest = kmeans.fit_measured(scaled, keys, ks, n_init, seed, silhouette=sample is None)
    if not runs:
        raise ValueError("no rows to cluster")
    models, lines = {}, []
    for k, (best, sil) in cheapest.items():
        if sample is not None:
            flat = kmeans.nearest(scaled, best.centres).select(*keys, "cluster", vector_to_array("features").alias("f"))
            sil = evaluate.silhouette(flat, "f", "cluster", keys, sample, seed).first()["silhouette"]
        models[k] = best
        lines.append((k, best.cost, float("-inf") if sil is None else float(sil)))
    best_k = max(lines, key=lambda x: (x[2], -x[0]))[0]
    table = scaled.sparkSession.createDataFrame(lines, "k int, inertia double, silhouette double")
    return Segments(models, table, best_k)
