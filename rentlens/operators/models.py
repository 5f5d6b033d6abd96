"""Price models, cross-validation, explanations and the price advisor.

Models are Spark ML estimators trained on a cached feature frame:
ridge (scaled by population sd as the reference's scaler does, with the
penalty converted to Spark's parametrisation), random forest and gradient
boosted trees.  Folds are a seeded hash of the listing id, so every run and
every recomputed task sees the same split.
"""

from __future__ import annotations

import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.operators import features as FT
from rentlens.operators import ranking, stats, trees
from rentlens.session import checkpoint_dir
from rentlens.sources import io

# --- fixed values -----------------------------------------------------------
RIDGE_ALPHA = 10.0
FOREST = {"numTrees": 200, "maxDepth": 12, "minInstancesPerNode": 5}
BOOSTED = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
N_FOLDS, SEED = 5, 42
ROWS_PER_TASK = 500_000  # training rows that a task of a fold's fit takes where the cores do not ask for more tasks
# -----------------------------------------------------------------------------


def _scaled_cols(meta: FT.FeatureMeta) -> list[str]:
    return [f"z_{c}" for c in meta.feature_cols]


class RidgeModel:
    """Standardised ridge: z = (x - mean) / sd_pop; NaN z -> 0 (the mean)."""

    def __init__(self, means: dict, sds: dict, lr_model, meta: FT.FeatureMeta):
        self.means, self.sds, self.lr, self.meta = means, sds, lr_model, meta

    def _z(self, df: DataFrame) -> DataFrame:
        cols = []
        for c in self.meta.feature_cols:
            sd = self.sds[c] or 1.0
            z = (F.col(c) - F.lit(self.means[c] or 0.0)) / F.lit(sd)
            cols.append(F.when(z.isNull() | F.isnan(z), F.lit(0.0)).otherwise(z).alias(f"z_{c}"))
        d = df.select("*", *cols)
        return VectorAssembler(inputCols=_scaled_cols(self.meta), outputCol="zfeatures").transform(d)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.lr.transform(self._z(df)).drop("zfeatures", *_scaled_cols(self.meta))

    @property
    def coefficients(self) -> dict:
        return dict(zip(self.meta.feature_cols, [float(x) for x in self.lr.coefficients]))


def fit_ridge(train: DataFrame, meta: FT.FeatureMeta, alpha: float = RIDGE_ALPHA) -> RidgeModel:
    """Closed-form ridge on standardised features.  Spark's normal-equation
    solver scales the label by its sd inside, so the reference's penalty
    alpha corresponds to regParam = alpha * sd_pop(y) / n."""
    aggs = [F.count(F.lit(1)).alias("_n"), F.stddev_pop("log_price").alias("_sy")]
    for c in meta.feature_cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = train.agg(*aggs).first()  # 2 numbers per feature
    means = {c: row[f"m_{c}"] for c in meta.feature_cols}
    sds = {c: (row[f"s_{c}"] or 1.0) for c in meta.feature_cols}
    model = RidgeModel(means, sds, None, meta)
    reg = alpha * (row["_sy"] or 1.0) / row["_n"]
    lr = LinearRegression(featuresCol="zfeatures", labelCol="log_price", predictionCol="prediction", regParam=reg,
                          elasticNetParam=0.0, standardization=False, solver="normal", fitIntercept=True)
    model.lr = lr.fit(model._z(train))
    return model


def forest(seed: int = SEED, **kw) -> RandomForestRegressor:
    p = dict(FOREST, **kw)
    return RandomForestRegressor(featuresCol="features", labelCol="log_price", seed=seed, **p)


def boosted(seed: int = SEED, **kw) -> GBTRegressor:
    p = dict(BOOSTED, **kw)
    return GBTRegressor(featuresCol="features", labelCol="log_price", seed=seed, **p)


def fit(kind: str, train: DataFrame, meta: FT.FeatureMeta, **kw):
    if kind == "ridge":
        return fit_ridge(train, meta, kw.get("alpha", RIDGE_ALPHA))
    est = forest(**kw) if kind == "forest" else boosted(**kw)
    return PipelineModel([trees.fit_trees(est, train)])


def regression_metrics(pred: DataFrame, label: str = "log_price", prediction: str = "prediction") -> DataFrame:
    """R² on the log scale, MAE and RMSE on the price scale (expm1)."""
    y, p = F.col(label), F.col(prediction)
    ey, ep = F.expm1(y), F.expm1(p)
    # SST = n * population variance of y, so R² comes from one aggregate pass
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    (1 - F.sum(F.pow(y - p, 2)) / (F.count(F.lit(1)) * F.var_pop(y))).alias("r2"),
                    F.avg(F.abs(ey - ep)).alias("mae"), F.sqrt(F.avg(F.pow(ey - ep, 2))).alias("rmse"))


def with_folds(df: DataFrame, k: int = N_FOLDS, seed: int = SEED) -> DataFrame:
    return df.withColumn("fold", FT.fold_column(F.col("listing_id"), k, seed))


def cross_validate(frame: DataFrame, kind: str, k: int = N_FOLDS, seed: int = SEED, parallel: int = N_FOLDS, **kw):
    """Per fold: fit on the other folds (features refitted on the training
    part), predict the fold.  Returns (out-of-fold predictions, per-fold
    metrics rows).  ``parallel`` folds are fitted at the same time from driver
    threads: boosting is a long chain of short jobs, so one fit alone leaves
    most of the cluster idle."""
    spark = frame.sparkSession
    checkpoint_dir(spark)
    # every fold reads the frame twice (fit, metrics): cut its lineage once,
    # in the shared checkpoint folder (survives executor loss)
    data = with_folds(frame, k, seed).checkpoint(eager=True)
    # the folds share the cores: a fold whose jobs had a task per core would start `parallel` times as many, most of
    # them shorter than their start
    tasks = max(1, -(-spark.sparkContext.defaultParallelism // max(1, parallel)), -(-data.count() // ROWS_PER_TASK))
    options = {a: b for a, b in kw.items() if a != "room_type_codes"}

    def one(f: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{f}")  # fair shares where the cluster has fair scheduling
        tr, te = data.where(F.col("fold") != f), data.where(F.col("fold") == f)
        meta = FT.fit_feature_meta(tr, kw.get("room_type_codes", FT.ROOM_TYPE_CODES))
        trf = FT.build_features(tr, meta)
        if kind != "ridge":
            trf = trf.select("features", "log_price").coalesce(tasks)  # what a fit of trees reads
        trf.cache()
        t0 = time.time()
        model = fit(kind, trf, meta, **options)
        secs = time.time() - t0
        pte = model.transform(FT.build_features(te, meta))
        m_te = regression_metrics(pte).first()
        m_tr = regression_metrics(model.transform(trf)).first()
        trf.unpersist()
        return (pte.select("listing_id", "fold", "price", "room_type", "neighbourhood_group", "log_price", "prediction"),
                (kind, f, float(m_te["r2"]), float(m_tr["r2"]), float(m_te["mae"]), float(m_te["rmse"]), secs))

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(one), range(k)))
    out = done[0][0]
    for p, _ in done[1:]:
        out = out.unionByName(p)
    metrics = spark.createDataFrame([row for _, row in done], "model string, fold int, r2 double, r2_train double, mae double, "
                                                              "rmse double, fit_seconds double")
    return out, metrics


def summarise_folds(metrics: DataFrame) -> DataFrame:
    """Mean and sd over folds of R² (test and train), MAE, RMSE and fit time, a row per model."""
    return metrics.groupBy("model").agg(F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"),
                                        F.avg("r2_train").alias("r2_train"), F.avg("mae").alias("mae"),
                                        F.avg("rmse").alias("rmse"), F.sum("fit_seconds").alias("fit_seconds"))


def compare_models(frame: DataFrame, kinds=("ridge", "forest", "boosted"), **kw) -> DataFrame:
    """``summarise_folds`` of each kind of model."""
    parts = []
    for kind in kinds:
        _, m = cross_validate(frame, kind, room_type_codes=kw.get("room_type_codes", FT.ROOM_TYPE_CODES), **kw.get(kind, {}))
        parts.append(m)
    m = parts[0]
    for p in parts[1:]:
        m = m.unionByName(p)
    return summarise_folds(m)


def residual_analysis(oof: DataFrame) -> DataFrame:
    """Residual = actual - predicted price; % error; by room type and group."""
    d = (oof.withColumn("predicted_price", F.expm1("prediction"))
         .withColumn("residual", F.col("price") - F.col("predicted_price"))
         .withColumn("pct_error", F.col("residual") / F.nullif(F.col("price"), F.lit(0.0)) * 100))
    of = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in ("room_type", "neighbourhood_group")])
    d = d.select("residual", "pct_error", F.inline(of))
    g = ranking.grouped(d, ["dimension", "value"],
                        [F.count(F.lit(1)).alias("n"), F.avg("residual").alias("mean_residual"), F.stddev_samp("residual").alias("std_residual"),
                         F.avg("pct_error").alias("mean_pct_error"), F.stddev_samp("pct_error").alias("std_pct_error")],
                        {"residual": {"median_residual": 0.5}, "pct_error": {"median_pct_error": 0.5}})
    return g.select("dimension", "value", "n", "median_residual", "mean_residual", "std_residual", "median_pct_error", "mean_pct_error", "std_pct_error")


def train_metrics(model, feats: DataFrame) -> DataFrame:
    """MAE and RMSE of a fitted model on its own training rows (price scale)."""
    p = model.transform(feats)
    e = F.col("price") - F.expm1("prediction")
    return p.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n"))


# --- persistence ----------------------------------------------------------------

def save_model(spark: SparkSession, model, meta: FT.FeatureMeta, path: str, kind: str) -> None:
    """Spark ML model (or ridge parts) plus a one-row metadata table."""
    if isinstance(model, RidgeModel):
        model.lr.write().overwrite().save(os.path.join(path, "model"))
        extra = {"means": model.means, "sds": model.sds}
    else:
        model.write().overwrite().save(os.path.join(path, "model"))
        extra = {}
    meta_row = dict(meta.to_row(), kind=kind, **extra)
    spark.createDataFrame([(json.dumps(meta_row),)], "meta string").coalesce(1).write.mode("overwrite").json(
        os.path.join(path, "meta"))


def load_model(spark: SparkSession, path: str):
    """(model, meta) or (None, None) when nothing is saved at ``path``."""
    from pyspark.ml.regression import LinearRegressionModel
    if not io.exists(spark, os.path.join(path, "meta")):
        return None, None
    row = spark.read.json(os.path.join(path, "meta")).first()
    m = json.loads(row["meta"])
    meta = FT.FeatureMeta(m["medians"], m["groups"], m["room_type_codes"], m["dummy_cols"])
    if m["kind"] == "ridge":
        lr = LinearRegressionModel.load(os.path.join(path, "model"))
        return RidgeModel(m["means"], m["sds"], lr, meta), meta
    return PipelineModel.load(os.path.join(path, "model")), meta


# --- explanations and advice ----------------------------------------------------------

def linear_contributions(model: RidgeModel, feats: DataFrame) -> DataFrame:
    """Per row and feature: coef * (z - mean z) with z standardised (the
    exact Shapley value of a linear model with independent features)."""
    coefs = model.coefficients
    cols = []
    for c in model.meta.feature_cols:
        sd = model.sds[c] or 1.0
        z = (F.col(c) - F.lit(model.means[c] or 0.0)) / F.lit(sd)
        z = F.when(z.isNull() | F.isnan(z), F.lit(0.0)).otherwise(z)
        cols.append(F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"),
                             (F.lit(coefs[c]) * z).alias("contribution")))
    return feats.select("listing_id", F.array(*cols).alias("contributions"))


def rank_contributions(contributions: DataFrame, names: list[str]) -> DataFrame:
    """Mean absolute contribution per feature, largest first (one aggregate row, turned on its side)."""
    row = contributions.agg(*[F.avg(F.abs(F.col("contributions")[i]["contribution"])).alias(f"f{i}") for i in range(len(names))])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"f{i}").alias("mean_abs_contribution")) for i, c in enumerate(names)])
    return row.select(F.inline(pairs)).orderBy(F.desc("mean_abs_contribution"), F.asc("feature"))


def largest_contributions(contributions: DataFrame, n: int = 5) -> DataFrame:
    """The n largest contributions of each row, with direction text."""
    largest = F.slice(F.array_sort(F.transform("contributions", lambda c: F.struct(
        (-F.abs(c["contribution"])).alias("_order"), c["feature"].alias("feature"), c["value"].alias("value"), c["contribution"].alias("contribution")))), 1, n)
    r = (contributions.select("listing_id", F.posexplode(largest).alias("rank", "c"))
         .select("listing_id", "c.feature", "c.value", "c.contribution", (F.col("rank") + 1).alias("rank")))
    direction = F.when(F.col("contribution") > 0, "increases").otherwise("decreases")
    return r.withColumn("text", F.format_string("%s = %.1f %s the log price by %.2f", F.col("feature"),
                                                F.col("value"), direction, F.abs("contribution")))


def importance_ranking(model: RidgeModel, feats: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature of a ridge model, largest first."""
    return rank_contributions(linear_contributions(model, feats), model.meta.feature_cols)


def top_drivers(model: RidgeModel, feats: DataFrame, n: int = 5) -> DataFrame:
    """The n largest contributions of each listing by a ridge model, with direction text."""
    return largest_contributions(linear_contributions(model, feats), n)


def predict_price(model, meta: FT.FeatureMeta, frame: DataFrame, peers: DataFrame) -> DataFrame:
    """For every listing of ``frame``: predicted fair price, current price,
    peer median (same group and room type, price > 0) and the predicted
    price's percentile among those peers."""
    feats = FT.build_features(frame, meta)
    p = model.transform(feats).withColumn("predicted_price", F.expm1("prediction"))
    keys = ["neighbourhood_group", "room_type"]
    med = stats.peer_medians(peers, keys)
    advice = p.select("listing_id", *keys, F.col("price").alias("current_price"), "predicted_price")
    # each row keeps its columns, so a listing with several host versions stays that many rows
    return stats.percentile_of_score(peers, advice, keys, score="predicted_price").join(med, keys, "left").select(
        *keys, "listing_id", "current_price", "predicted_price", "peer_median", "peer_n", "percentile")
