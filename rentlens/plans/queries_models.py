"""Registered feature, model and advisor queries (§2.11).

Model outputs depend on floating-point training details and have no SQL
form; they are registered without oracle SQL (row-count check) and tested
in ``tests/test_models_jobs.py``.  The feature table itself is oracle-checked.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from rentlens.operators import explain as X
from rentlens.operators import features as FT
from rentlens.operators import frames
from rentlens.operators import models as M
from rentlens.plans.oracle import q
from rentlens.plans.registry import register, source_state, stored, warehouse
from rentlens.session import scratch_path

D = 6  # feature values have at most 5 decimals: no rounding ties at 6
CODES = FT.DRIVER_ROOM_TYPE_CODES


def _frame(spark, sf_dir):
    return frames.model_frame(warehouse(spark, sf_dir))


def _fitted(spark, sf_dir, kind="ridge"):
    """(model, meta, features); the model is fitted once per state of the source tables and stored in the shared folder."""
    fr = _frame(spark, sf_dir)
    path = scratch_path(spark, f"model-{kind}-{source_state(spark, sf_dir)}")
    model, meta = M.load_model(spark, path)
    if model is None:
        meta = FT.fit_feature_meta(fr, CODES)
        feats = FT.build_features(fr, meta).cache()
        model = M.fit(kind, feats, meta)
        M.save_model(spark, model, meta, path, kind)
        feats.unpersist()
    return model, meta, FT.build_features(fr, meta)


def _folds(spark, sf_dir, kind):
    """(out-of-fold predictions, metrics by fold) of a kind of model, fitted once per state of the source tables and stored."""
    made = []

    def part(i):
        def build():
            if not made:
                made.extend(M.cross_validate(_frame(spark, sf_dir), kind, room_type_codes=CODES))
            return made[i]
        return build

    return [stored(spark, sf_dir, f"folds-{kind}-{name}", part(i)) for i, name in enumerate(("oof", "metrics"))]


_GROUPS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]  # region names of the driver data, sorted
_FT_SQL = q(f"""
, mf AS (
  SELECT f.listing_id, f.price, l.room_type, l.accommodates, l.bathrooms, l.bedrooms, l.beds, n.neighbourhood_group,
         h.host_is_superhost, h.host_listings_count, h.hosts_time_as_host_years, f.number_of_reviews,
         f.review_scores_rating, f.review_scores_cleanliness, f.review_scores_location, f.review_scores_value,
         f.availability_365, f.minimum_nights, f.estimated_occupancy_l365d
  FROM fact_listing_performance f JOIN dim_listing l ON f.listing_id = l.listing_id
  JOIN dim_neighbourhood n ON l.neighbourhood_name = n.neighbourhood_name
  JOIN dim_host h ON l.host_id = h.host_id JOIN v_listing_demand v ON f.listing_id = v.listing_id
  WHERE f.price IS NOT NULL AND l.price_is_valid AND v.demand_segment = 'active'),
md AS (SELECT median(bathrooms) AS bathrooms, median(bedrooms) AS bedrooms, median(beds) AS beds,
              median(host_listings_count) AS host_listings_count,
              median(hosts_time_as_host_years) AS hosts_time_as_host_years, median(minimum_nights) AS minimum_nights
       FROM mf),
ft AS (
  SELECT mf.listing_id, ln(1 + mf.price) AS log_price,
         CAST(mf.accommodates AS DOUBLE) AS accommodates,
         coalesce(CAST(mf.bathrooms AS DOUBLE), md.bathrooms) AS bathrooms,
         coalesce(CAST(mf.bedrooms AS DOUBLE), md.bedrooms) AS bedrooms,
         coalesce(CAST(mf.beds AS DOUBLE), md.beds) AS beds,
         CAST(CASE mf.room_type {" ".join(f"WHEN '{k}' THEN {v}" for k, v in CODES.items())} END AS DOUBLE) AS room_type_enc,
         coalesce(CAST(mf.minimum_nights AS DOUBLE), md.minimum_nights) AS minimum_nights,
         CAST(mf.availability_365 AS DOUBLE) AS availability_365, CAST(mf.number_of_reviews AS DOUBLE) AS number_of_reviews,
         coalesce(mf.review_scores_rating, 0.0) AS review_scores_rating,
         coalesce(mf.review_scores_cleanliness, 0.0) AS review_scores_cleanliness,
         coalesce(mf.review_scores_location, 0.0) AS review_scores_location,
         coalesce(mf.review_scores_value, 0.0) AS review_scores_value,
         CAST(mf.estimated_occupancy_l365d AS DOUBLE) AS estimated_occupancy_l365d,
         coalesce(CAST(mf.host_listings_count AS DOUBLE), md.host_listings_count) AS host_listings_count,
         coalesce(CAST(mf.hosts_time_as_host_years AS DOUBLE), md.hosts_time_as_host_years) AS hosts_time_as_host_years,
         CAST(coalesce(mf.host_is_superhost = 't', false) AS DOUBLE) AS is_superhost,
         CAST(mf.review_scores_rating IS NOT NULL AS DOUBLE) AS has_rating,
         coalesce(CAST(mf.beds AS DOUBLE), md.beds) / greatest(CAST(mf.accommodates AS DOUBLE), 1.0) AS beds_per_person,
         {", ".join(f'CAST(coalesce(mf.neighbourhood_group = {chr(39)}{g}{chr(39)}, false) AS DOUBLE) AS "ng_{g}"' for g in _GROUPS[1:])}
  FROM mf, md)
"""
                          )
_FEATURES = FT.BASE_FEATURES + [f"ng_{g}" for g in _GROUPS[1:]]
_FEAT_SQL = _FT_SQL + (f"""
SELECT listing_id, {", ".join(f'round(log_price, {D}) AS log_price' if c == 'log_price' else f'round("{c}", {D}) AS "{c}"'
                             for c in ['log_price'] + FT.BASE_FEATURES + [f'ng_{g}' for g in _GROUPS[1:]])}
FROM ft
""")


@register("feature_vector", _FEAT_SQL)
def feature_vector(spark, sf_dir):
    """Model features: log target, flags, zero and median fills, ratio, codes, one-hot groups."""
    fr = _frame(spark, sf_dir)
    meta = FT.fit_feature_meta(fr, CODES)
    f = FT.build_features(fr, meta, assemble=False)
    return f.select("listing_id", *[F.round(c, D).alias(c) for c in ["log_price"] + meta.feature_cols])


@register("feature_null_check", _FT_SQL + " UNION ALL ".join(
    f"""SELECT count(*) AS n_rows, '{c}' AS feature, count(*) FILTER (WHERE "{c}" IS NULL) AS n_null FROM ft""" for c in _FEATURES))
def feature_null_check(spark, sf_dir):
    """Rows and remaining NULLs per feature of the training matrix."""
    fr = _frame(spark, sf_dir)
    meta = FT.fit_feature_meta(fr, CODES)
    return FT.feature_null_check(FT.build_features(fr, meta, assemble=False), meta)


@register("kfold", _FT_SQL + f"""
SELECT CAST(CAST('0x' || substr(md5(CAST(listing_id AS VARCHAR) || ':{M.SEED}'), 1, 8) AS UBIGINT) % {M.N_FOLDS} AS INTEGER) AS fold, count(*) AS n
FROM mf GROUP BY 1
""")
def kfold(spark, sf_dir):
    """Rows per fold of the seeded 5-fold split."""
    return M.with_folds(_frame(spark, sf_dir)).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("compare_models")
def compare_models(spark, sf_dir):
    """Ridge, forest and boosted trees, 5 folds each: R² (test, train), MAE, RMSE on price (mean and sd over folds)."""
    kinds = [_folds(spark, sf_dir, kind)[1] for kind in ("ridge", "forest", "boosted")]
    return M.summarise_folds(kinds[0].unionByName(kinds[1]).unionByName(kinds[2]))


@register("oof_predictions")
def oof_predictions(spark, sf_dir):
    """Out-of-fold prediction of every training row by the boosted trees."""
    return _folds(spark, sf_dir, "boosted")[0]


@register("residual_analysis")
def residual_analysis(spark, sf_dir):
    """Residual (actual - predicted) and % error by room type and group (boosted trees, out of fold)."""
    return M.residual_analysis(_folds(spark, sf_dir, "boosted")[0])


@register("ridge")
def ridge(spark, sf_dir):
    """Ridge (alpha 10) on standardised features: coefficients."""
    model, meta, _ = _fitted(spark, sf_dir, "ridge")
    return spark.createDataFrame(sorted(model.coefficients.items()), "feature string, coefficient double")


@register("random_forest")
def random_forest(spark, sf_dir):
    """Random forest (200 trees, depth 12, min leaf 5): training MAE / RMSE."""
    model, meta, feats = _fitted(spark, sf_dir, "forest")
    return M.train_metrics(model, feats)


@register("boosted_trees")
def boosted_trees(spark, sf_dir):
    """Gradient boosted trees (300 rounds, depth 6, rate 0.05, 0.8 row/feature subsample): training MAE / RMSE."""
    model, meta, feats = _fitted(spark, sf_dir, "boosted")
    return M.train_metrics(model, feats)


@register("train_metrics")
def train_metrics(spark, sf_dir):
    """Training MAE / RMSE of the boosted trees on the price scale."""
    model, meta, feats = _fitted(spark, sf_dir, "boosted")
    return M.train_metrics(model, feats)


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Save the ridge model and its metadata to the shared folder, load them, score."""
    model, meta, feats = _fitted(spark, sf_dir, "ridge")
    path = scratch_path(spark, f"model_{os.getpid()}")
    M.save_model(spark, model, meta, path, "ridge")
    loaded, lmeta = M.load_model(spark, path)
    return loaded.transform(FT.build_features(_frame(spark, sf_dir), lmeta)).select("listing_id", "prediction")


@register("importance_ranking")
def importance_ranking(spark, sf_dir):
    """Mean |contribution| per feature of the ridge model, largest first."""
    model, meta, feats = _fitted(spark, sf_dir, "ridge")
    return M.importance_ranking(model, feats)


@register("top_drivers")
def top_drivers(spark, sf_dir):
    """Five largest contributions of every listing, with direction text."""
    model, meta, feats = _fitted(spark, sf_dir, "ridge")
    return M.top_drivers(model, feats)


def _contributions(spark, sf_dir):
    model, meta, feats = _fitted(spark, sf_dir, "boosted")
    return stored(spark, sf_dir, "contributions-boosted", lambda: X.tree_contributions(model, feats, meta.feature_cols)), meta


@register("price_importance")
def price_importance(spark, sf_dir):
    """Mean |contribution| per feature of the boosted trees (the model that predicts), largest first."""
    contributions, meta = _contributions(spark, sf_dir)
    return M.rank_contributions(contributions, meta.feature_cols)


@register("price_drivers")
def price_drivers(spark, sf_dir):
    """Five largest contributions to every listing's predicted price (boosted trees), with direction text."""
    return M.largest_contributions(_contributions(spark, sf_dir)[0])


@register("permutation_importance")
def permutation_importance(spark, sf_dir):
    """Rise of the boosted trees' error when the values of a feature are dealt anew, a row per feature."""
    model, meta, feats = _fitted(spark, sf_dir, "boosted")
    return X.permutation_importance(model, feats, meta.feature_cols)


@register("predict_price")
def predict_price(spark, sf_dir):
    """Advice for every listing: predicted and current price, peer median, percentile of the prediction (boosted trees)."""
    wh = warehouse(spark, sf_dir)
    model, meta, _ = _fitted(spark, sf_dir, "boosted")
    peers = wh.stg_listings.select(F.col("neighbourhood_group_cleansed").alias("neighbourhood_group"),
                                   "room_type", "price")
    scope = frames.listing_frame_all(wh)
    return M.predict_price(model, meta, scope, peers)
