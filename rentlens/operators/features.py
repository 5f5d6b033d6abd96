"""Price-model features, built the same way for training and scoring.

``fit_feature_meta`` learns the few numbers scoring needs again (medians of
six columns by distributed quantiles, the sorted list of area groups); they are
small by construction (6 numbers, one entry per group) and kept as
metadata.  ``build_features`` applies them as column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.operators.ranking import quantiles
from rentlens.functions import columns as C

# --- fixed values -----------------------------------------------------------
ROOM_TYPE_CODES = {"Entire home/apt": 3, "Private room": 2, "Hotel room": 1, "Shared room": 0}
SCORE_COLUMNS = ["review_scores_rating", "review_scores_cleanliness", "review_scores_location", "review_scores_value"]
IMPUTE_COLUMNS = ["bathrooms", "bedrooms", "beds", "host_listings_count", "hosts_time_as_host_years", "minimum_nights"]
BASE_FEATURES = ["accommodates", "bathrooms", "bedrooms", "beds", "room_type_enc", "minimum_nights",
                 "availability_365", "number_of_reviews", "review_scores_rating", "review_scores_cleanliness",
                 "review_scores_location", "review_scores_value", "estimated_occupancy_l365d",
                 "host_listings_count", "hosts_time_as_host_years", "is_superhost", "has_rating", "beds_per_person"]
DUMMY_PREFIX = "ng_"
MISSING = -1.0
# -----------------------------------------------------------------------------
# Room-type codes for the driver stand-in data (same ordinal idea: most
# private / largest first).
DRIVER_ROOM_TYPE_CODES = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1, "5-LOW": 0}


def map_lookup(c: Column, mapping: dict) -> Column:
    """Dictionary lookup; an unmapped value gives NULL."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[c]


@dataclass
class FeatureMeta:
    medians: dict
    groups: list            # all groups seen in training, sorted
    room_type_codes: dict
    dummy_cols: list = field(default_factory=list)

    @property
    def feature_cols(self) -> list:
        return BASE_FEATURES + self.dummy_cols

    def to_row(self) -> dict:
        return {"medians": {k: float(v) if v is not None else None for k, v in self.medians.items()},
                "groups": list(self.groups), "room_type_codes": {k: int(v) for k, v in self.room_type_codes.items()},
                "dummy_cols": list(self.dummy_cols)}


def fit_feature_meta(train: DataFrame, room_type_codes: dict = ROOM_TYPE_CODES) -> FeatureMeta:
    """Training medians (exact, interpolated) and the sorted group list."""
    named = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in IMPUTE_COLUMNS])
    found = quantiles(train.select(F.inline(named)), "x", {"median": 0.5}, ["column"]).collect()  # one row per column
    medians = {r["column"]: r["median"] for r in found}
    groups = list(train.agg(F.array_sort(F.collect_set("neighbourhood_group"))).first()[0] or [])  # one entry per group
    # one-hot with the first sorted category dropped (pandas get_dummies(drop_first=True))
    dummies = [f"{DUMMY_PREFIX}{g}" for g in groups[1:]]
    return FeatureMeta({c: medians.get(c) for c in IMPUTE_COLUMNS}, groups, dict(room_type_codes), dummies)


def build_features(df: DataFrame, meta: FeatureMeta, assemble: bool = True) -> DataFrame:
    """Target, flags, fills, ratios, codes, dummies and (optionally) the
    feature vector.  A room type outside the code table stays NULL (``MISSING``
    in the vector); a group unseen in training gets all zeros."""
    d = df.withColumn("log_price", F.log1p("price"))
    d = d.withColumn("is_superhost", C.to_flag_int(F.col("host_is_superhost") == "t"))
    d = d.withColumn("has_rating", F.col("review_scores_rating").isNotNull().cast("int"))
    d = d.fillna(0.0, subset=SCORE_COLUMNS)
    fills = {c: v for c, v in meta.medians.items() if v is not None}
    for c, v in fills.items():
        d = d.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(float(v))))
    d = d.withColumn("beds_per_person", F.col("beds") / C.clip_lower(F.col("accommodates").cast("double"), 1.0))
    d = d.withColumn("price_per_person", F.col("price") / C.clip_lower(F.col("accommodates").cast("double"), 1.0))
    d = d.withColumn("room_type_enc", map_lookup(F.col("room_type"), meta.room_type_codes).cast("double"))
    for g in meta.groups[1:]:
        d = d.withColumn(f"{DUMMY_PREFIX}{g}", C.to_flag_int(F.col("neighbourhood_group") == g))
    for c in meta.feature_cols:
        d = d.withColumn(c, F.col(c).cast("double"))
    if assemble:
        # Spark's trees take no NaN: for them a missing value is a value of its own, below all others
        names = [f"_f{i}" for i in range(len(meta.feature_cols))]
        d = d.withColumns({n: F.coalesce(F.nanvl(F.col(c), F.lit(MISSING)), F.lit(MISSING)) for n, c in zip(names, meta.feature_cols)})
        d = VectorAssembler(inputCols=names, outputCol="features").transform(d).drop(*names)
    return d


def feature_null_check(features: DataFrame, meta: FeatureMeta) -> DataFrame:
    """Rows and remaining NULLs per feature, long form."""
    row = features.agg(F.count(F.lit(1)).alias("n_rows"),
                       *[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in meta.feature_cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in meta.feature_cols)
    return row.selectExpr("n_rows", f"stack({len(meta.feature_cols)}, {stack}) AS (feature, n_null)")


def fold_column(key: Column, k: int = 5, seed: int = 42) -> Column:
    """Repeatable fold number from a seeded hash of the key (the first 32 bits of an MD5)."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(k)).cast("int")
