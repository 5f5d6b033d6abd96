"""Review text jobs: sentiment, language, buckets and the briefing facts.

Scoring is one Arrow-batched pass over whole texts (``functions.text``): no
sampling, no explode, no shuffle; grouping happens only on the scored rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentlens.functions import text as TX
from rentlens.operators import frames, hosts, market, seasons
from rentlens.operators.ranking import quantiles
from rentlens.operators.warehouse import Warehouse

SCORE_COLS = ["review_scores_rating", "review_scores_cleanliness", "review_scores_location", "review_scores_value"]
# Rating buckets, right-closed as ``pd.cut``: (0, 4.0], (4.0, 4.5], (4.5, 4.8], (4.8, 5.01]
RATING_BINS = [0.0, 4.0, 4.5, 4.8, 5.01]
RATING_LABELS = ["<4.0", "4.0-4.5", "4.5-4.8", "4.8-5.0"]


def rated_reviews(wh: Warehouse) -> DataFrame:
    """Reviews of rated listings with their listing scores (the reference's
    sample frame, here over every review)."""
    r = wh.fact_reviews.join(wh.fact_listing_performance, "listing_id").where(
        F.col("review_scores_rating").isNotNull())
    return r.select("review_id", "listing_id", "comment_length", *SCORE_COLS, "price")


def semi_join_ids(stg_reviews: DataFrame, ids: DataFrame) -> DataFrame:
    """Review rows whose id is in ``ids`` (a semi join, not a text IN list)."""
    return stg_reviews.join(ids.select(F.col("review_id").alias("id")).distinct(), "id", "left_semi")


def merge_text(reviews: DataFrame, wh: Warehouse) -> DataFrame:
    """Attach the review text by review id."""
    return wh.with_comments(reviews)


def review_texts(wh: Warehouse) -> DataFrame:
    return merge_text(rated_reviews(wh), wh)


def score_reviews(df: DataFrame, text_col: str = "comments") -> DataFrame:
    """Add neg, neu, pos, compound and language to every row, in one pass."""
    d = df.withColumn("_scores", TX.scores(F.col(text_col)))
    return d.withColumns({k: F.col(f"_scores.{k}") for k in ("neg", "neu", "pos", "compound", "language")}).drop("_scores")


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    c = F.col("compound")
    n = F.count(F.lit(1))
    scored = scored.select("compound")
    q = quantiles(scored, "compound", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    row = scored.agg(n.alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"),
                      F.max(c).alias("max"),
                      F.count_if(c > TX.POSITIVE_CUT).alias("n_positive"),
                      F.count_if((c >= TX.NEGATIVE_CUT) & (c <= TX.POSITIVE_CUT)).alias("n_neutral"),
                      F.count_if(c < TX.NEGATIVE_CUT).alias("n_negative"),
                      (F.count_if(c > TX.POSITIVE_CUT) * 100.0 / n).cast("double").alias("pct_positive"),
                      (F.count_if(c < TX.NEGATIVE_CUT) * 100.0 / n).cast("double").alias("pct_negative"))
    return row.withColumn("_one", F.lit(1)).join(q.withColumn("_one", F.lit(1)), "_one").drop("_one")  # one row each


def zero_sentiment_sample(scored: DataFrame, n: int = 10, width: int = 200) -> DataFrame:
    return (scored.where(F.col("compound") == 0).orderBy("review_id").limit(n)
            .select("review_id", F.substring("comments", 1, width).alias("comments")))


def language_mix(scored: DataFrame, top: int = 15) -> DataFrame:
    """Top languages with count and share of all scored reviews."""
    g = scored.groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per language
    return (g.select("language", "n", (F.col("n") * 100.0 / total).cast("double").alias("pct"))
            .orderBy(F.desc("n"), F.asc("language")).limit(top))


def sentiment_vs_scores(scored: DataFrame, language: str = "en") -> DataFrame:
    """Correlation of the compound score with each rating and text length."""
    e = scored.where(F.col("language") == language)
    cols = SCORE_COLS + ["comment_length"]
    row = e.agg(F.count(F.lit(1)).alias("n"), *[F.corr("compound", F.col(c).cast("double")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return row.selectExpr("n", f"stack({len(cols)}, {stack}) AS (metric, r)")


def rating_bucket(c) -> F.Column:
    """Right-closed rating buckets; values outside (0, 5.01] get no bucket."""
    out = None
    for lo, hi, lab in zip(RATING_BINS[:-1], RATING_BINS[1:], RATING_LABELS):
        cond = (c > lo) & (c <= hi)
        out = F.when(cond, lab) if out is None else out.when(cond, lab)
    return out


def sentiment_by_bucket(scored: DataFrame, language: str = "en") -> DataFrame:
    e = scored.where(F.col("language") == language)
    b = rating_bucket(F.col("review_scores_rating"))
    e = e.where(b.isNotNull()).select(b.alias("score_bucket"), "compound")
    return e.groupBy("score_bucket").agg(F.count(F.lit(1)).alias("n")).join(
        quantiles(e, "compound", {"median_compound": 0.5}, ["score_bucket"]), "score_bucket")


def sentiment_trend(scored: DataFrame, language: str = "en") -> DataFrame:
    """Least-squares line of rating on the compound score."""
    e = scored.where(F.col("language") == language)
    return e.agg(F.regr_slope("review_scores_rating", "compound").alias("slope"),
                 F.regr_intercept("review_scores_rating", "compound").alias("intercept"))


def language_accuracy(texts: DataFrame) -> DataFrame:
    """Detected vs known language of ``texts`` (comments, language_true)."""
    d = TX.add_language(texts.select("language_true", "comments"), "comments")
    return d.groupBy("language_true").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_if(F.col("language") == F.col("language_true")).alias("n_correct"),
                                          F.count_if(F.col("language") == TX.UNKNOWN).alias("n_unknown"))


def _facts(row: DataFrame, section: str, metrics: list[str]) -> DataFrame:
    """One row per metric from a one-row table."""
    return row.select(F.inline(F.array(*[F.struct(F.lit(section).alias("section"), F.lit(m).alias("metric"),
                                                  F.col(m).cast("double").alias("value")) for m in metrics])))


def _named(df: DataFrame, section: str, prefix: str, name: str, value: str) -> DataFrame:
    """A fact for each row of a small grouped table, named by its group."""
    return df.where(F.col(name).isNotNull()).select(
        F.lit(section).alias("section"), F.concat(F.lit(f"{prefix}:"), F.col(name)).alias("metric"), F.col(value).cast("double").alias("value"))


def _structure_facts(wh: Warehouse, lp: DataFrame, pct) -> list[DataFrame]:
    """Listings, hosts and their shares, licences."""
    segment = F.col("demand_segment")
    demand = lp.agg(F.count(F.lit(1)).alias("listings"), F.count_if(segment == "active").alias("active_listings"),
                    pct(segment == "active").alias("pct_active"), pct(segment == "never_active").alias("pct_never_active"),
                    pct(segment == "dormant_with_history").alias("pct_dormant"),
                    pct(F.col("estimated_occupancy_l365d") == 0).alias("zero_occupancy_pct"))
    p = hosts.host_portfolio(wh)
    n = F.col("listing_count")
    total = p.agg(F.sum("listing_count")).scalar()
    size = p.agg(F.count(F.lit(1)).alias("hosts"), pct(n == 1).alias("single_of_hosts_pct"),
                 (F.sum(F.when(n == 1, 1).otherwise(0)) * 100.0 / F.sum(n)).alias("single_hosts_pct"),
                 F.max(n).alias("largest_host_listings"), (F.max(n) * 100.0 / F.sum(n)).alias("largest_host_pct"),
                 (F.least(F.lit(500), F.count(F.lit(1))) * 100.0 / F.count(F.lit(1))).alias("top_500_of_hosts_pct"))
    top = [p.orderBy(F.desc("listing_count")).limit(k).agg((F.sum("listing_count") * 100.0 / total).alias(f"top_{k}_hosts_pct")) for k in (10, 500)]
    lic = wh.stg_listings.select("license", TX.license_category(F.col("license")).alias("c"), TX.license_number(F.col("license")).alias("number"))
    none = F.col("license").isNull() | (F.col("license") == "")
    lic = lic.agg(F.count_if(none).alias("without_licence"), pct(none).alias("without_licence_pct"), F.count_if(F.col("c") == "exempt_declared").alias("exempt"),
                  pct(F.col("c") == "exempt_declared").alias("exempt_pct"), F.count_distinct("number").alias("unique_licence_numbers"))
    return [_facts(demand, "demand", demand.columns), _facts(size, "hosts", size.columns),
            *[_facts(t, "hosts", t.columns) for t in top], _facts(lic, "licences", lic.columns)]


def _price_facts(wh: Warehouse, lp: DataFrame, digits: int) -> list[DataFrame]:
    """Prices of active listings: whole, by room type and by area."""
    active = lp.where((F.col("demand_segment") == "active") & F.col("price_is_valid")).select("price", "room_type", "neighbourhood_name")
    quarters = quantiles(active, "price", {"price_p25_active": 0.25, "median_price_active": 0.5, "price_p75_active": 0.75})
    room = quantiles(active.where(F.col("room_type").isNotNull()), "price", {"median": 0.5}, ["room_type"])
    premium = room.agg(((F.max("median") / F.nullif(F.min("median"), F.lit(0.0)) - 1) * 100).alias("room_type_premium_pct"))
    skew = active.where(F.col("room_type").isNotNull()).groupBy("room_type").agg(F.skewness("price").alias("s"))
    skew = skew.agg(F.min("s").alias("least_room_type_skewness"), F.max("s").alias("largest_room_type_skewness"))
    by_group = active.join(wh.dim_neighbourhood, "neighbourhood_name")
    group = quantiles(by_group, "price", {"median": 0.5}, ["neighbourhood_group"])
    top = market.top_neighbourhoods(wh, min_n=1, digits=digits).limit(1)
    return [_facts(quarters, "prices", quarters.columns), _facts(active.agg(F.avg("price").alias("mean_price_active")), "prices", ["mean_price_active"]),
            _named(room, "prices", "median", "room_type", "median"), _facts(premium, "prices", premium.columns), _facts(skew, "prices", skew.columns),
            _named(group, "areas", "median", "neighbourhood_group", "median"), _named(top, "areas", "top_area_median", "neighbourhood_name", "median_price")]


def _season_facts(wh: Warehouse, cutoff: tuple[int, int]) -> list[DataFrame]:
    """Peak and trough of demand, weekend against weekday."""
    season = seasons.review_seasonality(wh, *cutoff)
    peak = season.orderBy(F.desc("avg_reviews"), F.asc("month")).limit(1).select(F.col("month").alias("peak_month"))
    winter = season.agg(((F.avg(F.when(F.col("month").isin(12, 1), F.col("avg_reviews"))) / F.nullif(F.max("avg_reviews"), F.lit(0.0)) - 1) * 100)
                        .alias("winter_below_peak_pct"))
    booked = seasons.availability_by_month(wh).orderBy(F.asc("pct_available"), F.asc("month")).limit(1).select(F.col("month").alias("peak_booking_month"))
    weekend = seasons.weekend_availability(wh).agg(F.max(F.when(F.col("is_weekend"), F.col("pct_available")) * 100).alias("weekend_available_pct"),
                                                   F.max(F.when(~F.col("is_weekend"), F.col("pct_available")) * 100).alias("weekday_available_pct"))
    weekend = weekend.withColumn("weekend_difference_pp", F.abs(F.col("weekend_available_pct") - F.col("weekday_available_pct")))
    return [_facts(d, "season", d.columns) for d in (peak, winter, booked, weekend)]


def _quality_facts(wh: Warehouse, lp: DataFrame) -> list[DataFrame]:
    """Superhosts against other hosts; price against rating."""
    h = wh.dim_host.join(wh.dim_listing.select("listing_id", "host_id"), "host_id").join(wh.fact_listing_performance, "listing_id")
    flag = F.col("host_is_superhost")
    of = lambda name, c, like: F.avg(F.when(flag == like, F.col(c))).alias(name)
    both = h.agg((F.count_if(flag == "t") * 100.0 / F.count(F.lit(1))).alias("superhost_pct"),
                 of("superhost_rating", "review_scores_rating", "t"), of("other_rating", "review_scores_rating", "f"),
                 of("_rt", "number_of_reviews", "t"), of("_rf", "number_of_reviews", "f"), of("_pt", "price", "t"), of("_pf", "price", "f"))
    both = both.select("superhost_pct", "superhost_rating", "other_rating", (F.col("_rt") / F.nullif(F.col("_rf"), F.lit(0.0))).alias("superhost_reviews_ratio"),
                       (F.col("_pt") / F.nullif(F.col("_pf"), F.lit(0.0))).alias("superhost_price_ratio"))
    r = lp.where((F.col("demand_segment") == "active") & F.col("price_is_valid")).agg(F.corr("price", "review_scores_rating").alias("price_rating_r"))
    return [_facts(both, "hosts", both.columns), _facts(r, "prices", r.columns)]


def _review_facts(wh: Warehouse, scored: DataFrame, pct) -> list[DataFrame]:
    """Reviews, their sentiment, languages and correlation with the scores."""
    mood = scored.agg(F.avg("compound").alias("mean_compound"), pct(F.col("compound") > TX.POSITIVE_CUT).alias("positive_pct"),
                      pct(F.col("compound") < TX.NEGATIVE_CUT).alias("negative_pct"))
    return [_facts(wh.fact_reviews.agg(F.count(F.lit(1)).alias("reviews")), "reviews", ["reviews"]), _facts(mood, "reviews", mood.columns),
            _named(language_mix(scored), "languages", "pct", "language", "pct"), _named(sentiment_vs_scores(scored), "reviews", "sentiment_r", "metric", "r")]


def briefing_facts(wh: Warehouse, cutoff: tuple[int, int], digits: int = 4, scored: DataFrame | None = None) -> DataFrame:
    """The numbers a written market briefing quotes, computed (section, metric,
    value): market structure, licences, prices, areas, season, hosts, reviews
    and languages.  Each is a small aggregate turned on its side; ``scored``
    are the scored reviews, if they are at hand."""
    lp = frames.listing_perf(wh)
    pct = lambda cond: F.count_if(cond) * 100.0 / F.count(F.lit(1))
    scored = score_reviews(review_texts(wh)) if scored is None else scored
    parts = [*_structure_facts(wh, lp, pct), *_price_facts(wh, lp, digits), *_season_facts(wh, cutoff), *_quality_facts(wh, lp),
             *_review_facts(wh, scored, pct)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("value", F.round("value", digits))
