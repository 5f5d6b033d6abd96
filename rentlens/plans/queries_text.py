"""Registered text queries (§2.9) and licence text rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.functions import text as TX
from rentlens.operators import hosts, language, text
from rentlens.plans.oracle import q
from rentlens.plans.registry import register, stored, warehouse
from rentlens.sources import roles

D = 4


def _r(df, cols):
    return df.select(*[F.round(c, D).alias(c) if c in cols else F.col(c) for c in df.columns])


def _scored(spark, sf_dir):
    """Scored reviews without their texts, stored once per state of the source tables and shared by the queries."""
    wh = warehouse(spark, sf_dir)
    return stored(spark, sf_dir, "reviews-in-context", lambda: text.score_reviews(text.review_texts(wh)).drop("comments"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_LEX = ", ".join(f"({_sql_str(w)}, CAST({v} AS DOUBLE))" for w, v in sorted(TX.SENTIMENT_WEIGHTS.items()))
_LIST = {name: ", ".join(map(_sql_str, words)) for name, words in (
    ("neg", TX.NEGATIONS), ("boost", TX.BOOSTERS), ("damp", TX.DAMPENERS), ("contrast", TX.CONTRASTS))}
_LAGS = ", ".join(f"lag(t, {k}) OVER upto AS t{k}" for k in range(1, len(TX.BOOST_BY_DISTANCE) + 1))
_CLEAR = ["".join(f" AND t{j} NOT IN ({_LIST['contrast']})" for j in range(1, k + 1)) for k in range(1, len(TX.BOOST_BY_DISTANCE) + 1)]
_NEGATED = " OR ".join(f"coalesce(t{k} IN ({_LIST['neg']}){clear}, false)" for k, clear in enumerate(_CLEAR, 1))
_BOOST = " + ".join(f"CASE WHEN t{k} IN ({_LIST['boost']}){clear} THEN {x} WHEN t{k} IN ({_LIST['damp']}){clear} THEN -{x} ELSE 0 END::DOUBLE"
                    for k, (x, clear) in enumerate(zip(TX.BOOST_BY_DISTANCE, _CLEAR, strict=True), 1))
_SIGNS, _PLAIN = _sql_str(TX.PARTING + TX.APOSTROPHE), _sql_str(" " * len(TX.PARTING) + "'")
_LANG_VOTES = ", ".join(
    f"len(list_filter(toks, lambda x: list_contains([{', '.join(_sql_str(w) for w in TX.LANGUAGE_WORDS[lang])}], x))) AS v_{lang}"
    for lang in TX.LANGUAGE_ORDER)
_BEST = "greatest(" + ", ".join(f"v_{lang}" for lang in TX.LANGUAGE_ORDER) + ")"
_PICK = "CASE " + " ".join(f"WHEN v_{lang} = {_BEST} THEN '{lang}'" for lang in TX.LANGUAGE_ORDER) + " END"

# Review text -> words and end marks -> weights (unnest + join + windows), an
# independent formulation of the array pass.
SCORED_SQL = f"""
, rr AS (SELECT r.review_id, r.listing_id, r.comment_length, f.review_scores_rating, f.review_scores_cleanliness,
                f.review_scores_location, f.review_scores_value, f.price
         FROM fact_reviews r JOIN fact_listing_performance f ON r.listing_id = f.listing_id
         WHERE f.review_scores_rating IS NOT NULL),
rt AS (SELECT rr.*, s.comments FROM rr JOIN (SELECT id AS review_id, comments FROM stg_reviews) s USING (review_id)),
bd AS (SELECT review_id, translate(replace(replace(coalesce(comments, ''), '<br/>', ' '), '<br>', ' '), {_SIGNS}, {_PLAIN}) AS body FROM rt),
tk AS (SELECT review_id, trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS clean, regexp_matches(body, '[a-z]') AS has_small,
              regexp_extract_all(body, '[A-Za-z''\\x{{80}}-\\x{{10FFFF}}]+|[.!?]+') AS marks FROM bd),
ut AS (SELECT review_id, has_small, unnest(marks) AS x, generate_subscripts(marks, 1) AS i FROM tk),
um AS (SELECT *, lower(x) AS t, regexp_matches(x, '^[.!?]') AS is_end FROM ut),
us AS (SELECT *, coalesce(sum(CAST(is_end AS INTEGER)) OVER (PARTITION BY review_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sen FROM um),
uw AS (SELECT *, {_LAGS}, max(i) FILTER (WHERE t IN ({_LIST['contrast']})) OVER whole AS turn,
              coalesce(max(length(x) - length(replace(x, '!', ''))) FILTER (WHERE is_end) OVER whole, 0) AS bangs
       FROM us WINDOW upto AS (PARTITION BY review_id, sen ORDER BY i), whole AS (PARTITION BY review_id, sen)),
lex(w, v) AS (VALUES {_LEX}),
wt AS (SELECT uw.review_id, coalesce(lex.v, 0.0::DOUBLE)
              * CASE WHEN {_NEGATED} THEN CAST({TX.NEGATION_SCALE} AS DOUBLE) ELSE 1.0::DOUBLE END
              * (1.0::DOUBLE + {_BOOST})
              * CASE WHEN turn IS NULL THEN 1.0 WHEN i < turn THEN {TX.BEFORE_CONTRAST} ELSE {TX.AFTER_CONTRAST} END::DOUBLE
              * CASE WHEN has_small AND x = upper(x) THEN {TX.CAPITALS_SCALE} ELSE 1.0 END::DOUBLE
              * (1.0::DOUBLE + {TX.BANG_STEP}::DOUBLE * least(bangs, {TX.MOST_BANGS})) AS v
       FROM uw LEFT JOIN lex ON uw.t = lex.w WHERE NOT is_end),
ag AS (SELECT review_id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS ps,
              sum(CASE WHEN v < 0 THEN v - 1 ELSE 0 END) AS ns, count(*) FILTER (WHERE v = 0) AS nu
       FROM wt GROUP BY review_id),
sc AS (SELECT tk.review_id, coalesce(s, 0.0) AS s, coalesce(ps, 0.0) AS ps, coalesce(ns, 0.0) AS ns,
              CAST(coalesce(nu, 0) AS DOUBLE) AS nu, clean, {_LANG_VOTES}
       FROM (SELECT *, list_transform(marks, lambda x: lower(x)) AS toks FROM tk) AS tk LEFT JOIN ag USING (review_id)),
scored AS (
  SELECT rt.*,
         CASE WHEN ps + abs(ns) + nu > 0 THEN abs(ns / (ps + abs(ns) + nu)) ELSE 0.0 END AS neg,
         CASE WHEN ps + abs(ns) + nu > 0 THEN abs(nu / (ps + abs(ns) + nu)) ELSE 0.0 END AS neu,
         CASE WHEN ps + abs(ns) + nu > 0 THEN abs(ps / (ps + abs(ns) + nu)) ELSE 0.0 END AS pos,
         CASE WHEN s = 0 THEN 0.0 ELSE s / sqrt(s * s + {TX.ALPHA}) END AS compound,
         CASE WHEN length(clean) < {TX.MIN_LANG_CHARS} OR {_BEST} = 0 THEN 'unknown' ELSE {_PICK} END AS language
  FROM rt JOIN sc USING (review_id))
"""


@register("semi_join_ids", q("""
, ids AS (SELECT r.review_id FROM fact_reviews r JOIN fact_listing_performance f ON r.listing_id = f.listing_id
          WHERE f.review_scores_rating IS NOT NULL)
SELECT id, listing_id, reviewer_id, comment_length FROM stg_reviews WHERE id IN (SELECT review_id FROM ids)
"""))
def semi_join_ids(spark, sf_dir):
    """Review rows whose id is among the rated-listing reviews (left semi join)."""
    wh = warehouse(spark, sf_dir)
    return text.semi_join_ids(wh.review_rows, text.rated_reviews(wh)).select(
        "id", "listing_id", "reviewer_id", "comment_length")


@register("merge_text", q(SCORED_SQL + "SELECT review_id, listing_id, comment_length, comments FROM rt"))
def merge_text(spark, sf_dir):
    """Rated-listing reviews joined to their text by review id."""
    return text.review_texts(warehouse(spark, sf_dir)).select("review_id", "listing_id", "comment_length", "comments")


@register("review_sentiment", q(SCORED_SQL + f"""
SELECT review_id, listing_id, round(neg, {D}) AS neg, round(neu, {D}) AS neu, round(pos, {D}) AS pos,
       round(compound, {D}) AS compound FROM scored
"""))
def review_sentiment(spark, sf_dir):
    """Per-review neg / neu / pos / compound from the word-weight table (whole texts)."""
    s = _scored(spark, sf_dir).select("review_id", "listing_id", "neg", "neu", "pos", "compound")
    return _r(s, ("neg", "neu", "pos", "compound"))


@register("sentiment_distribution", q(SCORED_SQL + f"""
SELECT count(*) AS n, round(avg(compound), {D}) AS mean, round(stddev_samp(compound), {D}) AS std,
       round(min(compound), {D}) AS min, round(quantile_cont(compound, 0.25), {D}) AS p25,
       round(quantile_cont(compound, 0.5), {D}) AS p50, round(quantile_cont(compound, 0.75), {D}) AS p75,
       round(max(compound), {D}) AS max,
       count(*) FILTER (WHERE compound > {TX.POSITIVE_CUT}) AS n_positive,
       count(*) FILTER (WHERE compound >= {TX.NEGATIVE_CUT} AND compound <= {TX.POSITIVE_CUT}) AS n_neutral,
       count(*) FILTER (WHERE compound < {TX.NEGATIVE_CUT}) AS n_negative,
       round(CAST(count(*) FILTER (WHERE compound > {TX.POSITIVE_CUT}) AS DOUBLE) * 100 / count(*), {D}) AS pct_positive,
       round(CAST(count(*) FILTER (WHERE compound < {TX.NEGATIVE_CUT}) AS DOUBLE) * 100 / count(*), {D}) AS pct_negative
FROM scored
"""))
def sentiment_distribution(spark, sf_dir):
    """Describe of the compound score; counts and shares positive / neutral / negative."""
    d = text.sentiment_distribution(_scored(spark, sf_dir))
    return _r(d, ("mean", "std", "min", "p25", "p50", "p75", "max", "pct_positive", "pct_negative"))


@register("zero_sentiment_sample", q(SCORED_SQL + """
SELECT review_id, substr(comments, 1, 200) AS comments FROM scored WHERE compound = 0 ORDER BY review_id LIMIT 10
"""))
def zero_sentiment_sample(spark, sf_dir):
    """Ten reviews (by id) whose compound score is exactly 0."""
    zero = _scored(spark, sf_dir).where(F.col("compound") == 0).orderBy("review_id").limit(10)
    return text.zero_sentiment_sample(text.merge_text(zero, warehouse(spark, sf_dir)))


@register("detect_language", q(SCORED_SQL + "SELECT review_id, language FROM scored"))
def detect_language(spark, sf_dir):
    """Language of every review by function-word votes ('unknown' when short or no votes)."""
    return _scored(spark, sf_dir).select("review_id", "language")


@register("language_mix", q(SCORED_SQL + f"""
SELECT language, count(*) AS n, round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), {D}) AS pct
FROM scored GROUP BY language ORDER BY n DESC, language LIMIT 15
"""))
def language_mix(spark, sf_dir):
    """Top 15 languages with share of reviews."""
    return _r(text.language_mix(_scored(spark, sf_dir)), ("pct",))


@register("language_other_bucket", q(SCORED_SQL + """
, g AS (SELECT language AS value, count(*) AS n FROM scored GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS rk FROM g)
SELECT CASE WHEN rk <= 6 THEN value ELSE 'other' END AS value, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1
"""))
def language_other_bucket(spark, sf_dir):
    """Six most common languages, the rest as 'other'."""
    from rentlens.operators.market import other_bucket
    return other_bucket(_scored(spark, sf_dir), "language", keep=6)


@register("language_accuracy", q(f"""
, tk AS (SELECT lang AS language_true,
                regexp_replace(replace(replace(coalesce(text, ''), '<br/>', ' '), '<br>', ' '), '^\\s+|\\s+$', '', 'g') AS clean,
                list_filter(regexp_split_to_array(lower(replace(replace(replace(coalesce(text, ''), '<br/>', ' '), '<br>', ' '),
                                                                '’', '''')), '[^\\p{{L}}'']+'), lambda x: x <> '') AS toks
         FROM documents),
v AS (SELECT language_true, clean, {_LANG_VOTES} FROM tk),
d AS (SELECT language_true, CASE WHEN length(clean) < {TX.MIN_LANG_CHARS} OR {_BEST} = 0 THEN 'unknown' ELSE {_PICK} END AS language
      FROM v)
SELECT language_true, count(*) AS n, count(*) FILTER (WHERE language = language_true) AS n_correct,
       count(*) FILTER (WHERE language = 'unknown') AS n_unknown
FROM d GROUP BY language_true
"""))
def language_accuracy(spark, sf_dir):
    """Detected language against the known language of every document (whole texts)."""
    return text.language_accuracy(roles.review_text(roles.DriverTables(spark, sf_dir)))


def _labelled(spark, sf_dir):
    return roles.review_text(roles.DriverTables(spark, sf_dir)).withColumnRenamed("language_true", "language")


@register("language_model_accuracy")
def language_model_accuracy(spark, sf_dir):
    """Character n-gram model: right and unknown ones of the documents held out of its training, by language."""
    docs = _labelled(spark, sf_dir)
    out = language.held_out(F.col("review_id"))
    return language.accuracy(language.fit(docs.where(~out)), docs.where(out))


@register("detect_language_ngrams")
def detect_language_ngrams(spark, sf_dir):
    """Language of every review by the character n-gram model of the labelled documents."""
    model = language.fit(_labelled(spark, sf_dir))
    return text.review_texts(warehouse(spark, sf_dir)).select("review_id", language.detect(model, F.col("comments")).alias("language"))


@register("sentiment_vs_scores", q(SCORED_SQL + f"""
, e AS (SELECT * FROM scored WHERE language = 'en')
SELECT * FROM (
  SELECT (SELECT count(*) FROM e) AS n, 'review_scores_rating' AS metric, round(corr(compound, review_scores_rating), {D}) AS r FROM e
  UNION ALL SELECT (SELECT count(*) FROM e), 'review_scores_cleanliness', round(corr(compound, review_scores_cleanliness), {D}) FROM e
  UNION ALL SELECT (SELECT count(*) FROM e), 'review_scores_location', round(corr(compound, review_scores_location), {D}) FROM e
  UNION ALL SELECT (SELECT count(*) FROM e), 'review_scores_value', round(corr(compound, review_scores_value), {D}) FROM e
  UNION ALL SELECT (SELECT count(*) FROM e), 'comment_length', round(corr(compound, CAST(comment_length AS DOUBLE)), {D}) FROM e)
"""))
def sentiment_vs_scores(spark, sf_dir):
    """English reviews: correlation of compound score with ratings and length."""
    return _r(text.sentiment_vs_scores(_scored(spark, sf_dir)), ("r",))


@register("sentiment_by_bucket", q(SCORED_SQL + f"""
, b AS (SELECT *, CASE WHEN review_scores_rating > 0 AND review_scores_rating <= 4.0 THEN '<4.0'
                       WHEN review_scores_rating > 4.0 AND review_scores_rating <= 4.5 THEN '4.0-4.5'
                       WHEN review_scores_rating > 4.5 AND review_scores_rating <= 4.8 THEN '4.5-4.8'
                       WHEN review_scores_rating > 4.8 AND review_scores_rating <= 5.01 THEN '4.8-5.0' END AS score_bucket
        FROM scored WHERE language = 'en')
SELECT score_bucket, count(*) AS n, round(median(compound), {D}) AS median_compound
FROM b WHERE score_bucket IS NOT NULL GROUP BY score_bucket
"""))
def sentiment_by_bucket(spark, sf_dir):
    """English reviews: median compound per right-closed rating bucket."""
    return _r(text.sentiment_by_bucket(_scored(spark, sf_dir)), ("median_compound",))


@register("sentiment_trend", q(SCORED_SQL + f"""
SELECT round(regr_slope(review_scores_rating, compound), {D}) AS slope,
       round(regr_intercept(review_scores_rating, compound), {D}) AS intercept
FROM scored WHERE language = 'en'
"""))
def sentiment_trend(spark, sf_dir):
    """English reviews: least-squares line of rating on compound score."""
    return _r(text.sentiment_trend(_scored(spark, sf_dir)), ("slope", "intercept"))


CUTOFF = (2024, 1)  # last complete month of the review stand-in
_PCT = lambda cond: f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) * 100 / count(*)"
_SEG = lambda name: "demand_segment = " + _sql_str(name)
_ACT = "FROM lp WHERE demand_segment = 'active' AND price_is_valid"
_NO_LICENCE = "license IS NULL OR license = ''"
_EXEMPT = "NOT (license IS NULL OR license = '' OR regexp_matches(license, 'HUTB-?[0-9]+')) AND contains(license, 'Exempt')"
_AVG = lambda c, like: f"avg({c}) FILTER (WHERE host_is_superhost = '{like}')"
_FACTS = {
    ("demand", "listings"): "SELECT count(*) FROM lp", ("demand", "active_listings"): f"SELECT count(*) FROM lp WHERE {_SEG('active')}",
    ("demand", "pct_active"): f"SELECT {_PCT(_SEG('active'))} FROM lp", ("demand", "pct_never_active"): f"SELECT {_PCT(_SEG('never_active'))} FROM lp",
    ("demand", "pct_dormant"): f"SELECT {_PCT(_SEG('dormant_with_history'))} FROM lp",
    ("demand", "zero_occupancy_pct"): f"SELECT {_PCT('estimated_occupancy_l365d = 0')} FROM stg_listings",
    **{("prices", m): f"SELECT quantile_cont(price, {p}) {_ACT}"
       for m, p in (("price_p25_active", 0.25), ("median_price_active", 0.5), ("price_p75_active", 0.75))},
    ("prices", "mean_price_active"): f"SELECT avg(price) {_ACT}",
    ("prices", "room_type_premium_pct"): "SELECT (max(m) / min(m) - 1) * 100 FROM rt_price",
    ("prices", "least_room_type_skewness"): "SELECT min(skew) FROM rt_price", ("prices", "largest_room_type_skewness"): "SELECT max(skew) FROM rt_price",
    ("prices", "price_rating_r"): f"SELECT corr(price, review_scores_rating) {_ACT}",
    **{("hosts", f"top_{k}_hosts_pct"): f"SELECT (SELECT sum(n) FROM (SELECT n FROM hp ORDER BY n DESC LIMIT {k})) * 100.0 / sum(n) FROM hp" for k in (10, 500)},
    ("hosts", "top_500_of_hosts_pct"): "SELECT least(500, count(*)) * 100.0 / count(*) FROM hp", ("hosts", "hosts"): "SELECT count(*) FROM hp",
    ("hosts", "single_of_hosts_pct"): f"SELECT {_PCT('n = 1')} FROM hp",
    ("hosts", "single_hosts_pct"): "SELECT count(*) FILTER (WHERE n = 1) * 100.0 / sum(n) FROM hp",
    ("hosts", "largest_host_listings"): "SELECT max(n) FROM hp", ("hosts", "largest_host_pct"): "SELECT max(n) * 100.0 / sum(n) FROM hp",
    ("hosts", "superhost_pct"): "SELECT 100.0 * avg(CASE WHEN host_is_superhost = 't' THEN 1 ELSE 0 END) FROM stg_listings",
    ("hosts", "superhost_rating"): f"SELECT {_AVG('review_scores_rating', 't')} FROM stg_listings",
    ("hosts", "other_rating"): f"SELECT {_AVG('review_scores_rating', 'f')} FROM stg_listings",
    ("hosts", "superhost_reviews_ratio"): f"SELECT {_AVG('number_of_reviews', 't')} / {_AVG('number_of_reviews', 'f')} FROM stg_listings",
    ("hosts", "superhost_price_ratio"): f"SELECT {_AVG('price', 't')} / {_AVG('price', 'f')} FROM stg_listings",
    ("licences", "without_licence"): f"SELECT count(*) FROM stg_listings WHERE {_NO_LICENCE}",
    ("licences", "without_licence_pct"): f"SELECT {_PCT(_NO_LICENCE)} FROM stg_listings",
    ("licences", "exempt"): f"SELECT count(*) FROM stg_listings WHERE {_EXEMPT}", ("licences", "exempt_pct"): f"SELECT {_PCT(_EXEMPT)} FROM stg_listings",
    ("licences", "unique_licence_numbers"):
        "SELECT count(DISTINCT nullif(replace(regexp_extract(license, 'HUTB-?[0-9]+', 0), '-', ''), '')) FROM stg_listings",
    ("season", "peak_month"): "SELECT month FROM se ORDER BY v DESC, month LIMIT 1",
    ("season", "winter_below_peak_pct"): "SELECT (avg(v) FILTER (WHERE month IN (12, 1)) / max(v) - 1) * 100 FROM se",
    ("season", "peak_booking_month"): "SELECT m FROM (SELECT month(date) AS m, avg(CAST(available AS INTEGER)) AS a FROM fact_calendar GROUP BY 1) ORDER BY a, m LIMIT 1",
    ("season", "weekend_available_pct"): f"SELECT {_PCT('available')} FROM fact_calendar WHERE dayofweek(date) IN (0, 6)",
    ("season", "weekday_available_pct"): f"SELECT {_PCT('available')} FROM fact_calendar WHERE dayofweek(date) NOT IN (0, 6)",
    ("season", "weekend_difference_pp"): "SELECT abs(100.0 * avg(CAST(available AS INTEGER)) FILTER (WHERE dayofweek(date) IN (0, 6)) "
                                         "- 100.0 * avg(CAST(available AS INTEGER)) FILTER (WHERE dayofweek(date) NOT IN (0, 6))) FROM fact_calendar",
    ("reviews", "reviews"): "SELECT count(*) FROM fact_reviews", ("reviews", "mean_compound"): "SELECT avg(compound) FROM scored",
    ("reviews", "positive_pct"): f"SELECT {_PCT(f'compound > {TX.POSITIVE_CUT}')} FROM scored",
    ("reviews", "negative_pct"): f"SELECT {_PCT(f'compound < {TX.NEGATIVE_CUT}')} FROM scored",
    **{("reviews", f"sentiment_r:{c}"): f"SELECT corr(compound, CAST({c} AS DOUBLE)) FROM scored WHERE language = 'en'"
       for c in (*text.SCORE_COLS, "comment_length")},
}


@register("briefing_facts", q(SCORED_SQL + f"""
, lp AS (SELECT f.listing_id, f.price, f.review_scores_rating, l.price_is_valid, l.room_type, v.demand_segment, l.neighbourhood_name FROM fact_listing_performance f
         JOIN dim_listing l ON f.listing_id = l.listing_id JOIN v_listing_demand v ON f.listing_id = v.listing_id),
hp AS (SELECT h.host_id, h.host_is_superhost, count(*) AS n FROM dim_host h JOIN dim_listing l ON h.host_id = l.host_id GROUP BY 1, 2),
mo AS (SELECT year(date) AS y, month(date) AS month, count(*) AS n FROM fact_reviews GROUP BY 1, 2),
se AS (SELECT month, round_even(avg(n), 0) AS v FROM mo WHERE y < {CUTOFF[0]} OR (y = {CUTOFF[0]} AND month <= {CUTOFF[1]}) GROUP BY month),
rt_m AS (SELECT *, avg(price) OVER (PARTITION BY room_type) AS mu FROM lp WHERE demand_segment = 'active' AND price_is_valid AND room_type IS NOT NULL),
rt_price AS (SELECT room_type, median(price) AS m, avg(pow(price - mu, 3)) / pow(avg(pow(price - mu, 2)), 1.5) AS skew FROM rt_m GROUP BY 1),
facts AS (""" + " UNION ALL ".join(f"SELECT '{a}' AS section, '{b}' AS metric, CAST(({sql}) AS DOUBLE) AS value" for (a, b), sql in _FACTS.items()) + f"""
  UNION ALL SELECT 'prices', 'median:' || room_type, m FROM rt_price
  UNION ALL SELECT 'areas', 'median:' || neighbourhood_group, median(price) FROM lp JOIN dim_neighbourhood USING (neighbourhood_name)
    WHERE demand_segment = 'active' AND price_is_valid GROUP BY neighbourhood_group
  UNION ALL SELECT 'languages', 'pct:' || language, pct FROM (
    SELECT language, count(*) * 100.0 / sum(count(*)) OVER () AS pct, count(*) AS n FROM scored GROUP BY 1 ORDER BY n DESC, language LIMIT 15)
  UNION ALL SELECT section, metric, value FROM (
    SELECT 'areas' AS section, 'top_area_median:' || neighbourhood_name AS metric, median(price) AS value
    FROM lp WHERE demand_segment = 'active' AND price_is_valid AND neighbourhood_name IS NOT NULL
    GROUP BY neighbourhood_name ORDER BY median(price) DESC LIMIT 1))
SELECT section, metric, round(value, {D}) AS value FROM facts
"""))
def briefing_facts(spark, sf_dir):
    """Numbers quoted by the market briefing, computed: (section, metric, value)."""
    return text.briefing_facts(warehouse(spark, sf_dir), CUTOFF, D, _scored(spark, sf_dir))


# --- licence text -------------------------------------------------------------------

def _lic_case(version: int) -> str:
    rules = TX.LICENSE_RULES_V1 if version == 1 else TX.LICENSE_RULES_V2
    parts = ["CASE WHEN license IS NULL OR license = '' THEN 'no_license'"]
    for label, kind, pat in rules:
        cond = f"regexp_matches(license, {_sql_str(pat)})" if kind == "rlike" else f"contains(license, {_sql_str(pat)})"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return " ".join(parts) + " ELSE 'other' END"


@register("license_category", q(f"SELECT {_lic_case(2)} AS license_category, count(*) AS n FROM stg_listings GROUP BY 1"))
def license_category(spark, sf_dir):
    """Licence status by priority rules (v2: dash allowed in the number)."""
    return hosts.license_category(warehouse(spark, sf_dir).stg_listings, 2)


@register("license_category_v1", q(f"SELECT {_lic_case(1)} AS license_category, count(*) AS n FROM stg_listings GROUP BY 1"))
def license_category_v1(spark, sf_dir):
    """Licence status by the first rule set."""
    return hosts.license_category(warehouse(spark, sf_dir).stg_listings, 1)


@register("license_number", q(f"""
, h AS (SELECT nullif(replace(regexp_extract(license, {_sql_str(TX.LICENSE_NUMBER_PATTERN)}, 0), '-', ''), '') AS hutb_number
        FROM stg_listings)
SELECT count(hutb_number) AS listings_with_number, count(DISTINCT hutb_number) AS unique_numbers FROM h
"""))
def license_number(spark, sf_dir):
    """Listings with an extracted, normalised licence number; distinct numbers."""
    return hosts.license_number(warehouse(spark, sf_dir).stg_listings)


@register("license_genuine_v1", q(f"""
SELECT count(DISTINCT license) AS unique_genuine_texts FROM stg_listings WHERE {_lic_case(1)} = 'genuine_hut_number'
"""))
def license_genuine_v1(spark, sf_dir):
    return hosts.license_genuine_v1(warehouse(spark, sf_dir).stg_listings)


@register("license_residual", q(f"""
SELECT id, substr(license, 1, 150) AS license FROM stg_listings
WHERE {_lic_case(2)} = 'other' AND license IS NOT NULL ORDER BY id LIMIT 10
"""))
def license_residual(spark, sf_dir):
    """First ten unclassified licence texts."""
    return hosts.license_residual(warehouse(spark, sf_dir).stg_listings)
