"""Registered amenity similarity queries (§2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.operators import collaborative as CO
from rentlens.operators import similarity as SIM
from rentlens.plans.oracle import q
from rentlens.plans.registry import register, stored, warehouse
from rentlens.sources import roles

D = 4
# query listing: the 6th (by id) room type '1-URGENT' listing priced 150k-250k
# (the reference picked an entire home priced 150-250 the same way)
EXAMPLE = {"room_type": "1-URGENT", "price_range": (150000.0, 250000.0), "position": 5}


def _tokens(spark, sf_dir):
    return SIM.amenity_tokens(SIM.amenity_frame(warehouse(spark, sf_dir)))


def _example_id(tokens) -> int:
    r = SIM.example_query(tokens, EXAMPLE["room_type"], EXAMPLE["price_range"], position=EXAMPLE["position"]).first()
    if r is None:
        raise ValueError("no listing matches the example query")
    return int(r[0])


_BASE = f"""
, af AS (SELECT id AS listing_id, name, neighbourhood_cleansed AS neighbourhood,
                neighbourhood_group_cleansed AS neighbourhood_group, room_type, accommodates, price,
                review_scores_rating, bedrooms, bathrooms
         FROM stg_listings WHERE has_reviews AND price IS NOT NULL AND price > 0),
bm AS (SELECT DISTINCT l_orderkey AS listing_id, 'part ' || CAST(l_partkey AS VARCHAR) AS token
       FROM lineitem WHERE l_orderkey IN (SELECT listing_id FROM af)),
na AS (SELECT l_orderkey AS listing_id, count(*) AS n_amenities FROM lineitem GROUP BY 1),
ex AS (SELECT listing_id FROM af WHERE room_type = '{EXAMPLE["room_type"]}'
         AND price BETWEEN {EXAMPLE["price_range"][0]} AND {EXAMPLE["price_range"][1]}
       ORDER BY listing_id LIMIT 1 OFFSET {EXAMPLE["position"]}),
qt AS (SELECT token FROM bm WHERE listing_id = (SELECT listing_id FROM ex)),
ov AS (SELECT bm.listing_id, count(*) AS overlap FROM bm JOIN qt USING (token) GROUP BY 1),
nt AS (SELECT listing_id, count(*) AS n_tok FROM bm GROUP BY 1),
sc AS (SELECT af.*, na.n_amenities,
              CASE WHEN coalesce(ov.overlap, 0) = 0 THEN 0.0
                   ELSE ov.overlap / sqrt(CAST(nt.n_tok AS DOUBLE) * (SELECT count(*) FROM qt)) END AS s
       FROM af LEFT JOIN ov USING (listing_id) LEFT JOIN nt USING (listing_id) LEFT JOIN na USING (listing_id))
"""


@register("amenity_frame", q(_BASE + "SELECT * FROM af"))
def amenity_frame(spark, sf_dir):
    """Listings with amenities and a positive price (11 columns, raw amenity text dropped)."""
    return SIM.amenity_frame(warehouse(spark, sf_dir)).drop("amenities")


@register("amenity_tokens", q(_BASE + "SELECT listing_id, n_amenities FROM af JOIN na USING (listing_id)"))
def amenity_tokens(spark, sf_dir):
    """Parsed amenity list length per listing (repeats counted)."""
    return _tokens(spark, sf_dir).select("listing_id", "n_amenities")


@register("binary_matrix", q(_BASE + "SELECT listing_id, token FROM bm"))
def binary_matrix(spark, sf_dir):
    """Long form of the listing x amenity 0/1 matrix (repeats collapsed)."""
    return SIM.binary_matrix(_tokens(spark, sf_dir))


@register("amenity_counts", q(_BASE + f"""
SELECT token, count(*) AS n_listings, round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM af), {D}) AS pct_listings
FROM bm GROUP BY token ORDER BY n_listings DESC, token LIMIT 20
"""))
def amenity_counts(spark, sf_dir):
    """Top 20 amenities with the share of listings having them."""
    c = SIM.amenity_counts(_tokens(spark, sf_dir), 20)
    return c.withColumn("pct_listings", F.round("pct_listings", D))


@register("amenity_summary", q(_BASE + f"""
, t AS (SELECT na.n_amenities AS c FROM af JOIN na USING (listing_id))
SELECT count(*) AS n, round(avg(c), {D}) AS mean, round(stddev_samp(c), {D}) AS std, min(c) AS min,
       round(quantile_cont(c, 0.25), {D}) AS p25, round(quantile_cont(c, 0.5), {D}) AS p50,
       round(quantile_cont(c, 0.75), {D}) AS p75, max(c) AS max, (SELECT count(DISTINCT token) FROM bm) AS n_tokens
FROM t
"""))
def amenity_summary(spark, sf_dir):
    """Describe of amenity list length and the number of distinct amenities."""
    s = SIM.amenity_summary(_tokens(spark, sf_dir))
    return s.select(*[F.round(c, D).alias(c) if c in ("mean", "std", "p25", "p50", "p75") else F.col(c)
                      for c in s.columns])


@register("example_queries", q(_BASE + "SELECT listing_id FROM ex"))
def example_queries(spark, sf_dir):
    """Reproducible query listing by room type and price range."""
    t = _tokens(spark, sf_dir)
    return SIM.example_query(t, EXAMPLE["room_type"], EXAMPLE["price_range"], position=EXAMPLE["position"])


@register("cosine_pairs", q(_BASE + f"SELECT listing_id, round(s, {D}) AS similarity_score FROM sc"))
def cosine_pairs(spark, sf_dir):
    """Row of the cosine matrix for the query listing: its similarity to every listing (itself: 1)."""
    t = _tokens(spark, sf_dir)
    r = SIM.similarity_row(t, _example_id(t))
    return r.withColumn("similarity_score", F.round("similarity_score", D))


@register("recommend_similar", q(_BASE + f"""
SELECT listing_id, substr(name, 1, 60) AS name, neighbourhood, room_type, CAST(accommodates AS INTEGER) AS accommodates,
       price, review_scores_rating AS rating, n_amenities, round(s, {D}) AS similarity_score
FROM sc WHERE listing_id <> (SELECT listing_id FROM ex) ORDER BY s DESC, listing_id LIMIT 5
"""))
def recommend_similar(spark, sf_dir):
    """Top 5 listings most similar to the query listing by amenities."""
    t = _tokens(spark, sf_dir)
    return SIM.recommend_similar(t, _example_id(t), n=5, digits=D)


@register("recommend_other_area", q(_BASE + f"""
SELECT listing_id, substr(name, 1, 60) AS name, neighbourhood, room_type, CAST(accommodates AS INTEGER) AS accommodates,
       price, review_scores_rating AS rating, n_amenities, round(s, {D}) AS similarity_score
FROM sc WHERE listing_id <> (SELECT listing_id FROM ex)
  AND neighbourhood IS DISTINCT FROM (SELECT neighbourhood FROM af WHERE listing_id = (SELECT listing_id FROM ex))
ORDER BY s DESC, listing_id LIMIT 5
"""))
def recommend_other_area(spark, sf_dir):
    """Top 5 similar listings outside the query listing's area."""
    t = _tokens(spark, sf_dir)
    return SIM.recommend_similar(t, _example_id(t), n=5, exclude_same_neighbourhood=True, digits=D)


@register("describe_listing", q(_BASE + """
, al AS (SELECT string_agg('part ' || CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_partkey) AS t
         FROM lineitem WHERE l_orderkey = (SELECT listing_id FROM ex))
SELECT listing_id, printf('#%d %s', listing_id, substr(name, 1, 70)) AS title,
       printf('%s, %s', neighbourhood, neighbourhood_group) AS area, printf('%s for %d', room_type, accommodates) AS room,
       printf('%.2f a night, rated %s', price, coalesce(CAST(review_scores_rating AS VARCHAR), '-')) AS price_line,
       printf('%d amenities, such as %s', n_amenities, substr(t, 1, 120)) AS amenities_line
FROM af JOIN na USING (listing_id), al WHERE listing_id = (SELECT listing_id FROM ex)
"""))
def describe_listing(spark, sf_dir):
    """Display lines describing the query listing."""
    t = _tokens(spark, sf_dir)
    return SIM.describe_listing(t, _example_id(t))


_MATCHES = _BASE + """
, pr AS (SELECT x.listing_id, max(x.k / sqrt(CAST(p.n_tok AS DOUBLE) * r.n_tok)) AS s
         FROM (SELECT l.listing_id, o.listing_id AS other, count(*) AS k FROM bm l JOIN bm o ON l.token = o.token AND l.listing_id <> o.listing_id
               GROUP BY ALL) x JOIN nt p ON p.listing_id = x.listing_id JOIN nt r ON r.listing_id = x.other GROUP BY x.listing_id),
best AS (SELECT af.listing_id, coalesce(pr.s, 0) AS best_score FROM af LEFT JOIN pr USING (listing_id))
"""


def _matches(spark, sf_dir):
    return stored(spark, sf_dir, "best-matches", lambda: SIM.best_matches(_tokens(spark, sf_dir)))


@register("best_matches", q(_MATCHES + f"SELECT listing_id, round(best_score, {D}) AS best_score FROM best"))
def best_matches(spark, sf_dir):
    """Best cosine similarity of every listing with another one."""
    return _matches(spark, sf_dir).withColumn("best_score", F.round("best_score", D))


@register("best_match_stats", q(_MATCHES + f"""
SELECT count(*) AS n, round(avg(best_score), {D}) AS mean, round(stddev_samp(best_score), {D}) AS std, round(min(best_score), {D}) AS min,
       round(max(best_score), {D}) AS max, round(count(*) FILTER (WHERE best_score < 0.5 - 1e-12) * 100.0 / count(*), {D}) AS pct_below_half,
       round(quantile_cont(best_score, 0.25), {D}) AS p25, round(quantile_cont(best_score, 0.5), {D}) AS p50, round(quantile_cont(best_score, 0.75), {D}) AS p75
FROM best
"""))
def best_match_stats(spark, sf_dir):
    """Describe of the best match scores and the share of listings without a match of 0.5."""
    s = SIM.best_match_stats(_matches(spark, sf_dir))
    return s.select(*[F.col(c) if c == "n" else F.round(c, D).alias(c) for c in s.columns])


@register("best_match_histogram", q(_MATCHES + """
, e AS (SELECT min(best_score) AS lo, max(best_score) AS hi FROM best)
SELECT CAST(CASE WHEN hi > lo THEN least(floor((best_score - lo) / ((hi - lo) / 50)), 49) ELSE 0 END AS INTEGER) AS bin, count(*) AS n_listings
FROM best, e GROUP BY 1
"""))
def best_match_histogram(spark, sf_dir):
    """Listings per 50th of the range of best match scores."""
    return SIM.best_match_histogram(_matches(spark, sf_dir))


# --- collaborative (§2.12) -----------------------------------------------------------

def _stays(spark, sf_dir):
    return CO.interactions(roles.stays(roles.DriverTables(spark, sf_dir)))


_COLLAB = _BASE + """
, it AS (SELECT DISTINCT l_suppkey AS guest, l_orderkey AS listing_id FROM lineitem),
ng AS (SELECT listing_id, count(*) AS n_guests FROM it GROUP BY 1),
sh AS (SELECT listing_id, count(*) AS k FROM it WHERE guest IN (SELECT guest FROM it WHERE listing_id = (SELECT listing_id FROM ex)) GROUP BY 1),
co AS (SELECT ng.listing_id, n_guests, coalesce(k, 0) AS overlap,
              coalesce(k, 0) / sqrt(CAST(n_guests AS DOUBLE) * (SELECT n_guests FROM ng WHERE listing_id = (SELECT listing_id FROM ex))) AS c
       FROM ng LEFT JOIN sh USING (listing_id))
"""


@register("co_review_similarity", q(_COLLAB + f"SELECT listing_id, n_guests, overlap, round(c, {D}) AS similarity_score FROM co"))
def co_review_similarity(spark, sf_dir):
    """Cosine of the guests of the query listing and of every listing with guests."""
    r = CO.co_review_similarity(_stays(spark, sf_dir), _example_id(_tokens(spark, sf_dir)))
    return r.withColumn("similarity_score", F.round("similarity_score", D))


@register("hybrid_score", q(_COLLAB + f"""
, hy AS (SELECT listing_id, coalesce(s, 0) AS s_content, coalesce(c, 0) AS s_collab,
                CAST({CO.HALF_WEIGHT_REVIEWS} AS DOUBLE) / ({CO.HALF_WEIGHT_REVIEWS} + coalesce(number_of_reviews, 0)) AS alpha
         FROM (SELECT listing_id, s FROM sc) FULL JOIN (SELECT listing_id, c FROM co) USING (listing_id)
         LEFT JOIN fact_listing_performance USING (listing_id))
SELECT listing_id, round(s_content, {D}) AS s_content, round(s_collab, {D}) AS s_collab, round(alpha, {D}) AS alpha,
       round(alpha * s_content + (1 - alpha) * s_collab, {D}) AS s_final FROM hy
"""))
def hybrid_score(spark, sf_dir):
    """Content and collaborative similarity to the query listing, blended by the number of reviews, for every listing."""
    t = _tokens(spark, sf_dir)
    of = _example_id(t)
    reviews = warehouse(spark, sf_dir).fact_listing_performance.select("listing_id", "number_of_reviews")
    h = CO.hybrid_score(SIM.similarity_row(t, of), CO.co_review_similarity(_stays(spark, sf_dir), of), reviews)
    return h.select("listing_id", *[F.round(c, D).alias(c) for c in ("s_content", "s_collab", "alpha", "s_final")])


@register("popularity_hit_rate", f"""
WITH it AS (SELECT DISTINCT l_suppkey AS guest, l_orderkey AS listing_id FROM lineitem),
nb AS (SELECT *, count(*) OVER (PARTITION BY guest) AS n,
              row_number() OVER (PARTITION BY guest ORDER BY md5(concat_ws(':', guest, listing_id, '{CO.SEED}')), listing_id) AS nth FROM it),
held AS (SELECT guest, listing_id FROM nb WHERE n > 1 AND nth = 1),
train AS (SELECT guest, listing_id FROM nb WHERE NOT (n > 1 AND nth = 1)),
pop AS (SELECT i.listing_id, coalesce(t.n, 0) AS n FROM (SELECT DISTINCT listing_id FROM it) i
        LEFT JOIN (SELECT listing_id, count(*) AS n FROM train GROUP BY 1) t USING (listing_id)),
hp AS (SELECT held.guest, pop.n FROM held JOIN pop USING (listing_id)),
every AS (SELECT hp.guest, count(*) FILTER (WHERE pop.n > hp.n) AS better FROM hp, pop GROUP BY 1),
own AS (SELECT hp.guest, count(*) AS better FROM hp JOIN train USING (guest) JOIN pop USING (listing_id) WHERE pop.n > hp.n GROUP BY 1),
rk AS (SELECT e.guest, e.better - coalesce(own.better, 0) + 1 AS rank FROM every e LEFT JOIN own USING (guest))
SELECT count(*) AS n_guests, count(*) FILTER (WHERE rank <= 100) AS hits,
       round(count(*) FILTER (WHERE rank <= 100) / CAST(count(*) AS DOUBLE), {D}) AS hit_rate, round(avg(1.0::DOUBLE / rank), 6) AS mrr FROM rk
""")
def popularity_hit_rate(spark, sf_dir):
    """Leave one out: is the held-out listing of each guest among the 100 most popular ones that are new to the guest."""
    inter = _stays(spark, sf_dir)
    r = CO.hit_rate(CO.popularity_ranks(inter, *CO.hold_out(inter)), 100)
    return r.withColumns({"hit_rate": F.round("hit_rate", D), "mrr": F.round("mrr", 6)})


@register("leave_one_out_hit_rate")
def leave_one_out_hit_rate(spark, sf_dir):
    """Leave one out over every guest and every listing: hit rate in the first 10 and mean reciprocal rank, factor model and popularity."""
    return CO.leave_one_out_hit_rate(_stays(spark, sf_dir))
