"""Registered source, profiling and cleaning queries (§2.1-§2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.functions import columns as C
from rentlens.operators import cleaning, market, quality
from rentlens.plans.oracle import q
from rentlens.plans.registry import register, warehouse
from rentlens.sources import roles

D = 4
SUSPECT = ["host_since", "host_response_time", "instant_bookable", "calendar_updated"]


def _raw_listings(spark, sf_dir):
    return roles.raw_listings(roles.DriverTables(spark, sf_dir)).drop("_ord")


_RAW_HOSTS = """
, raw AS (SELECT o.o_orderkey AS id, o.o_orderstatus AS status, o.o_orderdate,
                 CASE WHEN o.o_orderstatus = 'F' THEN 'previous scrape' ELSE 'city scrape' END AS source,
                 CASE WHEN o.o_orderstatus = 'F' THEN CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS host_since,
                 CASE WHEN o.o_orderstatus = 'F' THEN 'within an hour' END AS host_response_time,
                 CASE WHEN o.o_orderstatus IN ('F', 'O') THEN 't' END AS instant_bookable,
                 CAST(NULL AS VARCHAR) AS calendar_updated
          FROM orders o)
"""


@register("null_cooccurrence", q(_RAW_HOSTS + """
SELECT count(*) FILTER (WHERE host_since IS NULL AND host_response_time IS NULL AND instant_bookable IS NULL
                        AND calendar_updated IS NULL) AS all_null,
       count(*) FILTER (WHERE host_since IS NULL OR host_response_time IS NULL OR instant_bookable IS NULL
                        OR calendar_updated IS NULL) AS any_null
FROM raw
"""))
def null_cooccurrence(spark, sf_dir):
    """Raw listings where all / any of four sparse columns are empty."""
    return quality.null_cooccurrence(_raw_listings(spark, sf_dir), SUSPECT)


@register("value_counts_by_null", q(_RAW_HOSTS + """
SELECT source, count(*) AS n, count(*) FILTER (WHERE host_since IS NULL) AS n_null FROM raw GROUP BY source
"""))
def value_counts_by_null(spark, sf_dir):
    """Source counts overall and where host_since is empty."""
    return quality.value_counts_by_null(_raw_listings(spark, sf_dir), "source", "host_since")


# Raw listing columns in order: type, and when the stand-in leaves them empty.
_NO_LINES, _NEVER = "NOT has_lines", "false"
RAW_COLUMNS = {
    "id": ("bigint", _NEVER), "name": ("string", _NEVER), "host_id": ("bigint", _NEVER), "host_name": ("string", _NEVER),
    "host_is_superhost": ("string", "c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')"),
    "host_identity_verified": ("string", _NEVER), "host_has_profile_pic": ("string", _NEVER), "host_listings_count": ("double", _NEVER),
    "hosts_time_as_host_years": ("double", "c_acctbal < 0"), "hosts_time_as_user_years": ("double", _NEVER),
    "host_location": ("string", _NEVER), "neighbourhood_cleansed": ("string", _NEVER), "neighbourhood_group_cleansed": ("string", _NEVER),
    "latitude": ("double", _NEVER), "longitude": ("double", _NEVER), "property_type": ("string", _NEVER), "room_type": ("string", _NEVER),
    "accommodates": ("int", _NEVER), "bathrooms": ("double", _NO_LINES), "bedrooms": ("double", "o_orderstatus = 'P'"),
    "beds": ("double", "c_acctbal < 0"), "amenities": ("string", _NO_LINES), "price": ("string", _NEVER),
    "price_quote_price_per_night": ("string", "o_orderstatus <> 'O'"), "price_quote_total_price": ("string", "true"),
    "minimum_nights": ("int", _NO_LINES), "maximum_nights": ("int", _NEVER), "availability_365": ("int", _NEVER),
    "number_of_reviews": ("int", _NEVER), "number_of_reviews_ltm": ("int", _NEVER), "reviews_per_month": ("double", _NO_LINES),
    "review_scores_rating": ("double", _NO_LINES), "review_scores_cleanliness": ("double", _NO_LINES),
    "review_scores_location": ("double", _NO_LINES), "review_scores_value": ("double", _NO_LINES),
    "estimated_occupancy_l365d": ("int", _NEVER), "estimated_revenue_l365d": ("double", _NEVER),
    "calculated_host_listings_count": ("int", _NEVER),
    "license": ("string", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') AND o_orderstatus NOT IN ('F', 'O')"),
    "source": ("string", _NEVER), "last_scraped": ("string", _NEVER), "first_review": ("string", _NO_LINES), "last_review": ("string", _NO_LINES),
    "calendar_last_scraped": ("string", _NEVER), "host_since": ("string", "o_orderstatus <> 'F'"),
    "host_response_time": ("string", "o_orderstatus <> 'F'"), "instant_bookable": ("string", "o_orderstatus NOT IN ('F', 'O')"),
    "calendar_updated": ("string", "true"), "neighborhood_overview": ("string", "true"),
}
_NULLS = ", nulls AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) AS n_rows, count(*) FILTER (WHERE {null}) AS n_null FROM base"
    for c, (t, null) in RAW_COLUMNS.items()) + ")"


@register("null_rate_audit", q(_NULLS + "SELECT column_name, n_null * 100.0::DOUBLE / n_rows AS null_pct FROM nulls"))
def null_rate_audit(spark, sf_dir):
    """Null % of every raw listing column."""
    return quality.null_rate_audit(_raw_listings(spark, sf_dir))


@register("profile_table", q(_NULLS + f"""
SELECT n_rows, column_name, dtype, n_null, 'listings' AS table_name, {len(RAW_COLUMNS)} AS n_columns
FROM nulls ORDER BY n_null DESC, column_name LIMIT 20
"""))
def profile_table(spark, sf_dir):
    """Shape, types and the 20 columns with most nulls of the raw listings."""
    return quality.profile_table(_raw_listings(spark, sf_dir), "listings")


_FRAME_TYPES = {"listing_id": "bigint", "price": "double", "room_type": "string", "property_type": "string", "accommodates": "int",
                "bathrooms": "double", "bedrooms": "double", "beds": "double", "neighbourhood_name": "string", "neighbourhood_group": "string",
                "host_is_superhost": "string", "host_listings_count": "double", "hosts_time_as_host_years": "double", "number_of_reviews": "int",
                "review_scores_rating": "double", "review_scores_cleanliness": "double", "review_scores_location": "double",
                "review_scores_value": "double", "availability_365": "int", "minimum_nights": "int", "estimated_occupancy_l365d": "int",
                "demand_segment": "string"}
_FRAME_NULLS = """
, fr AS (
  SELECT f.*, l.room_type, l.property_type, l.accommodates, l.bathrooms, l.bedrooms, l.beds, l.neighbourhood_name, n.neighbourhood_group,
         h.host_is_superhost, h.host_listings_count, h.hosts_time_as_host_years, v.demand_segment
  FROM fact_listing_performance f JOIN dim_listing l ON f.listing_id = l.listing_id
  JOIN dim_neighbourhood n ON l.neighbourhood_name = n.neighbourhood_name
  JOIN dim_host h ON l.host_id = h.host_id JOIN v_listing_demand v ON f.listing_id = v.listing_id
  WHERE f.price IS NOT NULL AND l.price_is_valid AND v.demand_segment = 'active'),
nulls AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM fr"
                                   for c, t in _FRAME_TYPES.items()) + ")"


@register("frame_null_top", q(_FRAME_NULLS + f"""
SELECT n_rows, column_name, dtype, n_null, 'model_frame' AS table_name, {len(_FRAME_TYPES)} AS n_columns
FROM nulls ORDER BY n_null DESC, column_name LIMIT 15
"""))
def frame_null_top(spark, sf_dir):
    """Null counts of the training frame, top 15."""
    from rentlens.operators import frames
    f = frames.model_frame(warehouse(spark, sf_dir))
    return quality.profile_table(f, "model_frame", top=15)


@register("negative_value_check", q("""
SELECT count(*) FILTER (WHERE price < 0) AS negative_price FROM stg_listings
"""))
def negative_value_check(spark, sf_dir):
    """Listings with a negative price (flagged, kept)."""
    return cleaning.negative_value_check(warehouse(spark, sf_dir).stg_listings, ["price"])


@register("negative_nights_check", q("""
SELECT count(*) FILTER (WHERE minimum_nights < 0) AS negative_minimum_nights,
       count(*) FILTER (WHERE maximum_nights < 0) AS negative_maximum_nights FROM stg_calendar
"""))
def negative_nights_check(spark, sf_dir):
    """Calendar rows with negative minimum / maximum nights (kept)."""
    return cleaning.negative_value_check(warehouse(spark, sf_dir).stg_calendar, ["minimum_nights", "maximum_nights"])


@register("geo_bounds_check", q("SELECT count(*) FILTER (WHERE NOT location_is_valid) AS n_outside FROM stg_listings"))
def geo_bounds_check(spark, sf_dir):
    """Listings outside the coordinate box."""
    return quality.geo_bounds_check(warehouse(spark, sf_dir).stg_listings)


@register("calendar_coverage", q("""
SELECT count(DISTINCT listing_id) AS n_listings, CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date
FROM stg_calendar
"""))
def calendar_coverage(spark, sf_dir):
    """Distinct listings and date range of the calendar."""
    c = cleaning.calendar_coverage(warehouse(spark, sf_dir).stg_calendar)
    return c.select("n_listings", F.col("min_date").cast("string"), F.col("max_date").cast("string"))


@register("orphan_keys", q("""
, ids AS (SELECT DISTINCT listing_id FROM stg_reviews)
SELECT count(*) AS n_orphans FROM ids
WHERE listing_id NOT IN (SELECT id FROM stg_listings WHERE property_type <> 'P')
"""))
def orphan_keys(spark, sf_dir):
    """Distinct review listing ids absent from the listings (listing universe
    restricted to non-'P' listings: the stand-in data has no orphans)."""
    wh = warehouse(spark, sf_dir)
    return cleaning.orphan_keys(wh.review_rows, wh.stg_listings.where(F.col("property_type") != "P"))


@register("anti_join_orphans", q("""
SELECT DISTINCT listing_id FROM stg_reviews WHERE listing_id NOT IN (SELECT id FROM stg_listings WHERE property_type <> 'P')
"""))
def anti_join_orphans(spark, sf_dir):
    """The orphan review listing ids themselves (left anti join)."""
    wh = warehouse(spark, sf_dir)
    ids = wh.review_rows.select("listing_id").distinct()
    lst = wh.stg_listings.where(F.col("property_type") != "P").select(F.col("id").alias("listing_id"))
    return ids.join(lst, "listing_id", "left_anti")


@register("short_text_check", q("SELECT count(*) FILTER (WHERE comment_length < 10) AS n_short FROM stg_reviews"))
def short_text_check(spark, sf_dir):
    """Reviews under 10 characters."""
    return cleaning.short_text_check(warehouse(spark, sf_dir).review_rows)


@register("clean_listings", q("""
SELECT id, price, price_quote_price_per_night, price_is_valid, location_is_valid, has_reviews, room_type, property_type,
       CAST(first_review AS VARCHAR) AS first_review, CAST(last_review AS VARCHAR) AS last_review
FROM stg_listings
"""))
def clean_listings(spark, sf_dir):
    """Cleaned listings: parsed prices, flags, trimmed categories, parsed dates, first row per id."""
    s = warehouse(spark, sf_dir).stg_listings
    return s.select("id", "price", "price_quote_price_per_night", "price_is_valid", "location_is_valid", "has_reviews",
                    "room_type", "property_type", F.col("first_review").cast("string"),
                    F.col("last_review").cast("string"))


@register("clean_calendar", q("""
SELECT listing_id, CAST(date AS VARCHAR) AS date, available, minimum_nights, maximum_nights FROM stg_calendar
"""))
def clean_calendar(spark, sf_dir):
    """Cleaned calendar: parsed date, t/f to boolean, first row per (listing, date)."""
    s = warehouse(spark, sf_dir).stg_calendar
    return s.select("listing_id", F.col("date").cast("string"), "available", "minimum_nights", "maximum_nights")


@register("clean_reviews", q("""
SELECT listing_id, id, CAST(date AS VARCHAR) AS date, reviewer_id, comment_length FROM stg_reviews
"""))
def clean_reviews(spark, sf_dir):
    """Cleaned reviews: parsed date, rows without text dropped, first row per id, text length."""
    s = warehouse(spark, sf_dir).review_rows
    return s.select("listing_id", "id", F.col("date").cast("string"), "reviewer_id", "comment_length")


@register("clean_price", q("""
SELECT id, price FROM stg_listings
"""))
def clean_price(spark, sf_dir):
    """Money text ('$1,234.56') parsed back to a number for every raw listing."""
    raw = _raw_listings(spark, sf_dir)
    return raw.select("id", C.clean_price(F.col("price")).alias("price"))


@register("map_available", q("""
SELECT l_orderkey AS listing_id, l_linenumber, l_partkey, l_suppkey, l_linestatus = 'O' AS available FROM lineitem
"""))
def map_available(spark, sf_dir):
    """'t'/'f' text of every raw calendar row mapped to boolean."""
    raw = roles.raw_calendar(roles.DriverTables(spark, sf_dir))
    return raw.select("listing_id", F.col("_ord.l_linenumber").alias("l_linenumber"),
                      F.col("_ord.l_partkey").alias("l_partkey"), F.col("_ord.l_suppkey").alias("l_suppkey"),
                      C.map_available(F.col("available")).alias("available"))


@register("dedup_first", q("""
SELECT count(*) AS n_rows, count(DISTINCT (listing_id, date)) AS n_keys FROM stg_calendar
"""))
def dedup_first(spark, sf_dir):
    """After first-row dedup every (listing, date) key is unique."""
    s = warehouse(spark, sf_dir).stg_calendar
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("listing_id", "date").alias("n_keys"))


@register("parse_dates", q("""
SELECT count(first_review) AS n_first, count(last_review) AS n_last FROM stg_listings
"""))
def parse_dates(spark, sf_dir):
    """Parsed review dates present after cleaning."""
    s = warehouse(spark, sf_dir).stg_listings
    return s.agg(F.count("first_review").alias("n_first"), F.count("last_review").alias("n_last"))


@register("trim_categories", q("SELECT property_type, count(*) AS n FROM stg_listings GROUP BY 1"))
def trim_categories(spark, sf_dir):
    """Property types after whitespace trimming."""
    return warehouse(spark, sf_dir).stg_listings.groupBy("property_type").agg(F.count(F.lit(1)).alias("n"))


@register("point_in_set", q("""
SELECT count(*) AS n FROM dash WHERE neighbourhood_group IN ('ASIA', 'EUROPE') AND room_type IN ('1-URGENT', '2-HIGH')
"""))
def point_in_set(spark, sf_dir):
    """IN-list filters over the dashboard frame."""
    from rentlens.operators import frames
    d = market.dashboard_filter(frames.dashboard_frame(warehouse(spark, sf_dir)), groups=["ASIA", "EUROPE"],
                                room_types=["1-URGENT", "2-HIGH"], price_range=(float("-inf"), float("inf")),
                                segments=None)
    return d.agg(F.count(F.lit(1)).alias("n"))
