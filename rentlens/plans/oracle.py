"""DuckDB SQL that rebuilds the cleaned warehouse from the driver tables.

This is written independently of the Spark plan (which goes through raw
text and the cleaning jobs), so agreement between the two checks the role
mapping, the parsers, the dedup rule and every query on top.  Each oracle
query is ``WAREHOUSE_CTES`` followed by its own SELECT.
"""

from rentlens.sources.roles import NO_TEXT, NO_TEXT_EVERY, REVIEW_DAYS, REVIEW_STEP

NA_LIST = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
           "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")

WAREHOUSE_CTES = f"""
WITH li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty_total,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0.0 END) AS qty_open,
         sum(round(l_discount * 100)) AS disc_pts, sum(round(l_tax * 100)) AS tax_pts,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_r,
         count(*) FILTER (WHERE l_returnflag = 'A') AS n_a,
         count(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
         min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey
),
hc AS (SELECT o_custkey AS hk, count(*) AS host_n FROM orders GROUP BY o_custkey),
base AS (
  SELECT o.*, c.*, n.n_name, r.r_name, hc.host_n, li.*,
         coalesce(li.n_lines, 0) > 0 AS has_lines,
         CAST(1 + floor(coalesce(li.qty_total, 0.0) / 40) AS INTEGER) AS acc,
         CAST(coalesce(li.qty_open, 0.0) AS INTEGER) AS occ
  FROM orders o
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN hc ON hc.hk = o.o_custkey
),
stg_listings AS (
  SELECT o_orderkey AS id, 'Listing ' || CAST(o_orderkey AS VARCHAR) AS name,
         o_custkey AS host_id, c_name AS host_name,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 't'
              WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'f' END AS host_is_superhost,
         CASE WHEN c_acctbal >= 0 THEN 't' ELSE 'f' END AS host_identity_verified,
         't' AS host_has_profile_pic,
         CAST(host_n AS DOUBLE) AS host_listings_count,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal / 1000.0 END AS hosts_time_as_host_years,
         (c_acctbal + 1000.0) / 1000.0 AS hosts_time_as_user_years,
         n_name AS host_location, n_name AS neighbourhood_cleansed, r_name AS neighbourhood_group_cleansed,
         41.15 + (c_acctbal + 1000.0) / 22000.0 AS latitude,
         1.85 + o_totalprice / 1000000.0 AS longitude,
         o_orderstatus AS property_type, o_orderpriority AS room_type,
         acc AS accommodates,
         CASE WHEN has_lines THEN 1 + floor(qty_total / 80) * 0.5 END AS bathrooms,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(ceil(acc / 2.0) AS DOUBLE) END AS bedrooms,
         CASE WHEN c_acctbal >= 0 THEN CAST(acc AS DOUBLE) END AS beds,
         o_totalprice AS price,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS price_quote_price_per_night,
         CASE WHEN has_lines THEN CAST(n_lines AS INTEGER) END AS minimum_nights,
         365 AS maximum_nights,
         365 - occ AS availability_365,
         CAST(coalesce(n_lines, 0) AS INTEGER) AS number_of_reviews,
         CAST(coalesce(n_n, 0) AS INTEGER) AS number_of_reviews_ltm,
         CASE WHEN has_lines THEN CAST(n_lines AS DOUBLE) / 12.0 END AS reviews_per_month,
         CASE WHEN has_lines THEN 5 - disc_pts / CAST(n_lines AS DOUBLE) / 5.0 END AS review_scores_rating,
         CASE WHEN has_lines THEN 5 - tax_pts / CAST(n_lines AS DOUBLE) / 4.0 END AS review_scores_cleanliness,
         CASE WHEN has_lines THEN 5 - n_r / CAST(n_lines AS DOUBLE) END AS review_scores_location,
         CASE WHEN has_lines THEN 5 - 2.0 * n_a / CAST(n_lines AS DOUBLE) END AS review_scores_value,
         occ AS estimated_occupancy_l365d,
         occ * o_totalprice / 1000.0 AS estimated_revenue_l365d,
         CAST(host_n AS INTEGER) AS calculated_host_listings_count,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'HUTB-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0')
              WHEN o_orderpriority = '2-HIGH' THEN 'HUTB' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || ' (registered)'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'Exempt'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'ESFCNT' || CAST(o_orderkey AS VARCHAR)
              WHEN o_orderstatus = 'F' THEN NULL
              WHEN o_orderstatus = 'O' THEN 'Pending application' END AS license,
         CASE WHEN o_orderstatus = 'F' THEN 'previous scrape' ELSE 'city scrape' END AS source,
         CAST(first_ship AS DATE) AS first_review, CAST(last_ship AS DATE) AS last_review,
         coalesce(o_totalprice >= 0, false) AS price_is_valid,
         coalesce((41.15 + (c_acctbal + 1000.0) / 22000.0) BETWEEN 41.2 AND 41.6
                  AND (1.85 + o_totalprice / 1000000.0) BETWEEN 1.9 AND 2.3, false) AS location_is_valid,
         coalesce(n_lines, 0) > 0 AS has_reviews
  FROM base
),
cal_raw AS (
  SELECT l_orderkey AS listing_id, CAST(l_shipdate AS DATE) AS date, l_linestatus = 'O' AS available,
         l_linenumber AS minimum_nights, CAST(l_quantity AS INTEGER) AS maximum_nights,
         row_number() OVER (PARTITION BY l_orderkey, CAST(l_shipdate AS DATE)
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem
),
stg_calendar AS (SELECT listing_id, date, available, minimum_nights, maximum_nights FROM cal_raw WHERE rn = 1),
rv_map AS (SELECT o_custkey, max(o_orderkey) AS listing_id FROM orders GROUP BY o_custkey),
numbered AS (SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS nth FROM documents),
stg_reviews AS (
  SELECT m.listing_id, e.event_id AS id,
         CAST(e.ts AS DATE) - CAST((e.event_id * {REVIEW_STEP}) % {REVIEW_DAYS} AS INTEGER) AS date,
         e.user_id AS reviewer_id, d.text AS comments, CAST(length(d.text) AS BIGINT) AS comment_length
  FROM events e JOIN rv_map m ON e.user_id = m.o_custkey
  JOIN numbered d ON d.nth = e.event_id % (SELECT count(*) FROM documents)
  WHERE e.event_id % {NO_TEXT_EVERY} NOT IN ({NO_TEXT["N/A"]}, {NO_TEXT[None]})
    AND d.text IS NOT NULL AND d.text NOT IN ({NA_LIST})
),
dim_host AS (
  SELECT DISTINCT host_id, host_name, host_is_superhost, host_identity_verified, host_has_profile_pic,
         host_listings_count, hosts_time_as_host_years, hosts_time_as_user_years, host_location
  FROM stg_listings
),
dim_neighbourhood AS (
  SELECT DISTINCT neighbourhood_cleansed AS neighbourhood_name, neighbourhood_group_cleansed AS neighbourhood_group
  FROM stg_listings WHERE neighbourhood_cleansed IS NOT NULL
),
dim_listing AS (
  SELECT id AS listing_id, host_id, neighbourhood_cleansed AS neighbourhood_name, property_type, room_type,
         accommodates, bathrooms, bedrooms, beds, latitude, longitude, has_reviews, price_is_valid,
         location_is_valid
  FROM stg_listings
),
dim_date AS (
  SELECT DISTINCT date, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
         CAST(dayofweek(date) AS BIGINT) AS day_of_week, coalesce(dayofweek(date) IN (0, 6), false) AS is_weekend
  FROM stg_calendar
),
fact_listing_performance AS (
  SELECT id AS listing_id, price, number_of_reviews, number_of_reviews_ltm, reviews_per_month,
         review_scores_rating, review_scores_cleanliness, review_scores_location, review_scores_value,
         estimated_occupancy_l365d, estimated_revenue_l365d, availability_365, minimum_nights, maximum_nights,
         calculated_host_listings_count
  FROM stg_listings
),
v_listing_demand AS (
  SELECT listing_id, number_of_reviews, estimated_occupancy_l365d,
         CASE WHEN number_of_reviews = 0 AND estimated_occupancy_l365d = 0 THEN 'never_active'
              WHEN number_of_reviews > 0 AND estimated_occupancy_l365d = 0 THEN 'dormant_with_history'
              ELSE 'active' END AS demand_segment
  FROM fact_listing_performance
),
fact_calendar AS (
  SELECT c.listing_id, c.date, c.available, c.minimum_nights, c.maximum_nights
  FROM stg_calendar c JOIN dim_listing l ON c.listing_id = l.listing_id
),
fact_reviews AS (
  SELECT r.id AS review_id, r.listing_id, r.date, r.reviewer_id, r.comment_length
  FROM stg_reviews r JOIN dim_listing l ON r.listing_id = l.listing_id
),
dash AS (
  SELECT f.listing_id, f.price, l.room_type, l.accommodates, l.neighbourhood_name, n.neighbourhood_group,
         h.host_is_superhost, h.host_id, f.review_scores_rating, f.number_of_reviews, v.demand_segment
  FROM fact_listing_performance f
  JOIN dim_listing l ON f.listing_id = l.listing_id
  JOIN dim_neighbourhood n ON l.neighbourhood_name = n.neighbourhood_name
  JOIN dim_host h ON l.host_id = h.host_id
  JOIN v_listing_demand v ON f.listing_id = v.listing_id
  WHERE f.price IS NOT NULL AND l.price_is_valid
)
"""


def q(body: str) -> str:
    """Oracle query = warehouse CTEs + body (body may add ``, name AS (...)``)."""
    return WAREHOUSE_CTES + body
