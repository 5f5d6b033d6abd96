"""Registered publication checks and the popularity fallback (§2.12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.operators import gates
from rentlens.plans.oracle import q
from rentlens.plans.registry import register, warehouse

D = 4
LOWEST_ROWS, HIGHEST_PRICE = 100, 400_000.0


@register("validation_gate", q(f"""
, c AS (SELECT greatest({LOWEST_ROWS} - count(*), 0) AS a,
               count(*) FILTER (WHERE price IS NOT NULL AND NOT (price >= 0 AND price <= {HIGHEST_PRICE})) AS b,
               count(*) FILTER (WHERE NOT location_is_valid) AS c FROM stg_listings)
SELECT 'row_count' AS rule, a AS n_bad, a = 0 AS passed FROM c
UNION ALL SELECT 'price_range', b, b = 0 FROM c
UNION ALL SELECT 'coordinate_bounds', c, c = 0 FROM c
"""))
def validation_gate(spark, sf_dir):
    """Rules that must hold before publication, with the rows that break them."""
    return gates.validation_gate(warehouse(spark, sf_dir).stg_listings, LOWEST_ROWS, HIGHEST_PRICE)


@register("psi_drift", q(f"""
, e AS (SELECT unnest([{", ".join(f"quantile_cont(price, {i / 10})" for i in range(1, 10))}]) AS cut
        FROM stg_listings WHERE property_type = 'F'),
x AS (SELECT property_type = 'F' AS is_base, price, (SELECT count(*) FROM e WHERE cut < price) AS bin
      FROM stg_listings WHERE price IS NOT NULL AND property_type IN ('F', 'O')),
g AS (SELECT bin, count(*) FILTER (WHERE is_base) AS a, count(*) FILTER (WHERE NOT is_base) AS b FROM x GROUP BY bin),
s AS (SELECT CASE WHEN a = 0 THEN 0.5::DOUBLE ELSE a::DOUBLE END / (SELECT sum(a) FROM g) AS pa,
             CASE WHEN b = 0 THEN 0.5::DOUBLE ELSE b::DOUBLE END / (SELECT sum(b) FROM g) AS pb FROM g)
SELECT round(sum((pa - pb) * ln(pa / pb)), {D}) AS psi, sum((pa - pb) * ln(pa / pb)) > {gates.MAX_PSI} AS drifted FROM s
"""))
def psi_drift(spark, sf_dir):
    """Stability of the price between two kinds of property."""
    s = warehouse(spark, sf_dir).stg_listings
    out = gates.psi_drift(s.where("property_type = 'F'"), s.where("property_type = 'O'"), "price")
    return out.select(F.round("psi", D).alias("psi"), "drifted")


@register("popularity_fallback", q("""
, r AS (SELECT l.neighbourhood_name, f.listing_id, coalesce(f.estimated_occupancy_l365d, 0) AS estimated_occupancy_l365d,
               coalesce(f.number_of_reviews, 0) AS number_of_reviews
        FROM fact_listing_performance f JOIN dim_listing l ON f.listing_id = l.listing_id WHERE l.neighbourhood_name IS NOT NULL)
SELECT neighbourhood_name, CAST(row_number() OVER w AS INTEGER) AS rank, listing_id, estimated_occupancy_l365d, number_of_reviews
FROM r WINDOW w AS (PARTITION BY neighbourhood_name ORDER BY estimated_occupancy_l365d DESC, number_of_reviews DESC, listing_id)
QUALIFY row_number() OVER w <= 3
"""))
def popularity_fallback(spark, sf_dir):
    """Three most booked listings per neighbourhood."""
    return gates.popularity_fallback(warehouse(spark, sf_dir))
