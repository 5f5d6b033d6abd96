"""The shared join frames the queries start from.

Fact, listing dimension and demand view are all keyed by ``listing_id`` and
come from the same deduplicated staging frame, whose output is already hash
partitioned by that key, so their joins need no further exchange.  Host and
neighbourhood dimensions are joined by size: one has a row per area, the host
dimension grows with the data.  Both are left to adaptive execution, which broadcasts a side
only when its measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.warehouse import Warehouse

MODEL_COLUMNS = [
    "listing_id", "price", "room_type", "property_type", "accommodates", "bathrooms", "bedrooms", "beds",
    "neighbourhood_name", "neighbourhood_group", "host_is_superhost", "host_listings_count",
    "hosts_time_as_host_years", "number_of_reviews", "review_scores_rating", "review_scores_cleanliness",
    "review_scores_location", "review_scores_value", "availability_365", "minimum_nights",
    "estimated_occupancy_l365d", "demand_segment",
]
DASHBOARD_COLUMNS = ["listing_id", "price", "room_type", "accommodates", "neighbourhood_name",
                     "neighbourhood_group", "host_is_superhost", "host_id", "review_scores_rating",
                     "number_of_reviews", "demand_segment"]


def listing_perf(wh: Warehouse) -> DataFrame:
    """fact ⋈ dim_listing ⋈ demand view (three-way, on listing_id): all three
    have the listing grain, so this is one projection (``listing_wide``)."""
    return wh.listing_wide


def fact_listing(wh: Warehouse) -> DataFrame:
    """fact ⋈ dim_listing (two-way), same grain: the wide projection."""
    return wh.listing_wide.drop("demand_segment")


def _five_way(wh: Warehouse) -> DataFrame:
    n = wh.dim_neighbourhood
    h = wh.dim_host.drop("host_name", "host_identity_verified", "host_has_profile_pic",
                         "hosts_time_as_user_years", "host_location")
    return wh.listing_wide.join(n, "neighbourhood_name").join(h, "host_id")


def model_frame(wh: Warehouse) -> DataFrame:
    """Training rows: valid price, active demand; 5-way join."""
    df = _five_way(wh).where(F.col("price").isNotNull() & F.col("price_is_valid")
                             & (F.col("demand_segment") == "active"))
    return df.select(*MODEL_COLUMNS)


def dashboard_frame(wh: Warehouse) -> DataFrame:
    """Dashboard rows: valid price, every segment; 11 columns."""
    df = _five_way(wh).where(F.col("price").isNotNull() & F.col("price_is_valid"))
    return df.select(*DASHBOARD_COLUMNS)


def listing_frame(wh: Warehouse, listing_ids) -> DataFrame:
    """The 5-way frame for given listing ids (no segment filter); the id
    predicate is applied to the fact scan before the joins."""
    ids = list(listing_ids) if isinstance(listing_ids, (list, tuple, set)) else [listing_ids]
    return _five_way(wh).where(F.col("listing_id").isin(ids)).select(*MODEL_COLUMNS)


def join_date_dim(wh: Warehouse) -> DataFrame:
    """Calendar ⋈ date dimension (NULL dates drop out).

    ``dim_date`` is the distinct dates of the same calendar with columns that
    are functions of the date, so the inner join equals computing those
    columns on the rows with a date: no second pass over the calendar and no
    join."""
    from rentlens.functions import columns as C
    d = F.col("date")
    return (wh.fact_calendar.where(d.isNotNull())
            .withColumn("year", F.year(d).cast("bigint")).withColumn("month", F.month(d).cast("bigint"))
            .withColumn("day_of_week", C.day_of_week(d)).withColumn("is_weekend", C.is_weekend(d)))


def join_reviews_listing(wh: Warehouse) -> DataFrame:
    return wh.fact_reviews.join(wh.fact_listing_performance, "listing_id")


def listing_frame_all(wh: Warehouse) -> DataFrame:
    """The five-way frame for every listing (no filter): the batch advisor input."""
    return _five_way(wh).select(*MODEL_COLUMNS)
