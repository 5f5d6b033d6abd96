"""Price, area and dashboard queries (§2.6 of the blueprint).

Every function takes a ``Warehouse`` (or a frame built from one) and returns a
lazy DataFrame.  ``digits`` is the rounding of reported doubles: the
reference rounds to 2 in SQL; the query registry asks for 4 so the oracle
comparison is not at the mercy of tie rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentlens.functions import columns as C
from rentlens.operators.ranking import grouped, quantiles
from rentlens.operators import frames
from rentlens.operators.warehouse import Warehouse


def _active_valid(wh: Warehouse) -> DataFrame:
    return frames.listing_perf(wh).where((F.col("demand_segment") == "active") & F.col("price_is_valid"))


def top_neighbourhoods(wh: Warehouse, min_n: int = 10, top: int = 10, digits: int = 2) -> DataFrame:
    """Top areas by median price among active, valid listings (n >= min_n)."""
    g = grouped(_active_valid(wh).select("neighbourhood_name", "price"), ["neighbourhood_name"],
                [F.count(F.lit(1)).alias("listing_count"), F.avg("price").alias("avg_price")],
                {"price": {"median_price": 0.5}}).where(F.col("listing_count") >= min_n)
    return (g.orderBy(F.desc("median_price"), F.asc("neighbourhood_name")).limit(top)
            .select("neighbourhood_name", "listing_count",
                    F.round("median_price", digits).alias("median_price"),
                    F.round("avg_price", digits).alias("avg_price")))


def host_tiers(wh: Warehouse, digits: int = 1) -> DataFrame:
    """Hosts and listings per portfolio tier, with the share of all listings."""
    per_host = wh.dim_listing.groupBy("host_id").agg(F.count(F.lit(1)).alias("listing_count"))
    lc = F.col("listing_count")
    tier = (F.when(lc == 1, "1 listing").when(lc.between(2, 5), "2-5 listings")
            .when(lc.between(6, 20), "6-20 listings").otherwise("20+ listings"))
    t = (per_host.groupBy(tier.alias("host_tier"))
         .agg(F.count(F.lit(1)).alias("host_count"), F.sum("listing_count").cast("bigint").alias("total_listings")))
    # four rows at most: the window over them is a one-task step by design
    total = F.sum("total_listings").over(Window.partitionBy())
    return t.select("host_tier", "host_count", "total_listings",
                    C.share_pct(F.col("total_listings"), total, digits).alias("pct_of_market"))


def _superhost_join(wh: Warehouse) -> DataFrame:
    return (wh.dim_host.join(wh.dim_listing, "host_id")
            .join(wh.fact_listing_performance, "listing_id")
            .where(F.col("host_is_superhost").isin("t", "f")))


def superhost_compare(wh: Warehouse, distinct: bool = False, digits: int | None = None) -> DataFrame:
    """Per superhost flag: listings (COUNT(*) or COUNT(DISTINCT)), average
    price / rating / reviews rounded to 2 / 3 / 1 digits unless ``digits``."""
    n = F.count_distinct("listing_id") if distinct else F.count(F.lit(1))
    d1, d2, d3 = (digits, digits, digits) if digits is not None else (2, 3, 1)
    return (_superhost_join(wh).groupBy("host_is_superhost")
            .agg(n.alias("listings"), F.round(F.avg("price"), d1).alias("avg_price"),
                 F.round(F.avg("review_scores_rating"), d2).alias("avg_rating"),
                 F.round(F.avg("number_of_reviews"), d3).alias("avg_reviews")))


def demand_breakdown(wh: Warehouse, digits: int = 1) -> DataFrame:
    v = wh.listing_demand
    g = v.groupBy("demand_segment").agg(F.count(F.lit(1)).alias("listing_count"))
    total = F.sum("listing_count").over(Window.partitionBy())  # three rows
    return g.select("demand_segment", "listing_count",
                    C.share_pct(F.col("listing_count"), total, digits).alias("pct_of_total"))


def monthly_availability(wh: Warehouse, digits: int = 2) -> DataFrame:
    c = wh.fact_calendar
    return (c.groupBy(F.month("date").cast("bigint").alias("month"))
            .agg(F.round(F.avg(F.when(F.col("available"), 1.0).otherwise(0.0)) * 100, digits).alias("pct_available"),
                 F.count_distinct("listing_id").alias("active_listings")))


def describe(df: DataFrame, col: str, by: list | None = None, digits: int = 4) -> DataFrame:
    """pandas ``describe``: exact linear-interpolated quartiles, sample std."""
    by = list(by or [])
    g = grouped(df.select(*by, col), by, [F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                                          F.min(col).alias("min"), F.max(col).alias("max")],
                {col: {"p25": 0.25, "p50": 0.5, "p75": 0.75}})
    return g.select(*by, "count", *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def price_describe(wh: Warehouse, digits: int = 4) -> DataFrame:
    """Price summary for all valid listings and for active ones only."""
    base = frames.listing_perf(wh).where(F.col("price").isNotNull() & F.col("price_is_valid"))
    scoped = base.select("price", F.explode(F.when(F.col("demand_segment") == "active", F.array(F.lit("all"), F.lit("active")))
                                            .otherwise(F.array(F.lit("all")))).alias("scope"))
    return describe(scoped, "price", ["scope"], digits)


def priciest_listings(wh: Warehouse, top: int = 10) -> DataFrame:
    df = frames.fact_listing(wh).where(F.col("price").isNotNull() & F.col("price_is_valid"))
    return (df.orderBy(F.desc("price"), F.asc("listing_id")).limit(top)
            .select("listing_id", "room_type", "accommodates", "price"))


def point_lookup(wh: Warehouse, ids) -> DataFrame:
    ids = list(ids) if isinstance(ids, (list, tuple, set)) else [ids]
    return (wh.fact_listing_performance.where(F.col("listing_id").isin(ids))
            .select("listing_id", "price", "number_of_reviews", "availability_365", "estimated_occupancy_l365d"))


def activity_overlap(wh: Warehouse) -> DataFrame:
    f = wh.fact_listing_performance
    zr, zo = F.col("number_of_reviews") == 0, F.col("estimated_occupancy_l365d") == 0
    return f.agg(F.count(F.lit(1)).alias("total"), F.count_if(zr).alias("zero_reviews"),
                 F.count_if(zo).alias("zero_occupancy"), F.count_if(zr & zo).alias("both_zero"))


def neighbourhood_summary(wh: Warehouse, digits: int = 2) -> DataFrame:
    df = _active_valid(wh).join(wh.dim_neighbourhood, "neighbourhood_name")
    by = ["neighbourhood_name", "neighbourhood_group"]
    g = grouped(df.select(*by, "price", "review_scores_rating"), by,
                [F.count(F.lit(1)).alias("listing_count"), F.avg("price").alias("avg_price"), F.avg("review_scores_rating").alias("avg_rating")],
                {"price": {"median_price": 0.5}})
    return g.select(*by, "listing_count", *[F.round(c, digits).alias(c) for c in ("avg_price", "median_price", "avg_rating")])


def neighbourhood_reliable(wh: Warehouse, min_n: int = 10, top: int = 10, digits: int = 2) -> DataFrame:
    """Areas with n >= min_n: the ``top`` most and least expensive by median."""
    s = neighbourhood_summary(wh, digits).where(F.col("listing_count") >= min_n)
    hi = s.orderBy(F.desc("median_price"), F.asc("neighbourhood_name")).limit(top).withColumn("side", F.lit("top"))
    lo = s.orderBy(F.asc("median_price"), F.desc("neighbourhood_name")).limit(top).withColumn("side", F.lit("bottom"))
    return hi.unionByName(lo)


def room_type_in_area(wh: Warehouse, neighbourhood: str, digits: int = 2) -> DataFrame:
    df = _active_valid(wh).where(F.col("neighbourhood_name") == neighbourhood)
    g = grouped(df.select("room_type", "price"), ["room_type"], [F.count(F.lit(1)).alias("n"), F.avg("price").alias("avg_price")],
                {"price": {"median_price": 0.5}})
    return g.select("room_type", "n", *[F.round(c, digits).alias(c) for c in ("avg_price", "median_price")])


def high_volume_low_score(wh: Warehouse, min_reviews: int = 50, max_rating: float = 4.0) -> DataFrame:
    f = wh.fact_listing_performance.where((F.col("number_of_reviews") >= min_reviews)
                                          & F.col("review_scores_rating").isNotNull()
                                          & (F.col("review_scores_rating") < max_rating))
    return (f.join(wh.dim_listing, "listing_id")
            .select("listing_id", "room_type", "neighbourhood_name", "price", "number_of_reviews",
                    "review_scores_rating", "review_scores_cleanliness", "review_scores_location",
                    "review_scores_value"))


def group_price_rows(wh: Warehouse) -> DataFrame:
    """(group, price) of active valid listings, one row per listing: the
    reference groups by (group, price, listing_id) to undo join fan-out."""
    df = _active_valid(wh).join(wh.dim_neighbourhood, "neighbourhood_name")
    return df.select("neighbourhood_group", "price", "listing_id").dropDuplicates()


def price_tiers(wh: Warehouse, labels: dict | None = None, digits: int = 2) -> DataFrame:
    """Median price per group with a fixed tier label (unlisted groups: NULL)."""
    g = grouped(group_price_rows(wh), ["neighbourhood_group"], [F.count(F.lit(1)).alias("n")], {"price": {"median_price": 0.5}})
    label = F.lit(None).cast("string")
    if labels:
        m = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
        label = m[F.col("neighbourhood_group")]
    return g.select("neighbourhood_group", F.round("median_price", digits).alias("median_price"),
                    label.alias("tier"))


# --- dashboard numbers --------------------------------------------------------

def dashboard_filter(df: DataFrame, groups=None, room_types=None, price_range=(0.0, 1000.0),
                     segments=("active",)) -> DataFrame:
    cond = F.col("price").between(float(price_range[0]), float(price_range[1]))
    if groups is not None:
        cond = cond & F.col("neighbourhood_group").isin(list(groups))
    if room_types is not None:
        cond = cond & F.col("room_type").isin(list(room_types))
    if segments is not None:
        cond = cond & F.col("demand_segment").isin(list(segments))
    return df.where(cond)


def filter_options(df: DataFrame) -> DataFrame:
    """Sorted distinct non-null values of each filter field, and the price range."""
    def opts(c):
        return F.array_sort(F.collect_set(F.col(c)))  # bounded: distinct categories
    return df.agg(opts("neighbourhood_group").alias("neighbourhood_groups"), opts("room_type").alias("room_types"),
                  opts("demand_segment").alias("demand_segments"),
                  F.min("price").alias("min_price"), F.max("price").alias("max_price"))


def kpi_cards(df: DataFrame, digits: int = 4) -> DataFrame:
    n = F.count(F.lit(1))
    active = F.coalesce(F.count_if(F.col("demand_segment") == "active") * 100.0 / F.nullif(n, F.lit(0)), F.lit(0.0)).cast("double")
    g = grouped(df.select("price", "review_scores_rating", "demand_segment"), [],
                [n.alias("total_listings"), F.avg("review_scores_rating").alias("avg_rating"), active.alias("pct_active")],
                {"price": {"median_price": 0.5}})
    return g.select("total_listings", *[F.round(c, digits).alias(c) for c in ("median_price", "avg_rating", "pct_active")])


def room_type_share(df: DataFrame, digits: int = 4) -> DataFrame:
    g = df.where(F.col("room_type").isNotNull()).groupBy("room_type").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per room type
    return g.select("room_type", "n", C.share_pct(F.col("n"), total, digits).alias("pct"))


def group_stats(df: DataFrame, digits: int = 4) -> DataFrame:
    g = grouped(df.where(F.col("neighbourhood_group").isNotNull()).select("neighbourhood_group", "listing_id", "price", "review_scores_rating"),
                ["neighbourhood_group"], [F.count("listing_id").alias("n"), F.avg("review_scores_rating").alias("avg_rating")],
                {"price": {"median_price": 0.5}})
    return g.select("neighbourhood_group", "n", *[F.round(c, digits).alias(c) for c in ("median_price", "avg_rating")])


def neighbourhood_extremes(df: DataFrame, min_n: int = 10, top: int = 10, digits: int = 4) -> DataFrame:
    s = grouped(df.where(F.col("neighbourhood_name").isNotNull()).select("neighbourhood_name", "listing_id", "price"), ["neighbourhood_name"],
                [F.count("listing_id").alias("n")], {"price": {"median_price": 0.5}}).where(F.col("n") >= min_n)
    hi = s.orderBy(F.desc("median_price"), F.asc("neighbourhood_name")).limit(top).withColumn("side", F.lit("most"))
    lo = s.orderBy(F.asc("median_price"), F.asc("neighbourhood_name")).limit(top).withColumn("side", F.lit("least"))
    return hi.unionByName(lo).withColumn("median_price", F.round("median_price", digits))


def superhost_dashboard(df: DataFrame, digits: int = 4) -> DataFrame:
    label = F.when(F.col("host_is_superhost") == "t", "Superhost").when(F.col("host_is_superhost") == "f",
                                                                          "Regular Host")
    d = df.where(F.col("host_is_superhost").isNotNull()).select("host_is_superhost", "listing_id", "price", "review_scores_rating", "number_of_reviews")
    g = grouped(d, ["host_is_superhost"], [F.count("listing_id").alias("n"), F.avg("review_scores_rating").alias("avg_rating")],
                {"price": {"median_price": 0.5}, "number_of_reviews": {"median_reviews": 0.5}})
    return g.select("host_is_superhost", "n", *[F.round(c, digits).alias(c) for c in ("median_price", "avg_rating", "median_reviews")],
                    label.alias("label"))


def _bounds(x: DataFrame):
    """One aggregate row (n, sd, min, max) fetched to the driver: four numbers."""
    return x.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"),
                 F.min("x").alias("lo"), F.max("x").alias("hi")).first()


def price_histogram(df: DataFrame, col: str = "price", bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed on the right."""
    x = df.where(F.col(col).isNotNull()).select(F.col(col).alias("x"))
    b = _bounds(x)
    if b["n"] == 0:
        return x.select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_lo"), F.lit(0.0).alias("bin_hi"),
                        F.lit(0).cast("bigint").alias("n")).limit(0)
    lo, hi = float(b["lo"]), float(b["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    idx = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    h = x.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "n")


def price_boxplot(df: DataFrame, by: str, col: str = "price", digits: int = 4) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers (extreme points inside the fences)."""
    q = quantiles(df.where(F.col(by).isNotNull()), col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by])
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    j = df.select(by, col).join(q, by)
    inside = F.col(col).between(F.col("lo_fence"), F.col("hi_fence"))
    out = j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"), F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))
    return out.select(by, *[F.round(c, digits).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                      "n_outliers")


def price_density(df: DataFrame, col: str = "price", grid: int = 64) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max]; bandwidth by
    Scott's rule (n^(-1/5) times the sample sd); one sum per grid point in a
    single aggregate."""
    x = df.where(F.col(col).isNotNull()).select(F.col(col).alias("x"))
    b = _bounds(x)
    n = int(b["n"])
    if n < 2 or not b["sd"]:
        return x.select(F.lit(0.0).alias("price"), F.lit(0.0).alias("density")).limit(0)
    lo, hi, bw = float(b["lo"]), float(b["hi"]), float(b["sd"]) * n ** -0.2
    step = (hi - lo) / max(grid - 1, 1)
    norm = n * bw * (2 * 3.141592653589793) ** 0.5
    at = [lo + i * step for i in range(grid)]
    row = x.agg(*[F.sum(F.exp(-0.5 * F.pow((F.col("x") - F.lit(p)) / F.lit(bw), 2))).alias(f"g{i}") for i, p in enumerate(at)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(p).alias("price"), (F.col(f"g{i}") / F.lit(norm)).alias("density"))
                                         for i, p in enumerate(at)])))


def other_bucket(df: DataFrame, col: str, keep: int = 6) -> DataFrame:
    """Counts of the ``keep`` most frequent values, the rest summed as 'other'."""
    g = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = g.orderBy(F.desc("n"), F.asc("value")).limit(keep)  # a distributed top-k; the others are what it leaves of all rows
    rest = g.agg(F.sum("n").alias("n")).select("n", top.agg(F.sum("n")).scalar().alias("_top"))
    return top.unionByName(rest.select(F.lit("other").alias("value"), (F.col("n") - F.col("_top")).cast("bigint").alias("n")).where("n > 0"))


def random_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the key: repeatable, and a
    distributed top-n (each partition keeps n, the driver merges)."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(n)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` absent from ``right`` (SQL EXCEPT)."""
    return left.subtract(right)
