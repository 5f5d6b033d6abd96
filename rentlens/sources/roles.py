"""Stand-in raw tables built from the driver's TPC-H-style tables.

The rental sources (listings, calendar, reviews, neighbourhood boundaries)
are not available here, so each is derived from the driver tables with the
column names, types and raw text forms the cleaning jobs expect:

==============  ==================================================================
role            built from
==============  ==================================================================
listing         ``orders`` left join per-order ``lineitem`` aggregates, host from
                ``customer``, neighbourhood = host's ``nation``, group = ``region``
calendar        ``lineitem``: listing = ``l_orderkey``, date = ``l_shipdate``,
                available = open line; file order = (linenumber, part, supp, qty)
review          ``events``: id = ``event_id``, reviewer = ``user_id``, listing = the
                reviewer's latest order; date = ``ts`` less 0 to 599 days by
                ``event_id`` (all events lie in one month); text = that of document
                number ``event_id`` modulo the number of documents, but for two
                small classes of events without a text (see ``NO_TEXT``)
boundaries      ``nation`` names and ``region`` names
==============  ==================================================================

Prices are emitted as ``$1,234.56`` text and dates, flags and amenity lists
as text so that the cleaning jobs parse them exactly as they would parse the
CSV export.  The same derivation is written in DuckDB SQL in
``rentlens.plans.oracle`` and the two are compared on every query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentlens.functions.columns import na_to_null
from rentlens.operators.cleaning import dedup_first
from rentlens.operators.ranking import row_rank

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()

#: The tables that the warehouse is derived from.
WAREHOUSE_TABLES = ("region", "nation", "customer", "orders", "lineitem", "events", "documents")

# --- fixed values -----------------------------------------------------------
SUPERHOST_SEGMENTS = ("AUTOMOBILE", "BUILDING")
REGULAR_SEGMENTS = ("FURNITURE", "HOUSEHOLD")
SCRAPE_DATE = "2024-02-01"
# event ids whose remainder by NO_TEXT_EVERY is one of these have no review text: an N/A token, and a null
NO_TEXT_EVERY, NO_TEXT = 50, {"N/A": 7, None: 13}
REVIEW_DAYS, REVIEW_STEP = 600, 7919
# -----------------------------------------------------------------------------


@dataclass
class DriverTables:
    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        raise AttributeError(name)


def line_stats(lineitem: DataFrame) -> DataFrame:
    """Per-order aggregates of ``lineitem``: the numbers by a hash aggregate, the list of parts on its own.

    A list beside the numbers would put whole lines through a sort before the shuffle;
    so only the two columns of the list are sorted, after it."""
    numbers = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty_total"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0)).alias("qty_open"),
        F.sum(F.round(F.col("l_discount") * 100)).alias("disc_pts"),
        F.sum(F.round(F.col("l_tax") * 100)).alias("tax_pts"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_r"),
        F.count_if(F.col("l_returnflag") == "A").alias("n_a"),
        F.count_if(F.col("l_returnflag") == "N").alias("n_n"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )
    # An order has a handful of lines (TPC-H: at most 7), so this list is
    # the size of one listing's amenity field, not of a data-sized group.
    parts = (lineitem.select("l_orderkey", "l_partkey").repartition("l_orderkey")
             .groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("parts")))
    return numbers.join(parts, "l_orderkey")


def raw_listings(t: DriverTables, first_only: bool = False) -> DataFrame:
    """Listings export stand-in (one row per order). With ``first_only`` the first row of each id,
    as the cleaning job keeps it, chosen before the wide columns are made: the rows that are sorted for it are narrow."""
    o = t.orders
    s = line_stats(t.lineitem)
    counts = o.groupBy(F.col("o_custkey").alias("_custkey")).agg(F.count(F.lit(1)).alias("host_n"))
    c = t.customer
    c = c.join(counts, c.c_custkey == counts._custkey, "inner").drop("_custkey")
    # nation (25 rows) and region (5 rows) are fixed-size by the TPC-H spec.
    n = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    r = F.broadcast(t.region.select("r_regionkey", "r_name"))
    df = (o.join(c, o.o_custkey == c.c_custkey, "inner")
          .join(n, c.c_nationkey == n.n_nationkey, "inner")
          .join(r, n.n_regionkey == r.r_regionkey, "inner"))
    if first_only:
        df = dedup_first(df.withColumn("_ord", F.struct("o_orderkey")), ["o_orderkey"]).drop("_ord")
    df = df.join(s, df.o_orderkey == s.l_orderkey, "left")
    has_lines = F.coalesce(F.col("n_lines"), F.lit(0)) > 0
    nl = F.col("n_lines").cast("double")
    accommodates = (1 + F.floor(F.coalesce(F.col("qty_total"), F.lit(0.0)) / 40)).cast("int")
    occupancy = F.coalesce(F.col("qty_open"), F.lit(0.0)).cast("int")
    status = F.col("o_orderstatus")
    key_txt = F.lpad(F.col("o_custkey").cast("string"), 6, "0")
    price_txt = F.concat(F.lit("$"), F.format_number(F.col("o_totalprice"), 2))
    return df.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Listing "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_custkey").alias("host_id"),
        F.col("c_name").alias("host_name"),
        F.when(F.col("c_mktsegment").isin(*SUPERHOST_SEGMENTS), "t")
         .when(F.col("c_mktsegment").isin(*REGULAR_SEGMENTS), "f").alias("host_is_superhost"),
        F.when(F.col("c_acctbal") >= 0, "t").otherwise("f").alias("host_identity_verified"),
        F.lit("t").alias("host_has_profile_pic"),
        F.col("host_n").cast("double").alias("host_listings_count"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 1000.0).alias("hosts_time_as_host_years"),
        ((F.col("c_acctbal") + 1000.0) / 1000.0).alias("hosts_time_as_user_years"),
        F.col("n_name").alias("host_location"),
        F.col("n_name").alias("neighbourhood_cleansed"),
        F.col("r_name").alias("neighbourhood_group_cleansed"),
        (41.15 + (F.col("c_acctbal") + 1000.0) / 22000.0).alias("latitude"),
        (1.85 + F.col("o_totalprice") / 1000000.0).alias("longitude"),
        F.concat(status, F.lit(" ")).alias("property_type"),
        F.col("o_orderpriority").alias("room_type"),
        accommodates.alias("accommodates"),
        F.when(has_lines, 1 + F.floor(F.col("qty_total") / 80) * 0.5).alias("bathrooms"),
        F.when(status != "P", F.ceil(accommodates / 2.0).cast("double")).alias("bedrooms"),
        F.when(F.col("c_acctbal") >= 0, accommodates.cast("double")).alias("beds"),
        F.when(has_lines, F.to_json(F.transform("parts", lambda p: F.concat(F.lit("Part #"), p.cast("string")))))
         .alias("amenities"),
        price_txt.alias("price"),
        F.when(status == "O", price_txt).alias("price_quote_price_per_night"),
        F.lit(None).cast("string").alias("price_quote_total_price"),
        F.when(has_lines, F.col("n_lines").cast("int")).alias("minimum_nights"),
        F.lit(365).alias("maximum_nights"),
        (365 - occupancy).alias("availability_365"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("number_of_reviews"),
        F.coalesce(F.col("n_n"), F.lit(0)).cast("int").alias("number_of_reviews_ltm"),
        F.when(has_lines, nl / 12.0).alias("reviews_per_month"),
        F.when(has_lines, 5 - F.col("disc_pts") / nl / 5.0).alias("review_scores_rating"),
        F.when(has_lines, 5 - F.col("tax_pts") / nl / 4.0).alias("review_scores_cleanliness"),
        F.when(has_lines, 5 - F.col("n_r") / nl).alias("review_scores_location"),
        F.when(has_lines, 5 - 2.0 * F.col("n_a") / nl).alias("review_scores_value"),
        occupancy.alias("estimated_occupancy_l365d"),
        (occupancy * F.col("o_totalprice") / 1000.0).alias("estimated_revenue_l365d"),
        F.col("host_n").cast("int").alias("calculated_host_listings_count"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("HUTB-"), key_txt))
         .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("HUTB"), key_txt, F.lit(" (registered)")))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Exempt"))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
               F.concat(F.lit("ESFCNT"), F.col("o_orderkey").cast("string")))
         .when(status == "F", F.lit(""))
         .when(status == "O", F.lit("Pending application")).alias("license"),
        F.when(status == "F", "previous scrape").otherwise("city scrape").alias("source"),
        F.lit(SCRAPE_DATE).alias("last_scraped"),
        F.date_format("first_ship", "yyyy-MM-dd").alias("first_review"),
        F.date_format("last_ship", "yyyy-MM-dd").alias("last_review"),
        F.lit(SCRAPE_DATE).alias("calendar_last_scraped"),
        # columns the export always leaves empty (dropped by cleaning), with a
        # few values so that the profiling queries have something to count
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("host_since"),
        F.when(status == "F", F.lit("within an hour")).alias("host_response_time"),
        F.when(status.isin("F", "O"), F.lit("t")).alias("instant_bookable"),
        F.lit(None).cast("string").alias("calendar_updated"),
        F.lit(None).cast("string").alias("neighborhood_overview"),
        F.struct(F.col("o_orderkey")).alias("_ord"),
    )


CALENDAR_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def raw_calendar(t: DriverTables) -> DataFrame:
    """Calendar export stand-in: one row per line item (duplicates included)."""
    li = t.lineitem
    return li.select(
        F.col("l_orderkey").alias("listing_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.when(F.col("l_linestatus") == "O", "t").otherwise("f").alias("available"),
        F.col("l_linenumber").alias("minimum_nights"),
        F.col("l_quantity").cast("int").alias("maximum_nights"),
        F.struct(*[F.col(c) for c in CALENDAR_ORDER]).alias("_ord"),
    )


def review_listing_map(t: DriverTables) -> DataFrame:
    """Reviewer -> the listing the reviewer stayed in (latest order)."""
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("listing_id"))


def raw_reviews(t: DriverTables) -> DataFrame:
    """Reviews export stand-in (one row per event), all but the text: ``text_key`` says which one it is."""
    m = review_listing_map(t)
    # documents numbered from 0 in the order of their ids (a distributed rank)
    d = row_rank(t.documents.select("doc_id"), "doc_id", "nth").select("nth", F.col("doc_id").alias("text_id"))
    n_docs = F.lit(max(1, t.documents.count()))
    e = t.events.select("event_id", "ts", "user_id", (F.pmod(F.col("event_id"), n_docs) + 1).alias("nth"))
    rest = F.pmod(F.col("event_id"), F.lit(NO_TEXT_EVERY))
    key = F.struct(F.when(~rest.isin(*NO_TEXT.values()), F.col("text_id")).alias("text_id"), F.when(rest == NO_TEXT["N/A"], "N/A").alias("fixed"))
    back = F.pmod(F.col("event_id") * REVIEW_STEP, F.lit(REVIEW_DAYS)).cast("int")
    return (e.join(m, e.user_id == m.o_custkey, "inner")
            .join(d, "nth", "left")
            .select(
                F.col("listing_id"),
                F.col("event_id").alias("id"),
                F.date_format(F.date_sub(F.col("ts"), back), "yyyy-MM-dd").alias("date"),
                F.col("user_id").alias("reviewer_id"),
                key.alias("text_key"),
                F.struct(F.col("event_id")).alias("_ord"),
            ))


def attach_text(t: DriverTables, reviews: DataFrame) -> DataFrame:
    """``reviews`` with ``comments`` by ``text_key``. The texts move once, each on its own: a text is put
    beside its reviews in the last join, and what reads the rows reads them there. Of several
    texts of an id one is taken, missing ones last."""
    first = Window.partitionBy("text_id").orderBy(na_to_null(F.col("text")).asc_nulls_last())
    d = t.documents.select(F.col("doc_id").alias("text_id"), "text").where(F.col("doc_id").isNotNull())
    d = d.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    r = reviews.withColumn("text_id", F.col("text_key.text_id"))
    return r.join(d, "text_id", "left").withColumn("comments", F.coalesce("text_key.fixed", "text")).drop("text_id", "text")


def stays(t: DriverTables) -> DataFrame:
    """Stays for the collaborative queries: a line item is one, its supplier the
    guest (each reviewer of the review stand-in knows one listing only)."""
    return t.lineitem.select(F.col("l_suppkey").alias("guest"), F.col("l_orderkey").alias("listing_id"))


def boundaries(t: DriverTables) -> DataFrame:
    """Neighbourhood boundary properties stand-in: (neighbourhood, group)."""
    n = t.nation.select("n_name", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(F.col("n_name").alias("neighbourhood"), F.col("r_name").alias("neighbourhood_group")))


def review_text(t: DriverTables) -> DataFrame:
    """Review text with its known language, for the text jobs' accuracy checks."""
    return t.documents.select(F.col("doc_id").alias("review_id"), F.col("text").alias("comments"),
                              F.col("lang").alias("language_true"))
