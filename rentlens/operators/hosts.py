"""Host portfolio, market concentration and licence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentlens.functions import text as TX
from rentlens.operators import ranking
from rentlens.operators.warehouse import Warehouse


def host_portfolio(wh: Warehouse) -> DataFrame:
    """Listings per (host, superhost flag); dim_host fan-out is kept."""
    return (wh.dim_host.join(wh.dim_listing, "host_id")
            .groupBy("host_id", "host_is_superhost")
            .agg(F.count("listing_id").alias("listing_count")))


def portfolio_buckets(wh: Warehouse) -> DataFrame:
    """Describe of portfolio size and the host count per size bucket."""
    p = host_portfolio(wh)
    lc = F.col("listing_count")
    q = F.percentile(lc, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return p.agg(F.count(F.lit(1)).alias("n_hosts"), F.avg(lc).alias("mean"), F.stddev_samp(lc).alias("std"),
                 F.min(lc).cast("bigint").alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"),
                 F.max(lc).cast("bigint").alias("max"),
                 F.count_if(lc == 1).alias("single"), F.count_if(lc.between(2, 5)).alias("hosts_2_5"),
                 F.count_if(lc.between(6, 20)).alias("hosts_6_20"), F.count_if(lc > 20).alias("hosts_20_plus"),
                 (F.count_if(lc == 1) * 100.0 / F.count(F.lit(1))).cast("double").alias("single_pct"))


def top_hosts(wh: Warehouse, top: int = 10) -> DataFrame:
    return host_portfolio(wh).orderBy(F.desc("listing_count"), F.asc("host_id")).limit(top)


def market_concentration(wh: Warehouse, ns=(10, 50, 100, 500)) -> DataFrame:
    """Share of all listings held by the top-n hosts, and by single-listing hosts.

    Only the ``max(ns)`` largest portfolios are ranked (a distributed top-k);
    the running sum then runs over at most ``max(ns)`` rows.  Totals are scalar
    subqueries over the whole portfolio table.
    """
    p = host_portfolio(wh)
    n_max = max(ns)
    total = p.agg(F.sum("listing_count")).scalar()
    n_hosts = p.agg(F.count(F.lit(1))).scalar()
    singles = p.agg(F.count_if(F.col("listing_count") == 1)).scalar()
    top = p.orderBy(F.desc("listing_count"), F.asc("host_id")).limit(n_max)
    w = Window.orderBy(F.desc("listing_count"), F.asc("host_id"))  # <= n_max rows
    ranked = top.select("listing_count", F.row_number().over(w).alias("rank"),
                        F.sum("listing_count").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    return (ranked.where(F.col("rank").isin(list(ns)))
            .select(F.col("rank").cast("bigint").alias("top_n"),
                    (F.col("rank") * 100.0 / n_hosts).cast("double").alias("pct_of_hosts"),
                    (F.col("cum") * 100.0 / total).cast("double").alias("pct_of_listings"),
                    (singles * 100.0 / total).cast("double").alias("single_listing_share")))


def concentration_curve(wh: Warehouse) -> DataFrame:
    """Cumulative share of listings for every host by descending portfolio
    (the full curve), with a distributed running sum."""
    p = host_portfolio(wh).withColumn("_one", F.lit(1).cast("bigint"))
    ties = [F.asc("host_id"), F.asc("host_is_superhost")]
    c = ranking.prefix_sums(p, "listing_count", {"cumulative_listings": "listing_count", "rank": "_one"}, descending=True,
                            ties=ties, total="_total")
    return c.withColumn("cumulative_pct", (F.col("cumulative_listings") * 100.0 / F.col("_total")).cast("double")).drop("_one", "_total")


def host_split(df: DataFrame) -> DataFrame:
    """Hosts with 1, 2-9 and 10+ rows in the dashboard frame."""
    hc = df.where(F.col("host_id").isNotNull()).groupBy("host_id").agg(F.count(F.lit(1)).alias("n"))
    return hc.agg(F.count_if(F.col("n") == 1).alias("single"),
                  F.count_if((F.col("n") > 1) & (F.col("n") < 10)).alias("multi"),
                  F.count_if(F.col("n") >= 10).alias("commercial"))


def top_host_share(df: DataFrame, ns=(1, 10, 100, 500)) -> DataFrame:
    """% of all dashboard rows held by the n hosts with most rows."""
    hc = df.where(F.col("host_id").isNotNull()).groupBy("host_id").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    top = hc.orderBy(F.desc("n"), F.asc("host_id")).limit(max(ns))
    w = Window.orderBy(F.desc("n"), F.asc("host_id"))  # <= max(ns) rows
    r = top.select(F.row_number().over(w).alias("rank"),
                   F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    # when there are fewer hosts than n, the share is that of all hosts
    m = r.agg(F.max("rank")).scalar()
    share = (F.col("cum") * 100.0 / total).cast("double").alias("pct_of_listings")
    parts = [r.where(F.col("rank") == F.least(F.lit(int(n)), m)).select(F.lit(int(n)).cast("bigint").alias("top_n"),
                                                                        share) for n in ns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- licences -----------------------------------------------------------------

def _has_license(c):
    return c.isNotNull() & (c != "")


def license_presence(stg_listings: DataFrame) -> DataFrame:
    lic = F.col("license")
    status = F.when(lic.isNull() | (lic == ""), "No license listed").otherwise("Has license")
    return stg_listings.groupBy(status.alias("license_status")).agg(F.count(F.lit(1)).alias("listing_count"))


def license_duplicates(stg_listings: DataFrame, top: int = 10) -> DataFrame:
    g = (stg_listings.where(_has_license(F.col("license"))).groupBy("license")
         .agg(F.count(F.lit(1)).alias("listings_using_this_license")).where(F.col("listings_using_this_license") > 1))
    return g.orderBy(F.desc("listings_using_this_license"), F.asc("license")).limit(top)


def license_distinct(stg_listings: DataFrame) -> DataFrame:
    return (stg_listings.where(_has_license(F.col("license")))
            .agg(F.count_distinct("license").alias("unique_license_count")))


def license_top_text(stg_listings: DataFrame, top: int = 5) -> DataFrame:
    g = stg_listings.where(_has_license(F.col("license"))).groupBy("license").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), F.asc("license")).limit(top)


def license_category(stg_listings: DataFrame, version: int = 2, rules=None) -> DataFrame:
    cat = TX.license_category(F.col("license"), version, rules)
    return stg_listings.groupBy(cat.alias("license_category")).agg(F.count(F.lit(1)).alias("n"))


def license_number(stg_listings: DataFrame) -> DataFrame:
    num = TX.license_number(F.col("license"))
    df = stg_listings.select(num.alias("hutb_number"))
    return df.agg(F.count("hutb_number").alias("listings_with_number"),
                  F.count_distinct("hutb_number").alias("unique_numbers"))


def license_genuine_v1(stg_listings: DataFrame) -> DataFrame:
    """Distinct licence texts in the v1 'genuine' class."""
    cat = TX.license_category(F.col("license"), 1)
    return (stg_listings.where(cat == "genuine_hut_number")
            .agg(F.count_distinct("license").alias("unique_genuine_texts")))


def license_residual(stg_listings: DataFrame, version: int = 2, n: int = 10, width: int = 150) -> DataFrame:
    """First ``n`` unclassified licence texts (by listing id), cut to ``width``
    characters for display."""
    cat = TX.license_category(F.col("license"), version)
    return (stg_listings.where((cat == "other") & F.col("license").isNotNull())
            .orderBy("id").limit(n).select("id", F.substring("license", 1, width).alias("license")))
