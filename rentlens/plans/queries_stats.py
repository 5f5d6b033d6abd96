"""Registered statistics queries (§2.7).

Statistics (U, H, W, chi-square, effect sizes) are checked against DuckDB
SQL written with window functions; the p-values have no SQL form and are
registered separately (``*_test``), checked by row count here and against
reference values of the distributions in the unit tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.operators import frames, seasons, stats
from rentlens.operators.market import group_price_rows
from rentlens.plans.oracle import q
from rentlens.plans.registry import register, warehouse

D = 4
# groups compared in the stand-in data (the reference compared its own labels)
H1_GROUPS = ("1-URGENT", "2-HIGH")  # room types
H3_CUT = 4  # "many reviews" threshold for the stand-in review counts (the reference used 10)


def _r(df, cols):
    return df.select(*[F.round(c, D).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- frames ---------------------------------------------------------------------

def h1_frame(wh):
    """Price by room type, active valid listings of the two room types."""
    df = frames.listing_perf(wh).where((F.col("demand_segment") == "active") & F.col("price_is_valid")
                                       & F.col("room_type").isin(*H1_GROUPS))
    return df.select(F.col("room_type").alias("g"), F.col("price").alias("x"))


def h2_frame(wh):
    """Rating by superhost flag (host dimension join, rating present)."""
    df = (wh.dim_host.join(wh.dim_listing, "host_id").join(wh.fact_listing_performance, "listing_id")
          .where(F.col("host_is_superhost").isin("t", "f") & F.col("review_scores_rating").isNotNull()))
    return df.select(F.col("host_is_superhost").alias("g"), F.col("review_scores_rating").alias("x"))


def h3_frame(wh):
    """Price of active listings: more than H3_CUT reviews vs the rest."""
    df = frames.listing_perf(wh).where((F.col("demand_segment") == "active") & F.col("price").isNotNull())
    g = F.when(F.col("number_of_reviews") > H3_CUT, "high").otherwise("low")
    return df.select(g.alias("g"), F.col("price").alias("x"))


def h4_frame(wh):
    return group_price_rows(wh).select(F.col("neighbourhood_group").alias("g"), F.col("price").alias("x"))


_H1_SQL = """
, d AS (SELECT l.room_type AS g, f.price AS x FROM fact_listing_performance f
        JOIN dim_listing l ON f.listing_id = l.listing_id JOIN v_listing_demand v ON f.listing_id = v.listing_id
        WHERE v.demand_segment = 'active' AND l.price_is_valid AND l.room_type IN ('1-URGENT', '2-HIGH'))
"""
_H2_SQL = """
, d AS (SELECT h.host_is_superhost AS g, f.review_scores_rating AS x
        FROM dim_host h JOIN dim_listing l ON h.host_id = l.host_id
        JOIN fact_listing_performance f ON l.listing_id = f.listing_id
        WHERE h.host_is_superhost IN ('t', 'f') AND f.review_scores_rating IS NOT NULL)
"""
_H3_SQL = f"""
, d AS (SELECT CASE WHEN f.number_of_reviews > {H3_CUT} THEN 'high' ELSE 'low' END AS g, f.price AS x
        FROM fact_listing_performance f JOIN v_listing_demand v ON f.listing_id = v.listing_id
        WHERE v.demand_segment = 'active' AND f.price IS NOT NULL)
"""
_H4_SQL = """
, d AS (SELECT DISTINCT n.neighbourhood_group AS g, f.price AS x, f.listing_id
        FROM fact_listing_performance f JOIN dim_listing l ON f.listing_id = l.listing_id
        JOIN dim_neighbourhood n ON l.neighbourhood_name = n.neighbourhood_name
        JOIN v_listing_demand v ON f.listing_id = v.listing_id
        WHERE v.demand_segment = 'active' AND l.price_is_valid)
"""


def _mw_sql(base: str, g1: str, g2: str, alternative: str) -> str:
    u = {"greater": "u1", "less": "u2"}.get(alternative, "greatest(u1, u2)")
    return q(base + f"""
, vc AS (SELECT x, count(*) FILTER (WHERE g = '{g1}') AS c0, count(*) FILTER (WHERE g = '{g2}') AS c1
         FROM d WHERE x IS NOT NULL AND g IN ('{g1}', '{g2}') GROUP BY x),
rr AS (SELECT c0, CAST(c0 + c1 AS DOUBLE) AS t,
              CAST(coalesce(sum(c0 + c1) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              + CAST(c0 + c1 + 1 AS DOUBLE) / 2 AS rnk FROM vc),
s AS (SELECT CAST(sum(c0) AS DOUBLE) AS n1, CAST(sum(t) - sum(c0) AS DOUBLE) AS n2, sum(c0 * rnk) AS r1,
             sum(t * t * t - t) AS tie_term FROM rr),
s2 AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u1 FROM s),
s3 AS (SELECT *, n1 * n2 - u1 AS u2 FROM s2),
s4 AS (SELECT *, {u} AS u FROM s3)
SELECT n1, n2, u1, u2, u, tie_term,
       round((u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie_term / ((n1 + n2) * (n1 + n2 - 1)))), {D}) AS z,
       round(1 - 2 * u1 / (n1 * n2), {D}) AS rank_biserial, round(abs(1 - 2 * u1 / (n1 * n2)), {D}) AS rank_biserial_abs
FROM s4
""")


_MW_COLS = ("z", "rank_biserial", "rank_biserial_abs")


@register("mann_whitney", _mw_sql(_H1_SQL, *H1_GROUPS, "greater"))
def mann_whitney(spark, sf_dir):
    """H1: U and rank-biserial effect, price of room type A > B (one-sided)."""
    d = h1_frame(warehouse(spark, sf_dir))
    return _r(stats.mann_whitney(d, "x", "g", *H1_GROUPS, "greater", with_p=False), _MW_COLS)


@register("mann_whitney_superhost", _mw_sql(_H2_SQL, "t", "f", "greater"))
def mann_whitney_superhost(spark, sf_dir):
    """H2: rating of superhosts > others (one-sided)."""
    d = h2_frame(warehouse(spark, sf_dir))
    return _r(stats.mann_whitney(d, "x", "g", "t", "f", "greater", with_p=False), _MW_COLS)


@register("mann_whitney_reviews", _mw_sql(_H3_SQL, "high", "low", "two-sided"))
def mann_whitney_reviews(spark, sf_dir):
    """H3: price of listings with many vs few reviews (two-sided, |effect|)."""
    d = h3_frame(warehouse(spark, sf_dir))
    return _r(stats.mann_whitney(d, "x", "g", "high", "low", "two-sided", with_p=False), _MW_COLS)


@register("mann_whitney_test")
def mann_whitney_test(spark, sf_dir):
    """H1 with the p-value (normal approximation, tie and continuity corrected)."""
    return stats.mann_whitney(h1_frame(warehouse(spark, sf_dir)), "x", "g", *H1_GROUPS, "greater")


@register("rank_biserial", _mw_sql(_H2_SQL, "t", "f", "greater").replace(
    "SELECT n1, n2, u1, u2, u, tie_term,", "SELECT u1, n1, n2,").replace(
    f"""       round((u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie_term / ((n1 + n2) * (n1 + n2 - 1)))), {D}) AS z,
""", ""))
def rank_biserial(spark, sf_dir):
    """Rank-biserial effect size 1 - 2U/(n1 n2), signed and absolute (H2)."""
    r = stats.mann_whitney(h2_frame(warehouse(spark, sf_dir)), "x", "g", "t", "f", "greater", with_p=False)
    return _r(r.select("u1", "n1", "n2", "rank_biserial", "rank_biserial_abs"), _MW_COLS)


_KW_SQL = q(_H4_SQL + f"""
, gv AS (SELECT g, x, count(*) AS c FROM d WHERE x IS NOT NULL AND g IS NOT NULL GROUP BY g, x),
vt AS (SELECT x, sum(c) AS t FROM gv GROUP BY x),
rk AS (SELECT x, CAST(t AS DOUBLE) AS t,
              CAST(coalesce(sum(t) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              + (CAST(t AS DOUBLE) + 1) / 2 AS rnk FROM vt),
pg AS (SELECT g, CAST(sum(c) AS DOUBLE) AS ng, sum(c * rnk) AS rg FROM gv JOIN rk USING (x) GROUP BY g),
s AS (SELECT sum(ng) AS n, CAST(count(*) AS DOUBLE) AS k, sum(rg * rg / ng) AS ssr,
             (SELECT sum(t * t * t - t) FROM rk) AS tie_term FROM pg),
hh AS (SELECT *, (12.0 / (n * (n + 1)) * ssr - 3 * (n + 1)) / (1 - tie_term / (n * n * n - n)) AS h FROM s)
SELECT n, k, round(h, {D}) AS h, tie_term, round((h - k + 1) / (n - k), {D}) AS eta_squared FROM hh
""")


@register("kruskal", _KW_SQL)
def kruskal(spark, sf_dir):
    """H4: Kruskal-Wallis H (tie corrected) and eta squared across groups."""
    return _r(stats.kruskal(h4_frame(warehouse(spark, sf_dir)), "x", "g", with_p=False), ("h", "eta_squared"))


@register("kruskal_test")
def kruskal_test(spark, sf_dir):
    """H4 with the chi-square p-value (k - 1 df)."""
    return stats.kruskal(h4_frame(warehouse(spark, sf_dir)), "x", "g")


_PAIR_SQL = q(_H4_SQL + f"""
, gv AS (SELECT g, x, count(*) AS c FROM d WHERE x IS NOT NULL AND g IS NOT NULL GROUP BY g, x),
gs AS (SELECT DISTINCT g FROM gv),
pairs AS (SELECT a.g AS group1, b.g AS group2 FROM gs a JOIN gs b ON a.g < b.g),
pv AS (SELECT p.group1, p.group2, gv.x,
              sum(CASE WHEN gv.g = p.group1 THEN c ELSE 0 END) AS c1, sum(CASE WHEN gv.g = p.group2 THEN c ELSE 0 END) AS c2
       FROM pairs p JOIN gv ON gv.g = p.group1 OR gv.g = p.group2 GROUP BY 1, 2, 3),
pr AS (SELECT *, CAST(c1 + c2 AS DOUBLE) AS t,
              CAST(coalesce(sum(c1 + c2) OVER (PARTITION BY group1, group2 ORDER BY x
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              + CAST(c1 + c2 + 1 AS DOUBLE) / 2 AS rnk FROM pv),
s AS (SELECT group1, group2, CAST(sum(c1) AS DOUBLE) AS n1, CAST(sum(c2) AS DOUBLE) AS n2, sum(c1 * rnk) AS r1,
             sum(t * t * t - t) AS tie_term FROM pr GROUP BY 1, 2),
s2 AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u1 FROM s),
med AS (SELECT g, median(x) AS m FROM d WHERE x IS NOT NULL GROUP BY g),
sz AS (SELECT *, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5)
                 / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie_term / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM s2),
-- two-sided p = 1 - erf(z / sqrt 2), by erf x = exp(-x^2) sum of x^(2 n + 1) / gamma(n + 3/2); no group is small enough for an exact p
sp AS (SELECT *, CASE WHEN z > 10 THEN 0.0 WHEN z > 0 THEN
                     greatest(1 - list_sum(list_transform(range(0, 400), lambda n: exp((2 * n + 1) * ln(z / sqrt(2)) - z * z / 2 - lgamma(n + 1.5)))), 0.0)
                 ELSE 1.0 END AS p FROM sz),
sb AS (SELECT *, least(p * (SELECT count(*) FROM pairs), 1.0) AS pb FROM sp)
SELECT group1, group2, n1, n2, u1, round(z, {D}) AS z, round(m1.m, {D}) AS median1, round(m2.m, {D}) AS median2,
       round(p, {D}) AS p_raw, round(pb, {D}) AS p_bonferroni, pb < 0.05 AS significant
FROM sb JOIN med m1 ON m1.g = group1 JOIN med m2 ON m2.g = group2
""")


@register("pairwise_bonferroni", _PAIR_SQL)
def pairwise_bonferroni(spark, sf_dir):
    """All group pairs: two-sided U and z, group medians (ranks per pair), raw and Bonferroni p-values, significance."""
    r = stats.pairwise_mann_whitney(h4_frame(warehouse(spark, sf_dir)), "x", "g")
    return _r(r, ("z", "median1", "median2", "p_raw", "p_bonferroni"))


@register("pairwise_bonferroni_test")
def pairwise_bonferroni_test(spark, sf_dir):
    """All group pairs with raw and Bonferroni p-values and significance."""
    return stats.pairwise_mann_whitney(h4_frame(warehouse(spark, sf_dir)), "x", "g")


_LEV_SQL = q(_H1_SQL + f"""
, med AS (SELECT g, median(x) AS m FROM d GROUP BY g),
z AS (SELECT d.g, abs(d.x - med.m) AS z FROM d JOIN med USING (g)),
gs AS (SELECT g, CAST(count(*) AS DOUBLE) AS ni, avg(z) AS zi FROM z GROUP BY g),
tot AS (SELECT sum(ni) AS n, CAST(count(*) AS DOUBLE) AS k, sum(ni * zi) / sum(ni) AS zbar FROM gs),
sb AS (SELECT sum(ni * (zi - zbar) * (zi - zbar)) AS sb FROM gs, tot),
sw AS (SELECT sum((z.z - gs.zi) * (z.z - gs.zi)) AS sw FROM z JOIN gs USING (g))
SELECT n, k, round((n - k) / (k - 1) * sb / sw, {D}) AS w FROM tot, sb, sw
""")


@register("levene", _LEV_SQL)
def levene(spark, sf_dir):
    """Levene's W (median centre) for the H1 groups."""
    return _r(stats.levene(h1_frame(warehouse(spark, sf_dir)), "x", "g", with_p=False), ("w",))


@register("levene_test")
def levene_test(spark, sf_dir):
    """Levene's W with the F-distribution p-value."""
    return stats.levene(h1_frame(warehouse(spark, sf_dir)), "x", "g")


_CHI_SQL = q(f"""
, j AS (SELECT d.is_weekend AS w, coalesce(c.available, false) AS a FROM fact_calendar c JOIN dim_date d ON c.date = d.date),
t AS (SELECT count(*) FILTER (WHERE w AND a) AS weekend_available, count(*) FILTER (WHERE w AND NOT a) AS weekend_unavailable,
             count(*) FILTER (WHERE NOT w AND a) AS weekday_available,
             count(*) FILTER (WHERE NOT w AND NOT a) AS weekday_unavailable FROM j),
o AS (SELECT *, CAST(weekend_available AS DOUBLE) AS oa, CAST(weekend_unavailable AS DOUBLE) AS ob,
             CAST(weekday_available AS DOUBLE) AS oc, CAST(weekday_unavailable AS DOUBLE) AS od FROM t),
e AS (SELECT *, oa + ob + oc + od AS n, (oa + ob) * (oa + oc) / (oa + ob + oc + od) AS ea,
             (oa + ob) * (ob + od) / (oa + ob + oc + od) AS eb, (oc + od) * (oa + oc) / (oa + ob + oc + od) AS ec,
             (oc + od) * (ob + od) / (oa + ob + oc + od) AS ed FROM o),
c AS (SELECT *, pow(oa + sign(ea - oa) * least(0.5, abs(ea - oa)) - ea, 2) / ea
              + pow(ob + sign(eb - ob) * least(0.5, abs(eb - ob)) - eb, 2) / eb
              + pow(oc + sign(ec - oc) * least(0.5, abs(ec - oc)) - ec, 2) / ec
              + pow(od + sign(ed - od) * least(0.5, abs(ed - od)) - ed, 2) / ed AS chi2 FROM e)
SELECT weekend_available, weekend_unavailable, weekday_available, weekday_unavailable, n, round(chi2, {D}) AS chi2,
       1 AS dof, round(ea, {D}) AS expected_weekend_available, round(eb, {D}) AS expected_weekend_unavailable,
       round(ec, {D}) AS expected_weekday_available, round(ed, {D}) AS expected_weekday_unavailable,
       round(sqrt(chi2 / n), {D}) AS cramers_v
FROM c
""")

_CHI_COLS = ("chi2", "expected_weekend_available", "expected_weekend_unavailable", "expected_weekday_available",
             "expected_weekday_unavailable", "cramers_v")


def _chi(spark, sf_dir, with_p):
    t = seasons.weekend_table(warehouse(spark, sf_dir))
    return stats.chi_square_2x2(t, "weekend_available", "weekend_unavailable", "weekday_available",
                                "weekday_unavailable", with_p=with_p)


@register("chi_square_2x2", _CHI_SQL)
def chi_square_2x2(spark, sf_dir):
    """H5: weekend x available chi-square with Yates correction, expected counts, Cramér's V."""
    return _r(_chi(spark, sf_dir, False), _CHI_COLS)


@register("chi_square_test")
def chi_square_test(spark, sf_dir):
    """H5 with the p-value (1 df)."""
    return _chi(spark, sf_dir, True)


@register("cramers_v", _CHI_SQL.replace(
    "SELECT weekend_available, weekend_unavailable, weekday_available, weekday_unavailable, n, round(chi2, 4) AS chi2,",
    "SELECT n, round(chi2, 4) AS chi2,").replace(
    """       1 AS dof, round(ea, 4) AS expected_weekend_available, round(eb, 4) AS expected_weekend_unavailable,
       round(ec, 4) AS expected_weekday_available, round(ed, 4) AS expected_weekday_unavailable,
""", ""))
def cramers_v(spark, sf_dir):
    """Cramér's V of the weekend x available table."""
    return _r(_chi(spark, sf_dir, False).select("n", "chi2", "cramers_v"), ("chi2", "cramers_v"))


_MOM_SQL = q(_H4_SQL + f"""
, m AS (SELECT g, avg(x) AS mu FROM d GROUP BY g)
SELECT d.g AS g, count(x) AS n, round(avg(x), {D}) AS mean, round(median(x), {D}) AS median,
       round(stddev_samp(x), {D}) AS std,
       round(avg(pow(x - mu, 3)) / pow(avg(pow(x - mu, 2)), 1.5), {D}) AS skew
FROM d JOIN m USING (g) GROUP BY d.g
""")


@register("group_moments", _MOM_SQL)
def group_moments(spark, sf_dir):
    """n, mean, median, sample sd, population skewness of price by group."""
    return _r(stats.group_moments(h4_frame(warehouse(spark, sf_dir)), "x", "g"), ("mean", "median", "std", "skew"))


_CORR_COLS = ["price", "number_of_reviews", "review_scores_rating", "reviews_per_month"]


@register("corr_matrix", q(f"""
, d AS (SELECT f.price, f.number_of_reviews, f.review_scores_rating, f.reviews_per_month
        FROM fact_listing_performance f JOIN v_listing_demand v ON f.listing_id = v.listing_id
        WHERE v.demand_segment = 'active' AND f.price IS NOT NULL AND f.review_scores_rating IS NOT NULL),
c AS (SELECT {", ".join(f"corr({a}, {b}) AS c_{i}_{j}" for i, a in enumerate(_CORR_COLS)
                        for j, b in enumerate(_CORR_COLS) if i != j)} FROM d)
{" UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + (f"round(c_{i}_{j}, {D})" if i != j else "1.0")
                    + " AS r FROM c" for i, a in enumerate(_CORR_COLS) for j, b in enumerate(_CORR_COLS))}
"""))
def corr_matrix(spark, sf_dir):
    """Pearson correlations of price, reviews, rating, reviews per month (active, rated)."""
    df = frames.listing_perf(warehouse(spark, sf_dir)).where(
        (F.col("demand_segment") == "active") & F.col("price").isNotNull() & F.col("review_scores_rating").isNotNull())
    return _r(stats.corr_matrix(df, _CORR_COLS), ("r",))


@register("linear_trend", q(f"""
SELECT round(regr_slope(review_scores_rating, review_scores_value), {D}) AS slope,
       round(regr_intercept(review_scores_rating, review_scores_value), {D}) AS intercept,
       regr_count(review_scores_rating, review_scores_value) AS n
FROM fact_listing_performance
"""))
def linear_trend(spark, sf_dir):
    """Least-squares line of rating on the value score (degree-1 fit)."""
    df = warehouse(spark, sf_dir).fact_listing_performance
    r = stats.linear_trend(df, "review_scores_rating", "review_scores_value")
    return _r(r.withColumn("n", F.col("n").cast("bigint")), ("slope", "intercept"))


_PEER_SQL = """
, pe AS (SELECT id AS listing_id, neighbourhood_group_cleansed AS neighbourhood_group, room_type, price
         FROM stg_listings WHERE price > 0)
"""


@register("peer_median", q(_PEER_SQL + f"""
SELECT neighbourhood_group, room_type, round(median(price), {D}) AS peer_median, count(*) AS peer_n
FROM pe GROUP BY 1, 2
"""))
def peer_median(spark, sf_dir):
    """Median price of each (group, room type) peer set, price > 0."""
    s = warehouse(spark, sf_dir).stg_listings.select(
        F.col("neighbourhood_group_cleansed").alias("neighbourhood_group"), "room_type", "price")
    return _r(stats.peer_medians(s, ["neighbourhood_group", "room_type"]), ("peer_median",))


@register("percentile_of_score", q(_PEER_SQL + f"""
SELECT neighbourhood_group, room_type, listing_id, price AS score,
       round(CAST(count(*) OVER (PARTITION BY neighbourhood_group, room_type ORDER BY price
                                 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) * 100
             / count(*) OVER (PARTITION BY neighbourhood_group, room_type), {D}) AS percentile
FROM pe
"""))
def percentile_of_score(spark, sf_dir):
    """Every listing's price as a percentile of its peers (same group and room type)."""
    s = warehouse(spark, sf_dir).stg_listings.select(
        F.col("id").alias("listing_id"), F.col("neighbourhood_group_cleansed").alias("neighbourhood_group"),
        "room_type", "price")
    scores = s.where(F.col("price") > 0).withColumnRenamed("price", "score")
    r = stats.percentile_of_score(s, scores, ["neighbourhood_group", "room_type"])
    return _r(r, ("percentile",))
