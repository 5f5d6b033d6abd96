"""Statistical tests and effect sizes as Spark jobs.

Rank tests never sort the data in one task: values are first counted per
distinct value (a partial + final aggregation), mid-ranks come from a
distributed running sum over the distinct values (``ranking.prefix_sum``),
and rank sums are aggregated back per group.  Only the final scalar step
(a tail probability) runs as a Pandas UDF on the one-row result.

All tests follow SciPy's defaults as used in the reference:
Mann-Whitney U exact for a small sample without ties, else with tie and
continuity correction (normal approximation),
Kruskal-Wallis H with tie correction, Levene with the median as centre,
chi-square on a 2x2 table with Yates' correction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.functions import distributions as DIST
from rentlens.operators import ranking
from rentlens.operators.ranking import prefix_sum, quantiles

#: Sample sizes up to which Mann-Whitney p-values without ties are counted exactly.
EXACT_SMALLER, EXACT_LARGER = 8, 10_000


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def value_counts(df: DataFrame, value: str, group: str, groups: list) -> DataFrame:
    """One row per distinct value with its count in each of ``groups``."""
    d = df.where(F.col(value).isNotNull() & F.col(group).isin(list(groups)))
    aggs = [F.count_if(F.col(group) == g).alias(f"c{i}") for i, g in enumerate(groups)]
    return d.groupBy(F.col(value).alias("x")).agg(*aggs)


def mid_ranks(vc: DataFrame, count_cols: list[str]) -> DataFrame:
    """Add t (ties at the value) and the mid-rank of each distinct value."""
    t = sum((F.col(c) for c in count_cols[1:]), F.col(count_cols[0]))
    vc = vc.withColumn("t", t.cast("bigint"))
    cum = ranking.prefix_sum(vc, "x", "t", "cum")
    return cum.withColumn("rank", (F.col("cum") - F.col("t")).cast("double") + (F.col("t") + 1) / 2.0)


def _mann_whitney_p(u: Column, sides: float) -> Column:
    """p of the columns n1, n2, tie_term and z: exact (all splits counted) without ties if one sample has at most
    ``EXACT_SMALLER`` values and the other at most ``EXACT_LARGER``, else the normal approximation."""
    n1, n2 = F.col("n1"), F.col("n2")
    exact = (F.col("tie_term") == 0) & F.least(n1, n2).between(1, EXACT_SMALLER) & (F.greatest(n1, n2) <= EXACT_LARGER)
    seen = [F.when(exact, c) for c in (n1, n2, u)]  # null where the approximation is taken
    p = F.when(exact, DIST.mann_whitney_exact_sf_col(*seen)).otherwise(DIST.normal_sf_col(F.col("z"))) * sides
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def mann_whitney(df: DataFrame, value: str, group: str, g1, g2, alternative: str = "two-sided",
                 with_p: bool = True) -> DataFrame:
    """One row: n1, n2, u1 (statistic of the first sample), u2, the U used for
    the test, tie term, z, p, and the rank-biserial effect 1 - 2*U1/(n1*n2)
    (signed, and its absolute value).  p is exact (all splits counted) without
    ties if one sample has at most ``EXACT_SMALLER`` values and the other at most
    ``EXACT_LARGER``, else the normal approximation."""
    vc = value_counts(df, value, group, [g1, g2])
    r = mid_ranks(vc, ["c0", "c1"])
    s = r.agg(F.sum("c0").cast("double").alias("n1"), F.sum("c1").cast("double").alias("n2"),
              F.sum(F.col("c0") * F.col("rank")).alias("r1"),
              F.sum(_d("t") * _d("t") * _d("t") - _d("t")).alias("tie_term"))
    n1, n2 = F.col("n1"), F.col("n2")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    s = s.withColumn("u1", u1).withColumn("u2", n1 * n2 - F.col("u1"))
    if alternative == "greater":
        u, f = F.col("u1"), 1.0
    elif alternative == "less":
        u, f = F.col("u2"), 1.0
    else:
        u, f = F.greatest("u1", "u2"), 2.0
    n = n1 + n2
    sd = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("tie_term") / (n * (n - 1))))
    s = (s.withColumn("u", u)
         .withColumn("z", (F.col("u") - n1 * n2 / 2.0 - 0.5) / F.nullif(sd, F.lit(0.0)))
         .withColumn("rank_biserial", 1 - 2 * F.col("u1") / F.nullif(n1 * n2, F.lit(0.0)))
         .withColumn("rank_biserial_abs", F.abs("rank_biserial")))
    cols = ["n1", "n2", "u1", "u2", "u", "tie_term", "z", "rank_biserial", "rank_biserial_abs"]
    if with_p:
        s = s.withColumn("p_value", _mann_whitney_p(F.col("u"), f))
        cols.append("p_value")
    return s.select(*cols)


def kruskal(df: DataFrame, value: str, group: str, with_p: bool = True) -> DataFrame:
    """One row: n, k, H (tie corrected), eta squared (H - k + 1)/(n - k), p."""
    d = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    gv = d.groupBy(F.col(group).alias("g"), F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    vt = gv.groupBy("x").agg(F.sum("c").cast("bigint").alias("t"))
    cum = ranking.prefix_sum(vt, "x", "t", "cum")
    rk = cum.select("x", "t", ((F.col("cum") - F.col("t")).cast("double") + (F.col("t") + 1) / 2.0).alias("rank"))
    per_group = (gv.join(rk, "x").groupBy("g")
                 .agg(F.sum("c").cast("double").alias("ng"), F.sum(F.col("c") * F.col("rank")).alias("rg")))
    ties = rk.agg(F.sum(_d("t") * _d("t") * _d("t") - _d("t")).alias("tie_term"))
    s = per_group.agg(F.sum("ng").alias("n"), F.count(F.lit(1)).cast("double").alias("k"),
                      F.sum(F.col("rg") * F.col("rg") / F.col("ng")).alias("ssr"))
    s = s.withColumn("tie_term", ties.scalar())
    n, k = F.col("n"), F.col("k")
    h0 = 12.0 / (n * (n + 1)) * F.col("ssr") - 3 * (n + 1)
    h = h0 / (1 - F.col("tie_term") / (n * n * n - n))
    s = s.withColumn("h", h).withColumn("eta_squared", (F.col("h") - k + 1) / (n - k))
    cols = ["n", "k", "h", "tie_term", "eta_squared"]
    if with_p:
        s = s.withColumn("p_value", DIST.chi2_sf_col(F.col("h"), k - 1))
        cols.append("p_value")
    return s.select(*cols)


def pairwise_mann_whitney(df: DataFrame, value: str, group: str, alpha: float = 0.05,
                          with_p: bool = True) -> DataFrame:
    """Two-sided Mann-Whitney for every unordered pair of groups (g1 < g2),
    Bonferroni-corrected, with p as in ``mann_whitney``.  Each group's value counts are copied once per pair
    it is in (k - 1 copies) and ranked per pair by running sums whose ranges
    split a pair like any other group of values."""
    d = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    gv = d.groupBy(F.col(group).alias("g"), F.col(value).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    names = gv.agg(F.array_sort(F.collect_set("g"))).scalar()  # one entry per group
    rep = gv.withColumn("_names", names).select("g", "x", "c", F.explode(F.array_remove("_names", F.col("g"))).alias("other"))
    own, other = F.col("g") < F.col("other"), F.col("c")
    pv = rep.groupBy(F.least("g", "other").alias("group1"), F.greatest("g", "other").alias("group2"), "x").agg(
        F.sum(F.when(own, other).otherwise(0)).alias("c1"), F.sum(F.when(own, 0).otherwise(other)).alias("c2"))
    pv = prefix_sum(pv.withColumn("t", F.col("c1") + F.col("c2")), "x", "t", "cum", by=["group1", "group2"])
    pv = pv.withColumn("rank", (F.col("cum") - F.col("t")).cast("double") + (F.col("t") + 1) / 2.0)
    s = pv.groupBy("group1", "group2").agg(
        F.sum("c1").cast("double").alias("n1"), F.sum("c2").cast("double").alias("n2"),
        F.sum(F.col("c1") * F.col("rank")).alias("r1"),
        F.sum(_d("t") * _d("t") * _d("t") - _d("t")).alias("tie_term"))
    n1, n2 = F.col("n1"), F.col("n2")
    s = s.withColumn("u1", F.col("r1") - n1 * (n1 + 1) / 2.0).withColumn("u2", n1 * n2 - F.col("u1"))
    n = n1 + n2
    sd = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("tie_term") / (n * (n - 1))))
    s = s.withColumn("z", (F.greatest("u1", "u2") - n1 * n2 / 2.0 - 0.5) / F.nullif(sd, F.lit(0.0)))
    med = quantiles(d.select(F.col(group).alias("g"), F.col(value).alias("x")), "x", {"med": 0.5}, ["g"])
    s = (s.join(med.select(F.col("g").alias("group1"), F.col("med").alias("median1")), "group1")
         .join(med.select(F.col("g").alias("group2"), F.col("med").alias("median2")), "group2"))
    cols = ["group1", "group2", "n1", "n2", "u1", "z", "median1", "median2"]
    if with_p:
        p = _mann_whitney_p(F.greatest("u1", "u2"), 2.0)
        pairs = F.size("_names") * (F.size("_names") - 1) / 2
        s = (s.withColumn("p_raw", p).withColumn("_names", names)
             .withColumn("p_bonferroni", F.least(F.col("p_raw") * pairs, F.lit(1.0)))
             .withColumn("significant", F.col("p_bonferroni") < alpha))
        cols += ["p_raw", "p_bonferroni", "significant"]
    return s.select(*cols)


def levene(df: DataFrame, value: str, group: str, groups: list | None = None, with_p: bool = True) -> DataFrame:
    """Brown-Forsythe form of Levene's test (centre = group median)."""
    d = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    if groups is not None:
        d = d.where(F.col(group).isin(list(groups)))
    d = d.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x"))
    med = quantiles(d, "x", {"med": 0.5}, ["g"])  # one row per group
    z = d.join(med, "g").withColumn("z", F.abs(F.col("x") - F.col("med")))
    gs = z.groupBy("g").agg(F.count(F.lit(1)).cast("double").alias("ni"), F.avg("z").alias("zi"))
    within = z.join(gs, "g").agg(F.sum(F.pow(F.col("z") - F.col("zi"), 2)).alias("sw"))
    s = gs.agg(F.sum("ni").alias("n"), F.count(F.lit(1)).cast("double").alias("k"),
               (F.sum(F.col("ni") * F.col("zi")) / F.sum("ni")).alias("zbar"),
               F.collect_list(F.struct("ni", "zi")).alias("gl"))  # k entries
    sb = F.aggregate("gl", F.lit(0.0), lambda acc, e: acc + e["ni"] * F.pow(e["zi"] - F.col("zbar"), 2))
    s = s.withColumn("sb", sb).withColumn("sw", within.scalar())
    n, k = F.col("n"), F.col("k")
    s = s.withColumn("w", (n - k) / (k - 1) * F.col("sb") / F.col("sw"))
    cols = ["n", "k", "w"]
    if with_p:
        s = s.withColumn("p_value", DIST.f_sf_col(F.col("w"), k - 1, n - k))
        cols.append("p_value")
    return s.select(*cols)


def chi_square_2x2(table: DataFrame, a: str, b: str, c: str, d: str, correction: bool = True,
                   with_p: bool = True) -> DataFrame:
    """Chi-square of [[a, b], [c, d]] with Yates' correction (SciPy's rule:
    each cell moves at most 0.5 toward its expected count); df = 1;
    Cramér's V = sqrt(chi2 / (n * (min(r, c) - 1)))."""
    o = {k: _d(k) for k in (a, b, c, d)}
    n = o[a] + o[b] + o[c] + o[d]
    r1, r2, c1, c2 = o[a] + o[b], o[c] + o[d], o[a] + o[c], o[b] + o[d]
    exp = {a: r1 * c1 / n, b: r1 * c2 / n, c: r2 * c1 / n, d: r2 * c2 / n}
    chi = F.lit(0.0)
    for k in (a, b, c, d):
        diff = exp[k] - o[k]
        adj = o[k] + (F.signum(diff) * F.least(F.lit(0.5), F.abs(diff)) if correction else F.lit(0.0))
        chi = chi + F.pow(adj - exp[k], 2) / exp[k]
    out = table.select(*[F.col(k) for k in (a, b, c, d)], n.alias("n"), chi.alias("chi2"), F.lit(1).alias("dof"),
                       *[exp[k].alias(f"expected_{k}") for k in (a, b, c, d)])
    out = out.withColumn("cramers_v", F.sqrt(F.col("chi2") / (F.col("n") * 1)))
    if with_p:
        out = out.withColumn("p_value", DIST.chi2_sf_col(F.col("chi2"), F.lit(1.0)))
    return out


def group_moments(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """n, mean, median, sample sd and population skewness (SciPy ``skew``)."""
    by = [group] if group else []
    aggs = [F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.skewness(value).alias("skew")]
    g = ranking.grouped(df.where(F.col(value).isNotNull()).select(*by, value), by, aggs, {value: {"median": 0.5}})
    return g.select(*by, "n", "mean", "median", "std", "skew")


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (pairwise-complete), long form."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(a, b).alias(f"{i}") if a != b else F.lit(1.0).alias(f"{i}")
                   for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', `{i}`" for i, (a, b) in enumerate(pairs))
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, r)")


def linear_trend(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line y = slope * x + intercept (degree-1 fit)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_count(y, x).alias("n"))


def peer_medians(df: DataFrame, keys: list[str], value: str = "price") -> DataFrame:
    """Median of ``value`` > 0 per peer group."""
    d = df.where(F.col(value) > 0).dropna(subset=keys)
    return quantiles(d, value, {"peer_median": 0.5}, keys).join(d.groupBy(*keys).agg(F.count(F.lit(1)).alias("peer_n")), keys)


def percentile_of_score(peers: DataFrame, scores: DataFrame, keys: list[str], value: str = "price",
                        score: str = "score") -> DataFrame:
    """The rows of ``scores`` (keys, score and any other columns) with
    ``percentile``, the % of peer values (> 0, same keys) that are <= the
    row's score (``kind='weak'``).

    Peer values (counted per distinct value) and scores go into one stream per
    key, ordered by value with scores after equal peer values; a running sum
    of peer counts is the number of peers at or below each score.  Ranges of
    that order split a key of any size, and each row carries its columns with
    it, so nothing is joined back."""
    carried = [c for c in scores.columns if c not in (*keys, score)]
    p = (peers.where(F.col(value) > 0).dropna(subset=keys).groupBy(*keys, F.col(value).cast("double").alias("_v"))
         .agg(F.count(F.lit(1)).alias("_w")).withColumn("_is_score", F.lit(0)))
    s = scores.withColumn("_v", F.col(score).cast("double")).withColumn("_w", F.lit(0).cast("bigint")).withColumn("_is_score", F.lit(1)).drop(score)
    known = s.dropna(subset=keys)
    u = prefix_sum(known.unionByName(p, allowMissingColumns=True), "_v", "_w", "_below", by=keys, ties=[F.col("_is_score").asc()])
    total = p.groupBy(*keys).agg(F.sum("_w").alias("_total"))  # one row per key
    out = u.where("_is_score = 1").join(total, keys, "left").withColumn(
        "percentile", (F.col("_below") * 100.0 / F.nullif(F.col("_total"), F.lit(0))).cast("double"))
    cols = [*keys, *carried, F.col("_v").alias(score)]
    without = s.where(" OR ".join(f"`{k}` IS NULL" for k in keys)).select(*cols, F.lit(None).cast("double").alias("percentile"))
    return out.select(*cols, "percentile").unionByName(without)
