"""Checks before data and models are published, and a fallback recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentlens.functions import columns as C
from rentlens.operators.ranking import quantiles
from rentlens.operators.warehouse import Warehouse

#: A model replaces the current one if it is better by more than this share; a drift above this index is reported.
MIN_GAIN, MAX_PSI = 0.01, 0.2


class ValidationError(RuntimeError):
    """The data must not be published."""


def validation_gate(stg_listings: DataFrame, min_rows: int = 1, max_price: float = 1_000_000.0) -> DataFrame:
    """(rule, n_bad, passed): row count, price range and coordinate bounds, in one aggregate."""
    price = F.col("price")
    rules = {"row_count": F.greatest(F.lit(min_rows) - F.count(F.lit(1)), F.lit(0)),
             "price_range": F.count_if(price.isNotNull() & ~price.between(0, max_price)),
             "coordinate_bounds": F.count_if(~C.flag_location_valid(F.col("latitude"), F.col("longitude")))}
    row = stg_listings.agg(*[n.cast("bigint").alias(rule) for rule, n in rules.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("n_bad"), (F.col(r) == 0).alias("passed"))
                                         for r in rules])))


def require_valid(gate: DataFrame) -> None:
    """Halts on the first failed rules of a gate (a few rows)."""
    if failed := [r["rule"] for r in gate.where("NOT passed").collect()]:
        raise ValidationError(f"failed: {', '.join(failed)}")


def model_gate(current: DataFrame, candidate: DataFrame, metric: str = "rmse", min_gain: float = MIN_GAIN) -> DataFrame:
    """One row: the metric (lower is better) of both one-row frames, the gain, and whether the candidate is accepted."""
    both = current.select(F.col(metric).alias("current")).withColumn("candidate", candidate.select(metric).scalar())
    return both.withColumn("gain", 1 - F.col("candidate") / F.nullif(F.col("current"), F.lit(0.0))).withColumn("accepted", F.col("gain") > min_gain)


def psi_drift(base: DataFrame, now: DataFrame, col: str, bins: int = 10, limit: float = MAX_PSI) -> DataFrame:
    """One row: population stability index of ``col`` over the base's quantile bins, and whether it is above the limit.

    An empty bin counts as half a row on its side.
    """
    edges = quantiles(base, col, {f"q{i}": i / bins for i in range(1, bins)})
    cuts = F.array(*[F.col(f"q{i}") for i in range(1, bins)])

    def counted(df, name):
        x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x")).withColumn("cuts", edges.agg(F.first(cuts)).scalar())
        return x.groupBy(F.size(F.filter("cuts", lambda c: c < F.col("x"))).alias("bin")).agg(F.count(F.lit(1)).alias(name))

    both = counted(base, "a").join(counted(now, "b"), "bin", "full")
    n = F.sum("a"), F.sum("b")
    rows = both.agg(F.collect_list(F.struct(F.coalesce("a", F.lit(0.5)).alias("a"), F.coalesce("b", F.lit(0.5)).alias("b"))).alias("bins"),
                    n[0].alias("na"), n[1].alias("nb"))  # at most ``bins`` entries
    share = lambda x: (x["a"] / F.col("na"), x["b"] / F.col("nb"))
    psi = F.aggregate("bins", F.lit(0.0), lambda acc, x: acc + (share(x)[0] - share(x)[1]) * F.log(share(x)[0] / share(x)[1]))
    return rows.select(psi.alias("psi"), (psi > limit).alias("drifted"))


def popularity_fallback(wh: Warehouse, top: int = 3) -> DataFrame:
    """The ``top`` most booked listings of each neighbourhood (occupancy, then reviews, then id).

    Each neighbourhood keeps a short list while it is aggregated: ranks are
    taken in parts first, so that no task sorts a whole neighbourhood.
    """
    order = [F.desc("estimated_occupancy_l365d"), F.desc("number_of_reviews"), F.asc("listing_id")]
    d = wh.listing_wide.where(F.col("neighbourhood_name").isNotNull()).select(
        "neighbourhood_name", "listing_id", F.coalesce("estimated_occupancy_l365d", F.lit(0)).alias("estimated_occupancy_l365d"),
        F.coalesce("number_of_reviews", F.lit(0)).alias("number_of_reviews"), F.pmod(F.xxhash64("listing_id"), F.lit(64)).alias("part"))
    first = d.withColumn("rank", F.row_number().over(Window.partitionBy("neighbourhood_name", "part").orderBy(*order))).where(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("neighbourhood_name").orderBy(*order))).where(F.col("rank") <= top)
    return last.select("neighbourhood_name", "rank", "listing_id", "estimated_occupancy_l365d", "number_of_reviews")
