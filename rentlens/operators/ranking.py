"""Distributed running sums, ranks and exact quantiles.

A window with an ORDER BY but no PARTITION BY moves every row to one task, and
one that is partitioned by a hot key moves that key's rows to one task.  The
helpers here compute the same running sum in two steps:

1. the rows are dealt by ranges of the whole order (group, sort key and
   tie-breakers, so neither a hot group nor a heavy tie ends up in one range),
   the range numbers are written to the shared folder once, so that every later
   evaluation sees the same ranges, and the running sum is taken inside each
   range;
2. each (range, group) is summed, these sums - one row per range and group in
   it - become offsets, and the offsets are joined back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.session import scratch_path


def _default_buckets(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def _ranged(df: DataFrame, order: list[Column], buckets: int) -> DataFrame:
    spark = df.sparkSession
    d = df.repartitionByRange(buckets, *order).withColumn("_b", F.spark_partition_id())
    path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
    d.write.parquet(path)
    return spark.read.schema(d.schema).parquet(path)


def prefix_sums(df: DataFrame, key: str, sums: dict[str, str], descending: bool = False, ties: list[Column] | None = None,
                buckets: int | None = None, by: list[str] | None = None, total: str | None = None) -> DataFrame:
    """Add inclusive running sums (result column -> summed column) ordered by
    ``key`` (descending if asked), then by ``ties``, within each group of
    ``by`` (columns without nulls); ``total`` names a column for the group's
    sum of the first of them."""
    by = list(by or [])
    order = [F.col(key).desc() if descending else F.col(key).asc(), *(ties or [])]
    d = _ranged(df, [F.col(c).asc() for c in by] + order, buckets or _default_buckets(df))
    w_local = Window.partitionBy("_b", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_off = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    w_all = Window.partitionBy(*by)
    totals = d.groupBy("_b", *by).agg(*[F.sum(v).alias(f"_tot_{k}") for k, v in sums.items()])
    cols = {f"_off_{k}": F.coalesce(F.sum(f"_tot_{k}").over(w_off), F.lit(0)) for k in sums}
    if total:
        cols[total] = F.sum(f"_tot_{next(iter(sums))}").over(w_all)
    offsets = totals.withColumns(cols).select("_b", *by, *cols)
    local = d.withColumns({f"_local_{k}": F.sum(v).over(w_local) for k, v in sums.items()})
    return (local.join(offsets, ["_b", *by])
            .withColumns({k: F.col(f"_local_{k}") + F.col(f"_off_{k}") for k in sums})
            .drop("_b", *[f"_local_{k}" for k in sums], *[f"_off_{k}" for k in sums]))


def prefix_sum(df: DataFrame, key: str, value: str, out: str, descending: bool = False,
               ties: list[Column] | None = None, buckets: int | None = None, by: list[str] | None = None,
               total: str | None = None) -> DataFrame:
    """One running sum; see ``prefix_sums``."""
    return prefix_sums(df, key, {out: value}, descending, ties, buckets, by, total)


def row_rank(df: DataFrame, key: str, out: str = "rank", descending: bool = False,
             ties: list[Column] | None = None, buckets: int | None = None) -> DataFrame:
    """1-based position of each row in the order (a distributed row_number)."""
    return prefix_sum(df.withColumn("_one", F.lit(1).cast("bigint")), key, "_one", out, descending, ties,
                      buckets).drop("_one")


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles, a column per entry of ``probs``, per group
    of ``by`` (or one row).  Values are counted first and the positions found
    from running sums, so no task holds a group's values."""
    by = list(by or [])
    x = F.col(value).cast("double")
    vc = df.where(x.isNotNull()).groupBy(*by, x.alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    cum = prefix_sum(vc, "_x", "_n", "_cum", by=by, total="_total")
    aggs = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        first = F.min(F.when(F.col("_cum") > F.floor(at), F.col("_x")))
        second = F.min(F.when(F.col("_cum") > F.ceil(at), F.col("_x")))
        part = F.max(at - F.floor(at))
        aggs.append((first + (second - first) * part).alias(name))
    return (cum.groupBy(*by) if by else cum).agg(*aggs)


def grouped(df: DataFrame, by: list[str], aggs: list[Column], probs: dict[str, dict[str, float]]) -> DataFrame:
    """``df`` grouped by ``by`` (one row if empty; a null is a group like any other)
    with ``aggs`` and exact quantiles: ``probs`` names, for each value column, the
    result columns and their shares. A group without values gets null."""
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    d = df.withColumn("_k", key)
    g = (d.groupBy("_k", *by).agg(*aggs) if by else d.agg(*aggs).withColumn("_k", key))
    for value, named in probs.items():
        g = g.join(quantiles(d.select("_k", value), value, named, ["_k"]), "_k", "left")
    return g.drop("_k")
