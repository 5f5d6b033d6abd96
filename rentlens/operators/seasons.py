"""Month, season and weekend queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators import frames
from rentlens.operators.warehouse import Warehouse


def monthly_reviews(wh: Warehouse) -> DataFrame:
    d = F.col("date")
    return (wh.fact_reviews.groupBy(F.year(d).cast("bigint").alias("year"), F.month(d).cast("bigint").alias("month"))
            .agg(F.count(F.lit(1)).alias("review_count")))


def complete_months(monthly: DataFrame, cutoff_year: int, cutoff_month: int,
                    since: str | None = None) -> DataFrame:
    """Drop months after the last complete one, add the month-start date and
    optionally keep only months from ``since`` on."""
    y, m = F.col("year"), F.col("month")
    keep = (y < cutoff_year) | ((y == cutoff_year) & (m <= cutoff_month))
    out = monthly.where(keep).withColumn("period", F.make_date(y.cast("int"), m.cast("int"), F.lit(1)))
    if since:
        out = out.where(F.col("period") >= F.lit(_dt.date.fromisoformat(since)))
    return out


def review_seasonality(wh: Warehouse, cutoff_year: int, cutoff_month: int) -> DataFrame:
    """Mean monthly review count per calendar month over complete months
    (half-even rounding to whole numbers, as pandas ``round``)."""
    cm = complete_months(monthly_reviews(wh), cutoff_year, cutoff_month)
    return cm.groupBy("month").agg(F.bround(F.avg("review_count"), 0).alias("avg_reviews"))


def availability_by_month(wh: Warehouse) -> DataFrame:
    c = wh.fact_calendar
    return (c.groupBy(F.month("date").cast("bigint").alias("month"))
            .agg(F.avg(F.when(F.col("available"), 1).otherwise(0)).alias("pct_available")))


def demand_vs_pressure(wh: Warehouse, cutoff_year: int, cutoff_month: int) -> DataFrame:
    """Historical review seasonality beside forward availability, by month."""
    return review_seasonality(wh, cutoff_year, cutoff_month).join(availability_by_month(wh), "month", "full")


def weekend_availability(wh: Warehouse) -> DataFrame:
    j = frames.join_date_dim(wh)
    return j.groupBy("is_weekend").agg(
        F.avg(F.when(F.col("available"), 1.0).otherwise(0.0)).alias("pct_available"),
        F.count(F.lit(1)).alias("n_observations"))


def weekend_table(wh: Warehouse) -> DataFrame:
    """2 x 2 counts: weekend / weekday by available / not (NULL counts as not)."""
    j = frames.join_date_dim(wh)
    a = F.coalesce(F.col("available"), F.lit(False))
    w = F.col("is_weekend")
    return j.agg(F.count_if(w & a).alias("weekend_available"), F.count_if(w & ~a).alias("weekend_unavailable"),
                 F.count_if(~w & a).alias("weekday_available"), F.count_if(~w & ~a).alias("weekday_unavailable"))
