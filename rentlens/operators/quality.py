"""Profiling and data-quality checks (one aggregate pass each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.functions import columns as C


def profile_table(df: DataFrame, name: str, nrows: int | None = None, top: int = 20) -> DataFrame:
    """Shape, type and null count of every column (long form, most nulls
    first); ``nrows`` caps the rows read, as the reference's profiler does."""
    d = df.limit(nrows) if nrows else df
    n = F.count(F.lit(1))
    row = d.agg(n.alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    stack = ", ".join(f"'{c}', '{t}', `n_{i}`" for i, (c, t) in enumerate(df.dtypes))
    out = row.selectExpr("_rows AS n_rows", f"stack({len(df.columns)}, {stack}) AS (column_name, dtype, n_null)")
    return (out.withColumn("table_name", F.lit(name)).withColumn("n_columns", F.lit(len(df.columns)))
            .orderBy(F.desc("n_null"), F.asc("column_name")).limit(top))


def null_rate_audit(df: DataFrame) -> DataFrame:
    """Null % of every column, highest first."""
    row = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(f"p_{i}") for i, c in enumerate(df.columns)])
    stack = ", ".join(f"'{c}', `p_{i}`" for i, c in enumerate(df.columns))
    return row.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, null_pct)")


def null_cooccurrence(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(F.count_if(C.all_null(cols)).alias("all_null"), F.count_if(C.any_null(cols)).alias("any_null"))


def value_counts_by_null(df: DataFrame, by: str, null_col: str) -> DataFrame:
    """Counts of ``by`` overall and where ``null_col`` is NULL (NULL keys dropped)."""
    return (df.where(F.col(by).isNotNull()).groupBy(by)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(null_col).isNull()).alias("n_null")))


def geo_bounds_check(df: DataFrame) -> DataFrame:
    ok = F.col("latitude").between(*C.LAT_BOUNDS) & F.col("longitude").between(*C.LON_BOUNDS)
    return df.agg(F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_outside"))
