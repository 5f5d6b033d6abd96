"""Readers, writers and small catalog helpers."""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.functions.columns import na_to_null

# --- fixed values -----------------------------------------------------------
# Source schemas (explicit: 64-bit ids must never be inferred as double).
LISTINGS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("host_id", T.LongType()), T.StructField("host_name", T.StringType()),
    T.StructField("host_is_superhost", T.StringType()),
    T.StructField("host_identity_verified", T.StringType()),
    T.StructField("host_has_profile_pic", T.StringType()),
    T.StructField("host_listings_count", T.DoubleType()),
    T.StructField("hosts_time_as_host_years", T.DoubleType()),
    T.StructField("hosts_time_as_user_years", T.DoubleType()),
    T.StructField("host_location", T.StringType()),
    T.StructField("neighbourhood_cleansed", T.StringType()),
    T.StructField("neighbourhood_group_cleansed", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("property_type", T.StringType()), T.StructField("room_type", T.StringType()),
    T.StructField("accommodates", T.IntegerType()), T.StructField("bathrooms", T.DoubleType()),
    T.StructField("bedrooms", T.DoubleType()), T.StructField("beds", T.DoubleType()),
    T.StructField("amenities", T.StringType()), T.StructField("price", T.StringType()),
    T.StructField("price_quote_price_per_night", T.StringType()),
    T.StructField("price_quote_total_price", T.StringType()),
    T.StructField("minimum_nights", T.IntegerType()), T.StructField("maximum_nights", T.IntegerType()),
    T.StructField("availability_365", T.IntegerType()),
    T.StructField("number_of_reviews", T.IntegerType()),
    T.StructField("number_of_reviews_ltm", T.IntegerType()),
    T.StructField("reviews_per_month", T.DoubleType()),
    T.StructField("review_scores_rating", T.DoubleType()),
    T.StructField("review_scores_cleanliness", T.DoubleType()),
    T.StructField("review_scores_location", T.DoubleType()),
    T.StructField("review_scores_value", T.DoubleType()),
    T.StructField("estimated_occupancy_l365d", T.IntegerType()),
    T.StructField("estimated_revenue_l365d", T.DoubleType()),
    T.StructField("calculated_host_listings_count", T.IntegerType()),
    T.StructField("license", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("last_scraped", T.StringType()), T.StructField("first_review", T.StringType()),
    T.StructField("last_review", T.StringType()), T.StructField("calendar_last_scraped", T.StringType()),
    T.StructField("host_since", T.StringType()), T.StructField("host_response_time", T.StringType()),
    T.StructField("instant_bookable", T.StringType()), T.StructField("calendar_updated", T.StringType()),
    T.StructField("neighborhood_overview", T.StringType()),
])
CALENDAR_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()), T.StructField("date", T.StringType()),
    T.StructField("available", T.StringType()), T.StructField("price", T.StringType()),
    T.StructField("adjusted_price", T.StringType()),
    T.StructField("minimum_nights", T.IntegerType()), T.StructField("maximum_nights", T.IntegerType()),
])
REVIEWS_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("date", T.StringType()), T.StructField("reviewer_id", T.LongType()),
    T.StructField("reviewer_name", T.StringType()), T.StructField("comments", T.StringType()),
])
# -----------------------------------------------------------------------------


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 header_only_schema: bool = False) -> DataFrame:
    """Read an export CSV (optionally gzip) the way the pandas reader sees it.

    * quoted fields may hold line breaks and doubled quotes;
    * every string field equal to a default missing-value token becomes NULL;
    * ``_ord`` records file order (file path, position) for first-row dedup.

    A gzip file is not splittable and arrives as one partition; the caller
    repartitions on the key it shuffles by next (dedup), so no separate
    round-robin shuffle is added here.
    """
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))
    if schema is not None and not header_only_schema:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if schema is not None and header_only_schema:
        known = {f.name for f in schema.fields}
        df = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in df.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
                       *[F.col(c) for c in df.columns if c not in known])
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        out.append(na_to_null(c).alias(f.name) if isinstance(f.dataType, T.StringType) else c)
    return df.select(*out, F.struct(F.input_file_name().alias("file"),
                                     F.monotonically_increasing_id().alias("pos")).alias("_ord"))


def read_neighbourhoods(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


BOUNDARY_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StructType([
            T.StructField("neighbourhood", T.StringType()),
            T.StructField("neighbourhood_group", T.StringType()),
        ])),
    ]))),
])


def read_boundaries(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON feature properties as rows (UTF-8); geometry is not read."""
    raw = spark.read.schema(BOUNDARY_SCHEMA).option("multiLine", True).option("encoding", "UTF-8").json(path)
    return (raw.select(F.explode("features").alias("f"))
            .select(F.col("f.properties.neighbourhood").alias("neighbourhood"),
                    F.col("f.properties.neighbourhood_group").alias("neighbourhood_group")))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """True when a completed Parquet output is at ``path``: its writer has left ``_SUCCESS``."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def newest_and_bytes(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Newest change (ms), bytes and number of the files of a table, from its listing; (0, 0, 0) where there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(at):
        return 0, 0, 0
    newest, total, n, files = 0, 0, 0, store.listFiles(at, True)
    while files.hasNext():
        f = files.next()
        newest, total, n = max(newest, f.getModificationTime()), total + f.getLen(), n + 1
    return newest, total, n


def write_clean(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def skip_if_exists(spark: SparkSession, path: str, force: bool, build) -> DataFrame:
    """Return the existing output unless ``force``; otherwise build, write, re-read."""
    if not force and exists(spark, path):
        return spark.read.parquet(path)
    write_clean(build(), path)
    return spark.read.parquet(path)


def stage_tables(tables: dict[str, DataFrame]) -> None:
    """Register frames as (replaceable) staging views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n) for each table; one aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def experiment_record(spark: SparkSession, n_rows: int, n_features: int, params: dict, metrics: dict,
                      model: str) -> DataFrame:
    """One-row run record (id, time, shape, params, metrics) as a DataFrame."""
    run_id = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S") + "_" + uuid.uuid4().hex[:6]
    row = {"run_id": run_id, "timestamp": _dt.datetime.now(_dt.timezone.utc).isoformat(), "model": model,
           "n_rows": int(n_rows), "n_features": int(n_features),
           "params": json.dumps(params, sort_keys=True), "metrics": json.dumps(metrics, sort_keys=True)}
    return spark.createDataFrame([row])


def experiment_log(record: DataFrame, path: str) -> None:
    """Append the run record to a JSON table."""
    record.coalesce(1).write.mode("append").json(path)
