"""Query registry: id -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables.  Parameters that the reference hard-codes for its own
data (an area name, room types, a month cut-off) are chosen here from values
that exist in the driver data; the rule each query implements is unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.operators.warehouse import StoredWarehouse, Warehouse
from rentlens.session import scratch_path
from rentlens.sources import io, roles


@dataclass
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Entry] = {}
_WH_CACHE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Entry(fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def source_state(spark: SparkSession, sf_dir: str) -> str:
    """Names the state of the source tables: folder, and newest file and bytes of each (listed by the driver, no job)."""
    parts = [sf_dir]
    for name in roles.WAREHOUSE_TABLES:
        parts.append(str(io.newest_and_bytes(spark, f"{sf_dir}/{name}.parquet")))
    return hashlib.sha1("|".join(parts).encode()).hexdigest()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over ``sf_dir``, its tables stored in the shared folder at their first use, per state of the source tables."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, source_state(spark, sf_dir))
    if key not in _WH_CACHE:
        _WH_CACHE[key] = StoredWarehouse(spark, sf_dir, scratch_path(spark, f"star-{key[1]}"))
    return _WH_CACHE[key]


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A result that several queries share, written once to the shared folder per state of the source tables."""
    path = scratch_path(spark, f"{name}-{source_state(spark, sf_dir)}")
    if not io.exists(spark, path):  # a write that was cut off is done again
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _load_all():
    # importing the query modules fills REGISTRY
    from rentlens.plans import (queries_gates, queries_market, queries_models, queries_quality, queries_similarity,  # noqa: F401
                                queries_stats, queries_text)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v.build for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v.sql for k, v in REGISTRY.items() if v.sql}
