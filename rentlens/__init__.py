"""rentlens: short-term-rental market analytics as Spark jobs.

Layout
------
sources/    readers, writers, staging, and the driver-table role mapping
functions/  column expressions (price parsing, flags, text rules, lexicons)
operators/  cleaning, warehouse, market / host / season queries, statistics,
            text jobs, amenity similarity, features and models
plans/      the query registry used by ``__spark_entry__`` and the DuckDB
            oracle SQL that checks it
jobs/       submit modules: the pipeline and model training
"""

from rentlens.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
