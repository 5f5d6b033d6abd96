"""Raw exports -> cleaned tables -> stored warehouse, in one command.

    spark-submit -m rentlens.jobs.pipeline --raw DIR --clean DIR --warehouse DIR [--force]

``--raw`` holds listings.csv.gz, calendar.csv.gz and reviews.csv.gz. A cleaned
table that is complete is kept unless ``--force`` is given; the warehouse is
always written anew. Exit code 0, or 1 after an error.
"""

from __future__ import annotations

import argparse
import logging
import sys
import time

from pyspark.sql import SparkSession

from rentlens.operators import cleaning
from rentlens.operators.warehouse import Warehouse
from rentlens.session import get_spark

log = logging.getLogger(__name__)


def run(spark: SparkSession, raw: str, clean: str, warehouse: str, force: bool = False) -> Warehouse:
    """The four steps in order, each with its time in the log."""
    began = time.time()

    def timed(name, step):
        t = time.time()
        out = step()
        log.info("%s: %.1f s", name, time.time() - t)
        return out

    listings_path = f"{clean}/listings_clean.parquet"
    listings = timed("listings", lambda: cleaning.clean_listings_job(spark, f"{raw}/listings.csv.gz", listings_path, force))
    calendar = timed("calendar", lambda: cleaning.clean_calendar_job(spark, f"{raw}/calendar.csv.gz", f"{clean}/calendar_clean.parquet", force))
    reviews = timed("reviews", lambda: cleaning.clean_reviews_job(spark, f"{raw}/reviews.csv.gz", f"{clean}/reviews_clean.parquet",
                                                                  listings_path, force))
    stored = timed("warehouse", lambda: Warehouse(listings, calendar, reviews).persist(warehouse))
    log.info("pipeline: %.1f s", time.time() - began)
    return stored


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--raw", default="data/raw")
    p.add_argument("--clean", default="data/processed")
    p.add_argument("--warehouse", default="data/warehouse")
    p.add_argument("--force", action="store_true", help="clean again where a cleaned table exists")
    args = p.parse_args(argv)
    try:
        run(get_spark(app="rental-pipeline"), args.raw, args.clean, args.warehouse, args.force)
    except Exception:
        log.exception("pipeline failed")
        return 1
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
