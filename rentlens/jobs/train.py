"""Trains a price model on the stored warehouse, saves it and records the run.

    spark-submit -m rentlens.jobs.train --warehouse DIR --models DIR --runs DIR
        [--kind boosted] [--rounds 300] [--depth 6] [--rate 0.05] [--seed 42]

Exit code 0, or 1 after an error.
"""

from __future__ import annotations

import argparse
import logging
import sys
import time

from pyspark.sql import SparkSession

from rentlens.operators import features as FT
from rentlens.operators import frames
from rentlens.operators import models as M
from rentlens.operators.warehouse import Warehouse
from rentlens.session import checkpoint_dir, get_spark
from rentlens.sources import io

log = logging.getLogger(__name__)


def run(spark: SparkSession, warehouse: str, models: str, runs: str, kind: str = "boosted", rounds: int = M.BOOSTED["maxIter"],
        depth: int = M.BOOSTED["maxDepth"], rate: float = M.BOOSTED["stepSize"], seed: int = M.SEED,
        room_type_codes: dict = FT.ROOM_TYPE_CODES) -> dict:
    """Fit, training metrics, saved model and an appended run record; returns the metrics."""
    began = time.time()
    checkpoint_dir(spark)
    frame = frames.model_frame(Warehouse.from_path(spark, warehouse))
    meta = FT.fit_feature_meta(frame, room_type_codes)
    feats = FT.build_features(frame, meta).cache()
    params = {"ridge": {}, "forest": {"seed": seed, "maxDepth": depth, "numTrees": rounds},
              "boosted": {"seed": seed, "maxIter": rounds, "maxDepth": depth, "stepSize": rate}}[kind]
    model = M.fit(kind, feats, meta, **params)
    row = M.train_metrics(model, feats).first()
    metrics = {"train_mae": row["mae"], "train_rmse": row["rmse"], "seconds": time.time() - began}
    M.save_model(spark, model, meta, models, kind)
    io.experiment_log(io.experiment_record(spark, row["n"], len(meta.feature_cols), params, metrics, kind), runs)
    feats.unpersist()
    log.info("%s: MAE %.2f, RMSE %.2f on %d rows", kind, row["mae"], row["rmse"], row["n"])
    return metrics


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--warehouse", default="data/warehouse")
    p.add_argument("--models", default="models/price")
    p.add_argument("--runs", default="experiments")
    p.add_argument("--kind", choices=("ridge", "forest", "boosted"), default="boosted")
    p.add_argument("--rounds", type=int, default=M.BOOSTED["maxIter"])
    p.add_argument("--depth", type=int, default=M.BOOSTED["maxDepth"])
    p.add_argument("--rate", type=float, default=M.BOOSTED["stepSize"])
    p.add_argument("--seed", type=int, default=M.SEED)
    args = p.parse_args(argv)
    try:
        run(get_spark(app="rental-train"), **vars(args))
    except Exception:
        log.exception("training failed")
        return 1
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
