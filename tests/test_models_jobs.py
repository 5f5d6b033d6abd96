"""Submit jobs, stored warehouse, models and gates on small inputs."""

import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentlens.jobs import pipeline, train
from rentlens.operators import cleaning, gates
from rentlens.operators import features as FT
from rentlens.operators import models as M
from rentlens.operators.warehouse import PARTITION_COLUMNS, Warehouse
from rentlens.sources import io

ROOMS = ["Entire home/apt", "Private room", "Hotel room"]


def gz(path, header, rows):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join('"' + str(x).replace('"', '""') + '"' if x is not None else "" for x in r) + "\n")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Exports with duplicates, an orphan, a host of two versions, multi-line text and empty values."""
    d = tmp_path_factory.mktemp("raw")
    head = ["id", "name", "host_id", "host_name", "host_is_superhost", "host_listings_count", "neighbourhood_cleansed",
            "neighbourhood_group_cleansed", "latitude", "longitude", "room_type", "accommodates", "bathrooms", "bedrooms", "beds", "price",
            "minimum_nights", "availability_365", "number_of_reviews", "estimated_occupancy_l365d", "review_scores_rating"]
    rows = []
    for i in range(1, 61):
        host = 100 + i % 20
        rows.append((i, f"Flat {i}", host, f"Host {host}", "t" if i == 7 or host % 2 else "f", 3, f"N{i % 4}", f"G{i % 2}", 41.4, 2.1, f" {ROOMS[i % 3]} ",
                     1 + i % 5, 1, 1 + i % 3, 1 + i % 4, f"${40 + 7 * (i % 9)}.00", 1 + i % 3, 100, i % 6, 10 + i, 4 + (i % 10) / 10))
    rows.append((1, "Flat 1 again", 101, "Host 101", "t", 3, "N1", "G1", 41.4, 2.1, ROOMS[0], 9, 1, 1, 1, "$999.00", 1, 1, 1, 1, 5))
    gz(d / "listings.csv.gz", head, rows)
    gz(d / "calendar.csv.gz", ["listing_id", "date", "available", "minimum_nights", "maximum_nights"],
       [(1, "2024-01-01", "t", 2, 30), (1, "2024-01-01", "f", 3, 30), (1, "invalid_date", "f", -1, 30), (2, "2024-02-03", "f", 3, 30), (99, "2024-01-06", "t", 1, 2)])
    gz(d / "reviews.csv.gz", ["listing_id", "id", "date", "reviewer_id", "comments"],
       [(1, 1, "2023-05-01", 5, 'Great "place"\nvery clean'), (2, 2, "2024-05-02", 6, "N/A"), (99, 3, "2023-06-01", 7, "orphan"), (2, 4, "2024-06-01", 8, "bad")])
    return str(d)


@pytest.fixture(scope="module")
def stored(spark, raw, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("out"))
    pipeline.run(spark, raw, f"{d}/clean", f"{d}/wh")
    return d


def test_pipeline_tables(spark, stored):
    wh = Warehouse.from_path(spark, f"{stored}/wh")
    assert all(not set(PARTITION_COLUMNS) & set(df.columns) for df in (*wh.tables().values(), wh.stg_calendar))
    assert wh.dim_listing.count() == 60 and wh.fact_listing_performance.where("listing_id = 1").first()["price"] == 47.0
    assert wh.fact_calendar.count() == 3 and [r["available"] for r in wh.fact_calendar.where("date = '2024-01-01'").collect()] == [True]
    assert sorted(r["review_id"] for r in wh.fact_reviews.collect()) == [1, 4]
    assert sorted(os.listdir(f"{stored}/wh/fact_reviews"))[-2:] == ["review_year=2023", "review_year=2024"]
    assert wh.dim_host.where("host_id = 107").count() == 1 and wh.stg_reviews.where("id = 1").first()["comments"].endswith("\nvery clean")


def test_pipeline_skips_and_forces(spark, raw, stored):
    done = f"{stored}/clean/calendar_clean.parquet"
    before = sorted(os.listdir(done))
    assert pipeline.main(["--raw", raw, "--clean", f"{stored}/clean", "--warehouse", f"{stored}/wh"]) == 0 and sorted(os.listdir(done)) == before
    assert pipeline.main(["--raw", raw, "--clean", f"{stored}/clean", "--warehouse", f"{stored}/wh", "--force"]) == 0 and sorted(os.listdir(done)) != before


def test_pipeline_fails_without_raw(spark, tmp_path):
    assert pipeline.main(["--raw", str(tmp_path), "--clean", str(tmp_path / "c"), "--warehouse", str(tmp_path / "w")]) == 1


def test_half_written_output_is_none(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert io.exists(spark, path)
    os.rename(f"{path}/_SUCCESS", str(tmp_path / "gone"))
    assert not io.exists(spark, path) and not io.exists(spark, str(tmp_path / "never"))


def test_dedup_needs_an_order(spark):
    df = spark.createDataFrame([(1, 2), (1, 1)], "id int, v int")
    with pytest.raises(ValueError, match="_ord"):
        cleaning.dedup_first(df, ["id"])
    for rows in ([(1, "a", 0), (1, "b", 1)], [(1, "b", 1), (1, "a", 0)]):
        got = cleaning.dedup_first(spark.createDataFrame(rows, "id int, v string, _ord int"), ["id"]).collect()
        assert [r["v"] for r in got] == ["a"]


def test_orphan_check_of_the_review_job(spark, stored, raw, caplog):
    with caplog.at_level("INFO"):
        cleaning.clean_reviews_job(spark, f"{raw}/reviews.csv.gz", f"{stored}/clean/reviews_clean.parquet", f"{stored}/clean/listings_clean.parquet")
    assert "without a listing: 1" in caplog.text


def test_train_job(spark, stored, tmp_path):
    kept = {}
    for kind, more in (("ridge", []), ("forest", ["--rounds", "5", "--depth", "3"]), ("boosted", ["--rounds", "4", "--depth", "2", "--rate", "0.3"])):
        args = ["--warehouse", f"{stored}/wh", "--models", str(tmp_path / kind), "--runs", str(tmp_path / "runs"), "--kind", kind, *more]
        assert train.main(args) == 0
        model, meta = M.load_model(spark, str(tmp_path / kind))
        kept[kind] = model.transform(FT.build_features(_frame(spark, stored), meta)).select("prediction").toPandas()["prediction"].to_numpy()
        assert np.isfinite(kept[kind]).all()
    assert spark.read.json(str(tmp_path / "runs")).count() == 3
    assert train.main(["--warehouse", str(tmp_path / "none"), "--models", str(tmp_path / "m"), "--runs", str(tmp_path / "r")]) == 1
    assert M.load_model(spark, str(tmp_path / "nothing")) == (None, None)


def _frame(spark, stored):
    from rentlens.operators import frames
    return frames.model_frame(Warehouse.from_path(spark, f"{stored}/wh"))


def test_folds_share_the_cores(spark, stored, monkeypatch):
    """five folds at once take a task each on four cores, whatever the partitions of the frame, and keep every row."""
    seen, fit = [], M.fit
    monkeypatch.setattr(M, "fit", lambda kind, train, meta, **kw: seen.append((train.rdd.getNumPartitions(), train.columns, train.count())) or fit(kind, train, meta, **kw))
    frame = _frame(spark, stored)
    n = frame.count()
    oof, _ = M.cross_validate(frame.repartition(12), "boosted", maxIter=1)
    assert oof.count() == n and sum(rows for _, _, rows in seen) == (M.N_FOLDS - 1) * n
    assert {(p, *c) for p, c, _ in seen} == {(-(-spark.sparkContext.defaultParallelism // M.N_FOLDS), "features", "log_price")}
    seen.clear()
    monkeypatch.setattr(M, "ROWS_PER_TASK", 10)
    M.cross_validate(frame.repartition(12), "boosted", maxIter=1, k=2, parallel=2)
    assert {p for p, _, _ in seen} == {max(-(-spark.sparkContext.defaultParallelism // 2), min(12, -(-n // 10)))}


def test_folds_and_comparison(spark, stored):
    frame = _frame(spark, stored)
    oof, metrics = M.cross_validate(frame, "ridge", k=3)
    assert oof.count() == frame.count() == oof.select("listing_id", "fold").distinct().count()
    r2 = [r["r2"] for r in metrics.collect()]
    kinds = M.compare_models(frame, ("ridge", "forest", "boosted"), forest={"numTrees": 3, "maxDepth": 2, "k": 2}, boosted={"maxIter": 2, "maxDepth": 2, "k": 2},
                             ridge={"k": 3}).collect()
    assert {r["model"] for r in kinds} == {"ridge", "forest", "boosted"}
    assert next(r["r2_std"] for r in kinds if r["model"] == "ridge") == pytest.approx(np.std(r2))
    res = M.residual_analysis(oof).where("dimension = 'room_type'").collect()
    assert {"mean_pct_error", "std_pct_error"} <= set(res[0].asDict()) and sum(r["n"] for r in res) == oof.count()


def test_advice_keeps_host_versions(spark, stored):
    """A listing whose host has two versions stays two rows, not four."""
    frame = _frame(spark, stored)
    twice = frame.unionByName(frame.where("listing_id <= 10").withColumn("host_listings_count", F.lit(9.0)))
    meta = FT.fit_feature_meta(frame)
    model = M.fit("ridge", FT.build_features(frame, meta), meta)
    peers = frame.select("neighbourhood_group", "room_type", "price")
    got = M.predict_price(model, meta, twice, peers).collect()
    assert len(got) == twice.count()
    every = [r.asDict() for r in peers.collect()]
    for r in got:
        mine = [p["price"] for p in every if (p["neighbourhood_group"], p["room_type"]) == (r["neighbourhood_group"], r["room_type"])]
        assert r["peer_median"] == np.median(mine) and r["percentile"] == pytest.approx(100 * np.mean(np.array(mine) <= r["predicted_price"]))


def test_drivers(spark, stored):
    frame = _frame(spark, stored)
    meta = FT.fit_feature_meta(frame)
    feats = FT.build_features(frame, meta)
    model = M.fit("ridge", feats, meta)
    rows = M.linear_contributions(model, feats).collect()
    best = {r["listing_id"]: sorted(r["contributions"], key=lambda c: (-abs(c["contribution"]), c["feature"]))[:3] for r in rows}
    for r in M.top_drivers(model, feats, 3).collect():
        assert r["feature"] == best[r["listing_id"]][r["rank"] - 1]["feature"]
    mean = {c: np.mean([abs(x["contribution"]) for r in rows for x in r["contributions"] if x["feature"] == c]) for c in meta.feature_cols}
    for r in M.importance_ranking(model, feats).collect():
        assert r["mean_abs_contribution"] == pytest.approx(mean[r["feature"]])


def test_gates(spark, stored):
    wh = Warehouse.from_path(spark, f"{stored}/wh")
    gates.require_valid(gates.validation_gate(wh.stg_listings))
    with pytest.raises(gates.ValidationError, match="price_range"):
        gates.require_valid(gates.validation_gate(wh.stg_listings, max_price=50.0))
    one = lambda v: spark.createDataFrame([(v,)], "rmse double")
    assert [gates.model_gate(one(100.0), one(v)).first()["accepted"] for v in (98.0, 99.5, 120.0)] == [True, False, False]
    x = spark.createDataFrame([(float(i),) for i in range(200)], "v double")
    assert gates.psi_drift(x, x, "v").first()["psi"] == pytest.approx(0.0) and gates.psi_drift(x, x.select((F.col("v") + 120).alias("v")), "v").first()["drifted"]
    top = gates.popularity_fallback(wh, 2).collect()
    assert len(top) == 8 and all(r["rank"] in (1, 2) for r in top)


def test_registered_model_kinds(spark, monkeypatch):
    """compare_models has a row for each of the three models; the advice and out-of-fold queries use the boosted trees."""
    from rentlens.plans import queries_models as Q
    monkeypatch.setattr(M, "FOREST", {"numTrees": 2, "maxDepth": 2})
    monkeypatch.setattr(M, "BOOSTED", {"maxIter": 2, "maxDepth": 2})
    kinds, fit, validate, small = [], M.fit, M.cross_validate, "/root/testdata/sf0.001"
    monkeypatch.setattr(M, "fit", lambda kind, *a, **kw: (kinds.append(kind), fit(kind, *a, **kw))[1])
    monkeypatch.setattr(M, "cross_validate", lambda *a, **kw: validate(*a, k=2, **kw))
    assert sorted(r["model"] for r in Q.compare_models(spark, small).collect()) == ["boosted", "forest", "ridge"]
    kinds.clear()
    n = Q._frame(spark, small).count()
    assert Q.oof_predictions(spark, small).count() == n and Q.train_metrics(spark, small).first()["n"] == n
    assert Q.residual_analysis(spark, small).filter("dimension = 'room_type'").agg(F.sum("n")).first()[0] == n
    assert Q.predict_price(spark, small).filter("predicted_price is null").count() == 0
    assert kinds == ["boosted"]  # folds and the model for all rows are fitted once and shared
