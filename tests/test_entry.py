import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["neighbourhood_name", "listing_count", "median_price", "avg_price"]
    assert len(rows) <= 10


def test_oracles_have_queries():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_oracle_agreement_small(spark):
    import duckdb

    from tools.oracle_check import TABLES, rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["top_neighbourhoods", "host_tiers", "mann_whitney", "kruskal", "review_sentiment",
                 "recommend_similar", "percentile_of_score", "feature_vector"]:
        sp = E.queries()[name](spark, SF).toPandas()
        dk = con.execute(E.oracle_sql()[name]).df()
        assert rows_of(sp) == rows_of(dk), name


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_model_roundtrip_and_ridge(spark):
    from rentlens.operators import features as FT
    from rentlens.operators import frames
    from rentlens.operators import models as M
    from rentlens.plans.registry import warehouse
    fr = frames.model_frame(warehouse(spark, SF))
    meta = FT.fit_feature_meta(fr, FT.DRIVER_ROOM_TYPE_CODES)
    feats = FT.build_features(fr, meta)
    ridge = M.fit("ridge", feats, meta)
    pdf = ridge._z(feats).select("zfeatures", "log_price").toPandas()
    import numpy as np
    X = np.vstack([v.toArray() for v in pdf["zfeatures"]])
    y = pdf["log_price"].to_numpy()
    Xc, yc = X - X.mean(0), y - y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + 10.0 * np.eye(X.shape[1]), Xc.T @ yc)  # closed-form ridge, alpha 10
    assert np.allclose(np.array(list(ridge.coefficients.values())), beta, atol=1e-6)
