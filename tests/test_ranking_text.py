"""Distributed running sums, quantiles and percentiles; the text scorer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentlens.functions import text as TX
from rentlens.operators import ranking, stats


@pytest.fixture(scope="module")
def tied(spark):
    """90 % of the rows have one value, in one hot group of two."""
    rows = [(i, 1.0 if i % 10 else float(i % 70), "hot" if i % 20 else "cold", i % 3) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id long, v double, g string, w long")


def test_ties_do_not_fill_a_range(tied):
    rows, df = tied
    sizes = [r["count"] for r in ranking._ranged(df, [F.col("v").asc(), F.col("id").asc()], 8).groupBy("_b").count().collect()]
    assert max(sizes) <= 2 * len(rows) / len(sizes) and len(sizes) >= 6


def test_running_sums(tied):
    rows, df = tied
    got = {r["id"]: (r["s"], r["t"]) for r in ranking.prefix_sum(df, "v", "w", "s", ties=[F.col("id").asc()], by=["g"], buckets=8, total="t").collect()}
    for g in ("hot", "cold"):
        part, run = sorted((r for r in rows if r[2] == g), key=lambda r: (r[1], r[0])), 0
        for i, _, _, w in part:
            run += w
            assert got[i] == (run, sum(r[3] for r in part))
    rank = {r["id"]: r["rank"] for r in ranking.row_rank(df, "v", descending=True, ties=[F.col("id").asc()]).collect()}
    assert [rank[r[0]] for r in sorted(rows, key=lambda r: (-r[1], r[0]))] == list(range(1, len(rows) + 1))


def test_quantiles(tied):
    rows, df = tied
    for r in ranking.quantiles(df, "v", {"a": 0.0, "b": 0.37, "c": 0.5, "d": 0.951, "e": 1.0}, ["g"]).collect():
        v = [x[1] for x in rows if x[2] == r["g"]]
        assert [r[k] for k in "abcde"] == pytest.approx(list(np.quantile(v, [0, 0.37, 0.5, 0.951, 1])))
    assert ranking.quantiles(df, "v", {"m": 0.5}).first()["m"] == np.median([r[1] for r in rows])


def test_percentiles_carry_their_columns(tied, spark):
    rows, df = tied
    scores = spark.createDataFrame([(i, 1.0 + i % 5, "hot" if i % 2 else "cold", f"x{i}") for i in range(40)] + [(99, 1.0, None, "y")],
                                   "id long, score double, g string, note string")
    got = stats.percentile_of_score(df.withColumnRenamed("v", "price"), scores, ["g"]).collect()
    assert len(got) == 41
    for r in got:
        peers = np.array([x[1] for x in rows if x[2] == r["g"] and x[1] > 0])
        assert r["note"] in (f"x{r['id']}", "y") and (r["percentile"] is None if r["g"] is None else r["percentile"] == pytest.approx(100 * np.mean(peers <= r["score"])))


def test_text_scores(spark):
    texts = ["Not clean, never good<br/>but GREAT!", "", None, "  ", "der Gastgeber ist sehr nett und wir", "la casa es muy bonita y todo fue bien", "xyz qqq zzz www",
             "It wasn’t bad at all, the best", "the the the le le le"]
    got = [r["s"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", TX.scores(F.col("t")).alias("s")).orderBy("i").collect()]
    w = TX.SENTIMENT_WEIGHTS
    # one sentence: two negated words before "but", one in capitals after it, one exclamation mark
    s = (TX.NEGATION_SCALE * (w["clean"] + w["good"]) * TX.BEFORE_CONTRAST + w["great"] * TX.AFTER_CONTRAST * TX.CAPITALS_SCALE) * (1 + TX.BANG_STEP)
    assert got[0]["compound"] == pytest.approx(s / (s * s + TX.ALPHA) ** 0.5) and got[7]["compound"] > 0
    assert [g["language"] for g in got] == ["unknown", "unknown", "unknown", "unknown", "de", "es", "unknown", "en", "en"]
    assert all(g["neg"] == g["pos"] == g["compound"] == 0 for g in got[1:4]) and got[0]["neg"] + got[0]["neu"] + got[0]["pos"] == pytest.approx(1)
