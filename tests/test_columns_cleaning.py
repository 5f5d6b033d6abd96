import datetime as dt
import gzip
import os

from pyspark.sql import functions as F

from rentlens.functions import columns as C
from rentlens.operators import cleaning, warehouse
from rentlens.sources import io


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_price_valid(spark):
    assert _one_col(spark, ["$1,250.00", "$99.99", "$0.00", "$10,000"], C.clean_price) == [1250.0, 99.99, 0.0, 10000.0]


def test_price_invalid(spark):
    assert _one_col(spark, ["$nan", "None", "", "$abc"], C.clean_price) == [None, None, None, None]


def test_price_extra_cases(spark):
    got = _one_col(spark, ["$12d", "($5.00)", "1_000", "0x10", "-$5.00", "1e3", " $5 ", None], C.clean_price)
    assert got == [None, None, None, None, -5.0, 1000.0, 5.0, None]


def test_location_flag(spark):
    df = spark.createDataFrame([(41.3851, 2.1734), (40.0, 2.0), (41.5999, 3.0), (None, 2.0)], "la double, lo double")
    got = [r[0] for r in df.select(C.flag_location_valid(F.col("la"), F.col("lo"))).collect()]
    assert got == [True, False, False, False]


def test_weekend_and_dow(spark):
    days = [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8), None]  # Sat, Sun, Mon, NULL
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(C.day_of_week(F.col("d")), C.is_weekend(F.col("d"))).collect()
    assert [r[0] for r in rows] == [6, 0, 1, None]
    assert [r[1] for r in rows] == [True, True, False, False]


def test_demand_segment(spark):
    df = spark.createDataFrame([(0, 0), (3, 0), (0, None), (None, 0), (2, 5)], "n int, o int")
    got = [r[0] for r in df.select(C.demand_segment(F.col("n"), F.col("o"))).collect()]
    assert got == ["never_active", "dormant_with_history", "active", "active", "active"]


def test_clip_lower_keeps_null(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in df.select(C.clip_lower(F.col("x"), 1.0)).collect()] == [1.0, 3.0, None]


def _write_gz(path, text):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)


def test_clean_calendar_fixture(spark, tmpdir_session):
    p = os.path.join(tmpdir_session, "calendar.csv.gz")
    _write_gz(p, "listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n"
                 "1,2024-01-01,t,$100.00,$90.00,2,30\n"
                 "1,invalid_date,f,$100.00,$90.00,-1,30\n"
                 "2,2024-01-03,f,$200.00,$190.00,3,30\n")
    raw = io.read_raw_csv(spark, p, io.CALENDAR_SCHEMA, header_only_schema=True)
    out = cleaning.clean_calendar(raw).orderBy("listing_id", F.col("date").asc_nulls_last()).collect()
    assert len(out) == 3
    assert [r["available"] for r in out] == [True, False, False]
    assert out[0]["date"] == dt.date(2024, 1, 1) and out[1]["date"] is None
    assert sorted(r["minimum_nights"] for r in out) == [-1, 2, 3]  # negatives kept


def test_reviews_null_tokens_and_quotes(spark, tmpdir_session):
    p = os.path.join(tmpdir_session, "reviews.csv.gz")
    _write_gz(p, 'listing_id,id,date,reviewer_id,reviewer_name,comments\n'
                 '1,10,2024-01-01,5,A,"Great ""place""<br/>with a\nline break"\n'
                 '1,11,2024-01-02,6,B,None\n'
                 '1,12,2024-01-02,6,B,N/A\n'
                 '1,13,2024-01-02,6,B,null\n'
                 '1,14,2024-01-02,6,B,\n'
                 '1,10,2024-01-05,7,C,duplicate id later in file\n')
    raw = io.read_raw_csv(spark, p, io.REVIEWS_SCHEMA, header_only_schema=True)
    out = cleaning.clean_reviews(raw).collect()
    assert len(out) == 1
    assert out[0]["comments"].startswith('Great "place"') and "\n" in out[0]["comments"]
    assert out[0]["date"] == dt.date(2024, 1, 1)  # first row by file order kept


def test_dedup_first_and_null_keys(spark):
    df = spark.createDataFrame([(1, None, "a", 0), (1, None, "b", 1), (2, "2024-01-01", "c", 3),
                                (2, "2024-01-01", "d", 2)], "listing_id int, date string, v string, o int")
    df = df.withColumn("_ord", F.struct("o"))
    out = sorted((r["listing_id"], r["v"]) for r in cleaning.dedup_first(df, ["listing_id", "date"]).collect())
    assert out == [(1, "a"), (2, "d")]


def test_host_fan_out_and_one_row(spark):
    rows = [(1, 7, "h", "t", "t", "t", 2.0, 1.0, 2.0, "X"), (2, 7, "h", "t", "t", "t", 2.0, 1.0, 2.0, "Y")]
    stg = spark.createDataFrame(rows, "id long, host_id long, host_name string, host_is_superhost string, "
                                      "host_identity_verified string, host_has_profile_pic string, "
                                      "host_listings_count double, hosts_time_as_host_years double, "
                                      "hosts_time_as_user_years double, host_location string")
    assert warehouse.dim_host(stg).count() == 2
    assert warehouse.dim_host(stg, one_row=True).count() == 1


def test_orphans_drop_from_facts(spark):
    stg_l = spark.createDataFrame([(1,)], "listing_id long")
    cal = spark.createDataFrame([(1, dt.date(2024, 1, 1), True, 1, 2), (99, dt.date(2024, 1, 1), False, 1, 2)],
                                "listing_id long, date date, available boolean, minimum_nights int, "
                                "maximum_nights int")
    assert [r["listing_id"] for r in warehouse.fact_calendar(cal, stg_l).collect()] == [1]
