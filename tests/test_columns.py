"""Scalar column functions: on-time flag, lead time, hashes, city, calendar, A/B."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from kpiforge.functions import columns as C


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_on_time_flag_edges(spark):
    df = spark.createDataFrame(
        [(1, ts("2018-01-02 10:00:00"), ts("2018-01-02 10:00:00")),
         (2, ts("2018-01-02 10:00:01"), ts("2018-01-02 10:00:00")),
         (3, ts("2018-01-02 10:00:00"), None),
         (4, None, ts("2018-01-02 10:00:00"))],
        "id int, d timestamp_ntz, e timestamp_ntz")
    got = dict(df.select("id", C.on_time_flag("d", "e").alias("f")).collect())
    assert got == {1: 1, 2: 0, 3: None, 4: None}


def test_lead_time_days(spark):
    df = spark.createDataFrame(
        [(1, ts("2018-01-01 00:00:00"), ts("2018-01-02 12:00:00")),
         (2, None, ts("2018-01-02 12:00:00")),
         (3, ts("2018-01-03 00:00:00"), ts("2018-01-02 00:00:00"))],
        "id int, a timestamp_ntz, d timestamp_ntz")
    got = dict(df.select("id", C.lead_time_days("d", "a")).collect())
    assert got == {1: 1.5, 2: None, 3: -1.0}


def test_staging_fingerprint_null_rules(spark):
    df = spark.createDataFrame([("o1", None, None, ts("2018-01-02 10:00:00.250000"))],
                               "order_id string, status string, d timestamp_ntz, e timestamp_ntz")
    got = df.select(C.row_md5([("order_id", "text"), ("status", "text"), ("d", "ts"),
                               ("e", "ts")]).alias("h")).first()["h"]
    want = hashlib.md5("o1|nan||2018-01-02T10:00:00.250000".encode()).hexdigest()
    assert got == want


def test_business_hash_drops_null_price(spark):
    df = spark.createDataFrame(
        [("o1", 1, None, "2.50", ts("2018-01-01 00:00:00"), None, None)],
        "order_id string, order_item_id int, price string, freight_value string, "
        "order_approved_at timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz")
    df = df.withColumn("price", F.col("price").cast("decimal(12,2)")).withColumn(
        "freight_value", F.col("freight_value").cast("decimal(12,2)"))
    got = df.select(C.business_md5().alias("h")).first()["h"]
    want = hashlib.md5("o1|1|2.50|2018-01-01T00:00:00||".encode()).hexdigest()
    assert got == want


def test_city_normalization(spark):
    df = spark.createDataFrame([(" São Paulo ",), ("SAO PAULO",), ("sao paulo",), (None,)], "c string")
    plain = [r[0] for r in df.select(C.norm_lower("c")).collect()]
    folded = [r[0] for r in df.select(C.norm_lower("c", deaccent=True)).collect()]
    assert plain == ["são paulo", "sao paulo", "sao paulo", None]
    assert folded == ["sao paulo", "sao paulo", "sao paulo", None]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),), (dt.date(2018, 1, 7),)], "date date")
    parts = C.calendar_parts("date")
    got = df.select(*[parts[k].alias(k) for k in ("day_of_week", "week", "month", "quarter", "year")]).collect()
    assert tuple(got[0]) == (5, 53, 1, 1, 2016)      # Friday, ISO week 53, calendar year 2016
    assert got[1]["day_of_week"] == 0                   # a Sunday


def test_ab_group_matches_md5_prefix(spark):
    ids = ["a", "customer-1", "9f8e", "0"]
    df = spark.createDataFrame([(i,) for i in ids], "customer_id string")
    got = dict(df.select("customer_id", C.ab_group("customer_id")).collect())
    want = {i: int(hashlib.md5(i.encode()).hexdigest()[:8], 16) & 1 for i in ids}
    assert got == want


def test_share_and_label(spark):
    df = spark.createDataFrame([(1.0, 4.0, 2018, 2), (1.0, 0.0, 2019, 1)], "x double, t double, year int, quarter int")
    got = df.select(C.share("x", "t").alias("s"), C.period_label().alias("p")).collect()
    assert (got[0]["s"], got[0]["p"]) == (0.25, "2018 Q2")
    assert got[1]["s"] is None


def test_accent_blind_matching(spark):
    from kpiforge.functions.columns import accent_blind
    from kpiforge.operators.fact import scope
    rows = [" São Paulo ", "SAO PAULO", "sao paulo", "sào pàulo", "saopaulo", "Santos", None]
    df = spark.createDataFrame([(r,) for r in rows], "customer_city string")
    assert sorted(r[0] for r in scope(df, "São Paulo", blind=True).collect()) == sorted(rows[:4])
    assert [r[0] for r in scope(df, "sao paulo").collect()] == ["sao paulo"]
    city = spark.createDataFrame([("sao paulo", 1), ("santos", 2)], "city string, k int")
    got = df.join(city, accent_blind("customer_city") == accent_blind("city")).groupBy("k").count().collect()
    assert sorted(map(tuple, got)) == [(1, 4), (2, 1)]
    assert df.groupBy(accent_blind("customer_city")).count().count() == 4
