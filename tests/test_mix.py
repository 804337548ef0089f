"""Top-k, pivot, frequencies, profile (O-63..O-69)."""

from pyspark.sql import functions as F

from kpiforge.operators import mix


def test_top_categories_and_trend(spark):
    rows = [(2018, 1, "a", 10.0, 0.5), (2018, 1, "b", 10.0, 0.5), (2018, 2, "a", 3.0, 1.0)]
    cs = spark.createDataFrame(rows, "year int, quarter int, category string, revenue_cat double, share_cat double")
    top = [(r["category"], r["revenue"]) for r in mix.top_categories(cs, 1).collect()]
    assert top == [("a", 13.0)]
    trend = {r["label"]: r.asDict() for r in mix.category_trend(cs, 2).collect()}
    assert trend["2018 Q2"] == {"label": "2018 Q2", "category_1": "a", "share_1": 1.0,
                                 "category_2": "b", "share_2": None}


def test_value_counts_profile_count_where(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), ("y", 5), (None, 4)], "s string, n int")
    assert [tuple(r) for r in mix.value_counts(df, "s").collect()] == [("x", 2), ("y", 1)]
    prof = {r["column"]: (r["dtype"], r["n_rows"], r["nulls"]) for r in mix.profile(df).collect()}
    assert prof == {"s": ("string", 4, 1), "n": ("int", 4, 1)}
    c = mix.count_where(df, F.col("n") >= 4).first()
    assert (c["n_match"], c["n_rows"]) == (2, 4)


def test_customers_by_city_and_top_mix(spark):
    cust = spark.createDataFrame([("a", "ASIA"), ("a", "ASIA"), ("b", "ASIA"), ("c", "EU")],
                                 "customer_city string, customer_state string")
    assert [tuple(r) for r in mix.customers_by_city(cust, "ASIA").collect()] == [("a", 2), ("b", 1)]
    rows = spark.createDataFrame([("s1", "t", 5.0), ("s1", "u", 5.0), ("s2", "t", 1.0)],
                                 "seller_id string, category string, price double")
    got = sorted(tuple(r) for r in mix.top_with_mix(rows, "seller_id", "category", k=1).collect())
    assert got == [("s1", 10.0, "t", 5.0, 0.5), ("s1", 10.0, "u", 5.0, 0.5)]
