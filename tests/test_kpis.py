"""KPI aggregates and period-over-period (FIXTURES 5: P90, reviews, KPI
consolidation, category share, late rate, LAG vs YoY, frozen category)."""

from pyspark.sql import functions as F

from kpiforge.operators import kpis, trends


def test_p90_interpolates(spark):
    fact = spark.createDataFrame([(1, 1, 1, 1.0), (1, 1, 1, 2.0), (1, 1, 1, 4.0),
                                  (2, 1, 2, 5.0), (3, 1, 3, None)],
                                 "calendar_sk int, customer_sk int, k int, lead_time_days double")
    cal = spark.createDataFrame([(1, 2018, 1), (2, 2018, 2), (3, 2018, 3)],
                                "calendar_sk int, year int, quarter int")
    cust = spark.createDataFrame([(1, "x")], "customer_sk int, customer_city string")
    got = {(r["year"], r["quarter"]): r["lead_time_p90"]
           for r in kpis.lead_time_pctl(fact, cal, cust, "x").collect()}
    assert abs(got[(2018, 1)] - 3.6) < 1e-12
    assert got[(2018, 2)] == 5.0
    assert (2018, 3) not in got                                   # all NULL: group missing


def test_review_share_fanout_and_null(spark):
    oq = spark.createDataFrame([("o1", 2018, 1), ("o2", 2018, 1)], "order_id string, year int, quarter int")
    rv = spark.createDataFrame([("o1", 5), ("o1", 3), ("o2", None), ("o9", 5)],
                               "order_id string, review_score int")
    r = kpis.review_share(oq, rv).first()
    assert abs(r["share_ge4"] - 1 / 3) < 1e-12


def test_on_time_vs_late_rate_null_rules(spark):
    fact = spark.createDataFrame([(1, 1, 1, 1, 1.0), (1, 1, 1, 0, 1.0), (1, 1, 1, None, 1.0)],
                                 "calendar_sk int, customer_sk int, product_sk int, on_time_flag int, price double")
    fact = fact.withColumn("order_id", F.lit("o"))
    cal = spark.createDataFrame([(1, 2018, 1)], "calendar_sk int, year int, quarter int")
    cust = spark.createDataFrame([(1, "x")], "customer_sk int, customer_city string")
    prod = spark.createDataFrame([(1, "toys")], "product_sk int, product_category_name string")
    assert kpis.on_time_rate(fact, cal, cust, "x").first()["on_time_rate"] == 0.5
    late = kpis.late_by_category(fact, cal, cust, prod, "x", distinct_orders=True).first()
    assert (late["n_orders"], round(late["late_rate"], 12), late["n_distinct_orders"]) == (3, round(2 / 3, 12), 1)


def test_category_share_zero_revenue(spark):
    fact = spark.createDataFrame([(1, 1, 1, 0.0), (1, 1, 2, 0.0), (2, 1, 1, 3.0), (2, 1, 2, 1.0)],
                                 "calendar_sk int, customer_sk int, product_sk int, price double")
    cal = spark.createDataFrame([(1, 2018, 1), (2, 2018, 2)], "calendar_sk int, year int, quarter int")
    cust = spark.createDataFrame([(1, "x")], "customer_sk int, customer_city string")
    prod = spark.createDataFrame([(1, "a"), (2, "b")], "product_sk int, product_category_name string")
    got = {(r["quarter"], r["category"]): r["share_cat"]
           for r in kpis.category_share(fact, cal, cust, prod, "x").collect()}
    assert got[(1, "a")] is None and got[(2, "a")] == 0.75


def test_kpi_consolidation_keeps_all_quarters(spark):
    fact = spark.createDataFrame([(1, 1, 10.0, 1.0, 1)],
                                 "calendar_sk int, customer_sk int, price double, lead_time_days double, on_time_flag int")
    cal = spark.createDataFrame([(1, 2018, 1, None), (2, 2018, 2, None)],
                                "calendar_sk int, year int, quarter int, date date")
    cal = cal.withColumn("date", F.when(F.col("calendar_sk") == 1, F.to_date(F.lit("2018-01-10")))
                         .otherwise(F.to_date(F.lit("2018-04-10"))))
    cust = spark.createDataFrame([(1, "c1", "x")], "customer_sk int, customer_id string, customer_city string")
    orders = spark.createDataFrame([("o2", "c1", "delivered")], "order_id string, customer_id string, order_status string")
    orders = orders.withColumn("order_delivered_customer_date", F.to_timestamp_ntz(F.lit("2018-04-10 08:00:00")))
    reviews = spark.createDataFrame([("o2", 5)], "order_id string, review_score int")
    got = [tuple(r) for r in kpis.kpi_quarter(fact, cal, cust, orders, reviews, "x").collect()]
    assert got == [(2018, 1, 10.0, None, 1.0, 1.0), (2018, 2, None, 1.0, None, None)]


def test_lag_skips_gap_yoy_base_null(spark):
    df = spark.createDataFrame([(2017, 1, "a", 1.0), (2017, 3, "a", 2.0), (2018, 1, "a", 5.0),
                                (2018, 3, "a", 4.0), (2018, 4, "a", 8.0)],
                               "year int, quarter int, category string, v double")
    lagged = {(r["year"], r["quarter"]): r["v_prev"]
              for r in trends.delta_prev(df, ["v"], ["category"]).collect()}
    assert lagged[(2017, 3)] == 1.0                          # previous existing quarter
    y = {(r["year"], r["quarter"]): (r["base"], r["yoy_pct"])
         for r in trends.yoy(df, "v", keys=["category"]).collect()}
    assert y[(2018, 1)] == (1.0, 400.0)
    assert y[(2018, 4)] == (None, None)                      # t-4 missing: base NULL, row kept


def test_frozen_top_category_tie_and_absent(spark):
    rows = [(2017, 1, "b", 5.0, 10.0, 0.5), (2017, 1, "a", 5.0, 10.0, 0.5),
            (2018, 1, "b", 2.0, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "year int, quarter int, category string, revenue_cat double, "
                                     "revenue_total double, share_cat double")
    got = {(r["year"], r["quarter"]): r for r in trends.frozen_top_category(df).collect()}
    r = got[(2018, 1)]
    assert r["top_category"] == "a"                          # tie: smaller name
    assert r["share_pct"] == 0.0 and r["base_pct"] == 50.0 and r["delta_pp"] == -50.0
    assert got[(2017, 1)]["top_category"] is None


def test_pareto_core_includes_crossing_segment(spark):
    rows = [(2018, 1, s, v) for s, v in [("a", 50.0), ("b", 30.0), ("c", 15.0), ("d", 5.0)]]
    df = spark.createDataFrame(rows, "year int, quarter int, seg string, price double")
    got = {r["segment"]: (r["rank"], r["in_core"]) for r in trends.pareto(df, "seg").collect()}
    assert got == {"a": (1, True), "b": (2, True), "c": (3, False), "d": (4, False)}


def test_purchase_interval(spark):
    import datetime as dt
    rows = [("c1", "o1", dt.datetime(2018, 1, 1)), ("c1", "o2", dt.datetime(2018, 1, 11)),
            ("c2", "o3", dt.datetime(2018, 2, 1))]
    df = spark.createDataFrame(rows, "customer_id string, order_id string, order_approved_at timestamp_ntz")
    got = {r["order_id"]: r["days_since_prev"] for r in trends.purchase_interval(df).collect()}
    assert got == {"o1": None, "o2": 10.0, "o3": None}


def test_kpi_targets(spark):
    d = spark.createDataFrame([(2018, 1, 3.0), (2018, 2, 1.0)], "year int, quarter int, yoy_pct double")
    got = {(r["quarter"]): r["met"] for r in trends.kpi_targets({"revenue_yoy": d}).collect()}
    assert got == {1: True, 2: False}


def test_targets_long_keeps_only_present_kpis(spark):
    wide = spark.createDataFrame(
        [(2018, 1, 3.0, True, None, False), (2018, 2, 1.0, True, -0.5, True)],
        "year int, quarter int, revenue_yoy double, revenue_yoy__present boolean, "
        "lead_time_p90 double, lead_time_p90__present boolean")
    got = sorted((r["kpi"], r["quarter"], r["met"]) for r in trends.targets_long(wide).collect())
    assert got == [("lead_time_p90", 2, True), ("revenue_yoy", 1, True), ("revenue_yoy", 2, False)]


def test_shipping_profile_percentiles(spark):
    fact = spark.createDataFrame([(1, 1, 1, float(i), 1, 1.0) for i in range(1, 101)] + [(1, 1, 1, None, None, 1.0)],
                                 "calendar_sk int, customer_sk int, product_sk int, "
                                 "lead_time_days double, on_time_flag int, price double")
    cal = spark.createDataFrame([(1, 2018, 1)], "calendar_sk int, year int, quarter int")
    cust = spark.createDataFrame([(1, "x")], "customer_sk int, customer_city string")
    r = kpis.shipping_profile(fact, cal, cust, "x").first()
    assert [round(r[c], 9) for c in ("lead_time_p50", "lead_time_p90", "lead_time_p99")] == [50.5, 90.1, 99.01]
    assert (r["n_rows"], r["n_with_estimate"]) == (101, 100)
