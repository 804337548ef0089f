"""Holiday and weather ingest (O-03, O-04, O-26)."""

import datetime as dt
import json
import os
import tempfile

from kpiforge.sources import external as E


def test_holidays_scope_and_gap_fill(spark):
    cal = spark.createDataFrame([(dt.date(2018, 1, d),) for d in range(1, 6)], "date date")
    h = spark.createDataFrame([
        (dt.date(2018, 1, 1), "New Year", None, None, "national"),
        (dt.date(2018, 1, 2), "State", None, "sp", "state"),
        (dt.date(2018, 1, 3), "Other state", None, "rj", "state"),
        (dt.date(2018, 1, 4), "City", " São Paulo ", "sp", "municipal")],
        "date date, holiday_name string, city string, state string, scope string")
    got = {r["date"].day: r["is_holiday"] for r in E.load_holidays(h, cal, "são paulo", "SP").collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 1, 5: 0}


def test_weather_json_clean_and_anomalies(spark):
    d = tempfile.mkdtemp(prefix="kpiforge-test-weather-")
    recs = [{"date": "2018-01-01", "city": " São Paulo ", "temp_avg": 25.04, "precip_mm": 3.0, "is_holiday": "yes"},
            {"date": "2018-01-02", "city": "SAO PAULO", "temp_avg": 70.0, "precip_mm": -1.0, "is_holiday": "no"},
            {"date": "2018-01-03", "city": "sao paulo", "temp_avg": None, "precip_mm": 0.0}]
    with open(os.path.join(d, "w.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    raw = E.read_weather(spark, d)
    clean = {r["date"].day: r for r in E.clean_weather(raw, deaccent=True).collect()}
    assert clean[1]["city"] == "sao paulo" and clean[1]["temp"] == 25.0 and clean[1]["is_holiday"] == 1
    assert clean[2]["temp"] is None and clean[2]["rain"] is None
    assert clean[3]["is_holiday"] is None
    reasons = sorted(r["reason"] for r in E.weather_anomalies(raw).collect())
    assert reasons == ["temp_out_of_range"]


def test_read_holidays_csv(spark):
    d = tempfile.mkdtemp(prefix="kpiforge-test-hol-")
    with open(os.path.join(d, "h.csv"), "w") as f:
        f.write("date,holiday_name,city,state,scope\n"
                "2018-01-01,New Year,,,National\n"
                "2018-01-25,Anniversary,São Paulo,SP,municipal\n"
                "not-a-date,Broken,,,national\n")
    h = E.read_holidays(spark, d)
    rows = {r["holiday_name"]: r for r in h.collect()}
    assert rows["New Year"]["scope"] == "national" and rows["Broken"]["date"] is None
    cal = spark.createDataFrame([(dt.date(2018, 1, 1),), (dt.date(2018, 1, 25),), (dt.date(2018, 1, 26),)],
                                "date date")
    got = {r["date"].day: r["is_holiday"] for r in E.load_holidays(h, cal, "são paulo", "SP").collect()}
    assert got == {1: 1, 25: 1, 26: 0}
