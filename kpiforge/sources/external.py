"""External data: holidays (CSV) and daily weather (JSON).

O-03 load_holidays, O-04 load_weather / clean_weather, O-26 clean_external
rules, O-70 external_effect.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import norm_lower, norm_upper, share

# ---------------------------------------------------------------------------
# Fixed values (spec of the external model)
# ---------------------------------------------------------------------------
TEMP_MIN, TEMP_MAX = -10.0, 55.0          # valid daily mean temperature, deg C
HOLIDAY_SCOPES = ("national", "state", "municipal")
TRUE_TOKENS = ("1", "true", "t", "yes", "y", "si", "sí")
HOLIDAY_SCHEMA = "date string, holiday_name string, city string, state string, scope string"
WEATHER_SCHEMA = "date string, city string, temp_avg double, precip_mm double, is_holiday string"


# ---------------------------------------------------------------------------
# O-03 holidays
# ---------------------------------------------------------------------------
def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Holiday CSV (date YYYY-MM-DD, holiday_name, city?, state, scope).  A
    missing file gives no holidays and a warning."""
    try:
        raw = spark.read.option("header", "true").schema(HOLIDAY_SCHEMA).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no holiday file at {path}: no day is a holiday", stacklevel=2)
        raw = spark.createDataFrame([], HOLIDAY_SCHEMA)
    return raw.select(F.col("date").try_cast("date").alias("date"), "holiday_name", "city",
                      "state", F.lower(F.trim("scope")).alias("scope"))


def load_holidays(holidays: DataFrame, calendar: DataFrame, city: str, state: str,
                  deaccent: bool = False) -> DataFrame:
    """``is_holiday`` 0/1 for every calendar day in (city, state): a national
    holiday, one of the state, or one of the city counts; a municipal holiday
    without a city is the given city's.  Cities are normalized as in the
    customer dimension (``deaccent`` is its setting)."""
    h = holidays.filter(F.col("scope").isin(*HOLIDAY_SCOPES))
    applies = ((F.col("scope") == "national")
               | ((F.col("scope") == "state") & (norm_upper("state") == F.lit(state.upper())))
               | ((F.col("scope") == "municipal") & (F.coalesce(norm_lower("city", deaccent), F.lit(city)) == F.lit(city))))
    per_day = (h.filter(applies).groupBy("date")
               .agg(F.min("holiday_name").alias("holiday_name")))
    return (calendar.select("date").join(per_day, "date", "left")
            .select("date", F.lit(city).alias("city"),
                    F.when(F.col("holiday_name").isNotNull(), F.lit(1)).otherwise(F.lit(0))
                    .alias("is_holiday"), "holiday_name"))


# ---------------------------------------------------------------------------
# O-04 / O-26 weather
# ---------------------------------------------------------------------------
def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Daily weather JSON files, read with a fixed schema (no inference pass)."""
    return spark.read.schema(WEATHER_SCHEMA).json(path)


def weather_flags(df: DataFrame) -> DataFrame:
    """Rule flags of each raw record (out-of-range temperature, negative rain)."""
    t, r = F.col("temp_avg"), F.col("precip_mm")
    return df.withColumns({
        "_bad_temp": t.isNotNull() & ~t.between(TEMP_MIN, TEMP_MAX),
        "_bad_rain": r.isNotNull() & (r < 0),
    })


def clean_weather(df: DataFrame, deaccent: bool = False) -> DataFrame:
    """(date, city, temp, rain, is_holiday): city normalized as in the customer
    dimension (``deaccent`` is its setting), temperature
    outside [-10, 55] -> NULL else rounded to 1 decimal, negative rain -> NULL,
    holiday flag text -> 0/1."""
    f = weather_flags(df)
    flag = F.lower(F.trim(F.col("is_holiday")))
    return f.select(
        F.col("date").try_cast("date").alias("date"),
        norm_lower("city", deaccent).alias("city"),
        F.when(F.col("_bad_temp"), F.lit(None).cast("double"))
        .otherwise(F.round("temp_avg", 1)).alias("temp"),
        F.when(F.col("_bad_rain"), F.lit(None).cast("double")).otherwise(F.col("precip_mm"))
        .alias("rain"),
        F.when(flag.isNull(), F.lit(None).cast("int"))
        .when(flag.isin(*TRUE_TOKENS), F.lit(1)).otherwise(F.lit(0)).alias("is_holiday"))


def weather_anomalies(df: DataFrame) -> DataFrame:
    """Raw records that break a rule, with the reason."""
    f = weather_flags(df)
    reason = (F.when(F.col("_bad_temp"), F.lit("temp_out_of_range"))
              .when(F.col("_bad_rain"), F.lit("negative_rain")))
    return (f.withColumn("reason", reason).filter(F.col("reason").isNotNull())
            .select("date", "city", "temp_avg", "precip_mm", "reason"))


# ---------------------------------------------------------------------------
# O-70 weather / holiday effect
# ---------------------------------------------------------------------------
def external_effect(fact_ext: DataFrame, dim_external: DataFrame, grain: str = "day") -> DataFrame:
    """Mean revenue and orders per day (or week, from its Monday) in rain vs
    dry and holiday vs normal periods.  ``rain_day`` is NULL where the rain is
    unknown.  The averages run over all days of the external dimension: a day
    without sales counts with zero."""
    period = F.col("date") if grain == "day" else F.date_trunc("week", "date").cast("date")
    days = dim_external.select("external_sk", period.alias("period"), (F.col("rain") > 0).alias("rain_day"),
                               F.coalesce(F.col("is_holiday"), F.lit(0)).alias("is_holiday"))
    seg = ["period", "rain_day", "is_holiday"]
    per_order = (fact_ext.join(days, "external_sk", "inner").groupBy(*seg, "order_id")
                 .agg(F.sum("price").alias("_rev")))
    sales = per_order.groupBy(*seg).agg(F.sum("_rev").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    # the spine and the sales meet in one aggregate: no join on NULL segments
    spine = days.select(*seg).distinct().select(*seg, F.lit(0).cast("decimal(12,2)").alias("revenue"),
                                                F.lit(0).cast("bigint").alias("orders"))
    per_period = spine.unionByName(sales).groupBy(*seg).agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    return per_period.groupBy("rain_day", "is_holiday").agg(
        F.count(F.lit(1)).alias("periods"),
        F.avg(F.col("revenue").cast("double")).alias("avg_revenue"),
        F.avg(F.col("orders").cast("double")).alias("avg_orders"),
        share(F.sum("revenue"), F.sum("orders")).alias("revenue_per_order"))
