"""Registered queries: holidays, weather, external dimension and its effect
(O-03, O-04, O-26, O-33, O-36, O-70)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources import external as E
from ..sources import testdata
from . import oracle as O
from .catalog import CITY, present, register
from .star import Star, dim_external_of, fact_external_of, holidays_of, weather_of, weather_raw_of

STATE = testdata.DEFAULT_STATE

_HOL_CTE = f"""
, yrs AS (SELECT unnest(generate_series(year(min(order_delivered_customer_date)),
                                        year(max(order_delivered_customer_date)))) AS y FROM orders_raw),
hol_raw AS (
  SELECT CAST(CAST(y AS VARCHAR) || '-' || md AS DATE) AS date, holiday_name, city, state, scope
  FROM yrs, (VALUES ('01-01', 'New Year', NULL, NULL, 'national'),
                    ('05-01', 'State Day', NULL, '{STATE}', 'state'),
                    ('07-09', 'City Day', ' {CITY.upper()} ', '{STATE}', 'municipal'))
             h(md, holiday_name, city, state, scope)),
hol_day AS (
  SELECT date, min(holiday_name) AS holiday_name FROM hol_raw
  WHERE scope = 'national' OR (scope = 'state' AND trim(upper(state)) = '{STATE}')
     OR (scope = 'municipal' AND trim(lower(city)) = '{CITY}')
  GROUP BY date),
holidays AS (
  SELECT c.date, '{CITY}' AS city, CASE WHEN h.holiday_name IS NOT NULL THEN 1 ELSE 0 END AS is_holiday,
         h.holiday_name
  FROM dim_calendar c LEFT JOIN hol_day h USING (date)),
w_raw AS (
  SELECT CAST(date AS VARCHAR) AS date, ' Nation_2 ' AS city,
         CAST(dayofyear(date) % 40 + CASE WHEN dayofyear(date) % 90 = 0 THEN 40 ELSE 0 END AS DOUBLE) AS temp_avg,
         CASE WHEN dayofyear(date) % 50 = 0 THEN -1.0 ELSE CAST(dayofyear(date) % 7 AS DOUBLE) END AS precip_mm,
         CASE WHEN month(date) = 1 THEN 'yes' ELSE 'no' END AS is_holiday
  FROM dim_calendar
  UNION ALL
  SELECT CAST(date AS VARCHAR), '{CITY.upper()}', CAST(dayofyear(date) % 40 + 5 AS DOUBLE), NULL, NULL
  FROM dim_calendar WHERE dayofyear(date) % 30 = 0),
weather AS (
  SELECT CAST(date AS DATE) AS date, trim(lower(city)) AS city,
         CASE WHEN temp_avg IS NOT NULL AND NOT (temp_avg BETWEEN -10 AND 55) THEN NULL
              ELSE round(temp_avg, 1) END AS temp,
         CASE WHEN precip_mm IS NOT NULL AND precip_mm < 0 THEN NULL ELSE precip_mm END AS rain,
         CASE WHEN is_holiday IS NULL THEN NULL
              WHEN lower(trim(is_holiday)) IN ('1', 'true', 't', 'yes', 'y', 'si', 'sí') THEN 1 ELSE 0 END
           AS is_holiday
  FROM w_raw),
dim_external AS (
  SELECT CAST(row_number() OVER (ORDER BY date, city) AS BIGINT) AS external_sk, *
  FROM (SELECT coalesce(w.date, h.date) AS date, coalesce(w.city, h.city) AS city, w.temp, w.rain,
               h.is_holiday
        FROM (SELECT * FROM weather QUALIFY row_number() OVER (PARTITION BY date, city
                ORDER BY temp DESC NULLS LAST, rain DESC NULLS LAST) = 1) w
        FULL JOIN holidays h ON w.date = h.date AND w.city = h.city))
"""
assert CITY == "nation_2"


@register("holiday_calendar", O.q(_HOL_CTE + """
SELECT CAST(date AS TIMESTAMP) AS date, city, is_holiday, holiday_name FROM holidays"""))
def holiday_calendar(s: Star) -> DataFrame:
    """O-03: holiday flag for every calendar day of the city (national, state
    or municipal holidays), gap-filled with 0."""
    return present(holidays_of(s, CITY, STATE), dates=["date"])


@register("weather_clean", O.q(_HOL_CTE + """
SELECT CAST(date AS TIMESTAMP) AS date, city, temp, rain, CAST(is_holiday AS DOUBLE) AS is_holiday FROM weather"""))
def weather_clean(s: Star) -> DataFrame:
    """O-04 + O-26: daily weather records validated and normalized."""
    return present(weather_of(s, CITY), dates=["date"], nullable_ints=["is_holiday"])


@register("weather_anomalies", O.q(_HOL_CTE + """
SELECT date, city, temp_avg, precip_mm,
       CASE WHEN temp_avg IS NOT NULL AND NOT (temp_avg BETWEEN -10 AND 55) THEN 'temp_out_of_range'
            ELSE 'negative_rain' END AS reason
FROM w_raw
WHERE (temp_avg IS NOT NULL AND NOT (temp_avg BETWEEN -10 AND 55))
   OR (precip_mm IS NOT NULL AND precip_mm < 0)
"""))
def weather_anomalies(s: Star) -> DataFrame:
    """O-04: raw weather records that break a range rule, with the reason."""
    return E.weather_anomalies(weather_raw_of(s, CITY))


@register("dim_external", O.q(_HOL_CTE + """
SELECT external_sk, CAST(date AS TIMESTAMP) AS date, city, temp, rain, is_holiday FROM dim_external"""))
def dim_external(s: Star) -> DataFrame:
    """O-33: one row per (date, city) merging holidays and weather."""
    return present(dim_external_of(s, CITY, STATE), dates=["date"])


@register("fact_external", O.q(_HOL_CTE + """
, sel AS (
  SELECT CAST(row_number() OVER (ORDER BY seller_id) AS BIGINT) AS seller_sk, seller_id
  FROM (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS seller_id FROM supplier))
SELECT f.event_id, f.order_id, f.order_item_id, CAST(s.seller_sk AS DOUBLE) AS seller_sk,
       CAST(x.external_sk AS DOUBLE) AS external_sk
FROM fact f
JOIN items i ON i.order_id = f.order_id AND i.order_item_id = f.order_item_id
LEFT JOIN sel s ON s.seller_id = i.seller_id
LEFT JOIN dim_calendar c ON c.calendar_sk = f.calendar_sk
LEFT JOIN dim_customer dc ON dc.customer_sk = f.customer_sk
LEFT JOIN dim_external x ON x.date = c.date AND x.city = dc.customer_city
""".replace("\n, sel AS", ", sel AS", 1)))
def fact_external(s: Star) -> DataFrame:
    """O-36: seller and external keys filled by left lookups (misses stay NULL)."""
    d = fact_external_of(s, CITY, STATE).select("event_id", "order_id", "order_item_id",
                                                "seller_sk", "external_sk")
    return present(d, nullable_ints=["seller_sk", "external_sk"])


def _effect_sql(first_day: str) -> str:
    """``first_day``: the first day of a day's period, from x.date."""
    return f"""
, ext AS (SELECT x.*, {first_day} AS first_day, CASE WHEN rain IS NOT NULL THEN rain > 0 END AS wet,
                 coalesce(is_holiday, 0) AS holiday FROM dim_external x),
takings AS (
  SELECT e.first_day, e.wet, e.holiday, sum(f.price) AS revenue, count(DISTINCT f.order_id) AS orders
  FROM fact f JOIN dim_calendar USING (calendar_sk) JOIN dim_customer USING (customer_sk)
  JOIN ext e ON e.date = dim_calendar.date AND e.city = customer_city GROUP BY ALL),
periods AS (SELECT DISTINCT first_day, wet, holiday FROM ext)
SELECT CAST(CAST(p.wet AS INTEGER) AS DOUBLE) AS rain_day, p.holiday AS is_holiday, count(*) AS periods,
       {O.r6('avg(coalesce(CAST(revenue AS DOUBLE), 0))', 'avg_revenue')},
       {O.r6('avg(coalesce(CAST(orders AS DOUBLE), 0))', 'avg_orders')},
       {O.r6('CAST(sum(revenue) AS DOUBLE) / NULLIF(CAST(sum(orders) AS DOUBLE), 0)', 'revenue_per_order')}
FROM periods p LEFT JOIN takings s ON s.first_day = p.first_day AND s.wet IS NOT DISTINCT FROM p.wet AND s.holiday = p.holiday
GROUP BY ALL
"""


@register("weather_effect", O.q(_HOL_CTE + _effect_sql("x.date")))
def weather_effect(s: Star) -> DataFrame:
    """O-70: mean daily revenue and orders on rain vs dry days and holidays."""
    d = E.external_effect(fact_external_of(s, CITY, STATE), dim_external_of(s, CITY, STATE))
    return present(d, rates=["avg_revenue", "avg_orders", "revenue_per_order"], nullable_ints=["rain_day"])


@register("weather_effect_week", O.q(_HOL_CTE + _effect_sql("x.date - CAST(isodow(x.date) - 1 AS INTEGER)")))
def weather_effect_week(s: Star) -> DataFrame:
    """O-70 at week grain: mean weekly revenue and orders by rain / holiday."""
    d = E.external_effect(fact_external_of(s, CITY, STATE), dim_external_of(s, CITY, STATE), grain="week")
    return present(d, rates=["avg_revenue", "avg_orders", "revenue_per_order"], nullable_ints=["rain_day"])
