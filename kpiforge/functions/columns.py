"""Column expressions shared by the staging, star-schema and KPI jobs.

Everything here returns a native ``Column`` so it runs inside whole-stage
codegen; nothing goes through a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Accent folding applied to city names when ``deaccent=True``; the specs ask
# for "remove accents" on Portuguese names (lower-case letters only, as the
# text is lower-cased first).
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüç"
UNACCENTED = "aaaaaeeeeiiiiooooouuuuc"
# Separator of every fingerprint input.
HASH_SEP = "|"
# Seconds in a day (lead time in days).
SECONDS_PER_DAY = 86400.0


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# O-18 text normalization
# ---------------------------------------------------------------------------
def norm_lower(c: ColumnOrName, deaccent: bool = False) -> Column:
    """trim(lower(c)); optionally fold accents (after lower-casing)."""
    out = F.trim(F.lower(_c(c)))
    if deaccent:
        out = F.translate(out, ACCENTED, UNACCENTED)
    return out


def norm_upper(c: ColumnOrName) -> Column:
    return F.trim(F.upper(_c(c)))


def accent_blind(c: ColumnOrName) -> Column:
    """O-18: the trimmed text under a collation for which case and accents don't
    matter: ``==``, joins, grouping and ordering of it see `` São Paulo`` and
    ``SAO PAULO`` as one.  The text itself stays as it is."""
    return F.collate(F.trim(_c(c)), "UNICODE_CI_AI")


# ---------------------------------------------------------------------------
# O-15 / O-16 / O-17 dates
# ---------------------------------------------------------------------------
def to_day(c: ColumnOrName) -> Column:
    return F.to_date(_c(c))


def coerce_ts(c: ColumnOrName) -> Column:
    """Text -> timestamp without zone; unparsable text becomes NULL."""
    return F.trim(_c(c).cast("string")).try_cast("timestamp_ntz")


def calendar_parts(date_col: ColumnOrName = "date") -> dict[str, Column]:
    """Day of week with 0 = Sunday, ISO week, month, quarter, calendar year."""
    d = _c(date_col)
    return {
        "day_of_week": (F.dayofweek(d) - 1).cast("int"),
        "week": F.weekofyear(d).cast("int"),
        "month": F.month(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "year": F.year(d).cast("int"),
    }


# ---------------------------------------------------------------------------
# O-19 / O-20 fingerprints
# ---------------------------------------------------------------------------
def iso_seconds(c: ColumnOrName) -> Column:
    """ISO text truncated to seconds, e.g. 2017-10-02T10:56:33."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss")


def iso_text(c: ColumnOrName) -> Column:
    """ISO text like ``Timestamp.isoformat()``: fraction only when non-zero."""
    ts = _c(c)
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == F.lit("000000"), iso_seconds(ts)).otherwise(
        F.concat(iso_seconds(ts), F.lit("."), micros))


def fixed2(c: ColumnOrName) -> Column:
    """Money as text with exactly two decimals (``1234.50``)."""
    return _c(c).cast("decimal(15,2)").cast("string")


def staging_field(c: ColumnOrName, kind: str) -> Column:
    """Text of one field of the staging fingerprint.

    ``kind``: ``ts`` -> ISO text, NULL -> ''; anything else -> text, NULL -> 'nan'
    (the textual form of a missing value in the loaders' frames).
    """
    col = _c(c)
    if kind == "ts":
        return F.coalesce(iso_text(col), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit("nan"))


def row_md5(fields: Iterable[tuple[str, str]]) -> Column:
    """O-19: md5 of the pipe-joined staging fields [(column, kind), ...]."""
    parts = [staging_field(c, k) for c, k in fields]
    return F.md5(F.concat_ws(HASH_SEP, *parts))


def business_md5(order_id: ColumnOrName = "order_id",
                 order_item_id: ColumnOrName = "order_item_id",
                 price: ColumnOrName = "price",
                 freight: ColumnOrName = "freight_value",
                 approved: ColumnOrName = "order_approved_at",
                 delivered: ColumnOrName = "order_delivered_customer_date",
                 estimated: ColumnOrName = "order_estimated_delivery_date") -> Column:
    """O-20: md5 over ids, money with two decimals and ISO dates (NULL -> '').

    NULL money is dropped by ``concat_ws`` exactly as in the reference.
    """
    return F.md5(F.concat_ws(
        HASH_SEP,
        _c(order_id).cast("string"),
        _c(order_item_id).cast("string"),
        fixed2(price),
        fixed2(freight),
        F.coalesce(iso_seconds(approved), F.lit("")),
        F.coalesce(iso_seconds(delivered), F.lit("")),
        F.coalesce(iso_seconds(estimated), F.lit("")),
    ))


# ---------------------------------------------------------------------------
# O-21 / O-22 derived metrics
# ---------------------------------------------------------------------------
def lead_time_days(delivered: ColumnOrName = "order_delivered_customer_date",
                   approved: ColumnOrName = "order_approved_at") -> Column:
    """(delivered - approved) in fractional days; NULL if either is NULL."""
    micros = F.timestamp_diff("MICROSECOND", _c(approved), _c(delivered))
    return (micros.cast("double") / F.lit(SECONDS_PER_DAY * 1e6)).alias("lead_time_days")


def on_time_flag(delivered: ColumnOrName = "order_delivered_customer_date",
                 estimated: ColumnOrName = "order_estimated_delivery_date") -> Column:
    """1 if delivered <= estimated, 0 if later, NULL when either is missing."""
    d, e = _c(delivered), _c(estimated)
    return (F.when(d.isNull() | e.isNull(), F.lit(None).cast("int"))
            .when(d <= e, F.lit(1)).otherwise(F.lit(0)))


# ---------------------------------------------------------------------------
# O-23 / O-24 / O-25 small helpers
# ---------------------------------------------------------------------------
def share(x: ColumnOrName, total: ColumnOrName) -> Column:
    """x / total as double, NULL when total is 0 or NULL."""
    t = _c(total).cast("double")
    return _c(x).cast("double") / F.nullif(t, F.lit(0.0))


def period_label(year: ColumnOrName = "year", quarter: ColumnOrName = "quarter") -> Column:
    """'2018 Q2'."""
    return F.concat(_c(year).cast("string"), F.lit(" Q"), _c(quarter).cast("string"))


def ab_group(customer_id: ColumnOrName = "customer_id") -> Column:
    """Low bit of the first 8 hex digits of md5(id): 0 = control, 1 = treatment."""
    prefix = F.substring(F.md5(_c(customer_id).cast("string")), 1, 8)
    return (F.conv(prefix, 16, 10).cast("bigint").bitwiseAND(F.lit(1))).cast("int")


def quarter_index(year: ColumnOrName = "year", quarter: ColumnOrName = "quarter") -> Column:
    """Consecutive quarter number, so t-4 is index - 4 (gaps stay gaps)."""
    return _c(year).cast("int") * 4 + _c(quarter).cast("int") - 1


def is_distinct(a: ColumnOrName, b: ColumnOrName) -> Column:
    """SQL ``a IS DISTINCT FROM b``."""
    return ~_c(a).eqNullSafe(_c(b))
