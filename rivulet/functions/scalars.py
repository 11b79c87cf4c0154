"""Numeric, vector, date and format expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.text import bind, strip_white

# Formats of tool arguments.
ID_FORMAT = r"^[A-Za-z0-9]{6,24}$"
PERIOD_FORMAT = r"^\d{4}-(0[1-9]|1[0-2])$"
M3_LIMIT = 100_000


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(v: Column) -> Column:
    """Unit vector; a zero vector is an error."""
    norm = F.sqrt(dot(v, v))
    checked = F.when(norm > 0, norm).otherwise(F.raise_error(F.lit("zero vector")).cast("double"))
    return bind(checked, lambda n: F.transform(v, lambda x: x.cast("double") / n))


def cosine_similarity(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def _product_error(x: Column, y: Column, p: Column) -> Column:
    """Exact x * y - p for p = x * y in doubles (Dekker's product with Veltkamp splitting)."""

    def split(v: Column) -> tuple[Column, Column]:
        c = v * F.lit(134217729.0)
        high = c - (c - v)
        return high, v - high

    (xh, xl), (yh, yl) = split(x), split(y)
    return ((xh * yh - p) + xh * yl + xl * yh) + xl * yl


def six_significant(x: Column) -> Column:
    """Six significant digits of the exact double; NaN and infinities become null.

    The printf family of the JVM rounds the shortest decimal instead, which differs
    on apparent ties, so those are settled by the error of the scaled product.
    """
    plain = F.when(F.isnan(x) | F.abs(x).eqNullSafe(F.lit(float("inf"))), None).otherwise(x)
    places = F.lit(5) - F.floor(F.log10(F.abs(plain))).cast("int")
    scale = F.pow(F.lit(10.0), F.abs(places).cast("double"))
    scaled = F.when(places >= 0, plain * scale).otherwise(plain / scale)
    low = F.floor(scaled).cast("double")
    error = F.when(places >= 0, _product_error(plain, scale, scaled)).otherwise(F.lit(0.0))
    whole = (
        F.when(scaled - low != 0.5, F.rint(scaled))
        .when(error > 0, low + 1)
        .when(error < 0, low)
        .otherwise(F.rint(scaled))
    )
    rounded = F.when(places >= 0, whole / scale).otherwise(whole * scale)
    return F.when(plain == 0, F.lit(0.0)).when(places > 22, F.format_string("%.6g", plain).cast("double")).otherwise(rounded)


def format_thousands(x: Column, digits: int = 1) -> Column:
    return F.format_number(x, digits)


def money_half_up(x: Column, digits: int = 2) -> Column:
    return F.round(x, digits)


def money_half_even(x: Column, digits: int = 2) -> Column:
    return F.bround(x, digits)


def period_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def night_hour(ts: Column, hours=(2, 3, 4)) -> Column:
    return F.hour(ts).isin(*hours)


def valid_id(x: Column) -> Column:
    return F.coalesce(strip_white(x).rlike(ID_FORMAT), F.lit(False))


def valid_period(x: Column) -> Column:
    """An absent period is allowed."""
    return F.coalesce(strip_white(x).rlike(PERIOD_FORMAT), F.lit(True))


def normal_tariff(x: Column) -> Column:
    return F.regexp_replace(F.lower(strip_white(x)), " ", "_")


def argument_problem(ident: Column, period: Column, tariff: Column, m3: Column, known_tariffs) -> Column:
    """First broken rule of a tool call, or null when the arguments are valid."""
    return (
        F.when(~valid_id(ident), "id")
        .when(~valid_period(period), "period")
        .when(~F.coalesce(normal_tariff(tariff).isin(*known_tariffs), F.lit(False)), "tariff")
        .when(~F.coalesce(m3.between(0, M3_LIMIT), F.lit(False)), "m3")
    )
