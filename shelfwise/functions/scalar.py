"""Scalar functions as column expressions; all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from shelfwise.constants import MILLISECOND_FLOOR, SCORE_DIGITS


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds from a column that mixes seconds and milliseconds."""
    ts = ts.cast("bigint")
    return F.when(ts >= MILLISECOND_FLOOR, F.floor(ts / 1000)).otherwise(ts).cast("bigint")


def complete(names: Iterable[str | Column], number: str | Column | None = None) -> Column:
    """No column is NULL and ``number`` is finite; true or false, never NULL."""
    ok = F.lit(True)
    for name in names:
        ok = ok & F.isnotnull(name)
    if number is not None:
        finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
        ok = ok & F.coalesce(finite, F.lit(False))
    return ok


def year_month(ts: Column, zone: str = "UTC") -> Column:
    """Epoch seconds to an integer yyyyMM in ``zone``, whatever the session zone is."""
    if zone == "UTC":
        # Whole days make a date without any zone rules, which cost more than the aggregation.
        day = F.date_from_unix_date(F.floor(ts / 86400).cast("int"))
    else:
        here = F.timestamp_seconds(ts).cast("timestamp_ntz")
        day = F.convert_timezone(F.current_timezone(), F.lit(zone), here).cast("date")
    return (F.year(day) * 100 + F.month(day)).cast("int")


def half_star(stars: Column) -> Column:
    """A 1..10 click on half stars as a 0.5..5.0 score."""
    return F.round(stars.cast("double") / 2, 2)


def split_list(joined: Column) -> Column:
    """A ``|``-joined list as an array of its non-empty items."""
    return F.filter(F.split(joined, r"\|"), lambda item: item != "")


def rounded(score: Column, digits: int = SCORE_DIGITS) -> Column:
    """Half-up rounding by plain arithmetic, so that every engine gives the same bits."""
    scale = float(10**digits)
    return F.floor(score * scale + 0.5) / scale


def vector_dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; NULL (never NaN) when one of them has no length."""
    return F.try_divide(vector_dot(a, b), F.sqrt(vector_dot(a, a)) * F.sqrt(vector_dot(b, b)))


def register_sql_functions(spark: SparkSession) -> None:
    """Makes ``changeDate(epochSeconds)``, the yyyyMM in UTC, known to SQL text.

    It is a SQL function, so Catalyst inlines it; no Python or JVM closure is involved.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(ts BIGINT) RETURNS INT RETURN "
        "(SELECT year(d) * 100 + month(d) "
        "FROM (SELECT date_from_unix_date(CAST(floor(ts / 86400) AS INT)) AS d))"
    )
