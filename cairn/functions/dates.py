"""Collection dates of seven written shapes, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
NOT_APPLICABLE = "NA"


def _month(name: Column) -> Column:
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m.lower(), f"{i:02d}")])
    return F.try_element_at(numbers, F.lower(name))


def normalized(c: Column) -> Column:
    """iso and precision (day, month, year, range, or NA if the shape is none of the seven).

    A range of years is the floor of their mean, as the precision tells.
    """
    text = F.trim(F.coalesce(c, F.lit("")))
    part = lambda pattern, k: F.regexp_extract(text, pattern, k)
    day, month_name, name_year = r"^([0-9]{1,2})-([A-Za-z]{3})-([0-9]{4})$", r"^([A-Za-z]{3})-([0-9]{4})$", r"^([0-9]{4})-([0-9]{2})$"
    span = r"^([0-9]{4})[/-]([0-9]{4})$"
    iso_span = r"^([0-9]{4})-[0-9]{2}-[0-9]{2}/([0-9]{4})-[0-9]{2}-[0-9]{2}$"
    mean = lambda p: F.format_string("%04d", F.floor((part(p, 1).try_cast("int") + part(p, 2).try_cast("int")) / 2))
    of = lambda iso, precision: F.struct(iso.alias("iso"), F.lit(precision).alias("precision"))
    return (
        F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), of(text, "day"))
        .when(text.rlike(day) & _month(part(day, 2)).isNotNull(), of(F.concat_ws("-", part(day, 3), _month(part(day, 2)), F.lpad(part(day, 1), 2, "0")), "day"))
        .when(text.rlike(month_name) & _month(part(month_name, 1)).isNotNull(), of(F.concat_ws("-", part(month_name, 2), _month(part(month_name, 1))), "month"))
        .when(text.rlike(name_year), of(text, "month"))
        .when(text.rlike(r"^[0-9]{4}$"), of(text, "year"))
        .when(text.rlike(span), of(mean(span), "range"))
        .when(text.rlike(iso_span), of(mean(iso_span), "range"))
        .otherwise(of(F.lit(""), NOT_APPLICABLE))
    )


def decimal_year(iso: Column, precision: Column) -> Column:
    """Position in time as a year; months are taken at their 15th, years at their middle, leap days not at all."""
    before = F.array(*[F.lit(x) for x in (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)])
    year = F.substring(iso, 1, 4).try_cast("double")
    month, day = F.substring(iso, 6, 2).try_cast("int"), F.substring(iso, 9, 2).try_cast("int")
    start = F.try_element_at(before, month)
    return F.when(precision == "day", year + (start + day - 0.5) / 365).when(precision == "month", year + (start + 15) / 365).when(precision.isin("year", "range"), year + 0.5)
