"""Date expressions: Column in, Column out."""

import calendar

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import strip


def parse_timestamp(c: Column) -> Column:
    """First fitting of m/d/Y, d/m/Y, Y-m-d, Y/m/d, d-m-Y with a time of day, as a zoneless timestamp.

    Texts are brought to year-month-day and parsed once. With slashes a first number of 1 to 12 is the month: where
    that gives no date, reading it as the day gives none either.
    """
    ordered = strip(c)
    for pattern, year_first in [
        (r"^(\d{4})([/-])(\d{1,2})\2(\d{1,2})\s+", "$1-$3-$4 "),
        (r"^(0?[1-9]|1[0-2])/(\d{1,2})/(\d{4})\s+", "$3-$1-$2 "),
        (r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4})\s+", "$4-$3-$1 "),
    ]:
        ordered = F.regexp_replace(ordered, pattern, year_first)
    whole = F.regexp_extract(ordered, r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", 0)
    return whole.try_cast("timestamp_ntz")


def date_valid(parsed: Column) -> Column:
    """A list of years, since a filter parses the date twice for the two bounds of a range."""
    return F.coalesce(F.year(parsed).isin(list(range(fixed.MIN_YEAR, fixed.MAX_YEAR + 1))), F.lit(False))


def date_error(raw: Column, parsed: Column) -> Column:
    year = F.year(parsed)
    return (
        F.when(raw.isNull(), "Date is null")
        .when(strip(raw) == "", "Date is empty")
        .when(parsed.isNull(), F.concat(F.lit("Could not parse date: "), strip(raw)))
        .when(~year.between(fixed.MIN_YEAR, fixed.MAX_YEAR), F.concat(F.lit("Year out of range: "), year.cast("string")))
    )


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def yearly_holiday(day: Column, as_written=False) -> Column:
    """Holiday by (month, day). `as_written` looks the list up with day and month swapped."""
    probe = (F.dayofmonth(day), F.month(day)) if as_written else (F.month(day), F.dayofmonth(day))
    return (probe[0] * 100 + probe[1]).isin([m * 100 + d for m, d in fixed.YEARLY_HOLIDAYS])


def dated_holiday(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd").isin(fixed.DATED_HOLIDAYS)


def calendar_features(day: Column) -> dict[str, Column]:
    """The ten calendar features of the forecast frame."""
    angle = 2 * F.pi() * F.dayofyear(day) / 365.25
    return {
        "jour_semaine": F.weekday(day),
        "jour_mois": F.dayofmonth(day),
        "mois": F.month(day),
        "trimestre": F.quarter(day),
        "semaine_annee": F.weekofyear(day),
        "est_weekend": is_weekend(day).cast("int"),
        "jour_annee": F.dayofyear(day),
        "jour_annee_sin": F.sin(angle),
        "jour_annee_cos": F.cos(angle),
        "est_ferie": dated_holiday(day).cast("int"),
    }


CALENDAR_COLUMNS = [
    "jour_semaine", "jour_mois", "mois", "trimestre", "semaine_annee",
    "est_weekend", "jour_annee", "jour_annee_sin", "jour_annee_cos", "est_ferie",
]


def days_between(first: Column, last: Column) -> Column:
    """One row per day, both ends included."""
    return F.explode(F.sequence(first, last))


def month_names() -> list[str]:
    return list(calendar.month_name)[1:]
