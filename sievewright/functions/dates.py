"""Date parsing expressions. None of them raises: text that is not a date gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date formats, in order of preference.
DAY_FIRST_FORMATS = (
    "yyyy-MM-dd", "dd-MM-yyyy", "MM-dd-yyyy", "yyyy/MM/dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyyMMdd",
)
MISSING_DATE_TOKENS = ("", "none", "nan", "null")
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
    "november", "december",
)

# The shapes a date may take in the type report.
DATE_SHAPES = (
    r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])",
    r"(0[1-9]|[12]\d|3[01])-(0[1-9]|1[0-2])-\d{4}",
    r"(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])-\d{4}",
    r"\d{4}/(0[1-9]|[12]\d|3[01])/(0[1-9]|1[0-2])",
    r"(0[1-9]|[12]\d|3[01])/(0[1-9]|1[0-2])/\d{4}",
    r"(0[1-9]|1[0-2])/(0[1-9]|[12]\d|3[01])/\d{4}",
    r"\d{8}",
)
DATE_PATTERN = "^(" + "|".join(DATE_SHAPES) + ")$"
DATE_LIKE_PATTERN = r"\d{4}[-/]\d{1,2}[-/]\d{1,2}"


def _as_date(*parts: Column) -> Column:
    """Year, month and day texts as a date; NULL when there is no such day."""
    return F.concat_ws("-", *parts).try_cast("date")


def digit_shape(c: Column) -> Column:
    """Every ASCII digit as ``9``: ``31-01-2024`` -> ``99-99-9999``."""
    return F.translate(c, "012345678", "999999999")


def parse_multi(c: Column, signed_years: bool = False) -> Column:
    """First hit of the seven formats; an ambiguous day and month is read day first.

    A formatter that fails raises inside the JVM, seven times for each bad text. Here the shape of the text
    says where year, month and day stand, and a plain cast checks the day. Years with a sign
    (``+12024-01-01``), the only other texts the formats accept, go through the formatters when asked for.
    """
    shape = digit_shape(c)
    year_first = shape.isin("9999-99-99", "9999/99/99")
    year_last = shape.isin("99-99-9999", "99/99/9999")
    head, tail, year = F.substring(c, 1, 2), F.substring(c, 4, 2), F.substring(c, 7, 4)
    parsed = (
        F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), c.try_cast("date"))
        .when(year_first, F.translate(c, "/", "-").try_cast("date"))
        .when(year_last, F.coalesce(_as_date(year, tail, head), _as_date(year, head, tail)))
        .when(shape == "99999999", _as_date(F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)))
    )
    if not signed_years:
        return parsed
    formatted = F.coalesce(*[F.try_to_date(c, f) for f in DAY_FIRST_FORMATS])
    return parsed.when(c.rlike(r"\+|^-|[-/]-"), formatted)


def parse_strict(c: Column) -> Column:
    """First hit of ``Y-m-d, m/d/Y, d/m/Y, Y/m/d, d-m-Y, m-d-Y``; one-digit days and months are accepted, years have
    four digits. With the year last, slashes mean month first and hyphens day first."""
    text = F.trim(c)
    parts = F.split(text, "[-/]")
    one, two, year = (F.get(parts, i) for i in range(3))
    month_first, day_first = _as_date(year, one, two), _as_date(year, two, one)
    return (
        F.when(text.rlike(r"^\d{4}(-\d{1,2}-|/\d{1,2}/)\d{1,2}$"), F.translate(text, "/", "-").try_cast("date"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.coalesce(month_first, day_first))
        .when(text.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.coalesce(day_first, month_first))
    )


def strict_issue(c: Column) -> Column:
    """Why a text is not a strict date: ``dynamic_or_partial``, ``unparseable``, or NULL when it is fine."""
    text = F.trim(c)
    return (
        F.when(text.isNull() | F.lower(text).isin(*MISSING_DATE_TOKENS), F.lit(None).cast("string"))
        .when(~text.rlike(r"\d"), "dynamic_or_partial")
        .when(parse_strict(c).isNull(), "unparseable")
    )


# How the days of the week begin in English.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
_TIME = r"(?:[ t]|, )+(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)? ?([ap]m)? ?(?:z|utc|gmt|[+-]\d{2}:?\d{2})?$"


def _time_fits(text: Column) -> Column:
    """No time of day at the end, or one that there is."""
    hour, minute, second = (F.regexp_extract(text, _TIME, i).try_cast("int") for i in (1, 2, 3))
    half_day = F.regexp_extract(text, _TIME, 4) != ""
    fits = (minute < 60) & (F.coalesce(second, F.lit(0)) < 60) & F.when(half_day, hour.between(1, 12)).otherwise(hour < 24)
    return F.when(text.rlike(_TIME), F.coalesce(fits, F.lit(False))).otherwise(F.lit(True))


def parse_permissive(c: Column) -> Column:
    """A date in any usual notation, in any letter case; NULL for what is none.

    The text is cut into numbers, words and what stands between. A weekday in front, a time of day behind, endings as in ``3rd`` and
    ``of`` are left out; what then remains is three parts with a month name (``5 March 2024``, ``Mar 5, 2024``, ``2024-Mar-05``, any of
    English in full, by three letters or as ``sept``), three numbers with the same separator out of ``- / .`` and blank, or eight digits
    ``yyyyMMdd``. The order of three numbers:

    * a first number of four digits is the year, then month and day;
    * else the last one is the year, of four or two digits (two: 1969 to 2068); of the other two the day comes first after hyphens and the
      month otherwise, unless that gives no date: then it is the other way round.

    A day or a year that is missing is not made up, and a time that does not exist spoils the text.
    """
    text = F.lower(F.trim(c))
    for pattern, by in _REWRITE:
        text = F.regexp_replace(text, pattern, by)
    parsed = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
    return F.coalesce(parse_strict(c), F.when(_time_fits(F.lower(F.trim(c))), parsed))


_DAYS = "|".join(f"{d}|{d[:3]}" for d in WEEKDAYS) + "|tues|thur|thurs"
_YEAR = r"(\d{4}|\d{2})"
_ABOVE_TWELVE = r"(1[3-9]|[2-9]\d)"
#: Steps that turn a notation into year-month-day, each a pattern and what takes its place. One expression per step: the parts of a
#: text are never named, so nothing is repeated, and the whole stays small enough to be compiled.
_REWRITE = (
    (_TIME, ""),
    (rf"^(?:{_DAYS})\.?,? +", ""),
    (r"(?<=\d)(?:st|nd|rd|th)\b", ""),
    (r"\bof +", ""),
    # The name of a month becomes its number behind a mark.
    *((rf"\b(?:{m}|{m[:3]}{'|sept' if m == 'september' else ''})\b", f"\x01{i}") for i, m in enumerate(MONTH_NAMES, 1)),
    ("^(\\d{4})[-/. ]+\x01(\\d+)[-/., ]+(\\d{1,2})$", "$1-$2-$3"),
    (f"^(\\d{{1,2}})[-/. ]+\x01(\\d+)[-/., ]+{_YEAR}$", "y$3-$2-$1"),
    (f"^\x01(\\d+)[-/. ]+(\\d{{1,2}})[-/., ]+{_YEAR}$", "y$3-$1-$2"),
    (r"^(\d{4})([-/. ])(\d{1,2})\2 ?(\d{1,2})$", "$1-$3-$4"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    # Day first after hyphens, month first otherwise, unless that makes a month above twelve.
    (rf"^(\d{{1,2}})- ?{_ABOVE_TWELVE}- ?{_YEAR}$", "y$3-$1-$2"),
    (rf"^(\d{{1,2}})-(\d{{1,2}})- ?{_YEAR}$", "y$3-$2-$1"),
    (rf"^{_ABOVE_TWELVE}([/. ])(\d{{1,2}})\2 ?{_YEAR}$", "y$4-$3-$1"),
    (rf"^(\d{{1,2}})([/. ])(\d{{1,2}})\2 ?{_YEAR}$", "y$4-$1-$3"),
    # A year that stood behind is marked, as it may have two digits.
    (r"^y(\d{4})", "$1"),
    (r"^y(69|[7-9]\d)-", "19$1-"),
    (r"^y(\d{2})-", "20$1-"),
)
