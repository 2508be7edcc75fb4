"""Publication day from free text, as Column expressions.

The day is the one that is written; no time zone conversion takes place. Only
complete dates count: a time alone or a month without a day gives null, so the
caller falls back on the day of the storage path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.functions.text import trim_space

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = (
    r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_WEEKDAY = r"(?:mon|tue|wed|thu|fri|sat|sun)(?:day|s|sday|nesday|r|rs|rsday|urday)?"
# Words that may stand between the parts of a date.
_FILLERS = ("of", "the", "on", "at", "and", "t", "ad")
_ZONE = rf"(?:\s*(?!(?:{_MONTH}|{_WEEKDAY}|{'|'.join(_FILLERS)})\b)[a-z]{{1,5}}\b)?\s*(?:[+-]\d{{2}}(?::?\d{{2}})?\b)?(?:\s*\([a-z ]+\))?"
_HALF = r"(?:\s*[ap]\.?m\b\.?)"
_CLOCK = rf"(?:(?:[01]?\d|2[0-4])(?::[0-5]\d){{1,2}}(?:[.,]\d+)?{_HALF}?|(?:0?\d|1[0-2]){_HALF}){_ZONE}"
_TAIL = rf"(?:(?:\s*,\s*|\s+|\s*t\s*)(?:at\s+)?{_CLOCK})?$"

_YMD = rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TAIL}"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:t?(?:[01]\d|2[0-4])[0-5]\d(?:[0-5]\d)?(?:[.,]\d+)?\s*(?:z|[+-]\d{2}:?\d{2})?)?$"
_NUMERIC = rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}}){_TAIL}"
_NUMBER = r"^(\d{1,2}|\d{4})(?:st|nd|rd|th)?$"


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))


def _full_year(year: Column) -> Column:
    """Two-digit years lie within fifty years of the current one, as most date readers assume."""
    now = F.year(F.current_date())
    near = (F.floor(now / 100) * 100 + year.try_cast("int")).cast("int")
    near = F.when(near >= now + 50, near - 100).when(near < now - 50, near + 100).otherwise(near)
    return F.when(F.length(year) == 2, near.cast("string")).otherwise(year)


def _named_month(t: Column) -> Column:
    """Date of a text that names its month: month, day and year in any order.

    The clock is taken out, then fillers and weekdays; what is left must be three words, one a month
    and two numbers. The year is the number of four digits, or the one that can be no day; an
    ordinal is the day. Two short numbers are day and year, but year and day before the month.
    """
    without_clock = F.regexp_replace(t, rf"(?:(?<=\d)t\s*|(?<![\w:.])){_CLOCK}", " ")
    words = F.split(F.regexp_replace(without_clock, rf"\b{_WEEKDAY}\b\.?", " "), r"[\s,;/.-]+")
    words = F.filter(words, lambda w: ~w.isin("", *_FILLERS))

    def day(words: Column) -> Column:
        months = F.filter(words, lambda w: w.rlike(f"^{_MONTH}$"))
        numbers = F.filter(words, lambda w: w.rlike(_NUMBER))
        month = F.array_position(F.array(*map(F.lit, _MONTHS)), F.substring(F.get(months, F.lit(0)), 1, 3))
        one, two = (F.get(numbers, F.lit(i)) for i in (0, 1))
        plain = lambda n: F.regexp_extract(n, _NUMBER, 1)
        ordinal = lambda n: n.rlike("[a-z]")
        is_year = lambda n: ~ordinal(n) & ((F.length(n) == 4) | (n.try_cast("int") > 31))
        last = F.get(words, F.lit(2)) == F.get(months, F.lit(0))
        year_first = is_year(one) | (~is_year(two) & (ordinal(two) | (last & ~ordinal(one))))
        year, number = F.when(year_first, plain(one)).otherwise(plain(two)), F.when(year_first, plain(two)).otherwise(plain(one))
        whole = (F.size(words) == 3) & (F.size(months) == 1) & (F.size(numbers) == 2) & (F.length(year) != 1) & (F.length(number) <= 2)
        return F.when(whole, _date(_full_year(year), month.cast("string"), number))

    # One element, so that the words are bound before they are read many times.
    return F.get(F.transform(F.array(words), day), F.lit(0))


def publication_day(c: Column) -> Column:
    """Date from ISO, compact, numeric (month first unless impossible) or named months in any order."""
    text = F.lower(trim_space(c))
    t = F.regexp_replace(text, rf"^{_WEEKDAY}\.?,?\s+(?=\d+[-/.])", "")

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(t, pattern, i)

    full_year = _full_year(part(_NUMERIC, 3))
    first, second = part(_NUMERIC, 1), part(_NUMERIC, 2)
    numeric = F.coalesce(_date(full_year, first, second), _date(full_year, second, first))
    return (
        F.when(t.rlike(_YMD), _date(part(_YMD, 1), part(_YMD, 2), part(_YMD, 3)))
        .when(t.rlike(_COMPACT), _date(part(_COMPACT, 1), part(_COMPACT, 2), part(_COMPACT, 3)))
        .when(t.rlike(_NUMERIC), numeric)
        .when(t.rlike(rf"\b{_MONTH}\b"), _named_month(t))
    )


def day_from_path(path: Column) -> Column:
    """``YYYY-MM-DD`` of a ``/dt=.../`` path segment, else null."""
    return F.nullif(F.regexp_extract(path, r"/dt=(\d{4}-\d{2}-\d{2})/", 1), F.lit(""))
