"""Dates and times of day, as column expressions. Times are ``HH:MM`` strings, null if unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import norm_key

#: Month names of the listings' language (fixed values).
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
ENGLISH_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def parse_hour(text: Column) -> Column:
    """First time of day in a text, minutes after ``:``, ``.`` or ``h``; else the first bare ``21 h``; null if out of range."""
    hour, minute = (F.regexp_extract(text, r"([0-9]+)[:.hH]([0-9]+)", i) for i in (1, 2))
    bare = F.regexp_extract(text, r"([0-9]+) ?[hH]", 1)

    def shown(h: Column, m: Column) -> Column:
        ok = (F.length(h) <= 2) & (F.length(m) == 2) & (F.try_to_number(h, F.lit("99")) < 24) & (F.try_to_number(m, F.lit("99")) < 60)
        return F.when(ok, F.concat(F.lpad(h, 2, "0"), F.lit(":"), m))

    return F.when(hour != "", shown(hour, minute)).when(bare != "", shown(bare, F.lit("00")))


def minutes(hour: Column) -> Column:
    return F.when(hour.rlike("^[0-9]{2}:[0-9]{2}$"), F.left(hour, F.lit(2)).cast("int") * 60 + F.right(hour, F.lit(2)).cast("int"))


def infer_year(day: Column, month: Column, today: Column, back: int = 45) -> Column:
    """The date of a day and month without a year: this year's unless over ``back`` days past, else next year's."""

    def of(year: Column) -> Column:
        return F.try_to_timestamp(F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")), F.lit("yyyy-MM-dd")).cast("date")

    now, after = of(F.year(today)), of(F.year(today) + 1)
    return F.when(now >= F.date_sub(today, back), now).otherwise(after)


def _month_numbers() -> dict[str, int]:
    """Names and usual short forms of the months in both languages, by their numbers."""
    out = {name: i for i, name in enumerate(MONTHS, 1)} | {"setiembre": 9, "sept": 9, "set": 9}
    for names in (MONTHS, ENGLISH_MONTHS):
        out |= {name[:3]: i for i, name in enumerate(names, 1) if name[:3] not in out}
    return out | {name: i for i, name in enumerate(ENGLISH_MONTHS, 1)}


def parse_date(text: Column, today: Column, year: Column | None = None) -> Column:
    """The date that a text names, by the first notation that it has; null if none, or if there is no such day.

    In this order: ``2026-10-17``; ``17/10/2026``, ``17.10.26``, ``17-10-2026``; ``[sábado] 17 [de] octubre [[de] 2026]`` with short and
    English names, where what is no month is passed over; ``October 17[, 2026]``. Without a year it is ``year``, else the
    one nearest to ``today`` that isn't over 45 days past.
    """
    numbers = F.create_map(*[F.lit(x) for pair in _month_numbers().items() for x in pair])
    key = norm_key(text)

    def valid(y: Column, m: Column, d: Column) -> Column:
        return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")

    def spoken(d: Column, m: Column, y: Column) -> Column:
        """Of a day, a month's number and a year that may be empty."""
        day, month = d.cast("int"), m.cast("string")
        there = valid(year.cast("string"), month, d) if year is not None else infer_year(day, m, today)
        return F.when(y != "", valid(y, month, d)).otherwise(there)

    iy, im, id_ = (F.regexp_extract(text, r"((?:19|20)\d\d)-(\d{1,2})-(\d{1,2})", i) for i in (1, 2, 3))
    d, m, y = (F.regexp_extract(text, r"\b(\d{1,2})[/.-](\d{1,2})[/.-]((?:19|20)\d\d|\d\d)\b", i) for i in (1, 2, 3))
    day_first = r"\b(\d{1,2})\s+(?:de\s+)?([a-z]+)(?:\s+(?:de\s+)?((?:19|20)\d\d))?\b"
    named = F.transform(F.regexp_extract_all(key, F.lit(day_first), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, day_first, 1).alias("d"), F.element_at(numbers, F.regexp_extract(x, day_first, 2)).alias("m"), F.regexp_extract(x, day_first, 3).alias("y")))
    first = F.get(F.filter(named, lambda x: x["m"].isNotNull()), F.lit(0))
    month_first = r"\b([a-z]+)\s+(\d{1,2})(?:\s+((?:19|20)\d\d))?\b"
    em, ed, ey = F.element_at(numbers, F.regexp_extract(key, month_first, 1)), F.regexp_extract(key, month_first, 2), F.regexp_extract(key, month_first, 3)
    return (
        F.when(iy != "", valid(iy, im, id_)).when(d != "", valid(F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y), m, d))
        .when(first.isNotNull(), spoken(first["d"], first["m"], first["y"])).when(em.isNotNull(), spoken(F.nullif(ed, F.lit("")), em, ey))
    )


def months_between(start: Column, end: Column) -> Column:
    """The first days of the months that a window touches: one listing page each."""
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))


def weeks_between(start: Column, end: Column) -> Column:
    """The Mondays of the weeks that a window touches."""
    return F.sequence(F.trunc(start, "week"), F.trunc(end, "week"), F.expr("INTERVAL 7 DAYS"))


def iso_hour(stamp: Column) -> Column:
    """The time of day of an ISO stamp; midnight means that none was given."""
    return F.nullif(F.nullif(F.regexp_extract(stamp, r"T(\d{2}:\d{2})", 1), F.lit("")), F.lit("00:00"))


def day_named(text: Column, day: Column) -> Column:
    """Whether a text names a date: ISO, ``d/m/y`` or ``d de month``, with and without leading zeros."""
    d, m, y = F.dayofmonth(day).cast("string"), F.month(day).cast("string"), F.year(day).cast("string")
    name = F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day))
    padded = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), "[^a-z0-9/-]+", " "), F.lit(" "))
    said = [day.cast("string"), F.concat_ws("/", d, m, y), F.concat_ws("/", F.lpad(d, 2, "0"), F.lpad(m, 2, "0"), y), F.concat_ws(" ", d, F.lit("de"), name)]
    out = F.lit(False)
    for x in said:
        out |= F.contains(padded, F.concat(F.lit(" "), x, F.lit(" ")))
    return out


def hour_named(text: Column, hour: Column) -> Column:
    """Whether a text has the time ``HH:MM`` with ``:``, ``.`` or ``h`` between, and no digit around."""
    h, m = F.left(hour, F.lit(2)).cast("int").cast("string"), F.right(hour, F.lit(2))
    plain = F.concat(F.lit("x"), F.regexp_replace(F.regexp_replace(F.lower(text), r"([0-9])[.h]([0-9])", "$1:$2"), r"(^|[^0-9])0([0-9]:)", "$1$2"), F.lit("x"))
    return F.rlike(plain, F.concat(F.lit("[^0-9]"), h, F.lit(":"), m, F.lit("[^0-9]")))


def recurrences(start: Column, end: Column, weekdays: Column, most: int = 8) -> Column:
    """The first ``most`` days between two dates on the given ISO weekdays (1: Monday)."""
    days = F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))
    return F.slice(F.filter(days, lambda d: F.array_contains(weekdays, F.weekday(d) + 1)), 1, most)


def nearest_weekday(today: Column, day: Column, iso_weekday: Column, back: int = 60, ahead: int = 120) -> Column:
    """The nearest date with this day of month and weekday, for listings without a month."""
    days = F.filter(F.sequence(F.date_sub(today, back), F.date_add(today, ahead)), lambda d: (F.dayofmonth(d) == day) & (F.weekday(d) + 1 == iso_weekday))
    return F.array_min(F.transform(days, lambda d: F.struct(F.abs(F.datediff(d, today)).alias("far"), d.alias("day"))))["day"]
