"""Dates and titles in the flat sequence of a page's texts, for pages without structured data.

A page is cut at its tags. One fold over the texts pairs each one that has a date with a title: what stands before the date in the
same text, else the nearest title of the four texts before (or after) it that no other date has taken, up to the next date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.propernames import let
from ..functions.text import clean

#: Elements whose texts are no content, and how far a title may be from its date and an hour after it (fixed values).
IGNORED = ("script", "style", "noscript", "nav", "footer", "header")
REACH, HOURS = 4, 3
_FOUND = "array<struct<pos:int,day:date,title:string,hour:string>>"
_STATE = f"struct<used:array<int>,found:{_FOUND}>"


def date_pattern() -> str:
    months = "|".join(sorted(dates._month_numbers(), key=lambda m: (-len(m), m)))
    return rf"(?i)\b(?:(?:19|20)\d\d-\d{{1,2}}-\d{{1,2}}|\d{{1,2}}[/.-]\d{{1,2}}[/.-](?:(?:19|20)\d\d|\d\d)|\d{{1,2}}\s+(?:de\s+)?(?:{months})\b\.?(?:\s+(?:de\s+)?(?:19|20)\d\d)?|(?:{months})\.?\s+\d{{1,2}}\b(?:,?\s+(?:19|20)\d\d)?)"


def texts(html: Column) -> Column:
    """The texts between a page's tags, in order, cleaned; empty ones and those of ignored elements are left out."""
    plain = F.regexp_replace(html, rf"(?is)<({'|'.join(IGNORED)})\b[^>]*>.*?</\1\s*>", " ")
    plain = F.regexp_replace(plain, "<[^>]*>", "\n")
    for entity, sign in (("&nbsp;", " "), ("&quot;", "\""), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(sign))
    return F.filter(F.transform(F.split(plain, "\n"), lambda t: clean(t)), lambda t: t != "")


def is_title(text: Column, stop: str) -> Column:
    """2 to 160 characters with a letter, neither an hour nor what ``stop`` (a pattern for the whole text) takes out."""
    size = F.length(text)
    return (size >= 2) & (size <= 160) & text.rlike(r"\p{L}") & ~text.rlike(rf"(?i)^(?:{stop})$") & ~text.rlike(r"^\d{1,2}[:.]\d{2}\s*h?\.?$")


def dated_titles(pages: DataFrame, key: str, html: str, today: Column, stop: str = "entradas|comprar|más info|leer más", before: bool = True) -> DataFrame:
    """(``key``, pos, day, title, hour): a row for each text with a date that has a title; ``pos`` numbers the texts.

    The hour is that after the date, else the first of the three texts that follow. ``before``: whether titles stand before
    their dates. Null and empty pages give no rows.
    """
    pattern = date_pattern()

    def described(t: Column) -> Column:
        parts = F.split(t, pattern, 2)
        front = F.regexp_replace(clean(F.get(parts, F.lit(0))), r"^[\s\-–·|:]+|[\s\-–·|:]+$", "")
        day = F.when(t.rlike(pattern), dates.parse_date(F.regexp_extract(t, pattern, 0), today))
        return F.struct(day.alias("day"), F.when(day.isNotNull() & is_title(front, stop), front).alias("front"), F.when(is_title(t, stop), t).alias("title"), F.when(day.isNotNull(), dates.parse_hour(F.coalesce(F.get(parts, F.lit(1)), F.lit("")))).alias("own"), F.when(day.isNull(), dates.parse_hour(t)).alias("hour"))

    def scan(ts: Column) -> Column:
        offsets = F.array(*[F.lit(-n if before else n) for n in range(1, REACH + 1)])

        def one(state: Column, i: Column) -> Column:
            t = F.get(ts, i)
            near = F.transform(offsets, lambda o: F.struct((i + o).alias("j"), F.get(ts, i + o)["day"].isNotNull().alias("dated"), F.array_contains(state["used"], i + o).alias("used"), F.get(ts, i + o)["title"].alias("title")))
            # The texts up to the first that is dated or taken; the first title of these.
            stop_at = F.coalesce(F.array_position(F.transform(near, lambda n: n["dated"] | n["used"]), F.lit(True)), F.lit(0))
            reachable = F.when(stop_at > 0, F.slice(near, F.lit(1), (stop_at - 1).cast("int"))).otherwise(near)
            taken = F.get(F.filter(reachable, lambda n: n["title"].isNotNull() & (n["j"] >= 0)), F.lit(0))
            title = F.coalesce(t["front"], taken["title"])
            following = F.get(F.filter(F.transform(F.sequence(F.lit(1), F.lit(HOURS)), lambda k: F.get(ts, i + k)["hour"]), lambda h: h.isNotNull()), F.lit(0))
            row = F.struct(i.alias("pos"), t["day"].alias("day"), title.alias("title"), F.coalesce(t["own"], following).alias("hour"))
            used = F.when(t["front"].isNull() & taken.isNotNull(), F.concat(state["used"], F.array(taken["j"]))).otherwise(state["used"])
            return F.when(t["day"].isNotNull() & title.isNotNull(), F.struct(used.alias("used"), F.concat(state["found"], F.array(row)).alias("found"))).otherwise(state).cast(_STATE)

        places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(ts) - 1, F.lit(0))), lambda i: F.get(ts, i)["day"].isNotNull())
        empty = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast(_FOUND).alias("found")).cast(_STATE)
        return F.aggregate(places, empty, one, lambda s: s["found"])

    found = let(F.transform(texts(F.col(html)), described), scan)
    return pages.where(F.col(html).isNotNull()).select(key, F.explode(found).alias("e")).select(key, "e.pos", "e.day", "e.title", "e.hour")
