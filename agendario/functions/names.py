"""Titles and names: festivals, line-ups, honoured artists, countries, broken encodings."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import norm_key

#: Encodings that UTF-8 bytes are often taken for.
TAKEN_FOR = ("cp1252", "latin-1", "cp437", "cp850", "cp775")
_ORDINAL = r"^(\d+|[ivx]+)$"


def festival_key(title: Column, common: Column) -> Column:
    """Sorted distinct words of a festival's name, without numbers, ordinals and the words of ``common`` (an array)."""
    words = F.split(norm_key(title), " ")
    kept = F.filter(words, lambda w: ~F.array_contains(common, w) & ~w.rlike(_ORDINAL) & (w != ""))
    return F.array_join(F.array_sort(F.array_distinct(kept)), " ")


def same_festival(key: Column, other: Column, least: int = 2) -> Column:
    """Equal keys of at least ``least`` words."""
    return (key == other) & (F.size(F.split(key, " ")) >= least)


def is_festival(title: Column) -> Column:
    """The title has the word festival or fest outside parentheses."""
    return F.regexp_replace(title, r"\([^)]*\)", " ").rlike(r"(?i)(^|[^a-z])fest(ival)?([^a-z]|$)")


def line_up(title: Column, open_end: Column) -> tuple[Column, Column, Column]:
    """(festival, artists, incomplete) of ``Festival X: A, B y C``; null festival if the title has no such list.

    An entry that starts with a key of ``open_end`` (an array, such as "and more") is no artist and tells that the
    list goes on.
    """
    clear = title.rlike(r"(?i)^[^:]*\bfest(ival)?\b[^:]*:")
    parts = F.filter(F.transform(F.split(F.regexp_replace(title, r"^[^:]*:", ""), r",|\+| y "), lambda x: F.trim(x)), lambda x: x != "")
    artists = F.filter(parts, lambda x: ~F.exists(open_end, lambda m: F.startswith(F.concat(norm_key(x), F.lit(" ")), F.concat(m, F.lit(" ")))))
    none = F.array().cast("array<string>")
    return F.when(clear, F.trim(F.substring_index(title, ":", 1))), F.when(clear, artists).otherwise(none), clear & (F.size(artists) < F.size(parts))


def honoured(title: Column) -> Column:
    """Who a tribute is to; null where the title says no such thing."""
    patterns = (r"(?i)tributo (?:a|al|a la) (.+)$", r"(?i)homenaje (?:a|al) (.+)$", r"(?i)tribute to (.+)$", r"(?i)^(.+?) tribut[oe]\b", r"(?i)plays? (.+)$")
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(title, p, 1)), F.lit("")) for p in patterns])


def only_country(title: Column, codes: tuple[str, ...]) -> Column:
    """The one country code in parentheses; null if there are several or none."""
    found = F.array_distinct(F.filter(F.regexp_extract_all(title, F.lit(r"\(([A-Z]{2})\)"), 1), lambda c: c.isin(*codes)))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def _oddness(text: str) -> int:
    """How many signs stand where text has letters: symbols, controls and signs between letters."""
    return sum(unicodedata.category(c) in ("Sc", "Sk", "So", "Sm", "Cc", "Co", "Cn") or c in "\u00c3\u00c2\ufffd" for c in text if not c.isascii())


def repaired(text: str) -> str:
    """Of the text and its readings as UTF-8 that was taken for another encoding, the one with the fewest odd signs.

    The whole text is read again, not each word; it stays as it is on a tie.
    """
    readings = [text]
    for name in TAKEN_FOR if not text.isascii() else ():
        try:
            readings.append(text.encode(name).decode("utf-8"))
        except UnicodeError:
            pass
    return min(readings, key=lambda x: (_oddness(x), len(x)) if x != text else (_oddness(x), len(x) - 0.5))


@F.arrow_udf(StringType())
def repair_encoding(texts: pa.Array) -> pa.Array:
    """``repaired`` for columns: the JVM lacks some of the encodings."""
    return pa.array([None if x is None else repaired(x) for x in texts.to_pylist()], pa.string())
