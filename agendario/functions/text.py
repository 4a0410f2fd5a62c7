"""Text functions of the consolidation engine, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folds() -> tuple[str, str]:
    """Letters that decompose to one ASCII letter, by the Unicode data, and that letter."""
    pairs = [(c, unicodedata.normalize("NFKD", c)) for c in map(chr, range(0xA0, 0x250))]
    one = [(c, "".join(x for x in d if not unicodedata.combining(x))) for c, d in pairs]
    kept = [(c, d) for c, d in one if len(d) == 1 and d.isascii() and d.isalnum()]
    return "".join(c for c, _ in kept), "".join(d for _, d in kept)


ACCENTED, PLAIN = _folds()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` where ``value`` is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_accents(text: Column) -> Column:
    """Accented letters as plain ones; most texts have none, and only those with one are translated."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, ACCENTED, PLAIN)).otherwise(text)


def norm_key(text: Column) -> Column:
    """The join key of names: no accents, lower case, ``&`` as "and", no apostrophes, other signs as one space."""
    plain = F.lower(fold_accents(text))
    plain = F.translate(F.replace(plain, F.lit("&"), F.lit(" and ")), "'’`´", "")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def clean(text: Column) -> Column:
    """White space runs (no-break spaces too) to one space; separators at the ends go."""
    return F.regexp_replace(F.regexp_replace(text, r"[\s ]+", " "), r"^[ .·|,;–-]+|[ .·|,;–-]+$", "")


def tokens(key: Column) -> Column:
    return F.array_distinct(F.filter(F.split(key, " "), lambda w: w != ""))


def contains_words(short: Column, long: Column, least: int = 4) -> Column:
    """Word-aligned containment of one key in another."""
    return (F.length(short) >= least) & F.contains(F.concat(F.lit(" "), long, F.lit(" ")), F.concat(F.lit(" "), short, F.lit(" ")))


def search(text: Column, words: Column) -> Column:
    """Accent-insensitive search: every word occurs; no word matches all."""
    return F.forall(tokens(norm_key(words)), lambda w: F.contains(norm_key(text), w))


def billing(text: Column) -> tuple[Column, Column]:
    """Headliner and guests of ``A + B + C``."""
    parts = F.filter(F.transform(F.split(text, r"\+"), lambda x: F.trim(x)), lambda x: x != "")
    return F.get(parts, F.lit(0)), F.slice(parts, 2, 1 << 20)


def country_suffix(text: Column) -> tuple[Column, Column]:
    """Name and two-letter code of ``Name (XX)``; the code is null where there is none."""
    code = F.nullif(F.regexp_extract(text, r"\(([A-Z]{2})\)\s*$", 1), F.lit(""))
    return F.trim(F.regexp_replace(text, r"\s*\([A-Z]{2}\)\s*$", "")), code


def url_domain(url: Column) -> Column:
    """Host of a URL in lower case without ``www.``; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")


def url_clean(url: Column, tracking: str = "utm_[a-z]+|fbclid|gclid|ref") -> Column:
    """The URL without its fragment and tracking parameters."""
    bare = F.substring_index(url, "#", 1)
    base, query = F.substring_index(bare, "?", 1), F.when(F.contains(bare, F.lit("?")), F.regexp_replace(bare, r"^[^?]*\?", "")).otherwise("")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({tracking})="))
    return F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)


def domain_suffixes(host: Column) -> Column:
    """``a.b.c`` to [a.b.c, b.c, c], for longest-suffix lookups."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, 1 << 10), "."))


def prices(text: Column) -> Column:
    """The sorted distinct amounts of a price text (``10 - 12,5 €``)."""
    found = F.regexp_extract_all(text, F.lit(r"([0-9]+(?:[.,][0-9]{1,2})?)"), 1)
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double"))))


def price_min(text: Column) -> Column:
    """The least amount of a price text; 0 where it says free; null otherwise."""
    free = F.lower(text).rlike(r"gratis|gratuit|libre|free")
    return F.when(free, F.lit(0.0)).otherwise(F.get(prices(text), F.lit(0)))


def slug(text: Column, most: int = 60) -> Column:
    return F.left(F.replace(norm_key(text), F.lit(" "), F.lit("-")), F.lit(most))
