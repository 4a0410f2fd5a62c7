"""Predicates and small derivations over the fields of listings, as column expressions.

Word lists are arguments (tuples or array columns): they belong to a region and a language, not to the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import minutes
from .text import let, norm_key


def words(key: Column) -> Column:
    return F.filter(F.split(key, " "), lambda w: w != "")


def _spaced(key: Column) -> Column:
    return F.concat(F.lit(" "), key, F.lit(" "))


def has_phrase(key: Column, phrases: tuple[str, ...]) -> Column:
    """A key has one of the phrases (keys themselves) as whole words."""
    return let(_spaced(key), lambda k: F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(k, _spaced(p))))


# Names and titles


def is_filler(name: Column, phrases: tuple[str, ...]) -> Column:
    """A billing entry that names no one: it starts with one of the phrases, or is empty."""
    return let(norm_key(name), lambda key: (key == "") | F.exists(F.array(*map(F.lit, phrases)), lambda p: F.startswith(_spaced(key), _spaced(p))))


def is_generic(name: Column, generic: tuple[str, ...], least: int = 3) -> Column:
    """A name that many acts could have: on the list, or shorter than ``least``."""
    key = norm_key(name)
    return key.isin(*generic) | (F.length(key) < least)


def has_broken_encoding(text: Column) -> Column:
    """Signs that UTF-8 leaves where it was read as a one-byte encoding."""
    return text.rlike("[ÃÂ][\u0080-¿Œ-Ÿ]|�")


def head(name: Column, turns: tuple[str, ...]) -> Column:
    """The name before the first word that opens a tour or a programme (``presenta``, ``gira``)."""
    key = norm_key(name)
    cut = F.trim(F.regexp_extract(_spaced(key), f"^(.*?) (?:{'|'.join(turns)}) ", 1))
    return F.when(cut != "", cut).otherwise(key)


def variants(name: Column, turns: tuple[str, ...]) -> Column:
    """The forms in which a name may be met: its key, its head, without ``the`` or ``los``, and joined."""
    key = norm_key(name)
    forms = F.array(key, head(name, turns), F.regexp_replace(key, "^(the|los|las|el|la) ", ""), F.replace(key, F.lit(" "), F.lit("")))
    return F.array_sort(F.array_distinct(F.filter(forms, lambda x: x != "")))


def without_cycle(title: Column) -> tuple[Column, Column]:
    """(cycle, rest) of ``Cycle. Artist`` or ``Cycle: Artist``; null cycle where there is no such form."""
    cycle = F.trim(F.regexp_extract(title, r"^([^.:]{4,}?)[.:] +[^ ]", 1))
    return F.nullif(cycle, F.lit("")), F.when(cycle != "", F.trim(F.regexp_replace(title, r"^[^.:]{4,}?[.:] +", ""))).otherwise(title)


def performer(title: Column) -> Column:
    """The performer in the title of a show: what follows the last `` - ``."""
    return F.trim(F.element_at(F.split(title, " - "), -1))


def card_keys(title: Column, turns: tuple[str, ...]) -> Column:
    """The ordered keys under which a card may be kept: whole, rest of a cycle, performer, head; each once."""
    tries = [norm_key(title), norm_key(without_cycle(title)[1]), norm_key(performer(title)), head(title, turns)]
    return F.array_distinct(F.filter(F.array(*tries), lambda x: x != ""))


def significant(name: Column, common: tuple[str, ...]) -> Column:
    """Distinct words of three letters or more that are neither numbers nor on the list."""
    return F.array_distinct(F.filter(words(norm_key(name)), lambda w: (F.length(w) >= 3) & ~w.isin(*common) & ~w.rlike("^[0-9]+$")))


def album_title(title: Column) -> Column:
    """The key of an album without what stands in brackets and without an edition."""
    return norm_key(F.regexp_replace(F.regexp_replace(title, r"[\[(][^\])]*[\])]", " "), r"(?i) - .*(edition|remaster|version).*$", ""))


def worth_asking(name: Column, least: int = 3, most: int = 60) -> Column:
    """A lookup by this name can succeed: not too short, not too long, with a letter."""
    key = norm_key(name)
    return (F.length(key) >= least) & (F.length(key) <= most) & key.rlike("[a-z]")


def style_parts(style: Column) -> Column:
    """The parts of a style text: split at commas, slashes, semicolons, pipes, middle dots and spaced hyphens."""
    return F.filter(F.transform(F.split(style, r"[,/;|·]| - "), lambda x: F.trim(x)), lambda x: x != "")


def mentions(text: Column, name: Column) -> Column:
    """The text has the name as whole words, accents and signs aside."""
    key = norm_key(name)
    return (key != "") & F.contains(_spaced(norm_key(text)), _spaced(key))


def around(text: Column, phrase: str, reach: int = 600) -> Column:
    """The stretches of up to ``reach`` characters on both sides of each mention (a Java pattern's literal), without overlap."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{0,{reach}}}\\Q{phrase}\\E.{{0,{reach}}}"), 0)


# Places


def venue_key(name: Column, kinds: tuple[str, ...]) -> Column:
    """The key of a venue without a kind (``sala``, ``club``) in front."""
    return F.regexp_replace(norm_key(name), f"^(?:{'|'.join(kinds)}) ", "")


def venue_words(name: Column, kinds: tuple[str, ...]) -> Column:
    """The key of a venue without the words of kinds anywhere."""
    return F.array_join(F.filter(words(norm_key(name)), lambda w: ~w.isin(*kinds)), " ")


def place_candidates(text: Column) -> Column:
    """The keys to look a place up by: the whole text, then its parts at commas, slashes, hyphens and parentheses."""
    parts = F.transform(F.split(text, r"[,/()]| - "), lambda x: norm_key(x))
    return F.array_distinct(F.filter(F.concat(F.array(norm_key(text)), parts), lambda x: x != ""))


# Hours, prices, states


def far_apart(hour: Column, other: Column, most: int = 120) -> Column:
    """Both hours are known and more than ``most`` minutes apart."""
    return F.coalesce(F.abs(minutes(hour) - minutes(other)) > most, F.lit(False))


def amount(value: Column, most: float = 2000) -> Column:
    """The number of a text or value, above 0 and below ``most``; null otherwise."""
    number = F.replace(F.regexp_extract(value.cast("string"), r"([0-9]+(?:[.,][0-9]+)?)", 1), F.lit(","), F.lit(".")).try_cast("double")
    return F.when((number > 0) & (number < most), number)


def euros(number: Column) -> Column:
    """``12,5 €``: at most two decimals, none where they are 0."""
    plain = F.regexp_replace(F.regexp_replace(F.format_string("%.2f", number), "0+$", ""), r"\.$", "")
    return F.concat(F.replace(plain, F.lit("."), F.lit(",")), F.lit(" €"))


def offer_price(prices: Column) -> Column:
    """``10 €`` or ``10-15 €`` of the amounts of all offers; ``0 €`` counts as free; null for none."""
    low, high = F.array_min(prices), F.array_max(prices)
    one = F.when(low == 0, F.lit("free")).otherwise(euros(low))
    return F.when(F.size(prices) > 0, F.when(low == high, one).otherwise(F.concat(F.regexp_replace(euros(low), " €$", ""), F.lit("-"), euros(high))))


def event_state(status: Column, availability: Column) -> tuple[Column, Column]:
    """(cancelled or postponed, sold out) of a status and the availabilities of all offers."""
    state = F.when(status.rlike("Cancel"), "cancelled").when(status.rlike("Postpon|Resched"), "postponed")
    return state, (F.size(availability) > 0) & F.forall(availability, lambda a: F.coalesce(a.rlike("SoldOut"), F.lit(False)))


def clear_price(text: Column, most: int = 4) -> Column:
    """The range of the amounts before a euro sign where there are at most ``most``; null otherwise."""
    found = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"([0-9]+(?:[.,][0-9]{1,2})?) ?€"), 1), lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double"))))
    return F.when(F.size(found) <= most, offer_price(found))


def price_named(text: Column, number: Column) -> Column:
    """The amount stands before a euro sign in the text."""
    found = F.regexp_extract_all(text, F.lit(r"([0-9]+(?:[.,][0-9]{1,2})?) ?€"), 1)
    return F.exists(found, lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double") == number)


def listeners_label(n: Column) -> Column:
    return F.when(n >= 1_000_000, "1M+").when(n >= 100_000, "100k+").when(n >= 10_000, "10k+").when(n >= 0, "<10k")


def listeners_text(n: Column) -> Column:
    """``1,2 M``, ``340 k`` or the number itself."""
    millions = F.concat(F.replace(F.format_string("%.1f", F.floor(n / 100_000) / 10), F.lit("."), F.lit(",")), F.lit(" M"))
    return F.when(n >= 1_000_000, millions).when(n >= 10_000, F.concat(F.floor(n / 1000).cast("string"), F.lit(" k"))).otherwise(n.cast("string"))


def has_gap(hour: Column, price: Column, ticket: Column) -> Column:
    return hour.isNull() | price.isNull() | ticket.isNull()


# Addresses and ids


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def is_specific(url: Column) -> Column:
    """The address is of a page below the root."""
    return ~url_path(url).isin("", "/")


def slug_words(url: Column) -> Column:
    """The words of an address's last path segment."""
    last = F.regexp_extract(F.regexp_replace(url_path(url), "/+$", ""), "([^/]*)$", 1)
    return words(norm_key(F.regexp_replace(last, r"\.[a-z]{2,5}$", "")))


def mentions_artist(url: Column, name: Column) -> Column:
    """A word of the slug equals or contains a word of the name (of three letters or more)."""
    own = F.filter(words(norm_key(name)), lambda w: F.length(w) >= 3)
    return F.exists(slug_words(url), lambda s: F.exists(own, lambda w: F.contains(s, w)))


def of_another_event(url: Column, name: Column) -> Column:
    """The slug has two words or more, and none of the artist's."""
    return (F.size(slug_words(url)) >= 2) & ~mentions_artist(url, name)


def event_id(day: Column, venue: Column, artist: Column, size: int = 12) -> Column:
    """A stable id: the first hex digits of a digest of day, venue and artist, as keys."""
    return F.left(F.sha1(F.concat_ws("|", day.cast("string"), norm_key(venue), norm_key(artist))), F.lit(size))


def file_name(url: Column, size: int = 16) -> Column:
    return F.left(F.sha1(url), F.lit(size))


def thumbnail_url(base: str, file: Column, width: int) -> Column:
    """The address of a scaled picture in a store that is laid out by the MD5 of the file name."""
    name = F.replace(file, F.lit(" "), F.lit("_"))
    digest = F.md5(name)
    return F.concat(F.lit(base), F.left(digest, F.lit(1)), F.lit("/"), F.left(digest, F.lit(2)), F.lit("/"), name, F.lit(f"/{width}px-"), name)


def same_picture(a: Column, b: Column, most: int = 20) -> Column:
    """Two 64-bit picture hashes differ in at most ``most`` bits; null if one is unknown."""
    return F.bit_count(a.bitwiseXOR(b)) <= most


# Countries


def estimated_country(name: Column, own: tuple[str, ...], foreign: tuple[str, ...], code: str) -> Column:
    """``code`` if a name has letters or words of the own language and no more words of the foreign one."""
    key = words(norm_key(name))
    n_own, n_foreign = F.size(F.array_intersect(key, F.array(*map(F.lit, own)))), F.size(F.array_intersect(key, F.array(*map(F.lit, foreign))))
    return F.when((F.lower(name).rlike("[ñáéíóú]") | (n_own > 0)) & (n_foreign <= n_own), F.lit(code))


def country_of_text(text: Column, countries: dict[str, str], regions: dict[str, str]) -> Column:
    """The code of the last comma part that is a country, else of the last that is a region; keys are join keys."""
    parts = F.reverse(F.transform(F.split(text, ","), lambda x: norm_key(x)))

    def first(table: dict[str, str]) -> Column:
        known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        return F.get(F.filter(F.transform(parts, lambda p: F.try_element_at(known, p)), lambda x: x.isNotNull()), F.lit(0))

    return F.coalesce(first(countries), first(regions))


def countries_of_sentence(sentence: Column, demonyms: dict[str, str]) -> Column:
    """The sorted distinct codes of the demonyms and country names (keys, one word each) in a sentence."""
    known = F.create_map(*[F.lit(x) for pair in demonyms.items() for x in pair])
    return F.array_sort(F.array_distinct(F.filter(F.transform(words(norm_key(sentence)), lambda w: F.try_element_at(known, w)), lambda c: c.isNotNull())))


def country_in_text(text: Column, name: Column, demonyms: dict[str, str]) -> Column:
    """The code if the sentences that mention the name attribute exactly one country."""
    sentences = F.filter(F.split(text, r"[.!?\n]+"), lambda s: mentions(s, name))
    codes = F.array_distinct(F.flatten(F.transform(sentences, lambda s: countries_of_sentence(s, demonyms))))
    return F.when(F.size(codes) == 1, F.get(codes, F.lit(0)))


def styles_in_text(text: Column, styles: tuple[str, ...], most: int = 5) -> Column:
    """The styles (keys, the longest first) that a text names as whole words; parts of a longer one found do not count."""
    ordered = F.array(*map(F.lit, sorted(styles, key=lambda s: (-len(s), s))))

    def own(found: Column) -> Column:
        return F.filter(found, lambda s, i: ~F.exists(F.slice(found, 1, F.greatest(i, F.lit(0))), lambda longer: F.contains(_spaced(longer), _spaced(s))))

    # The key of the text and what is found in it are worked out once, not for each style.
    found = let(_spaced(norm_key(text)), lambda key: F.filter(ordered, lambda s: F.contains(key, _spaced(s))))
    return F.slice(let(found, own), 1, most)
