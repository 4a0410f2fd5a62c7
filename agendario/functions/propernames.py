"""Proper names in running text: a name that stands there whole, and what is said right beside it.

A token automaton walks away from each place where a name's words stand: through linking words and quotation marks to the first
token that counts. If that is capitalised, the name found is a part of another one. The automaton is a fold over the token
array, so it runs in the JVM; word lists are arguments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, norm_key

#: Words that link the parts of a name (fixed values of the languages), and quotation marks.
LINKS = ("de", "del", "la", "las", "el", "los", "y", "e", "of", "the", "and", "van", "von", "da", "do", "dos", "di", "le", "les", "du")
QUOTES = "“”\"«»‘’'"

_TOKEN = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*|&|[^\s\p{L}\p{N}_]"


def sentences(text: Column, least: int = 11) -> Column:
    """The sentences of a text: cut after ``.``, ``!``, ``?`` and at line ends; shorter ones than ``least`` are left out."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda s: F.trim(s)), lambda s: F.length(s) >= least)


def tokens(text: Column, links: tuple[str, ...] = LINKS) -> Column:
    """Words, ``&`` and signs, in order: (key, capital, link). A sign has no key; a number counts as capitalised."""
    found = F.regexp_extract_all(F.replace(text, F.lit("&amp;"), F.lit("&")), F.lit(_TOKEN), F.lit(0))

    def described(t: Column) -> Column:
        first = F.left(t, F.lit(1))
        word = first.rlike(r"[\p{L}\p{N}]")
        key = F.when(t == "&", "and").when(word, norm_key(t))
        capital = first.rlike(r"[\p{Lu}\p{N}]")
        return F.struct(key.alias("key"), capital.alias("capital"), ((F.coalesce(key.isin(*links), F.lit(False)) & ~capital) | F.contains(F.lit(QUOTES), t)).alias("link"))

    return F.transform(found, described)


def _walk(side: Column) -> Column:
    """Where the walk over a side's tokens, the nearest first, ends: "name", "other", or "open" and "linked" at the text's end."""

    def step(state: Column, t: Column) -> Column:
        stopped = F.when(t["link"], "linked").when(t["key"].isNotNull() & (t["key"] != "") & t["capital"], "name").otherwise("other")
        return F.when(state.isin("open", "linked"), stopped).otherwise(state)

    return F.aggregate(side, F.lit("open"), step)


def named_whole(text: Column, name: Column, links: tuple[str, ...] = LINKS) -> Column:
    """Whether a text has a name as a whole proper name, capitalised and not as a part of a longer one.

    A text that starts in lower case inside a name (``de la X)``) doesn't have it there. A name without letters is nowhere; null text or name: null.
    """
    parts = F.filter(F.split(norm_key(name), " "), lambda w: w != "")

    def search(ts: Column, ws: Column) -> Column:
        n, k = F.size(ts), F.size(ws)
        keys = F.transform(ts, lambda t: F.coalesce(t["key"], F.lit("")))
        places = F.when((k > 0) & (n >= k), F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
        begun = F.left(text, F.lit(1)).rlike(r"\p{Ll}")

        def free(i: Column) -> Column:
            before, after = _walk(F.reverse(F.slice(ts, F.lit(1), i))), _walk(F.slice(ts, i + k + 1, n))
            return (before != "name") & ~((before == "linked") & begun) & (after != "name")

        return let(keys, lambda ks: F.exists(F.filter(places, lambda i: (F.get(ks, i) == F.get(ws, F.lit(0))) & F.get(ts, i)["capital"] & (F.slice(ks, i + 1, k) == ws)), free))

    return F.when(text.isNotNull() & name.isNotNull(), let(tokens(text, links), lambda ts: let(parts, lambda ws: search(ts, ws))))


def _any(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + ")"


#: Verbs and articles between a name and what is said of it (fixed values of the language).
_IS, _ARTICLE = "(?:es|son|fue|era|eran)", "(?:un|una|unos|el|la|los|las)"
_FROM = "(?:nace en|nacid[oa]s? en|nacio en|procedentes? de|originari[oa]s? de|natural(?:es)? de|surgid[oa]s? en|formad[oa]s? en|fundad[oa]s? en)"


def said_beside(sentence: Column, name: Column, who: tuple[str, ...], wanted: tuple[str, ...]) -> Column:
    """The words of ``wanted`` (keys) that a sentence says of a name right beside it: "X es un grupo de rock W", "la banda W X".

    ``who`` are keys of what a name can be (group, singer). Only whole names count, and only what is joined to them.
    """
    one, of = _any(who), _any(wanted)
    key = norm_key(name)
    text = norm_key(sentence)
    after = F.concat(F.lit("(?<![a-z0-9])"), key, F.lit(rf"(?![a-z0-9])\s*{_IS}?\s*{_ARTICLE}?\s*{one}\s+(?:de\s+)?(?:[a-z-]+\s+){{0,2}}?({of})\b"))
    before = F.concat(F.lit(rf"\b{one}\s+(?:y\s+[a-z]+\s+)?(?:de\s+[a-z-]+\s+)?({of})\s+(?:de\s+[a-z]+\s+)?(?:(?:mas\s+)?(?:conocid[oa]s?\s+como|alias|llamad[oa])\s+)?"), key, F.lit("(?![a-z0-9])"))
    found = F.concat(F.regexp_extract_all(text, after, F.lit(1)), F.regexp_extract_all(text, before, F.lit(1)))
    return F.when(key != "", F.array_sort(F.array_distinct(found))).otherwise(F.array().cast("array<string>"))


def birthplace_said(sentence: Column, name: Column) -> Column:
    """The key of the place that a sentence gives right after a name ("X nace en W", "X, procedentes de W"); null if none."""
    key = norm_key(name)
    # Signs that end a clause stay, so that a place of the next clause isn't taken.
    text = F.array_join(F.transform(F.split(sentence, "[.;:()\n]"), lambda s: norm_key(s)), " | ")
    pattern = F.concat(F.lit("(?<![a-z0-9])"), key, F.lit(rf"(?![a-z0-9])[^|]{{0,60}}?\b{_FROM}\s+([^|]{{2,60}})"))
    place = F.trim(F.coalesce(F.get(F.regexp_extract_all(text, pattern, F.lit(1)), F.lit(0)), F.lit("")))
    return F.when(key != "", F.nullif(F.trim(F.element_at(F.split(place, r" (?:y|en|a|con|que|para|el|la|los|las|desde) "), 1)), F.lit("")))


def only_one(values: Column) -> Column:
    """The value of an array that has one different value; null for none or several."""
    return F.when(F.size(F.array_distinct(values)) == 1, F.get(values, F.lit(0)))
