"""Many phrases found in many texts, each text read once: by an Aho-Corasick automaton in each task, or by digests of windows of words.

A dictionary of at most ``MOST`` phrases is an automaton, which reads a text letter by letter and reports every phrase that ends at a
letter. A larger one is looked for by windows: the digest of every window of as many words as some phrase has meets a bitmap of all
phrases' digests, and what passes is compared with the phrases themselves, in the task where the dictionary is small enough to be sent
(``SHARED``), else in a join. The result is the same. Phrases and texts are keys (as by ``norm_key``, made in Arrow batches by
``functions/keys.py``), and phrases match whole words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import Keys, keys
from ..functions.text import norm_key
from ..sources.tables import written
from .lookup import sized

#: Phrases of an automaton: with more than these it takes more time for a letter than windows (235 ns of one core with 153,199 phrases).
MOST = 10_000
#: Phrases that are sent to all tasks, and their letters, to be compared there.
SHARED, SHARED_LETTERS = 2_000_000, 1 << 26
#: Bits of the bitmap for each phrase, and the power of two that bounds all of them (128 MB).
BITS_EACH, MOST_BITS = 32, 30

def _longest(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of hits (start, end) those that are taken from the left, the longest first, without overlap."""
    out, free = [], 0
    for start, end in sorted(hits, key=lambda h: (h[0], -h[1])):
        if start >= free:
            out.append((start, end))
            free = end
    return out


def _by_automaton(rows: DataFrame, key: str, text: str, phrases: list[str], longest: bool) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for p in phrases:
            automaton.add_word(f"{p} ", len(p))
        automaton.make_automaton()
        for batch in batches:
            for row, found in keys(batch.column(1)):
                docs, places, said = [], [], []
                for doc, text in enumerate(found.whole().to_pylist(), row):
                    line = f"{text} "
                    hits = [(end - n, end) for end, n in automaton.iter(line) if end == n or line[end - n - 1] == " "]
                    for a, b in _longest(hits) if longest else hits:
                        docs.append(doc)
                        places.append(a)
                        said.append(line[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs, pa.int64())), pa.array(said, pa.string()), pa.array(places, pa.int64())], [key, "phrase", "at"])

    return rows.select(key, text).mapInArrow(work, _hits_of(rows, key))


def _hits_of(rows: DataFrame, key: str) -> str:
    return f"`{key}` {rows.schema[key].dataType.simpleString()}, phrase string, at long"


def _known(dictionary: DataFrame, phrase: str) -> DataFrame:
    """(phrase, size, digest): the different phrases, as keys, with their number of words and digest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in keys(batch.column(0)):
                first, last = (x[np.diff(found.doc_at) > 0] for x in (found.doc_at[:-1], found.doc_at[1:] - 1))
                yield pa.RecordBatch.from_arrays([found.cut(first, last), pa.array(last - first + 1, pa.int32()), pa.array(found.digests(first, last).view(np.int64))], ["phrase", "size", "digest"])

    return dictionary.select(phrase).mapInArrow(work, "phrase string, size int, digest long").distinct()


class _Shared:
    """All phrases of a dictionary, in order of their digests."""

    def __init__(self, known: pa.Table):
        digests = known["digest"].to_numpy().view(np.uint64)
        order = np.argsort(digests)
        self.digests, self.phrases = digests[order], known["phrase"].combine_chunks().take(pa.array(order)).cast(pa.string())
        # So many phrases have the same digest at most.
        self.alike = int(np.unique(digests, return_counts=True)[1].max())

    def which(self, digests: np.ndarray, said: pa.Array) -> np.ndarray:
        """The phrase that each text is, by its number; -1 for none."""
        at, out = np.searchsorted(self.digests, digests), np.full(len(digests), -1)
        for k in range(self.alike):
            tried = np.minimum(at + k, len(self.digests) - 1)
            out = np.where(pc.equal(self.phrases.take(pa.array(tried)), said).to_numpy(zero_copy_only=False), tried, out)
        return out


def _spots(digests: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return digests & np.uint64(bits - 1), digests >> np.uint64(32) & np.uint64(bits - 1)


def _bits(n: int) -> int:
    return 1 << min(MOST_BITS, max(20, (BITS_EACH * n).bit_length()))


def _bitmap(digests: np.ndarray, bits: int) -> np.ndarray:
    has = np.zeros(bits, bool)
    for spot in _spots(digests, bits):
        has[spot.astype(np.int64)] = True
    return np.packbits(has, bitorder="little")


def _bitmap_of(known: DataFrame, bits: int) -> np.ndarray:
    """The same bitmap of phrases that are too many for the driver, which gets its pieces."""
    spots = known.select(F.explode(F.array(F.col("digest").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("digest", 32).bitwiseAND(F.lit(bits - 1)))).alias("spot"))
    # Spark's bitmaps count from 1 in buckets of 32,768.
    pieces = spots.groupBy(F.bitmap_bucket_number(F.col("spot") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("spot") + 1)).alias("bitmap"))
    table = bytearray(bits // 8)
    for r in pieces.toLocalIterator():
        table[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = r["bitmap"]
    return np.frombuffer(bytes(table), np.uint8)


def _passed(found: Keys, sizes: list[int], bitmap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first word, last word, text, digest) of the windows whose digest the bitmap has."""
    for n in sizes:
        for a, digests in found.windows(n):
            one, two = _spots(digests, 8 * len(bitmap))
            hits = np.flatnonzero(bitmap[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8) & 1)
            hits = hits[bitmap[two[hits] >> np.uint64(3)] >> (two[hits] & np.uint64(7)).astype(np.uint8) & 1 == 1]
            first, doc = found.within(hits + a, n)
            yield first, first + n - 1, doc, digests[first - a]


def _by_windows(rows: DataFrame, key: str, text: str, known: DataFrame, longest: bool) -> DataFrame:
    """Every place of any number of phrases: windows of words whose digest a bitmap has are compared with the phrases.

    The bitmap has two bits for each phrase among ``BITS_EACH`` or more (``MOST_BITS`` at most), so that few windows are compared that are no
    phrase. ``longest`` holds only where phrases are sent to the tasks; the caller chooses where they are joined.
    """
    context = rows.sparkSession.sparkContext
    count, letters, sizes = known.agg(F.count("*"), F.sum(F.length("phrase")), F.sort_array(F.collect_set("size"))).first()
    here = count <= SHARED and letters <= SHARED_LETTERS
    if here:
        told = _Shared(known.select("phrase", "digest").toArrow())
        shared = context.broadcast((told, _bitmap(told.digests, _bits(count))))
    else:
        shared = context.broadcast((None, _bitmap_of(known, _bits(count))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, bitmap = shared.value
        for batch in batches:
            for row, found in keys(batch.column(1)):
                parts = list(_passed(found, sizes, bitmap))
                if not parts:
                    continue
                first, last, doc, digests = map(np.concatenate, zip(*parts))
                said = found.cut(first, last)
                if told:
                    which = told.which(digests, said)
                    kept = np.flatnonzero(which >= 0)
                    if longest:
                        # Texts stand one after the other, so that places of all of them are in order.
                        spans = {(int(found.start[first[i]]), int(found.end[last[i]])): i for i in kept}
                        kept = np.array([spans[s] for s in _longest(list(spans))], np.int64)
                    first, doc, said = first[kept], doc[kept], said.take(pa.array(kept))
                at = found.start[first] - found.start[found.doc_at[doc]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + row)), said, pa.array(at, pa.int64())], [key, "phrase", "at"])

    hits = rows.select(key, text).mapInArrow(work, _hits_of(rows, key))
    if here:
        return hits
    every = written(hits.join(known.select("phrase"), "phrase", "left_semi").select(key, "phrase", "at"), "phrases-found")
    return _leftmost(every, key) if longest else every


def _leftmost(every: DataFrame, key: str) -> DataFrame:
    """From the left, the longest first, without overlap: a fold over each text's hits."""
    hits = every.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", (-F.length("phrase")).alias("n"), "phrase"))).alias("hits"))
    none = F.struct(F.lit(0).cast("long").alias("free"), F.array().cast("array<struct<phrase:string,at:long>>").alias("out"))

    def take(state, h):
        taken = F.struct((h["at"] - h["n"]).cast("long").alias("free"), F.concat(state["out"], F.array(F.struct(h["phrase"].alias("phrase"), h["at"].alias("at")))).alias("out"))
        return F.when(h["at"] >= state["free"], taken).otherwise(state)

    return hits.select(key, F.explode(F.aggregate("hits", none, take)["out"]).alias("f")).select(key, "f.phrase", "f.at")


def openings(rows: DataFrame, text: str, n: int) -> DataFrame:
    """(phrase): the first ``n`` words of each text's key, once each; texts of fewer words have none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in keys(batch.column(0)):
                first = found.doc_at[:-1][np.diff(found.doc_at) >= n]
                yield pa.RecordBatch.from_arrays([found.cut(first, first + n - 1).unique()], ["phrase"])

    return rows.select(text).mapInArrow(work, "phrase string").distinct()


def phrases_in(rows: DataFrame, key: str, text: str, dictionary: DataFrame, phrase: str, longest: bool = True, most: int = MOST) -> DataFrame:
    """(``key``, phrase, at): the dictionary's phrases in each text, with the place of their first letter in the text's key.

    ``longest``: of overlapping phrases the one that starts first, then the longest ("alternative rock", not "rock"); else
    all. ``key`` must be unique. Null and empty texts and phrases give nothing.
    """
    known = _known(dictionary, phrase)
    some = known.select("phrase").limit(most + 1).collect()
    if not some:
        return rows.select(key, F.lit("").alias("phrase"), F.lit(0).cast("long").alias("at")).limit(0)
    if len(some) <= most:
        return _by_automaton(rows, key, text, sorted(r["phrase"] for r in some), longest)
    return _by_windows(rows, key, text, written(known, "phrases"), longest)


def first_rule(rows: DataFrame, key: str, text: str, rules: DataFrame, values: list[str]) -> DataFrame:
    """(``key``, ``values``) of the first rule (pos, phrase, values) whose phrase a text has as whole words; nulls if none."""
    known = rules.select("pos", norm_key(F.col("phrase")).alias("phrase"), *values).where("phrase <> ''")
    hits = phrases_in(rows, key, text, rules, "phrase", longest=False).select(key, "phrase").distinct().join(sized(known), "phrase")
    best = hits.groupBy(key).agg(F.min_by(F.struct(*values), "pos").alias("best"))
    return rows.select(key).join(best, key, "left").select(key, *[F.col(f"best.{v}").alias(v) for v in values])


def categories(rows: DataFrame, key: str, style: str, exact: DataFrame, keywords: DataFrame) -> DataFrame:
    """(``key``, category, categories) of style texts such as ``Indie Rock / Folk``.

    ``exact`` has name and categories (an array) for whole texts and parts; ``keywords`` has pos, phrase and category. The category is that of the
    whole text by name (its first), else of the first part that has one by name or by its first keyword, else of the whole
    text by its first keyword. All categories: those of the whole text's name if it has several; else the category, then
    those of the parts, each once. Each different text is looked at once.
    """
    from ..functions.fields import style_parts

    texts = rows.select(F.col(style).alias("said")).where("said IS NOT NULL").distinct()
    pieces = texts.select("said", F.posexplode(F.concat(F.array("said"), style_parts(F.col("said")))).alias("at", "piece"))
    keyed = pieces.withColumn("name", norm_key(F.col("piece"))).where("name <> ''")
    known = exact.select(norm_key(F.col("name")).alias("name"), "categories").groupBy("name").agg(F.first("categories").alias("by_name"))
    words = first_rule(keyed.select("name").distinct(), "name", "name", keywords, ["category"])
    each = keyed.join(sized(known), "name", "left").join(words, "name", "left")
    own = F.coalesce(F.get("by_name", F.lit(0)), "category")
    whole = each.where("at = 0").select("said", F.get("by_name", F.lit(0)).alias("whole_name"), F.when(F.size("by_name") > 1, F.col("by_name")).alias("several"), F.col("category").alias("whole_word"))
    parts = each.where("at > 0").groupBy("said").agg(F.array_compact(F.transform(F.array_sort(F.collect_list(F.struct("at", own.alias("own")))), lambda x: x["own"])).alias("parts"))
    told = whole.join(parts, "said", "left").withColumn("parts", F.coalesce("parts", F.array().cast("array<string>")))
    first = F.coalesce("whole_name", F.get("parts", F.lit(0)), "whole_word")
    every = F.coalesce("several", F.when(F.array_contains("parts", first) | first.isNull(), F.array_distinct("parts")).otherwise(F.array_distinct(F.concat(F.array(first), "parts"))))
    out = told.select("said", first.alias("category"), every.alias("categories"))
    return rows.select(key, F.col(style).alias("said")).join(out, "said", "left").select(key, "category", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"))
