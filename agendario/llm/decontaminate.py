"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs without white space and ASCII punctuation, A-Z lower-cased. The ``SEED``-word grams of the
test items are looked for in all documents. Passages around them are cut out of the documents, once for each class
of item lengths (powers of two), so that a long item widens no passage of shorter ones.

A passage is compared with an item if it holds at least ``SHARED`` of the item's distinct grams, rounded down, and
one at least. The seeds of an item with n grams of which k are needed are its n - k + 1 rarest ones, by the number of
passages that hold them: whatever holds k grams holds one of these. So the frequent phrases of an item join
nothing, and still what is found in a document does not depend on the others: counts choose the way, never the
result. Passages and seeds meet in a join on class and gram that carries ids only; each pair's words follow once.

A pair is aligned locally (match 1, mismatch and gap -1) and counts as contamination if its score is at least
``LEAST`` of the item's words, and ``LEAST_SCORE`` or the whole item. A score is at most the number of the item's
words that the passage holds; pairs in which that or the shared grams are too few are not aligned.

Up to ``MOST_EXACT`` seeds are counted and broadcast, so that no passage is shuffled to meet them; more of them meet the
passages under ``SALTS`` salts, and so do the words of items, since one item may be in a third of all documents.

Which grams occur in a document is first asked of a bit table of at most ``MAX_SLOTS`` bits for each class, and of at
most ``MOST_EXACT`` grams, all that is broadcast; a larger benchmark makes it less selective, never wrong, because
the joins compare the full hashes. No pair, seed or passage is capped.

Defined cases: null or empty texts have no words; items of fewer than ``SEED`` words have no seed and
are never found; a null item_id or doc_id is reported as such; repeated rows of a document or item give
one row per (doc_id, item_id) with the best score; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stored, table
from .wordhash import Words, pieces, text_buffers, window_hashes

SEED = 3
LEAST = 0.4
#: Below this score, only a whole item counts: a few common words meet by chance.
LEAST_SCORE = 8
#: Share of an item's distinct grams that a passage must hold.
SHARED = 0.15
MAX_SLOTS = 1 << 28
SLOTS_PER_GRAM = 64
MOST_EXACT = 1 << 20
CHUNK_BITS = 1 << 20
#: Parts into which a gram or an item that very many passages hold is dealt.
SALTS = 16
#: Items of at most 2 ** LEAST_CLASS words are one class.
LEAST_CLASS = 6
#: Words of a passage at least, before passages of a long document are split (with overlap).
LONGEST = 2048


def _words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of every text."""
    raw, offs = text_buffers(column)
    for a, b in pieces(offs):
        words = Words(raw, offs[a : b + 1], marks=False)
        for i in range(b - a):
            yield words.hash[words.doc_at[i] : words.doc_at[i + 1]]


def item_words(items: DataFrame) -> DataFrame:
    """item_id, words (binary) and n_words of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = list(_words(batch.column(1)))
            columns = [batch.column(0), pa.array([w.tobytes() for w in words], pa.binary()), pa.array([len(w) for w in words], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "n_words"])

    return items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "item_id long, words binary, n_words int")


def needed(n_grams: np.ndarray | int) -> np.ndarray | int:
    """How many of an item's distinct grams a passage must hold."""
    return np.maximum(1, np.floor(SHARED * np.asarray(n_grams))).astype(int)


def item_grams(items: DataFrame) -> DataFrame:
    """(item, class, need, gram) for every distinct gram of an item; its class is the power of two that bounds its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(w, np.uint64) for w in batch.column(1).to_pylist()]
            grams = [np.unique(window_hashes(w, SEED)).view(np.int64).tolist() for w in own]
            classes = [max(LEAST_CLASS, (max(len(w), 1) - 1).bit_length()) for w in own]
            columns = [batch.column(0), pa.array(classes, pa.int32()), pa.array(needed([len(g) for g in grams]), pa.int32()), pa.array(grams, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "class", "need", "grams"])

    found = items.select("item", "words").mapInArrow(run, "item long, class int, need int, grams array<long>")
    return found.select("item", "class", "need", F.explode("grams").alias("gram"))


def rare_seeds(grams: DataFrame, held: DataFrame) -> DataFrame:
    """(item, class, gram): the grams of each item that fewest passages hold (``held``: passage, class, gram), as many as the docstring says."""
    counts = held.groupBy("class", "gram").agg(F.count("*").alias("n"))
    # One item's grams, which one row held before.
    own = Window.partitionBy("item")
    ranked = grams.join(counts, ["class", "gram"], "left").select(
        "item", "class", "gram", "need", "n", F.row_number().over(own.orderBy(F.coalesce("n", F.lit(0)), "gram")).alias("rank"), F.count("*").over(own).alias("grams")
    )
    return ranked.where("rank <= grams - need + 1 AND n IS NOT NULL").select("item", "class", "gram")


def meetings(held: DataFrame, seeds: DataFrame) -> DataFrame:
    """Distinct (passage, item) that share a seed."""
    if seeds.count() <= MOST_EXACT:
        met = held.join(F.broadcast(seeds), ["class", "gram"])
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        met = held.withColumn("salt", F.pmod(F.col("passage"), F.lit(SALTS)).cast("int")).join(seeds.select("*", salts), ["class", "gram", "salt"])
    return met.select("passage", "item").distinct()


class BitTable:
    """Which grams are in a set: bits of their lowest places, and up to ``MOST_EXACT`` grams the grams themselves."""

    def __init__(self, grams: DataFrame):
        n = grams.select("gram").distinct().count()
        self.slots = min(MAX_SLOTS, max(CHUNK_BITS, 1 << (SLOTS_PER_GRAM * max(n, 1) - 1).bit_length()))
        mask = self.slots - 1

        def pack(rows: pa.Table) -> pa.Table:
            bits = np.zeros(CHUNK_BITS, np.uint8)
            bits[rows["slot"].to_numpy() % CHUNK_BITS] = 1
            return pa.table({"chunk": pa.array([int(rows["slot"][0].as_py()) // CHUNK_BITS], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        slots = grams.select(F.col("gram").bitwiseAND(mask).alias("slot")).distinct()
        rows = slots.groupBy(F.floor(F.col("slot") / CHUNK_BITS).alias("of")).applyInArrow(pack, "chunk long, bits binary").collect()
        self.bits = np.zeros(self.slots // 8, np.uint8)
        for r in rows:
            at = r["chunk"] * (CHUNK_BITS // 8)
            self.bits[at : at + CHUNK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
        self.exact = None
        if n <= MOST_EXACT:
            self.exact = np.sort(np.array([r["gram"] for r in grams.select("gram").distinct().collect()], np.int64).view(np.uint64))

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Places of the grams that are in the set (beyond ``MOST_EXACT``: and of some others)."""
        at = grams & np.uint64(self.slots - 1)
        found = np.flatnonzero((self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
        if self.exact is None or not len(found):
            return found
        own = grams[found]
        place = np.minimum(np.searchsorted(self.exact, own), len(self.exact) - 1)
        return found[self.exact[place] == own]


def passages(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Passages with a seed: doc_id, class (of the items sought), start (in words), words (binary) and grams (those that may be seeds)."""
    # At most one class for each bit of an item's length.
    classes = sorted(r["class"] for r in seeds.select("class").distinct().collect())
    tables = [(c, (1 << c) + (1 << c) // 4 + SEED, BitTable(seeds.where(F.col("class") == c))) for c in classes]
    known = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, words in zip(batch.column(0).to_pylist(), _words(batch.column(1))):
                own = window_hashes(words, SEED)
                for c, margin, bits in known.value:
                    hit = bits.hits(own)
                    if len(hit):
                        for start, end, inside in cut(own, hit, len(words), margin):
                            for column, value in zip(out, (doc_id, c, start, words[start:end].tobytes(), inside)):
                                column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["doc_id", "class", "start", "words", "grams"])

    def cut(own: np.ndarray, hit: np.ndarray, n_words: int, margin: int) -> Iterator[tuple[int, int, list[int]]]:
        longest = max(LONGEST, 6 * margin)
        cuts = np.flatnonzero(np.r_[True, np.diff(hit) > 2 * margin, True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            lo, hi = max(0, int(hit[a]) - margin), min(n_words, int(hit[b - 1]) + SEED + margin)
            for start in range(lo, max(lo + 1, hi - 2 * margin), longest - 2 * margin):
                end = min(hi, start + longest)
                inside = np.unique(own[hit[(hit >= start) & (hit <= end - SEED)]]).view(np.int64).tolist()
                if inside:
                    yield start, end, inside

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, class int, start long, words binary, grams array<long>")


def align(passage: list[np.ndarray], item: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of pairs at once: best score, and the passage's words from and to which it runs.

    One step handles one passage word of all pairs; the gap inside a row is a running maximum.
    """
    n, wide, long = len(item), max(map(len, item)), max(map(len, passage))
    b = np.zeros((n, wide), np.uint64)
    for k, x in enumerate(item):
        b[k, : len(x)] = x
    inside = np.arange(wide) < np.array([len(x) for x in item])[:, None]
    a = np.zeros((n, long), np.uint64)
    for k, x in enumerate(passage):
        a[k, : len(x)] = x
    size = np.array([len(x) for x in passage])
    step = np.arange(wide, dtype=np.int32)
    # A cell holds score * BIG + (BIG - 1 - first word), so that the place it began at travels with the score.
    big = np.int64(1 << 32)
    before = np.zeros((n, wide + 1), np.int64)
    best, at_end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(long):
        fresh = big - 1 - i
        base = np.where(before[:, :-1] >= big, before[:, :-1], fresh)
        same = (a[:, i : i + 1] == b) & inside & (i < size)[:, None]
        cell = np.maximum(np.where(same, base + big, base - big), before[:, 1:] - big)
        cell = np.maximum(cell, 0)
        cell = np.maximum.accumulate(cell + step * big, axis=1) - step * big
        cell[cell < big] = 0
        before[:, 1:] = cell
        top = np.where(inside, cell, 0).max(axis=1)
        better = (top // big > best // big) & (i < size)
        best[better], at_end[better] = top[better], i + 1
    return best // big, np.where(best > 0, big - 1 - best % big, 0), at_end


def least_score(n_words: np.ndarray, least: float) -> np.ndarray:
    """The scores from which items of so many words count."""
    return np.minimum(n_words, np.maximum(least * n_words, LEAST_SCORE))


def contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, score, n_words (of the item), start and end (words of the document)."""
    tests = stored(item_words(items).withColumn("item", F.monotonically_increasing_id()), "items")
    grams = stored(item_grams(tests), "grams")
    found = stored(passages(docs, grams).withColumn("passage", F.monotonically_increasing_id()), "passages")
    held = found.select("passage", "class", F.explode("grams").alias("gram"))
    pairs = meetings(held, stored(rare_seeds(grams, held), "seeds"))

    def may_count(passage: bytes, item: bytes) -> bool:
        words, own = np.frombuffer(item, np.uint64), np.frombuffer(passage, np.uint64)
        if np.isin(words, own).sum() < least_score(len(words), least):
            return False
        grams = np.unique(window_hashes(words, SEED))
        return np.isin(grams, window_hashes(own, SEED)).sum() >= needed(len(grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likely = [may_count(p, t) for p, t in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())]
            batch = batch.filter(pa.array(likely, pa.bool_()))
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = [np.frombuffer(x, np.uint64) for x in part.column(2).to_pylist()]
                tests_ = [np.frombuffer(x, np.uint64) for x in part.column(4).to_pylist()]
                score, first, last = align(texts, tests_)
                start = np.array(part.column(1).to_pylist(), np.int64)
                n = np.array([len(x) for x in tests_])
                rows = pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(3), pa.array(score, pa.int64()), pa.array(n, pa.int64()), pa.array(start + first, pa.int64()), pa.array(start + last, pa.int64())],
                    ["doc_id", "item_id", "score", "n_words", "start", "end"],
                )
                yield rows.filter(pa.array(score >= least_score(n, least)))

    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    dealt = pairs.withColumn("salt", F.pmod(F.col("passage"), F.lit(SALTS)).cast("int"))
    with_items = dealt.join(tests.select("item", "item_id", F.col("words").alias("item_words"), salts), ["item", "salt"])
    met = with_items.join(found.select("passage", "doc_id", "start", "words"), "passage").select("doc_id", "start", "words", "item_id", "item_words")
    aligned = met.mapInArrow(run, "doc_id long, item_id long, score long, n_words long, start long, end long")
    best = F.max_by(F.struct("score", "n_words", "start", "end"), F.struct("score", -F.col("start"))).alias("best")
    return aligned.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns.

    Rows are decided by their texts: equal texts share a verdict, and an id that several texts have, or null ids,
    take no other row with them.
    """
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = contaminated(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    # Stored, so that the join deals it anew and a text with very many copies can be split.
    gone = stored(found.select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return docs.join(gone, key == gone["gone_id"], "left_anti")
