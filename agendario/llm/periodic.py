"""Periodic runs of words: every maximal stretch that repeats with one period, exactly, and texts with one period of each kept.

A run is a stretch of consecutive words with smallest period q and at least ``max(least, times * q)`` words that no
neighbouring word extends with period q. For a period p its words from the first to the p-th last, each equal to the word
p further on, are at least ``max((times - 1) * p, least - p)``, so one of the places 0, k, 2k, ... with k that number is among
them: a grid per period, whose sizes sum to n times a logarithm of n (a harmonic series). All (period, grid place) pairs of a batch
of documents are worked on at once:

1. pairs whose two words differ are dropped,
2. the lengths by which the words before and after both places agree are found by binary search over
   prefix hashes (modulo a prime of 31 bits), for all pairs in the same steps,
3. stretches that are long enough are deduplicated; of those with the same bounds the smallest period stays
   (a stretch of three periods or more whose smallest period is q has exactly its q-run's bounds), and
4. the words of each are compared. A hash can only make a length too long, so that this comparison finds every
   collision; a document with one is done again without hashes.

Documents don't meet: there is no shuffle, and a task holds one batch of ``BATCH_WORDS`` words, or one document where
that is longer, and at most ``PAIRS`` pairs at a time. A document is read and worked through whole.

Defined cases: a null text has no words; an empty text and one of fewer words than ``least`` have no runs;
repeated rows and ids are each returned; null ids stay; an empty table gives no rows; other columns are
ignored. White space is ASCII white space (space and 0x09 to 0x0D), so every other character is part of a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

BATCH_WORDS = 100_000
PAIRS = 1_000_000

#: A prime below 2**31, and the base of the prefix hashes.
PRIME, BASE = 2_147_483_629, 1_103_515_245

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Batch:
    """Documents laid end to end as word numbers, with prefix hashes over all of them."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, least: int, times: int):
        self.w, self.least, self.times = numbers, least, times
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        power = np.ones(1, np.uint64)
        while len(power) < len(numbers) + 1:
            power = np.concatenate([power, power * np.uint64(pow(BASE, len(power), PRIME)) % PRIME])
        self.power = power[: len(numbers) + 1]
        self.prefix = np.concatenate([[0], np.cumsum((numbers.astype(np.uint64) + np.uint64(1)) * self.power[:-1] % PRIME)]).astype(np.uint64) % PRIME

    def agree(self, at: np.ndarray, period: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from ``at`` have the hash of those ``period`` further on."""
        a = self.prefix[at + size] + PRIME - self.prefix[at]
        b = self.prefix[at + period + size] + PRIME - self.prefix[at + period]
        return a % PRIME * self.power[period] % PRIME == b % PRIME

    def reach(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The largest agreeing length up to ``most``, after or before both places, by binary search for all pairs at once."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            ok = self.agree(at - mid if back else at, period, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, period, place) of every grid place, ``PAIRS`` at most at a time."""
        sizes = self.ends - self.starts
        per_doc = np.where(sizes >= self.least, sizes // self.times, 0)
        lasts = np.cumsum(per_doc)
        for first in range(0, int(lasts[-1]) if len(lasts) else 0, PAIRS // 8):
            k = np.arange(first, min(first + PAIRS // 8, int(lasts[-1])))
            doc = np.searchsorted(lasts, k, side="right")
            period = k - (lasts[doc] - per_doc[doc]) + 1
            step = np.maximum((self.times - 1) * period, self.least - period)
            count = (sizes[doc] - period + step - 1) // step
            cut = np.searchsorted(np.cumsum(count), np.arange(0, int(count.sum()) + PAIRS, PAIRS))
            for a, b in zip(cut, [*cut[1:], len(k)]):
                if a < b:
                    n = count[a:b]
                    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    yield np.repeat(doc[a:b], n), np.repeat(period[a:b], n), place * np.repeat(step[a:b], n) + np.repeat(self.starts[doc[a:b]], n)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, start, length, period) by document, start and period; start counts from the document's first word."""
        found = [np.zeros((4, 0), np.int64)]
        for doc, period, at in self.pairs():
            same = self.w[at] == self.w[at + period]
            doc, period, at = doc[same], period[same], at[same]
            after = self.reach(at, period, self.ends[doc] - at - period, False)
            need = np.maximum(self.times * period, self.least)
            before = self.reach(at, period, at - self.starts[doc], True)
            length = before + after + period
            ok = length >= need
            found.append(np.stack([doc, at - before - self.starts[doc], length, period])[:, ok])
        doc, start, length, period = np.concatenate(found, axis=1)
        order = np.lexsort((period, length, start, doc))
        doc, start, length, period = (x[order] for x in (doc, start, length, period))
        first = np.ones(len(doc), bool)
        first[1:] = (np.diff(doc) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
        doc, start, length, period = (x[first] for x in (doc, start, length, period))
        wrong = set()
        for d, s, n, p in zip(doc, start + self.starts[doc], length, period):
            if not np.array_equal(self.w[s : s + n - p], self.w[s + p : s + n]):
                wrong.add(d)
        if wrong:
            keep = ~np.isin(doc, list(wrong))
            again = [(d, *r) for d in wrong for r in plain_runs(self.w[self.starts[d] : self.ends[d]], self.least, self.times)]
            doc, start, length, period = np.concatenate([np.stack([doc, start, length, period])[:, keep], np.array(again, np.int64).reshape(-1, 4).T], axis=1)
        order = np.lexsort((period, start, doc))
        return doc[order], start[order], length[order], period[order]


def plain_runs(w: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """The same without hashes, period by period: quadratic, for documents in which hashes have collided."""
    found: dict[tuple[int, int], int] = {}
    for p in range(1, len(w) // times + 1):
        same = np.concatenate([[False], w[:-p] == w[p:], [False]])
        edges = np.flatnonzero(np.diff(same.astype(np.int8)))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a + p >= max(least, times * p):
                found.setdefault((int(a), int(b - a + p)), p)
    return sorted((s, n, p) for (s, n), p in found.items())


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs:
        edge[s + p] += 1
        edge[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def _worked(texts: list[str | None], least: int, times: int) -> tuple[np.ndarray, list, list]:
    """The number of words, the runs and the collapsed text of each of some documents."""
    words = [(t or "").encode().split() for t in texts]
    number: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((number.setdefault(x, len(number)) for w in words for x in w), np.int64, int(sizes.sum()))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for d, s, n, p in zip(*(x.tolist() for x in _Batch(flat, sizes, least, times).runs())):
        runs[d].append((s, n, p))
    return sizes, runs, [_kept(w, r) if r else b" ".join(w) for w, r in zip(words, runs)]


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """(``key``, n_words, runs, collapsed): every run of each document as (start, length, period), and its words without repeats.

    A word is left out of ``collapsed`` if some run has it after its first period; words are joined by one space.
    ``times`` is 3 at least (a shorter stretch needn't have its smallest period's bounds).
    """
    if times < 3 or least < times:
        raise ValueError("times must be 3 at least, and least not below it")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A word takes six bytes or so with its space.
            upto = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // (6 * BATCH_WORDS)
            for first, n in zip(*np.unique(upto, return_index=False, return_counts=True)):
                at = int(np.searchsorted(upto, first))
                part = batch.slice(at, int(n))
                counts, runs, collapsed = _worked(part.column(1).to_pylist(), least, times)
                rows = [[{"start": s, "length": m, "period": p} for s, m, p in r] for r in runs]
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(rows, RUNS), pa.array([c.decode() for c in collapsed], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "runs", "collapsed"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string")).mapInArrow(work, f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The query's texts: with h = crc32(doc_id), g = h // 10, n words, documents of h % 10 = 0 repeat from word g % n on.

    A null id leaves its text as it is.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        again = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(again, " ")).otherwise(F.lit(""))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = detect(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    runs = F.col("runs")

    def better(best: Column, r: Column) -> Column:
        more, less = r["length"] * best["period"], best["length"] * r["period"]
        # Runs come by start, then period: the first of equals stays.
        return F.when(best["period"].isNull() | (more > less), r).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate(runs, none, better)
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.when(F.size(runs) > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
