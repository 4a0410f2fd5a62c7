"""Nearest neighbours by inner product: multiprobe p-stable hashing, then exact distances.

Vectors are scaled to the unit ball and get one more component, sqrt(1 - |x|**2), in the index (0 in a query), so that
the largest inner product is the smallest Euclidean distance. Each of ``TABLES`` tables has ``m`` functions
floor((a x + b) / w) with Gaussian a (2-stable); a bucket is their m numbers.

*Probing.* A query visits its own bucket first, then perturbed ones in the order of their estimated success: a bucket's score
is the sum, over its functions, of the squared distance from the query's projection to the near edge of that bucket's cell, and
the chance that a near vector lies there falls with exp(-score). All buckets up to a score are visited; no number is fixed,
so a query near many edges visits more of them. The score is fitted: for ``SAMPLE`` queries (drawn by digest) the exact nearest
are found among all rows, and the score is that which reaches ``RECALL`` of them in some table. Every row is indexed.

*Work.* Buckets are dealt by their first ``c`` numbers (cells, chosen for about ``CELL_ROWS`` rows), so that a query
travels once per cell it visits, not once per bucket. A cell of more rows or queries is dealt further into a grid of parts
of at most ``CELL_ROWS`` x ``CELL_QUERIES``, so a cell that holds a third of all rows is many tasks. A part gives each query's best
few exactly, by matrix products over the buckets that its queries visit; candidate pairs never leave it. The tables' candidates are then
merged, in two steps where a query has met many parts.

Equal vectors are one entry with their smallest ids, found by partial aggregation, so that very many copies cost no hot
task. Queries that find fewer than ``k`` candidates although there are more visit every part.

Defined cases: null ids and vectors that are null, zero or hold null or non-finite components take no part, nor do those whose
length isn't that of most (ties: the longest). A repeated id is a row of its own, as query and as candidate. Ties go to the smaller
id. An empty table gives no rows; other columns are ignored. Inner products are sums of doubles in a fixed order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stored, table
from .vectors import as_doubles, binary, finite, from_binary, of_one_length, single

TABLES = 2
WIDTH = 2.5
SAMPLE = 256
RECALL = 0.95
CELL_ROWS = 8192
CELL_QUERIES = 4096

#: Scores within this share of the k-th best are computed again in a fixed order before they are ranked.
_SLACK = 1e-9
_FOUND = pa.list_(pa.struct([("neg", pa.float64()), ("first", pa.int64()), ("entry", pa.binary())]))
_FOUND_SQL = "array<struct<neg:double,first:long,entry:binary>>"


class Tables:
    """The hash functions, all tables' from one seed. ``depth`` numbers of a bucket name its cell."""

    def __init__(self, dim: int, largest: float, rows: int, seed: int = 1):
        self.dim, self.largest = dim, largest
        self.m = int(np.clip(round(np.log2(max(rows, 2)) / 2), 4, 24))
        self.depth = int(np.clip(np.ceil(np.log(max(rows, 1) / CELL_ROWS) / np.log(3)), 0, self.m))
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(TABLES, dim + 1, self.m))
        self.b = rng.uniform(0, WIDTH, size=(TABLES, 1, self.m))

    def places(self, x: np.ndarray, query: bool) -> np.ndarray:
        """(table, row, function): where vectors fall, in cells' widths. Sums run in a fixed order, so places are repeatable."""
        x = x / self.largest
        norm = np.sqrt((x * x).sum(axis=1))
        if query:
            # A query's own length changes no order of inner products.
            x, last = x / norm[:, None], np.zeros(len(x))
        else:
            last = np.sqrt(np.maximum(0.0, 1.0 - norm * norm))
        full = np.concatenate([x, last[:, None]], axis=1)
        return np.stack([(np.einsum("nd,dm->nm", full, a) + b) / WIDTH for a, b in zip(self.a, self.b)])


def edges(place: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Squared distance from places to the near edge of cells, 0 inside."""
    return np.maximum(0.0, np.maximum(bucket - place, place - bucket - 1)) ** 2


def cells_within(place: np.ndarray, depth: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell numbers): every cell whose own share of the score is at most ``most``, grown number by number."""
    row, score, cells = np.arange(len(place)), np.zeros(len(place)), np.zeros((len(place), 0), np.int64)
    for i in range(depth):
        at = place[row, i]
        low = np.floor(at - np.sqrt(np.maximum(most - score, 0))).astype(np.int64)
        high = np.floor(at + np.sqrt(np.maximum(most - score, 0))).astype(np.int64)
        n = high - low + 1
        src = np.repeat(np.arange(len(row)), n)
        number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + low[src]
        score = score[src] + edges(at[src], number)
        ok = score <= most
        row, score, cells = row[src][ok], score[ok], np.concatenate([cells[src], number[:, None]], axis=1)[ok]
    return row, cells


def best_of(queries: np.ndarray, rows: np.ndarray, first: np.ndarray, k: int, visited=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's ``k`` largest inner products, ties to the smaller ``first``.

    A matrix product finds those that may be among them; their scores are then summed in a fixed order and ranked.
    ``visited`` (queries x rows, or null for all) says which rows a query looks at.
    """
    product = queries @ rows.T
    if visited is not None:
        product[~visited] = -np.inf
    take = min(k, len(rows))
    least = -np.partition(-product, take - 1, axis=1)[:, take - 1]
    slack = _SLACK * np.sqrt((queries**2).sum(axis=1) * (rows**2).sum(axis=1).max(initial=0))
    q, r = np.nonzero(product >= np.where(np.isfinite(least), least - slack, np.finfo(np.float64).min)[:, None])
    score = (queries[q] * rows[r]).sum(axis=1)
    order = np.lexsort((first[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], r[rank < k], score[rank < k]


def entries(rows: DataFrame, key: str, vector: str, every: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The distinct vectors (entry, v, first, asks, norm), the ids of those that several rows have, the queries, and the dimension."""
    kept = rows.select(F.col(key).cast("long").alias("id"), vector).where(F.col("id").isNotNull() & finite(vector) & F.exists(vector, lambda c: c != 0))
    taken, dim = of_one_length(kept, vector)
    kind = "<f4" if single(rows, vector) else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_doubles(batch.column(1), dim) + 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), binary(x.astype(kind)), pa.array(np.sqrt((x * x).sum(axis=1)))], ["id", "v", "norm"])

    packed = taken.mapInArrow(pack, "id long, v binary, norm double").withColumn("entry", F.unhex(F.md5("v")))
    known = stored(packed.groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.max(F.col("id") % every == 0).alias("asks"), F.max("norm").alias("norm")).withColumn("entry", F.unhex(F.md5("v"))), "entries")
    several = known.where("copies > 1").select("entry")
    order = F.row_number().over(Window.partitionBy("entry").orderBy("id"))
    shared = packed.select("id", "entry").join(several, "entry", "left_semi").withColumn("n", order).where(F.col("n") <= k + 1)
    ids = shared.groupBy("entry").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return known, ids, packed.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "entry"), dim


def fitted_score(known: DataFrame, asking: DataFrame, tables: Tables, kind: str, k: int, recall: float, sample: int) -> float:
    """The score at which a sample of queries reaches ``recall`` of its exact nearest among all rows.

    The sample is at most ``sample`` queries and goes to every task; each task returns its best ``k`` per query,
    which are merged on Spark. What reaches the driver is ``sample * k`` vectors.
    """
    chosen = asking.orderBy("entry").limit(sample).collect()
    if not chosen:
        return 0.0
    dim, queries, own = tables.dim, np.stack([np.frombuffer(r["v"], kind).astype(np.float64) for r in chosen]), [bytes(r["entry"]) for r in chosen]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CELL_ROWS):
                part = batch.slice(at, CELL_ROWS)
                x = from_binary(part.column(1), kind, dim).astype(np.float64)
                q, r, score = best_of(queries, x, part.column(2).to_numpy(), k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(score), part.column(0).take(pa.array(r)), part.column(1).take(pa.array(r))], ["q", "score", "entry", "v"])

    near = known.select("entry", "v", "first").mapInArrow(scan, "q int, score double, entry binary, v binary")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "entry"))
    best = near.withColumn("n", rank).where(F.col("n") <= k + 1).collect()
    pairs = [(r["q"], r["v"]) for r in best if bytes(r["entry"]) != own[r["q"]]]
    if not pairs:
        return 0.0
    place = tables.places(queries, True)[:, [q for q, _ in pairs]]
    bucket = np.floor(tables.places(np.stack([np.frombuffer(v, kind).astype(np.float64) for _, v in pairs]), False))
    return float(np.quantile(edges(place, bucket).sum(axis=2).min(axis=0), recall, method="higher")) + 1e-9


def _cell(table_no: int, cells: np.ndarray) -> pa.Array:
    """A table's cell as one number (a digest of its numbers, where equal numbers give equal digests)."""
    out = np.full(len(cells), table_no + 1, np.uint64)
    for c in cells.T:
        out = (out ^ c.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return pa.array(out.view(np.int64))


def candidates(known: DataFrame, asking: DataFrame, tables: Tables, kind: str, k: int, most: float) -> DataFrame:
    """(query, found): the best ``k`` entries that each query finds in the buckets of scores up to ``most``; infinity visits all."""
    dim, depth = tables.dim, tables.depth if np.isfinite(most) else 0
    used = TABLES if np.isfinite(most) else 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.floor(tables.places(from_binary(batch.column(1), kind, dim).astype(np.float64), False)).astype(np.int64)
            for t in range(used):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, t, np.int32)), _cell(t, at[t][:, :depth]), *batch.columns], ["t", "cell", "entry", "v", "first"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                at = tables.places(from_binary(part.column(1), kind, dim).astype(np.float64), True)
                for t in range(used):
                    row, cells = cells_within(at[t], depth, most)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), t, np.int32)), _cell(t, cells), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))], ["t", "cell", "query", "v"])

    rows = known.select("entry", "v", "first").mapInArrow(index, "t int, cell long, entry binary, v binary, first long")
    probes = asking.select(F.col("entry").alias("query"), "v").mapInArrow(probe, "t int, cell long, query binary, v binary")
    counted = rows.groupBy("t", "cell").agg(F.count("*").alias("n_rows")).join(probes.groupBy("t", "cell").agg(F.count("*").alias("n_queries")), ["t", "cell"])
    parts = stored(counted.select("t", "cell", F.ceil(F.col("n_rows") / CELL_ROWS).cast("int").alias("ni"), F.ceil(F.col("n_queries") / CELL_QUERIES).cast("int").alias("nj")), "cells")

    def dealt(name: str, n: str) -> Column:
        return F.pmod(F.xxhash64(name, F.lit(7)), F.col(n)).cast("int")

    every = rows.join(parts, ["t", "cell"]).select("t", "cell", dealt("entry", "ni").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"), "entry", "v", "first")
    asked = probes.join(parts, ["t", "cell"]).select("t", "cell", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), dealt("query", "nj").alias("j"), "query", "v")

    def meet(names: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list] = ([], [])
        if left.num_rows and right.num_rows:
            t = names[0].as_py()
            left, right = left.combine_chunks(), right.combine_chunks()
            x = from_binary(left["v"], kind, dim).astype(np.float64)
            bucket, of = np.unique(np.floor(tables.places(x, False)[t]), axis=0, return_inverse=True)
            order = np.argsort(of.ravel(), kind="stable")
            x, of, left = x[order], of.ravel()[order], left.take(pa.array(order))
            first, entry = left["first"].to_numpy(), left["entry"].to_pylist()
            for begin in range(0, right.num_rows, 256):
                part = right.slice(begin, 256)
                q = from_binary(part["v"], kind, dim).astype(np.float64)
                visited = None
                if np.isfinite(most):
                    place = tables.places(q, True)[t]
                    score = np.zeros((len(q), len(bucket)))
                    for f in range(tables.m):
                        score += edges(place[:, f, None], bucket[None, :, f])
                    seen = score <= most
                    some = seen.any(axis=0)[of]
                    visited = seen[:, of[some]]
                else:
                    some = np.ones(len(x), bool)
                if not some.any():
                    continue
                at = np.flatnonzero(some)
                qi, ri, value = best_of(q, x[at], first[at], k, visited)
                if visited is not None:
                    ok = visited[qi, ri]
                    qi, ri, value = qi[ok], ri[ok], value[ok]
                cut = np.searchsorted(qi, np.arange(len(q) + 1))
                for n, query in enumerate(part["query"].to_pylist()):
                    if cut[n] < cut[n + 1]:
                        out[0].append(query)
                        out[1].append([{"neg": -float(s), "first": int(first[at[r]]), "entry": entry[at[r]]} for s, r in zip(value[cut[n] : cut[n + 1]], ri[cut[n] : cut[n + 1]])])
        return pa.table([pa.array(out[0], pa.binary()), pa.array(out[1], _FOUND)], ["query", "found"])

    keys = ["t", "cell", "i", "j"]
    met = every.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(meet, f"query binary, found {_FOUND_SQL}")

    def merged(df: DataFrame, *by) -> DataFrame:
        best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))), 1, k)
        return df.groupBy("query", *by).agg(best.alias("found"))

    return merged(merged(met, F.pmod(F.xxhash64("found"), F.lit(16)).alias("part")).drop("part"))


def nearest(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """(query_id, found): for each row whose id is divisible by ``every``, its ``k`` nearest found as (neg, id), the nearest first.

    ``neg`` is the negated inner product.
    """
    known, ids, queries, dim = entries(rows, key, vector, every, k)
    kind = "<f4" if single(rows, vector) else "<f8"
    total = known.agg(F.count("*").alias("n"), F.max("norm").alias("largest")).first()
    asking = known.where("asks").select("entry", "v")
    if not total["n"]:
        return rows.sparkSession.createDataFrame([], "query_id long, found array<struct<neg:double,id:long>>")
    tables = Tables(dim, total["largest"], total["n"])
    most = fitted_score(known, asking, tables, kind, k, recall, sample)
    # One more than is asked for, as a query may find itself.
    found = stored(candidates(known, asking, tables, kind, k + 1, most), "found")
    enough = found.where(F.size("found") >= min(k + 1, total["n"])).select(F.col("query").alias("entry"))
    short = asking.join(enough, "entry", "left_anti")
    if short.take(1):
        rest = candidates(known, short, tables, kind, k + 1, float("inf"))
        found = found.join(enough.withColumnRenamed("entry", "query"), "query", "left_semi").unionByName(rest)
    each = found.select("query", F.explode("found").alias("f")).select("query", "f.neg", "f.first", F.col("f.entry").alias("entry"))
    wide = each.join(ids, "entry", "left").select("query", F.transform(F.coalesce("ids", F.array("first")), lambda i: F.struct(F.col("neg"), i.alias("id"), F.col("entry").alias("entry"))).alias("some"))
    lists = wide.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("some"))), 1, k + 1).alias("found"))
    mine = queries.join(lists, queries["entry"] == lists["query"]).select("query_id", "entry", "found")
    own = F.array_position(F.transform("found", lambda f: (f["id"] == F.col("query_id")) & (f["entry"] == F.col("entry"))), F.lit(True))
    others = F.filter("found", lambda f, i: i + 1 != own)
    return mine.select("query_id", F.transform(F.slice(others, 1, k), lambda f: F.struct(f["neg"].alias("neg"), f["id"].alias("id"))).alias("found"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest(table(spark, sf_dir, "embeddings"))
    each = found.select("query_id", F.posexplode("found").alias("at", "f"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.id").alias("vec_id"), (-F.col("f.neg")).alias("score"))
