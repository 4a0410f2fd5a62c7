"""Exact n-gram Jaccard join with several global token orders, up to connected components.

A document's set holds its distinct 5-word shingles. Two documents link when their sets'
Jaccard similarity is at least 0.8. The join works on distinct sets only (copies share one), and

1. counts in how many sets each shingle occurs. Shingles travel as binary blocks dealt by hash,
   about ``BLOCK_TOKENS`` to a block, so a very common shingle costs once per set and no
   row of its own; what is met again goes back to the group of rows that its set is from. In a block a set is
   its place in its group, one byte mostly, so that bytes a shingle don't grow with the number of blocks.
   Keys travel once for each set and group, in blocks of their own, which tell the first of the groups that have
   a set in how many groups it is. There, a shingle met in more groups than its set is shared with another
   set. A set links only if at least ceil(0.8 n) of its shingles are shared at all; most documents of a corpus end
   here, exactly.
   Sets with the same shared shingles and the same size are one class: they link with the same other sets, and
   with each other or not at all by their size alone. Only one set of each class goes on.
2. orders the shared shingles of each remaining set by (times met, hash_k), k = 0, 1, 2:
   three global orders. In each, linked sets must share a shingle of their prefixes. Sets that share one
   in the first order are tied together into pools; no link leaves a pool.
3. inside pools, dealt into chunks of about ``CHUNK`` sets, candidates must meet in the
   prefixes of all orders; only then are intersections counted. Pairs that are already connected are
   not verified again and no pair is ever emitted: a chunk returns one label per set. Pools of more
   than one chunk are then joined by pivots (some sets sent to all chunks of the pool), and finally
   every set outside the pool's largest component is compared with all chunks, which makes the
   components exact.

Shingles are compared by 56-bit and sets by 128-bit hashes.

Defined cases: null, empty or blank text has an empty set, links with nothing and is its own
component; fewer than five words make one shingle of the whole sequence; repeated rows are
each returned, in one component; rows with a null ``doc_id`` take part, but a null never names a
component unless all its rows are null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import MOST_HUBS, met, stored, table
from .wordhash import mix, shingle_sets

SHINGLE = 5
PERCENT = 80
ORDERS = 3
BLOCK_TOKENS = 1_500_000
BLOCK_KEYS = 250_000
GROUP_ROWS = 2500
CHUNK = 1024
PIVOTS = 16
#: Bits of the filter for a row that it holds; words of 64 bits that it has at most (8 MB); words of a slice.
ROW_BITS = 16
MOST_WORDS = 1 << 20
SLICE_WORDS = 1 << 10
_PROBES = 2

_ODD = [np.uint64(0x9E3779B97F4A7C15 + 2 * 0x1234567 * k) for k in range(ORDERS + 2)]


def _key(own: np.ndarray) -> bytes:
    """128-bit hash of a set."""
    a = mix(own * _ODD[ORDERS] + np.uint64(3)).sum(dtype=np.uint64) + np.uint64(len(own))
    b = mix(own * _ODD[ORDERS + 1] + np.uint64(5)).sum(dtype=np.uint64)
    return np.array([a, b], ">u8").tobytes()


def least_overlap(n):
    """The fewest shingles that a set of n shares with any set it links to."""
    return (PERCENT * n + 99) // 100


def described(docs: DataFrame) -> DataFrame:
    """doc_id, digest (MD5 of the text), set_key (null for an empty set) and n_shingles of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], []
            for own in shingle_sets(batch.column(1), SHINGLE):
                keys.append(_key(own) if len(own) else None)
                sizes.append(len(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "digest", "set_key", "n_shingles"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _digest(F.col("text")))
    return rows.mapInArrow(run, "doc_id long, digest binary, set_key binary, n_shingles long")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


_TOKEN_BYTES = 7
_TOKEN = np.uint64((1 << 8 * _TOKEN_BYTES) - 1)


def _narrow(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 8)[:, :_TOKEN_BYTES]).tobytes()


def _wide(column: pa.ChunkedArray) -> np.ndarray:
    narrow = _joined(column, np.uint8).reshape(-1, _TOKEN_BYTES)
    tokens = np.zeros((len(narrow), 8), np.uint8)
    tokens[:, :_TOKEN_BYTES] = narrow
    return tokens.view(np.uint64).ravel()


def _planes(numbers: np.ndarray) -> bytes:
    """Byte planes of 32-bit numbers, which are mostly small: the shuffle compresses them away."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _of_planes(column: pa.ChunkedArray) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(4, -1).T for x in column]
    return np.ascontiguousarray(np.concatenate(parts)).view("<u4").ravel() if parts else np.zeros(0, np.uint32)


def _steps(places: np.ndarray) -> bytes:
    """Ascending places by their distances, which are small."""
    return _planes(np.diff(places, prepend=0))


def _of_steps(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all rows one after another, and the row of each."""
    steps = _of_planes(column).astype(np.int64)
    size = pc.binary_length(column).to_numpy() // 4
    ends = np.r_[0, np.cumsum(steps)]
    begin = np.cumsum(size) - size
    return ends[1:] - np.repeat(ends[begin], size), np.repeat(np.arange(len(size)), size)


def _dealt(docs: DataFrame, blocks: int, key_blocks: int) -> DataFrame:
    """Shingles of the distinct sets of each group of rows, one row per block and group.

    Blocks below 0 have the keys and sizes of sets (no tokens).
    """

    def deal(texts: pa.Array, group: int) -> pa.RecordBatch | None:
        seen: dict[bytes, np.ndarray] = {}
        for own in shingle_sets(texts, SHINGLE):
            if len(own):
                seen.setdefault(_key(own), own)
        if not seen:
            return None
        keys = np.frombuffer(b"".join(seen), "V16")
        sizes = np.array([len(x) for x in seen.values()])
        tokens = np.concatenate(list(seen.values())) & _TOKEN
        entry = np.repeat(np.arange(len(seen), dtype=np.int32), sizes)
        block = ((tokens >> np.uint64(32)) % np.uint64(blocks)).astype(np.uint16 if blocks < 65536 else np.uint32)
        order = np.argsort(block, kind="stable")
        tokens, entry, block = tokens[order], entry[order], block[order]
        cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        out: list[list] = [[], [], [], [], []]
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(block)]):
            e = entry[lo:hi]
            at = np.flatnonzero(np.r_[True, e[1:] != e[:-1]])
            for column, value in zip(out, (int(block[lo]), _steps(e[at]), _planes(np.diff(np.r_[at, hi - lo])), _narrow(tokens[lo:hi]), b"")):
                column.append(value)
        of_key = keys.view(">u8").reshape(-1, 2)[:, 0] % np.uint64(key_blocks)
        for k in np.unique(of_key):
            at = np.flatnonzero(of_key == k)
            for column, value in zip(out, (-1 - int(k), _steps(at), _planes(sizes[at]), b"", keys[at].tobytes())):
                column.append(value)
        groups = pa.array([group] * len(out[0]), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), groups, *[pa.array(x, pa.binary()) for x in out[1:]]], ["block", "grp", "places", "counts", "tokens", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_ROWS):
                rows = deal(batch.column(0).slice(at, GROUP_ROWS), group)
                group += 1
                if rows is not None:
                    yield rows

    return docs.select(F.col("text").cast("string")).mapInArrow(run, f"block long, {_BLOCK}")


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The values of a binary column one after another."""
    parts = []
    for chunk in filter(len, column.chunks):
        chunk = chunk.cast(pa.large_binary())
        offs = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[offs[0] : offs[-1]])
    return (parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint8)])).view(dtype)


_BLOCK = "grp long, places binary, counts binary, tokens binary, keys binary"


def _met_in_block(rows: pa.Table) -> pa.Table:
    """For each group with sets in the block: their shingles that are met again, with how often they are met."""
    if rows["block"][0].as_py() < 0:
        return _first_of_keys(rows)
    (places, group), counts, tokens = _of_steps(rows["places"]), _of_planes(rows["counts"]), _wide(rows["tokens"])
    entry = np.repeat(np.arange(len(places), dtype=np.int32), counts)
    order = np.argsort(tokens)
    tokens, entry = tokens[order], entry[order]
    del order
    cuts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    runs = np.diff(np.r_[cuts, len(tokens)])
    many = np.repeat(runs > 1, runs)
    tokens, entry, times = tokens[many], entry[many], np.repeat(runs[runs > 1], runs[runs > 1]).astype(np.uint32)
    del cuts, runs, many
    order = np.argsort(entry, kind="stable")
    tokens, entry, times = tokens[order], entry[order], times[order]
    names, out = rows["grp"].to_pylist(), [[], [], [], [], []]
    cuts = np.searchsorted(group[entry], np.arange(rows.num_rows + 1))
    for g, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        if hi > lo:
            at = np.flatnonzero(np.r_[True, entry[lo + 1 : hi] != entry[lo : hi - 1]])
            size = np.diff(np.r_[at, hi - lo])
            for column, value in zip(out, (names[g], _steps(places[entry[lo:hi][at]]), _planes(size), _narrow(tokens[lo:hi]), _planes(times[lo:hi]))):
                column.append(value)
    none = pa.array([b""] * len(out[0]), pa.binary())
    return pa.table([pa.array(out[0], pa.int64()), *[pa.array(x, pa.binary()) for x in out[1:4]], none, pa.array(out[4], pa.binary())], ["grp", "places", "counts", "tokens", "keys", "times"])


def _first_of_keys(rows: pa.Table) -> pa.Table:
    """The keys and sizes of the sets that each group is the first to have; ``times`` is how many groups have them."""
    (places, group), sizes, keys = _of_steps(rows["places"]), _of_planes(rows["counts"]), _joined(rows["keys"], np.uint64).reshape(-1, 2)
    names = rows["grp"].to_numpy()
    order = np.lexsort((names[group], keys[:, 1], keys[:, 0]))
    cuts = np.flatnonzero(np.r_[True, (keys[order[1:]] != keys[order[:-1]]).any(1)])
    times = np.zeros(len(keys), np.int64)
    times[order[cuts]] = np.diff(np.r_[cuts, len(keys)])
    out: list[list] = [[], [], [], [], []]
    ends = np.searchsorted(group, np.arange(rows.num_rows + 1))
    for g, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
        at = lo + np.flatnonzero(times[lo:hi])
        if len(at):
            for column, value in zip(out, (names[g], _steps(places[at]), _planes(sizes[at]), keys[at].tobytes(), _planes(times[at]))):
                column.append(value)
    none = pa.array([b""] * len(out[0]), pa.binary())
    return pa.table([pa.array(out[0], pa.int64()), *[pa.array(x, pa.binary()) for x in out[1:3]], none, *[pa.array(x, pa.binary()) for x in out[3:]]], ["grp", "places", "counts", "tokens", "keys", "times"])


def _by_set(rows: pa.Table) -> pa.Table:
    """One row per set that may link, in the first group that has it: its shared shingles of all blocks, ascending.

    All groups that have a set have all its shingles, so those that are met in no other group are its own.
    """
    blank = pc.equal(pc.binary_length(rows["tokens"]), 0)
    described, rows = rows.filter(blank), rows.filter(pc.invert(blank))
    names, n, copies = _joined(described["keys"], "V16"), _of_planes(described["counts"]).astype(np.int64), _of_planes(described["times"])
    first, places = _of_steps(described["places"])[0], _of_steps(rows["places"])[0]
    place = np.full(1 + max(first.max(initial=-1), places.max(initial=-1)), -1)
    place[first] = np.arange(len(first))
    owner = np.repeat(place[places], _of_planes(rows["counts"]))
    tokens, sets = _wide(rows["tokens"]), _of_planes(rows["times"])
    shared = owner >= 0
    shared[shared] = sets[shared] > copies[owner[shared]]
    owner, tokens, sets = owner[shared], tokens[shared], sets[shared]
    order = np.lexsort((tokens, owner))
    tokens, sets = tokens[order], sets[order]
    cuts = np.searchsorted(owner[order], np.arange(len(names) + 1))
    some = np.flatnonzero(np.diff(cuts) >= least_overlap(n))
    ends = [(cuts[i], cuts[i + 1]) for i in some]
    return pa.table({
        "set_key": pa.array([names[i].tobytes() for i in some], pa.binary()),
        "core": pa.array([_key(tokens[a:b]) for a, b in ends], pa.binary()),
        "n": pa.array(n[some], pa.int64()),
        "n_shared": pa.array(np.diff(cuts)[some], pa.int64()),
        "tokens": pa.array([tokens[a:b].tobytes() for a, b in ends], pa.binary()),
        "sets": pa.array([sets[a:b].tobytes() for a, b in ends], pa.binary()),
    })


def candidates(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets that may link at all: set_key, core (key of the shared shingles), n, n_shared, tokens (ascending) and sets (times met)."""
    total, n = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("set_key")).first()
    blocks, key_blocks = max(1, -(-int(total) // BLOCK_TOKENS)), max(1, -(-n // BLOCK_KEYS))
    met_again = _dealt(docs, blocks, key_blocks).groupBy("block").applyInArrow(_met_in_block, f"{_BLOCK}, times binary")
    return met_again.groupBy("grp").applyInArrow(_by_set, "set_key binary, core binary, n long, n_shared long, tokens binary, sets binary")


def _prefix(tokens: np.ndarray, sets: np.ndarray, n: int, order: int) -> np.ndarray:
    """Places of the prefix tokens under global order (times met, hash of that order).

    A set's shingles of its own are met as often as the set, all others more often: the former come first in
    every order; they can't be shared and are left out.
    """
    size = len(tokens) - least_overlap(n) + 1
    return np.lexsort((mix(tokens * _ODD[order] + np.uint64(order)), sets))[:size]


def _set_of(tokens: bytes, sets: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(tokens, np.uint64), np.frombuffer(sets, np.uint32)


def _first_prefixes(alive: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, tokens = [], []
            for row in batch.to_pylist():
                t, s = _set_of(row["tokens"], row["sets"])
                nodes.append(row["node"])
                tokens.append(t[_prefix(t, s, row["n"], 0)].view(np.int64))
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, tokens)]).astype(np.int32), np.concatenate(tokens)) if tokens else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), lists], ["node", "prefix"])

    rows = alive.select(F.xxhash64("set_key").alias("node"), "n", "tokens", "sets")
    return rows.mapInArrow(run, "node long, prefix array<long>").select("node", F.explode("prefix").alias("token"))


def pools(alive: DataFrame) -> DataFrame:
    """(set_key, pool): sets that share a prefix token of the first order, transitively.

    Sets go by a 64-bit hash of their key here; two of one hash come into one pool, where all sets are compared anyway.
    """
    rows = _first_prefixes(alive)
    most = alive.agg(F.sum(F.col("n") / 5 + 1).cast("long")).first()[0] or 0
    heads = rows.groupBy("token").agg(F.min("node").alias("head"), F.count("*").alias("k")).where(F.col("k") > 1)
    roots = components(met(rows, heads, "token", most).select(F.col("node").alias("a"), F.col("head").alias("b")))
    return alive.select("set_key", F.xxhash64("set_key").alias("node")).join(roots, "node").select("set_key", F.col("root").alias("pool"))


class _Members:
    """Sets of a chunk with postings of all their tokens and of the prefixes of every order."""

    def __init__(self, rows: pa.Table):
        self.keys, self.labels = rows["set_key"].to_pylist(), rows["label"].to_pylist()
        self.n = np.array(rows["n"].to_pylist(), np.int64)
        both = [_set_of(t, s) for t, s in zip(rows["tokens"].to_pylist(), rows["sets"].to_pylist())]
        self.tokens = [t for t, _ in both]
        self.prefixes = [[t[_prefix(t, s, int(n), k)] for (t, s), n in zip(both, self.n)] for k in range(ORDERS)]
        self.all = self._postings(self.tokens)
        self.first = [self._postings(x) for x in self.prefixes]

    @staticmethod
    def _postings(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        by = np.argsort(every, kind="stable")
        return every[by], owner[by]

    def hits(self, postings: tuple[np.ndarray, np.ndarray], tokens: np.ndarray) -> np.ndarray:
        """For each member, how many of ``tokens`` it has."""
        every, owner = postings
        lo, hi = np.searchsorted(every, tokens, "left"), np.searchsorted(every, tokens, "right")
        size = hi - lo
        at = np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        return np.bincount(owner[at], minlength=len(self.keys))

    def linked(self, tokens: np.ndarray, prefixes: list[np.ndarray], n: int, open_: np.ndarray) -> np.ndarray:
        """The members, among those marked in ``open_``, that link with the given set."""
        where = open_ & (100 * self.n >= PERCENT * n) & (100 * n >= PERCENT * self.n)
        for postings, prefix in zip(self.first, prefixes):
            if not where.any():
                break
            where &= self.hits(postings, prefix) > 0
        if not where.any():
            return np.zeros(0, np.int64)
        both = self.hits(self.all, tokens)
        return np.flatnonzero(where & (100 * both >= PERCENT * (self.n + n - both)))


_OUT = "a binary, b binary"


def _within(rows: pa.Table) -> pa.Table:
    """One row per set of a chunk: a is the set, b the smallest set of its component here."""
    m = _Members(rows)
    root = np.arange(len(m.keys))
    for i in range(len(m.keys)):
        for j in m.linked(m.tokens[i], [p[i] for p in m.prefixes], int(m.n[i]), root != root[i]):
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
    least: dict[int, bytes] = {}
    for r, k in zip(root, m.keys):
        least[r] = min(least.get(r, k), k)
    return pa.table({"a": pa.array(m.keys, pa.binary()), "b": pa.array([least[r] for r in root], pa.binary())})


def _across(members: pa.Table, probes: pa.Table) -> pa.Table:
    """Edges between labels (a of a probe, b of a member) that a link connects; each at most once."""
    edges: dict[tuple[bytes, bytes], None] = {}
    if members.num_rows and probes.num_rows:
        m, q = _Members(members), _Members(probes.rename_columns([c.removeprefix("probe_") for c in probes.column_names]))
        labels = np.array(m.labels, object)
        for i in range(len(q.keys)):
            open_ = labels != q.labels[i]
            for j in m.linked(q.tokens[i], [p[i] for p in q.prefixes], int(q.n[i]), open_):
                edges[q.labels[i], m.labels[j]] = None
    return pa.table({"a": pa.array([a for a, _ in edges], pa.binary()), "b": pa.array([b for _, b in edges], pa.binary())})


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after the components of ``edges`` between labels."""
    roots = components(edges)
    return labels.join(roots, F.col("label") == F.col("node"), "left").withColumn("label", F.coalesce("root", "label")).drop("node", "root")


def linked_sets(alive: DataFrame) -> DataFrame:
    """(set_key, label) of the candidates: equal labels mean one component."""
    classes = stored(alive.groupBy("core", "n").agg(F.min("set_key").alias("first"), F.count("*").alias("k"), F.max("n_shared").alias("n_shared")), "classes")
    firsts = stored(alive.join(classes.select(F.col("first").alias("set_key")), "set_key", "left_semi"), "firsts")
    labels = stored(linked_classes(firsts), "labels")
    size = labels.groupBy("label").agg(F.count("*").alias("together")).withColumn("k", F.col("together"))
    sized = met(labels, size, "label", firsts.count()).withColumnRenamed("set_key", "first")
    # A class that links with another is one component; alone, it is one if its own sets link with each other.
    own = 100 * F.col("n_shared") >= PERCENT * (2 * F.col("n") - F.col("n_shared"))
    decided = classes.join(sized, "first", "left")
    decided = decided.select("core", "n", "k", F.coalesce("label", "first").alias("label"), (own | (F.coalesce("together", F.lit(1)) > 1)).alias("one"))
    decided = stored(decided.withColumn("class", F.struct("core", "n")).select("class", "k", "label", "one"), "decided")
    members = alive.select("set_key", F.struct("core", "n").alias("class"))
    return met(members, decided, "class", alive.count()).select("set_key", F.when(F.col("one"), F.col("label")).otherwise(F.col("set_key")).alias("label"))


def linked_classes(alive: DataFrame) -> DataFrame:
    """(set_key, label) of sets that no other has both shared shingles and size of."""
    pool = stored(pools(alive), "pools")
    sizes = pool.groupBy("pool").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    placed = pool.join(sizes, "pool").withColumn("chunk", F.pmod(F.xxhash64("set_key"), F.col("chunks")).cast("int"))
    rows = alive.join(placed, "set_key")
    local = rows.withColumn("label", F.col("set_key")).groupBy("pool", "chunk").applyInArrow(_within, _OUT)
    labels = stored(local.select(F.col("a").alias("set_key"), F.col("b").alias("label")).join(placed, "set_key"), "labels")

    large = labels.where(F.col("chunks") > 1)
    if not large.take(1):
        return labels.select("set_key", "label")
    pivot = F.pmod(F.xxhash64("set_key", F.lit(1)), F.col("chunks") * max(1, CHUNK // PIVOTS)) == 0
    tied = _compared(alive, large, large.where(pivot).withColumn("part", F.lit(0)), large.select("pool", F.lit(1).alias("parts")).distinct())
    large = stored(_merged(large, tied), "labels")

    by_label = large.groupBy("pool", "label").agg(F.count("*").alias("k"))
    main = by_label.groupBy("pool").agg(F.max_by("label", "k").alias("main"))
    probes = large.join(main, "pool").where(F.col("label") != F.col("main")).drop("main")
    parts = probes.groupBy("pool").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    probes = probes.join(parts, "pool").withColumn("part", F.pmod(F.xxhash64("set_key", F.lit(2)), F.col("parts")).cast("int")).drop("parts")
    large = _merged(large, _compared(alive, large, probes, parts))
    return labels.where(F.col("chunks") == 1).select("set_key", "label").unionByName(large.select("set_key", "label"))


def _compared(alive: DataFrame, members: DataFrame, probes: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges between labels: each chunk of a pool against each part of the pool's probes."""
    left = members.join(parts, "pool").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = probes.drop("chunk").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    keep = ("pool", "chunk", "part", "set_key", "label", "n", "tokens", "sets")
    left = left.join(alive, "set_key").select(*keep)
    right = right.join(alive, "set_key").select(*[F.col(c).alias(f"probe_{c}") for c in keep])
    return left.groupBy("pool", "chunk", "part").cogroup(right.groupBy("probe_pool", "probe_chunk", "probe_part")).applyInArrow(_across, _OUT)


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``described`` and (set_key, label) of the sets that may link."""
    sets = stored(described(docs), "sets")
    return sets, stored(linked_sets(stored(candidates(docs, sets), "alive")), "linked")


def similar(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    sets, labels = grouped(docs)
    some = sets.where(F.col("set_key").isNotNull())
    first = some.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("k"))
    tied = stored(first.join(labels, "set_key", "left").withColumn("label", F.coalesce("label", "set_key")), "tied")
    least = tied.groupBy("label").agg(F.min("first").alias("least"), F.count("*").alias("k"))
    n, n_rows = tied.count(), sets.count()
    owner = stored(met(tied.select("set_key", "label", F.col("k").alias("copies")), least, "label", n).select("set_key", F.col("least").alias("owner"), F.col("copies").alias("k")), "owner")
    # Empty sets link with nothing; they take no part in the join.
    named = met(some, owner, "set_key", n_rows).select("doc_id", "n_shingles", F.coalesce("owner", "doc_id").alias("component_id"))
    return named.unionByName(sets.where(F.col("set_key").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: the one with the smallest id (null ids last), then the smallest MD5 of its text.

    Rows are told apart by id and text, so an id that several texts have is decided text by text, and of rows that
    agree in both one stays. Rows with an empty set link with nothing and stay.
    """
    sets, labels = grouped(docs.select("doc_id", "text"))
    rows = sets.where(F.col("set_key").isNotNull()).groupBy("doc_id", "digest", "set_key").agg(F.count("*").alias("same"))
    rows = stored(rows.join(labels, "set_key", "left").withColumn("label", F.coalesce("label", "set_key")), "rows")
    order = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "digest")
    best = rows.groupBy("label").agg(F.min(order).alias("best"), F.count("*").alias("k"))
    stays = order.eqNullSafe(F.col("best"))
    decided = met(rows, best, "label", rows.count()).where(~stays | (F.col("same") > 1))
    decided = stored(decided.select(F.col("doc_id").alias("row_id"), F.col("digest").alias("row_digest"), stays.alias("once")), "decided")
    many = decided.where("once")
    # Few rows have an equal one; then only rows that may be decided are shuffled, once, for all other decisions.
    many = F.broadcast(many) if many.count() <= MOST_HUBS else many
    mark = "digest"
    while mark in docs.columns:
        mark += "_"
    bits = f"{mark}_bits"
    held = _bits_of(decided, bits)

    def this(side: DataFrame) -> Column:
        return docs["doc_id"].cast("long").eqNullSafe(side["row_id"]) & (_digest(docs["text"]) == side["row_digest"])

    may = _bit_set(F.col(bits), F.xxhash64(docs["doc_id"].cast("long"), _digest(docs["text"])))
    # A row whose bits are not set is surely not decided: it stays where it is.
    untouched, some = docs.join(held, may, "left_anti"), docs.join(held, may, "left_semi")
    left = some.join(decided, this(decided), "left_anti")
    again = docs.join(many, this(many), "left_semi").withColumn(mark, _digest(docs["text"]))
    return untouched.unionByName(left).unionByName(again.dropDuplicates(["doc_id", mark]).drop(mark))


def _places(key: Column, words: int) -> list[tuple[Column, Column]]:
    """(word, bit) of each probe of a 64-bit hash."""
    parts = [F.shiftrightunsigned(key, 32 * k) for k in range(_PROBES)]
    return [(F.shiftrightunsigned(p, 6).bitwiseAND(F.lit(words - 1)).cast("int"), p.bitwiseAND(F.lit(63)).cast("int")) for p in parts]


def _bits_of(rows: DataFrame, name: str) -> DataFrame:
    """One row, broadcast: a Bloom filter of (row_id, row_digest), as slices of 64-bit words.

    It has ``MOST_WORDS`` words however many rows there are; over about four million rows more keys that it doesn't
    hold pass, which costs a shuffle of these and nothing else.
    """
    spark = rows.sparkSession
    words = min(MOST_WORDS, max(SLICE_WORDS, 1 << (max(1, rows.count() * ROW_BITS // 64) - 1).bit_length()))
    probes = F.array(*[F.struct(w.alias("word"), F.expr("1L").alias("one"), b.alias("bit")) for w, b in _places(F.col("key"), words)])
    ones = rows.select(F.xxhash64("row_id", "row_digest").alias("key")).select(F.explode(probes).alias("p"))
    ones = ones.select("p.word", F.call_function("shiftleft", "p.one", "p.bit").alias("bits"))
    blank = spark.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = ones.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))

    def in_order(by: str, value: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(by, value))), lambda x: x[value])

    slices = whole.groupBy(F.shiftright("word", SLICE_WORDS.bit_length() - 1).alias("slice")).agg(in_order("word", "bits").alias("words"))
    return F.broadcast(stored(slices.agg(in_order("slice", "words").alias(name)), "filter"))


def _bit_set(bits: Column, key: Column) -> Column:
    """Whether a Bloom filter of ``_bits_of`` may hold a key."""
    words = F.size(bits) * SLICE_WORDS
    found = [F.call_function("getbit", bits[F.shiftright(w, SLICE_WORDS.bit_length() - 1)][w.bitwiseAND(F.lit(SLICE_WORDS - 1))], b) == 1 for w, b in _places(key, words)]
    return found[0] & found[1]
