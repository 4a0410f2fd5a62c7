"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are split into pre-tokens (words); within a block of whole documents every distinct word
gets a slot, and the documents become arrays of slots in word order: words exploded with their
positions, in compact form. Then

1. the (block, slot, word) rows are shuffled by word and sorted, so that each distinct word of the
   corpus is met in one task and encoded once, whatever the number of blocks that have it,
2. the ids are joined back to their blocks, where slots are replaced by ids by position, and
3. decoding joins ids with the token-byte table (bounded by the vocabulary, broadcast).

A word occurs at most once per block, so a very frequent word costs a row per block, not one per
occurrence. Blocks hold about ``BLOCK_CHARS`` characters, or one document where that is longer.

The documents are read twice (words, places), so ``docs`` must give the same rows in the same order
each time, as a table scan does; store it first where it is the result of a shuffle. A block is named by a digest of
its number and its words, and their number goes with it: where the two reads differ, the query fails.

Defined cases: null text counts as empty (no ids, the digest of nothing); repeated rows and ids are each
returned; an empty table gives no rows; other columns are ignored. Strings of special tokens inside
a text are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import pieces, pretoken_pattern
from .shared import table

BLOCK_CHARS = 32_000_000

_CODEC = "zstd"
_LOADED: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class _Slots:
    """Distinct words of a block, numbered as they are met, and its documents as slots in word order.

    Frequent words are met early and get small numbers, so the planes of their bytes compress well.
    """

    def __init__(self, pattern):
        self.find = pattern.findall
        self.slot: dict[str, int] = {}
        self.known: dict[str, bytes] = {}
        self.ids: list = []
        self.sizes: list[int] = []
        self.places: list[bytes] = []
        self.chars = 0

    def add(self, doc_id, text: str, places: bool) -> None:
        known, slot, cut = self.known, self.slot, pieces(text)
        for p in dict.fromkeys(cut):
            if p not in known:
                known[p] = array("I", [slot.setdefault(w, len(slot)) for w in self.find(p)]).tobytes()
        self.ids.append(doc_id)
        self.chars += len(text)
        if places:
            at = b"".join([known[p] for p in cut])
            self.places.append(at)
            self.sizes.append(len(at) // 4)

    def named(self, number: int) -> int:
        """The block's name: 63 bits of a digest of its number and its words in order."""
        digest = hashlib.blake2b(number.to_bytes(8, "little"), digest_size=8)
        digest.update("\0".join(self.slot).encode())
        return int.from_bytes(digest.digest(), "little") >> 1

    def words_row(self, block: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([list(self.slot)], pa.list_(pa.string()))], ["block", "words"])

    def places_row(self, block: int) -> pa.RecordBatch:
        every = np.frombuffer(b"".join(self.places), np.uint8)
        planes = pa.compress(every.reshape(-1, 4).T.tobytes(), _CODEC, asbytes=True)
        columns = [pa.array([block], pa.int64()), pa.array([len(self.slot)], pa.int64()), pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.sizes], pa.list_(pa.int32())), pa.array([planes], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["block", "n_slots", "doc_ids", "sizes", "places"])


def _blocks(docs: DataFrame, pattern: str, places: bool) -> DataFrame:
    """One row per block: its words, or its documents. Both number blocks and words alike, by the scan's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled, block = pretoken_pattern(pattern), TaskContext.get().partitionId() << 32
        now = _Slots(spelled)
        row = _Slots.places_row if places else _Slots.words_row
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    now.add(doc_id, text or "", places)
                    if now.chars >= BLOCK_CHARS:
                        yield row(now, now.named(block))
                        now, block = _Slots(spelled), block + 1
        if now.ids:
            yield row(now, now.named(block))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "block long, n_slots long, doc_ids array<long>, sizes array<int>, places binary" if places else "block long, words array<string>")


def _encoding(name: str, ranks, pattern: str):
    if name not in _LOADED:
        import tiktoken

        _LOADED.clear()
        _LOADED[name] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
    return _LOADED[name]


def _places(row: dict) -> np.ndarray:
    size = 4 * sum(row["sizes"])
    raw = pa.decompress(row["places"], decompressed_size=size, codec=_CODEC, asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def encode(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """doc_id, ids and decoded bytes of every row of ``docs`` (doc_id, text)."""

    def of(doc_id, decimal, data):
        return doc_id, [int(x) for x in ",".join(decimal).split(",") if x], b"".join(data)

    return _assembled(docs, vocabulary_path, pattern, "doc_id long, ids array<int>, decoded binary", of)


def digests(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs`` (doc_id, text)."""

    def of(doc_id, decimal, data):
        said, whole = ",".join(decimal), b"".join(data)
        return doc_id, said.count(",") + (said != ""), hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(whole).hexdigest()

    return _assembled(docs, vocabulary_path, pattern, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", of)


def _assembled(docs: DataFrame, vocabulary_path: str, pattern: str, schema: str, result) -> DataFrame:
    spark = docs.sparkSession
    known = read_ranks(vocabulary_path)
    ranks = spark.sparkContext.broadcast(known)
    name = hashlib.md5(repr(sorted(known.values())[-3:]).encode() + vocabulary_path.encode()).hexdigest()
    width = "H" if max(known.values(), default=0) < 1 << 16 else "I"
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    fields = [(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows of a word are in one task, next to each other: each word is encoded once."""
        encoding, last, ids = _encoding(name, ranks, pattern), None, b""
        for batch in batches:
            out = []
            for word in batch.column(2).to_pylist():
                if word != last:
                    last, ids = word, array(width, encoding.encode_ordinary(word))
                out.append(ids)
            # One row per block and batch, not per word: what goes back is little more than the ids.
            block, slots = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0, True]) if len(order) else np.zeros(1, int)
            rows: list[list] = [[], [], [], []]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                own = order[lo:hi]
                coded_ = [out[i] for i in own]
                for column, value in zip(rows, (int(block[own[0]]), slots[own].astype("<u4").tobytes(), array("I", map(len, coded_)).tobytes(), b"".join(coded_))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), *[pa.array(x, pa.binary()) for x in rows[1:]]], ["of_block", "slots", "sizes", "ids"])

    def assemble(ids: pa.Table, blocks: pa.Table) -> pa.Table:
        token = {v: k for k, v in ranks.value.items()}
        said = {i: str(i) for i in token}
        rows = ids.to_pylist()
        total = sum(len(r["slots"]) // 4 for r in rows)
        if [total] != blocks["n_slots"].to_pylist():
            raise RuntimeError("the two reads of the documents differ: store them first")
        decimal, data = [""] * total, [b""] * total
        for r in rows:
            at, flat = 0, memoryview(r["ids"]).cast(width).tolist()
            for s, n in zip(memoryview(r["slots"]).cast("I").tolist(), memoryview(r["sizes"]).cast("I").tolist()):
                own = flat[at : at + n]
                at += n
                decimal[s], data[s] = ",".join([said[i] for i in own]), b"".join([token[i] for i in own])
        out: list[tuple] = []
        for row in blocks.to_pylist():
            places, at = _places(row), 0
            for doc_id, n in zip(row["doc_ids"], row["sizes"]):
                own = places[at : at + n].tolist()
                at += n
                out.append(result(doc_id, [decimal[s] for s in own], [data[s] for s in own]))
        columns = list(zip(*out)) if out else [[] for _ in fields]
        return pa.table({f: pa.array(c, k) for (f, k), c in zip(fields, columns)})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = _blocks(docs, pattern, False).select(F.col("block").alias("of_block"), F.posexplode("words").alias("slot", "word"))
    back = words.repartition(parts, "word").sortWithinPartitions("word").mapInArrow(coded, "of_block long, slots binary, sizes binary, ids binary")
    held = _blocks(docs, pattern, True)
    return back.groupBy("of_block").cogroup(held.groupBy("block")).applyInArrow(assemble, schema)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of op4 for every row of ``docs``."""
    import public_tokenizers

    return digests(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
