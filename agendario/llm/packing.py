"""Token-id output: fixed-width bit packing in blocks of whole documents.

File format: Parquet rows, one per block, written by Spark below one folder. Columns: ``shard``
(the task that wrote it; shards ascend with the ids' order), ``block`` (place in the shard),
``start`` (ids of the shard before it), ``bits``, ``n_ids``, ``doc_ids`` and ``n_tokens`` (of the
documents in it, in order) and ``payload``: id k occupies bits k*bits .. (k+1)*bits-1, least
significant bit first. ``unpack`` turns a payload, or any run of ids in it, into a numpy array
at once; ``start`` with the shards' totals gives random access.

Documents are dealt by ranges of doc_id before they are encoded, so only (doc_id, text) is
shuffled and each task writes its range in order. Pieces of text repeat, so each task encodes a piece once
and looks it up again in a table of at most ``MEMO`` entries.

Defined cases: null text counts as empty (only the end id); rows are ordered by (doc_id, text),
null ids first; repeated rows are each written; an empty table gives no rows; other columns
are ignored. The vocabulary travels from the driver as a broadcast value. The string of a special token inside
a text gives that token's id, as in the library unless ``special_as_text`` is set.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import pieces
from .shared import new_path, table

END_ID = 2
BLOCK_IDS = 1 << 16
MEMO = 2_000_000

_LOADED: dict = {}


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(each[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, n: int) -> np.ndarray:
    """Ids ``start`` .. ``start + n - 1`` of a payload."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n, start * bits // 8).astype("<u4")
    first, last = start * bits // 8, ((start + n) * bits + 7) // 8
    each = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first), bitorder="little")
    each = each[start * bits - first * 8 :][: n * bits].reshape(n, bits)
    full = np.zeros((n, 32), np.uint8)
    full[:, :bits] = each
    return np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, piece by piece through a bounded table.

    New pieces are encoded many to a string, one after another as they could stand in a text; their
    ids are told apart by the tokens' lengths in bytes.
    """

    JOINED = 512

    def __init__(self, vocabulary: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = special_as_text
        special = [] if special_as_text else sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        #: Strings that the library takes out of a text before it looks for pre-tokens.
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        # A token of a byte-level vocabulary has one character for each byte.
        size = self.tokenizer.get_vocab_size()
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        plain = [p for p in new if p[0] in " \n" and len(p) > 1 and not p[1].isspace() and not p[-1].isspace()]
        alone = list(set(new).difference(plain))
        for p, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.known[p] = np.array(e.ids, "<u4").tobytes()
        groups = [plain[k : k + self.JOINED] for k in range(0, len(plain), self.JOINED)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.cumsum([len(p.encode()) for p in group])
            at = [0, *np.searchsorted(np.cumsum(self.bytes[ids]), ends, "right").tolist()]
            data = ids.tobytes()
            for p, lo, hi in zip(group, at, at[1:]):
                self.known[p] = data[4 * lo : 4 * hi]

    def _cut(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return pieces(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*(pieces(text[at : m.start()]) if m.start() > at else []), m[0]]
            at = m.end()
        return out + (pieces(text[at:]) if at < len(text) else [])

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._cut(x) for x in texts]
        if len(self.known) > MEMO:
            self.known = {}
        known = self.known
        new = list(set().union(*cut).difference(known))
        if new:
            self._learn(new)
        return [b"".join(map(known.__getitem__, ps)) for ps in cut]


def _encoder(name: tuple, vocabulary) -> Encoder:
    """One encoder for a Python worker and vocabulary; it outlives tasks."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Encoder(vocabulary.value, name[1])
    return _LOADED[name]


_SCHEMA = "shard int, block int, start long, bits int, n_ids int, doc_ids array<long>, n_tokens array<long>, payload binary"


def write(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = END_ID, special_as_text: bool = False) -> None:
    """Encodes ``docs`` (doc_id, text) in ascending order of doc_id and writes the blocks to ``path``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        text = file.read()
    bits = bits_for(max(Tokenizer.from_str(text).get_vocab_size(), end_id + 1))
    vocabulary, name = spark.sparkContext.broadcast(text), (zlib.crc32(text.encode()), special_as_text)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(name, vocabulary), TaskContext.get().partitionId()
        held: list[tuple] = []
        state = {"block": 0, "start": 0, "held": 0}

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
            row = [[shard], [state["block"]], [state["start"]], [bits], [len(ids)], [[d for d, _ in held]], [[len(x) // 4 for _, x in held]], [pack(ids, bits)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            state["block"] += 1
            state["start"] += len(ids)
            state["held"] = 0
            held.clear()
            names = ["shard", "block", "start", "bits", "n_ids", "doc_ids", "n_tokens", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [x or "" for x in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    held.append((doc_id, ids + end))
                    state["held"] += len(ids) // 4 + 1
                    if state["held"] >= BLOCK_IDS:
                        yield flush()
        if held:
            yield flush()

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, _SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row in batch.to_pylist():
                at = 0
                for doc_id, n in zip(row["doc_ids"], row["n_tokens"]):
                    ids = unpack(row["payload"], row["bits"], at, n)
                    for column, value in zip(out, (row["shard"], doc_id, row["start"] + at, n, zlib.crc32(ids.tobytes()))):
                        column.append(value)
                    at += n
            kinds = [pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["shard", "doc_id", "offset", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema(_SCHEMA).parquet(path)
    per = blocks.groupBy("shard").agg(F.sum("n_ids").cast("long").alias("ids"))
    # One row per writing task: as many as the write had partitions.
    before = per.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    found = blocks.mapInArrow(run, "shard int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(before), "shard").select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "packed-ids")
    write(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path)
