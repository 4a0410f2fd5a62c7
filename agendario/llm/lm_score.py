"""Language-model scores: a word-count base for every text and a small causal attention model.

Documents whose crc32 of the id leaves 2 after division by 7 are held out; all others are learned from.

Base. Words are lower-cased (A-Z) runs without white space, and one end per document. Groups of
rows count their distinct words by 64-bit hash; the counts are added up over the corpus in blocks
dealt by hash, and each group gets the totals of its own words back. No word list of the corpus is
ever in one place.

Model (``attention``). Texts become subword ids. Their corpus-wide counts (at most one per entry of the
vocabulary) are the model's biases. It starts from ``WARM_DOCUMENTS`` documents on the driver; then every task of the
corpus trains a copy of it on all its learnable documents and the copies are averaged, weighted by
their tokens, so what is learned grows with the input. Every text is then scored whole, in overlapping windows.

Defined cases: null text counts as empty (only the end); a null id is learned from and not held out; repeated
rows are each returned; empty tables give no rows; with nothing to learn from, counts are 0 and the model is
untrained; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention
from .bpe import _encoding, read_ranks
from .shared import stored, table
from .wordhash import Words, mix, pieces, text_buffers

FOLDS, HELD_OUT = 7, 2
GROUP_ROWS = 1000
BLOCK_WORDS = 2_000_000
WARM_DOCUMENTS = 1500
RATE = 0.015
SLICES = 64
_END_WORD = mix(np.array([0xE0D], np.uint64))[0]

_GROUPS = "grp long, doc_ids array<long>, learned array<boolean>, n_words array<int>, slots binary, hashes binary, counts binary, sizes binary, ids binary"


def _learned(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS != HELD_OUT


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers as compressed byte planes."""
    return pa.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint32)
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()


def _blocks_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def grouped(docs: DataFrame, name: str, ranks, pattern: str, end: int) -> DataFrame:
    """Groups of rows with their words as slots of distinct hashes, and their subword ids."""

    def group(number: int, doc_ids: list, texts: pa.Array) -> pa.RecordBatch:
        raw, offs = text_buffers(texts)
        hashes, sizes = [], []
        for a, b in pieces(offs):
            words = Words(raw, offs[a : b + 1])
            at = words.doc_at
            hashes.append(np.insert(words.hash, at[1:], _END_WORD))
            sizes.append(np.diff(at) + 1)
        every, n = np.concatenate(hashes), np.concatenate(sizes)
        learned = np.array([_learned(d) for d in doc_ids])
        # Slots in the order of first sight: frequent words get small ones.
        slots, distinct = pd.factorize(every)
        counts = np.bincount(slots[np.repeat(learned, n)], minlength=len(distinct))
        encoding = _encoding(name, ranks, pattern)
        ids = [np.array([*encoding.encode_ordinary(x.as_py() or ""), end], "<u2") for x in texts]
        lengths = np.array([len(x) for x in ids], "<u4")
        flat = np.concatenate(ids)
        row = [[number], [doc_ids], [learned.tolist()], [n.tolist()], [_packed(slots)], [distinct.tobytes()], [counts.astype("<u4").tobytes()], [lengths.tobytes()], [flat.tobytes()]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], [x.split()[0] for x in _GROUPS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_ROWS):
                part = batch.slice(at, GROUP_ROWS)
                yield group(number, part.column(0).to_pylist(), part.column(1))
                number += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _GROUPS)


def word_totals(groups: DataFrame, blocks: int) -> DataFrame:
    """(grp, block, counts, words, known): the corpus counts of each group's words of a block, in slot order.

    ``words`` and ``known`` are the block's learned tokens and distinct words, on one row of each block.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["counts"], "<u4")
                block = _blocks_of(hashes, blocks)
                order = np.argsort(block, kind="stable")
                cuts = np.searchsorted(block[order], np.arange(blocks + 1))
                some = np.flatnonzero(np.diff(cuts))
                parts = [order[cuts[b] : cuts[b + 1]] for b in some]
                columns = [pa.array(some, pa.int64()), pa.array([row["grp"]] * len(some), pa.int64()), pa.array([hashes[p].tobytes() for p in parts], pa.binary()), pa.array([counts[p].tobytes() for p in parts], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "grp", "hashes", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x.as_py(), np.uint64) for x in rows["hashes"]]
        counts = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in rows["counts"]])
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, counts, len(distinct)).astype(np.int64)
        cuts = np.cumsum([0, *map(len, hashes)])
        n = rows.num_rows
        return pa.table({
            "grp": rows["grp"], "block": rows["block"],
            "counts": pa.array([total[place[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
            "words": pa.array([int(total.sum()), *[0] * (n - 1)], pa.int64()), "known": pa.array([int((total > 0).sum()), *[0] * (n - 1)], pa.int64()),
        })

    dealt = groups.select("grp", "hashes", "counts").mapInArrow(deal, "block long, grp long, hashes binary, counts binary")
    return dealt.groupBy("block").applyInArrow(add, "grp long, block long, counts binary, words long, known long")


def subword_counts(groups: DataFrame, vocabulary: int) -> np.ndarray:
    """Counts of all subword ids in the learned texts: at most ``vocabulary`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = np.frombuffer(row["ids"], "<u2"), np.frombuffer(row["sizes"], "<u4")
                n = np.bincount(ids[np.repeat(np.array(row["learned"], bool), lengths)], minlength=vocabulary)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some], pa.int64())], ["id", "n"])

    rows = groups.select("ids", "sizes", "learned").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(vocabulary)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def _texts(row: dict, keep) -> tuple[np.ndarray, np.ndarray]:
    """Ids and lengths of those texts of a group that are learned and kept."""
    lengths = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
    mask = np.array([ok and keep(d) for ok, d in zip(row["learned"], row["doc_ids"])], bool)
    return np.frombuffer(row["ids"], "<u2")[np.repeat(mask, lengths)].astype(np.int64), lengths[mask]


def trained(groups: DataFrame, vocabulary: int, end: int) -> attention.Model:
    """The model after its start on the driver and one averaged pass of all tasks."""
    spark = groups.sparkSession
    counts = subword_counts(groups, vocabulary)
    model = attention.Model(attention.initial(vocabulary), counts)
    rows = groups.select("doc_ids", "learned", "sizes", "ids")

    n_docs = groups.agg(F.sum(F.size("doc_ids"))).first()[0] or 0
    one_in = max(1, int(n_docs) // WARM_DOCUMENTS)

    def warm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = _texts(row, lambda d: zlib.crc32(f"warm {d}".encode()) % one_in == 0)
                cuts = np.cumsum(lengths)[:-1]
                texts = [x.astype("<u2").tobytes() for x in np.split(ids, cuts)] if len(lengths) else []
                keys = [zlib.crc32(t) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.binary())], ["k", "ids"])

    found = rows.mapInArrow(warm, "k long, ids binary").orderBy("k", "ids").limit(WARM_DOCUMENTS).collect()
    texts = [np.frombuffer(r["ids"], "<u2").astype(np.int64) for r in found]
    if texts:
        model.train(np.concatenate(texts), np.array([len(x) for x in texts]), end, RATE)
    shared = spark.sparkContext.broadcast((model.w, counts))
    names = sorted(model.w)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths = [], []
        for batch in batches:
            for row in batch.to_pylist():
                own, n = _texts(row, lambda d: True)
                ids.append(own.astype("<u2"))
                lengths.append(n)
        n = sum(map(len, ids))
        if n:
            weights, known = shared.value
            copy = attention.Model({k: x.copy() for k, x in weights.items()}, known)
            task = TaskContext.get().partitionId()
            copy.train(np.concatenate(ids), np.concatenate(lengths), end, RATE / 3, seed=task)
            # What it learned, not what it is: unseen ids stay 0 and cost little to send.
            flat = np.concatenate([(copy.w[k] - weights[k]).ravel() for k in names]).astype("<f4")
            parts = np.array_split(flat, SLICES)
            packed = [pa.compress(p.tobytes(), "zstd", asbytes=True) for p in parts]
            columns = [pa.array(range(SLICES), pa.int32()), pa.array([task] * SLICES, pa.int32()), pa.array([float(n)] * SLICES, pa.float64()), pa.array([len(p) for p in parts], pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "task", "n", "size", "w"])

    def mean(out: pa.Table) -> pa.Table:
        total, w = 0.0, 0.0
        size = out["size"][0].as_py()
        for n, x in zip(out["n"].to_pylist(), out["w"]):
            w = w + n * np.frombuffer(pa.decompress(x.as_py(), decompressed_size=4 * size, codec="zstd", asbytes=True), "<f4")
            total += n
        packed = pa.compress((w / total).astype("<f4").tobytes(), "zstd", asbytes=True)
        return pa.table({"slice": out["slice"].slice(0, 1), "n": pa.array([total]), "size": out["size"].slice(0, 1), "w": pa.array([packed], pa.binary())})

    copies = rows.mapInArrow(train, "slice int, task int, n double, size int, w binary")
    # In two steps, so that no task adds up the copies of all others.
    some = copies.groupBy("slice", F.pmod("task", F.lit(256)).alias("part")).applyInArrow(mean, "slice int, n double, size int, w binary")
    slices = some.groupBy("slice").applyInArrow(mean, "slice int, n double, size int, w binary").collect()
    if slices:
        flat = np.concatenate([np.frombuffer(pa.decompress(r["w"], decompressed_size=4 * r["size"], codec="zstd", asbytes=True), "<f4") for r in sorted(slices, key=lambda r: r["slice"])])
        at = 0
        for k in names:
            size = model.w[k].size
            model.w[k] = model.w[k] + flat[at : at + size].reshape(model.w[k].shape)
            at += size
        model.tables()
    return model


def scores(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    spark = docs.sparkSession
    known = read_ranks(vocabulary_path)
    end = max(known.values()) + 1
    ranks = spark.sparkContext.broadcast(known)
    name = hashlib.md5(vocabulary_path.encode()).hexdigest()
    groups = stored(grouped(docs, name, ranks, pattern, end), "groups", group_mb=8)

    distinct = groups.agg(F.sum(F.octet_length("hashes") / 8)).first()[0] or 0
    blocks = max(1, -(-int(distinct) // BLOCK_WORDS))
    totals = stored(word_totals(groups, blocks), "totals")
    words, types = totals.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    fitted = trained(groups, end + 1, end)
    shared = spark.sparkContext.broadcast((fitted.w, (fitted.b1, fitted.b2, fitted.b3)))

    def by_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        model = attention.Model(weights, np.zeros(end + 1))
        model.b1, model.b2, model.b3 = bias
        for batch in batches:
            out = []
            for size, flat in zip(batch.column("sizes"), batch.column("ids")):
                lengths = np.frombuffer(size.as_buffer(), "<u4").astype(np.int64)
                ids, at, each = np.frombuffer(flat.as_buffer(), "<u2"), np.r_[0, np.cumsum(lengths)], []
                for a in range(0, len(lengths), 64):
                    b = min(a + 64, len(lengths))
                    each += model.score(ids[at[a] : at[b]].astype(np.int64), lengths[a:b], end).tolist()
                out.append(each)
            keep = ["grp", "doc_ids", "n_words", "slots"]
            block = pa.array([_packed(_blocks_of(np.frombuffer(x.as_buffer(), np.uint64), blocks)) for x in batch.column("hashes")], pa.binary())
            types = pa.array([len(x.as_buffer()) // 8 for x in batch.column("hashes")], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], types, block, pa.array(out, pa.list_(pa.float64()))], [*keep, "types", "of_block", "lm"])

    def finish(rows: pa.Table, counts: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        by_block = counts.sort_by("block")["counts"].to_pylist()
        total = np.concatenate([np.frombuffer(c, np.int64) for c in by_block])
        for row in rows.to_pylist():
            own = np.empty(row["types"], np.int64)
            own[np.argsort(_unpacked(row["of_block"], row["types"]), kind="stable")] = total
            n = np.array(row["n_words"], np.int64)
            slots = _unpacked(row["slots"], int(n.sum()))
            at = np.cumsum(n) - n
            logs = np.add.reduceat(np.log10(own + 1.0)[slots], at)
            known = np.add.reduceat((own > 0)[slots].astype(np.int64), at)
            for column, value in zip(out, (row["doc_ids"], n.tolist(), known.tolist(), logs.tolist(), row["lm"])):
                column += value
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        return pa.table([pa.array(v, k) for v, k in zip(out, kinds)], ["doc_id", "n_tokens", "n_known", "logs", "score"])

    model_rows = groups.select("grp", "doc_ids", "n_words", "slots", "hashes", "sizes", "ids").mapInArrow(
        by_model, "grp long, doc_ids array<long>, n_words array<int>, slots binary, types long, of_block binary, lm array<double>"
    )
    back = totals.select(F.col("grp").alias("of"), "block", "counts")
    found = model_rows.groupBy("grp").cogroup(back.groupBy("of")).applyInArrow(finish, "doc_id long, n_tokens long, n_known long, logs double, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    return found.select(
        "doc_id",
        held.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(words)).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(words + types + 1)))).alias("base_score"),
        "score",
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scores(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
