import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from agendario.llm import bpe, packing
from agendario.llm.pieces import pieces, pretoken_pattern
from agendario.llm.shared import new_path

from . import cases

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_pieces_keep_pre_tokens(library, encoding):
    rng, pattern = random.Random(5), pretoken_pattern(public_tokenizers.PATTERN)
    letters = ["a", "b", " ", "\n", "  ", "\t", "\x1c", "\x85", " ", "é", "1", "'s", "'", "!", "　", "\0", "<|endoftext|>", "\r\n", " x", "日", "\U0001f600"]
    encoder = packing.Encoder(library.to_str())
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text, ids in zip(some, encoder.encode(some)):
        assert "".join(pieces(text)) == text
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert [i for p in pieces(text) for w in pattern.findall(p) for i in encoding.encode_ordinary(w)] == encoding.encode_ordinary(text), text


def test_special_strings_as_the_library_has_them(library):
    some = ["end <|endoftext|> of it", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", " x <|endoftext|>\n y"]
    as_text = Tokenizer.from_file(JSON)
    as_text.encode_special_tokens = True
    for encoder, expected in ((packing.Encoder(library.to_str()), library), (packing.Encoder(library.to_str(), True), as_text)):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some)]
        assert got == [expected.encode(x, add_special_tokens=False).ids for x in some]


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 32])
def test_bit_packing_and_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype("<u4")
    data = packing.pack(ids, bits)
    assert len(data) == (1001 * bits + 7) // 8
    assert (packing.unpack(data, bits, 0, 1001) == ids).all() and (packing.unpack(data, bits, 333, 100) == ids[333:433]).all()
    assert packing.unpack(data, bits, 1001, 0).tolist() == []


def test_files_read_back(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_IDS", 500)
    docs = cases.documents(spark)
    path = new_path(spark, "ids")
    packing.write(docs, path, JSON)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, packing.read(spark, path).collect()), key=lambda r: r[1]) == expected
    none = new_path(spark, "ids")
    packing.write(cases.empty(spark), none, JSON)
    assert packing.read(spark, none).collect() == []


def test_bpe_as_the_library(spark, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 9000)
    docs = cases.documents(spark)
    expected = []
    for r in docs.collect():
        ids, data = encoding.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()
        expected.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(data).hexdigest()))
    assert cases.rows_of(bpe.digests(docs, RANKS, public_tokenizers.PATTERN)) == sorted(expected, key=repr)
    first = bpe._blocks
    monkeypatch.setattr(bpe, "_blocks", lambda docs, pattern, places: first(docs if places else docs.where("doc_id <> 3"), pattern, places))
    with pytest.raises(Exception, match="reads of the documents differ"):
        bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    monkeypatch.setattr(bpe, "_blocks", first)
    whole = {r["doc_id"]: r for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    text = cases.texts()[3]
    assert whole[3]["ids"] == encoding.encode_ordinary(text) and bytes(whole[3]["decoded"]) == text.encode()
    assert bpe.digests(cases.empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []
