import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer, normalizers

from tickframe.llm import bpe, packing

RANKS = P.path("byte_bpe_50k.tiktoken")
ODD = ["", None, "a", "  two  spaces\n\n and\ttabs ", "it's we'll I'D 12 345", "naïve über   x\u0085y 漢字かな🙂🙂", "=" * 900, "\x1c\x1d a​b",
       "z" * 5000 + " " + "ab1" * 700, "<|endoftext|> in a text", "the the the", "the the the", "tail   "]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(3, ODD[3], "x"), (None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_matches_library(spark, docs):
    own = library()
    for r in bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS).collect():
        text = "no id" if r.doc_id is None else ODD[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == own.encode_ordinary(text)
        assert bytes(r.decoded).decode() == text and r.n_tokens == len(r.ids) // 4


def test_digests_of_corpus(spark):
    from tickframe.llm.queries import QUERIES

    own = library()
    text = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op6_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = own.encode_ordinary(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("bits", [1, 7, 11, 16, 17, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    packed = packing.pack(ids, bits)
    assert len(packed) == (1001 * bits + 7) // 8
    assert (packing.unpack(packed, bits, 0, 1001) == ids).all() and (packing.unpack(packed, bits, 37, 100) == ids[37:137]).all()


def test_token_file(spark, docs):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    path = packing.new_file(spark)
    packing.write_tokens(docs, P.path("byte_bpe_50k.json"), P.PATTERN, 2, path, block_ids=300)
    rows = packing.crc_of(packing.read_documents(spark, path)).orderBy("start").collect()
    whole = []
    for r in rows:
        text = "no id" if r.doc_id is None else ODD[r.doc_id] or ""
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (len(whole), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        whole += ids
    assert [r.doc_id for r in rows] == [None, 0, 1, 2, 3, 3, *range(4, len(ODD))]
    assert packing.read_ids(spark, path, 280, 900) == whole[280:1180]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, RANKS, P.PATTERN), RANKS).count() == 0
    path = packing.new_file(spark)
    packing.write_tokens(none, P.path("byte_bpe_50k.json"), P.PATTERN, 2, path)
    assert packing.read_documents(spark, path).count() == 0


def test_registered_token_file_of_corpus(spark):
    from tickframe.llm.queries import QUERIES

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    text = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    rows = {r.doc_id: r for r in QUERIES["op10_packed_tokens"](spark, "/root/testdata/sf0.001").collect()}
    assert sorted(rows) == sorted(text)
    start = 0
    for doc_id in sorted(text):
        ids = np.array([*t.encode(text[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        r = rows[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_words_by_merges_alone_equal_the_whole_chain(tmp_path):
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    words = ["", "é€🙂", "\x00\x7f", "퟿\U0010ffffÿÀ", "a" * 5000, " the", "\n\n", "漢字"]
    expected = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(words, add_special_tokens=False)]
    assert packing._byte_signs(path) is not None and packing._encoded(path, words) == expected
    t.normalizer = normalizers.Lowercase()
    t.save(str(tmp_path / "lower.json"))
    lower = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(["The", "ABC"], add_special_tokens=False)]
    assert packing._byte_signs(str(tmp_path / "lower.json")) is None
    assert packing._encoded(str(tmp_path / "lower.json"), ["The", "ABC"]) == lower


def test_kept_words_stay_bounded(monkeypatch):
    path = P.path("byte_bpe_50k.json")
    monkeypatch.setattr(packing, "KEPT_WORDS", 5)
    packing._tokenizer(path)[2].clear()
    expected = {w: packing._encoded(path, [w])[0] for w in "abcdefghijkl"}
    for words in ("abc", "cdefg", "chijkl", "abcdefghijkl"):
        assert packing._word_ids(path, list(words)) == [expected[w] for w in words]
        assert len(packing._tokenizer(path)[2]) <= 5
