"""Byte-level BPE and token records against the public tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from codelake.llm import byte_bpe, queries, records
from codelake.llm.common import new_folder
from pyspark.sql import functions as F
from tokenizers import Tokenizer

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    data = open(RANKS, "rb").read()
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(data), special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(MODEL)
    found.encode_special_tokens = True
    return found


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_op1(spark, texts, library):
    rows = queries.op1_byte_bpe(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(packed(ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (50, 24), (4096, 256)])
def test_small_chunks(docs, texts, library, chunk, overlap):
    some = docs.where("doc_id < 120")
    for r in byte_bpe.encode(some, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap).collect():
        assert bytes(r["ids"]) == packed(library.encode_ordinary(texts[r["doc_id"]]))


def test_odd_texts(odd, library):
    rows = byte_bpe.decode(byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN, chunk=512, overlap=64), RANKS).collect()
    found = sorted((repr(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in rows)
    wanted = sorted((repr(r["doc_id"]), packed(library.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in odd.collect())
    assert found == wanted


def test_boundaries_in_white_space(spark, library):
    random.seed(3)
    words = ["a", "bc", "it's", "  ", "\n\n", " \n ", "12", "é!", "we'll", "\t", "日本", "..."]
    values = [(i, "".join(random.choice(words) + random.choice(["", " "]) for _ in range(random.randrange(80)))) for i in range(300)]
    df = spark.createDataFrame(values, "doc_id long, text string")
    for r in byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, chunk=40, overlap=20).collect():
        assert bytes(r["ids"]) == packed(library.encode_ordinary(values[r["doc_id"]][1])), values[r["doc_id"]]


def test_long_pre_token(library):
    code = byte_bpe.encoder(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    text = "ab" * 3000 + " " * 5000 + "é" * 5000
    assert code(text) == packed(library.encode_ordinary(text))


def test_ids_array(odd):
    rows = byte_bpe.ids_array(byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)).where("doc_id = 10").collect()
    assert len(rows) == 1 and all(isinstance(i, int) for i in rows[0]["ids"])


def test_empty(nothing):
    assert byte_bpe.decode(byte_bpe.encode(nothing, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0
    assert records.token_records(nothing, MODEL, 2).count() == 0


def test_files_by_number(spark):
    names = [f"part-{n:05d}-a-c000.txt" for n in (2, 99_999, 100_000, 100_001, 1_000_000)]
    df = spark.createDataFrame([(name, 10 ** i) for i, name in enumerate(names)], "file string, tokens long")
    before = {r["file"]: r["before"] for r in records.files_in_turn(df).collect()}
    assert [before[name] for name in names] == [0, 1, 11, 111, 1111]


def test_one_key_fills_several_files(spark):
    values = [(7 if i % 2 else i, f"text {i} of many") for i in range(4000)]
    df = spark.createDataFrame(values, "doc_id long, text string").repartition(5)
    folders = [new_folder(spark, "records") for _ in range(2)]
    rows = [records.token_records(df.repartition(3 + i), MODEL, 2, folder=folder).collect() for i, folder in enumerate(folders)]
    assert sorted(rows[0]) == sorted(rows[1]) and len(rows[0]) == 4000
    index = spark.read.parquet(f"{folders[0]}/index")
    assert index.where("doc_id = 7").select("file").distinct().count() >= 3
    turn = index.orderBy("start").collect()
    assert [r["doc_id"] for r in turn] == sorted(r["doc_id"] for r in turn)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(turn, turn[1:]))


def test_op8(spark, texts, tokenizer):
    rows = sorted(queries.op8_token_records(spark, "/root/testdata/sf0.01").collect(), key=lambda r: r["doc_id"])
    start = 0
    assert [r["doc_id"] for r in rows] == sorted(texts)
    for r in rows:
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)


def test_odd_records(spark, odd, tokenizer):
    folder = new_folder(spark, "test-records")
    records.write_records(odd, folder, MODEL, 2, file_bytes=100_000)
    index = records.write_index(spark, folder)
    found = sorted((repr(r["doc_id"]), bytes(r["ids"])) for r in records.read_records(spark, folder).collect())
    wanted = sorted((repr(r["doc_id"]), packed([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2])) for r in odd.collect())
    assert found == wanted
    some = records.read_records(spark, folder, index.where("doc_id = 9 or doc_id = -8").orderBy(F.rand(1)))
    assert {r["doc_id"] for r in some.collect()} == {9, -8}


def test_wide_ids_and_damage():
    data = records.frame(None, np.array([1, 70_000], "<u4")) + b"\n" + records.frame(-5, np.array([3], "<u4")) + b"\n"
    key, ids, after = records.parse(data, 0)
    assert key is None and ids.tolist() == [1, 70_000]
    assert records.parse(data, after)[0] == -5
    with pytest.raises(ValueError):
        records.parse(data[:14] + b"\x07" + data[15:], 0)


def test_piecewise(tokenizer):
    code, odd = records.piecewise(open(MODEL).read()), [
        "", " ", "a  b   c", "it's x.\ny. ", "don't. ... x!", " lead", "trail ", "\x1c a \x1d b", "<|endoftext|> a", "é. É, 日本 a"]
    for text in odd:
        assert code(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_added_tokens(spark):
    """Ids are those of the tokenizer as loaded, with nothing switched."""
    unaltered = Tokenizer.from_file(MODEL)
    values = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  z <|endoftext|>", "a <|endof text|> b", "plain words.", ""]))
    assert unaltered.encode(values[0][1], add_special_tokens=False).ids == [64, 220, 50256, 275]
    rows = sorted(records.token_records(spark.createDataFrame(values, "doc_id long, text string"), MODEL, 2).collect())
    start = 0
    for r, (i, text) in zip(rows, values, strict=True):
        ids = [*unaltered.encode(text, add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
