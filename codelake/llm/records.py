"""Token ids as length-delimited binary records, with a separate offset index."""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from codelake.llm.common import map_batches, new_folder, texts_of

#: Pieces between blanks, and single pre-tokens, that a task remembers the ids of: some 200 bytes each.
PIECES, TOKENS = 300_000, 500_000
SAFE_BLANK = re.compile(r"(?<![\s\x1c-\x1f]) (?![\s\x1c-\x1f])")
UNSAFE_BLANK = re.compile(r"[\s\x1c-\x1f] | [\s\x1c-\x1f]|\A | \Z")
#: What an ASCII text needs to have for a blank to be unsafe, but for one at either end.
UNSAFE_PAIRS = ["  ", *[p for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f" for p in (" " + c, c + " ")]]


def byte_names() -> dict[int, int]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for characters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + i for i, b in enumerate(hidden)}


BYTE_NAMES = byte_names()
BLANK_NAME = chr(BYTE_NAMES[ord(" ")])
#: Marks that make one pre-token where they follow a word.
MARKS = ".,!?;:|&%$#*"
#: Bytes of text that one record file is made from, at most by plan.
FILE_BYTES = 64 << 20
#: A record: payload length (8 bytes), masked checksum of these 8 bytes (4), payload, masked checksum of the payload (4),
#: and a line feed that Spark's text writer sets. Payload: flags (1), document id (8), ids of 2 or 4 bytes each.
HEAD, TAIL, PAYLOAD, MASK = "<QI", "<I", "<Bq", 0xA282EAD8
WIDE, NO_KEY = 1, 2


def masked(data: bytes) -> int:
    """CRC-32, turned right by 15 bits and shifted by a constant, so that checksums of checksums stay apart."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(key: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    payload = struct.pack(PAYLOAD, WIDE * wide | NO_KEY * (key is None), key or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(TAIL, masked(length)) + payload + struct.pack(TAIL, masked(payload))


def parse(data: bytes, at: int) -> tuple[int | None, np.ndarray, int]:
    """The record at an offset: key, ids, and the offset of the next one. Wrong checksums are errors."""
    length, check = struct.unpack_from(HEAD, data, at)
    payload = data[at + 12:at + 12 + length]
    if check != masked(data[at:at + 8]) or struct.unpack_from(TAIL, data, at + 12 + length)[0] != masked(payload):
        raise ValueError(f"damaged record at byte {at}")
    flags, key = struct.unpack_from(PAYLOAD, payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=struct.calcsize(PAYLOAD)).astype("<u4")
    return None if flags & NO_KEY else key, ids, at + 12 + length + 4 + 1


class Known(dict):
    """Text -> its ids as bytes, made by ``make`` when first met; at ``most`` short texts it forgets all."""

    def __init__(self, make, most):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, text):
        ids = self.make(text)
        if len(text) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[text] = ids
        return ids


@lru_cache(maxsize=2)
def piecewise(model: str):
    """Text without added tokens -> ids. A blank between two characters that are not white space always begins a pre-token, so the text is
    cut there; what the tokenizer makes of a piece, or of its letters and the marks after them, is remembered."""
    tokenizer = Tokenizer.from_str(model)
    tokenizer.encode_special_tokens = True

    def by_tokenizer(text):
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    by_model = tokenizer.model.tokenize

    def one_token(text):
        """A text that is one pre-token needs the model alone, whose alphabet has a character for each byte."""
        named = text.replace(" ", BLANK_NAME) if text.isascii() else text.encode().decode("latin-1").translate(BYTE_NAMES)
        return array("I", [t.id for t in by_model(named)]).tobytes()

    tokens = Known(one_token, TOKENS)

    def word(lead, text):
        """Letters and the marks after them are two pre-tokens; what else there may be is left to the tokenizer."""
        letters = text.rstrip(MARKS)
        if not letters.isalpha():
            return by_tokenizer(lead + text)
        return tokens[lead + letters] + tokens[text[len(letters):]] if len(letters) < len(text) else tokens[lead + letters]

    def after_blank(piece):
        if "\n" not in piece:
            return word(" ", piece)
        first, *lines = piece.split("\n")
        # a line feed between characters other than white space is a pre-token of its own
        if not first or not all(lines) or any(map(str.isspace, piece.replace("\n", ""))):
            return by_tokenizer(" " + piece)
        return word(" ", first) + b"".join(feed + word("", x) for x in lines)

    feed = by_tokenizer("\n")
    pieces = Known(after_blank, PIECES)

    def encode(text: str) -> np.ndarray:
        plain = text.isascii() and not any(map(text.__contains__, UNSAFE_PAIRS)) and text[:1] != " " != text[-1:]
        head, *rest = text.split(" ") if plain or not UNSAFE_BLANK.search(text) else SAFE_BLANK.split(text)
        return np.frombuffer(b"".join([by_tokenizer(head), *map(pieces.__getitem__, rest)]), "<u4")

    return encode


@lru_cache(maxsize=2)
def encoder(model: str):
    """Text -> ids as the tokenizer gives them as it is loaded: a text that holds an added token goes to it whole."""
    tokenizer, plain = Tokenizer.from_str(model), piecewise(model)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(text: str) -> np.ndarray:
        if any(map(text.__contains__, added)):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return plain(text)

    return encode


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
                  file_bytes: int = FILE_BYTES) -> None:
    """Encode texts and write them as records to ``folder``/records, in ascending key order over the files by number.

    Texts are dealt by ranges of the key and the text's hash, and sorted within them before they are encoded, so that ids never
    move, a key that many rows share fills several files, and reruns write rows that share a key in the same order. The files are
    written and committed by Spark's text writer, so any store that Spark writes to will do and lost tasks are
    repeated. The tokenizer must be byte-level with pre-tokens as in ``SAFE_BLANK``'s rule. Null texts count as
    empty and give a record of the end id alone; null keys come first and are marked in the record.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))

    def run(batch):
        encode, end = encoder(sent.value), np.array([end_id], "<u4")
        keys = batch.column("doc_id").to_pylist()
        yield {"frame": [frame(k, np.concatenate([encode(t), end])) for k, t in zip(keys, texts_of(batch))]}

    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    # a cast from binary keeps the bytes as they are, and the text writer writes them as they are
    map_batches(ordered, run, "frame binary").select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(f"{folder}/records")


def scanned(spark: SparkSession, folder: str) -> DataFrame:
    """Every record read from the files in turn: file, at, length, doc_id, n_tokens, ids_crc32, first.

    ``first`` is the number of ids before the record in its file; both checksums of each record are verified.
    """
    files = spark.read.format("binaryFile").load(f"{folder}/records").where("length > 0").select("path", "content")

    def run(batch):
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            data, at, first = data.as_py(), 0, 0
            out = {n: [] for n in ("file", "at", "length", "doc_id", "n_tokens", "ids_crc32", "first")}
            while at < len(data):
                key, ids, after = parse(data, at)
                for name, value in zip(out, (path.rpartition("/")[2], at, after - at, key, len(ids), zlib.crc32(ids.tobytes()), first)):
                    out[name].append(value)
                at, first = after, first + len(ids)
            yield out

    return map_batches(files, run, "file string,at long,length long,doc_id long,n_tokens long,ids_crc32 long,first long")


def files_in_turn(totals: DataFrame) -> DataFrame:
    """file and the ids ``before`` it, from (file, tokens), by the number in the writer's file names.

    Names alone would not do: they are padded to five digits, and sort otherwise from file 100,000 on.
    """
    number = F.regexp_extract("file", r"^part-([0-9]+)", 1).cast("long")
    turn = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("tokens").over(turn), F.lit(0)).alias("before"))


def write_index(spark: SparkSession, folder: str) -> DataFrame:
    """Write ``folder``/index (Parquet) from the record files: where each record is, and the ids before it in all files.

    The files' totals, one row each, are the only thing that is put in one order.
    """
    rows = scanned(spark, folder)
    rows.write.parquet(f"{folder}/scan")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/scan")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    index = rows.join(files_in_turn(totals), "file").select("file", "at", "length", "doc_id", "n_tokens", "ids_crc32", (F.col("first") + F.col("before")).alias("start"))
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index")


def read_records(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) by the index: all records, or those whose rows of the
    index are in ``wanted`` (file, at), in any order. Only the wanted bytes of a file go to Python."""
    index = spark.read.parquet(f"{folder}/index") if wanted is None else wanted
    files = spark.read.format("binaryFile").load(f"{folder}/records").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    parts = files.join(index.select("file", "at", "length"), "file").select(
        F.substring(F.col("content"), (F.col("at") + 1).cast("int"), F.col("length").cast("int")).alias("data"))

    def run(batch):
        found = [parse(d, 0) for d in batch.column("data").to_pylist()]
        yield {"doc_id": [f[0] for f in found], "ids": [f[1].tobytes() for f in found]}

    return map_batches(parts, run, "doc_id long,ids binary")


def token_records(docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
                  folder: str | None = None) -> DataFrame:
    """Write the records of ``docs`` and their index, read the files back: doc_id, start, n_tokens, ids_crc32.

    Rows with the same key are records of their own, in the order of their texts' hashes. Null and empty texts are the end
    id alone; null keys come first. An empty table writes no record and gives an empty result.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "records")
    write_records(docs, folder, tokenizer_path, end_id, key, text)
    return write_index(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
