"""Byte-level BPE: overlapping chunk encoding, and decoding by concatenating raw bytes."""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codelake.llm.common import map_batches, stored, texts_of

#: Code points of a chunk, and how far the next chunk's text reaches back into it.
CHUNK, OVERLAP = 32_768, 2_048
#: What may follow a pre-token's end and still change it: a contraction has three characters.
LOOK_AHEAD = 3
#: Texts with such a run may hold a pre-token so long that adjacent pairs must wait in a heap.
LONG_RUN = re.compile(r"\S{4096}|\s{4096}")


@lru_cache(maxsize=4)
def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank, leftmost first, is joined until none is left.

    Pairs wait in a heap, so that a long run without a boundary costs n log n.
    """
    if piece in ranks:
        return [ranks[piece]]
    ends = list(range(1, len(piece) + 1))  # the part from i ends before ends[i]
    before = list(range(-1, len(piece) - 1))

    def offer(i):
        j = ends[i]
        if j < len(piece) and (rank := ranks.get(piece[i:ends[j]])) is not None:
            return rank, i, j, ends[j]
        return None

    heap = [pair for i in range(len(piece)) if (pair := offer(i))]
    heapify(heap)
    alive = bytearray(b"\x01" * len(piece))
    while heap:
        _, i, j, end = heappop(heap)
        if not (alive[i] and ends[i] == j and j < len(piece) and alive[j] and ends[j] == end):
            continue
        ends[i], alive[j] = end, 0
        if end < len(piece):
            before[end] = i
        for k in (i, before[i]):
            if k >= 0 and (pair := offer(k)):
                heappush(heap, pair)
    ids, i = [], 0
    while i < len(piece):
        ids.append(ranks[piece[i:ends[i]]])
        i = ends[i]
    return ids


@lru_cache(maxsize=4)
def encoder(data: bytes, pattern: str):
    """Text -> ids. Pre-tokens of thousands of characters, which pairwise scans handle badly, are merged by the heap."""
    ranks = read_ranks(data)
    usual = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    find = regex.compile(pattern).findall

    def encode(text: str) -> bytes:
        if LONG_RUN.search(text):
            return np.array([i for t in find(text) for i in merged(t.encode("utf-8", "replace"), ranks)], "<u4").tobytes()
        return usual.encode_to_numpy(text).astype("<u4", copy=False).tobytes()

    return encode


@lru_cache(maxsize=4)
def decoder(data: bytes):
    """Ids (little-endian unsigned 32-bit) -> the bytes of all tokens, concatenated."""
    ranks = read_ranks(data)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)

    def decode(ids: bytes) -> bytes:
        known = np.frombuffer(ids, "<u4")
        size = sizes[known]
        place = np.cumsum(size) - size
        return flat[np.repeat(starts[known] - place, size) + np.arange(size.sum())].tobytes()

    return decode


def chunked(docs: DataFrame, size: int, overlap: int) -> DataFrame:
    """Rows (doc_row, doc_id, start, last, chunk): chunk texts start at multiples of ``size - overlap``."""
    step = size - overlap
    count = F.greatest(F.ceil((F.length("text") - overlap) / step), F.lit(1)).cast("int")
    places = docs.select("doc_row", "doc_id", "text", F.explode(F.sequence(F.lit(0), count - 1)).alias("nth"), count.alias("count"))
    return places.select("doc_row", "doc_id", (F.col("nth") * step).alias("start"), (F.col("nth") == F.col("count") - 1).alias("last"),
                         F.substring(F.col("text"), F.col("nth") * step + 1, F.lit(size)).alias("chunk"))


def stitched(chunks: DataFrame, pattern: str, size: int, overlap: int) -> DataFrame:
    """Rows (doc_row, doc_id, start, piece): texts cut at true pre-token boundaries.

    Each chunk is pre-tokenised on its own. Matching looks only forward, so two chunks that share a boundary agree from
    there on. The cut between neighbours is the first boundary that both have in their overlap, that follows a character
    other than white space, and that the earlier chunk's end cannot have moved. Neighbours without one (a
    pre-token longer than the overlap) stay together and are cut where the next ones resynchronise.
    """
    step = size - overlap

    def boundaries(batch):
        find, heads, tails = regex.compile(pattern), [], []
        for text, start, last in zip(texts_of(batch, "chunk"), batch.column("start").to_pylist(), batch.column("last").to_pylist()):
            ends = [m.end() for m in find.finditer(text)]
            ends = [e for e in ends if not text[e - 1].isspace()]
            heads.append([start + e for e in ends if start and e <= overlap])
            tails.append([] if last else [start + e for e in ends if step < e <= len(text) - LOOK_AHEAD])
        yield {"doc_row": batch.column("doc_row"), "start": batch.column("start"), "head": heads, "tail": tails}

    found = map_batches(chunks.select("doc_row", "start", "last", "chunk"), boundaries, "doc_row long,start int,head array<int>,tail array<int>")
    order = Window.partitionBy("doc_row").orderBy("start")
    common = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    cuts = found.select("doc_row", "start", common.alias("cut"))
    cuts = cuts.select("doc_row", "start", F.col("cut"), F.lag("cut").over(order).alias("from"))
    texts = chunks.join(cuts, ["doc_row", "start"])
    # a chunk adds its text from the cut before it (or the previous chunk's new part) up to its own cut
    begin = F.coalesce("from", F.when(F.col("start") > 0, F.col("start") + overlap), F.lit(0))
    end = F.coalesce("cut", F.col("start") + F.length("chunk"))
    parts = texts.select("doc_row", "doc_id", "start", F.col("from").isNotNull().cast("int").alias("new"),
                         F.substring("chunk", begin - F.col("start") + 1, end - begin).alias("part"))
    group = F.sum("new").over(order)
    joined = parts.withColumn("group", group).groupBy("doc_row", "doc_id", "group").agg(
        F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
    return joined.select("doc_row", "doc_id", F.col("group").alias("start"), F.concat_ws("", "parts.part").alias("piece"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ids (binary: little-endian unsigned 32-bit integers) of every whole text.

    Texts of up to ``chunk`` characters are one chunk and are encoded where they lie. Longer ones are cut into
    overlapping chunks that are pre-tokenised by different tasks, stitched where their boundaries resynchronise, encoded
    piece by piece, and only their ids are gathered. The rank file is read once by the driver and broadcast; its size is
    that of the vocabulary (checked: 64 MB at most).

    Null and empty texts have no ids. Keys may be null or repeat: rows are told apart by a number, not by the
    key. Lone surrogates become U+003F. An empty table gives an empty result.
    """
    data = ranks_file(docs, ranks_path)
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(batch):
        code = encoder(sent.value, pattern)
        yield {**{n: batch.column(n) for n in batch.schema.names if n != "piece"}, "ids": [code(t) for t in texts_of(batch, "piece")]}

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = map_batches(rows.where(F.length("text") <= chunk).select("doc_id", F.col("text").alias("piece")), run, "doc_id long,ids binary")
    long = stored(rows.where(F.length("text") > chunk).withColumn("doc_row", F.monotonically_increasing_id()), "bpe-long")
    if long.isEmpty():
        return short
    pieces = stitched(dealt(chunked(long, chunk, overlap)), pattern, chunk, overlap)
    coded = map_batches(pieces.repartition("doc_row", "start"), run, "doc_row long,doc_id long,start long,ids binary")
    whole = coded.groupBy("doc_row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "ids"))).alias("parts"))

    def join(batch):
        yield {"doc_id": batch.column("doc_id"), "ids": [b"".join(p) for p in batch.column("ids").to_pylist()]}

    ARRAYS = "doc_id long,ids binary"
    return short.unionAll(map_batches(whole.select("doc_id", F.col("parts.ids").alias("ids")), join, ARRAYS))


def dealt(chunks: DataFrame) -> DataFrame:
    """Chunks of one text on different tasks; stored, as boundaries and texts are both read from them."""
    return stored(chunks.repartition("doc_row", "start"), "bpe-chunks")


def ranks_file(docs: DataFrame, path: str) -> bytes:
    with open(path, "rb") as file:
        data = file.read()
    if len(data) > 64 << 20:
        raise ValueError("a rank file of more than 64 MB is no vocabulary to broadcast")
    return data


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of ``encoded`` and decoded (binary): the raw bytes of all ids, concatenated."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks_file(encoded, ranks_path))

    def run(batch):
        bytes_of = decoder(sent.value)
        yield {"doc_id": batch.column("doc_id"), "ids": batch.column("ids"),
               "decoded": [bytes_of(i) for i in batch.column("ids").to_pylist()]}

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long,ids binary,decoded binary")


def ids_array(encoded: DataFrame) -> DataFrame:
    """doc_id and ids as array<long>."""
    def run(batch):
        yield {"doc_id": batch.column("doc_id"), "ids": [np.frombuffer(i, "<u4").astype(np.int64) for i in batch.column("ids").to_pylist()]}

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long,ids array<long>")
