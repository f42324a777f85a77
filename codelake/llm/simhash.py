"""SimHash near-dedup by anchor-point covering."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelake.llm.common import map_batches, segments, stored, texts_of
from codelake.llm.components import components, forest

#: Differing bits at which two fingerprints still link.
THRESHOLD = 4
#: First bit and bits of each block. Of at most 4 differing bits, one of three blocks has at most one.
BLOCKS = ((0, 21), (21, 21), (42, 22))
#: The first 15 bits of a block are covered by the Hamming code, whose 2048 words lie within 1 bit of everything.
CODED, RADIUS = 15, 1
SEED = 42
LANE = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, words: int = 4) -> np.ndarray:
    """XXH64 of each run of ``words`` words (fewer: of the whole sequence), A-Z in lower case."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(parts)
    if not parts:
        return np.empty(0, np.uint64)
    starts, ends = segments(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    n = max(len(parts) - words + 1, 1)
    last = ends[-n:] - 1
    hashed = xxhash.xxh64_intdigest
    return np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if more than half of the hashes have it. Bits are summed in byte lanes, 255 hashes at a time."""
    if not len(hashes):
        return 0
    cuts, bits = np.arange(0, len(hashes), 255), np.zeros(64, np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANE, cuts)
        bits[k::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i, n in enumerate(bits.tolist()) if 2 * n > len(hashes))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its 64-bit fingerprint, as a signed long. No words: zero."""
    def run(batch):
        prints = [majority(shingle_hashes(t)) for t in texts_of(batch)]
        yield {"doc_id": batch.column("doc_id"), "fingerprint": pa.array(np.array(prints, np.uint64).view(np.int64))}

    return map_batches(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), run, "doc_id long,fingerprint long")


def flips(block_bits: int, block_threshold: int = 1) -> list[list[int]]:
    """For each syndrome, what turns a block into every anchor within covering radius plus threshold.

    Anchors are the blocks whose first 15 bits are a word of the Hamming code. The first entry is the nearest one.
    """
    most = RADIUS + block_threshold
    found: list[list[int]] = [[] for _ in range(CODED + 1)]
    for size in range(most + 1):
        for chosen in combinations(range(block_bits), size):
            syndrome = 0
            for bit in chosen:
                syndrome ^= bit + 1 if bit < CODED else 0
            found[syndrome].append(sum(1 << bit for bit in chosen))
    return found


def parity_bit(word: Column, bit: int) -> Column:
    mask = sum(1 << place for place in range(CODED) if (place + 1) >> bit & 1)
    return F.bit_count(word.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1))


def replicated(prints: DataFrame) -> DataFrame:
    """Each fingerprint at every anchor within covering radius plus threshold of a block: fingerprint, anchor, home."""
    sides = []
    for number, (first, bits) in enumerate(BLOCKS):
        word = F.shiftrightunsigned("fingerprint", first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        syndrome = sum((F.shiftleft(parity_bit(word, b), b) for b in range(1, 4)), parity_bit(word, 0))
        table = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks]) for masks in flips(bits)])
        moved = F.get(table, syndrome.cast("int"))
        at = prints.select("fingerprint", word.alias("word"), F.posexplode(moved).alias("nth", "flip"))
        anchor = F.col("word").bitwiseXOR(F.col("flip")).bitwiseOR(F.lit(number << 22).cast("long"))
        sides.append(at.select("fingerprint", anchor.alias("anchor"), (F.col("nth") == 0).alias("home")))
    return sides[0].unionAll(sides[1]).unionAll(sides[2])


def anchor_links(members: DataFrame, threshold: int = THRESHOLD, cell_homes: int = 50_000) -> DataFrame:
    """Links found at the anchors, as (fingerprint, smaller linked fingerprint); a chain of them joins every linked pair.

    At an anchor the fingerprints at home there are compared with all that were sent there. An anchor with more
    than ``cell_homes`` of them deals them over cells that each see all its members. A cell holds its homes, members
    stream past them, and what is found in a step leaves as a spanning forest instead of all pairs.
    """
    crowds = stored(members.where("home").groupBy("anchor").agg(F.count("*").alias("homes")).where(F.col("homes") > cell_homes).select(
        F.col("anchor").alias("crowd"), F.ceil(F.col("homes") / cell_homes).cast("int").alias("cells")), "simhash-crowds")
    dealt = members.join(crowds, F.col("anchor") == F.col("crowd"), "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("cells")).cast("int")
    everywhere = dealt.select("fingerprint", "anchor", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
                              F.when(F.col("home"), own).alias("own"))
    rows = everywhere.select("fingerprint", "anchor", "cell", (F.col("own") == F.col("cell")).alias("home"))
    rows = rows.withColumn("home", F.coalesce("home", F.lit(False)))
    placed = rows.repartition("anchor", "cell").sortWithinPartitions("anchor", "cell", F.desc("home"))

    def run(batches):
        held_key, held = None, np.empty(0, np.uint64)
        for batch in batches:
            prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("anchor", "cell")], axis=1)
            home = batch.column("home").to_numpy(zero_copy_only=False).astype(bool)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(prints) else np.empty(0, np.int64)
            left, right = [], []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(prints)]):
                key, homes = tuple(keys[a]), prints[a:b][home[a:b]]
                if key == held_key:
                    held = np.concatenate([held, homes])
                else:
                    held_key, held = key, homes
                for x, y in near(held, prints[a:b], threshold):
                    left.append(x)
                    right.append(y)
            if left:
                child, root = forest(np.concatenate(left), np.concatenate(right))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(root.view(np.int64))], ["src", "dst"])

    return placed.mapInArrow(run, "src long, dst long").distinct()


def near(homes: np.ndarray, others: np.ndarray, threshold: int, step: int = 1 << 20):
    """Pairs within ``threshold`` bits, a block of the comparison matrix at a time."""
    if len(homes) and len(others) > 1:
        rows = max(1, step // len(others))
        for a in range(0, len(homes), rows):
            part = homes[a:a + rows]
            i, j = np.nonzero(np.bitwise_count(part[:, None] ^ others[None, :]) <= threshold)
            different = part[i] != others[j]
            if different.any():
                yield forest(part[i][different], others[j][different])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, fingerprint (signed long), component_id (smallest doc_id reachable by links).

    Equal fingerprints are one node, so copies cost one row. Each distinct fingerprint goes to every anchor of a
    covering code within covering radius plus threshold, block by block; a linked pair meets at the home anchor
    of either, in the block that holds at most one of its differing bits. The result is exact.

    Null and empty texts have fingerprint zero and link like others. Keys are integers; a document with a null
    key gets its component from the others, null if there are none. Repeated rows get the same answer. An empty
    table gives an empty result.
    """
    if threshold > THRESHOLD:
        raise ValueError("the blocks are laid out for at most 4 differing bits")
    prints = stored(fingerprints(docs, key, text), "simhash-prints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    links = stored(anchor_links(replicated(nodes.select("fingerprint")), threshold), "simhash-links")
    roots = components(links)
    linked = stored(nodes.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "simhash-roots")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(linked.join(smallest, "root").select(F.col("fingerprint").alias("node"), "component_id"), "simhash-named")
    return prints.join(named, F.col("fingerprint") == F.col("node")).select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The documents that are the smallest key of their component; all columns stay.

    Rows with a null key cannot be named and stay; rows that repeat a key share its fate.
    """
    found = near_duplicates(docs, key, text, threshold)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(key).cast("long") == F.col("__gone"), "left_anti")
