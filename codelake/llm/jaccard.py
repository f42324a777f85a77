"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codelake.llm.common import few_rows, stored, texts_of
from codelake.llm.components import components
from codelake.operators.skew import lookup_join

#: Words of an n-gram; hundredths of the union that two linked sets share at least.
WORDS, PERCENT = 5, 80
#: Entries of a row block, at which a task cuts its rows; entries of a column block, as intended.
ROW_ENTRIES, COLUMN_ENTRIES = 2_000_000, 4_000_000
#: Bytes of a hash by which an n-gram is named in the blocks. Of two sets of 100 n-grams, two differ but share a name
#: with a probability of 10^4 / 2^48.
NAME = 6
#: Counters of the sketch of all entries; a cell with so many times the mean holds frequent n-grams.
CELLS, FREQUENT = 1 << 18, 4
#: Sketch counters in a row; rows of a column's members that one task compares at once.
SLICE, MEMBERS = 1 << 12, 20_000
#: Bits of the marks that a set carries; partners of a set in a round; share of the sets below which a round's links are few.
MARKS, PARTNERS, FEW = 512, 4, 0.02
MIX = np.uint64(0xBF58476D1CE4E5B9)


def gram_set(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct n-grams of a text as sorted 64-bit hashes, A-Z in lower case; the whole sequence if it is shorter."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    hashed = xxhash.xxh3_64_intdigest
    if len(parts) < words:
        return np.array([hashed(b" ".join(parts))] if parts else [], np.uint64)
    single = np.fromiter(map(hashed, parts), np.uint64, len(parts))
    n = len(parts) - words + 1
    grams = single[:n].copy()
    for k in range(1, words):
        grams = (grams ^ (grams >> np.uint64(29))) * MIX + single[k:n + k]
    grams ^= grams >> np.uint64(32)
    return np.unique(grams * MIX)


def set_key(grams: np.ndarray) -> int:
    """64 bits that name a set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64)) if len(grams) else 0


def bound(size, percent: int = PERCENT):
    """N-grams that a set shares with any set linked to it, at least: the union is no smaller than the set."""
    return -(-percent * size // 100)


def sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(doc_id, n, set, slice, counts): a row per document, and rows with a null ``n`` that hold slices of the sketch."""
    few_rows(docs.sparkSession)
    names = ["doc_id", "n", "set", "slice", "counts"]

    def run(batches):
        sketch, seen = np.zeros(CELLS, np.uint32), False
        for batch in batches:
            size, name = [], []
            for t in texts_of(batch):
                grams = gram_set(t, words)
                size.append(len(grams))
                name.append(set_key(grams))
                np.add.at(sketch, cell_of(grams), 1)
            seen = seen or len(size) > 0
            empty = pa.nulls(len(size))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(name, pa.int64()),
                                              empty.cast(pa.int32()), empty.cast(pa.binary())], names)
        if seen:
            slices = np.flatnonzero(sketch.reshape(-1, SLICE).any(axis=1))
            empty = pa.nulls(len(slices), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, empty, pa.array(slices.astype(np.int32)),
                                              pa.array([sketch[i * SLICE:(i + 1) * SLICE].tobytes() for i in slices], pa.binary())], names)

    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n long, set long, slice int, counts binary")


def cell_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(20)).astype(np.int64) & (CELLS - 1)


def frequent_cells(slices: DataFrame) -> tuple[np.ndarray, int]:
    """Sizes of the cells that hold frequent n-grams (0 for the others), and the number of entries in all."""
    def run(batches):
        key, total = None, None
        for batch in batches:
            for at, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                if at != key:
                    if key is not None:
                        yield row(key, total)
                    key, total = at, np.zeros(SLICE, np.int64)
                total += np.frombuffer(counts.as_buffer(), np.uint32)
        if key is not None:
            yield row(key, total)

    def row(key, total):
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "counts"])

    summed = slices.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, "slice int, counts binary")
    cells = np.zeros(CELLS, np.int64)
    for at, counts in summed.collect():  # at most CELLS / SLICE rows of fixed size
        cells[at * SLICE:(at + 1) * SLICE] = np.frombuffer(counts, np.int64)
    total = int(cells.sum())
    return np.where(cells > max(FREQUENT * total / CELLS, 1), cells, 0), total


def named(grams: np.ndarray) -> np.ndarray:
    """The names of n-grams: the low bytes of their hashes, sorted and distinct."""
    return np.unique(grams & np.uint64(2 ** (8 * NAME) - 1))


def packed(grams: np.ndarray) -> bytes:
    return np.ascontiguousarray(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :NAME]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // NAME, 8), np.uint8)
    wide[:, :NAME] = np.frombuffer(data, np.uint8).reshape(-1, NAME)
    return wide.view("<u8").ravel()


def narrow(lengths: np.ndarray) -> bytes:
    """Lengths in as few bytes each as the largest needs; one per set, so :func:`lengths_of` knows how many."""
    return lengths.astype(np.min_scalar_type(int(lengths.max(initial=0)))).tobytes()


def lengths_of(part: dict) -> np.ndarray:
    sets = len(part["sets"]) // 8
    return np.frombuffer(part["lengths"], f"u{len(part['lengths']) // max(sets, 1) or 1}").astype(np.int64)


def row_blocks(docs: DataFrame, text: str, words: int, hot: np.ndarray, columns: int) -> DataFrame:
    """The incidence matrix cut into blocks: (block, column, sets, sizes, grams, lengths).

    A row block holds the distinct sets of a stretch of documents; a column block holds the n-grams of a range of names, as one
    compressed row per set (``lengths`` and ``grams``). Frequent n-grams need no counting: they are in a negative column of their block,
    which names all of its sets with their sizes.
    """
    few_rows(docs.sparkSession)
    names = ["block", "column", "sets", "sizes", "grams", "lengths"]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    shift = np.uint64(8 * NAME - (columns.bit_length() - 1))

    def cut(held, block):
        keys, grams = np.array(list(held), np.int64), list(held.values())
        sizes = np.fromiter(map(len, grams), np.int64, len(grams))
        flat, own = np.concatenate(grams), np.repeat(np.arange(len(grams)), sizes)
        column = (flat >> shift).astype(np.int64)
        column[hot[cell_of(flat)] > 0] = -1
        order = np.argsort(column, kind="stable")
        flat, own, column = flat[order], own[order], column[order]
        many = int(np.searchsorted(column, 0))
        frequent = np.bincount(own[:many], minlength=len(keys))
        rows = [(block, -1 - block % 2**31, keys.tobytes(), sizes.tobytes(), packed(flat[:many]), narrow(frequent))]
        starts = many + np.flatnonzero(np.r_[True, column[many + 1:] != column[many:-1]]) if many < len(flat) else []
        for a, b in zip(starts, [*starts[1:], len(flat)]):
            there, lengths = np.unique(own[a:b], return_counts=True)
            rows.append((block, int(column[a]), keys[there].tobytes(), None, packed(flat[a:b]), narrow(lengths)))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    def run(batches):
        held, entries, block = {}, 0, TaskContext.get().partitionId() << 16
        for batch in batches:
            for t in texts_of(batch):
                grams = gram_set(t, words)
                name = set_key(grams)
                if len(grams) and name not in held:
                    held[name] = named(grams)
                    entries += len(grams)
                    if entries >= ROW_ENTRIES:
                        yield cut(held, block)
                        held, entries, block = {}, 0, block + 1
        if held:
            yield cut(held, block)

    schema = "block long, column int, sets binary, sizes binary, grams binary, lengths binary"
    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def shared_entries(blocks: DataFrame) -> DataFrame:
    """What of the blocks other sets have too: (block, column, sets, sizes, grams, lengths, counts).

    A column block's parts meet in one task, which counts the distinct sets of each n-gram; equal sets of several
    row blocks count once, and stay in the first. ``counts`` says how many sets have each n-gram; frequent ones pass as they are.
    """
    names = ["block", "column", "sets", "sizes", "grams", "lengths", "counts"]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]

    def counted(parts):
        if parts[0]["column"] < 0:
            yield from (tuple(p.get(name) for name in names) for p in parts)
            return
        keys = [np.frombuffer(p["sets"], np.int64) for p in parts]
        lengths = [lengths_of(p) for p in parts]
        grams = np.concatenate([unpacked(p["grams"]) for p in parts])
        row_key, row_length = np.concatenate(keys), np.concatenate(lengths)
        first = np.zeros(len(row_key), bool)
        first[np.unique(row_key, return_index=True)[1]] = True
        kept = np.repeat(first, row_length)
        _, place, count = np.unique(grams[kept], return_inverse=True, return_counts=True)
        counts = np.zeros(len(grams), np.int64)
        counts[kept] = count[place]
        start = 0
        for p, k, n in zip(parts, keys, lengths):
            end = start + int(n.sum())
            yield part(p, k, n, grams[start:end], counts[start:end], counts[start:end] > 1)
            start = end

    def part(p, keys, lengths, grams, counts, kept):
        own = np.repeat(np.arange(len(keys)), lengths)[kept]
        there, left = np.unique(own, return_counts=True)
        return (p["block"], p["column"], keys[there].tobytes(), None, packed(grams[kept]), narrow(left),
                np.minimum(counts[kept], 2**31 - 1).astype(np.int32).tobytes())

    def run(batches):
        column, parts = None, []
        for batch in batches:
            for p in batch.to_pylist():
                if column is not None and p["column"] != column:
                    yield out(counted(parts))
                    parts = []
                column = p["column"]
                parts.append(p)
        if parts:
            yield out(counted(parts))

    def out(rows):
        rows = [r for r in rows if r[2]]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    schema = "block long, column int, sets binary, sizes binary, grams binary, lengths binary, counts binary"
    return blocks.repartition("column").sortWithinPartitions("column", "block").mapInArrow(run, schema)


def marks_of(grams: np.ndarray) -> bytes:
    """Bits that each n-gram turns over: in so many bits as differ, two sets differ in as many n-grams at least."""
    turned = np.bincount(((grams * MIX) >> np.uint64(40)).astype(np.int64) % MARKS, minlength=MARKS) & 1
    return np.packbits(turned.astype(np.uint8)).tobytes()


def candidates(entries: DataFrame, hot: np.ndarray, percent: int) -> DataFrame:
    """(set, n, grams, prefix, marks) of the sets that share enough n-grams with others to be linked at all.

    ``grams`` are the shared ones, sorted; ``prefix`` the shared ones among the first n - bound + 1 of the set, rarest first: two
    linked sets have one of these in common. ``marks``: see :func:`marks_of`.
    """
    names = ["set", "n", "grams", "prefix", "marks"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]

    def assembled(parts):
        key, gram, count, sizes = [], [], [], {}
        for p in parts:
            keys, grams = np.frombuffer(p["sets"], np.int64), unpacked(p["grams"])
            key.append(np.repeat(keys, lengths_of(p)))
            gram.append(grams)
            if p["counts"] is None:  # frequent n-grams come after all counted ones
                sizes = dict(zip(keys.tolist(), np.frombuffer(p["sizes"], np.int64).tolist()))
                count.append(hot[cell_of(grams)] + (1 << 40))
            else:
                count.append(np.frombuffer(p["counts"], np.int32).astype(np.int64))
        key, gram, count = map(np.concatenate, (key, gram, count))
        if not len(key):
            return
        order = np.lexsort((gram, count, key))
        key, gram = key[order], gram[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(starts, [*starts[1:], len(key)]):
            n = sizes[int(key[a])]
            if b - a >= bound(n, percent):
                alone = n - (b - a)  # n-grams of no other set come first
                yield int(key[a]), n, packed(np.sort(gram[a:b])), gram[a:a + n - bound(n, percent) + 1 - alone].view(np.int64), marks_of(gram[a:b])

    def run(batches):
        block, parts = None, []
        for batch in batches:
            for p in batch.to_pylist():
                if block is not None and p["block"] != block:
                    yield out(assembled(parts))
                    parts = []
                block = p["block"]
                parts.append(p)
        if parts:
            yield out(assembled(parts))

    def out(rows):
        rows = list(rows)
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    placed = entries.repartition("block").sortWithinPartitions("block")
    found = placed.mapInArrow(run, "set long, n long, grams binary, prefix array<long>, marks binary")
    return found


def verified(pairs: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) of sets that are linked: overlaps are counted on the shared n-grams, sizes on all."""
    left = chosen.select(F.col("set").alias("x"), F.col("n").alias("n_x"), F.col("grams").alias("grams_x"))
    right = chosen.select(F.col("set").alias("y"), F.col("n").alias("n_y"), F.col("grams").alias("grams_y"))
    met = pairs.join(left, "x").join(right, "y")  # a set that leads many pairs is split by the adaptive skew join

    def run(batches):
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            a, b = batch.column("n_x").to_pylist(), batch.column("n_y").to_pylist()
            kept = []
            for i, (m, n, g, h) in enumerate(zip(a, b, batch.column("grams_x"), batch.column("grams_y"))):
                g, h = unpacked(g.as_py()), unpacked(h.as_py())
                both = len(g) + len(h) - len(np.union1d(g, h))
                if 100 * both >= percent * (m + n - both):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in kept], pa.int64()), pa.array([y[i] for i in kept], pa.int64())], ["src", "dst"])

    return met.mapInArrow(run, "src long, dst long")


def labelled(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """Column ``part``: the component of each set under the links known so far."""
    if links is None:
        return rows.withColumn("part", F.col("set"))
    return rows.join(components(links), F.col("set") == F.col("node"), "left").withColumn("part", F.coalesce("root", "set")).drop("node", "root")


def star_pairs(members: DataFrame) -> DataFrame:
    """One partner for each set: the one that leads most of the columns they share.

    A column's members of like size are led by the first of them in an order of all sets. Dense groups come together
    in this round, at a cost that grows with their size only.
    """
    order = F.xxhash64("part")
    like = F.floor(F.log("n") / F.log(F.lit(1.25)))
    rows = members.withColumn("like", like).withColumn("lead", F.struct(order.alias("order"), "part", "set"))
    leads = rows.groupBy("gram", "like").agg(F.min("lead").alias("low"), F.max("lead").alias("high")).where("low.part <> high.part")
    met = rows.select("gram", "like", "set", "part").join(leads, ["gram", "like"])
    partner = F.when(F.col("low.part") != F.col("part"), F.col("low.set")).otherwise(F.col("high.set"))
    votes = met.select(F.col("set").alias("x"), partner.alias("y")).groupBy("x", "y").agg(F.count("*").alias("votes"))
    best = votes.groupBy("x").agg(F.max(F.struct("votes", "y")).alias("best"))
    return best.select(F.least("x", "best.y").alias("x"), F.greatest("x", "best.y").alias("y")).distinct()


def column_pairs(members: DataFrame, traits: DataFrame, percent: int, most: int, best: bool) -> DataFrame:
    """All pairs of sets of different components that have a prefix n-gram in common and may reach the bound.

    With ``best``, the most promising ones of each set, ``PARTNERS`` at most. Pairs are judged by their sizes, by what can still follow the common n-gram in
    either prefix order, and by their marks. A column of one component needs no work; one with more than ``most``
    members is dealt over cells, each of which compares its own with all.
    """
    mixed = stored(members.groupBy("gram").agg(F.count("*").alias("members"), F.min("part").alias("low"), F.max("part").alias("high")).where(
        "low <> high").select("gram", "members", F.ceil(F.col("members") / most).cast("int").alias("cells")), "jaccard-columns")
    rows = members.join(mixed.select("gram", "cells"), "gram").join(traits, "set")
    own = F.pmod(F.xxhash64("set"), F.col("cells")).cast("int")
    carried = ["gram", "set", "n", "rest", "part", "shared", "marks"]
    dealt = rows.select(*carried, own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))
    dealt = dealt.select("cell", *carried, (F.col("own") == F.col("cell")).alias("home"))
    placed = dealt.repartition("gram", "cell").sortWithinPartitions("gram", "cell", F.desc("home"))

    def run(batches):
        held_key, held, held_marks = None, None, None
        for batch in batches:
            gram, cell = batch.column("gram").to_numpy(), batch.column("cell").to_numpy()
            data = np.stack([batch.column(c).to_numpy() for c in ("set", "n", "rest", "part", "shared")])
            marks = np.frombuffer(b"".join(batch.column("marks").to_pylist()), np.uint64).reshape(-1, MARKS // 64)
            home = batch.column("home").to_numpy(zero_copy_only=False).astype(bool)
            if not len(gram):
                continue
            starts = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (cell[1:] != cell[:-1])])
            found = []
            for a, b in zip(starts, [*starts[1:], len(gram)]):
                mine, own_marks = data[:, a:b][:, home[a:b]], marks[a:b][home[a:b]]
                if (gram[a], cell[a]) == held_key:
                    held, held_marks = np.concatenate([held, mine], axis=1), np.concatenate([held_marks, own_marks])
                else:
                    held_key, held, held_marks = (gram[a], cell[a]), mine, own_marks
                found += facing(held, held_marks, data[:, a:b], marks[a:b], percent, best)
            if found:
                x, y, slack = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(slack)], ["x", "y", "slack"])

    met = placed.mapInArrow(run, "x long, y long, slack long")
    if best:
        order = Window.partitionBy("x").orderBy(F.desc("slack"), "y")
        met = met.distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= PARTNERS)
    return met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def facing(homes: np.ndarray, home_marks: np.ndarray, others: np.ndarray, other_marks: np.ndarray, percent: int, best: bool,
           step: int = 1 << 18) -> list[np.ndarray]:
    """(one, other, slack) of different components where sizes, the remaining prefix order and marks allow the overlap.

    ``slack`` is by how much; with ``best``, only a home's ``PARTNERS`` largest. A block of the product at a time.
    """
    key, n, rest, part, shared = others
    if (part == part[0]).all() and (homes[3] == part[0]).all():
        return []
    rows, found = max(1, step // max(len(key), 1)), []
    for a in range(0, homes.shape[1], rows):
        k, m, r, p, s = homes[:, a:a + rows]
        needed = -(-percent * (m[:, None] + n) // (100 + percent))
        i, j = np.nonzero((p[:, None] != part) & (np.minimum(r[:, None], rest) >= needed))
        if not len(i):
            continue
        differ = np.bitwise_count(home_marks[a:a + rows][i] ^ other_marks[j]).sum(axis=1, dtype=np.int64)
        slack = (s[i] + shared[j] - differ) // 2 - needed[i, j]
        may = slack >= 0
        i, j, slack = i[may], j[may], slack[may]
        if best and len(i):
            order = np.lexsort((key[j], -slack, i))
            i, j, slack = i[order], j[order], slack[order]
            start = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            first = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)])) < PARTNERS
            i, j, slack = i[first], j[first], slack[first]
        if len(i):
            found.append(np.stack([k[i], key[j], slack]))
    return found


def linked_sets(docs: DataFrame, text: str, words: int, percent: int, slices: DataFrame, most: int = MEMBERS,
                column_entries: int = COLUMN_ENTRIES) -> DataFrame | None:
    """Links (src, dst) between sets, of which chains join every two sets with a Jaccard similarity of ``percent`` or more.

    First each set against one leader, then, until few links come of it, each against its most promising partners, then all that is
    left. A round leaves out what the components so far join already, so that dense groups don't give all of their pairs.
    """
    hot, total = frequent_cells(slices)
    if not total:
        return None
    columns = 1 << max(0, (total // column_entries).bit_length())
    blocks = row_blocks(docs, text, words, hot, columns)
    chosen = stored(candidates(shared_entries(blocks), hot, percent), "jaccard-candidates")
    # a set may be in several row blocks: the first one has all that is shared, others the frequent n-grams alone
    fullest = F.max_by(F.struct("n", "grams", "prefix", "marks"), F.octet_length("grams"))
    chosen = stored(chosen.groupBy("set").agg(fullest.alias("all")).select("set", "all.*"), "jaccard-sets")
    prefix = chosen.select("set", "n", F.posexplode("prefix").alias("pos", "gram"), F.size("prefix").alias("long"))
    # what follows the n-gram at this place of the prefix, itself included
    rest = bound_column(F.col("n"), percent) + F.col("long") - 1 - F.col("pos")
    prefix = prefix.select("gram", "set", "n", rest.alias("rest"))
    met = prefix.groupBy("gram").agg(F.count("*").alias("met")).where("met > 1")
    prefix = stored(prefix.join(met.select("gram"), "gram"), "jaccard-prefixes")
    traits = chosen.select("set", (F.octet_length("grams") / NAME).cast("long").alias("shared"), "marks")
    few = chosen.count() * FEW
    links, _ = with_round(star_pairs, prefix, chosen, None, percent)
    found = few + 1
    while found > few:
        links, found = with_round(lambda m: column_pairs(m, traits, percent, most, True), prefix, chosen, links, percent)
    return with_round(lambda m: column_pairs(m, traits, percent, most, False), prefix, chosen, links, percent)[0]


def with_round(partners: Callable, prefix: DataFrame, chosen: DataFrame, links: DataFrame | None, percent: int) -> tuple[DataFrame, int]:
    """The links with those among the pairs that ``partners`` makes of the prefixes, and how many came."""
    pairs = stored(partners(stored(labelled(prefix, links), "jaccard-members")), "jaccard-pairs")
    new = stored(verified(pairs, chosen, percent), "jaccard-links")
    return new if links is None else links.unionByName(new), new.count()


def bound_column(n: Column, percent: int) -> Column:
    return F.floor((percent * n + 99) / 100).cast("long")


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, **tuning) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document: the size of its set of n-grams and the smallest doc_id reachable by links.

    Two documents link when their sets' intersection is at least ``percent`` hundredths of their union. Sets are compared as 64-bit
    hashes. Equal sets are one row of the incidence matrix; how the product is cut and bounded, see :func:`row_blocks`,
    :func:`shared_entries`, :func:`candidates`, :func:`star_pairs` and :func:`column_pairs`.

    Null and empty texts and texts without words have no set and link with nothing: their component is their own doc_id.
    Keys are integers; a row with a null key gets its component from the others, null if there are none. Repeated rows are equal
    sets. Texts are read whole; one text's set must fit a task. An empty table gives an empty result.
    """
    read = stored(sets(docs, key, text, words), "jaccard-documents")
    per_doc = read.where("n IS NOT NULL").select("doc_id", "n", "set")
    nodes = stored(per_doc.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("least")), "jaccard-nodes")
    links = linked_sets(docs, text, words, percent, read.where("slice IS NOT NULL").select("slice", "counts"), **tuning)
    if links is not None:
        roots = components(links)
        reached = nodes.join(roots, F.col("set") == F.col("node"), "left").select("set", "least", F.coalesce("root", "set").alias("root"))
        reached = stored(reached, "jaccard-roots")
        smallest = reached.groupBy("root").agg(F.min("least").alias("component_id"))
        nodes = stored(lookup_join(reached, smallest, ["root"], ["set"]).select("set", "component_id"), "jaccard-components")
    else:
        nodes = nodes.withColumnRenamed("least", "component_id")
    counts = per_doc.where("n > 0").groupBy("set").agg(F.count("*").alias("n"))
    found = lookup_join(per_doc.where("n > 0"), nodes, ["set"], ["doc_id"], "left", counts=stored(counts, "jaccard-copies"))
    lone = per_doc.where("n = 0").withColumn("component_id", F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        lone.select("doc_id", F.col("n").alias("n_shingles"), "component_id"))
