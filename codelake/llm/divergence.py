"""Source divergence audit: term frequencies of sources compared through k-squared quadtrees of the count matrix."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codelake.llm.common import few_rows, stored

#: What is no letter becomes a blank; A-Z become small; bytes of other scripts stay.
LETTERS = bytes((b | 32) if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents of a language that must hold a term; parts of one in which probabilities are counted.
LEAST_DOCS, ONE = 10, 1_000_000_000
#: Rows of a tile and leaf strips of a row: a square of 2 ** LEVELS, split in four at every level.
LEVELS = 6
SIDE = 1 << LEVELS
#: Terms of a column block, as intended; hashing makes some a little wider.
BLOCK_TERMS = 1024
#: Distinct (group, term) that a counting task holds; bytes of a text taken at a time; leaf pairs priced at a time.
HELD, PIECE, ITEMS = 400_000, 1 << 20, 1 << 14


def pieces(data: bytes):
    """A text's letters and blanks, cut at blanks into pieces of about ``PIECE`` bytes."""
    data, start = data.translate(LETTERS), 0
    while len(data) - start > PIECE:
        cut = data.find(b" ", start + PIECE)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:] if start else data


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs), and for each group a row with a null term and its number of documents."""
    few_rows(docs.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]

    def rows(seen, found, held):
        for (tongue, place), count in seen.items():
            terms = list(found[tongue, place])
            yield pa.RecordBatch.from_arrays([
                pa.array([tongue] * (len(terms) + 1)), pa.array([place] * (len(terms) + 1)),
                pa.array([None, *terms], pa.binary()).cast(pa.string()),
                pa.array([0, *found[tongue, place].values()], pa.int64()),
                pa.array([count, *(held[tongue, place][t] for t in terms)], pa.int64())], names)

    def run(batches):
        seen, found, held = Counter(), defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for group in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                key, body, own = group[:2], group[2].as_py() or b"", set()
                seen[key] += 1
                for piece in pieces(body):
                    terms = piece.split()
                    found[key].update(terms)
                    own.update(terms)
                held[key].update(own)
            if sum(map(len, found.values())) > HELD:
                yield from rows(seen, found, held)
                seen, found, held = Counter(), defaultdict(Counter), defaultdict(Counter)
        yield from rows(seen, found, held)

    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).cast("binary").alias("text"))
    counted = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), in exact arithmetic."""
    wide, by = (count + 2).cast("decimal(20,0)") * F.lit(ONE), (total + 2 * terms).cast("decimal(20,0)")
    return whole(wide, by) + 1


def whole(value: Column, by: Column) -> Column:
    """Integer quotient of two numbers that are not negative, as a long."""
    return F.call_function("div", value, by)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so the square fits a long."""
    return whole((p - q) * (p - q), p + q)


def planted(occupied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the k-squared tree (k = 2) of a SIDE x SIDE matrix, level by level, and its full leaves in tree order.

    Each full quadrant has four bits on the next level, one per quarter; an empty quadrant has nothing below it.
    """
    bits, nodes = [], np.zeros((1, 2), np.int64)
    for level in range(1, LEVELS + 1):
        size = 1 << level
        full = occupied.reshape(size, SIDE // size, size, SIDE // size).any(axis=(1, 3))
        children = (2 * nodes[:, None, :] + np.array([[0, 0], [0, 1], [1, 0], [1, 1]])[None]).reshape(-1, 2)
        has = full[children[:, 0], children[:, 1]]
        bits.append(has)
        nodes = children[has]
    return np.concatenate(bits), nodes


def tiles(entries: DataFrame) -> DataFrame:
    """A tree per (lang, rows, columns): bits of the quadtree, and the shares in its full leaves (0: count of zero).

    ``entries`` has (lang, rows, columns, row, column, width, p). A leaf is one row of a strip of ceil(width / SIDE) columns.
    """
    keys = ["lang", "rows", "columns"]
    placed = entries.repartition(*keys).sortWithinPartitions(*keys)
    schema = "lang string, rows int, columns long, width int, bits binary, leaves binary"

    def tree(key, width, row, column, p):
        strip = -(-width // SIDE)
        occupied = np.zeros((SIDE, SIDE), bool)
        occupied[row, column // strip] = True
        bits, leaves = planted(occupied)
        place = np.zeros((SIDE, SIDE), np.int64)
        place[leaves[:, 0], leaves[:, 1]] = np.arange(len(leaves))
        shares = np.zeros((len(leaves), strip), np.int64)
        shares[place[row, column // strip], column % strip] = p
        return (*key, int(width), np.packbits(bits).tobytes(), shares.tobytes())

    def run(batches):
        held, parts = None, []

        def flush():
            row, column, width, p = (np.concatenate(x) for x in zip(*parts))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(tree(held, width[0], row, column, p), kinds)], names)

        names = ["lang", "rows", "columns", "width", "bits", "leaves"]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches:
            at = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            data = [batch.column(c).to_numpy() for c in ("row", "column", "width", "p")]
            starts = [i for i in range(len(at)) if i == 0 or at[i] != at[i - 1]]
            for a, b in zip(starts, [*starts[1:], len(at)]):
                if held is not None and at[a] != held:
                    yield flush()
                    parts = []
                held = at[a]
                parts.append([x[a:b] for x in data])
        if parts:
            yield flush()

    return placed.mapInArrow(run, schema)


def unpacked(packed: bytes | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level: the four bits of each full quadrant, and for each set bit its number among the level's full quadrants."""
    if packed is None:
        return []
    bits, levels, start, nodes = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool), [], 0, 1
    for _ in range(LEVELS):
        has = bits[start:start + 4 * nodes]
        levels.append((has, np.cumsum(has) - 1))
        start, nodes = start + 4 * nodes, int(has.sum())
    return levels


def joint(width: int, left: tuple, right: tuple, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gaps over the visited columns, and their number, for each row of one tile with each of another.

    ``left`` and ``right`` are (bits, leaves, share of a zero count per row); no bits: an empty tile. Quadrants empty in both
    trees are not entered: their columns stay out of the number visited, and the caller prices them.
    """
    trees = [unpacked(left[0]), unpacked(right[0])]
    strip = -(-width // SIDE)
    leaves = [np.frombuffer(t[1], np.int64).reshape(-1, strip) if t[0] is not None else np.zeros((0, strip), np.int64) for t in (left, right)]
    zeros = [np.asarray(left[2], np.int64), np.asarray(right[2], np.int64)]
    # columns: quadrant row in either tree, quadrant column, node in either tree (-1: empty)
    front = np.array([[0, 0, 0, 0 if trees[0] else -1, 0 if trees[1] else -1]])
    halves = np.array([[a, b, c] for a in (0, 1) for b in (0, 1) for c in (0, 1)])
    for level in range(LEVELS):
        grown = np.repeat(front, 8, axis=0)
        half = np.tile(halves, (len(front), 1))
        next_nodes = []
        for side in (0, 1):
            node = grown[:, 3 + side]
            if trees[side]:
                has, number = trees[side][level]
                at = np.where(node >= 0, 4 * node + 2 * half[:, side] + half[:, 2], 0)
                next_nodes.append(np.where((node >= 0) & has[at], number[at], -1))
            else:
                next_nodes.append(np.full(len(grown), -1))
        front = np.column_stack([2 * grown[:, :3] + half, *next_nodes])
        alive = (front[:, 3] >= 0) | (front[:, 4] >= 0)
        if same:
            alive &= front[:, 0] <= front[:, 1]
        rows = SIDE >> (level + 1)
        alive &= (front[:, 0] * rows < len(zeros[0])) & (front[:, 1] * rows < len(zeros[1]))
        front = front[alive]
    if same:
        front = front[front[:, 0] < front[:, 1]]
    value, visited = np.zeros((SIDE, SIDE), np.int64), np.zeros((SIDE, SIDE), np.int64)
    for a in range(0, len(front), ITEMS):
        i, j, at, x, y = front[a:a + ITEMS].T
        shares = []
        for side, row, node in ((0, i, x), (1, j, y)):
            zero = zeros[side][row][:, None]
            got = np.where(node[:, None] >= 0, leaves[side][np.maximum(node, 0)], 0) if len(leaves[side]) else np.zeros((len(row), strip), np.int64)
            shares.append(np.where(got > 0, got, zero))
        p, q = shares
        inside = at[:, None] * strip + np.arange(strip)[None] < width
        np.add.at(value, (i, j), (np.where(inside, (p - q) ** 2 // (p + q), 0)).sum(axis=1))
        np.add.at(visited, (i, j), inside.sum(axis=1))
    return value, visited


def pair_sums(trees: DataFrame, blocks: DataFrame) -> DataFrame:
    """(lang, a, b, i, j, value, visited): rows i and j of row blocks a <= b compared over all their tiles."""
    wide = trees.select("lang", "columns", "width").distinct()
    spans = blocks.select("lang", "rows", "zeros")
    full = wide.join(spans, "lang").join(trees.drop("width"), ["lang", "columns", "rows"], "left")
    sides = [full.select("lang", "columns", "width", *[F.col(c).alias(f"{c}_{s}") for c in ("rows", "zeros", "bits", "leaves")]) for s in "ab"]
    met = sides[0].join(sides[1].drop("width"), ["lang", "columns"]).where("rows_a <= rows_b AND (bits_a IS NOT NULL OR bits_b IS NOT NULL)")
    names = ["lang", "a", "b", "i", "j", "value", "visited"]

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                value, visited = joint(r["width"], (r["bits_a"], r["leaves_a"], r["zeros_a"]), (r["bits_b"], r["leaves_b"], r["zeros_b"]),
                                       r["rows_a"] == r["rows_b"])
                i, j = np.nonzero(visited)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["lang"]] * len(i), pa.string()), pa.array(np.full(len(i), r["rows_a"], np.int32)), pa.array(np.full(len(i), r["rows_b"], np.int32)),
                    pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(value[i, j]), pa.array(visited[i, j])], names)

    found = met.mapInArrow(run, "lang string, a int, b int, i int, j int, value long, visited long")
    return found.groupBy("lang", "a", "b", "i", "j").agg(F.sum("value").alias("value"), F.sum("visited").alias("visited"))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS,
               top: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """How the term shares of each (lang, source) differ from those of other sources and of its language.

    Returns (lang, source, part, item, value, rank): part ``pair`` names every other source of the language, part ``term``
    the ``top`` terms that the source uses more than its language does. Terms are runs of letters, A-Z in lower case, that
    at least ``least_docs`` documents of the language hold.

    Counts form a matrix of groups by terms, per language. It is cut into tiles of 64 groups by about ``block_terms`` terms,
    more frequent terms first within a tile; each tile is a k-squared quadtree whose leaves are strips of one group's row.
    Two tiles over the same terms are walked together. Quadrants without a count in either are not entered: all of
    their terms have the same gap, so they are priced by their number at the end.

    Null text, lang and source count as ''. Repeated rows count as documents of their own; ties in value rank by item, in
    the order of its bytes. Texts of any length are read whole, a megabyte at a time. A group without terms still gets its
    pairs; a language without kept terms has pairs of value 0. An empty table gives an empty result.
    """
    counts = stored(term_counts(docs, text, lang, source), "divergence-counts")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(
        F.col("docs") >= least_docs)
    tongues = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total")).withColumn(
        "blocks", F.ceil(F.col("terms") / block_terms))
    inside = Window.partitionBy("lang", "columns").orderBy(F.desc("lang_n"), "term")
    columns = kept.join(tongues, "lang").withColumn("columns", F.pmod(F.xxhash64("term"), F.col("blocks")))
    columns = columns.repartition("lang", "columns")  # else the join leaves each language in one task
    columns = stored(columns.withColumn("column", F.row_number().over(inside) - 1).withColumn(
        "width", F.count("*").over(Window.partitionBy("lang", "columns"))).select(
        "lang", "term", "lang_n", "columns", F.col("column").cast("int"), F.col("width").cast("int")), "divergence-columns")
    cells = stored(counts.where("n > 0").join(columns, ["lang", "term"]).select(
        "lang", "source", "term", "n", "lang_n", "columns", "column", "width"), "divergence-cells")

    groups = counts.where("term IS NULL").select("lang", "source")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(tongues, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    # as many rows as sources; the result has one for each pair of them
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(F.lit(1).cast("long"))
    groups = stored(groups.withColumn("place", place).withColumn("rows", F.floor(F.col("place") / SIDE).cast("int")).withColumn(
        "row", (F.col("place") % SIDE).cast("int")).withColumn("zero", zero).drop("place"), "divergence-groups")
    in_order = F.array_sort(F.collect_list(F.struct("row", "source", "zero")))
    blocks = groups.groupBy("lang", "rows").agg(in_order.alias("members"), F.first("terms").alias("terms")).withColumn("zeros", F.col("members.zero"))

    shares = cells.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    trees = stored(tiles(shares.select("lang", "rows", "columns", "row", "column", "width", "p")), "divergence-tiles")
    sums = stored(pair_sums(trees, blocks), "divergence-sums")

    sides = [blocks.select("lang", F.col("rows").alias(s), F.col("members").alias(f"members_{s}"), "terms") for s in "ab"]
    facing = sides[0].join(sides[1].drop("terms"), "lang").where("a <= b").repartition("lang", "a", "b")
    facing = facing.select("lang", "a", "b", "terms", "members_b", F.explode("members_a").alias("x")).select(
        "lang", "a", "b", "terms", "x", F.explode("members_b").alias("y")).where("a < b OR x.row < y.row")
    facing = facing.select("lang", "a", "b", F.col("x.row").alias("i"), F.col("y.row").alias("j"), "terms", "x", "y")
    unseen = (F.col("terms") - F.coalesce("visited", F.lit(0))) * gap(F.col("x.zero"), F.col("y.zero"))
    priced = facing.join(sums, ["lang", "a", "b", "i", "j"], "left").withColumn(
        "value", (F.coalesce("value", F.lit(0)) + unseen).cast("long"))
    both = F.array(F.struct(F.col("x.source").alias("source"), F.col("y.source").alias("item")),
                   F.struct(F.col("y.source").alias("source"), F.col("x.source").alias("item")))
    pairs = priced.select("lang", "value", F.inline(both)).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = shares.withColumn("q", q).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).cast("long").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
