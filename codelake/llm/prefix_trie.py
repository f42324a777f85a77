"""Trie of conversation prefixes, rolled up in depth bands."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codelake.llm.common import WORD, stored
from codelake.operators.skew import lookup_join

#: Levels of the trie in a band.
BAND = 16
#: Turns of a conversation that one window orders or folds.
SEGMENT = 4096
#: Conversations of a family borrow first turns from its first one, fewer than BORROWED of them.
FAMILY, BORROWED = 20, 4
#: Values of conv_id that one piece of a list of members spans.
PIECE = 4096
#: The node without turns.
ROOT = "named_struct('a', 0L, 'b', 0L)"


def numbered(rows: DataFrame, segment: int) -> DataFrame:
    """Column ``pos``: the place of each turn in its conversation, from 1, by (turn, digest), null turns first.

    Conversations of up to ``segment`` turns are ordered by a window. The turns of longer ones are dealt out by range
    over as many tasks as they fill segments, and each range counts on from the ranges before it.
    """
    counts = rows.groupBy("conv").agg(F.count("*").alias("n"))
    long_ones = stored(counts.where(F.col("n") > segment), "trie-long")
    total = long_ones.agg(F.sum("n")).first()[0] or 0
    order = ["turn", "digest"]
    short = Window.partitionBy("conv").orderBy(*order)
    if not total:
        return rows.withColumn("pos", F.row_number().over(short).cast("long"))
    marked = lookup_join(rows, long_ones, ["conv"], order, "left")
    few = marked.where("n IS NULL").drop("n").withColumn("pos", F.row_number().over(short).cast("long"))
    # equal turns of a conversation are told apart by their row, so that any number of them can be dealt out
    many = stored(marked.where("n IS NOT NULL").drop("n").withColumn("row", F.monotonically_increasing_id()), "trie-long-turns")
    dealt = stored(many.repartitionByRange(-(-total // segment), "conv", *order, "row").withColumn("part", F.spark_partition_id()), "trie-ranges")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("conv", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order, "row"))
    placed = dealt.withColumn("pos", within).join(sizes, ["conv", "part"]).withColumn("pos", F.col("pos") + F.col("before"))
    return few.unionByName(placed.select(few.columns))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, digest, words) of the rebuilt conversations, and (conv) of all of them, turnless ones too.

    Conversation c begins with the first h turns of c - c % FAMILY and goes on with its own after its first h, where
    h is the unsigned crc32 of its decimal number modulo BORROWED; % takes the sign of c.
    """
    h = (F.crc32(F.col("conv").cast("string")) % BORROWED).cast("int")
    base = F.col("conv") - F.col("conv") % FAMILY
    convs = turns.where("pos = 1").select("conv", h.alias("h"), base.alias("base"))
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < BORROWED)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    borrowed = convs.join(heads, "base").select("conv", F.explode(F.slice("head", F.lit(1), F.col("h"))).alias("t")).select(
        "conv", F.col("t.pos").alias("depth"), "t.digest", "t.words")
    own = turns.withColumns({"h": h, "base": base}).where("pos > h")
    found = lookup_join(own, heads.select("base", F.size("head").alias("given")), ["base"], ["conv", "pos"], "left")
    depth = F.col("pos") - F.col("h") + F.least(F.col("h"), F.coalesce("given", F.lit(0)))
    own = found.select("conv", depth.cast("long").alias("depth"), "digest", "words")
    return borrowed.unionByName(own), convs.select("conv")


def with_nodes(rows: DataFrame, segment: int, deepest: int) -> DataFrame:
    """Columns ``node`` and ``up``: the node of each turn's prefix and that of its parent.

    A node is named by two 64-bit values: the exclusive or, over its turns, of hashes of (depth, digest). A fold within
    segments of a conversation, then over the segments before.
    """
    rows = rows.withColumns({
        "a": F.xxhash64("depth", "digest"), "b": F.xxhash64("digest", "depth", F.lit("second")),
        "segment": F.floor((F.col("depth") - 1) / segment)})
    upto = Window.partitionBy("conv", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    folded = rows.withColumns({"x": F.bit_xor("a").over(upto), "y": F.bit_xor("b").over(upto)})
    if deepest > segment:
        before = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
        ends = rows.groupBy("conv", "segment").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        ends = ends.select("conv", "segment", F.bit_xor("a").over(before).alias("p"), F.bit_xor("b").over(before).alias("q"))
        zero = F.lit(0).cast("long")
        folded = folded.join(ends.where("segment > 0"), ["conv", "segment"], "left").withColumns({
            "x": F.col("x").bitwiseXOR(F.coalesce("p", zero)), "y": F.col("y").bitwiseXOR(F.coalesce("q", zero))})
    return folded.select(
        "conv", "depth", "words", F.struct(F.col("x").alias("a"), F.col("y").alias("b")).alias("node"),
        F.struct(F.col("x").bitwiseXOR(F.col("a")).alias("a"), F.col("y").bitwiseXOR(F.col("b")).alias("b")).alias("up"))


def banded(rows: DataFrame, band: int) -> DataFrame:
    """(node, depth, path, anchor) per distinct node of (conv, depth, node).

    Band k spans the depths k * band + 1 to (k + 1) * band; its anchors are the nodes right above it. ``path`` are the nodes
    of the band from its top to the node itself, at most ``band`` of them. An anchor's row is also dealt to the band below.
    """
    at = F.floor((F.col("depth") - 1) / band)
    below = F.when(F.col("depth") % band == 0, F.struct((at + 1).alias("band"), F.lit(True).alias("above")))
    dealt = rows.select("conv", "depth", "node", F.inline(F.array_compact(F.array(
        F.struct(at.alias("band"), F.lit(False).alias("above")), below))))
    upto = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = dealt.select("node", "depth", "above", F.collect_list(F.when(~F.col("above"), F.col("node"))).over(upto).alias("path"),
                        F.max(F.when(F.col("above"), F.col("node"))).over(upto).alias("anchor"))
    return seen.where(~F.col("above")).groupBy("node").agg(
        F.first("depth").alias("depth"), F.first("path").alias("path"), F.coalesce(F.first("anchor"), F.expr(ROOT)).alias("anchor"))


def rolled_up(rows: DataFrame, values: DataFrame, deepest: int, band: int) -> DataFrame:
    """(node, leaves, saved): sums of ``values`` over each node's subtree, itself included, for all nodes of ``rows`` and the root.

    Each node goes to its ancestors within its band, at most ``band`` of them. What hangs below a node at the bottom of a band
    is known first: the anchors form a trie of their own, less deep by the factor ``band``, whose values are the sums over the band
    below each, and which is rolled up in the same way. So rounds grow with the logarithm of the depth.
    """
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    nothing = F.lit(0).cast("long")
    placed = banded(rows, band).join(values, "node", "left")
    placed = stored(placed.withColumns({c: F.coalesce(c, nothing) for c in ("leaves", "saved")}), "trie-band")
    if deepest <= band:
        under = placed.agg(*[F.coalesce(s, nothing).alias(n) for s, n in zip(sums, ("leaves", "saved"))]).select(F.expr(ROOT).alias("node"), "leaves", "saved")
    else:
        hung = placed.groupBy(F.col("anchor").alias("node")).agg(*sums)
        anchors = rows.where(F.col("depth") % band == 0).withColumn("depth", (F.col("depth") / band).cast("long"))
        done = stored(rolled_up(anchors, hung, deepest // band, band), "trie-anchors")
        under = done.where(F.col("node") == F.expr(ROOT))
        met = placed.join(done.select("node", F.col("leaves").alias("more"), F.col("saved").alias("more_saved")), "node", "left")
        placed = met.withColumns({"leaves": F.col("leaves") + F.coalesce("more", nothing), "saved": F.col("saved") + F.coalesce("more_saved", nothing)})
    inner = placed.select(F.explode("path").alias("node"), "leaves", "saved").groupBy("node").agg(*sums)
    top = under.unionByName(values.where(F.col("node") == F.expr(ROOT)).select("node", "leaves", "saved")).groupBy("node").agg(*sums)
    return inner.unionByName(top)


def members_digest(ends: DataFrame, piece: int) -> DataFrame:
    """(node, ends_sha256) of (node, conv): SHA-256 of the conversations' decimal numbers, ascending, comma-joined.

    Numbers are joined in pieces, one per range of ``piece`` values, and a node's pieces run through one digest as they come, sorted.
    """
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    parts = ends.groupBy(F.col("node.a").alias("a"), F.col("node.b").alias("b"), F.floor(F.col("conv") / piece).alias("piece")).agg(listed.alias("part"))
    sorted_parts = parts.repartition("a", "b").sortWithinPartitions("a", "b", "piece")

    def run(batches):
        key, digest = None, None
        for batch in batches:
            out = []
            for at, part in zip(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()), batch.column("part").to_pylist()):
                if at == key:
                    digest.update(b"," + part.encode())
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = at, hashlib.sha256(part.encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, digest.hexdigest()), kinds)], names)

    names, kinds = ["a", "b", "ends_sha256"], [pa.int64(), pa.int64(), pa.string()]
    return sorted_parts.mapInArrow(run, "a long, b long, ends_sha256 string").select(F.struct("a", "b").alias("node"), "ends_sha256")


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                band: int = BAND, segment: int = SEGMENT, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see :func:`rebuilt`): what caching each prefix once would save.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens (over the subtree, itself
    included; a node saves its last turn's words once per further member) and ends_sha256 (of the members that end there).

    Rows without a conv_id belong to no conversation and are left out. Null role or text counts as empty. Turns that tie are
    ordered by a digest of role and text, equal ones are interchangeable; repeated rows are turns of their own. Texts of any length become
    a digest and a number of words in the first scan. An empty table has no conversations and no root: the result is empty.
    """
    rows = conversations.where(F.col(conv).isNotNull())
    said, body = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    framed = F.concat(F.octet_length(said).cast("string"), F.lit(":"), said, body)
    rows = stored(rows.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.md5(framed).alias("digest"),
                              F.regexp_count(body, F.lit(WORD)).cast("long").alias("words")), "trie-turns")
    turns = stored(numbered(rows, segment).select("conv", "pos", "digest", "words"), "trie-numbered")
    prefixes, convs = rebuilt(turns)
    prefixes = stored(prefixes, "trie-rebuilt")
    deepest = prefixes.agg(F.max("depth")).first()[0] or 0
    prefixes = stored(with_nodes(prefixes, segment, deepest), "trie-prefixes")

    inner = prefixes.groupBy("node").agg(F.min("conv").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"),
                                         F.max("words").alias("words"), F.max("up").alias("up"))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.expr(ROOT).alias("node"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("words"),
        F.lit(None).cast("struct<a:bigint,b:bigint>").alias("up"))
    nodes = stored(inner.unionByName(root), "trie-nodes")
    kids = stored(nodes.where("up IS NOT NULL").groupBy("up").agg(F.count("*").alias("n")), "trie-children")
    nodes = stored(nodes.join(kids.select(F.col("up").alias("node"), F.col("n").alias("n_children")), "node", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "trie-families")
    values = nodes.select("node", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = rolled_up(prefixes.select("conv", "depth", "node"), values, deepest, band)

    last = prefixes.groupBy("conv").agg(F.max(F.struct("depth", "node")).alias("last")).select("conv", F.col("last.node").alias("node"))
    ends = convs.join(last, "conv", "left").select("conv", F.coalesce("node", F.expr(ROOT)).alias("node"))
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    named = lookup_join(nodes, parents, ["up"], ["node"], "left", counts=kids)
    return named.join(totals, "node").join(members_digest(ends, piece), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
