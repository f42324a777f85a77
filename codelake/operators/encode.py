"""From token ids to model-ready blocks and batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from codelake.functions import arrays as A
from codelake.functions import text as T
from codelake.functions.keys import draw_bucket, draw_key
from codelake.operators.ranking import position, with_quantile_bucket
from codelake.session import durable

#: Rows that look their items up together.
GROUP_ROWS = 2000


def translated(df: DataFrame, key: str, items: Column, dictionary: DataFrame, of: Callable, to: StructField,
               group_rows: int = GROUP_ROWS) -> DataFrame:
    """Column ``to``: ``of(items, entries)`` of each row, with the dictionary's (item, entry) for the row's items.

    Rows are dealt into groups of about ``group_rows``. A group asks once for each of its distinct items, and gets its part of the
    dictionary back as one table beside its rows: no item crosses the network once per use, and the dictionary, dealt by item,
    can have any size.
    """
    groups = max(1, -(-df.count() // group_rows))
    dealt = df.withColumns({"_group": F.pmod(F.xxhash64(key), F.lit(groups)), "_items": items})
    asked = dealt.select("_group", F.explode("_items").alias("item")).distinct()
    # an item is asked for by each group at most once, so none is hot
    answered = asked.join(dictionary.toDF("item", "entry"), "item").select(F.col("_group").alias("_asked_by"), "item", "entry")
    schema = StructType([*df.schema.fields, to])
    arrow = to_arrow_schema(schema)

    def looked_up(rows: pa.Table, entries: pa.Table) -> pa.Table:
        held = dict(zip(entries.column("item").to_pylist(), entries.column("entry").to_pylist()))
        found = [of(row or [], held) for row in rows.column("_items").to_pylist()]
        columns = [rows.column(name) for name in arrow.names[:-1]]
        return pa.Table.from_arrays([*columns, pa.array(found, arrow.field(to.name).type)], arrow.names)

    return dealt.groupBy("_group").cogroup(answered.groupBy("_asked_by")).applyInArrow(looked_up, schema)


def lookup_pieces(df: DataFrame, key: str, words: Column, pieces: DataFrame, unknown: int, to: str = "input_ids",
                  group_rows: int = GROUP_ROWS) -> DataFrame:
    """JOIN-10: replace each word by its ids, as ``to``, keeping all documents and their word order. ``pieces`` is (word, ids)."""
    def ids(row, held):
        return [i for word in row for i in held.get(word, (unknown,))]

    return translated(df, key, words, pieces.select("word", "ids"), ids, StructField(to, ArrayType(IntegerType())), group_rows)


def decode(df: DataFrame, key: str, ids: str, vocab: DataFrame, joiner: str = " ", unknown: str = "<unk>",
           group_rows: int = GROUP_ROWS) -> DataFrame:
    """ENC-7: (key, text) from ids."""
    def text(row, held):
        return joiner.join(held.get(i, unknown) for i in row)

    rows = df.select(key, F.col(ids).alias("_ids"))
    found = translated(rows, key, F.col("_ids"), vocab.select("id", "piece"), text, StructField("text", StringType()), group_rows)
    return found.select(key, "text")


def starts(rows: DataFrame, shard: str) -> DataFrame:
    """Column ``_start``: the sum of ``_size`` over the rows of the shard that come earlier by ``_order``."""
    ranged = with_quantile_bucket(rows, "_order", "_range")
    before = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(shard, "_range").agg(F.sum("_size").alias("_sum")).select(
        F.col(shard).alias("_shard"), F.col("_range").alias("_at"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(shard, "_range").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_start", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    met = summed.join(offsets, F.col(shard).eqNullSafe(F.col("_shard")) & F.col("_range").eqNullSafe(F.col("_at")))
    return met.withColumn("_start", F.col("_start") + F.col("_before")).drop("_shard", "_at", "_before", "_range", "_size")


def pack_blocks(df: DataFrame, shard: str, order: str, ids: str, length: int = 512) -> DataFrame:
    """WIN-2: (shard, block, input_ids) of exactly ``length`` ids; each shard drops its tail.

    A shard is one batch of consecutive rows, however large: its rows are cut into ranges at quantiles of ``order``, sizes are
    summed within a range and the sums of earlier ranges are added, so one shard with most of the rows is placed by many tasks.
    Each row is cut at block borders, so pieces move rather than single tokens.
    """
    # stored once: the cuts of the ranges, their sums and the rows are read separately
    rows = durable(df.select(shard, F.col(order).alias("_order"), F.col(ids).alias("_ids"), F.size(ids).alias("_size")))
    placed = starts(rows, shard)
    placed = placed.where(F.size("_ids") > 0)
    end = F.col("_start") + F.size("_ids")
    blocks = F.sequence(F.floor(F.col("_start") / length), F.floor((end - 1) / length))

    def piece(block):
        low = F.greatest(block * length, F.col("_start"))
        high = F.least((block + 1) * length, end)
        return F.struct(
            block.alias("block"), low.alias("at"),
            F.slice("_ids", (low - F.col("_start") + 1).cast("int"), (high - low).cast("int")).alias("part"))

    pieces = placed.select(shard, F.inline(F.transform(blocks, piece)))
    joined = pieces.groupBy(shard, "block").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("_parts"))
    return joined.select(
        shard, "block", F.flatten(F.transform("_parts", lambda p: p["part"])).alias("input_ids")
    ).where(F.size("input_ids") == length)


def bucket_by_length(df: DataFrame, key: str, ids: str, seed, batch_size: int, step: int = 8) -> DataFrame:
    """SRT-3: batches of rows whose length rounds up to the same multiple of ``step``.

    ``padded_length`` is the longest row of the batch, rounded up.
    """
    # stored once, so that ids are neither made again for the ranks nor moved with them where nobody asks for them
    sized = durable(df.withColumn("_size", F.size(ids)))
    bucketed = sized.withColumn("bucket", A.round_up(F.col("_size"), step))
    draw = draw_key(seed, key)
    placed = position(bucketed, "_pos", [draw, F.col(key)], draw_bucket(draw), by=("bucket",))
    batched = placed.withColumn("batch", F.floor(F.col("_pos") / batch_size).cast("long")).drop("_pos")
    longest = F.max("_size").over(Window.partitionBy("bucket", "batch"))
    return batched.withColumn("padded_length", A.round_up(longest, step)).drop("_size")


def role_batch(df: DataFrame, tokens: str, ids: str, length, pad_id: int = 0) -> DataFrame:
    """ENC-6: aligned input ids, role ids, mask and role labels, padded to ``length`` (a number or a column)."""
    return (
        df.withColumn("role_ids", A.pad(T.role_tags(F.col(tokens)), length, T.ROLES["PAD"]))
        .withColumn("input_ids", A.pad(ids, length, pad_id))
        .withColumn("attention_mask", A.attention_mask("input_ids", pad_id))
        .withColumn("role_labels", A.role_labels("role_ids", "input_ids", pad_id))
    )
