"""Syntax graphs as node and edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

from codelake.functions.code import code_facts, node_types, syntax_of
from codelake.session import durable


def syntax_nodes(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """GRF-1: (doc, nid, type, parent), numbered breadth first; unreadable text is one unknown node."""
    graph = df.select(F.col(key).alias("doc"), code_facts(F.col(text), "graph")["graph"].alias("g"))
    nodes = F.transform(F.arrays_zip("g.types", "g.parents"), lambda n: F.struct(
        n["types"].alias("type"), n["parents"].alias("parent")))
    rows = graph.select("doc", F.posexplode(nodes).alias("nid", "n"))
    return rows.select("doc", "nid", "n.type", "n.parent")


class SyntaxRows:
    """The table function behind :func:`syntax_rows`: a row per node of each program of its table argument."""

    @staticmethod
    def analyze(programs: AnalyzeArgument) -> AnalyzeResult:
        key = programs.dataType.fields[0]
        schema = StructType([StructField("doc", key.dataType), StructField("nid", IntegerType()),
                             StructField("type", StringType()), StructField("parent", IntegerType())])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key.name)])

    def eval(self, programs: Row) -> Iterator[tuple]:
        doc, text = programs[:2]
        graph = syntax_of(text)
        for nid, (name, parent) in enumerate(zip(graph["types"], graph["parents"])):
            yield doc, nid, name, parent


def syntax_rows(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """UDF-4: GRF-1's nodes from a Python table function, its table argument partitioned by ``key``.

    Rows of one key come to one call of the function after another, so a caller may keep state per program. A null text
    counts as unreadable. :func:`syntax_nodes` gives the same rows without a shuffle.
    """
    return udtf(SyntaxRows)(df.select(key, text).asTable())


def type_ids(spark) -> DataFrame:
    """GRF-1: the fixed dictionary (type, type_id): 0 for unknown, then the grammar's types by name."""
    rows = [("<unk>", 0), *((name, i) for i, name in enumerate(node_types(), 1))]
    return spark.createDataFrame(rows, "type string, type_id int")


def syntax_edges(nodes: DataFrame) -> DataFrame:
    """GRF-1: (doc, src, dst), both directions of every parent link."""
    links = F.array(
        F.struct(F.col("parent").alias("src"), F.col("nid").alias("dst")),
        F.struct(F.col("nid").alias("src"), F.col("parent").alias("dst")))
    return nodes.where("parent >= 0").select("doc", F.inline(links))


def syntax_graph(df: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """GRF-1: node and edge tables; the nodes are stored, since every later step reads them."""
    nodes = durable(syntax_nodes(df, key, text))
    return nodes, syntax_edges(nodes)


def propagate_rows(df: DataFrame, key: str, text: str = "text", rounds: int = 2) -> DataFrame:
    """GRF-2 for graphs that lie whole in their rows: (doc, type, value) without a shuffle.

    The graph of a program is local to its row, so degrees and rounds are counted on its parent positions where the row
    lies. ``propagate`` does the same for node and edge tables of any graph.
    """

    @F.pandas_udf("array<struct<type:string,value:double>>")
    def smoothed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for graphs in batches:
            yield pd.Series([type_shares(t, np.asarray(p), rounds) for t, p in zip(graphs["types"], graphs["parents"])])

    graph = df.select(F.col(key).alias("doc"), code_facts(F.col(text), "graph")["graph"].alias("g"))
    return graph.select("doc", F.inline(smoothed("g")))


def type_shares(types: list[str], parents: np.ndarray, rounds: int) -> list[dict]:
    """Values by type of one graph: one number per node goes to its neighbours and back."""
    child = np.flatnonzero(parents >= 0)
    parent = parents[child]
    degree = 1 + np.bincount(parent, minlength=len(parents)) + (parents >= 0)
    scale, x = 1 / np.sqrt(degree), np.ones(len(parents))
    for _ in range(rounds):
        sent = x * scale
        got = sent + np.bincount(parent, sent[child], len(parents))
        got[child] += sent[parent]
        x = got * scale
    names, which = np.unique(np.asarray(types, dtype=str), return_inverse=True)
    sums = np.bincount(which, x)
    return [{"type": str(n), "value": float(v)} for n, v in zip(names, sums / np.sqrt((sums * sums).sum()))]


def propagate(nodes: DataFrame, edges: DataFrame, rounds: int = 2) -> DataFrame:
    """GRF-2: smooth one-hot node types over the graph, mean per document, unit length.

    Returns (doc, type, value). With S = D^-1/2 (A + I) D^-1/2 the mean over nodes of
    S^r X is the row vector (1/N) 1'S^r X, and S is symmetric: so r rounds on one number
    per node, summed by type at the end, replace r rounds on a vector per node.
    """
    at = ["doc", "nid"]
    ends = edges.select("doc", F.col("src").alias("nid")).unionByName(nodes.select(*at))
    state = ends.groupBy(*at).agg((1 / F.sqrt(F.count(F.lit(1)))).alias("scale")).withColumn("x", F.lit(1.0))
    for _ in range(rounds):
        own = state.select(*at, (F.col("x") * F.col("scale")).alias("sent"))
        across = edges.join(own.withColumnRenamed("nid", "src"), ["doc", "src"])
        got = across.select("doc", F.col("dst").alias("nid"), "sent").unionByName(own).groupBy(*at).agg(
            F.sum("sent").alias("got"))
        state = state.join(got, at).select(*at, "scale", (F.col("got") * F.col("scale")).alias("x"))
    by_type = nodes.join(state, at).groupBy("doc", "type").agg(F.sum("x").alias("sum"))
    # the mean's 1/N cancels in the unit length
    norm = F.sqrt(F.sum(F.col("sum") * F.col("sum")).over(Window.partitionBy("doc")))
    return by_type.select("doc", "type", (F.col("sum") / norm).alias("value"))
