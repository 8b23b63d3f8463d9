"""Connected components of links, and the splitting of large groups into blocks, as Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the smallest node that can be reached.

    Alternates two steps until nothing changes: every node passes its smallest neighbour to its
    larger neighbours, then to its smaller ones. Each is an aggregation with map-side combine and a
    join that adaptive execution splits at hot nodes, and halves the paths, so that the rounds grow
    with the logarithm of the longest path. Loops and repeated links do no harm.
    """
    edges = cut(_ordered(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))))
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = cut(_smaller(_larger(edges)))
    return nodes.join(edges.select(F.col("b").alias("node"), F.col("a").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, with the smaller node as `a`."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _larger(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node with the smallest one among the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _ordered(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _smaller(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours with the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return _ordered(joined.select("a", F.col("m").alias("b")).union(least.select(F.col("m").alias("a"), "b")))


def with_components(rows: DataFrame, node: str, links: DataFrame) -> DataFrame:
    """`rows` with the column `component` of their node; nodes without a link are their own."""
    found = components(links).select(F.col("node").alias("\0node"), "component")
    return rows.join(found, rows[node] == found["\0node"], "left").select(
        *[rows[c] for c in rows.columns], F.coalesce("component", rows[node]).alias("component")
    )


def block_pairs(rows: DataFrame, size: Column, block: int, salt: Column) -> DataFrame:
    """`rows` dealt to pairs of blocks of about `block` rows, so that every two rows of a group meet in one task.

    `size` is the number of rows of a row's group. Adds `low` and `high`, the blocks of the task, and
    `own`, the row's block. Two rows of one block meet in the task (own, own) only.
    """
    blocks = F.ceil(size / F.lit(block)).cast("int")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64(salt), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select(
        "*", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    ).drop("other")


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the symmetric matrix `linked` connects, one for each row but the first of a component."""
    left = np.ones(len(linked), bool)
    out: list[tuple[int, int]] = []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            row = queue.pop()
            new = np.flatnonzero(linked[row] & left)
            left[new] = False
            out += [(row, n) for n in new.tolist()]
            queue += new.tolist()
    return out
