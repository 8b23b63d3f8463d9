import random

import numpy as np
from pyspark.sql import functions as F

from tripleloom.llm.groups import block_pairs, components, forest


def least_nodes(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in list(parent)}


def test_components_match_union_find(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 580)] + [(7, 7), (3, 9), (9, 3)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(130)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {k: v for k, v in least_nodes([x for x in links if x[0] != x[1]]).items()}
    assert got == expected


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_bring_every_two_rows_together_once(spark):
    rows = spark.range(50).withColumn("group", F.lit("g"))
    dealt = block_pairs(rows, F.lit(50), 12, F.col("id")).collect()
    tasks = {}
    for r in dealt:
        tasks.setdefault((r["low"], r["high"]), []).append((r["id"], r["own"]))
    met = {}
    for (low, high), found in tasks.items():
        for i, (a, x) in enumerate(found):
            for b, y in found[:i]:
                if low == high or x != y:
                    met[frozenset((a, b))] = met.get(frozenset((a, b)), 0) + 1
    assert len(met) == 50 * 49 // 2 and set(met.values()) == {1}


def test_forest_connects_what_the_matrix_connects():
    rng = np.random.default_rng(2)
    linked = rng.random((40, 40)) < 0.03
    linked = linked | linked.T
    a, b = np.nonzero(np.triu(linked, 1))
    assert least_nodes(zip(a.tolist(), b.tolist())) == least_nodes(forest(linked))
