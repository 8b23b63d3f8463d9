import hashlib
import math
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F
from tests_llm_helpers import documents

from tripleloom.llm import shard_tree
from tripleloom.llm.queries import op4_hash_tree
from tripleloom.llm.shard_tree import ShardTree


def unit(name, key):
    return (int(hashlib.md5(f"{name}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13


def slow_shard(tree, key):
    def won(children):
        return min((-math.log(unit(n, key)) / w, i) for i, (n, w) in enumerate(children) if w)[1]

    numbers, n = [], 0
    for region in tree.regions:
        numbers.append([])
        for rack in region:
            numbers[-1].append(range(n, n + len(rack)))
            n += len(rack)
    top = [(f"region-{r}", sum(map(sum, x))) for r, x in enumerate(tree.regions)] + [(f"shard-{n + i}", w) for i, w in enumerate(tree.joined)]
    r = won(top)
    if r >= len(tree.regions):
        return n + r - len(tree.regions)
    k = won([(f"rack-{r}-{k}", sum(rack)) for k, rack in enumerate(tree.regions[r])])
    return numbers[r][k][won([(f"shard-{s}", w) for s, w in zip(numbers[r][k], tree.regions[r][k])])]


def placed(spark, tree, n=6000):
    rows = spark.range(n).withColumn("key", F.col("id").cast("string"))
    return {r["id"]: r["shard"] for r in shard_tree.descended(rows, tree).collect()}


UNEVEN = ShardTree((((1.0, 2.0), (3.0,)), ((1.0, 0.0, 1.0),), ((0.5,), (0.5,), (4.0, 1.0))), (2.0,))


def test_descent_matches_brute_force_and_weights(spark):
    found = placed(spark, UNEVEN)
    assert all(found[i] == slow_shard(UNEVEN, str(i)) for i in range(0, 6000, 7))
    weights = [w for region in UNEVEN.regions for rack in region for w in rack] + list(UNEVEN.joined)
    counts = Counter(found.values())
    for shard, weight in enumerate(weights):
        expected = 6000 * weight / sum(weights)
        assert abs(counts[shard] - expected) <= 5 * math.sqrt(expected) + 1


def test_a_joining_shard_only_takes(spark):
    tree = ShardTree()
    for _ in range(3):
        before, tree = placed(spark, tree), tree.grown()
        after = placed(spark, tree)
        moved = {i for i in before if before[i] != after[i]}
        assert moved and {after[i] for i in moved} == {tree.shards - 1}


def test_movement_stays_in_changed_subtrees(spark):
    """More weight for one rack: rows come into its region, and within it into that rack; none moves elsewhere."""
    heavier = ShardTree((((1.0, 2.0), (6.0,)), *UNEVEN.regions[1:]), UNEVEN.joined)
    before, after = placed(spark, UNEVEN), placed(spark, heavier)
    region, rack = {0: 0, 1: 0, 2: 0}, {0: 0, 1: 0, 2: 1}
    moved = [(before[i], after[i]) for i in before if before[i] != after[i]]
    assert moved and all(region.get(b) == 0 for _, b in moved)
    assert all(rack[b] == 1 for a, b in moved if region.get(a) == 0)


def test_rows(spark, awkward, no_documents):
    rows = shard_tree.sharded(awkward, ShardTree()).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["shard"] == slow_shard(ShardTree(), "" if r["doc_id"] is None else str(r["doc_id"]))
        assert r["grown_shard"] == slow_shard(ShardTree().grown(), "" if r["doc_id"] is None else str(r["doc_id"]))
    assert len(rows) == 12 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_tree.sharded(no_documents, ShardTree()).count() == 0


def test_against_sql(spark, tiny):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tiny}/documents.parquet'")
    cursor = con.execute(shard_tree.sql(ShardTree()))
    names = [d[0] for d in cursor.description]
    found = op4_hash_tree(spark, tiny)
    assert sorted(names) == sorted(found.columns)
    assert sorted(tuple(r[n] for n in names) for r in found.collect()) == sorted(cursor.fetchall())


def test_no_python_in_the_plan(spark):
    plan = shard_tree.sharded(documents(spark, [(1, "a")]), ShardTree())._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
