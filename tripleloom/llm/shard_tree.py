"""Sharding by a hierarchical weighted hash tree, in built-in functions.

A row descends from the root to a region, a rack and a shard. On each level every child draws
-ln(u) / weight, where u in (0, 1) is a hash of the child's name and the row's key, and the least draw
wins, so that a child gets rows in proportion to its weight. A node's weight is the sum of its
shards' weights. If a shard's weight changes, rows move only into or out of the subtrees whose weight
changed; the draws between all others are as before.

A shard that joins later draws at the root beside the regions, with its own weight: then it takes its
share from all of them, and no other shard gets a row by it. (Put into a rack, its weight would pull
rows into that region that then descend to its older shards.)

Null ids are the key of the empty text; a null text counts as empty. Repeated rows get the same shard
and slots of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import id_and_text


@dataclass(frozen=True)
class ShardTree:
    """`regions`: for each region its racks, for each rack its shards' weights; shards are numbered in that order.

    `joined`: the weights of shards that joined later, numbered after those of the regions.
    """

    regions: tuple[tuple[tuple[float, ...], ...], ...] = ((((1.0,) * 2,) * 4),) * 3
    joined: tuple[float, ...] = field(default=())

    def grown(self, weight: float = 1.0) -> ShardTree:
        return ShardTree(self.regions, (*self.joined, weight))

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region) + len(self.joined)


def draw(name: Column, weight: Column, key: Column) -> Column:
    """-ln(u) / weight, u from the first 13 hexadecimal digits of the md5 of name and key; infinite without weight."""
    digits = F.substring(F.md5(F.concat(name, F.lit(":"), key).cast("binary")), 1, 13)
    unit = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**13))
    return F.when(weight > 0, -F.log(unit) / weight).otherwise(F.lit(float("inf")))


def least(children: Column, key: Column) -> Column:
    """(draw, place) of the child of least draw in an array of (name, weight, ...)."""
    return F.array_min(F.transform(children, lambda c, i: F.struct(draw(c["name"], c["weight"], key).alias("draw"), i.alias("place"))))


def _listed(children: list[tuple]) -> Column:
    names = ("name", "weight", "number")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, c)]) for c in children])


def descended(rows: DataFrame, tree: ShardTree) -> DataFrame:
    """`rows`, which have a column `key`, with `shard` and `top`, the least (draw, place) at the root."""
    key, regions = F.col("key"), tree.regions
    count = sum(len(rack) for region in regions for rack in region)
    root = [(f"region-{r}", float(sum(map(sum, region)))) for r, region in enumerate(regions)]
    root += [(f"shard-{count + i}", float(w)) for i, w in enumerate(tree.joined)]
    racks, leaves, number = [], [], 0
    for r, region in enumerate(regions):
        racks.append(_listed([(f"rack-{r}-{k}", float(sum(rack))) for k, rack in enumerate(region)]))
        leaves.append([])
        for rack in region:
            leaves[-1].append(_listed([(f"shard-{number + i}", float(w), number + i) for i, w in enumerate(rack)]))
            number += len(rack)
    place = F.col("top.place")
    found = rows.withColumn("top", least(_listed(root), key)).withColumn("region", F.least(place, F.lit(len(regions) - 1)) + 1)
    found = found.withColumn("rack", least(F.element_at(F.array(*racks), F.col("region")), key)["place"] + 1)
    of_rack = F.element_at(F.element_at(F.array(*[F.array(*row) for row in leaves]), F.col("region")), F.col("rack"))
    found = found.withColumn("leaf", F.element_at(of_rack, least(of_rack, key)["place"] + 1)["number"])
    late = place - len(regions)
    return found.withColumn("shard", F.when(late >= 0, late + count).otherwise(F.col("leaf"))).drop("region", "rack", "leaf")


def key_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def sharded(docs: DataFrame, tree: ShardTree) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of all rows.

    `grown_shard` is the shard in `tree.grown()`: the new shard's draw against the least one at the root.

    `slot` numbers the rows of a shard from 0 without gaps. Rows are numbered within 4096 parts of each
    shard, and the parts' sizes, summed up before, say where each begins: no shard meets in one task.
    """
    rows = id_and_text(docs).withColumn("key", key_of(F.col("doc_id")))
    text, key = F.coalesce("text", F.lit("")), F.col("key")
    part = F.conv(F.substring(F.md5(F.concat(F.lit("slot:"), key).cast("binary")), 1, 3), 16, 10).cast("int")
    joins = draw(F.lit(f"shard-{tree.shards}"), F.lit(1.0), key)
    placed = descended(rows, tree).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "shard",
        part.alias("part"),
        F.when(joins < F.col("top.draw"), F.lit(tree.shards)).otherwise(F.col("shard")).alias("grown_shard"),
    )
    sizes = descended(rows.select("key"), tree).groupBy("shard", part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.selectExpr("shard", "part", "sum(n) over (partition by shard order by part) - n as before")
    numbered = placed.selectExpr(
        "*", "row_number() over (partition by shard, part order by doc_id, text_crc32, size) - 1 as place"
    )
    return numbered.join(before, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"),
        "grown_shard",
    )


def sql(tree: ShardTree) -> str:
    """The same rows as `sharded` as DuckDB SQL over the view `documents`, with the column `law`."""

    def draw(name: str, weight: float) -> str:
        return f"-ln((('0x' || substr(md5('{name}:' || k), 1, 13))::BIGINT + 0.5) / {16**13}.0) / {weight}"

    def won(children: list[tuple[str, float, str]]) -> str:
        if len(children) == 1:
            return children[0][2]
        listed = ", ".join(draw(n, w) for n, w, _ in children)
        cases = " ".join(f"WHEN {i + 1} THEN {c}" for i, (_, _, c) in enumerate(children))
        return f"CASE list_position([{listed}], list_min([{listed}])) {cases} END"

    def tree_sql(t: ShardTree) -> str:
        number, top = 0, []
        for r, region in enumerate(t.regions):
            racks = []
            for n, rack in enumerate(region):
                leaves = [(f"shard-{number + i}", w, str(number + i)) for i, w in enumerate(rack)]
                number += len(rack)
                racks.append((f"rack-{r}-{n}", sum(rack), won(leaves)))
            top.append((f"region-{r}", sum(map(sum, region)), won(racks)))
        for weight in t.joined:
            top.append((f"shard-{number}", weight, str(number)))
            number += 1
        return won(top)

    return f"""
WITH RECURSIVE crc_steps(b, c, i) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM crc_steps WHERE i < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_steps WHERE i = 8),
rows_in AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
placed AS (
  SELECT doc_id, strlen(text) + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'),
          lambda h: ('0x' || h)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
    ({tree_sql(tree)})::INTEGER AS shard, ({tree_sql(tree.grown())})::INTEGER AS grown_shard,
    ('0x' || substr(md5('slot:' || k), 1, 3))::INTEGER AS part
  FROM rows_in CROSS JOIN crc_table)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM placed"""
