"""Near copies among vectors by randomised-rotation binary codes.

Unit vectors are rotated by a random orthogonal matrix and stored as signs, with the correction factor
<signs / sqrt(d), rotated vector>. The signs' inner product with another rotated vector, divided by the
factor, is an unbiased estimate of the two vectors' inner product, and the factor gives a bound that
the error rarely exceeds. Pairs whose upper bound is below the threshold are dismissed; all others are
computed anew from the vectors in double precision, so no link below the threshold is returned.

Which pairs are estimated is decided by buckets: in each of several tables a bucket is the signs of
some more random directions. Their number per table follows the logarithm of the number of vectors, and
the number of tables follows from the recall asked for at the threshold. A pair counts in the first
table in which it meets. Equal vectors are one with a number of copies, and large buckets are cut into
blocks which meet two by two, so that no task holds more than two blocks.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their
own component; so do vectors of different lengths among each other. Rows that repeat an id count each.
Rows with a null id are left out of links and have a null component. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.bit_sliced import usable
from tripleloom.llm.common import cut
from tripleloom.llm.groups import block_pairs, components, forest

#: Times the standard error of an estimate that its bound allows for.
DEVIATIONS = 3.0
BLOCK = 1024


def rotation(size: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([size, number]).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def directions(size: int, count: int) -> np.ndarray:
    """`count` random directions as columns, orthogonal in runs of `size`."""
    return np.concatenate([rotation(size, 1 + i) for i in range(-(-count // size))], axis=1)[:, :count]


def tables_for(vectors: int, least: float, recall: float) -> tuple[int, int]:
    """(bits of a bucket, number of tables): buckets of some 64 vectors that find a pair at `least` with `recall`."""
    bits = max(6, math.ceil(math.log2(max(vectors, 2))) - 6)
    meet = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, correction factors) of unit vectors."""
    turned = unit @ rotation(unit.shape[1], 0)
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def upper_bounds(unit: np.ndarray, signs: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """For all pairs, the most that their inner product can be by the estimates from either side."""
    size = unit.shape[1]
    if size < 3:
        return np.ones((len(unit), len(unit)))
    turned = (unit @ rotation(size, 0)).astype(np.float32)
    bits = np.unpackbits(signs, axis=1, count=size).astype(np.float32) * 2 - 1
    estimate = (bits @ turned.T) / (math.sqrt(size) * factor[:, None])
    error = np.sqrt(np.maximum(1 - factor**2, 0)) / factor * DEVIATIONS / math.sqrt(size - 1)
    bound = estimate + error[:, None]
    return np.minimum(bound, bound.T)


def bucketed(unique: DataFrame, bits: int, tables: int, wide: int) -> DataFrame:
    """(length, t, area, bucket, keys, node, copies, signs, factor, v): each vector in each table.

    An area is 2^wide neighbouring buckets: a task compares only rows of one bucket, but loads an area.
    """
    kind = (
        "length int, t int, area int, bucket int, keys binary, node long, copies long, signs binary, factor double, "
        "v array<double>"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for _, group in whole.groupby(whole["v"].map(len)):
                for start in range(0, len(group), 500):
                    part = group.iloc[start : start + 500]
                    x = np.stack(part["v"])
                    x = x / np.abs(x).max(1, keepdims=True)
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    signs, factor = codes(unit)
                    side = (unit @ directions(unit.shape[1], bits * tables) >= 0).reshape(len(part), tables, bits)
                    keys = (side @ (1 << np.arange(bits))).astype(np.int32)
                    base = pd.DataFrame({
                        "length": np.int32(unit.shape[1]), "keys": [k.tobytes() for k in keys], "node": part["node"].to_numpy(),
                        "copies": part["copies"].to_numpy(), "signs": [s.tobytes() for s in signs], "factor": factor,
                        "v": list(part["v"]),
                    })
                    for t in range(tables):
                        out = base.assign(t=np.int32(t), bucket=keys[:, t], area=keys[:, t] >> wide)
                        yield out[[c.split()[0] for c in kind.split(", ")]]

    return unique.mapInPandas(run, kind)


def linked_rows(vectors: DataFrame, least: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(unique vectors: v, node, copies), (a, b, n): links a-b of a spanning forest, and a's n linked rows where b is null."""
    good = usable(vectors, "vec_id", "embedding").where(F.exists("v", lambda x: x != 0))
    unique = cut(good.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    n = unique.count()
    bits, tables = tables_for(n, least, recall)
    wide = max(0, round(math.log2(400 / max(n / 2**bits, 1e-3)))) if n else 0
    rows = bucketed(unique, bits, tables, min(wide, bits))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group["v"])
        scaled = x / np.abs(x).max(1, keepdims=True)
        norm = np.linalg.norm(scaled, axis=1)
        unit = scaled / norm[:, None]
        t, bucket, own = int(group["t"].iloc[0]), group["bucket"].to_numpy(), group["own"].to_numpy()
        signs = np.stack([np.frombuffer(s, np.uint8) for s in group["signs"]])
        close = bucket[:, None] == bucket[None, :]
        if group["low"].iloc[0] != group["high"].iloc[0]:
            close &= own[:, None] != own[None, :]
        close &= upper_bounds(unit, signs, group["factor"].to_numpy()) >= least
        a, b = np.nonzero(np.triu(close, 1))
        keys = np.stack([np.frombuffer(k, np.int32) for k in group["keys"]])
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        linked = np.zeros(close.shape, bool)
        degree = np.zeros(len(node), np.int64)
        for start in range(0, len(a), 100_000):
            i, j = a[start : start + 100_000], b[start : start + 100_000]
            first = ~(keys[i, :t] == keys[j, :t]).any(1)
            i, j = i[first], j[first]
            exact = np.einsum("nd,nd->n", scaled[i], scaled[j]) / (norm[i] * norm[j])
            i, j = i[exact >= least], j[exact >= least]
            linked[i, j] = linked[j, i] = True
            np.add.at(degree, i, copies[j])
            np.add.at(degree, j, copies[i])
        tree = np.array(forest(linked), np.int64).reshape(-1, 2)
        some = np.flatnonzero(degree)
        return pd.concat([
            pd.DataFrame({"a": node[tree[:, 0]], "b": pd.array(node[tree[:, 1]], "Int64"), "n": np.zeros(len(tree), np.int64)}),
            pd.DataFrame({"a": node[some], "b": pd.array([None] * len(some), "Int64"), "n": degree[some]}),
        ])

    sizes = rows.select("length", "t", "area").groupBy("length", "t", "area").agg(F.count("*").alias("size")).where("size > 1")
    dealt = block_pairs(rows.join(sizes, ["length", "t", "area"]), F.col("size"), BLOCK, F.col("node"))
    found = dealt.groupBy("length", "t", "area", "low", "high").applyInPandas(compare, "a long, b long, n long")
    return unique, cut(found)


def near_vectors(vectors: DataFrame, least: float = 0.95, recall: float = 0.995) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: how many other rows reach a cosine of `least` with it."""
    unique, found = linked_rows(vectors, least, recall)
    joined = components(found.where("b is not null").select("a", "b"))
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    known = unique.join(joined, "node", "left").join(links, "node", "left").select(
        F.col("v").alias("of_v"), F.coalesce("component", "node").alias("found_id"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("found_links"),
    )
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("v")
    )
    component = F.coalesce("found_id", "vec_id")
    return rows.join(known, F.col("v") == F.col("of_v"), "left").select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("found_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
        F.when(F.col("vec_id").isNotNull(), F.col("vec_id") == component).alias("kept"),
    )
