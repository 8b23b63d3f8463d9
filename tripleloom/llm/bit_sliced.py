"""Exact top-k search by inner product over a bit-sliced index.

Components are quantised to integers. A part of the rows keeps, for each component, one bitmap over its
rows for each binary digit; 64 parts are put side by side for a search. A query's scores are summed as bitmaps: each non-zero digit of a
query component adds the component's slices at that weight (their complement for a negative digit), and
three bitmaps of one weight become one of this and one of the next weight until one is left of each.
The top rows are then chosen from the most significant slice downward; rows that stay equal in all
slices tie at the boundary, and the smallest ids among them fill the rest.

Every query meets every part of the index, as the question demands: packed parts and chunks of queries
meet in tasks of bounded size, each of which returns its k best rows of each query.

Vectors that are null, empty or hold null or non-finite components take no part, as query or as
candidate. Vectors of different lengths have no inner product and don't meet. Rows that repeat an id
count each, and all rows of the query's own id are left out. Components of any finite size are whole numbers
of their own, so scores differ wherever the true ones do and ranks follow them; a score beyond the range of a
long is null, its rank stays. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Integers of fewer bits are numpy's; larger ones are Python's, in arrays of objects.
_PLAIN = 52


def floored(x: float, scale: float) -> int:
    return math.floor(Fraction(x) * Fraction(scale))


def quantised(vectors: np.ndarray, scale: float) -> np.ndarray:
    scaled = vectors.astype(np.float64) * scale
    if not scaled.size or np.abs(scaled).max() < 2.0**_PLAIN:
        return np.floor(scaled).astype(np.int64)
    exact = [floored(x, scale) for x in vectors.astype(np.float64).ravel().tolist()]
    return np.array([*exact, None], object)[:-1].reshape(vectors.shape)


def packed(values: np.ndarray, low: int, digits: int) -> np.ndarray:
    """Bitmaps of a matrix of integers from `low`: [d, j] has digit j of component d, a bit for each row."""
    plain = digits <= _PLAIN + 1 and abs(low) < 2**_PLAIN
    shifted = values.astype(np.int64) - low if plain else values.astype(object) - low
    bits = np.zeros((values.shape[1], digits, -(-len(values) // 64) * 8), np.uint8)
    for j in range(digits):
        plane = ((shifted >> j) & 1).astype(np.uint8)
        bits[:, j, : -(-len(values) // 8)] = np.packbits(plane.T, axis=1, bitorder="little")
    return bits.view(np.uint64)


def signed_digits(n: int) -> list[tuple[int, int]]:
    """(weight, 1 or -1) of a number in non-adjacent form, which has the fewest non-zero digits."""
    out, weight = [], 0
    while n:
        if n & 1:
            digit = 2 - (n & 3)
            out.append((weight, digit))
            n -= digit
        n >>= 1
        weight += 1
    return out


def score_slices(query: np.ndarray, low: int, slices: np.ndarray) -> tuple[list[np.ndarray | None], int]:
    """Bitmaps of the scores by weight, and the constant that makes them the inner products."""
    digits = slices.shape[1]
    full = (1 << digits) - 1
    plus: dict[int, list[tuple[int, int]]] = {}
    minus: dict[int, list[tuple[int, int]]] = {}
    constant = low * sum(query.tolist())
    for d, value in enumerate(query.tolist()):
        for weight, sign in signed_digits(value):
            constant -= (full << weight) if sign < 0 else 0
            for j in range(digits):
                (plus if sign > 0 else minus).setdefault(weight + j, []).append((d, j))
    out: list[np.ndarray | None] = []
    carried: list[np.ndarray] = []
    weight, last = 0, max([-1, *plus, *minus])
    while weight <= last or carried:
        parts = carried
        for places, flip in ((plus.get(weight), False), (minus.get(weight), True)):
            if places:
                d, j = np.array(places).T
                parts.append(~slices[d, j] if flip else slices[d, j])
        carried = []
        rows = np.concatenate(parts) if parts else None
        while rows is not None and len(rows) > 1:
            if len(rows) == 2:
                carried.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
                break
            n = len(rows) // 3
            a, b, c = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
            differs = a ^ b
            carried.append((a & b) | (differs & c))
            rows = np.concatenate([differs ^ c, rows[3 * n :]])
        out.append(None if rows is None else rows[0])
        weight += 1
    return out, constant


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def places_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(sums: list[np.ndarray | None], candidates: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k candidates of highest score, the smaller id first among equal ones."""
    if _count(candidates) <= k:
        return places_of(candidates)
    sure, even, missing = np.zeros_like(candidates), candidates, k
    for bitmap in reversed(sums):
        if bitmap is None:
            continue
        higher = even & bitmap
        n = _count(higher)
        if n >= missing:
            even = higher
            if n == missing:
                break
        else:
            sure, even, missing = sure | higher, even & ~bitmap, missing - n
    rest = places_of(even)
    return np.concatenate([places_of(sure), rest[np.argsort(ids[rest], kind="stable")[:missing]]])


def scores_at(sums: list[np.ndarray | None], constant: int, places: np.ndarray) -> list[int]:
    out = [constant] * len(places)
    for weight, bitmap in enumerate(sums):
        if bitmap is not None:
            bits = (bitmap[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)
            out = [o + (int(b) << weight) for o, b in zip(out, bits, strict=True)]
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows whose id is known and whose vector is not empty and all of finite numbers."""
    v = F.col("v")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad)


def top_k(
    vectors: DataFrame, queries: F.Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
    vector_col: str = "embedding", part: int = 1024, parts: int = 64, chunk: int = 512,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row that meets `queries`.

    `queries` is a condition on `vec_id`. The index is packed in parts of about `part` rows, and `parts`
    of them are searched together by `chunk` queries at a time.
    """
    rows = usable(vectors, id_col, vector_col).withColumn("length", F.size("v"))
    n, least, most = rows.agg(F.count("*"), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    low, high = (floored(x or 0.0, scale) for x in (least, most))
    digits = max(1, (high - low).bit_length())
    # scores as bytes of one width, in whose order they fall; a vector's length is below 2^31
    width = (2 * max(abs(low), abs(high)).bit_length() + 31 + 2) // 8 + 1
    asked = rows.where(queries)
    pieces, chunks = max(1, -(-n // part)), max(1, -(-asked.count() // chunk))
    blocks = -(-pieces // parts)
    place = F.xxhash64("vec_id")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        bits = packed(quantised(np.stack(group["v"]), scale), low, digits)
        return pd.DataFrame({
            "length": [len(bits)], "block": [int(group["piece"].iloc[0]) // parts],
            "ids": [group["vec_id"].to_numpy().tobytes()], "bits": [bits.tobytes()],
        })

    def search(index: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        if len(index) and len(given):
            held = [np.frombuffer(b, np.int64) for b in index["ids"]]
            length = int(index["length"].iloc[0])
            slices = np.concatenate([np.frombuffer(b, np.uint64).reshape(length, digits, -1) for b in index["bits"]], axis=2)
            # a part's bitmaps end on a word: places without a row have an id, but are no candidates
            ids = np.concatenate([np.append(h, np.zeros(-len(h) % 64, np.int64)) for h in held])
            taken = np.concatenate([np.append(np.ones(len(h), np.uint8), np.zeros(-len(h) % 64, np.uint8)) for h in held])
            for query_id, query in zip(given["vec_id"].tolist(), quantised(np.stack(given["v"]), scale), strict=True):
                sums, constant = score_slices(query, low, slices)
                others = np.packbits(taken & (ids != query_id), bitorder="little").view(np.uint64)
                places = top_rows(sums, others, ids, k)
                scores = scores_at(sums, constant, places)
                keys = [(s + (1 << (8 * width - 1))).to_bytes(width) for s in scores]
                plain = [s if -(1 << 63) <= s < 1 << 63 else None for s in scores]
                found += zip([query_id] * len(scores), ids[places].tolist(), plain, keys, strict=True)
        out = pd.DataFrame(found, columns=["query_id", "vec_id", "score", "key"], dtype=object)
        return out.astype({"query_id": "int64", "vec_id": "int64", "score": "Int64"})

    index = rows.withColumn("piece", F.pmod(place, F.lit(pieces))).groupBy("length", "piece").applyInPandas(
        pack, "length int, block int, ids binary, bits binary"
    )
    given = asked.withColumn("chunk", F.pmod(place, F.lit(chunks)).cast("int"))
    met = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).groupBy("length", "block", "chunk")
    asking = given.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("length", "block", "chunk")
    best = met.cogroup(asking).applyInPandas(search, "query_id long, vec_id long, score long, key binary")
    ranked = best.selectExpr(
        "query_id", "row_number() over (partition by query_id order by key desc, vec_id) as rank", "vec_id", "score"
    )
    return ranked.where(F.col("rank") <= k)
