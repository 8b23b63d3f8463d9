"""Whitening of vectors by mixed-precision refinement of eigenvectors.

Components c become the integers floor(scale * c) + shift. The different integer vectors are the fit
list. Their sums are exact; their covariance is summed over partitions from vectors that are centred
first. Eigenvectors are taken in float32 and corrected by the iteration of Ogita and Aishima, whose
matrix products are exact up to 69 bits: numbers are cut into slices whose products float64 adds
without rounding. Where eigenvalues lie too close for the iteration to tell their vectors apart, the
cluster is solved by itself: its vectors span the right space, and the small matrix of the cluster,
less its mean eigenvalue, tells them apart.

Rows whose vector is null or holds a null or non-finite component, or one whose integer is beyond
2^61, have no result. Vectors of different lengths are different spaces, each with its own fit; an
empty vector has no component. Copies count once in the fit and each get their rows; rows that repeat
an id or have none are kept as they are. A component whose eigenvalue is zero to rounding (below
2^-46 of the largest one) can't be scaled to one and has no rows; a fit list of one vector has none at
all. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import cut

#: Beyond this integers are not formed; eigenvalues below the share of the largest one count as zero.
_MOST, _ZERO = 2.0**61, 2.0**-46
#: Models of up to this many bytes together are sent to the tasks; larger ones meet groups of AT_ONCE rows.
SENT, AT_ONCE = 32_000_000, 50_000


def sliced(a: np.ndarray, axis: int, bits: int, count: int = 3) -> list[np.ndarray]:
    """Matrices that add up to `a`, each of `bits` bits under its row's or column's largest number."""
    out = []
    for _ in range(count):
        top = np.abs(a).max(axis=axis, keepdims=True, initial=0)
        unit = np.exp2(np.ceil(np.log2(np.where(top > 0, top, 1))) - bits).astype(np.longdouble)
        part = np.rint(a / unit) * unit
        out.append(part.astype(np.float64))
        a = a - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in extended precision: float64 adds the products of the slices exactly."""
    bits = (53 - math.ceil(math.log2(max(a.shape[1], 2)))) // 2 - 1
    left, right = sliced(a, 1, bits), sliced(b, 0, bits)
    total = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    for i, j in sorted(((i, j) for i in range(3) for j in range(3) if i + j < 4), key=lambda p: -sum(p)):
        total += left[i] @ right[j]
    return total


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of the values in runs that no gap of more than `gap` divides."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [np.sort(run) for run in np.split(order, breaks)]


def refined(matrix: np.ndarray, most: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, eigenvectors as columns) of a symmetric matrix, from those of float32."""
    size = len(matrix)
    if not size:
        return np.zeros(0), np.zeros((0, 0))
    scale = float(np.abs(matrix).max()) or 1.0
    a = (matrix / scale).astype(np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm = float(np.linalg.norm(a.astype(np.float64), 2))
    solved: set[tuple[int, ...]] = set()
    eye, before = np.eye(size), np.inf
    for _ in range(most):
        r = eye - product(x.T, x)
        s = product(x.T, product(a, x))
        values = np.diag(s) / (1 - np.diag(r))
        off = float(np.linalg.norm((s - np.diag(np.diag(s))).astype(np.float64), 2))
        omega = 2 * (off + norm * float(np.linalg.norm(r.astype(np.float64), 2)))
        differ = values[None, :] - values[:, None]
        apart = np.abs(differ) > omega
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, differ, 1), r / 2)
        x = x + product(x, e)
        # a cluster is solved once its vectors span their space, which the steps between clusters see to
        change = float(np.abs(np.where(apart | np.eye(size, dtype=bool), e, 0)).max())
        if change < 1e-8:
            for run in clusters(values.astype(np.float64), omega):
                if len(run) > 1 and tuple(run) not in solved:
                    solved.add(tuple(run))
                    own = x[:, run]
                    small = product(own.T, product(a, own) - own * values[run].mean())
                    top = float(np.abs(small).max()) or 1.0
                    turn = np.linalg.eigh(((small + small.T) / (2 * top)).astype(np.float64))[1]
                    x[:, run] = product(own, turn.astype(np.longdouble))
                    change = np.inf
        if change < 1e-18 or (change < 1e-15 and change >= before / 2):
            break
        before = change
    values = (np.diag(product(x.T, product(a, x))) / np.diag(product(x.T, x))).astype(np.float64) * scale
    x = (x / np.sqrt((x * x).sum(0))).astype(np.float64)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def integers(vectors: DataFrame, scale: float, shift: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, length, x) of the rows that take part."""
    v = F.transform(vectors[vector_col].cast("array<double>"), lambda c: F.lit(float(scale)) * c)
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v"))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(_MOST)))
    x = F.transform("v", lambda c: F.floor(c).cast("long") + F.lit(shift).cast("long"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & good).select(
        "vec_id", F.size("v").alias("length"), x.alias("x")
    )


def matrix_of(column: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = batch.column("length").to_numpy(zero_copy_only=False)
    for length in np.unique(lengths).tolist():
        yield length, batch if (lengths == length).all() else batch.filter(pa.array(lengths == length))


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums of integers as Python numbers: their halves' sums do not overflow."""
    high, low = x >> np.int64(32), x & np.int64(0xFFFFFFFF)
    return [(h << 32) + n for h, n in zip(high.sum(0).tolist(), low.sum(0).tolist(), strict=True)]


def sums(fit: DataFrame) -> DataFrame:
    """(length, i, n, total): number of vectors and exact sum of component i, as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for length, part in by_length(batch):
                n, total = held.get(length, (0, [0] * length))
                added = exact_sums(matrix_of(part.column("x")))
                held[length] = n + part.num_rows, [a + b for a, b in zip(total, added, strict=True)]
        for length, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()),
                    pa.array([n] * length, pa.int64()), pa.array([str(t) for t in total]),
                ],
                ["length", "i", "n", "total"],
            )

    partial = fit.mapInArrow(run, "length int, i int, n long, total string")
    return partial.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def totals(fitted: DataFrame) -> DataFrame:
    """(length, n, total): one row for each length, the sums in order as texts."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", "total"))), lambda r: r["total"].cast("string"))
    return fitted.groupBy("length").agg(F.max("n").alias("n"), ordered.alias("total"))


@dataclass
class Model:
    """What rows of one length are worked with; `turn` maps a centred vector to its whitened components."""

    n: int
    total: list[int]
    turn: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float | None = None

    @classmethod
    def of(cls, row: dict) -> Model:
        total = [int(t) for t in row["total"]]
        turn = np.frombuffer(row["turn"], np.float64).reshape(len(total), -1) if "turn" in row else None
        explained = np.array(row["explained"], float) if "explained" in row else None
        return cls(row["n"], total, turn, explained, row.get("identity_error"))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, whose integer part is taken off before the rest is rounded."""
        whole = np.array([t // self.n for t in self.total], np.int64)
        rest = np.array([(t % self.n) / self.n for t in self.total])
        return (x - whole).astype(np.float64) - rest


Work = Callable[[Iterator[pa.RecordBatch], dict[int, Model]], Iterator[pa.RecordBatch]]


def with_models(rows: DataFrame, models: DataFrame, work: Work, kind: str) -> DataFrame:
    """`work` over batches of rows and the models of their lengths; no task gets all rows of a length.

    The models are one row for each length, `components` + 2 numbers for each place. Where they are measured to
    be small they are sent to the tasks; else rows are salted and each model is repeated for each salt.
    """
    sized = {"string": F.octet_length, "binary": F.octet_length}
    size = sum((sized.get(k, lambda c: F.size(c) * 48 if "array" in k else F.lit(8))(F.col(c)) for c, k in models.dtypes), F.lit(0))
    if (models.agg(F.sum(size)).first()[0] or 0) <= SENT:
        known = {r["length"]: Model.of(r.asDict()) for r in models.collect()}
        return rows.mapInArrow(lambda batches: work(batches, known), kind)
    salts = max(1, -(-rows.count() // AT_ONCE))
    spread = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns, F.monotonically_increasing_id()), F.lit(salts)))
    repeated = models.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    names = [c.split()[0] for c in re.sub(r"\(.*?\)", "", kind).split(", ")]

    def of_group(group: pa.Table, model: pa.Table) -> pa.Table:
        known = {r["length"]: Model.of(r) for r in model.to_pylist()}
        found = list(work(iter(group.combine_chunks().to_batches()), known)) if len(known) else []
        empty = pa.table({n: pa.nulls(0) for n in names})
        return pa.Table.from_batches(found) if found else empty

    return spread.groupBy("length", "salt").cogroup(repeated.groupBy("length", "salt")).applyInArrow(of_group, kind)


def moments(rows: DataFrame, models: DataFrame) -> DataFrame:
    """(length, i, row): row i of the sum of y y^T over all vectors, where y is x - S / n, whitened where there is a turn."""
    kind = "length int, i int, row array<double>"

    def run(batches: Iterator[pa.RecordBatch], known: dict[int, Model]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, part in by_length(batch):
                y = known[length].centred(matrix_of(part.column("x")))
                if known[length].turn is not None:
                    y = y @ known[length].turn
                held[length] = held.get(length, 0) + y.T @ y
        for length, m in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))],
                ["length", "i", "row"],
            )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.stack(group["row"]), axis=0)
        return pd.DataFrame({"length": group["length"].iloc[:1], "i": group["i"].iloc[:1], "row": [total]})

    # in two steps, so that a group holds a small part of what many partitions send
    partial = with_models(rows, models, run, kind).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(32)))
    some = partial.groupBy("length", "i", "part").applyInPandas(add, kind)
    return some.groupBy("length", "i").applyInPandas(add, kind)


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """The exact sum of (n x - S)^2 over the components of each row."""
    s = np.array(total, object)
    # whole numbers of a half word stay exact in int64, all others are Python's
    reach = max((abs(n * int(e) - t) for row in (x.min(0), x.max(0)) for e, t in zip(row, total, strict=True)), default=0)
    if reach and reach * reach * len(total) < 2**62 and n * max(abs(int(x.min())), abs(int(x.max()))) < 2**62:
        d = x * np.int64(n) - np.array(total, np.int64)
        return (d * d).sum(1).tolist()
    return [int(sum((n * int(e) - t) ** 2 for e, t in zip(row, s, strict=True))) for row in x.tolist()]


def solved(covariance: DataFrame, sizes: DataFrame, components: int) -> DataFrame:
    """(length, n, total, turn, explained): one row for each length, from its covariance's rows and its sums."""

    def solve(key: tuple, group: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(group):
            return pd.DataFrame({"length": [], "turn": [], "explained": []})
        n = int(known["n"].iloc[0])
        v = np.stack(group.sort_values("i")["row"]) / n
        v = (v + v.T) / 2
        values, x = refined(v)
        kept = np.flatnonzero(values > max(values[0], 0) * _ZERO)[:components] if values[0] > 0 else np.zeros(0, int)
        turn = x[:, kept] / np.sqrt(values[kept])
        return pd.DataFrame({"length": [key[0]], "turn": [turn.tobytes()], "explained": [(values[kept] / np.trace(v)).tolist()]})

    found = covariance.groupBy("length").cogroup(sizes.select("length", "n").groupBy("length")).applyInPandas(
        solve, "length int, turn binary, explained array<double>"
    )
    return sizes.join(found, "length")


def whitened(
    vectors: DataFrame, components: int = 16, scale: float = 64.0, shift: int = 1_000_000,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component.

    `deviation` is a decimal of 38 digits, null where it has more. `identity_error` is measured: the whitened fit
    list is formed and multiplied.
    """
    rows = integers(vectors, scale, shift, id_col, vector_col)
    fit = cut(rows.select("length", "x").distinct())
    sizes = cut(totals(sums(fit)))
    model = cut(solved(moments(fit, sizes), sizes, components))
    image = moments(fit, model).join(model.select("length", "n"), "length")
    wrong = F.aggregate(
        F.transform("row", lambda e, j: F.abs(e / F.col("n") - F.when(j == F.col("i"), 1.0).otherwise(0.0))),
        F.lit(0.0), lambda a, b: F.greatest(a, b),
    )
    # a length without components has no error, and no rows
    errors = image.groupBy("length").agg(F.max(wrong).alias("identity_error"))
    model = cut(model.join(errors, "length", "left"))
    kind = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )

    def run(batches: Iterator[pa.RecordBatch], known: dict[int, Model]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, group in by_length(batch):
                m = known[length]
                for start in range(0, group.num_rows, 2000):
                    part = group.slice(start, 2000)
                    x = matrix_of(part.column("x"))
                    w = m.centred(x) @ m.turn
                    count, k = w.shape
                    deviation = [str(d) if d < 10**38 else None for d in deviations(x, m.n, m.total)]
                    place = pa.array(np.repeat(np.arange(count), k))
                    columns = {
                        "vec_id": part.column("vec_id").take(place),
                        "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                        "n": pa.array(np.full(count * k, m.n)),
                        "deviation": pa.array(deviation, pa.string()).cast(pa.decimal128(38, 0)).take(place),
                        "whitened": pa.array(w.ravel()),
                        "explained": pa.array(np.tile(m.explained, count)),
                        "identity_error": pa.array([m.identity_error], pa.float64()).take(pa.array(np.zeros(count * k, int))),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return with_models(rows, model, run, kind)
