"""Join helpers for keys that may be hot, and for lookups in outside extracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tripleloom.session import cut_lineage

# A filter lists at most so many keys; a larger set is a table that is joined.
FEW = 1000


@dataclass(frozen=True)
class KeySet:
    """Distinct keys of one column, computed and written once.

    `values` lists them where there are at most `bound`, so that they become a filter that reaches the scan; beyond,
    it is None and the written table is joined. The driver never sees more than `bound` + 1 keys.
    """

    table: DataFrame
    column: str
    values: list | None


def key_set(keys: DataFrame, column: str, bound: int = FEW) -> KeySet:
    """The distinct values of `column`; NULL is no key."""
    table = cut_lineage(keys.select(column).where(F.col(column).isNotNull()).distinct())
    found = [row[0] for row in table.limit(bound + 1).collect()]
    return KeySet(table, column, sorted(found) if len(found) <= bound else None)


def among(rows: DataFrame, column: str, keys: KeySet) -> DataFrame:
    """The rows whose `column` is one of the keys: a filter for few of them, a semi-join for more."""
    if keys.values is not None:
        return rows.where(F.col(column).isin(keys.values))
    return rows.join(keys.table.select(F.col(keys.column).alias(column)), column, "left_semi")


def regroup(grouped: DataFrame, keys: list[str]) -> DataFrame:
    """A table with one row per key, made ready for a join with rows that may be skewed on the key.

    Adaptive execution splits the hot partitions of one side only when both sides are shuffled by
    the join itself. A grouped table is already placed by its keys and would be taken as it is; a
    key written as a new text is shuffled again, which costs one row per key.
    """
    fresh = {k: F.concat(F.col(k), F.lit("")).alias(k) for k in keys}
    return grouped.select(*[fresh.get(c, F.col(c)) for c in grouped.columns])


def hashed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """`left.join(right, keys, how)` for names: a hash of the keys is a key as well, and comes first.

    Names begin alike, so a sort by them compares whole texts; a sort by the hash is done by its first eight bytes. The
    keys stay join keys, so equal hashes of different names join nothing.
    """
    mark = F.xxhash64(*keys).alias("_hash")
    made = left.select(mark, *left.columns).join(right.select(mark, *right.columns), ["_hash", *keys], how)
    return made.drop("_hash")


def bind_join(local: DataFrame, facts: DataFrame, iri: str, fact: str, how: str = "inner") -> DataFrame:
    """Look up facts of one predicate for the IRIs in column `iri`.

    `facts` has (s, o, ...); its object columns are renamed after `fact`. Catalyst turns a small side into a
    broadcast by its measured size.
    """
    object_names = {"o": fact, "o_kind": f"{fact}_kind", "o_dt": f"{fact}_dt", "o_lang": f"{fact}_lang"}
    side = facts.select(F.col("s").alias(iri), *[F.col(c).alias(n) for c, n in object_names.items() if c in facts.columns])
    return local.join(side, iri, how)


def set_difference_counts(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Sizes of both differences of two sets of rows, from one aggregation over their union."""
    keys = left.columns
    sides = (
        left.select(*keys, F.lit(1).alias("_side"))
        .unionByName(right.select(*keys, F.lit(2).alias("_side")))
        .groupBy(*keys)
        .agg(F.bit_or("_side").alias("_side"))
    )
    return sides.agg(
        F.count_if(F.col("_side") == 1).alias(left_name), F.count_if(F.col("_side") == 2).alias(right_name)
    )
