"""Near copies by SimHash, with candidates from the pigeonring principle.

The 64 bits of a fingerprint are cut into `m` segments on a ring. If two fingerprints differ in at
most t bits, there is a segment from which every chain of l consecutive segments holds at most
floor(l * t / m) differences. So a pair is found by what the budgets leave equal on such a chain:
for a chain of given length, each way to place its allowed differences leaves a set of equal
segments, which is a join key. Joined pairs then have to keep the budget of every longer chain from
the same start, and the last of these chains is the whole ring: the full Hamming check.

Keys that many fingerprints share are cut into blocks. Every two blocks meet in one task, which
returns links that connect what its pairs connect, so that nothing grows with the square of a group.

Null and empty texts have no word and the fingerprint zero; they are linked with each other like any
other rows. Repeated rows have one fingerprint. Rows with a null id stay and are never the smallest.
Of further columns, whatever their names and types, `without_near_copies` returns each as it was, and
`simhash_components` none. The hashes of a text are made in runs, so that a long one needs memory
for its words and no more. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import cut, id_and_text, if_small
from tripleloom.llm.groups import block_pairs, forest, with_components

_SEED = 42
#: A key with more fingerprints than this is cut into blocks of BLOCK.
SMALL, BLOCK = 16, 1024


def shingles(text: str | None, words: int, run: int = 1 << 16) -> Iterator[list[bytes]]:
    """The word shingles of a text in runs, repeats included: A-Z lower-cased, words cut at ASCII white space."""
    parts = (text or "").encode().lower().split()
    if len(parts) < words:
        if parts:
            yield [b" ".join(parts)]
        return
    for first in range(0, len(parts) - words + 1, run):
        some = parts[first : first + run + words - 1]
        joined = b" ".join(some)
        stops = np.cumsum([len(p) + 1 for p in some])
        starts = np.append(0, stops[:-1])
        pairs = zip(starts[: len(some) - words + 1].tolist(), (stops[words - 1 :] - 1).tolist(), strict=True)
        yield [joined[a:b] for a, b in pairs]


def fingerprint(text: str | None, words: int) -> np.uint64:
    """Bit by bit, whether over half of the shingles' hashes have it; zero without words."""
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), 0
    for run in shingles(text, words):
        found = np.array([digest(s, _SEED) for s in run], "<u8")
        ones += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        n += len(run)
    return np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0]


def fingerprints(rows: DataFrame, words: int) -> DataFrame:
    """`rows` with `fp` in place of `text`, their last column."""
    names = [*rows.columns[:-1], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), words) for t in batch.column(batch.num_columns - 1)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks.view(np.int64))], names)

    kind = ", ".join(f"{c} {k}" for c, k in [*rows.dtypes[:-1], ("fp", "long")])
    return rows.mapInArrow(run, kind)


@dataclass(frozen=True)
class Ring:
    """How the ring is cut: segments, bits that may differ for a pair to be surely found, length of the key's chain."""

    segments: int
    sure_bits: int
    chain: int

    def masks(self) -> list[int]:
        cuts = [round(64 * i / self.segments) for i in range(self.segments + 1)]
        return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]

    def keys(self) -> list[tuple[int, int]]:
        """(start segment, mask of the bits that have to be equal), each mask once."""
        budget = [(n * self.sure_bits) // self.segments for n in range(self.chain + 1)]
        masks, found = self.masks(), {}
        for start in range(self.segments):
            for away in combinations(range(self.chain), budget[-1]):
                if all(sum(p < n for p in away) <= budget[n] for n in range(1, self.chain + 1)):
                    equal = 0
                    for place in set(range(self.chain)) - set(away):
                        equal |= masks[(start + place) % self.segments]
                    found.setdefault(equal, start)
        return [(start, mask) for mask, start in found.items()]

    def chains(self, max_bits: int) -> list[list[tuple[int, int]]]:
        """For each start: (mask of the first n segments, most differences in them), up to the whole ring."""
        masks, out = self.masks(), []
        for start in range(self.segments):
            whole, row = 0, []
            for n in range(1, self.segments + 1):
                whole |= masks[(start + n - 1) % self.segments]
                row.append((whole, n * max_bits // self.segments))
            out.append(row)
        return out


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def ring_for(nodes: int, max_bits: int = 4) -> Ring:
    """Up to some ten million fingerprints 18 keys each of about 21 bits, beyond 33 of about 23; neither loses a pair.

    A key row is 28 bytes, so a document has 0.5 KB or 0.9 KB of them. Longer keys would be many more: 34 bits take 156.
    """
    return Ring(9, max_bits, 4) if nodes < 1 << 24 else Ring(11, max_bits, 5)


def keyed(nodes: DataFrame, ring: Ring) -> DataFrame:
    """(kind, part, node, fp): a row for each key (kind, part) of each node of (node, lane, fp)."""
    keys = F.array(*[
        F.struct(
            (F.col("lane") * len(ring.keys()) + i).cast("int").alias("kind"),
            F.col("fp").bitwiseAND(F.lit(signed(mask)).cast("long")).alias("part"),
        )
        for i, (_, mask) in enumerate(ring.keys())
    ])
    return nodes.select(F.inline(keys), "node", "fp")


def near(a: str, b: str, ring: Ring, max_bits: int) -> Column:
    """The chain budgets from the key's start, shortest chain first; the last one is the full Hamming check."""
    chains = [ring.chains(max_bits)[start] for start, _ in ring.keys()]
    differs = F.col(a).bitwiseXOR(F.col(b))
    found = F.lit(True)
    for n in range(ring.segments):
        of_start = F.element_at(F.array(*[F.lit(signed(c[n][0])).cast("long") for c in chains]), F.col("kind") % len(chains) + 1)
        found &= F.bit_count(differs.bitwiseAND(of_start)) <= chains[0][n][1]
    return found


def near_matrix(fp: np.ndarray, start: int, ring: Ring, max_bits: int) -> np.ndarray:
    """`near` for all pairs of a block."""
    differs = fp[:, None] ^ fp[None, :]
    found = np.ones(differs.shape, bool)
    for mask, most in ring.chains(max_bits)[start]:
        found &= np.bitwise_count(differs & np.uint64(mask)) <= most
    return found


def links(nodes: DataFrame, ring: Ring, max_bits: int) -> DataFrame:
    """Links (a, b) that connect the nodes (node, lane, fp) which differ in few bits in some lane."""
    rows = keyed(nodes, ring)
    starts = [start for start, _ in ring.keys()]
    key = ["kind", "part"]
    large = cut(rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > SMALL))
    # few in number as they are, the large keys can be told at the rows' places, which are shuffled once then
    few = rows.join(if_small(large.select(*key)), key, "left_anti")
    pairs = (
        few.select(*key, F.col("node").alias("a"), F.col("fp").alias("fa"))
        .join(few.select(*key, F.col("node").alias("b"), F.col("fp").alias("fb")), key)
        .where((F.col("a") < F.col("b")) & near("fa", "fb", ring, max_bits))
        .select("a", "b").distinct()
    )
    many = rows.join(if_small(large), key)

    def connect(group: pd.DataFrame) -> pd.DataFrame:
        fp, node = group["fp"].to_numpy().view(np.uint64), group["node"].to_numpy()
        close = near_matrix(fp, starts[int(group["kind"].iloc[0]) % len(starts)], ring, max_bits)
        found = np.array(forest(close), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": node[found[:, 0]], "b": node[found[:, 1]]})

    blocks = block_pairs(many, F.col("n"), BLOCK, F.col("node")).groupBy(*key, "low", "high")
    return pairs.union(blocks.applyInPandas(connect, "a long, b long"))


def components_of(marked: DataFrame, least: Column, max_bits: int) -> DataFrame:
    """(fp, first): for each fingerprint of `marked` the smallest value of `least` in its component."""
    nodes = cut(marked.groupBy(F.col("fp").alias("node")).agg(F.min(least).alias("least")).withColumn("fp", F.col("node")))
    found = links(nodes.select("node", F.lit(0).alias("lane"), "fp"), ring_for(nodes.count(), max_bits), max_bits)
    grouped = cut(with_components(nodes, "node", found))
    first = grouped.groupBy("component").agg(F.min("least").alias("first"))
    # written once more under another name, so that a component of very many rows can be split
    named = grouped.select("fp", F.col("component").alias("of"))
    return cut(named.join(if_small(cut(first)), F.col("of") == F.col("component")).select("fp", "first"))


def simhash_components(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): rows whose fingerprints differ in at most `max_bits` bits are linked.

    `component_id` is the smallest id that can be reached through links, the row's own included; it is
    null only where no row of the component has an id.
    """
    marked = cut(fingerprints(id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words))
    of_fp = components_of(marked, F.col("doc_id"), max_bits)
    return marked.join(if_small(of_fp), "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def without_near_copies(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component of `simhash_components`: that of the smallest id, nulls last, then of the least text hash.

    Of rows that are equal in both, the one whose columns are first as JSON.
    """
    doc_id, key = docs["doc_id"].cast("long"), F.xxhash64(docs["text"])
    rows = docs.select(doc_id.alias("doc_id"), key.alias("text_key"), docs["text"].alias("text"))
    marked = cut(fingerprints(rows, words))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    of_fp = components_of(marked, order, max_bits).select(
        F.col("fp").alias("of_fp"), F.col("first.doc_id").alias("keeper"), F.col("first.text_key").alias("keeper_key")
    )
    first = F.col("doc_id").eqNullSafe(F.col("keeper")) & (F.col("text_key") == F.col("keeper_key"))
    counted = marked.groupBy("fp", "doc_id", "text_key").agg(F.count("*").alias("n"))
    judged = cut(counted.join(if_small(of_fp), F.col("fp") == F.col("of_fp")).select(
        F.col("doc_id").alias("\0id"), F.col("text_key").alias("\0key"), first.alias("first"), "n"
    ))
    gone = if_small(judged.where("not first").select("\0id", "\0key"))
    twice = judged.where("first and n > 1").select("\0id", "\0key")
    of = lambda keys: doc_id.eqNullSafe(keys["\0id"]) & (key == keys["\0key"])
    left = docs.join(gone, of(gone), "left_anti")
    if twice.isEmpty():
        return left
    repeated = if_small(twice)
    whole = F.struct(*[docs[c] for c in docs.columns])
    single = docs.join(repeated, of(repeated)).groupBy("\0id", "\0key").agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return left.join(repeated, of(repeated), "left_anti").unionByName(single.select("row.*"))
