"""Best-fit packing of token sequences by rounds over a tree of partitions.

Every partition packs its pieces best-fit, longest first: a piece goes into the open bin whose room
fits it most closely. Nearly full bins are done. The others become items of the next round, in fewer
partitions, and so on until one task has seen what is left or rounds no longer help. What a task
holds is bounded by the number of partitions, which follows the number of items; what a round found is
kept in the checkpoint folder, so that lost executors change no bin.

A document is its ids and the end id. Only documents longer than a sequence are cut, into whole
sequences with the shorter piece first. A null or empty text is the end id alone. Repeated rows are
packed as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.bpe import Vocabulary, vocabulary
from tripleloom.llm.common import cut, id_and_text

#: Fixed value: the pattern that the vocabulary's words follow.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of texts, by the library's encoder over the merges of the vocabulary file."""

    def __init__(self, path: str) -> None:
        self.known: Vocabulary = vocabulary(path)
        whole = self.known.bytes.tobytes()
        special = set(self.known.special.values())
        ranks = {
            whole[a : a + n]: i
            for i, (a, n) in enumerate(zip(self.known.first.tolist(), self.known.length.tolist(), strict=True))
            if n and i not in special
        }
        self.fast = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=self.known.special)

    def ids(self, text: str | None) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text or "", allowed_special="all")
        except BaseException as error:  # the pattern's engine gives up on runs of a million like characters
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.frombuffer(self.known.encode([text])[0], "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, room: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the documents' ids, cut where longer than `room`."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        end = np.array([end_id], "<u4")
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([known.ids(text.as_py()).astype("<u4"), end])
                stops = [*range(len(ids) % room or room, len(ids) + 1, room)]
                for piece, (a, b) in enumerate(zip([0, *stops], stops)):
                    out.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = docs.select(docs["doc_id"].cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, place in it, fill of each bin) for items in the given order."""
    open_bins: list[list[int]] = [[] for _ in range(room + 1)]
    rooms = 0  # bit r is set where a bin has exactly r left
    bins, offsets, fills = [], [], []
    for length in lengths.tolist():
        fits = rooms >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            chosen = open_bins[left].pop()
            if not open_bins[left]:
                rooms ^= 1 << left
        else:
            left, chosen = room, len(fills)
            fills.append(0)
        bins.append(chosen)
        offsets.append(room - left)
        fills[chosen] = room - left + length
        left -= length
        if left:
            open_bins[left].append(chosen)
            rooms |= 1 << left
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(fills, np.int64)


def packed_round(items: DataFrame, partitions: int, room: int, order: list[str]) -> DataFrame:
    """`items` with the columns bin, place and fill, after best-fit within each of `partitions` partitions."""
    names = [*items.columns, "bin", "place", "fill"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        group = pd.concat(held).sort_values(["length", *order], ascending=[False, *[True] * len(order)], kind="stable")
        bins, place, fill = best_fit(group["length"].to_numpy(), room)
        first = TaskContext.get().partitionId() << 40
        yield group.assign(bin=bins + first, place=place, fill=fill[bins])[names]

    dealt = items.repartition(partitions, *[F.xxhash64(*order)])
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields)
    return dealt.mapInPandas(run, f"{kept}, bin long, place long, fill long")


def best_fit_packed(
    docs: DataFrame, path: str, room: int = 1024, end_id: int = 2, slack: int = 4, at_once: int = 50_000
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece's sequence and place.

    A bin with at most `slack` tokens free is done; tasks pack about `at_once` items.
    """
    cut_docs = cut(pieces(id_and_text(docs), path, room, end_id))
    partitions = max(1, -(-cut_docs.count() // at_once))
    # dealt by their place in the written table, so that rows of one content spread over all partitions
    dealt = cut_docs.withColumn("row", F.monotonically_increasing_id())
    placed = cut(packed_round(dealt, partitions, room, ["row"]))
    under = placed.where(F.col("fill") < room - slack).groupBy("bin").agg(F.max("fill").alias("length"))
    moved = under.select("bin", F.col("bin").alias("sequence"), F.lit(0).cast("long").alias("base"))
    items = under.select(F.col("bin").alias("item"), "length")
    n, level = items.count(), 0
    while n > 1:
        level += 1
        partitions = max(1, min(-(-partitions // 8), -(-n // at_once)))
        merged = cut(packed_round(items, partitions, room, ["item"]))
        # bins of a round are told from those of others by the level, which no partition number reaches
        merged = merged.withColumn("bin", F.col("bin") + F.lit(level << 60))
        moved = cut(
            moved.join(merged.select(F.col("item").alias("sequence"), F.col("bin").alias("next"), "place"), "sequence", "left")
            .select("bin", F.coalesce("next", "sequence").alias("sequence"), (F.col("base") + F.coalesce("place", F.lit(0))).alias("base"))
        )
        left = merged.where(F.col("fill") < room - slack).groupBy("bin").agg(F.max("fill").alias("length"))
        items = left.select(F.col("bin").alias("item"), "length")
        before, n = n, items.count()
        if partitions == 1 or n > 0.99 * before:
            break
    return placed.join(moved, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
