"""Helpers that several operators share: reading, cutting lineage, the fold of a row, Arrow batches."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that Spark and Python hand each other at once. A text has kilobytes, so Spark's 10,000 rows are tens of MB, and
#: the JVM and Python each hold them several times over.
ROWS_AT_ONCE = 1000


def small_batches(spark: SparkSession) -> None:
    """Hold the session at `ROWS_AT_ONCE`; a smaller value of its own stays, and it stays for what is evaluated later."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_AT_ONCE:
        spark.conf.set(name, ROWS_AT_ONCE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the cluster's checkpoint folder, so that a lost executor loses nothing.

    The folder is that of `spark.checkpoint.dir`. Only a single-machine session without the setting
    gets a temporary one; on a cluster its absence is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
            folder = tempfile.mkdtemp(prefix="tripleloom-llm-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def if_small(ids: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A table of ids as it is, marked for a broadcast where it has at most `most` rows (some 16 MB).

    Then the rows it is joined with, whole texts for example, stay where they are; else both are shuffled.
    """
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`: a split that follows the row and not its place."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the columns an operator reads, so that further columns of any name do no harm."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def in_batches(work: Callable[[list], list | np.ndarray | pa.Array], kind: pa.DataType) -> Callable:
    """A function for `mapInArrow` that appends one column computed from the last column of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = work(batch.column(batch.num_columns - 1).to_pylist())
            column = values if isinstance(values, pa.Array) else pa.array(values, kind)
            names = [*batch.schema.names[:-1], "value"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names)

    return run


def slices(texts: list[str | None], limit: int = 1_000_000, overlap: int = 0) -> Iterator[tuple[list[int], list[str]]]:
    """The texts in runs of about `limit` characters, as (place in `texts`, piece).

    A longer text is cut at white space into pieces that share `overlap` words, so that what a task
    holds at once does not grow with one text.
    """
    places: list[int] = []
    pieces: list[str] = []
    held = 0
    for place, text in enumerate(texts):
        text = text or ""
        start = 0
        while True:
            stop = len(text)
            if stop - start > limit:
                space = re.compile(r"\s").search(text, start + limit)
                stop = space.start() if space else len(text)
            if held and held + stop - start > limit:
                yield places, pieces
                places, pieces, held = [], [], 0
            places.append(place)
            pieces.append(text[start:stop])
            held += stop - start
            if stop == len(text):
                break
            tail = text[max(start + 1, stop - 200 * (overlap + 1)) : stop]
            back = sum(map(len, re.findall(r"\s+\S+", tail)[-overlap:])) if overlap else 0
            start = stop - back
    if places:
        yield places, pieces


_FACTORS = (np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def word_hashes(pieces: list[str], head: int = 0) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(hash, hash of the first `head` bytes, place of the piece) of every word of the lower-cased pieces.

    A word is a run of ASCII letters, digits and characters beyond ASCII.
    """
    data = [p.lower().encode() for p in pieces]
    flat = np.frombuffer(b" ".join([b"", *data, b""]), np.uint8)
    first_byte = np.cumsum([1, *(len(d) + 1 for d in data)])[:-1]
    inside = _IN_WORD[flat]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none if head else None, np.zeros(0, np.int64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(lengths.sum()) - np.repeat(first, lengths)
    values = (flat[inside].astype(np.uint64) + np.uint64(1)) * _FACTORS[at & 63]
    short = mixed(np.add.reduceat(np.where(at < head, values, np.uint64(0)), first)) if head else None
    return mixed(np.add.reduceat(values, first)), short, np.searchsorted(first_byte, starts, side="right") - 1


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Gradient steps with running moments, for the small models trained here."""

    def __init__(self, parts: list[np.ndarray], rate: float) -> None:
        self.parts, self.rate, self.step = parts, rate, 0
        self.first, self.second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]

    def apply(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for part, g, m, v in zip(self.parts, gradients, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            part -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def known_labels(labels: DataFrame, label: str, folds: int) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from: those of every fold but 0.

    A document id that is labelled more than once counts with its largest label; a null id has no label.
    """
    return (
        labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )


def chosen(rows: DataFrame, bound: int) -> DataFrame:
    """At most `bound` of the rows of (doc_id, ...), by a hash of the id; the first ones of a larger choice."""
    rank = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_003))
    share = min(1.0, 1.2 * bound / max(rows.select("doc_id").count(), 1) + 0.002)
    near = rows.where(rank < int(share * 1_000_003) + 1)
    return near.withColumn("rank", rank).orderBy("rank", "doc_id").limit(bound).drop("rank")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, bound: int, longest: int = 200_000) -> DataFrame:
    """(doc_id, text, label) of at most `bound` labelled ids, one row each, found without a shuffle of the texts.

    The labels are broadcast: `bound` limits their size. An id that repeats counts with its least text, which is
    found in the map tasks first. Texts of over `longest` characters are scored like all
    others but not learned from, which bounds what the driver holds while it fits a model.
    """
    few = F.broadcast(chosen(known_labels(labels, label, folds), bound))
    rows = id_and_text(docs).where(F.length(F.coalesce("text", F.lit(""))) <= longest).join(few, "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
