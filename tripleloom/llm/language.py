"""Language of a text by sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, everything but letters becomes one space, and the n-grams of 1 to 3 characters are
hashed. The inverse document frequencies are counted over all rows that may be learned from. The weights
are trained on a bounded sample by the follow-the-regularised-leader rule with elastic-net penalties,
which leaves most of them zero. A part of the sample that was not trained on sets the temperature by
which the scores are divided, so that they read as probabilities.

Null texts and texts without a letter are `und` with score 0, empty ones included. Repeated rows get
repeated results. Without any row to learn from every text is `und`; with one language every text with
a letter is of that language. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import chosen, fold, id_and_text, mixed, slices

BUCKETS = 1 << 16
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The code point itself for a letter, else a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(sys.maxunicode + 1)], np.uint32)


def grams(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, place of the piece) of every n-gram, and whether each piece has a letter."""
    whole = " " + " ".join(pieces) + " "
    codes = _letters()[np.frombuffer(whole.lower().encode("utf-32-le"), np.uint32)]
    lengths = [len(p.lower()) + 1 for p in pieces]
    of = np.repeat(np.arange(len(pieces)), lengths)
    of = np.concatenate([of[:1], of])[: len(codes)] if len(of) else np.zeros(len(codes), np.int64)
    keep = np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))
    codes, of = codes[keep].astype(np.uint64), of[keep]
    letter = codes != 32
    has = np.zeros(len(pieces), bool)
    has[of[letter]] = True
    found, places = [mixed(codes[letter])], [of[letter]]
    if len(codes) > 1:
        two = codes[:-1] * np.uint64(0x9E3779B1) + codes[1:] * np.uint64(0x85EBCA77) + np.uint64(1)
        ok = (of[1:] == of[:-1]) & (letter[1:] | letter[:-1])
        found.append(mixed(two[ok]))
        places.append(of[:-1][ok])
    if len(codes) > 2:
        three = mixed(two[:-1]) + codes[2:] * np.uint64(0xC2B2AE3D)
        ok = (of[2:] == of[:-2]) & letter[1:-1]
        found.append(mixed(three[ok]))
        places.append(of[:-2][ok])
    return (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(places), has


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """(rows, in how many of them each bucket occurs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            total += len(texts)
            for places, pieces in slices(texts):
                bucket, of, _ = grams(pieces)
                seen = np.unique(np.asarray(places)[of] * BUCKETS + bucket)
                counts += np.bincount(seen % BUCKETS, minlength=BUCKETS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(counts[some], total))], ["bucket", "n"]
        )

    counted = rows.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, total = np.zeros(BUCKETS, np.int64), 0
    for r in counted.collect():  # at most one row per bucket
        if r["bucket"] < 0:
            total = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return total, out


@dataclass
class Languages:
    names: list[str]
    weights: np.ndarray  # bucket x language, inverse document frequencies multiplied in
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        total = np.zeros((len(texts), len(self.names)))
        count, has = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for places, pieces in slices(texts):
            bucket, of, letters = grams(pieces)
            at, places = np.asarray(places)[of], np.asarray(places)
            for k in range(len(self.names)):
                total[:, k] += np.bincount(at, self.weights[bucket, k], len(texts))
            count += np.bincount(at, minlength=len(texts))
            has[places[letters]] = True
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        shares = softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)
        best = shares.argmax(1)
        names = [self.names[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)]
        return names, np.where(has, shares.max(1), 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def trained(
    texts: list[str], names: list[str], idf: np.ndarray, epochs: int = 3, rate: float = 1.0, smooth: float = 1.0,
    l1: float = 0.02, l2: float = 0.02,
) -> Languages:
    """A model of the given texts. Every fifth one sets the temperature and trains nothing."""
    known = sorted(set(names))
    if len(known) < 2:
        return Languages(known, np.zeros((BUCKETS, len(known))), np.zeros(len(known)), 1.0)
    target = np.array([known.index(n) for n in names])
    rows = []
    for text in texts:
        bucket, _, _ = grams([text])
        some, n = np.unique(bucket, return_counts=True)
        rows.append((some, n / max(n.sum(), 1) * idf[some] * 20))
    z, n2 = (np.zeros((BUCKETS + 1, len(known))) for _ in range(2))
    z_bias, n_bias = np.zeros(len(known)), np.zeros(len(known))

    def weight(z_at: np.ndarray, n_at: np.ndarray, l1_at: float, l2_at: float) -> np.ndarray:
        return np.where(np.abs(z_at) <= l1_at, 0.0, -(z_at - np.sign(z_at) * l1_at) / ((smooth + np.sqrt(n_at)) / rate + l2_at))

    learn = [i for i in range(len(rows)) if i % 5 or len(rows) < 10]
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for i in order.permutation(learn):
            some, x = rows[i]
            w, bias = weight(z[some], n2[some], l1, l2), weight(z_bias, n_bias, 0.0, l2)
            p = softmax((x @ w + bias)[None])[0]
            p[target[i]] -= 1
            for z_all, n_all, at, w_at, g in ((z, n2, some, w, x[:, None] * p), (z_bias, n_bias, slice(None), bias, p)):
                z_all[at] += g - (np.sqrt(n_all[at] + g * g) - np.sqrt(n_all[at])) / rate * w_at
                n_all[at] += g * g
    w, bias = weight(z, n2, l1, l2), weight(z_bias, n_bias, 0.0, l2)
    held = [i for i in range(len(rows)) if i % 5 == 0]
    scores = np.array([rows[i][1] @ w[rows[i][0]] + bias for i in held])
    of = target[held]
    grid = np.exp(np.linspace(math.log(0.05), math.log(20), 60))
    loss = [-np.log(softmax(scores / t)[np.arange(len(of)), of] + 1e-12).mean() for t in grid]
    return Languages(known, w[:-1] * (idf * 20)[:, None], bias, float(grid[int(np.argmin(loss))]))


def fit(
    docs: DataFrame, sample: int = 3000, least: int = 50, languages: int = 200, folds: int = 4, held: int = 2, longest: int = 200_000
) -> Languages:
    """A model learned from text and lang of rows outside fold `held`.

    The weights come from at most `sample` of them, each of at most `longest` characters, and of at most `least`
    further rows of every language, so that one that is rare among very many rows is learned as well. The
    `languages` most frequent ones have such rows, which bounds the sample where `lang` holds anything else.
    """
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), docs["lang"].alias("lang")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), folds) != held)
    )
    total, seen = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + seen)) + 0.05
    short = rows.where(F.length("text") <= longest)
    few = {(r["doc_id"], r["text"], r["lang"]) for r in chosen(short, sample).collect()}
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    few |= {(r["doc_id"], r["text"], r["lang"]) for r in first_of_each(short, least, [r["lang"] for r in most.collect()]).collect()}
    few = sorted(few, key=lambda r: (hashlib.sha256(f"{r[0]}".encode()).digest(), r))
    return trained([text for _, text, _ in few], [lang for _, _, lang in few], idf)


def first_of_each(rows: DataFrame, least: int, languages: list[str]) -> DataFrame:
    """At most `least` rows of (doc_id, text, lang) of each of the languages, by a hash of the id."""
    rank = F.xxhash64(F.lit("language"), "doc_id")
    order = "row_number() over (partition by lang order by rank, doc_id, text)"
    # the rank filter runs in the map tasks before the shuffle, which so moves few rows of a frequent language
    return rows.where(F.col("lang").isin(languages)).withColumn("rank", rank).withColumn("place", F.expr(order)).where(F.col("place") <= least).drop("rank", "place")


def predicted(docs: DataFrame, model: Languages) -> DataFrame:
    """(doc_id, lang_pred, score) of every text."""
    names = ["doc_id", "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                found, score = model.predict(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(score)], names)

    rows = id_and_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
