"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is that of its hash plus that of the hash of its first bytes, which inflected forms
share. Filters of widths 1, 2 and 3 run over the words, the maximum of each filter over the text is
its feature, and a logistic layer reads the features. All is trained in numpy on a bounded sample; the
first component of the embeddings starts from the label counts of all rows that may be learned from, so
that rare words have a fair start.

The score at which a text counts as toxic is calibrated for each language, over all rows that may be
learned from, and mapped to 0.5. The language is read from the text itself by its most frequent function
words; a language with few labels uses the threshold of all.

Null and empty texts have no words and get the score of a text of unknown words. Long texts are read in
overlapping pieces, which leaves the maxima as they are. Repeated rows get repeated scores. Without
labels every score is 0.25. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleloom.llm.common import Adam, cut, id_and_text, known_labels, labelled_sample, sigmoid, slices, word_hashes

WORDS, HEADS, HEAD = 1 << 17, 1 << 15, 5
SIZE, WIDTHS, FILTERS = 8, (1, 2, 3), 8
NO_WORD = WORDS  # the row of the padding between texts, always zero
#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for with as on are this be by not he from",
    "de": "der die und das den von zu mit ist im ein eine nicht sich auf dem des als auch",
    "fr": "le la les des et du un une est que qui dans pour par sur au pas avec ne",
    "es": "el los las del y en que un una es por con para se su al lo como no",
}
BINS = 400


def buckets(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, head bucket, place of the piece) of every word."""
    whole, head, of = word_hashes(pieces, HEAD)
    return (whole & np.uint64(WORDS - 1)).astype(np.int64), (head & np.uint64(HEADS - 1)).astype(np.int64), of


def language_table() -> np.ndarray:
    """1 + the place of the only language that has a word bucket as function word, else 0."""
    table, shared = np.zeros(WORDS, np.int64), np.zeros(WORDS, bool)
    for i, words in enumerate(FUNCTION_WORDS.values(), 1):
        found = np.unique(buckets([words])[0])
        shared[found] |= table[found] > 0
        table[found] = i
    return np.where(shared, 0, table)


def padded(word: np.ndarray, head: np.ndarray, of: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with room for a whole window after each text, and where each text starts."""
    count = np.bincount(of, minlength=texts)
    starts = np.cumsum(count + max(WIDTHS)) - count - max(WIDTHS)
    total = int(count.sum()) + texts * max(WIDTHS)
    at = np.arange(len(word)) + of * max(WIDTHS)
    w, h = np.full(total, NO_WORD), np.full(total, HEADS)
    w[at], h[at] = word, head
    return w, h, starts


@dataclass
class Classifier:
    words: np.ndarray  # (WORDS + 1) x SIZE
    heads: np.ndarray  # (HEADS + 1) x SIZE
    filters: list[np.ndarray]  # by width: width x SIZE x FILTERS
    bias: np.ndarray  # of the filters
    out: np.ndarray
    shift: np.ndarray  # one number

    def responses(self, w: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The filters' answers at every place; a place and the width - 1 after it are a window."""
        x = self.words[w] + self.heads[h]
        columns = []
        for width, bank in zip(WIDTHS, self.filters, strict=True):
            answer = x @ bank[0]
            for j in range(1, width):
                answer[:-j] += x[j:] @ bank[j]
            columns.append(answer)
        return np.concatenate(columns, axis=1) + self.bias

    def raw(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logit, place of the language) of every text."""
        best = np.full((len(texts), len(self.out)), -np.inf, np.float32)
        votes = np.zeros((len(texts), len(FUNCTION_WORDS) + 1))
        table = language_table()
        for places, pieces in slices(texts, 400_000, overlap=max(WIDTHS)):
            places = np.asarray(places)
            word, head, of = buckets(pieces)
            w, h, starts = padded(word, head, of, len(pieces))
            np.maximum.at(best, places, np.maximum.reduceat(self.responses(w, h), starts, axis=0))
            flat = places[of] * votes.shape[1] + table[word]
            votes += np.bincount(flat, minlength=votes.size).reshape(votes.shape)
        language = np.where(votes[:, 1:].sum(1) > 0, votes[:, 1:].argmax(1) + 1, 0)
        return np.maximum(best, 0) @ self.out + self.shift[0], language


def label_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all of (text, label): rows by label, and the rows of each label that have each word and head bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, WORDS + HEADS + 1), np.int64)
        for batch in batches:
            label = (batch.column(1).to_numpy(zero_copy_only=False) > 0.5).astype(int)
            counts[:, -1] += np.bincount(label, minlength=2)
            for places, pieces in slices(batch.column(0).to_pylist()):
                places = np.asarray(places)
                word, head, of = buckets(pieces)
                seen = np.unique(np.concatenate([of * (WORDS + HEADS) + word, of * (WORDS + HEADS) + WORDS + head]))
                for k in (0, 1):
                    mine = seen[label[places[seen // (WORDS + HEADS)]] == k] % (WORDS + HEADS)
                    counts[k, :-1] += np.bincount(mine, minlength=WORDS + HEADS)
        some = np.flatnonzero(counts.sum(0))
        columns = [pa.array(some.astype(np.int32)), pa.array(counts[0, some]), pa.array(counts[1, some])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "no", "yes"])

    summed = rows.select("text", "label").mapInArrow(run, "bucket int, no long, yes long").groupBy("bucket").agg(
        F.sum("no").alias("no"), F.sum("yes").alias("yes")
    )
    out = np.zeros((2, WORDS + HEADS + 1))
    for r in summed.collect():  # at most one row per bucket
        out[:, r["bucket"]] = r["no"], r["yes"]
    return out[:, -1], out[:, :WORDS], out[:, WORDS:-1]


def log_odds(total: np.ndarray, seen: np.ndarray, weight: float = 20.0, rare: int = 3) -> np.ndarray:
    """How much more often a bucket occurs with the label than without, drawn to 0 where it is seen in few rows."""
    share = total[1] / max(total.sum(), 1)
    odds = np.log((seen[1] + weight * share) / (seen[0] + weight * (1 - share))) - np.log(share / (1 - share))
    return np.where(seen.sum(0) >= rare, np.clip(odds, -2, 4), 0.0)


def trained(texts: list[str], label: np.ndarray, first: np.ndarray, heads: np.ndarray, epochs: int = 8, batch: int = 32) -> Classifier:
    rng = np.random.default_rng(5)
    words_part = np.zeros((WORDS + 1, SIZE), np.float32)
    heads_part = np.zeros((HEADS + 1, SIZE), np.float32)
    words_part[:-1] = rng.normal(0, 0.02, (WORDS, SIZE))
    words_part[:-1, 0], heads_part[:-1, 1] = first / 2, heads / 4
    filters = [rng.normal(0, 0.15, (k, SIZE, FILTERS)).astype(np.float32) for k in WIDTHS]
    for bank in filters:
        bank[0, :2] = np.abs(bank[0, :2]) + 0.3
    n = FILTERS * len(WIDTHS)
    model = Classifier(words_part, heads_part, filters, np.full(n, -0.3, np.float32), np.full(n, 0.2), np.full(1, -2.0))
    sizes = [(b - a) for a, b in zip(range(0, n, FILTERS), range(FILTERS, n + 1, FILTERS), strict=True)]
    parts = [*filters, model.bias, model.out, model.shift]
    adam = Adam(parts, 0.01)
    rows = [buckets([t]) for t in texts]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            of = np.concatenate([np.full(len(rows[i][0]), k) for k, i in enumerate(some)])
            w, h, starts = padded(*(np.concatenate([rows[i][c] for i in some]) for c in (0, 1)), of.astype(np.int64), len(some))
            answer = model.responses(w, h)
            best = np.maximum.reduceat(answer, starts, axis=0)
            # the place of each maximum: the first one of the text that reaches it
            owner = np.repeat(np.arange(len(some)), np.diff(np.append(starts, len(w))))
            place = np.empty(best.shape, np.int64)
            hit_row, hit_filter = np.nonzero(answer == best[owner])
            place[owner[hit_row[::-1]], hit_filter[::-1]] = hit_row[::-1]
            features = np.maximum(best, 0)
            p = sigmoid(features @ model.out + model.shift[0])
            error = (p - label[some]) / len(some)
            back = (error[:, None] * model.out) * (best > 0)
            gradients = [np.zeros_like(b) for b in filters]
            for k, width in enumerate(WIDTHS):
                own = back[:, sum(sizes[:k]) : sum(sizes[: k + 1])]
                spots = place[:, sum(sizes[:k]) : sum(sizes[: k + 1])]
                for j in range(width):
                    seen = np.minimum(spots + j, len(w) - 1)
                    x = model.words[w[seen]] + model.heads[h[seen]]  # text x filter x SIZE
                    gradients[k][j] = np.einsum("tf,tfs->sf", own, x)
                    step = (0.5 * own[:, :, None] * filters[k][j].T[None]).astype(np.float32)
                    np.subtract.at(words_part, w[seen], step)
            words_part[-1] = 0
            gradients += [back.sum(0).astype(np.float32), features.T @ error + 1e-4 * model.out, error.sum(keepdims=True)]
            adam.apply(gradients)
    return model


def with_raw(rows: DataFrame, model: Classifier) -> DataFrame:
    """`rows` with the columns raw and language instead of text."""
    rest = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                raw, language = model.raw(batch.column(batch.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw.astype(float)), pa.array(language)], [*rest, "raw", "language"])

    kind = T.StructType([*[rows.schema[c] for c in rest], T.StructField("raw", T.DoubleType()), T.StructField("language", T.LongType())])
    return rows.select(*rest, "text").mapInArrow(run, kind)


def best_threshold(yes: np.ndarray, no: np.ndarray) -> float:
    """The bin border of the best F1 of counts by bin; the middle of the borders that are equally good."""
    above_yes, above_no = yes[::-1].cumsum()[::-1], no[::-1].cumsum()[::-1]
    f1 = 2 * above_yes / np.maximum(above_yes + above_no + yes.sum(), 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 / BINS)


def thresholds(scored: DataFrame, enough: int = 30) -> np.ndarray:
    """The calibrated threshold, as a logit, of each language from all of (raw, language, label)."""
    share = 1 / (1 + F.exp(-F.col("raw")))
    binned = scored.groupBy("language", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin"), (F.col("label") > 0.5).alias("yes"))
    counts = np.zeros((2, len(FUNCTION_WORDS) + 1, BINS))
    for r in binned.count().collect():  # at most 2 x 5 x BINS rows
        counts[int(r["yes"]), r["language"], r["bin"]] += r["count"]
    own = [k if min(counts[0, k].sum(), counts[1, k].sum()) >= enough else None for k in range(counts.shape[1])]
    every = best_threshold(counts[1].sum(0), counts[0].sum(0))
    found = np.array([every if k is None else best_threshold(counts[1, k], counts[0, k]) for k in own])
    found = np.clip(found, 0.002, 0.998)
    return np.log(found / (1 - found))


def score(raw: Column, language: Column, limits: np.ndarray) -> Column:
    """The score whose 0.5 is the threshold of the text's language."""
    limit = F.element_at(F.array(*[F.lit(float(x)) for x in limits]), (language + 1).cast("int"))
    return 1 / (1 + F.exp(-F.greatest(F.least(raw - limit, F.lit(40.0)), F.lit(-40.0))))


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = 3000, counted: int = 20_000, folds: int = 5
) -> tuple[Classifier, np.ndarray, DataFrame] | None:
    """The classifier, its thresholds, and (doc_id, raw, language) of all rows; None without rows of both labels.

    Only labels outside fold 0 are read: the words' first values come from at most `counted` rows, the filters
    from at most `sample` of these, and the thresholds from all of them.
    """
    total, words, heads = label_counts(labelled_sample(docs, labels, "toxic", folds, counted))
    if not total.all():
        return None
    rows = sorted(labelled_sample(docs, labels, "toxic", folds, sample).collect(), key=lambda r: (r["doc_id"], r["text"] or ""))
    label = np.array([float(r["label"] > 0.5) for r in rows])
    model = trained([r["text"] or "" for r in rows], label, log_odds(total, words), log_odds(total, heads))
    raw = cut(with_raw(id_and_text(docs), model))
    return model, thresholds(raw.join(known_labels(labels, "toxic", folds), "doc_id")), raw


def scored(docs: DataFrame, fitted: tuple[Classifier, np.ndarray, DataFrame] | None, name: str = "toxicity") -> DataFrame:
    """`docs` with the column `name`; their own columns may have any names."""
    if fitted is None:
        return docs.withColumn(name, F.lit(0.25))
    model, limits, _ = fitted
    own = [f"\0{i}" for i in range(len(docs.columns))]
    text = F.col(own[docs.columns.index("text")]).alias("text")
    raw = with_raw(docs.toDF(*own).select(*own, text), model)
    back = [F.col(c).alias(n) for c, n in zip(own, docs.columns, strict=True)]
    return raw.select(*back, score(F.col("raw"), F.col("language"), limits).alias(name))
