"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages of 48 words, of which only the whole bag has a label. Every passage is
described by counts (letters, digits, signs, word lengths, repetitions, hashed word shapes) and encoded
by a trained layer. A gated attention layer, tanh times sigmoid, gives each passage a weight; the weights
of a text add up to 1, and the score is read from the weighted sum of its passages. All weights are
trained in numpy from the documents' labels, on a bounded sample.

Null and empty texts are a bag of one passage without words. A text of over a million characters starts
a new passage at each million. Repeated rows get repeated scores. Without labels every score is 0.5.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleloom.llm.common import _FACTORS, Adam, labelled_sample, mixed, sigmoid, slices

PASSAGE = 48
SHAPES = 32
_KINDS = np.full(256, 5, np.uint8)  # signs of no other kind
for _kind, _codes in enumerate(
    [[*range(65, 91)], [*range(97, 123)], [*range(48, 58)], [*range(128, 256)], [ord(c) for c in ".,;:'\"-()?"]]
):
    _KINDS[_codes] = _kind
_KINDS[ord("!")], _KINDS[ord("|")], _KINDS[: 33] = 6, 7, 8
_KINDS[ord("\n")] = 9
FEATURES = 10 + 9 + SHAPES


def passages(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features, place of the piece) of every passage; a piece without words has one of zeros."""
    data = [p.encode() for p in pieces]
    flat = np.frombuffer(b" ".join([b"", *data, b""]), np.uint8)
    piece_at = np.cumsum([1, *(len(d) + 1 for d in data)])[:-1]
    white = flat <= 32
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    of = np.searchsorted(piece_at, starts, side="right") - 1
    bare = np.setdiff1d(np.arange(len(pieces)), of)
    if not len(starts):
        return np.zeros((len(bare), FEATURES)), bare
    words = np.bincount(of, minlength=len(pieces))
    first_word = np.cumsum(words) - words
    head = np.flatnonzero((np.arange(len(of)) - first_word[of]) % PASSAGE == 0)
    passage = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(of))))
    n_words = np.bincount(passage).astype(float)
    # bytes by kind: a passage reaches to the start of the next one
    kinds = _KINDS[flat[starts[0] :]]
    by_byte = np.repeat(np.arange(len(head)), np.diff(np.append(starts[head], len(flat))))
    counts = np.bincount(by_byte * 10 + kinds, minlength=len(head) * 10).reshape(-1, 10).astype(float)
    n_bytes = np.maximum(counts[:, :8].sum(1), 1)
    length = ends - starts
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    values = (flat[~white].astype(np.uint64) + np.uint64(1)) * _FACTORS[at & 63]
    word = mixed(np.add.reduceat(values, np.cumsum(length) - length))
    first, last = _KINDS[flat[starts]].astype(np.int64), _KINDS[flat[ends - 1]].astype(np.int64)
    order = np.lexsort((word, passage))
    new = np.append(True, (word[order][1:] != word[order][:-1]) | (passage[order][1:] != passage[order][:-1]))
    distinct = np.bincount(passage[order][new], minlength=len(head))
    again = np.append(False, (word[1:] == word[:-1]) & (passage[1:] == passage[:-1]))
    shape = mixed((first * 100 + last * 1000 + np.minimum(length, 12)).astype(np.uint64)) % np.uint64(SHAPES)
    shapes = np.bincount(passage * SHAPES + shape.astype(np.int64), minlength=len(head) * SHAPES).reshape(-1, SHAPES)

    def mean(x: np.ndarray) -> np.ndarray:
        return np.bincount(passage, x, len(head)) / n_words

    size = mean(length)
    own = np.column_stack([
        counts[:, :8] / n_bytes[:, None], counts[:, 9] / n_words, np.log1p(n_words) / 4,
        size / 10, np.sqrt(np.maximum(mean(length**2.0) - size**2, 0)) / 10, distinct / n_words, mean(again),
        mean(length <= 3), mean(length == 1), mean(last == 4), mean(last >= 5), mean(first == 0),
    ])
    x = np.concatenate([np.column_stack([own, shapes / n_words[:, None]]), np.zeros((len(bare), FEATURES))])
    return x, np.concatenate([of[head], bare])


@dataclass
class Bags:
    middle: np.ndarray
    spread: np.ndarray
    parts: list[np.ndarray]  # encoder, its bias, tanh gate, sigmoid gate, attention, output, its bias

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(representation, tanh gate, sigmoid gate, attention before normalising) of every passage."""
        encoder, bias, tanh_gate, sigmoid_gate, attention, _, _ = self.parts
        h = np.tanh(x @ encoder + bias)
        t, s = np.tanh(h @ tanh_gate), sigmoid(h @ sigmoid_gate)
        return h, t, s, (t * s) @ attention

    def normal(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.spread, -5, 5)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The score of every text: the weights of all its passages add up to 1."""
        sums = np.zeros((len(texts), self.parts[0].shape[1]))
        weight = np.zeros(len(texts))
        for places, pieces in slices(texts):
            x, of = passages(pieces)
            h, _, _, a = self.encoded(self.normal(x))
            e, place = np.exp(np.clip(a, -30, 30)), np.asarray(places)[of]
            np.add.at(sums, place, e[:, None] * h)
            weight += np.bincount(place, e, len(texts))
        return sigmoid(sums / np.maximum(weight, 1e-300)[:, None] @ self.parts[5] + self.parts[6][0])


def trained(texts: list[str | None], label: np.ndarray, epochs: int = 30, batch: int = 64, hidden: int = 24, gate: int = 12) -> Bags:
    bags = []
    for text in texts:
        bags.append(np.concatenate([passages(pieces)[0] for _, pieces in slices([text])]))
    every = np.concatenate(bags)
    rng = np.random.default_rng(3)
    model = Bags(every.mean(0), every.std(0) + 0.02, [
        rng.normal(0, 0.15, (FEATURES, hidden)), np.zeros(hidden), rng.normal(0, 0.2, (hidden, gate)),
        rng.normal(0, 0.2, (hidden, gate)), rng.normal(0, 0.2, gate), rng.normal(0, 0.2, hidden), np.zeros(1),
    ])
    bags = [model.normal(b) for b in bags]
    adam = Adam(model.parts, 0.004)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            x = np.concatenate([bags[i] for i in some])
            size = np.array([len(bags[i]) for i in some])
            of, first = np.repeat(np.arange(len(some)), size), np.cumsum(size) - size
            encoder, bias, tanh_gate, sigmoid_gate, attention, out, shift = model.parts
            h, t, s, a = model.encoded(x)
            e = np.exp(a - np.maximum.reduceat(a, first)[of])
            weight = e / np.add.reduceat(e, first)[of]
            z = np.add.reduceat(weight[:, None] * h, first, axis=0)
            error = (sigmoid(z @ out + shift[0]) - label[some]) / len(some)
            dz = (error[:, None] * out)[of]
            d_weight = (dz * h).sum(1)
            da = weight * (d_weight - np.add.reduceat(weight * d_weight, first)[of])
            dg = da[:, None] * attention
            dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
            dh = (weight[:, None] * dz + dt @ tanh_gate.T + ds @ sigmoid_gate.T) * (1 - h * h)
            adam.apply([
                x.T @ dh + 1e-4 * encoder, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ da, z.T @ error + 1e-4 * out,
                error.sum(keepdims=True),
            ])
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000, folds: int = 5) -> Bags | None:
    """A model from at most `sample` of the labelled rows outside fold 0; None without rows of both labels."""
    rows = sorted(labelled_sample(docs, labels, "quality", folds, sample).collect(), key=lambda r: (r["doc_id"], r["text"] or ""))
    label = np.array([float(r["label"] > 0.5) for r in rows])
    return trained([r["text"] for r in rows], label) if len(set(label)) == 2 else None


def score(text: Column, model: Bags | None) -> Column:
    """The score of a text column: the higher, the likelier label 1."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [model.scores(texts.iloc[i : i + 1000].tolist()) for i in range(0, len(texts), 1000)]
            yield pd.Series(np.concatenate([*found, np.zeros(0)]))

    return of(text)
