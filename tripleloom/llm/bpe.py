"""Byte-pair encoding and decoding by merge rounds over one flat array.

The texts of a batch are laid out as one array of code points. Array operations find where words
start, equal words are found by hash (and compared letter by letter), and the different words are
merged together: a round looks up the key of every adjacent pair of symbols in the sorted keys of
all merges by binary search, every word takes its pair of lowest rank, and all its occurrences are
merged at once. Words without a merge leave the array.

Null text counts as empty; empty text has no ids and decodes to empty text. Repeated rows give
repeated results. A null list of ids decodes to null; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripleloom.llm.common import _FACTORS, mixed

_NONE = np.iinfo(np.int32).max
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
#: White space as Unicode has it, and the endings that are words of their own after an apostrophe.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    found = np.array([kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    found[WHITE_SPACE] = _SPACE
    return found


def word_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Places where a word starts: runs of one class, to which one space before them belongs.

    White space before something else leaves its last character to what follows: as part of that
    word if it is a space, else as a word of its own. White space at the end of a text is one word.
    An apostrophe and one of the ENDINGS are a word where no space and no other mark precede.
    """
    kind = classes()[codes]
    new_text = np.zeros(len(codes) + 1, bool)
    new_text[text_starts] = new_text[-1] = True
    starts = new_text[:-1].copy()
    starts[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(starts)
    length = np.diff(np.append(run, len(codes)))
    after = run + length
    inner = ~new_text[after]
    white = inner & (kind[run] == _SPACE)
    starts[after[white] - 1] = True
    starts[after[white & (codes[after - 1] == 32)]] = False
    mark = np.flatnonzero(inner & (length == 1) & (codes[run] == ord("'")) & starts[run])
    mark = mark[kind[after[mark]] == _LETTER]
    letters, room = after[mark], length[mark + 1]
    second = codes[np.minimum(letters + 1, len(codes) - 1)]
    for ending in ENDINGS:
        fits = (codes[letters] == ord(ending[0])) & (room >= len(ending))
        if len(ending) == 2:
            fits &= second == ord(ending[1])
        starts[letters[fits]] = False
        starts[letters[fits & (room > len(ending))] + len(ending)] = True
    return np.flatnonzero(starts)


def spread(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for length[0] places, then the same from first[1], and so on."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - length), length)


def byte_letters() -> dict[str, int]:
    """The printable letter that the vocabulary writes for each byte, by letter."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges, ids and bytes of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, letters = content["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        made = np.array([ids["".join(p)] for p in pairs], np.int32)
        keys = left * size + right
        order = np.argsort(keys)
        self.size, self.made = size, made
        self.key_type = np.uint32 if size * size < 2**32 else np.int64
        self.keys, self.rank = keys[order].astype(self.key_type), order.astype(np.int32)
        self.of_byte = np.zeros(256, np.int32)
        spelled = {i: bytes(letters[c] for c in token) for token, i in ids.items() if token not in self.special}
        for i, token in spelled.items():
            if len(token) == 1:
                self.of_byte[token[0]] = i
        spelled |= {i: token.encode() for token, i in self.special.items()}
        self.length = np.array([len(spelled.get(i, b"")) for i in range(size)], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(size)), np.uint8)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, `_NONE` where there is none."""
        pair = left.astype(self.key_type) * self.key_type(self.size) + right.astype(self.key_type)
        place = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[place] == pair, self.rank[place], _NONE)

    def merged(self, letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of each word's ids, from the words' bytes."""
        symbols = self.of_byte[letters]
        word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        rank = np.full(len(symbols), _NONE, np.int32)
        ask = np.flatnonzero(word[1:] == word[:-1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank[ask] = self.ranks(symbols[ask], symbols[ask + 1])
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            keep = least != _NONE
            done.append((word[~keep], symbols[~keep]))
            at = np.flatnonzero(keep & (rank == least))
            # of overlapping occurrences, as in "aaa", every second one counts
            run = np.flatnonzero(np.append(True, np.diff(at) != 1)[: len(at)])
            since = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[since % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep[at + 1] = False
            # only pairs beside a merged symbol have another rank than before
            beside = np.zeros(len(symbols), bool)
            beside[at] = beside[np.maximum(at - 1, 0)] = True
            symbols, word, rank, beside = symbols[keep], word[keep], rank[keep], np.flatnonzero(beside[keep])
            rank[beside] = _NONE
            ask = beside[beside + 1 < len(word)]
            ask = ask[word[ask] == word[ask + 1]]
        of = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int32)
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(of, kind="stable")
        return ids[order], np.bincount(of, minlength=len(lengths))

    def plain(self, texts: list[str]) -> list[bytes]:
        """The ids, as little-endian 32-bit numbers, of texts without special tokens."""
        sizes = np.array([len(t) for t in texts])
        if not sizes.sum():
            return [b""] * len(texts)
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        text_starts = np.cumsum(sizes) - sizes
        word = word_starts(codes, text_starts[sizes > 0])
        length = np.diff(np.append(word, len(codes)))
        at = spread(np.zeros(len(word), np.int64), length)
        hashes = mixed(np.add.reduceat((codes + np.uint64(1)) * _FACTORS[at & 63], word))
        _, like, same = np.unique(hashes, return_index=True, return_inverse=True)
        stays = np.repeat(length == length[like[same]], length)
        if not np.array_equal(codes[stays], codes[(np.repeat(word[like[same]], length) + at)[stays]]) or not stays.all():
            like, same = np.arange(len(word)), np.arange(len(word))  # two words of one hash: each stands for itself
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        byte = np.append(0, np.cumsum(width))
        first, last = byte[word[like]], byte[word[like] + length[like]]
        ids, count = self.merged(np.frombuffer(whole.encode(), np.uint8)[spread(first, last - first)], last - first)
        ids = ids[spread((np.cumsum(count) - count)[same], count[same])].astype("<u4").tobytes()
        # the ids before each text are those of the words before it
        before = np.append(0, np.cumsum(count[same]))[np.searchsorted(word, np.append(text_starts, len(codes)))] * 4
        return [ids[a:b] for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True)]

    def encode(self, texts: list[str | None], at_once: int = 2_000_000) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        segments: list[str] = []
        layout: list[list[tuple[bool, int]]] = []
        for text in texts:
            row = []
            special = self.split is not None and any(s in (text or "") for s in self.special)
            for k, part in enumerate(self.split.split(text) if special else [text or ""]):
                if special and k % 2:
                    row.append((True, self.special[part]))
                else:
                    row.append((False, len(segments)))
                    segments.append(part)
            layout.append(row)
        coded: list[bytes] = []
        run: list[str] = []
        held = 0
        for segment in segments:
            run.append(segment)
            held += len(segment)
            if held >= at_once:
                coded += self.plain(run)
                run, held = [], 0
        coded += self.plain(run)
        return [
            coded[row[0][1]] if len(row) == 1 and not row[0][0]
            else b"".join(np.uint32(i).tobytes() if is_id else coded[i] for is_id, i in row)
            for row in layout
        ]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError("an id is outside the vocabulary")
        return self.bytes[spread(self.first[ids], self.length[ids])].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for all tasks of a Python worker."""
    return Vocabulary(path)


def _kept(df: DataFrame, out: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, kind)])


def bpe_encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """`df` with the list of ids of its text in `ids_col`; a column of that name is replaced.

    `path` names the vocabulary file on every machine.
    """
    rest = [c for c in df.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                coded = known.encode(batch.column(batch.num_columns - 1).to_pylist())
                offsets = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(coded), "<i4"))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*rest, ids_col])

    given = df.select(*[df[c] for c in rest], df[text_col].alias("\0text"))
    return given.mapInArrow(run, _kept(df, ids_col, T.ArrayType(T.IntegerType())))


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`df` with the text of its ids in `text_col`; bytes that are no UTF-8 become the replacement character."""
    rest = [c for c in df.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                texts = [
                    None if not v.is_valid else known.decode(v.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace")
                    for v in batch.column(batch.num_columns - 1)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(texts, pa.string())], [*rest, text_col]
                )

    given = df.select(*[df[c] for c in rest], df[ids_col].alias("\0ids"))
    return given.mapInArrow(run, _kept(df, text_col, T.StringType()))
