"""First-fit decreasing with a tournament tree, run independently in randomised groups of documents.

A document is its ids and the end id. Whole sequences are cut off its front; the piece that is left is
an item. Items are dealt to groups of about `at_once` by a hash of their row, and each group packs its
items longest first, each into the first sequence with room. A tournament tree over the sequences'
room finds that one: the winner of a match is the larger room, and the way down goes left wherever
the left side's winner fits.

A sequence is padded to its full length unless its length is a power of two. So that nothing is
padded, the emptiest sequences of a group then fill the gaps of the fullest ones, with one cut for a
gap at most, and the last one left is cut into powers of two. Only lengths go through the shuffle;
the ids of an item are in a written table and are read again only where an item is cut.

A null or empty text is the end id alone. Repeated rows are items of their own, dealt by their place
and not by their content, so that they spread over all groups; rows without an id are packed like any
other. Further columns are not read. A text is encoded word by word, words being what ASCII white space
leaves, so a long text needs memory for its ids and for a run of about a million characters; only a
single word without white space is given to the library as a whole. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
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
from tokenizers import Tokenizer

from tripleloom.llm.bpe import byte_letters
from tripleloom.llm.common import cut, id_and_text, if_small
from tripleloom.session import cut_lineage

#: Words that a worker remembers, and the longest of them in bytes.
REMEMBERED, LONGEST = 400_000, 64
#: What stands for the end of a word in the merges; no word that is merged here holds it.
END = b"\0"
#: Words that are cut and merged here: Latin letters whose lower case and composed form are one letter each, and marks.
PLAIN = re.compile("[\n!-~\xa1-\u012f\u0131-\u017f\u2010-\u2027\u20ac]+")
SPACE = re.compile(r"[ \t\n\r]")
#: The vocabulary's pattern over these words, and the line end that parts them.
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|\n|[^\n{_LETTERS}{_NUMBERS}]+")


class WordEncoder:
    """Ids of whole texts, where each frequent word is encoded once.

    The vocabulary's pattern never joins what white space parts, so a text's ids are those of its words. Words of
    Latin letters and common marks are cut by the same pattern here and merged many at a time, with a
    byte that they can't hold in place of the mark of a word's end; all others go through the library.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        of_letter = {c: bytes([b]) for c, b in letters.items()}
        suffix = model["end_of_word_suffix"]

        def spelled(token: str) -> bytes:
            ends = token.endswith(suffix)
            return b"".join(of_letter[c] for c in token.removesuffix(suffix)) + (END if ends else b"")

        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # a letter joins the end mark before anything else happens to it
        tokens = [*letters, *[c + suffix for c in letters], *["".join(p) for p in pairs]]
        ranks = {spelled(t): i for i, t in enumerate(tokens)}
        self.id_of_rank = np.array([model["vocab"][t] for t in tokens], "<u4")
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.line = model["vocab"][next(c for c, b in letters.items() if b == 10) + suffix]
        self.known: dict[bytes, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        lines = b"\n".join(new).decode()
        if PLAIN.fullmatch(lines) and "<|" not in lines:
            plain, rest = new, []
        else:
            apart = [bool(PLAIN.fullmatch(t)) and "<|" not in t for t in lines.split("\n")]
            plain = [w for w, p in zip(new, apart, strict=True) if p]
            rest = [w for w, p in zip(new, apart, strict=True) if not p]
            lines = b"\n".join(plain).decode()
        if plain:
            parts = PARTS.findall(lines.lower() + "\n")
            ids = self.id_of_rank[self.merges.encode_to_numpy("\0".join(parts) + "\0")]
            stops = np.flatnonzero(ids == self.line) * 4
            starts, data = np.append(0, stops[:-1] + 4).tolist(), ids.tobytes()
            self.known.update(zip(plain, [data[a:b] for a, b in zip(starts, stops.tolist(), strict=True)], strict=True))
        if rest:
            coded = self.library.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
            self.known.update((w, np.array(c.ids, "<u4").tobytes()) for w, c in zip(rest, coded, strict=True))

    def encode(self, texts: list[str | None], run: int = 500_000) -> Iterator[np.ndarray]:
        """The ids of each text; about `run` characters are worked on together."""
        held: list[tuple[bool, list[bytes]]] = []  # whether a text ends here, and words
        size, parts = 0, []
        for place, text in enumerate(texts):
            text, start = text or "", 0
            while True:
                space = SPACE.search(text, start + run) if len(text) - start > run else None
                stop = space.start() if space else len(text)
                held.append((stop == len(text), text[start:stop].encode().split()))
                size += stop - start
                if size >= run or (place == len(texts) - 1 and stop == len(text)):
                    self._know([words for _, words in held])
                    for ends, words in held:
                        parts.append(b"".join(map(self.known.__getitem__, words)))
                        if ends:
                            yield np.frombuffer(b"".join(parts), "<u4")
                            parts = []
                    self._forget([words for _, words in held])
                    held, size = [], 0
                start = stop
                if stop == len(text):
                    break

    def _know(self, lists: list[list[bytes]]) -> None:
        missing = set().union(*lists).difference(self.known)
        if missing:
            self._learn(list(missing))

    def _forget(self, lists: list[list[bytes]]) -> None:
        if len(self.known) > REMEMBERED:
            self.known = {}
        for w in {w for words in lists for w in words if len(w) > LONGEST}:
            self.known.pop(w, None)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encoded(docs: DataFrame, path: str, room: int, end_id: int) -> DataFrame:
    """(row, doc_id, start, length, ids_crc32, doc_tokens, ids): whole sequences without ids, and items with them.

    `row` is a number that no other item has.
    """
    kind = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    names = [c.split()[0] for c in kind.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = word_encoder(path), np.array([end_id], "<u4")
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                out: list[tuple] = []
                coded = known.encode(batch.column(1).to_pylist())
                for doc_id, found in zip(batch.column(0).to_pylist(), coded, strict=True):
                    ids = np.concatenate([found, end])
                    for a in range(0, len(ids), room):
                        data = ids[a : a + room].tobytes()
                        item = data if len(data) < 4 * room else None
                        out.append((row, doc_id, a, len(data) // 4, zlib.crc32(data), len(ids), item))
                        row += 1
                columns = list(zip(*out, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, kind)


def first_fit(lengths: list[int], room: int) -> list[list[int]]:
    """Places of the items in each sequence; every item goes into the first sequence with room for it."""
    leaves = 1 << max(len(lengths) - 1, 0).bit_length()
    best = [room] * (2 * leaves)
    bins: list[list[int]] = []
    for place, length in enumerate(lengths):
        at = 1
        while at < leaves:
            at *= 2
            if best[at] < length:
                at += 1
        if at - leaves == len(bins):
            bins.append([])
        bins[at - leaves].append(place)
        best[at] -= length
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
    return bins


def without_gaps(bins: list[list[tuple[int, int, int]]], room: int) -> list[list[tuple[int, int, int]]]:
    """The parts (item, from, length) of sequences so dealt that each has `room` ids or a power of two of them.

    The emptiest sequence gives to the fullest one with a gap, and is cut where the gap ends.
    """
    fill = [sum(n for _, _, n in b) for b in bins]
    whole = [i for i, n in enumerate(fill) if n == room or n & (n - 1) == 0]
    out = [bins[i] for i in whole]
    done = set(whole)
    open_bins = sorted((i for i in range(len(bins)) if i not in done), key=lambda i: (-fill[i], i))
    left = [list(bins[i]) for i in open_bins]
    low, high = 0, len(left) - 1
    gap = room - fill[open_bins[0]] if open_bins else 0
    while low < high:
        item, start, n = left[high].pop()
        taken = min(n, gap)
        left[low].append((item, start, taken))
        if taken < n:
            left[high].append((item, start + taken, n - taken))
        gap -= taken
        if not left[high]:
            high -= 1
        if not gap:
            out.append(left[low])
            low += 1
            gap = room - sum(n for _, _, n in left[low])
    if low == high and left[low]:
        out += powers(left[low])
    return out


def powers(parts: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """One sequence cut into several, whose lengths are the powers of two that make up its own."""
    total = sum(n for _, _, n in parts)
    out, parts = [], parts[::-1]
    for k in reversed(range(total.bit_length())):
        if total >> k & 1:
            want, row = 1 << k, []
            while want:
                item, start, n = parts.pop()
                taken = min(n, want)
                row.append((item, start, taken))
                want -= taken
                if taken < n:
                    parts.append((item, start + taken, n - taken))
            out.append(row)
    return out


def packed_items(items: DataFrame, room: int, at_once: int) -> DataFrame:
    """`items` without ids as (..., sequence_id, offset, first): a row for each part, `first` its place in the item."""
    groups = max(1, -(-items.count() // at_once))
    kept = ["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        lengths = group["length"].tolist()
        bins = without_gaps([[(i, 0, lengths[i]) for i in b] for b in first_fit(lengths, room)], room)
        item, first, length = np.array([p for b in bins for p in b], np.int64).reshape(-1, 3).T
        of_bin = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        before = np.cumsum(length) - length
        opening = np.searchsorted(of_bin, np.arange(len(bins)))
        out = group.iloc[item].reset_index(drop=True)
        return pd.DataFrame({
            "row": out["row"], "doc_id": out["doc_id"], "start": out["start"] + first, "length": length,
            "ids_crc32": out["ids_crc32"].astype("Int64").where(length == out["length"]), "doc_tokens": out["doc_tokens"],
            "sequence_id": (int(group["group"].iloc[0]) << 32) + of_bin, "offset": before - before[opening][of_bin], "first": first,
        })

    dealt = items.select(*kept, F.pmod(F.xxhash64(F.lit("group"), "row"), F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInPandas(
        pack, ", ".join(f"{c} long" for c in [*kept, "sequence_id", "offset", "first"])
    )


def first_fit_packed(docs: DataFrame, path: str, room: int = 2048, end_id: int = 1, at_once: int = 16_384) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    if room & (room - 1):
        raise ValueError("the room of a sequence has to be a power of two")
    pieces = cut_lineage(encoded(id_and_text(docs), path, room, end_id))
    items = pieces.where(F.col("length") < room)
    parts = cut(packed_items(items.drop("ids"), room, at_once))
    split = parts.where(F.col("ids_crc32").isNull()).drop("ids_crc32")
    wanted = split.select("row", "first", "length").withColumnsRenamed({"row": "of_row", "length": "n"})
    own = F.expr("substring(ids, cast(first * 4 + 1 as int), cast(n * 4 as int))")
    sums = items.join(if_small(wanted), F.col("row") == F.col("of_row")).select(
        "of_row", F.col("first").alias("of_first"), F.crc32(own).alias("ids_crc32")
    )
    mended = split.join(sums, (F.col("row") == F.col("of_row")) & (F.col("first") == F.col("of_first")))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # no group reaches this number
    alone = pieces.where(F.col("length") == room).select(
        "*", (F.col("row") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return (
        parts.where(F.col("ids_crc32").isNotNull()).select(out)
        .unionByName(mended.select(out)).unionByName(alone.select(out))
    )
