import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tests_llm_helpers import documents
from tokenizers import Tokenizer

from tripleloom.llm import first_fit as ff

WORDS = public_tokenizers.path("word_bpe_49k.json")


def slow_first_fit(lengths, room):
    bins, free = [], []
    for place, n in enumerate(lengths):
        for b, left in enumerate(free):
            if left >= n:
                break
        else:
            b = len(bins)
            bins.append([])
            free.append(room)
        bins[b].append(place)
        free[b] -= n
    return bins


@pytest.mark.parametrize("seed", range(20))
def test_tree_finds_the_first_sequence_with_room(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, rng.choice([40, 64])) for _ in range(rng.randint(0, 150))]
    assert ff.first_fit(lengths, 64) == slow_first_fit(lengths, 64)


@pytest.mark.parametrize("seed", range(20))
def test_gaps_are_filled_and_no_id_is_lost(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 63) for _ in range(rng.randint(1, 60))), reverse=True)
    bins = [[(i, 0, lengths[i]) for i in b] for b in ff.first_fit(lengths, 64)]
    found = ff.without_gaps(bins, 64)
    fills = [sum(n for _, _, n in b) for b in found]
    assert all(f & (f - 1) == 0 and 0 < f <= 64 for f in fills) and sum(fills) == sum(lengths)
    assert sum(f < 64 for f in fills) <= 6 + sum(f < 64 and f & (f - 1) == 0 for f in map(lambda b: sum(p[2] for p in b), bins))
    spans = sorted((i, a, a + n) for b in found for i, a, n in b)
    ends = defaultdict(int)
    for i, a, b in spans:
        assert ends[i] == a
        ends[i] = b
    assert ends == dict(enumerate(lengths))
    # a gap is closed by at most one cut, and the last sequence by one a power of two
    assert len(spans) - len(lengths) <= sum(f < 64 for f in map(lambda b: sum(p[2] for p in b), bins)) + 6


def test_words_give_the_librarys_ids():
    library = Tokenizer.from_file(WORDS)
    texts = [
        None, "", " \n\t ", "Hello  World", "<|endoftext|>a <|startoftext|>", "don't WE'LL 123 ½ ²", "İstanbul ΣΑΣ Ǆ ﬁ é ́ x",
        "a\x1cb\x85c\xa0d e​f", "日本語 中文 mixed日本", "😀👍🏽 <|", "x" * 5000, "\x0b\x0ca\x00b", "the cat " * 100,
    ]
    rng = random.Random(4)
    texts += ["".join(chr(rng.choice([32, 9, rng.randrange(33, 600), rng.randrange(0x300, 0x3000)])) for _ in range(80)) for _ in range(200)]
    for run in (7, 1_000_000):
        coder = ff.WordEncoder(WORDS)
        for _ in range(2):
            found = [ids.tolist() for ids in coder.encode(texts, run)]
            assert found == [library.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_merges_of_every_kind_of_word():
    """Runs of marks and letters, whole entries of the vocabulary and joined ones, and the words of the given documents."""
    library, coder = Tokenizer.from_file(WORDS), ff.WordEncoder(WORDS)
    rng = random.Random(9)
    marks = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x180), *range(0x2010, 0x2028), 0x20AC]]
    words = [m * n for m in marks for n in (1, 2, 3, 5, 8, 13, 40)]
    entries = [t.replace("</w>", "") for t in library.get_vocab() if t.isascii() and "<|" not in t]
    words += rng.sample(entries, 8000) + ["".join(rng.sample(entries, 2)) for _ in range(8000)]
    words += ["".join(rng.choice(marks) * rng.randint(1, 4) for _ in range(rng.randint(1, 8))) for _ in range(8000)]
    words += ["".join(rng.choice("aeinrst'") for _ in range(rng.randint(1, 30))) for _ in range(8000)]
    text = " ".join(words)
    assert next(coder.encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(bool(ff.PLAIN.fullmatch(w)) for w in words) > 0.95 * len(words)


def test_a_full_memory_of_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(ff, "REMEMBERED", 3)
    library, coder = Tokenizer.from_file(WORDS), ff.WordEncoder(WORDS)
    for text in ["a b c d e", "c d e f g", "a a g", "x y z a b"]:
        assert next(coder.encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids


def valid(rows, texts, room=2048):
    """Every id in one piece, no gap in a sequence, nothing padded."""
    library = Tokenizer.from_file(WORDS)
    wanted, found = defaultdict(int), defaultdict(list)
    for i, text in texts:
        wanted[(i, tuple([*library.encode(text or "", add_special_tokens=False).ids, 1]))] += 1
    for r in rows:
        found[r["doc_id"]].append(r)
    assert set(found) == {i for i, _ in texts}
    for i, pieces in found.items():
        # copies of a row are told apart only by their number
        for (j, ids), n in wanted.items():
            if j != i:
                continue
            data = np.array(ids, "<u4")
            covered = np.zeros(len(ids), int)
            for p in pieces:
                part = slice(p["start"], p["start"] + p["length"])
                if p["doc_tokens"] == len(ids) and zlib.crc32(data[part].tobytes()) == p["ids_crc32"]:
                    covered[part] += 1
            assert (covered >= n).all()
        assert sum(p["length"] for p in pieces) == sum(len(ids) * n for (j, ids), n in wanted.items() if j == i)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= room and at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("at_once", [16_384, 40])
def test_given_documents(spark, tiny, at_once):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = ff.first_fit_packed(docs, WORDS, at_once=at_once).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sequences = valid(rows, texts)
    groups = -(-len(texts) // at_once)
    short = sum(sum(n for _, n in parts) < 2048 for parts in sequences.values())
    assert short <= 16 * groups


def test_awkward_rows(spark, awkward, no_documents):
    rows = ff.first_fit_packed(awkward, WORDS).collect()
    valid(rows, [(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert ff.first_fit_packed(no_documents, WORDS).count() == 0
    with pytest.raises(ValueError):
        ff.first_fit_packed(awkward, WORDS, room=1000)


def test_repeated_rows_spread_over_groups(spark):
    rows = [(1, "one and the same text " * 20)] * 400 + [(i, f"another text {i}") for i in range(2, 200)]
    packed = ff.first_fit_packed(documents(spark, rows), WORDS, at_once=100).collect()
    valid(packed, rows)
    groups = defaultdict(int)
    for r in packed:
        groups[r["sequence_id"] >> 32] += r["doc_id"] == 1
    assert len(groups) >= 5 and max(groups.values()) < 200
