import hashlib
import random
import zlib

import numpy as np
import pytest
from tests_llm_helpers import PATH, documents
from tokenizers import Tokenizer

from tripleloom.llm import packing
from tripleloom.llm.bpe import Vocabulary, bpe_decode, bpe_encode
from tripleloom.llm.queries import op9_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n):
    rng = random.Random(3)
    signs = " \n\t  aab'scdéß😀1２٣  \x1c\x85!?.<|endoftext|>' 've's"
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 25))) for _ in range(n)]
    return made + ["", "a", "  b", "a  ", "a <|endoftext|> b", "<|endoftext|>" * 2, "aaaaaaa aaaa", " \n b", "a \n", "I'll we've 'tis 'll'"]


def test_encoding_and_decoding_match_the_library(library):
    texts, known = odd_texts(3000), Vocabulary(PATH)
    for text, coded in zip(texts, known.encode(texts), strict=True):
        ids = np.frombuffer(coded, "<u4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert known.decode(ids.astype(int)).decode("utf-8", "replace") == library.decode(ids.tolist(), skip_special_tokens=False)
        assert packing.encoder(PATH).ids(text).tolist() == ids.tolist(), repr(text)


def test_words_of_one_hash_stand_for_themselves(library, monkeypatch):
    monkeypatch.setattr("tripleloom.llm.bpe.mixed", lambda h: h & np.uint64(1))
    texts = odd_texts(50)
    coded = Vocabulary(PATH).encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_pieces_of_a_batch_do_not_matter():
    texts, known = odd_texts(300), Vocabulary(PATH)
    assert known.encode(texts, at_once=7) == known.encode(texts)


def test_decoding_unknown_or_broken_ids(spark):
    known = Vocabulary(PATH)
    with pytest.raises(ValueError):
        known.decode(np.array([known.size]))
    rows = spark.createDataFrame([(1, None), (2, []), (3, [known.of_byte[0xC3].item()])], "k int, ids array<int>")
    assert [r["decoded"] for r in bpe_decode(rows, PATH).orderBy("k").collect()] == [None, "", "�"]


def test_round_trip_of_awkward_rows(awkward, no_documents, library):
    coded = bpe_encode(awkward, PATH)
    assert coded.columns == [*awkward.columns, "ids"]
    for r in bpe_decode(coded, PATH).collect():
        assert r["decoded"] == (r["text"] or "") and r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert bpe_decode(bpe_encode(no_documents, PATH), PATH).count() == 0


def test_op9_digests(spark, tiny, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    for r in op9_bpe(spark, tiny).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def check_packing(rows, texts, library, room):
    """Every piece is right, and every sequence is full without gaps; returns the number of sequences."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc_id, found in by_doc.items():
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        found = sorted(found, key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(-(-len(ids) // room)))
        assert [r["start"] for r in found] == np.cumsum([0, *(r["length"] for r in found)])[:-1].tolist()
        assert sum(r["length"] for r in found) == len(ids) and all(r["length"] == room for r in found[1:])
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in found)
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= room
    return len(by_sequence)


@pytest.mark.parametrize("at_once,more", [(50_000, 1.01), (20, 1.06)])
def test_packing(spark, tiny, library, at_once, more):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.best_fit_packed(docs, PATH, at_once=at_once).collect()
    n = check_packing(rows, texts, library, 1024)
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert n <= more * least + 1


def test_packing_awkward_rows(spark, awkward, no_documents, library):
    rows = packing.best_fit_packed(awkward, PATH, room=8).collect()
    assert sum(r["doc_id"] == 5 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) >= 1
    single = [r for r in rows if r["doc_id"] not in (5, None)]
    texts = {r["doc_id"]: r["text"] for r in awkward.collect() if r["doc_id"] not in (5, None)}
    assert {r["doc_id"] for r in single} == texts.keys() and [r["length"] for r in rows if r["doc_id"] == 1] == [1]
    assert packing.best_fit_packed(no_documents, PATH).count() == 0
    docs = documents(spark, [(i, "x " * n) for i, n in enumerate([1, 7, 8, 9, 15, 16, 17, 3, 3])])
    check_packing(packing.best_fit_packed(docs, PATH, room=8).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, library, 8)


def test_best_fit_takes_the_closest_room():
    bins, places, fills = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and places.tolist() == [0, 0, 6, 5, 8] and fills.tolist() == [10, 10]
