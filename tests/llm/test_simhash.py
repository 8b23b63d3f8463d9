import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests_llm_helpers import documents
from tripleloom.llm import simhash
from tripleloom.llm.simhash import Ring


def slow_fingerprint(text, words):
    parts = "".join(c.lower() if c.isascii() else c for c in text or "")
    parts = [p for p in __import__("re").split(r"[\x20\x09-\x0d]+", parts) if p]
    grams = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashed = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashed) * 2 > len(hashed))


def slow_components(rows, linked):
    ids = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if ids[i] != ids[j] and linked(rows[i], rows[j]):
                    low, high = sorted((ids[i], ids[j]))
                    ids = [low if x == high else x for x in ids]
                    changed = True
    least = {}
    for n, (doc_id, *_) in zip(ids, rows):
        if doc_id is not None:
            least[n] = min(least.get(n, doc_id), doc_id)
    return [least.get(n) for n in ids]


def noisy(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice("alpha beta gamma delta".split())
    return " ".join(words)


def some_texts(rng):
    base = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(300)) for _ in range(90)) for _ in range(12)]
    texts = base + [noisy(rng, b, n) for b in base[:6] for n in (0, 1, 1, 2, 4, 8)]
    return texts


@pytest.mark.parametrize("ring,bits", [(Ring(9, 4, 4), 4), (Ring(11, 4, 5), 4), (Ring(8, 6, 5), 6), (Ring(9, 6, 9), 6), (Ring(10, 6, 10), 6)])
def test_keys_lose_no_pair(ring, bits):
    """Every two fingerprints that differ in few bits share a key whose chains they keep."""
    rng = random.Random(1)
    chains = ring.chains(bits)
    for _ in range(3000):
        differs = sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits)))
        if rng.random() < 0.3:  # crowded together
            at = rng.randrange(58)
            differs = sum(1 << b for b in rng.sample(range(at, at + 6), rng.randint(0, min(bits, 6))))
        shared = [s for s, mask in ring.keys() if not differs & mask]
        assert any(all((differs & mask).bit_count() <= most for mask, most in chains[s]) for s in shared)


def test_shared_masks_keep_every_start():
    for ring in (Ring(9, 4, 4), Ring(11, 4, 5)):
        assert len({m for _, m in ring.keys()}) == len(ring.keys())


def test_components_match_brute_force(spark):
    rng = random.Random(5)
    texts = list(enumerate(some_texts(rng) + ["", None, " \n", "One Two", "one two", "one two three four five"]))
    texts.append((None, "one two"))
    found = simhash.simhash_components(documents(spark, texts)).collect()
    rows = [(i, slow_fingerprint(x, 4)) for i, x in texts]
    expected = slow_components(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found), key=str) == sorted(
        ((i, fp, c) for (i, fp), c in zip(rows, expected)), key=str
    )


def test_large_keys_give_the_same_components(spark, monkeypatch):
    rng = random.Random(6)
    docs = documents(spark, list(enumerate(some_texts(rng))))
    plain = {tuple(r) for r in simhash.simhash_components(docs).collect()}
    monkeypatch.setattr(simhash, "SMALL", 1)
    monkeypatch.setattr(simhash, "BLOCK", 3)
    assert {tuple(r) for r in simhash.simhash_components(docs).collect()} == plain


def test_every_ring_gives_the_same_components(spark, monkeypatch):
    rng = random.Random(8)
    texts = list(enumerate(some_texts(rng)))
    rows = [(i, slow_fingerprint(x, 4)) for i, x in texts]
    expected = slow_components(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    rings = {simhash.ring_for(n) for n in (0, 1 << 24, 1 << 40)}
    assert len(rings) == 2 and max(len(r.keys()) for r in rings) <= 36
    for ring in rings:
        monkeypatch.setattr(simhash, "ring_for", lambda nodes, max_bits, ring=ring: ring)
        found = simhash.simhash_components(documents(spark, texts)).collect()
        assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(i, c) for (i, _), c in zip(texts, expected)]


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(7)
    texts = list(enumerate(some_texts(rng) + ["", "", "short text", "Short  Text"]))
    rows = [(i, slow_fingerprint(x, 4)) for i, x in texts]
    expected = set(slow_components(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4))
    docs = documents(spark, texts).withColumn("m", F.create_map(F.lit("k"), "text"))
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    twice = simhash.without_near_copies(docs.unionByName(docs)).collect()
    assert sorted(r["doc_id"] for r in twice) == sorted(expected)


def test_awkward_rows(awkward, no_documents):
    found = simhash.simhash_components(awkward).collect()
    assert len(found) == 12
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["fp"] for i in (1, 2, 3)] == [0, 0, 0] and {by_id[i]["component_id"] for i in (1, 2, 3)} == {1}
    assert by_id[8]["component_id"] == by_id[9]["component_id"] == 8 and by_id[None]["component_id"] is None
    kept = sorted((r["doc_id"] for r in simhash.without_near_copies(awkward).collect()), key=str)
    assert kept == [1, 10, 11, 4, 5, 7, 8, None]
    assert simhash.simhash_components(no_documents).count() == simhash.without_near_copies(no_documents).count() == 0


@pytest.mark.parametrize("run", [1, 3, 1 << 16])
def test_fingerprints_by_runs(run):
    for text in [None, "", "a", "a b c", "a b c d", "A b C d e", "a b c d e f g h " * 5]:
        whole = [s for part in simhash.shingles(text, 4, run) for s in part]
        parts = (text or "").lower().encode().split()
        assert whole == ([b" ".join(parts[i : i + 4]) for i in range(max(1, len(parts) - 3))] if parts else [])
        assert int(simhash.fingerprint(text, 4)) == slow_fingerprint(text, 4)
