import random

import pytest
from pyspark.sql import functions as F
from test_simhash import slow_components
from tests_llm_helpers import PATH, documents
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tripleloom.llm import quality, secrets, simhash, toxicity
from tripleloom.llm.queries import llm_checks, llm_queries


def test_names_and_checks():
    numbers = sorted(int(n[2:].split("_")[0]) for n in llm_queries())
    assert numbers == list(range(1, 14)) and set(llm_checks()) <= set(llm_queries())
    assert set(llm_queries()) | {"pipeline"} <= set(entry.queries()) and set(llm_checks()) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "simhash_near_dedup", "secrets", "best_fit_packing"]


def test_stages_against_their_operators(spark, tiny):
    """Each stage on what its predecessor kept, held against the operator's judgement of every row."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    known = spark.read.parquet(f"{tiny}/labels.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    kept = stages["toxicity"](spark, docs, tiny)
    fitted = toxicity.fit(docs, known)
    expected = {r["doc_id"] for r in toxicity.scored(docs, fitted).collect() if r["toxicity"] < 0.5}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == expected

    docs = kept.cache()
    kept = stages["quality"](spark, docs, tiny)
    model = quality.fit(docs, known)
    rows = docs.collect()
    good = model.scores([r["text"] for r in rows])
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r, s in zip(rows, good) if s >= 0.3}

    docs = kept.cache()
    kept = stages["simhash_near_dedup"](spark, docs, tiny)
    rows = [(r["doc_id"], int(simhash.fingerprint(r["text"], 4))) for r in docs.collect()]
    expected = slow_components(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == set(expected)

    docs = kept.cache()
    kept = stages["secrets"](spark, docs, tiny)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    cleaned = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == columns and cleaned.keys() == texts.keys()
    for i, r in cleaned.items():
        assert r["text"] == secrets.redacted(texts[i]) and r["n_chars"] == len(r["text"]) and not secrets.pattern_spans(r["text"])

    packed = stages["best_fit_packing"](spark, kept, tiny)
    library = Tokenizer.from_file(PATH)
    length = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert length == {i: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in cleaned.items()}


def test_run_gives_the_rows_of_its_stages(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tiny).cache()
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, docs.select(keys).collect())) == sorted(map(tuple, corpus_pipeline.run(spark, tiny).select(keys).collect()))


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(11)
    base = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(5000)}" for _ in range(200)) for _ in range(20)]
    rows = list(enumerate(base))
    rows += [(100 + i, x) for i, x in enumerate(base[:5])]
    rows += [(200 + i, x.replace(x.split()[50], "changed", 1)) for i, x in enumerate(base[:5])]
    return documents(spark, rows)


def test_planted_copies_go_and_others_stay(spark, tiny, planted):
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, planted, tiny)
    rows = [(r["doc_id"], int(simhash.fingerprint(r["text"], 4))) for r in planted.collect()]
    expected = set(slow_components(rows, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4))
    assert set(range(20)) <= expected and not expected & set(range(100, 105)) and len(expected) < 25
    assert kept.columns == planted.columns and {r["doc_id"] for r in kept.collect()} == expected


def test_repeated_and_null_ids_are_judged_by_row(spark, tiny):
    a, b, c, d = (" ".join(f"{x}{n}" for n in range(60)) for x in "abcd")
    rows = [(1, a), (2, a.upper()), (2, b), (3, c), (3, c), (None, c), (None, d), (None, d), (None, d.upper()), (None, a)]
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, documents(spark, rows), tiny)
    found = sorted((str(r["doc_id"]), r["text"][0].lower()) for r in kept.collect())
    assert found == [("1", "a"), ("2", "b"), ("3", "c"), ("None", "d")]


@pytest.mark.parametrize("name", ["toxicity", "quality", "simhash_near_dedup", "secrets", "best_fit_packing"])
def test_awkward_rows_and_empty_tables(spark, tiny, awkward, no_documents, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = stage(spark, awkward, tiny)
    ids = {r["doc_id"] for r in rows.collect()}
    assert ids <= {r["doc_id"] for r in awkward.collect()} and stage(spark, no_documents, tiny).count() == 0
    if name == "simhash_near_dedup":
        assert {None, 1, 4, 5, 7, 8, 10} <= ids and 9 not in ids and 2 not in ids
    if name == "secrets":
        assert rows.count() == 12 and rows.where("doc_id = 1 and text is null").count() == 1


def test_every_stage_bounds_its_batches(spark, tiny):
    """A stage that is run alone hands Python at most `ROWS_AT_ONCE` texts at once; a smaller bound of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, docs = spark.conf.get(name), documents(spark, [(1, "some words")])
    try:
        for given, expected in (("10000", "1000"), ("0", "1000"), ("200", "200")):
            for stage in ("secrets", "simhash_near_dedup"):
                spark.conf.set(name, given)
                dict(corpus_pipeline.STAGES)[stage](spark, docs, tiny)
                assert spark.conf.get(name) == expected
    finally:
        spark.conf.set(name, before)
