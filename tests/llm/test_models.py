import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import documents

from tripleloom.llm import common, language, quality, toxicity
from tripleloom.llm.common import slices, word_hashes
from tripleloom.llm.queries import op2_quality, op6_toxicity, op10_language

LABELS = "doc_id long, quality int, toxic int, text string, fp string"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, x, "t", "f") for i, q, x in rows], LABELS)


def held(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def of_labels(spark, tiny, name):
    return {r["doc_id"]: r[name] for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}


@pytest.fixture(scope="module")
def middle():
    return "/root/testdata/sf0.01"


def test_quality_on_held_out_documents(spark, middle):
    rows, truth = op2_quality(spark, middle).collect(), of_labels(spark, middle, "quality")
    assert len(rows) == spark.read.parquet(f"{middle}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == held(r["doc_id"], 5, 0) for r in rows)
    judged = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in judged]) >= 0.95


def test_toxicity_on_held_out_documents(spark, middle):
    rows, truth = op6_toxicity(spark, middle).collect(), of_labels(spark, middle, "toxic")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == held(r["doc_id"], 5, 0) for r in rows)
    judged = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in judged]) >= 0.95


def test_language_on_held_out_documents(spark, middle):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{middle}/documents.parquet").collect()}
    rows = op10_language(spark, middle).collect()
    assert all(0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"], 4, 2) for r in rows)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]] for r in rows if r["held_out"]]) >= 0.97


def test_scores_do_not_see_other_columns(spark):
    """Other ids, languages and sources of the same texts leave the scores as they are."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice("good fine text idiot words here".split()) for _ in range(30)) for _ in range(60)]
    docs = documents(spark, list(enumerate(texts)))
    known = labels(spark, [(i, i % 2, int("idiot" in x)) for i, x in enumerate(texts)])
    fitted, model = toxicity.fit(docs, known), quality.fit(docs, known)
    other = documents(spark, [(i + 1001, x) for i, x in enumerate(texts)])
    for scored in (lambda d: toxicity.scored(d, fitted).select("text", "toxicity"), lambda d: d.select("text", quality.score(d["text"], model))):
        assert sorted(map(tuple, scored(docs).collect())) == sorted(map(tuple, scored(other).collect()))


def test_held_out_labels_are_never_read(spark):
    texts = [(i, f"text number {i} of words") for i in range(200)]
    rows = [(i, i % 2, i % 3 == 0) for i, _ in texts]
    docs = documents(spark, texts)
    flipped = [(i, 1 - q if held(i, 5, 0) else q, 1 - x if held(i, 5, 0) else x) for i, q, x in rows]
    for fit, score in ((quality.fit, lambda m: m.scores(["text number 7"])), (toxicity.fit, lambda m: m[0].raw(["text number 7"])[0])):
        assert np.array_equal(score(fit(docs, labels(spark, [(i, q, int(x)) for i, q, x in rows]))), score(fit(docs, labels(spark, [(i, q, int(x)) for i, q, x in flipped]))))


def test_awkward_rows(spark, awkward, no_documents, tiny):
    train = spark.read.parquet(f"{tiny}/documents.parquet")
    known = spark.read.parquet(f"{tiny}/labels.parquet")
    fitted, model, languages = toxicity.fit(train, known), quality.fit(train, known), language.fit(train)
    scored = toxicity.scored(awkward, fitted)
    assert scored.columns == [*awkward.columns, "toxicity"] and scored.where("toxicity between 0 and 1").count() == 12
    assert awkward.select(quality.score(awkward["text"], model).alias("s")).where("s between 0 and 1").count() == 12
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predicted(awkward, languages).collect()}
    assert [found[i] for i in (1, 2, 3, 11)] == [("und", 0.0)] * 4 and found[10][0] != "und"
    assert toxicity.scored(no_documents, fitted).count() == language.predicted(no_documents, languages).count() == 0
    # nothing to learn from
    none = labels(spark, [])
    assert toxicity.fit(no_documents, none) is None and quality.fit(no_documents, none) is None
    assert {r["toxicity"] for r in toxicity.scored(awkward, None).collect()} == {0.25}
    assert {r["lang_pred"] for r in language.predicted(awkward, language.fit(no_documents)).collect()} == {"und"}


def test_repeated_and_null_labels(spark):
    docs = documents(spark, [(i, f"some text {i}") for i in range(40)])
    rows = [(i, i % 2, i % 2) for i in range(40)]
    once = quality.fit(docs, labels(spark, rows)).scores(["some text 3"])
    more = labels(spark, rows + rows + [(None, 1, 1), (3, None, None), (9999, 1, 1)])
    assert np.array_equal(quality.fit(docs, more).scores(["some text 3"]), once)


def test_long_texts_are_read_in_pieces():
    words = [f"w{i}" for i in range(60_000)]
    text = " ".join(words)
    for overlap in (0, 3):
        pieces = [p for _, ps in slices([text], 50_000, overlap) for p in ps]
        assert len(pieces) > 4 and all(len(p) <= 50_000 + 10 for p in pieces)
        found = [p.split() for p in pieces]
        again = found[0] + [w for before, ws in zip(found, found[1:]) for w in ws[overlap:]]
        assert again == words
        assert all(b[:overlap] == a[-overlap:] for a, b in zip(found, found[1:])) or not overlap
    rng = np.random.default_rng(1)
    model = toxicity.trained(["bad idiot", "good text"] * 20, np.array([1.0, 0.0] * 20), np.zeros(toxicity.WORDS), np.zeros(toxicity.HEADS), epochs=1)
    long = " ".join(f"x{i}" for i in rng.integers(0, 500, 200_000)) + " idiot"
    whole = model.raw([long])[0]
    assert np.allclose(whole, model.raw(["", long, None])[0][1])


def test_word_hashes_are_those_of_single_words():
    texts = ["One two, THREE-four", "", "été 2two", "one"]
    whole, head, of = word_hashes(texts, 3)
    expected = [(w, i) for i, ws in enumerate((("one", "two", "three", "four"), (), ("été", "2two"), ("one",))) for w in ws]
    assert of.tolist() == [i for _, i in expected]
    for h, (word, _) in zip(whole.tolist(), expected, strict=True):
        assert h == word_hashes([word])[0][0]
    assert whole[0] == whole[-1] and head[2] == word_hashes(["thr"], 3)[1][0]


def gradient_check(loss, parts, gradients, rng):
    for part, g in zip(parts, gradients, strict=True):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in part.shape)
            keep = part[at]
            part[at] = keep + 1e-6
            up = loss()
            part[at] = keep - 1e-6
            down = loss()
            part[at] = keep
            assert abs((up - down) / 2e-6 - g[at]) < 1e-4 * max(1, abs(g[at])) + 2e-4


def test_attention_gradients(monkeypatch):
    """The first step's gradients of the bags' loss, against differences."""
    seen = {}

    class Spy:
        def __init__(self, parts, rate):
            self.parts = parts

        def apply(self, gradients):
            seen.setdefault("now", ([p.copy() for p in self.parts], [g.copy() for g in gradients]))

    monkeypatch.setattr(quality, "Adam", Spy)
    texts = [" ".join(["Word", "word,", "X!!", "9"][i % (2 + k % 3)] for i in range(60 + 31 * k)) for k in range(6)]
    label = np.array([0.0, 1, 0, 1, 1, 0])
    model = quality.trained(texts, label, epochs=1)
    _, gradients = seen["now"]

    def loss():
        p = model.scores(texts)
        encoder, out = model.parts[0], model.parts[5]
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean() + 0.5e-4 * ((encoder**2).sum() + (out**2).sum())

    gradient_check(loss, model.parts, gradients, np.random.default_rng(0))


def test_thresholds_by_language():
    yes, no = np.zeros(toxicity.BINS), np.zeros(toxicity.BINS)
    yes[300], no[100] = 5, 7
    assert 100 / toxicity.BINS < toxicity.best_threshold(yes, no) <= 300 / toxicity.BINS
    table = toxicity.language_table()
    word, _, _ = toxicity.buckets(["the and nicht von les"])
    assert [int(x) for x in table[word]] == [1, 1, 2, 2, 3]


def test_weights_are_sparse():
    texts = ["der hund und die katze sind nicht da", "the dog and the cat are not here"] * 30
    model = language.trained(texts, ["de", "en"] * 30, np.ones(language.BUCKETS))
    assert 0 < np.count_nonzero(model.weights.any(1)) < 0.02 * language.BUCKETS
    assert model.predict(["der hund", "the dog", "...", None])[0] == ["de", "en", "und", "und"]


def test_a_rare_language_is_learned(spark):
    rows = [(i, "der hund und die katze sind im haus" if i % 2 else "the dog and the cat are home", "de" if i % 2 else "en") for i in range(3000)]
    rows += [(5000 + i, "le chien et le chat sont dans la maison", "fr") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit(docs, sample=100).names == ["de", "en", "fr"]
    assert language.fit(docs, sample=100, least=0).names == ["de", "en"]
    rows += [(9000 + i, "x y z", f"junk{i}") for i in range(50)]
    assert set(language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 100, languages=3).names) >= {"de", "en", "fr"}


def test_a_labelled_id_with_many_texts_is_one_row(spark):
    docs = documents(spark, [(1, f"text {i}") for i in range(500)] + [(2, "b"), (3, None)])
    known = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (None, 1)], "doc_id long, quality int")
    rows = common.labelled_sample(docs, known, "quality", 1_000_003, 10).collect()
    assert sorted(map(tuple, rows)) == [(1, "text 0", 0.0), (2, "b", 1.0), (3, None, 1.0)]


def test_columns_of_inner_names_do_no_harm(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet").limit(50)
    known = spark.read.parquet(f"{middle}/labels.parquet")
    fitted = toxicity.fit(spark.read.parquet(f"{middle}/documents.parquet"), known)
    plain = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, fitted, "score").collect()}
    more = docs.withColumns({c: F.lit("x") for c in ("language", "raw", "toxicity", "value", "label")}).withColumn("m", F.create_map(F.lit(1), "text"))
    kept = toxicity.scored(more, fitted, "score")
    assert kept.columns == [*more.columns, "score"] and {r["doc_id"]: r["score"] for r in kept.collect()} == plain
