"""Tables of the operators' tests, with every awkward row at once."""

import public_tokenizers

PATH = public_tokenizers.path("byte_bpe_50k.json")
KIND = "doc_id long, text string, lang string, source string, n_chars long, fp string, key string, score string, value int, label int"
LONG = "the long tale of a very long text " * 40_000


def documents(spark, texts):
    """Rows of (id, text), with further columns of names that operators use inside."""
    rows = [(i, x, "en" if i is None or i % 2 else "de", "s", len(x or ""), "x", "y", "z", 1, 1) for i, x in texts]
    return spark.createDataFrame(rows, KIND)


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "two words"), (5, "two words"), (None, "no id here at all"),
    (7, "ÀÉÎ ñandú ß İstanbul 😀   x"), (8, "same text same text"), (9, "same text same text"), (10, LONG), (11, "12345 !!! ###"),
]
