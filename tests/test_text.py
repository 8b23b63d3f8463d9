from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tripleloom.functions import text as x
from tripleloom.sources.constants import constant_rows


def apply(spark, function, values):
    rows = constant_rows(spark, {"i": "long", "v": "string"}, list(enumerate(values)))
    out = rows.select("i", function(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(out, key=lambda r: r["i"])]


def test_slug(spark):
    names = ["Warner Bros.", "Amélie", "!!!", "A  B--C", "Ünder", ""]
    assert apply(spark, x.slug, names) == ["warner-bros", "am-lie", "", "a-b-c", "nder", ""]
    assert apply(spark, lambda c: x.slug(c, "_"), ["Science Fiction"]) == ["science_fiction"]


def test_strip_takes_every_kind_of_blank(spark):
    values = ["  a b ", "\t\na ", " a\x1f", "　", "a"]
    assert apply(spark, x.strip, values) == [v.strip() for v in values]


def test_character_name(spark):
    values = [None, "a|b", " a\t b  c ", "|"]
    assert apply(spark, x.character_name, values) == ["", "a/b", "a b c", "/"]


def test_percent_decode_like_the_standard_library(spark):
    values = ["a%20b", "%C3%A9", "a+b", "%zz", "a%20b%zz%", "100%", "Person%5F9", "plain", "%41%4", "%2B"]
    assert apply(spark, x.percent_decode, values) == [unquote(v) for v in values]


def test_json_names(spark):
    values = ['[{"name": " A "}, {"name": "B"}]', "", "[]", None]
    assert apply(spark, x.json_names, values) == [["A", "B"], [], [], []]
    with pytest.raises(Exception, match="(?i)malformed"):
        apply(spark, x.json_names, ["[{"])


def test_small_functions(spark):
    assert apply(spark, x.whole_part, ["169.0", "", "121"]) == ["169", "", "121"]
    assert apply(spark, x.last_segment, ["http://a/b/42", "x"]) == ["42", "x"]
    assert apply(spark, lambda c: x.str_after(c, "res/"), ["a/res/b/res/c", "none", None]) == ["b/res/c", "", ""]
    assert apply(spark, x.year_value, ["1970-07-30T00:00:00Z", "1970-07-30", "http://genid/1", None]) == [
        1970, 1970, None, None,
    ]
    assert apply(spark, lambda c: x.first_or_blank(F.split(c, r"\|")), ["a|b", ""]) == ["a", ""]
    kind = F.when(F.startswith("v", F.lit("http")), "iri").otherwise("lit")
    space = "http://dbpedia.org/resource/"
    assert apply(spark, lambda c: x.name_of_resource(c, kind, space), [space + "New_York", "New_York"]) == [
        "New York", "New_York",
    ]
