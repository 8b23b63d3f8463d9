import pytest
from pyspark.sql import Observation, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import profile
from tripleloom.sources import authority, tabular, triples_io
from tripleloom.sources.constants import constant_rows, constant_triples

ROWS = [
    ("http://x/s", "http://x/p", "plain", "lit", t.XSD_STRING, ""),
    ("http://x/s", "http://x/p", 'q"uo\\te\nline\rtab\t\x01end \\n', "lit", t.XSD_STRING, ""),
    ("http://x/s", "http://x/p", "été", "lit", "", "fr-CA"),
    ("http://x/s", "http://x/p", "5", "lit", t.XSD_INTEGER, ""),
    ("http://x/s", "http://x/p", 'a"@en', "lit", t.XSD_STRING, ""),
    ("http://x/s", "http://x/p", "", "lit", t.XSD_STRING, ""),
    ("_:b1", "http://x/q", "_:b2", "bnode", "", ""),
    ("http://x/s", "http://x/q", "http://x/o", "iri", "", ""),
    ("http://x/s", "http://x/q", "long " * 20000 + '"' * 3000, "lit", t.XSD_STRING, ""),
]


def test_text_round_trip(spark, tmp_path):
    triples = constant_triples(spark, ROWS)
    triples_io.write_ntriples(triples, str(tmp_path / "nt"))
    back = triples_io.read_ntriples(spark, str(tmp_path / "nt"))
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)
    both = triples_io.load_graph(spark, [str(tmp_path / "nt"), str(tmp_path / "nt")])
    assert both.count() == len(ROWS)
    kept = triples_io.read_graphs(spark, {"a": str(tmp_path / "nt"), "b": str(tmp_path / "nt")})
    assert kept.count() == 2 * len(ROWS)
    assert profile.file_sizes(spark, str(tmp_path / "nt")).agg(F.sum("bytes")).first()[0] > 100000


def test_foreign_lines(spark):
    lines = ['# note', '', '  <a>\t<b>  "x\\u00e9\\t"@en .  # end', '_:n.1 <b> _:m .', '<a><b><c>.', '<a> <b> "1"^^<d>.']
    got = triples_io.from_lines(constant_rows(spark, {"value": "string"}, [(x,) for x in lines])).collect()
    assert [tuple(r) for r in got] == [
        ("a", "b", "xé\t", "lit", "", "en"), ("_:n.1", "b", "_:m", "bnode", "", ""), ("a", "b", "c", "iri", "", ""),
        ("a", "b", "1", "lit", "d", "")]
    for wrong in ("<a> <b> .", "<a> <b> \"x\" ", "a b c ."):
        with pytest.raises(Exception, match="not an N-Triples line"):
            triples_io.from_lines(constant_rows(spark, {"value": "string"}, [(wrong,)])).collect()


def test_escapes_of_any_plane(spark):
    lines = ['<a> <b> "x\\U0001F600y\\U00000041 \\\\U0001F600 \\u00e9 \\U0010FFFF" .', "<a\\u0062> <b> <c> ."]
    got = triples_io.from_lines(constant_rows(spark, {"value": "string"}, [(x,) for x in lines])).collect()
    assert [(r["s"], r["o"]) for r in got] == [("a", "x\U0001F600yA \\U0001F600 é \U0010FFFF"), ("ab", "c")]
    for wrong in (r'<a> <b> "\u12 " .', r'<a> <b> "\q" .', r'<a> <b> "\U00110000" .'):
        with pytest.raises(Exception, match="N-Triples"):
            triples_io.from_lines(constant_rows(spark, {"value": "string"}, [(wrong,)])).collect()


def test_place_in_the_input_and_many_tasks(spark, tmp_path):
    """Rows are numbered by file name and place, whatever order Spark reads the files in."""
    folder = tmp_path / "in"
    folder.mkdir()
    for name, n in (("a.csv", 3), ("b.csv", 500), ("c.csv", 40)):
        (folder / name).write_text("k,v\n" + "".join(f"{name}{i:04},\n" for i in range(n)))
    expected = [f"{name}{i:04}" for name, n in (("a.csv", 3), ("b.csv", 500), ("c.csv", 40)) for i in range(n)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        for line_breaks in (True, False):
            rows = tabular.read_csv(spark, str(folder), ordinal=True, line_breaks=line_breaks)
            assert [(r["k"], r["v"]) for r in rows.orderBy("ordinal").collect()] == [(k, "") for k in expected]
            assert (rows.rdd.getNumPartitions() > 4) == (not line_breaks)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_table_prunes_by_predicate(spark, tmp_path):
    triples_io.write_table(constant_triples(spark, ROWS), str(tmp_path / "table"))
    stored = triples_io.read_table(spark, str(tmp_path / "table"))
    assert sorted(map(tuple, stored.triples().collect())) == sorted(ROWS)
    one = stored.match("http://x/q")
    assert one.count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_result_table_and_report(spark, tmp_path):
    rows = constant_rows(spark, {"a": "string", "n": "long"}, [("x", 1), (None, None)])
    assert sorted(map(tuple, tabular.result_table(rows).collect())) == [("", ""), ("x", "1")]
    report = constant_rows(spark, dict.fromkeys(["kind", "uri", "label", "wikidata", "dbpedia"], "string"),
                           [("movie", "u", 'l "q", x', "", "d")])
    tabular.write_csv(report, str(tmp_path / "report"))
    assert [tuple(r) for r in tabular.read_link_report(spark, str(tmp_path / "report")).collect()] == [
        ("movie", "u", 'l "q", x', "", "d")]


def test_authority_filters_reach_the_scan(spark, tmp_path):
    rows = [("i1", "P4985", "1", None), ("i2", "P9", "1", "a")]
    constant_rows(spark, dict.fromkeys(["item", "id_property", "id_value", "article"], "string"), rows).write.parquet(
        str(tmp_path / "items"))
    read = authority.read_items(spark, str(tmp_path / "items"), ["P4985"])
    assert [r["item"] for r in read.collect()] == ["i1"]
    assert "PushedFilters: [In(id_property" in read._jdf.queryExecution().executedPlan().toString() or (
        "EqualTo(id_property" in read._jdf.queryExecution().executedPlan().toString())


def test_compressed_text_takes_little_disk(spark, tmp_path):
    rows = [(f"http://x/s{i}", "http://x/p", f"http://x/o{i % 7}", "iri", "", "") for i in range(20000)]
    triples = constant_triples(spark, rows).repartition(4)
    told = Observation()
    triples_io.write_ntriples(triples, str(tmp_path / "nt"), told, "gzip")
    lines = sum(len(f"<{s}> <{p}> <{o}> .\n") for s, p, o, *_ in rows)
    assert told.get == {"triples": len(rows), "bytes": lines}
    assert sorted(map(tuple, triples_io.read_ntriples(spark, str(tmp_path / "nt")).collect())) == sorted(rows)
    assert profile.file_sizes(spark, str(tmp_path / "nt")).agg(F.sum("bytes")).first()[0] * 5 < lines
