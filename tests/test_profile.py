import dataclasses

import pytest
from pyspark.sql import functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import profile
from tripleloom.operators.lift import MappedGraph, StoredGraph, award_map, union_all
from tripleloom.plans.profile_queries import DESCRIPTION
from tripleloom.session import DEALT_BYTES, PARTITIONS, bounded_reads, bounded_shuffles
from tripleloom.sources.constants import constant_rows, constant_triples
from tripleloom.sources.driver_views import DriverViews

A = [("s1", t.TYPE, t.MOVIE), ("s2", t.TYPE, t.MOVIE), ("s1", t.SAME_AS, t.WD + "Q1"), ("s1", t.SAME_AS, t.DBR + "X"),
     (t.RES + "p", t.TYPE, t.PERSON)]
B = [(t.RES + "p", t.HAS_AWARD, "a"), ("a", t.TYPE, t.ONT + "Award"), ("s1", t.TYPE, t.MOVIE)]


@pytest.fixture(scope="module")
def graphs(spark):
    def of(g, rows):
        return constant_triples(spark, [(*r, "iri", "", "") for r in rows]).withColumn("g", F.lit(g))

    return of("a", A).unionByName(of("b", B))


def test_counts(graphs):
    assert tuple(profile.triple_totals(graphs).first()) == (8, 7)
    row = profile.subject_totals(graphs).first()
    assert (row["subjects_per_file_sum"], row["subjects_merged"]) == (6, 4)
    assert (row["entities_per_file_sum"], row["entities_merged"]) == (2, 1)
    classes = {r["class"]: r["entities"] for r in profile.class_partitions(graphs).collect()}
    assert classes == {t.MOVIE: 3, t.PERSON: 1, t.ONT + "Award": 1}
    properties = {r["property"]: r["triples"] for r in profile.property_partitions(graphs).collect()}
    assert sum(properties.values()) == 8 and properties[t.TYPE] == sum(classes.values())
    links = graphs.where(F.col("p") == t.SAME_AS)
    assert tuple(profile.triple_totals(graphs.limit(0)).first()) == (0, 0)
    assert tuple(profile.subject_totals(graphs.limit(0)).first()) == (0, 0, 0, 0)
    assert {tuple(r) for r in profile.linksets(links).collect()} == {("wikidata.org", 1), ("dbpedia.org", 1)}
    assert {tuple(r) for r in profile.linksets(links.limit(0)).collect()} == {("wikidata.org", 0), ("dbpedia.org", 0)}
    types = graphs.where(F.col("p") == t.TYPE).select("s", F.col("o").alias("class"))
    listed = profile.class_counts(types, [("Movie", t.MOVIE), ("None", "x")])
    assert {tuple(r) for r in listed.collect()} == {("Movie", 2), ("None", 0)}


def test_metadata_graph(spark, graphs):
    sizes = constant_rows(spark, {"g": "string", "bytes": "long"}, [("a", 10)])
    made = profile.metadata(graphs, graphs.where(F.col("p") == t.SAME_AS), sizes, DESCRIPTION)
    rows = made.collect()
    assert len(rows) == len(set(rows)) and all(v is not None for r in rows for v in r)
    said = {(r["s"], r["p"], r["o"]) for r in rows}
    dataset = t.META + "dataset"
    for p, o in (("triples", "8"), ("classes", "3"), ("properties", "3"), ("distinctSubjects", "6"), ("entities", "2")):
        assert (dataset, t.VOID + p, o) in said
    assert (t.META + "file-a", t.DCAT + "byteSize", "10") in said
    assert (t.META + "file-b", t.VOID + "triples", "3") in said
    assert (t.META + "links-dbpedia.org", t.VOID + "triples", "1") in said
    assert any("Graph of 3 movies" in r["o"] for r in rows)
    parts = [r["o"] for r in rows if r["p"] == t.VOID + "classPartition"]
    assert len(set(parts)) == 3 and {(x, t.VOID + "entities") for x in parts} <= {(s, p) for s, p, _ in said}
    assert (dataset, t.DCT + "title", "Orders told as films") in said and (t.META + "run", t.PROV + "used", t.META + "order-tables") in said
    again = profile.kept_created(made, dataclasses.replace(DESCRIPTION), "2026-02-02")
    assert (again.created, again.modified) == ("2026-01-01", "2026-02-02")
    assert DESCRIPTION.modified == "2026-01-01"
    first = profile.kept_created(None, dataclasses.replace(DESCRIPTION), "2026-02-02")
    assert (first.created, first.modified) == ("2026-02-02", "2026-02-02")


def test_counts_without_making_the_triples(spark, tiny):
    """Rules counted on their rows give what counting and merging the triples gives."""
    v = DriverViews(spark, tiny)
    graph = MappedGraph([*v.graph.maps, *award_map(v.people().select(t.mint(t.RES + "person/", F.col("id")).alias("person")), "genre_x", "X")])
    asked = {tuple(r) for r in graph.predicate_counts().collect()}
    assert asked == {tuple(r) for r in graph.triples().groupBy("p").count().collect()}
    own = [(t.ONT + "genre_5_low", t.TYPE, t.ONT + "Genre", "iri", "", ""), (t.ONT + "genre_5_low", t.LABEL, "5-LOW", "lit", "", "en"),
           (t.RES + "movie/42", t.TYPE, t.MOVIE, "iri", "", ""), (t.RES + "movie/42", t.TITLE, "Order 42", "lit", "", "en")]
    two = StoredGraph(constant_triples(spark, own))
    three = StoredGraph(constant_triples(spark, own[2:] + [("x", "only", "y", "iri", "", "")]))
    files = {"graph": graph, "two": two, "three": three}
    spelled = [g.triples().withColumn("g", F.lit(name)) for name, g in files.items()]
    expected = profile.triple_totals(union_all(spelled)).first()
    assert tuple(profile.merged_totals(files).first()) == tuple(expected)
    assert expected["per_file_sum"] - expected["merged"] == 3 + 2
    alone = {"three": three, "none": StoredGraph(constant_triples(spark, []))}
    assert tuple(profile.merged_totals(alone).first()) == (3, 3)
    counted = graph.predicate_counts()._jdf.queryExecution().executedPlan().toString()
    movies = next(line for line in counted.split("\n") if "count_if" in line or "count(if" in line or "partial_count" in line)
    assert "concat(http://kg.example/resource/movie/" not in movies


def test_bundle_has_one_header(spark, graphs):
    header = constant_triples(spark, [(x, t.TYPE, t.OWL + "Ontology", "iri", "", "") for x in ("o1", "o2")])
    made = profile.bundle([graphs.drop("g"), header], "all")
    assert made.count() == 7 + 1
    assert made.where(F.col("o") == t.OWL + "Ontology").first()["s"] == t.ONT + "all"


def test_published_numbers_add_up():
    """Arithmetic over the counts the surveyed dataset publishes."""
    classes = dict(Movie=250, Country=16, Person=672, Genre=17, Actor=522, Studio=99, Director=156, Award=1, CastRole=750)
    assert sum(classes.values()) == 2483
    assert 250 * 6 + 750 * 6 + 672 + 2483 + 1832 + 32 + 883 == 11902
    assert 11902 + 115 - 4 == 12013


def test_bundle_has_no_set_in_the_map_tasks(spark):
    """Triples are dealt out before they are made distinct."""
    rows = [(f"http://x/s{i}", "http://x/p", "o", "lit", "", "en") for i in range(5)]
    made = profile.bundle([constant_triples(spark, rows), constant_triples(spark, rows)], "b")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning"):]
    assert made.count() == 6


def test_bounded_reads(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        for given, held in (("64m", "16m"), ("67108864b", "16m"), ("8m", "8m"), ("1g", "16m"), ("1000", "1000")):
            spark.conf.set(name, given)
            bounded_reads(spark)
            assert spark.conf.get(name) == held
    finally:
        spark.conf.set(name, before)


def test_shuffles_are_dealt_out_by_the_size_of_the_tables(spark, tmp_path):
    spark.range(300_000).selectExpr("uuid() AS x").repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f.is_file())
    before = spark.conf.get(PARTITIONS, None)
    try:
        spark.conf.set(PARTITIONS, "1")
        bounded_shuffles(spark, str(tmp_path))
        assert int(spark.conf.get(PARTITIONS)) == -(-size // DEALT_BYTES) > 1
        spark.conf.set(PARTITIONS, "700")  # a larger number of the session's own stays
        bounded_shuffles(spark, str(tmp_path))
        assert spark.conf.get(PARTITIONS) == "700"
    finally:
        spark.conf.set(PARTITIONS, before) if before else spark.conf.unset(PARTITIONS)


def test_bundle_is_dealt_by_subject(spark):
    """Triples of one subject travel together, and are made distinct where they arrive: one exchange of triples."""
    rows = [(f"http://x/s{i % 3}", f"http://x/p{i % 2}", f"o{i % 4}", "lit", "", "en") for i in range(24)]
    made = profile.bundle([constant_triples(spark, rows), constant_triples(spark, rows[:5])], "b")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(s#" in plan
    dealt = plan[plan.index("Exchange hashpartitioning(") + len("Exchange hashpartitioning("):]
    assert "p#" not in dealt[:dealt.index(")")]
    assert {tuple(r) for r in made.collect()} == {*rows, (t.ONT + "b", t.TYPE, t.OWL + "Ontology", "iri", "", "")} and made.count() == 13
