import pytest
from pyspark.sql import functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import patterns as q
from tripleloom.operators.lift import StoredGraph
from tripleloom.sources.constants import constant_triples
from tripleloom.plans.catalog import named_queries
from tripleloom.session import cut_lineage
from tripleloom.sources.driver_views import DriverViews

S = t.XSD_STRING
ROWS = [
    ("m1", "title", "A", "lit", S, ""), ("m1", "title", "A", "lit", "", "en"), ("m2", "title", "B", "lit", S, ""),
    ("m1", "by", "p1", "iri", "", ""), ("m2", "by", "p2", "iri", "", ""), ("m3", "by", "p1", "iri", "", ""),
    ("p1", "name", "A", "lit", S, ""), ("p2", "name", "Z", "lit", S, ""), ("m1", "by", "p1", "lit", S, ""),
    ("m1", "part", "_:b1", "bnode", "", ""), ("_:b1", "name", "inner", "lit", S, ""), ("m2", "self", "m2", "iri", "", ""),
]


@pytest.fixture(scope="module")
def graph(spark):
    return StoredGraph(constant_triples(spark, ROWS))


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_terms_are_equal_only_as_a_whole(graph):
    assert rows(q.bgp(graph, [("?m", "title", t.text("A"))]), "m") == [("m1",)]
    assert rows(q.bgp(graph, [("?m", "title", t.tagged("A", "en"))]), "m") == [("m1",)]
    assert rows(q.bgp(graph, [("?m", "title", t.tagged("A", "fr"))]), "m") == []
    both = q.bgp(graph, [("?m", "title", "?x"), ("?p", "name", "?x"), ("?m", "by", "?p")])
    assert rows(both, "m", "p", "x", "x__lang") == [("m1", "p1", "A", "")]


def test_a_literal_is_no_resource(graph):
    assert rows(q.bgp(graph, [("?m", "by", "?p"), ("?p", "name", "?n")]), "m", "n") == [("m1", "A"), ("m2", "Z"), ("m3", "A")]


def test_variable_predicate_and_repeated_variable(graph):
    assert rows(q.bgp(graph, [("m2", "?p", "?o")]), "p") == [("by",), ("self",), ("title",)]
    assert rows(q.bgp(graph, [("?x", "self", "?x")]), "x") == [("m2",)]


def test_optional_keeps_rows_and_filters_inside(graph):
    movies = q.bgp(graph, [("?m", "by", "?p")], {"?p"})
    titles = q.bgp(graph, [("?m", "title", "?t")])
    found = {(r["m"], r["t"]) for r in q.optional(movies, titles.where("t__lang = 'en'")).collect()}
    assert found == {("m1", "A"), ("m2", None), ("m3", None)}


def test_negation_union_and_forms(graph):
    movies, titled = q.bgp(graph, [("?m", "by", "?p")], {"?p"}), q.bgp(graph, [("?m", "title", "?t")])
    assert rows(q.not_exists(movies, titled), "m") == [("m3",)]
    assert rows(q.exists(movies, titled), "m") == [("m1",), ("m2",)]
    either = q.alternative(movies.select("m"), titled.select("m", "t"))
    assert either.count() == 6
    assert q.ask(movies).first()[0] is True
    assert q.ask(movies.where("m = 'none'")).first()[0] is False
    made = q.construct(q.optional(movies, titled), [(F.col("m"), "called", t.text(F.col("t")))])
    assert rows(made, "s", "o") == [("m1", "A"), ("m2", "B")]
    assert {(r["s"], r["p"]) for r in q.describe(graph, "m1").collect()} == {
        ("m1", "title"), ("m1", "by"), ("m1", "part"), ("_:b1", "name")}
    with pytest.raises(ValueError):
        q.bgp(graph, [("?a", "by", "?b"), ("?c", "title", "?d")])


def test_terms_meet_resources_only_as_resources(spark):
    rows_ = [("a", "says", "x", "lit", S, ""), ("b", "says", "x", "iri", "", ""), ("x", "name", "X", "lit", S, "")]
    g = StoredGraph(constant_triples(spark, rows_))
    said, named = q.bgp(g, [("?m", "says", "?v")]), q.bgp(g, [("?v", "name", "?n")])
    assert rows(q.optional(said, named), "m", "n") == [("a", None), ("b", "X")]
    assert rows(q.exists(said, named), "m") == [("b",)] and rows(q.not_exists(said, named), "m") == [("a",)]
    assert rows(q.optional(named, said), "v", "m") == [("x", "b")]


def test_groups_without_shared_variables(graph):
    movies, none = q.bgp(graph, [("?m", "by", "?p")], {"?p"}), q.bgp(graph, [("?x", "nothing", "?y")])
    names = q.bgp(graph, [("?q", "name", "?n")])
    assert q.exists(movies, names).count() == q.not_exists(movies, none).count() == movies.count()
    assert q.exists(movies, none).count() == q.not_exists(movies, names).count() == 0
    with pytest.raises(ValueError):
        q.optional(movies, names)


def test_constant_patterns_are_conditions(graph):
    assert q.ask(q.bgp(graph, [("m1", "by", "p1")])).first()[0] is True
    assert q.ask(q.bgp(graph, [("m1", "by", "p2")])).first()[0] is False
    both = [("?m", "title", "?t"), ("m1", "by", "p1")]
    assert q.bgp(graph, both).count() == 3
    assert q.bgp(graph, [("?m", "title", "?t"), ("m1", "by", "p2")]).count() == 0
    assert q.ask(q.bgp(graph, [("m1", "by", "p1"), ("m2", "by", "p2")])).first()[0] is True


def test_a_constant_subject_reaches_the_scan(spark, tiny):
    views = DriverViews(spark, tiny)
    plan = q.describe(views.graph, t.RES + "movie/42")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert 0 < len(scans) <= 14 and any("EqualTo(o_orderkey,42)" in line for line in scans)
    assert all("EqualTo(" in line for line in scans if "o_orderkey" in line or "l_orderkey" in line)
    for strange in (t.RES + "movie/042", t.RES + "movie/x", "http://elsewhere/1"):
        assert q.describe(views.graph, strange).count() == 0
    assert q.describe(views.graph, t.RES + "person/9").count() >= 3


def test_patterns_about_one_row_are_one_projection(spark, tiny):
    """The same solutions as over the stored triples, where every pattern is a scan."""
    views = DriverViews(spark, tiny)
    stored = StoredGraph(cut_lineage(views.graph.triples()))
    film = [("?m", t.TYPE, t.MOVIE), ("?m", t.TITLE, "?title"), ("?m", t.YEAR, "?year")]
    role = [("?r", t.PLAYED_BY, "?a"), ("?r", t.BILLING, t.integer(1)), ("?r", t.CHARACTER, "?c")]
    for patterns in (
        film, role, film + [("?m", t.HAS_ROLE, "?r")] + role, film + [("?m", t.GENRE, t.ONT + "genre_1_urgent")],
        role + [("?r", t.ROLE_IN, "?m"), ("?m", t.DIRECTOR, "?a")], [("?m", t.TITLE, "?x"), ("?m", t.YEAR, "?x")],
        [("?r", t.PLAYED_BY, "?a"), ("?r", t.ROLE_IN, "?m"), ("?a", t.NAME, "?n"), ("?r", t.LABEL, t.tagged("no", "en"))],
        [("?m", t.TITLE, t.text("Order 42")), ("?m", t.TYPE, t.PERSON)], [("?m", t.TITLE, "?v"), ("?m", t.DIRECTOR, "?v")],
    ):
        mine, plain = q.bgp(views.graph, patterns), q.bgp(stored, patterns)
        assert sorted(mine.columns) == sorted(plain.columns)
        assert mine.exceptAll(plain.select(mine.columns)).count() == 0 and mine.count() == plain.count(), patterns
    groups, rest = q.stars(views.graph, film + role + [("?m", t.HAS_ROLE, "?r"), ("?a", t.NAME, "?n")])
    assert [len(g) for g in groups] == [3, 3] and [p for _, p, _ in rest] == [t.HAS_ROLE, t.NAME]
    assert q.stars(stored, film) == ([], film)
    plan = named_queries()["bgp_star"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("orders.parquet") == 1 and "Exchange hashpartitioning" not in plan


def test_a_year_reaches_the_scan_as_a_range_of_dates(spark, tiny):
    plan = DriverViews(spark, tiny).movie(after=1995, until=1996)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
