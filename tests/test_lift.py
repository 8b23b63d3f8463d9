import pytest

from tripleloom.functions import terms as t
from tripleloom.operators import lift
from tripleloom.operators.lift import MappedGraph
from tripleloom.sources.constants import constant_rows

COLUMNS = ["id", "title", "year", "director_id", "director_name", "genre", "studio", "country",
           "cast_ids", "cast_names", "cast_characters"]
FILMS = [
    ("1", "One", "1999", "5", "Dee", "Action", "Warner Bros.", "Land", "7|8|7|7", "G|H|G|G", "a||b|c"),
    ("2", "Two", "2000", "7", "G", "action", None, "", "7", "G", None),
    ("3", "Three", "2001", None, None, "", "Warner Bros", "Land", "", "", ""),
]


def films(spark, rows=FILMS):
    return constant_rows(spark, dict.fromkeys(COLUMNS, "string"), rows)


@pytest.fixture(scope="module")
def graph(spark):
    table = lift.split_cast(films(spark))
    return lift.film_graph(table, lift.cast_rows(table))


def triples(df):
    return {(r["s"], r["p"], r["o"], r["o_lang"]) for r in df.collect()}


def test_roles(spark, graph):
    role = t.RES + "role/"
    roles = {r["s"].removeprefix(role): r["o"] for r in graph.match(t.BILLING).collect()}
    assert roles == {"1-7": "1", "1-8": "2", "1-7-3": "3", "1-7-4": "4", "2-7": "1"}
    labels = {s.removeprefix(role): o for s, p, o, lang in triples(graph.match(t.LABEL)) if s.startswith(role) and lang == "en"}
    assert labels["1-7"] == "G as a in One" and labels["1-8"] == "H in One" and labels["2-7"] == "G in Two"
    assert graph.match(t.CHARACTER).count() == 3
    assert graph.match(t.STARRING).count() == 3


def test_people_and_dimensions(graph):
    types = {(s, o) for s, _, o, _ in triples(graph.match(t.TYPE))}
    person = t.RES + "person/7"
    assert {o for s, o in types if s == person} == {t.PERSON, t.ONT + "Director", t.ONT + "Actor"}
    genre = {(s, o) for s, _, o, _ in triples(graph.match(t.LABEL)) if "genre" in s}
    assert genre == {(t.ONT + "genre_action", "Action"), (t.ONT + "genre_action", "action")}
    assert graph.match(t.STUDIO).select("o").distinct().count() == 1
    assert graph.match(t.DIRECTOR).count() == 2 and graph.match(t.COUNTRY).count() == 2


def test_graph_is_a_set_and_both_paths_agree(spark, graph):
    everything = graph.triples()
    assert everything.count() == everything.distinct().count()
    by_predicate = everything.groupBy("p").count().collect()
    assert {r["p"]: r["count"] for r in by_predicate} == {r["p"]: graph.match(r["p"]).count() for r in by_predicate}
    doubled = lift.split_cast(films(spark, FILMS + FILMS))
    again = lift.film_graph(doubled, lift.cast_rows(doubled))
    assert triples(again.triples()) == triples(everything) and again.triples().count() == everything.count()


def test_misaligned(spark):
    bad = [("4", "Bad", "2000", "", "", "", "", "", "1|2", "a|b", "x"), *FILMS]
    assert [tuple(r) for r in lift.misaligned(films(spark, bad)).collect()] == [("4", 2, 2, 1)]
    with pytest.raises(Exception, match="unequal numbers of cast ids, names and characters, id 4"):
        lift.cast_rows(lift.split_cast(films(spark, bad))).collect()
    lenient = lift.split_cast(films(spark, bad), strict=False)
    assert {r["id"]: r["aligned"] for r in lenient.collect()} == {"1": True, "2": True, "3": True, "4": False}


def test_value_takes_the_smallest(graph):
    rows = {r["s"]: r["o"] for r in lift.value(graph, t.LABEL).collect()}
    assert rows[t.ONT + "genre_action"] == "Action"


def test_award_and_links(spark):
    winners = constant_rows(spark, {"person": "string"}, [("p1",), ("p2",)])
    made = triples(MappedGraph(lift.award_map(winners, "award_x", "X")).triples())
    award = t.ONT + "award_x"
    assert made == {("p1", t.HAS_AWARD, award, ""), ("p2", t.HAS_AWARD, award, ""),
                    (award, t.TYPE, t.ONT + "Award", ""), (award, t.LABEL, "X", "en")}
