"""The closure over bits against the one fact by fact."""

import random

import pytest
from pyspark.sql import functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import closure
from tripleloom.operators.lift import StoredGraph
from tripleloom.operators.marks import _both_ways
from tripleloom.operators.ontology import axioms
from tripleloom.sources.constants import constant_triples

O, R = t.ONT, t.RES


def graph(spark, rows):
    return StoredGraph(constant_triples(spark, [(s, p, o, "lit" if p == t.BILLING or o == "x" else "iri", "", "") for s, p, o in rows]))


@pytest.mark.parametrize("seed", [1, 2])
def test_bits_give_what_facts_give(spark, seed):
    rng = random.Random(seed)
    kinds = [("m", t.DIRECTOR, "p"), ("m", t.HAS_ROLE, "r"), ("r", t.ROLE_IN, "m"), ("r", t.PLAYED_BY, "p"), ("m", t.STARRING, "p"),
             ("m", t.HAS_ROLE, "m"), ("p", t.TYPE, "p")]
    rows = {(f"{R}{a}{rng.randrange(4)}", p, f"{R}{b}{rng.randrange(4)}") for a, p, b in rng.choices(kinds, k=24)}
    rows |= {(R + "p1", t.HAS_AWARD, O + "award"), (R + "p1", t.TYPE, O + "Director"), (R + "m9", t.TYPE, O + "ActionMovie"),
             (R + "m1", t.GENRE, O + "genre_comedy"), (R + "r1", t.PLAYED_BY, "x"), (R + "m1", t.HAS_ROLE, R + "r1")}
    bits, facts = (closure.close(graph(spark, sorted(rows) * 2), axioms(spark), explained=way) for way in (False, True))
    assert bits.bits is not None and facts.bits is None
    added = [tuple(r) for r in bits.new_terms().collect()]
    assert len(added) == len(set(added)) == sum(bits.sizes) and set(added) == {tuple(r) for r in facts.new_terms().collect()}
    types = [tuple(r) for r in bits.types().collect()]
    assert len(types) == len(set(types)) and set(types) == {tuple(r) for r in facts.types().collect()}


def test_an_individual_is_one_row(spark):
    """All classes of an individual are one row, whatever their number."""
    rows = [(R + "m1", t.TYPE, t.MOVIE), (R + "m1", t.GENRE, O + "genre_action"), (R + "m1", t.DIRECTOR, R + "p1"), (R + "p1", t.TYPE, O + "Director")]
    found = closure.close(graph(spark, rows), axioms(spark))
    assert {r["node"] for r in found.members[0].collect()} == {R + "m1", R + "p1", O + "genre_action"} and found.members[0].count() == 3


def test_a_missing_end_ends(spark):
    """Facts whose other end is missing follow from each other, and the rounds end."""
    found = closure.close(StoredGraph(
        constant_triples(spark, [(R + "m1", t.HAS_ROLE, None, "iri", "", ""), (R + "m2", t.HAS_ROLE, R + "r2", "iri", "", "")])), axioms(spark))
    got = sorted((r["s"] or "", r["p"], r["o"] or "") for r in found.facts().collect())
    assert got == [("", t.ROLE_IN, R + "m1"), (R + "r2", t.ROLE_IN, R + "m2")]


def test_inverses_both_ways():
    same, other = _both_ways({("p", "q"), ("q", "p"), ("q", "z")})
    assert other["p"] == {"q"} and same["p"] == {"p", "z"} and other["q"] == {"p", "z"} and same["q"] == {"q"}


def test_equal_names_are_merged_before_facts_are_closed(spark):
    rows = [(R + "r1", t.PLAYED_BY, R + "a"), (R + "r1", t.PLAYED_BY, R + "b"), (R + "m1", t.DIRECTOR, R + "b"), (R + "m1", t.STARRING, R + "b")]
    found = closure.close(graph(spark, rows), axioms(spark), equal=True)
    assert found.named.where(F.col("o") == R + "b").isEmpty()
    assert {(r["s"], r["p"], r["o"]) for r in found.facts().collect()} == {(R + "m1", t.DIRECTOR, R + "a"), (R + "m1", t.STARRING, R + "a")}
