import random

import pytest

from tripleloom.functions import terms as t
from tripleloom.operators import closure, inference, upkeep
from tripleloom.operators.lift import StoredGraph
from tripleloom.operators.ontology import axioms
from tripleloom.sources.constants import constant_triples

O, R = t.ONT, t.RES


def triples(spark, rows):
    return constant_triples(spark, [(s, p, o, "lit" if p == t.BILLING else "iri", "", "") for s, p, o in rows])


def said(found):
    """Memberships and other added facts; no fact is both given and added, or added twice."""
    added = [tuple(r) for r in found.added().select(t.TERM).collect()]
    assert len(added) == len(set(added)) and not {tuple(r) for r in found.base.select(t.TERM).collect()} & set(added)
    return {tuple(r) for r in found.types().collect()}, {tuple(r) for r in found.facts().collect()}


def random_rows(rng, n):
    kinds = [("m", t.DIRECTOR, "p"), ("m", t.HAS_ROLE, "r"), ("r", t.ROLE_IN, "m"), ("r", t.PLAYED_BY, "p"), ("m", t.STARRING, "p")]
    rows = {(f"{R}{a}{rng.randrange(4)}", p, f"{R}{b}{rng.randrange(4)}") for a, p, b in rng.choices(kinds, k=n)}
    rows |= {(f"{R}p{rng.randrange(4)}", t.HAS_AWARD, O + "award") for _ in range(2)}
    rows |= {(f"{R}m{rng.randrange(4)}", t.GENRE, O + rng.choice(["genre_action", "genre_comedy"])) for _ in range(2)}
    rows |= {(f"{R}m{rng.randrange(4)}", t.TYPE, O + rng.choice(["ActionMovie", "ComedyMovie", "Movie"])) for _ in range(2)}
    return sorted(rows | {(f"{R}p{rng.randrange(4)}", t.TYPE, O + "Director"), (f"{R}r0", t.BILLING, "1")})


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_give_what_closing_again_gives(spark, seed):
    rng = random.Random(seed)
    rows, ax = random_rows(rng, 16), axioms(spark)
    rng.shuffle(rows)
    at = len(rows) * 2 // 3
    whole, part = (closure.close(StoredGraph(triples(spark, r)), ax) for r in (rows, rows[:at]))
    more = upkeep.extended(part, triples(spark, rows[at:] + rows[:2]), ax)
    assert said(more) == said(whole)
    assert said(upkeep.without(more, triples(spark, rows[at:] + [(R + "x", t.DIRECTOR, R + "y")]), ax)) == said(part)
    less = upkeep.without(whole, triples(spark, rows[at:]), ax)
    assert said(less) == said(part)


def test_given_and_derived(spark):
    """A derived fact that is given as well stays when its reason goes, and a given one that follows from others comes back."""
    ax = axioms(spark)
    role, back = (R + "m", t.HAS_ROLE, R + "r"), (R + "r", t.ROLE_IN, R + "m")
    found = closure.close(StoredGraph(triples(spark, [role])), ax)
    both = upkeep.extended(found, triples(spark, [back]), ax)
    assert {r["p"] for r in both.facts().collect()} == set()
    kept = upkeep.without(both, triples(spark, [role]), ax)
    assert {(r["s"], r["p"], r["o"]) for r in kept.facts().collect()} == {role}
    # nothing holds a circle of facts that only follow from each other
    none = upkeep.without(kept, triples(spark, [back]), ax)
    assert none.facts().isEmpty() and none.types().isEmpty()


def test_a_bad_record_comes_and_goes(spark):
    ax = axioms(spark)
    rows = [(R + "m", t.TYPE, t.MOVIE), (R + "m", t.GENRE, O + "genre_action")]
    bad = triples(spark, [(R + "bad", t.GENRE, O + "genre_action"), (R + "bad", t.GENRE, O + "genre_comedy")])
    found = closure.close(StoredGraph(triples(spark, rows)), ax)
    more = upkeep.extended(found, bad, ax, explained=True)
    assert [r["s"] for r in inference.disjoint_clashes(more.types(), ax).collect()] == [R + "bad"]
    assert said(upkeep.without(more, bad, ax)) == said(found)
    assert said(upkeep.extended(found, bad.limit(0), ax)) == said(found) == said(upkeep.without(found, bad, ax))


def test_merged_names_are_an_error(spark):
    ax = axioms(spark)
    rows = triples(spark, [(R + "r", t.PLAYED_BY, R + "a"), (R + "r", t.PLAYED_BY, R + "b")])
    found = closure.close(StoredGraph(rows), ax, equal=True)
    with pytest.raises(ValueError, match="merged names"):
        upkeep.without(found, rows, ax)
