import random

import pytest
from pyspark.sql import functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import closure, inference, ontology
from tripleloom.operators.joins import hashed_join, regroup, set_difference_counts
from tripleloom.operators.lift import StoredGraph
from tripleloom.operators.ontology import AXIOMS, axioms, class_closure, ontology_triples
from tripleloom.session import shared_folder
from tripleloom.sources.constants import constant_rows, constant_triples

O, R = t.ONT, t.RES


def graph(spark, rows):
    full = [(s, p, o, "lit" if p in (t.BILLING, t.YEAR) else "iri", "", "") for s, p, o in rows]
    return StoredGraph(constant_triples(spark, full))


FACTS = [
    (R + "m1", t.TYPE, t.MOVIE), (R + "m1", t.GENRE, O + "genre_action"), (R + "m1", t.DIRECTOR, R + "p1"),
    (R + "m1", t.HAS_ROLE, R + "r1"), (R + "r1", t.PLAYED_BY, R + "p1"), (R + "p1", t.HAS_AWARD, O + "award"),
    (R + "p2", t.HAS_AWARD, O + "award"), (R + "m2", t.TYPE, O + "ComedyMovie"), (R + "r2", t.ROLE_IN, R + "m2"),
    (R + "r2", t.PLAYED_BY, R + "p3"), (R + "m2", t.DIRECTOR, R + "p4"), (R + "m1", t.YEAR, "1999"),
]


def types_of(types):
    out = {}
    for r in types.collect():
        out.setdefault(r["s"].removeprefix(R), set()).add(r["class"].removeprefix(O))
    return out


def test_materialise_reaches_the_fixpoint(spark):
    types, facts = closure.materialise(graph(spark, FACTS), axioms(spark))
    got = types_of(types)
    assert got["m1"] == {"Movie", t.MOVIE, "ActionMovie"}
    assert got["m2"] == {"Movie", t.MOVIE, "ComedyMovie"}
    assert got["p1"] == {"Person", t.PERSON, "Director", "Actor", "ActorDirector", "AwardWinningDirector"}
    assert got["p2"] == {"Person", t.PERSON}
    assert got["p3"] == {"Person", t.PERSON, "Actor"} and got["p4"] == {"Person", t.PERSON, "Director"}
    assert got["r1"] == got["r2"] == {"CastRole"}
    assert got[O + "award"] == {"Award"} and got[O + "genre_comedy"] == {"Genre"}
    added = {(r["s"], r["p"], r["o"]) for r in facts.collect()}
    assert added == {
        (R + "r1", t.ROLE_IN, R + "m1"), (R + "m1", t.STARRING, R + "p1"), (R + "m2", t.HAS_ROLE, R + "r2"),
        (R + "m2", t.STARRING, R + "p3"), (R + "m2", t.GENRE, O + "genre_comedy")}
    again, none = closure.materialise(graph(spark, FACTS + sorted(added)), axioms(spark))
    assert types_of(again) == got and none.isEmpty()


def test_bad_record_is_explained(spark):
    ax = axioms(spark)
    bad = [(R + "bad", t.GENRE, O + "genre_action"), (R + "bad", t.GENRE, O + "genre_comedy")]
    for rows, expected in ((FACTS, []), (FACTS + bad, [(R + "bad", O + "ComedyMovie", O + "ActionMovie")])):
        types = inference.has_value_members(graph(spark, rows).match(t.GENRE), ax)
        assert [tuple(r) for r in inference.disjoint_clashes(types, ax).collect()] == expected


def test_functional(spark):
    ax = axioms(spark)
    g = graph(spark, [("r", t.PLAYED_BY, x) for x in "abc"] + [("q", t.PLAYED_BY, "a"), ("r", t.BILLING, "1"),
                                                             ("r", t.BILLING, "2"), ("q", t.BILLING, "1")])
    assert {(r["s"], r["o"]) for r in inference.functional_same(g, ax).collect()} == {("a", "b"), ("a", "c")}
    assert [tuple(r) for r in inference.functional_clashes(g, ax).collect()] == [("r", t.BILLING, 2)]


def test_ontology(spark):
    ax = axioms(spark)
    made = ontology_triples(ax)
    assert made.count() == made.distinct().count() == 115
    reach = {(r["class"], r["super"]) for r in class_closure(ax).collect()}
    assert (O + "AwardWinningDirector", t.PERSON) in reach and (t.MOVIE, O + "Movie") in reach
    assert (O + "Person", O + "Director") not in reach


@pytest.mark.parametrize("seed", [1, 2])
def test_alias_clusters_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{a:03}", f"n{b:03}") for a, b in ((rng.randrange(120), rng.randrange(120)) for _ in range(80))]
    edges += [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)] + [("hub", f"leaf{i}") for i in range(50)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    links = constant_rows(spark, {"s": "string", "o": "string"}, edges)
    got = {r["node"]: r["cluster"] for r in inference.alias_clusters(links).collect()}
    groups = {}
    for x in list(parent):
        groups.setdefault(root(x), []).append(x)
    assert got == {x: min(g) for g in groups.values() for x in g}


def test_alias_counts(spark):
    members = constant_rows(spark, {"class": "string", "s": "string"}, [("A", "x"), ("A", "y"), ("B", "x"), ("A", "z")])
    clusters = constant_rows(spark, {"node": "string", "cluster": "string"},
                             [("x", "q"), ("q", "q"), ("w", "q"), ("y", "u"), ("u", "u")])
    got = {tuple(r) for r in inference.alias_counts(members, clusters).select("class", "members", "with_aliases").collect()}
    assert got == {("A", 3, 6), ("B", 1, 3)}


def test_differences_both_ways(spark):
    def pairs(rows):
        return constant_rows(spark, {"s": "string", "o": "string"}, rows)

    row = set_difference_counts(pairs([("a", "b"), ("c", "d"), ("x", "y")]), pairs([("a", "b"), ("n", "m")]), "l", "r").first()
    assert (row["l"], row["r"]) == (2, 1)


def test_hot_key_is_split_at_run_time(spark):
    """A key with a third of the rows joins a grouped table in several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id")
        grouped = rows.groupBy("k").agg({"id": "min"})
        joined = rows.join(regroup(grouped, ["k"]), "k")
        assert joined.count() == 60000
        joined.write.format("noop").mode("overwrite").save()
        plan = joined._jdf.queryExecution()
        joined.collect()
        assert "skew=true" in plan.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_rules_feed_each_other(spark):
    """An inverse fact completes a chain, the chain a class, and all of these facts are returned."""
    facts = [(R + "r1", t.ROLE_IN, R + "m1"), (R + "r1", t.PLAYED_BY, R + "p1"), (R + "m1", t.DIRECTOR, R + "p1")]
    types, added = closure.materialise(graph(spark, facts), axioms(spark))
    assert "ActorDirector" in types_of(types)["p1"]
    assert {(r["s"], r["p"], r["o"]) for r in added.collect()} == {
        (R + "m1", t.HAS_ROLE, R + "r1"), (R + "m1", t.STARRING, R + "p1")}


@pytest.mark.parametrize("kind", ["inverse", "some values", "has value", "chain", "both ends", "functional", "disjoint"])
def test_absent_axiom_kinds(spark, kind):
    ax = axioms(spark).where(f"kind <> '{kind}'")
    g = graph(spark, FACTS)
    types, _ = closure.materialise(g, ax)
    assert "Movie" in types_of(types)["m1"]
    for rows in (inference.functional_same(g, ax), inference.functional_clashes(g, ax), inference.disjoint_clashes(types, ax)):
        assert rows.count() >= 0


def test_classes_over_defined_classes(spark):
    """A class defined over another defined class, and more rounds than any fixed number."""
    rows = [("some values", f"{O}C{i + 1}", f"{O}next", f"{O}C{i}", []) for i in range(12)]
    rows += [("subclass", f"{O}C0", None, f"{O}Base", None)]
    ax = constant_rows(spark, AXIOMS, rows)
    chain = [(R + "x0", t.TYPE, O + "C0")] + [(R + f"x{i + 1}", O + "next", R + f"x{i}") for i in range(12)]
    types, _ = closure.materialise(graph(spark, chain), ax)
    got = types_of(types)
    assert got["x0"] == {"C0", "Base"} and all(got[f"x{i}"] == {f"C{i}"} for i in range(1, 13))


def test_a_cluster_without_shared_folder_is_an_error(spark):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)


def test_values_of_a_functional_property_are_one_individual(spark):
    """Two players of one role are one person, who then directs and stars; the smaller name stands for both."""
    facts = [(R + "r1", t.PLAYED_BY, R + "a"), (R + "r1", t.PLAYED_BY, R + "b"), (R + "m1", t.DIRECTOR, R + "a"), (R + "m1", t.STARRING, R + "b")]
    apart = types_of(closure.close(graph(spark, facts), axioms(spark)).types())
    assert "ActorDirector" not in apart["a"] | apart["b"]
    found = closure.close(graph(spark, facts), axioms(spark), equal=True)
    got = types_of(found.types())
    assert got["a"] == {"Person", t.PERSON, "Director", "Actor", "ActorDirector"} and "b" not in got
    assert {tuple(r) for r in found.clusters.collect()} == {(R + "a", R + "a"), (R + "b", R + "a")}
    assert (R + "m1", t.STARRING, R + "a") in {(r["s"], r["p"], r["o"]) for r in found.facts().collect()}


def test_a_merge_leads_to_the_next_one(spark):
    """r1 and r2 are one role once their movies' names are, and then their players are one person."""
    facts = [(R + "q", t.ROLE_IN, R + "m1"), (R + "q", t.ROLE_IN, R + "m2"), (R + "m2", t.PLAYED_BY, R + "x"), (R + "m1", t.PLAYED_BY, R + "y"),
             (R + "z", t.SAME_AS, R + "x"), (R + "m0", t.DIRECTOR, R + "z"), (R + "m0", t.STARRING, R + "y")]
    found = closure.close(graph(spark, facts), axioms(spark), equal=True)
    assert {tuple(r) for r in found.clusters.collect()} == {
        (R + "m1", R + "m1"), (R + "m2", R + "m1"), (R + "x", R + "x"), (R + "y", R + "x"), (R + "z", R + "x")}
    assert "ActorDirector" in types_of(found.types())["x"]


def test_a_clash_across_names(spark):
    """Each name alone is in one of two disjoint classes."""
    facts = [(R + "r", t.ROLE_IN, R + "m1"), (R + "r", t.ROLE_IN, R + "m2"),
             (R + "m1", t.GENRE, O + "genre_action"), (R + "m2", t.GENRE, O + "genre_comedy")]
    ax = axioms(spark)
    assert inference.disjoint_clashes(closure.close(graph(spark, facts), ax).types(), ax).isEmpty()
    clashes = inference.disjoint_clashes(closure.close(graph(spark, facts), ax, equal=True).types(), ax)
    assert [tuple(r) for r in clashes.collect()] == [(R + "m1", O + "ComedyMovie", O + "ActionMovie")]


def slow_equal(facts, functional, chain, ends):
    """Equality, chain, both-ends membership by sets alone."""
    facts, parent, members = set(facts), {}, set()

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    while True:
        facts = {(root(s), p, root(o)) for s, p, o in facts}
        members = {root(x) for x in members}
        before = (set(facts), dict(parent), set(members))
        for s, p, o in list(facts):
            for s2, p2, o2 in list(facts):
                if (s, p) == (s2, p2) and p in functional and root(o) != root(o2):
                    low, high = sorted((root(o), root(o2)))
                    parent[high] = low
                if (p, p2) == chain[1:] and o == s2:
                    facts.add((s, chain[0], o2))
                if (p, p2) == ends and (s, o) == (s2, o2):
                    members.add(o)
        if (facts, parent, members) == before:
            return members, {x: root(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equality_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = {(f"{R}{a}{rng.randrange(9)}", p, f"{R}{b}{rng.randrange(9)}") for _ in range(14) for a, p, b in (
        ("m", t.HAS_ROLE, "r"), ("r", t.PLAYED_BY, "p"), ("m", t.DIRECTOR, "p"))}
    ax = axioms(spark).where("kind IN ('functional', 'chain', 'both ends', 'object property')")
    found = closure.close(graph(spark, sorted(rows)), ax, equal=True)
    members, names = slow_equal(rows, {t.ROLE_IN, t.PLAYED_BY}, (t.STARRING, t.HAS_ROLE, t.PLAYED_BY), (t.DIRECTOR, t.STARRING))
    got = found.types().where(F.col("class") == O + "ActorDirector").collect()
    assert {r["s"] for r in got} == members
    assert {r["node"]: r["cluster"] for r in found.clusters.where("node <> cluster").collect()} == {x: y for x, y in names.items() if x != y}


def test_rounds_read_what_the_last_one_added(spark):
    found = closure.close(graph(spark, FACTS), axioms(spark))
    assert len(found.sizes) >= 3 and found.sizes == sorted(found.sizes, reverse=True)
    given = {tuple(r) for r in graph(spark, FACTS).triples().collect()}
    added = [tuple(r)[:6] for r in found.added().collect()]
    assert len(added) == len(set(added)) == sum(found.sizes) and not given & set(added)


def test_derivations_lead_to_given_triples(spark):
    facts = [(R + "r1", t.ROLE_IN, R + "m1"), (R + "r1", t.PLAYED_BY, R + "p1"), (R + "m1", t.DIRECTOR, R + "p1"), (R + "m9", t.GENRE, O + "g")]
    found = closure.close(graph(spark, facts), axioms(spark), explained=True)
    asked = constant_rows(spark, dict.fromkeys(["of", "s", "p", "o"], "string"), [
        ("both", R + "p1", t.TYPE, O + "ActorDirector"), ("inverse", R + "m1", t.HAS_ROLE, R + "r1"),
        ("given", R + "m9", t.GENRE, O + "g"), ("above", R + "p1", t.TYPE, t.PERSON)])
    got = {}
    for r in found.explain(asked).collect():
        got.setdefault(r["of"], set()).add((r["s"], r["p"], r["o"]))
    above = got.pop("above")
    assert got == {"both": set(facts[:3]), "inverse": {facts[0]}, "given": {facts[3]}} and len(above) >= 1 and above <= set(facts)
    one = {(r["s"], r["p"], r["o"]): (r["rule"], len(r["premises"])) for r in found.added().collect()}
    assert one[(R + "m1", t.STARRING, R + "p1")] == ("chain", 2) and one[(R + "m1", t.HAS_ROLE, R + "r1")] == ("inverse", 1)


def test_a_long_chain_of_classes_closes_as_joins(spark):
    rows = spark.range(2000).selectExpr(
        "'subclass' AS kind", f"concat('{O}C', id) AS subject", "CAST(NULL AS STRING) AS property",
        f"concat('{O}C', id + 1) AS object", "CAST(NULL AS ARRAY<STRING>) AS members")
    reach = class_closure(rows)
    assert reach.count() == 2001 * 2002 // 2
    assert reach.where(F.col("class") == O + "C0").count() == 2001


def test_joins_close_classes_as_the_driver_does(spark, monkeypatch):
    one = {tuple(r) for r in class_closure(axioms(spark)).collect()}
    monkeypatch.setattr(ontology, "SMALL", 0)
    assert {tuple(r) for r in class_closure(axioms(spark)).collect()} == one


def test_keys_of_names_sort_by_their_hash(spark):
    """The joins of aliases are led by a hash, and equal hashes alone join nothing."""
    left = constant_rows(spark, {"node": "string", "a": "long"}, [(R + "x", 1), (R + "y", 2), (None, 3)])
    right = constant_rows(spark, {"node": "string", "b": "long"}, [(R + "x", 4), (R + "x", 5), (None, 6)])
    assert sorted(map(tuple, hashed_join(left, right, ["node"]).collect())) == [(R + "x", 1, 4), (R + "x", 1, 5)]
    plan = hashed_join(left, right.hint("merge"), ["node"])._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_hash#" in plan


def test_new_facts_are_found_without_a_sort_by_names(spark):
    fact = lambda s, o: (s, t.STARRING, o, "iri", "", "")
    old = constant_triples(spark, [fact("m1", "p1"), fact("m2", None)])
    derived = constant_triples(spark, [fact("m1", "p1"), fact("m1", "p2"), fact("m1", "p2"), fact("m2", None)])
    why = derived.withColumns({"rule": F.lit("chain"), "premises": F.array().cast(closure.PREMISES)})
    new = closure.unseen(why, old, False)
    # a fact with a null equals none
    assert sorted((r["s"], r["o"] or "") for r in new.collect()) == [("m1", "p2"), ("m2", "")]
    assert "SortMergeJoin" not in new._jdf.queryExecution().toString() and "Sort [" not in new._jdf.queryExecution().toString()
    with_rule = closure.unseen(why, old, True).collect()
    assert sorted((r["s"], r["o"] or "", r["rule"]) for r in with_rule) == [("m1", "p2", "chain"), ("m2", "", "chain")]


def test_derivations_are_looked_up_for_asked_facts(spark):
    facts = [(R + "r1", t.ROLE_IN, R + "m1"), (R + "r1", t.PLAYED_BY, R + "p1"), (R + "m1", t.DIRECTOR, R + "p1")]
    found = closure.close(graph(spark, facts), axioms(spark), explained=True)
    # rounds keep facts alone: no derivation is sorted out or written before one is asked for
    assert all(r.where("rule <> '' OR size(premises) > 0").isEmpty() for r in found.rounds)
    asked = found.new_terms().select(F.lit("x").alias("of"), "s", "p", "o")
    assert found.derivations(asked.limit(0)) is None
    told = {tuple(r)[:3]: [tuple(p) for p in r["premises"]] for r in found.derivations(asked).collect()}
    assert len(told) == sum(found.sizes) and told[(R + "m1", t.HAS_ROLE, R + "r1")] == [facts[0]]
    written = found.settled()
    assert {tuple(r)[:3]: [tuple(p) for p in r["premises"]] for r in written.derivations(asked).collect()} == told
    assert {tuple(r) for r in written.explain(asked).collect()} == {tuple(r) for r in found.explain(asked).collect()}


def test_known_facts_are_compared_by_the_objects_that_rules_name(spark):
    ax = axioms(spark)
    single, pairs = closure.single_rules(ax), closure.PairRules.of(ax)
    rules = {tuple(r) for r in single.select("on_p", "new_p", "new_o").collect()}
    rows = [("m", t.GENRE, O + "genre_action"), ("m", t.GENRE, O + "genre_other"), ("m", t.TYPE, t.MOVIE), ("m", t.TYPE, O + "AwardWinningDirector")]
    known = graph(spark, rows).triples()
    near = lambda there, first: {
        (r["p"], r["o"]) for r in known.where(closure.comparable(rules, pairs, class_closure(ax), there, first)).collect()}
    assert near({t.TYPE}, False) == {(t.GENRE, O + "genre_action"), (t.TYPE, O + "AwardWinningDirector")}
    assert near({t.GENRE}, False) == {(t.TYPE, t.MOVIE)} and near({t.NAME}, False) == set()
    assert near({t.GENRE}, True) == {(t.TYPE, t.MOVIE), (t.TYPE, O + "AwardWinningDirector")}


def test_names_of_one_link_take_no_part_in_rounds(spark, monkeypatch):
    """A hub and the names around it are told by one aggregation; only links between hubs go into rounds."""
    seen = []
    monkeypatch.setattr(inference, "components", lambda links, f=inference.components: (seen.append(links.count()), f(links))[1])
    star = [(f"{R}h{i}", f"{R}z{i}-{j}") for i in range(3) for j in range(i + 1)] + [(R + "same", R + "same"), (R + "q", R + "p"), (R + "q", R + "p")]
    links = lambda rows: constant_rows(spark, {"s": "string", "o": "string"}, rows)
    got = {r["node"]: r["cluster"] for r in inference.alias_clusters(links(star)).collect()}
    assert got == {n: m for s, o in star for n, m in ((s, s), (o, s))} | {R + "p": R + "p", R + "q": R + "p"} and not seen
    more = links([*star, (R + "h1", R + "h2"), (R + "a", R + "h2"), (R + "h2", None)])
    got = {r["node"]: r["cluster"] for r in inference.alias_clusters(more).collect()}
    assert seen == [1] and None not in got and {got[n] for n in got if n[len(R):][:2] in ("h1", "h2", "z1", "z2", "a")} == {R + "a"}
