"""Named queries over class membership and constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import closure, inference, lift, upkeep
from tripleloom.operators.joins import set_difference_counts
from tripleloom.operators.lift import MappedGraph, MergedGraph, Rule, TripleMap
from tripleloom.operators.ontology import axioms
from tripleloom.plans.build_queries import stored_winners
from tripleloom.session import cut_lineage
from tripleloom.sources.constants import constant_triples
from tripleloom.sources.driver_views import DriverViews, movie_iri, person_iri

AWARD, AWARD_LABEL = "award_best_director", "Academy Award for Best Director"
REPORTED = [t.ONT + c for c in ("ActionMovie", "ComedyMovie", "AwardWinningDirector", "ActorDirector", "CastRole")]


def award_graph(v: DriverViews) -> MappedGraph:
    return MappedGraph(lift.award_map(stored_winners(v), AWARD, AWARD_LABEL))


def with_awards(v: DriverViews) -> MergedGraph:
    """The graph with its gaps, and the awards: what the closure has to complete."""
    return MergedGraph([v.gappy_graph, award_graph(v)])


def per_class(types: DataFrame) -> DataFrame:
    return types.groupBy("class").agg(F.count(F.lit(1)).alias("members"))


def rule_equivalent(v: DriverViews) -> DataFrame:
    """Local class names of the movies and people that the data types with public ones."""
    types = inference.with_superclasses(inference.asserted_types(v.graph), v.axioms)
    return per_class(types.where(F.col("class").isin(t.ONT + "Movie", t.ONT + "Person")))


def rule_subclass(v: DriverViews) -> DataFrame:
    return per_class(inference.with_superclasses(inference.asserted_types(v.graph), v.axioms))


def rule_domain_range(v: DriverViews) -> DataFrame:
    return per_class(inference.property_types(v.graph.triples(), v.axioms))


def rule_has_value(v: DriverViews) -> DataFrame:
    return per_class(inference.has_value_members(v.graph.match(t.GENRE), v.axioms))


def rule_has_value_triples(v: DriverViews) -> DataFrame:
    """Members of the defined classes imply the genre, which is what the data says."""
    types = inference.has_value_members(v.graph.match(t.GENRE), v.axioms)
    implied = inference.has_value_triples(types, v.axioms).select("s", "o")
    said = v.graph.match(t.GENRE).select("s", "o")
    return set_difference_counts(implied, said, "impliedOnly", "saidOnly")


def rule_award_winning(v: DriverViews) -> DataFrame:
    graph = MappedGraph([*v.graph.maps, *award_graph(v).maps])
    direct = inference.asserted_types(graph).unionByName(
        inference.property_types(graph.match(t.HAS_AWARD), v.axioms)
    )
    types = cut_lineage(inference.with_superclasses(direct, v.axioms))
    return inference.some_values_members(types, graph, v.axioms).select("s")


def rule_chain_starring(v: DriverViews) -> DataFrame:
    return inference.chain_triples(v.graph, v.axioms).select("s", "o")


def rule_inverse(v: DriverViews) -> DataFrame:
    return inference.inverse_triples(v.graph, v.axioms).groupBy("p").agg(
        F.count(F.lit(1)).alias("triples"), F.count_distinct("s").alias("subjects")
    )


def flat_roles(v: DriverViews) -> MappedGraph:
    """A graph that breaks the functional axioms: a role IRI per movie and actor without suffix has
    several billing orders, and one per movie and line has several players."""
    roles = v.billed()
    pair = t.mint(t.RES + "role/", F.col("movie_id"), F.lit("-"), F.col("actor_id"))
    line = t.mint(t.RES + "line/", F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    lines = v.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return MappedGraph(
        [
            TripleMap(roles, [Rule(pair, t.BILLING, t.integer(F.col("billing_order")))]),
            TripleMap(lines, [Rule(line, t.PLAYED_BY, t.iri(person_iri(F.col("l_suppkey"))))]),
            TripleMap(roles, [Rule(pair, t.ROLE_IN, t.iri(movie_iri(F.col("movie_id"))))]),
        ]
    )


def rule_functional(v: DriverViews) -> DataFrame:
    return inference.functional_same(flat_roles(v), v.axioms).select("s", "p", "o")


def rule_functional_clash(v: DriverViews) -> DataFrame:
    return inference.functional_clashes(flat_roles(v), v.axioms)


def rule_actor_director(v: DriverViews) -> DataFrame:
    return inference.both_ends_members(v.graph, v.axioms).select("s")


def rule_disjoint(v: DriverViews) -> DataFrame:
    """Movies whose parts make them members of two disjoint classes, with the two memberships."""
    genre = t.mint(t.ONT + "genre_", F.lower("p_type"))
    parts = v.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey")).join(
        v.table("part").select("p_partkey", "p_type"), "p_partkey"
    )
    tagged = MappedGraph([TripleMap(parts, [Rule(movie_iri(F.col("l_orderkey")), t.GENRE, t.iri(genre))])])
    ax = axioms(v.spark, "PROMO", "ECONOMY")
    types = inference.has_value_members(tagged.match(t.GENRE, as_bag=True), ax)
    return inference.disjoint_clashes(types, ax)


def same_as_links(v: DriverViews) -> DataFrame:
    return MappedGraph([lift.same_as_map(v.stored_report)]).match(t.SAME_AS).select("s", "o")


def rule_same_as(v: DriverViews) -> DataFrame:
    """Alias clusters by size."""
    clusters = inference.alias_clusters(same_as_links(v))
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))


def reported_types(v: DriverViews) -> DataFrame:
    """Memberships of the five reported classes, each by its own rule."""
    roles = inference.asserted_types(v.graph).where(F.col("class") == t.ONT + "CastRole")
    winners = rule_award_winning(v).select("s", F.lit(t.ONT + "AwardWinningDirector").alias("class"))
    return lift.union_all([
        inference.has_value_members(v.graph.match(t.GENRE), v.axioms), inference.both_ends_members(v.graph, v.axioms),
        roles, winners,
    ])


def rule_alias_counts(v: DriverViews) -> DataFrame:
    """Members of the reported classes with and without their aliases."""
    types = reported_types(v)
    clusters = inference.alias_clusters(same_as_links(v))
    return inference.alias_counts(inference.members(types, REPORTED), clusters)


def rule_agreement(v: DriverViews) -> DataFrame:
    """`starring` against the chain over the role nodes, on the triples of the graph with gaps."""
    direct = v.gappy_graph.match(t.STARRING).select("s", "o")
    through = inference.chain_triples(v.gappy_graph, v.axioms).select("s", "o")
    counts = set_difference_counts(direct, through, "starringWithoutRole", "roleWithoutStarring")
    return counts.withColumn(
        "agree", (F.col("starringWithoutRole") == 0) & (F.col("roleWithoutStarring") == 0)
    )


def rule_closure(v: DriverViews) -> DataFrame:
    """Members of every class at the fixpoint of all rules."""
    types = closure.close(with_awards(v), v.axioms).types()
    return per_class(types.where(F.startswith("class", F.lit(t.ONT)) | F.col("class").isin(t.MOVIE, t.PERSON)))


def rule_facts(v: DriverViews) -> DataFrame:
    """Facts that the closure adds, by predicate."""
    facts = closure.close(with_awards(v), v.axioms).facts()
    return facts.groupBy("p").agg(F.count(F.lit(1)).alias("triples"))


def line_roles(v: DriverViews) -> MappedGraph:
    """A role for each line of every 499th movie. Lines of one number are one role, so their players are one person."""
    line = t.mint(t.RES + "line/", F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    lines = v.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").where(F.col("l_orderkey") % 499 == 0)
    return MappedGraph([TripleMap(lines, [
        Rule(line, t.PLAYED_BY, t.iri(person_iri(F.col("l_suppkey")))), Rule(line, t.ROLE_IN, t.iri(movie_iri(F.col("l_orderkey")))),
    ])])


def closed_with_names(v: DriverViews) -> closure.Closure:
    return closure.close(MergedGraph([with_awards(v), line_roles(v)]), v.axioms, equal=True)


def rule_closure_equal(v: DriverViews) -> DataFrame:
    """Members of every class where several values of a functional property are one individual, by its smallest name."""
    return per_class(closed_with_names(v).types().where(F.startswith("class", F.lit(t.ONT)) | F.col("class").isin(t.MOVIE, t.PERSON)))


def rule_equal_names(v: DriverViews) -> DataFrame:
    """Every individual of several names, and the smallest one."""
    return closed_with_names(v).clusters.select("node", "cluster")


def rule_explain(v: DriverViews) -> DataFrame:
    """For each member of two disjoint classes, the given triples that it rests on."""
    genre = t.mint(t.ONT + "genre_", F.lower("p_type"))
    parts = v.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey")).join(
        v.table("part").select("p_partkey", "p_type"), "p_partkey"
    )
    tagged = MappedGraph([TripleMap(parts, [Rule(movie_iri(F.col("l_orderkey")), t.GENRE, t.iri(genre))])])
    ax = axioms(v.spark, "PROMO", "ECONOMY")
    found = closure.close(tagged, ax, explained=True)
    clashes = cut_lineage(inference.disjoint_clashes(found.types(), ax))
    sides = clashes.select(F.inline(F.array(*[
        F.struct(F.struct("s", "left_class", "right_class").alias("of"), F.col("s").alias("s"), F.lit(t.TYPE).alias("p"), F.col(c).alias("o"))
        for c in ("left_class", "right_class")
    ])))
    return found.explain(sides).select("of.left_class", "of.right_class", "s", "p", "o")


def bad_record(v: DriverViews) -> DataFrame:
    """A movie in two genres that make it a member of two disjoint classes."""
    movie = t.RES + "movie/bad-record"
    genres = [(movie, t.GENRE, t.ONT + g, "iri", "", "") for g in ("genre_1_urgent", "genre_5_low")]
    return constant_triples(v.spark, [(movie, t.TYPE, t.MOVIE, "iri", "", ""), (movie, t.TITLE, "Bad record", "lit", t.XSD_STRING, ""), *genres])


def bundle_with_bad_record(v: DriverViews) -> DataFrame:
    """Members per class of the bundle, with the bad record and after it is taken out again. Members of two disjoint
    classes are members of the empty class."""
    empty = t.OWL + "Nothing"

    def told(step: str, found: closure.Closure) -> DataFrame:
        types = found.types().where(F.startswith("class", F.lit(t.ONT)) | F.col("class").isin(t.MOVIE, t.PERSON))
        clashes = inference.disjoint_clashes(types, v.axioms).select("s", F.lit(empty).alias("class")).distinct()
        return per_class(types.unionByName(clashes)).select(F.lit(step).alias("step"), "class", "members")

    first = closure.close(with_awards(v), v.axioms)
    bad = upkeep.extended(first, bad_record(v), v.axioms)
    mended = upkeep.without(bad, bad_record(v), v.axioms)
    return lift.union_all([told("first", first), told("with the bad record", bad), told("mended", mended)])


def rule_members(v: DriverViews) -> DataFrame:
    """Local members of the reported classes, in order."""
    return inference.members(reported_types(v), REPORTED).orderBy("class", "s")
