"""Class membership and constraint checks from the axiom table.

Types are pairs (s, class). Each axiom shape is one join or filter. Axiom tables are constant tables of
known size, so Spark broadcasts them where that is cheap. Rules that need two facts first bring each
side to distinct short rows. An axiom kind without rows gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators.joins import among, hashed_join, key_set, regroup
from tripleloom.operators.lift import MergedGraph, StoredGraph, as_set, union_all
from tripleloom.operators.ontology import class_closure, of_kind
from tripleloom.session import cut_lineage
from tripleloom.sources.constants import constant_rows, constant_triples


TYPES = {"s": "string", "class": "string"}


def _types(frames: list[DataFrame], ax: DataFrame) -> DataFrame:
    return union_all([constant_rows(ax.sparkSession, TYPES, []), *frames]).distinct()


def _facts(frames: list[DataFrame], ax: DataFrame) -> DataFrame:
    return union_all([constant_triples(ax.sparkSession, []), *[f.select(*t.TERM) for f in frames]])


def asserted_types(graph) -> DataFrame:
    return graph.match(t.TYPE).where(F.col("o_kind") == "iri").select("s", F.col("o").alias("class"))


def with_superclasses(types: DataFrame, ax: DataFrame) -> DataFrame:
    """Sub- and equivalent-class typing: every class with all its ancestors, one join."""
    reach = class_closure(ax)
    upward = types.join(reach, "class").select("s", F.col("super").alias("class"))
    return upward.unionByName(types).distinct()


def property_types(triples: DataFrame, ax: DataFrame) -> DataFrame:
    """Domain and range typing; a range types only IRI and blank-node objects.

    Both come from one pass: an axiom row per (property, side), exploded against the triple.
    """
    sides = (
        of_kind(ax, "object property").select(F.col("subject").alias("p"), "property", "object")
        .unionByName(
            of_kind(ax, "datatype property").select(
                F.col("subject").alias("p"), "property", F.lit(None).cast("string").alias("object"))
        )
        .withColumnsRenamed({"property": "domain", "object": "range"})
    )
    typed = triples.join(sides, "p").select(
        F.inline(
            F.array(
                F.struct(F.col("s").alias("s"), F.col("domain").alias("class")),
                F.struct(
                    F.col("o").alias("s"), F.when(F.col("o_kind") != "lit", F.col("range")).alias("class")
                ),
            )
        )
    )
    return typed.where(F.col("class").isNotNull()).distinct()


def has_value_members(triples: DataFrame, ax: DataFrame) -> DataFrame:
    """x p v makes x a member of the class defined by (p, v)."""
    rule = (
        of_kind(ax, "has value").select("subject", F.col("property").alias("p"), F.col("object").alias("o"))
    )
    return (
        triples.where(F.col("o_kind") == "iri").join(rule, ["p", "o"])
        .select("s", F.col("subject").alias("class")).distinct()
    )


def has_value_triples(types: DataFrame, ax: DataFrame) -> DataFrame:
    """The other direction: a member of the class has the value."""
    rule = (
        of_kind(ax, "has value").select(F.col("subject").alias("class"), F.col("property").alias("p"), "object")
    )
    return types.join(rule, "class").select("s", "p", *t.iri(F.col("object")).columns())


def some_values_members(types: DataFrame, graph, ax: DataFrame) -> DataFrame:
    """Members of every listed class that have the property with a value of the wanted class."""
    out = []
    for row in of_kind(ax, "some values").collect():
        facts = graph.match(row["property"], as_bag=True).where(F.col("o_kind") != "lit").select("s", "o")
        values = types.where(F.col("class") == row["object"]).select(F.col("s").alias("o"))
        found = facts.join(regroup(values.distinct(), ["o"]), "o").select("s").distinct()
        for cls in row["members"]:
            found = found.join(types.where(F.col("class") == cls).select("s"), "s", "left_semi")
        out.append(found.select("s", F.lit(row["subject"]).alias("class")))
    return _types(out, ax)


def inverse_triples(graph, ax: DataFrame) -> DataFrame:
    """p inverse of q: o q s for every s p o, and the other way."""
    out = []
    for row in of_kind(ax, "inverse").collect():
        for p, q in ((row["subject"], row["object"]), (row["object"], row["subject"])):
            out.append(
                graph.match(p).where(F.col("o_kind") != "lit").select(
                    F.col("o").alias("s"), F.lit(q).alias("p"), F.col("s").alias("o"),
                    F.when(F.startswith("s", F.lit("_:")), "bnode").otherwise("iri").alias("o_kind"),
                    F.lit("").alias("o_dt"), F.lit("").alias("o_lang"),
                )
            )
    return _facts(out, ax)


def chain_triples(graph, ax: DataFrame) -> DataFrame:
    """first ∘ second ⊑ property, as a set."""
    out = []
    for row in of_kind(ax, "chain").collect():
        first, second = row["members"]
        left = graph.match(first, as_bag=True).where(F.col("o_kind") != "lit").select("s", F.col("o").alias("via"))
        right = graph.match(second, as_bag=True).select(F.col("s").alias("via"), *t.OBJECT)
        out.append(left.join(right, "via").select("s", F.lit(row["subject"]).alias("p"), *t.OBJECT))
    return as_set(_facts(out, ax))


def both_ends_members(graph, ax: DataFrame) -> DataFrame:
    """p(m, x) and q(m, x) make x a member: a two-column equi-join."""
    out = []
    for row in of_kind(ax, "both ends").collect():
        p, q = row["members"]
        left = graph.match(p, as_bag=True).where(F.col("o_kind") != "lit").select("s", "o")
        right = graph.match(q, as_bag=True).where(F.col("o_kind") != "lit").select("s", "o")
        out.append(
            left.join(right, ["s", "o"], "left_semi").select(
                F.col("o").alias("s"), F.lit(row["subject"]).alias("class"))
        )
    return _types(out, ax)


def functional(ax: DataFrame, kind: str) -> list[str]:
    """Functional properties of a kind; axioms are few by nature."""
    named = of_kind(ax, "functional").select("subject").join(of_kind(ax, kind).select("subject"), "subject", "left_semi")
    return sorted(r["subject"] for r in named.collect())


def functional_same(graph, ax: DataFrame) -> DataFrame:
    """A functional object property with several values: the values are one individual.

    Each further value is paired with the smallest one, which says the same as all pairs.
    """
    out = []
    for p in functional(ax, "object property"):
        values = graph.match(p).where(F.col("o_kind") != "lit").select("s", "o").distinct()
        least = (
            values.groupBy("s").agg(F.min("o").alias("least"), F.max("o").alias("most"))
            .where(F.col("least") != F.col("most")).select("s", "least")
        )
        out.append(
            values.join(regroup(least, ["s"]), "s").where(F.col("o") != F.col("least"))
            .select(F.col("least").alias("s"), F.lit(t.SAME_AS).alias("p"), *t.iri(F.col("o")).columns())
        )
    return as_set(_facts(out, ax))


def functional_clashes(graph, ax: DataFrame) -> DataFrame:
    """Subjects with several values of a functional datatype property: inconsistent."""
    out = []
    for p in functional(ax, "datatype property"):
        values = graph.match(p).where(F.col("o_kind") == "lit").select("s", "p", *t.OBJECT)
        out.append(as_set(values))
    return (
        _facts(out, ax).groupBy("s", "p").agg(F.count(F.lit(1)).alias("n_values")).where(F.col("n_values") > 1)
    )


def disjoint_clashes(types: DataFrame, ax: DataFrame) -> DataFrame:
    """Individuals in two disjoint classes, with the two memberships that explain the clash.

    One aggregation over the memberships that matter, which a filter by class finds in the scan; no self-join."""
    pairs = of_kind(ax, "disjoint").select(F.col("subject").alias("left_class"), F.col("object").alias("right_class"))
    sides = (
        pairs.select("left_class", "right_class", F.inline(F.array(
            F.struct(F.col("left_class").alias("class"), F.lit(1).alias("side")),
            F.struct(F.col("right_class").alias("class"), F.lit(2).alias("side")),
        )))
    )
    return (
        among(types, "class", key_set(sides, "class")).join(sides, "class")
        .groupBy("s", "left_class", "right_class").agg(F.bit_or("side").alias("sides"))
        .where(F.col("sides") == 3).select("s", "left_class", "right_class")
    )


def members(types: DataFrame, classes: list[str], base: str = t.RES) -> DataFrame:
    """Members of the classes among the local individuals only."""
    return types.where(F.col("class").isin(classes) & F.startswith("s", F.lit(base))).select("class", "s").distinct()


def both_ways(links: DataFrame) -> DataFrame:
    return links.select(
        F.inline(F.array(
            F.struct(F.col("s").alias("node"), F.col("o").alias("other"), F.lit(True).alias("in_s"), F.lit(False).alias("in_o")),
            F.struct(F.col("o").alias("node"), F.col("s").alias("other"), F.lit(False).alias("in_s"), F.lit(True).alias("in_o")),
        ))
    )


def alias_clusters(links: DataFrame) -> DataFrame:
    """Connected components of (s, o) identity statements as (node, cluster); the cluster is its
    smallest node. A missing end is no node.

    Most names have one other name, so those follow the name they are linked with and take no part in rounds: only links
    between two names of several others do. One aggregation of all links tells them apart.
    """
    links = links.where(F.col("s").isNotNull() & F.col("o").isNotNull())
    other = F.when(F.col("other") != F.col("node"), F.col("other"))
    ends = cut_lineage(
        both_ways(links).groupBy("node")
        .agg(F.min(other).alias("lo"), F.max(other).alias("hi"), F.max("in_s").alias("in_s"), F.max("in_o").alias("in_o"))
        .select("node", "lo", (F.col("lo") != F.col("hi")).alias("several"), "in_s", "in_o")
    )
    hubs = ends.where("several")
    placed = hubs.select("node", F.least("node", "lo").alias("cluster"))
    between = links_between(links, hubs)
    if between is not None:
        joined = components(between)
        least = joined.join(placed, "node").groupBy(F.col("cluster_of").alias("of")).agg(F.min("cluster").alias("least"))
        own = joined.join(least, F.col("cluster_of") == F.col("of")).select("node", "least")
        placed = cut_lineage(hashed_join(placed, own, ["node"], "left").select("node", F.coalesce("least", "cluster").alias("cluster")))
    near = ends.where("NOT coalesce(several, false)").select("node", F.coalesce("lo", "node").alias("hub"))
    of_hub = placed.select(F.col("node").alias("hub"), F.col("cluster"))
    # two names of only each other have no hub
    follow = near.join(of_hub, "hub", "left").select("node", F.coalesce("cluster", F.least("node", "hub")).alias("cluster"))
    return placed.unionByName(follow)


def links_between(links: DataFrame, hubs: DataFrame) -> DataFrame | None:
    """The links with both ends among `hubs`, None if there are none. The side with fewer hubs comes first, and what it leaves
    is written, so that a few of either are known to be few."""
    sizes = hubs.agg(F.count_if("in_s").alias("s"), F.count_if("in_o").alias("o")).first()
    for side in sorted("so", key=lambda c: sizes[c]):
        if not sizes[side]:
            return None
        own = cut_lineage(hubs.where(f"in_{side}").select(F.col("node").alias(side)))
        links = cut_lineage(links.where("s <> o").join(own, side).select("s", "o"))
        if links.isEmpty():
            return None
    return links


def components(links: DataFrame) -> DataFrame:
    """(node, cluster_of) of the nodes of some links, with the smallest node that is connected.

    Least labels move along the links and each round also jumps to the label's own label, so a
    chain of n links takes about log n rounds. Labels and links are read from tables on both
    sides of the join, which lets adaptive execution split a node with a large part of all links.
    """
    edges = cut_lineage(both_ways(links).select("node", "other").distinct())
    labels = cut_lineage(
        edges.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("cluster"))
    )
    while True:
        near = hashed_join(edges, labels, ["node"]).select(F.col("other").alias("node"), "cluster", F.lit(None).cast("string").alias("was"))
        own = labels.select("node", "cluster", F.col("cluster").alias("was"))
        least = near.unionByName(own).groupBy("node").agg(F.min("cluster").alias("cluster"), F.max("was").alias("was"))
        jump = labels.select(F.col("node").alias("cluster"), F.col("cluster").alias("jumped"))
        after = cut_lineage(
            hashed_join(least, jump, ["cluster"]).select("node", F.least("cluster", "jumped").alias("cluster"), "was")
        )
        labels = after.select("node", "cluster")
        if after.where(F.col("cluster") != F.col("was")).isEmpty():
            return labels.select("node", F.col("cluster").alias("cluster_of"))


def alias_counts(members_: DataFrame, clusters: DataFrame) -> DataFrame:
    """Members per class, and the same with every alias of a member counted as well."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    placed = members_.join(clusters, F.col("s") == F.col("node"), "left").select(
        "class", F.coalesce("cluster", "s").alias("cluster")
    )
    per_cluster = placed.groupBy("class", "cluster").agg(F.count(F.lit(1)).alias("local"))
    return (
        per_cluster.join(sizes, "cluster", "left")
        .groupBy("class")
        .agg(
            F.sum("local").alias("members"),
            F.sum(F.coalesce("size", F.lit(1))).alias("with_aliases"),
        )
    )
