"""The movie ontology as an axiom table, and its triples.

Fixed values: class and property names, their domains, ranges and axioms. The table has a fixed
number of rows that does not grow with the data, so broadcasting it is safe.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripleloom.functions import terms as t
from tripleloom.session import cut_lineage
from tripleloom.sources.constants import constant_rows, constant_triples

#: Class axioms up to this number are closed on the driver.
SMALL = 200
AXIOMS = {"kind": "string", "subject": "string", "property": "string", "object": "string", "members": "strings"}


def axiom_rows(action: str = "Action", comedy: str = "Comedy") -> list[tuple]:
    """(kind, subject, property, object, members). `action` and `comedy` are the labels of the
    genres behind the two defined movie classes."""
    o = t.ONT
    rows: list[tuple] = []

    def add(kind, subject, prop=None, obj=None, members=None):
        rows.append((kind, subject, prop, obj, members))

    for name, label in (
        ("Person", "Person"), ("Director", "Director"), ("Actor", "Actor"), ("Movie", "Movie"), ("Genre", "Genre"),
        ("Studio", "Studio"), ("Country", "Country"), ("ActionMovie", "Action Movie"),
        ("ComedyMovie", "Comedy Movie"), ("Award", "Award"), ("AwardWinningDirector", "Award-winning Director"),
        ("ActorDirector", "Actor-Director"), ("CastRole", "Cast role"),
    ):
        add("class", o + name, None, label)
    add("equivalent", o + "Person", None, t.PERSON)
    add("equivalent", o + "Movie", None, t.MOVIE)
    for sub, sup in (
        ("Director", "Person"), ("Actor", "Person"), ("ActorDirector", "Person"), ("AwardWinningDirector", "Director")
    ):
        add("subclass", o + sub, None, o + sup)
    for prop, domain, range_ in (
        (t.GENRE, "Movie", "Genre"), (t.STUDIO, "Movie", "Studio"), (t.COUNTRY, "Movie", "Country"),
        (t.DIRECTOR, "Movie", "Director"), (t.STARRING, "Movie", "Actor"), (t.HAS_AWARD, "Person", "Award"),
        (t.HAS_ROLE, "Movie", "CastRole"), (t.ROLE_IN, "CastRole", "Movie"), (t.PLAYED_BY, "CastRole", "Actor"),
    ):
        add("object property", prop, o + domain, o + range_)
    for prop, domain, range_ in (
        (t.YEAR, "Movie", t.XSD_INTEGER), (t.CHARACTER, "CastRole", t.XSD_STRING),
        (t.BILLING, "CastRole", t.XSD_INTEGER),
    ):
        add("datatype property", prop, o + domain, range_)
    for prop, label in (
        (t.GENRE, "has genre"), (t.STUDIO, "produced by"), (t.COUNTRY, "produced in"), (t.YEAR, "release year"),
        (t.DIRECTOR, "director"), (t.STARRING, "starring"), (t.HAS_AWARD, "has award"),
        (t.HAS_ROLE, "has cast role"), (t.ROLE_IN, "role in movie"), (t.PLAYED_BY, "played by"),
        (t.CHARACTER, "character name"), (t.BILLING, "billing order"),
    ):
        add("label", prop, None, label)
    for name, genre in (("ActionMovie", action), ("ComedyMovie", comedy)):
        node = f"{o}genre_{re.sub('[^a-z0-9]+', '_', genre.lower())}"
        add("has value", o + name, t.GENRE, node)
        add("individual", node, o + "Genre", genre)
    for subject, prop, obj in (
        ("CastRole", "seeAlso", t.SCHEMA + "PerformanceRole"), ("characterName", "seeAlso", t.SCHEMA + "characterName")
    ):
        add("see also", o + subject, t.RDFS + prop, obj)
    add("comment", o + "CastRole", None, "An actor in a movie, with character and billing position.")
    add("disjoint", o + "ComedyMovie", None, o + "ActionMovie")
    add("some values", o + "AwardWinningDirector", t.HAS_AWARD, o + "Award", [o + "Director"])
    add("chain", t.STARRING, None, None, [t.HAS_ROLE, t.PLAYED_BY])
    add("inverse", t.HAS_ROLE, None, t.ROLE_IN)
    for prop in (t.ROLE_IN, t.PLAYED_BY, t.BILLING):
        add("functional", prop)
    add("both ends", o + "ActorDirector", None, None, [t.DIRECTOR, t.STARRING])
    return rows


def axioms(spark: SparkSession, action: str = "Action", comedy: str = "Comedy") -> DataFrame:
    return constant_rows(spark, AXIOMS, axiom_rows(action, comedy))


def of_kind(ax: DataFrame, *kinds: str) -> DataFrame:
    return ax.where(F.col("kind").isin(*kinds))


def class_closure(ax: DataFrame) -> DataFrame:
    """(class, super) for every class in a sub- or equivalent-class axiom: its ancestors, itself included."""
    up = of_kind(ax, "subclass", "equivalent").select(
        F.inline(F.array(
            F.struct(F.col("subject").alias("class"), F.col("object").alias("super")),
            F.struct(F.when(F.col("kind") == "equivalent", F.col("object")).alias("class"), F.col("subject").alias("super")),
            F.struct(F.col("subject").alias("class"), F.col("subject").alias("super")),
            F.struct(F.col("object").alias("class"), F.col("object").alias("super")),
        ))
    ).where("class IS NOT NULL AND super IS NOT NULL")
    few = up.distinct().limit(SMALL + 1).collect()
    if len(few) <= SMALL:  # as small as an ontology is, so it is closed at once; joins give the same
        return constant_rows(ax.sparkSession, {"class": "string", "super": "string"}, sorted(_closed({tuple(r) for r in few})))
    return joined_closure(up)


def _closed(pairs: set[tuple[str, str]]) -> set[tuple[str, str]]:
    while True:
        above: dict[str, set[str]] = {}
        for c, x in pairs:
            above.setdefault(c, set()).add(x)
        wider = pairs | {(c, y) for c, x in pairs for y in above.get(x, ())}
        if wider == pairs:
            return pairs
        pairs = wider


def joined_closure(pairs: DataFrame) -> DataFrame:
    """The transitive closure of (class, super), which holds each class with itself.

    A round joins all pairs so far with the pairs of just twice as many steps as the last one's, so that a chain
    of n classes takes about log n rounds and each pair is found a few times. What a round found is a written table.
    """
    reach = cut_lineage(pairs.distinct())
    steps = cut_lineage(reach.where("class <> super"))
    size, before = reach.count(), -1
    while size != before:
        on = steps.select(F.col("class").alias("super"), F.col("super").alias("next"))
        longer = reach.join(on, "super").select("class", F.col("next").alias("super"))
        reach = cut_lineage(reach.unionByName(longer).distinct())
        steps = cut_lineage(steps.join(on, "super").select("class", F.col("next").alias("super")).distinct())
        before, size = size, reach.count()
    return reach


def ontology_triples(ax: DataFrame) -> DataFrame:
    """The axioms as OWL triples; restrictions and lists become blank nodes.

    As many triples as the ontology has, whatever the data: again a constant table.
    """
    owl, rdf, rdfs = t.OWL, t.RDF, t.RDFS
    out: set[tuple] = set()

    def node(*parts) -> str:
        return "_:b" + hashlib.md5("\x1f".join(map(str, parts)).encode()).hexdigest()

    def add(s: str, p: str, o: str, kind: str = "iri", lang: str = "") -> None:
        out.add((s, p, o, "bnode" if o.startswith("_:") else kind, "", lang))

    def ends(s, domain, range_, kind):
        add(s, t.TYPE, owl + kind)
        add(s, rdfs + "domain", domain)
        add(s, rdfs + "range", range_)

    def rdf_list(key: str, items: list[str]) -> str:
        cells = [node("list", key, i) for i in range(len(items))] + [rdf + "nil"]
        for cell, item, rest in zip(cells, items, cells[1:]):
            add(cell, rdf + "first", item)
            add(cell, rdf + "rest", rest)
        return cells[0]

    def restriction(s, p, how, value) -> str:
        own = node(s, p, value)
        add(own, t.TYPE, owl + "Restriction")
        add(own, owl + "onProperty", p)
        add(own, owl + how, value)
        return own

    direct = {
        "equivalent": owl + "equivalentClass", "subclass": rdfs + "subClassOf", "disjoint": owl + "disjointWith",
        "inverse": owl + "inverseOf", "see also": rdfs + "seeAlso",
    }
    for kind, s, p, o, parts in ax.select("kind", "subject", "property", "object", "members").collect():
        if kind in direct:
            add(s, direct[kind], o)
        elif kind in ("class", "label"):
            add(s, t.LABEL, o, "lit", "en")
            if kind == "class":
                add(s, t.TYPE, owl + "Class")
        elif kind == "comment":
            add(s, rdfs + "comment", o, "lit", "en")
        elif kind == "individual":
            add(s, t.TYPE, p)
            add(s, t.LABEL, o, "lit", "en")
        elif kind == "functional":
            add(s, t.TYPE, owl + "FunctionalProperty")
        elif kind == "object property":
            ends(s, p, o, "ObjectProperty")
        elif kind == "datatype property":
            ends(s, p, o, "DatatypeProperty")
        elif kind == "has value":
            add(s, owl + "equivalentClass", restriction(s, p, "hasValue", o))
        elif kind == "some values":
            both = node("intersection", s)
            add(s, owl + "equivalentClass", both)
            add(both, t.TYPE, owl + "Class")
            add(both, owl + "intersectionOf", rdf_list(s, [*parts, restriction(s, p, "someValuesFrom", o)]))
        elif kind == "chain":
            add(s, owl + "propertyChainAxiom", rdf_list(s, parts))
    return constant_triples(ax.sparkSession, sorted(out))
