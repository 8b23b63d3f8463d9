"""Rows to triples.

A `TripleMap` states once how a row becomes triples. It is used in two ways:

* `triples()` writes all of them in one pass over the rows (one generator, no union of scans);
* `match(p)` gives the rows of one predicate as a plain projection, so a graph pattern over mapped
  tables reads only the columns it needs and Catalyst pushes its filters to the scan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from tripleloom.functions import terms as t
from tripleloom.functions.text import slug
from tripleloom.operators.joins import KeySet, among
from tripleloom.sources.constants import constant_triples


WHOLE_NUMBER = r"0|-?[1-9]\d{0,17}"


@dataclass(frozen=True)
class Rule:
    """One triple per row; `when` keeps it out for rows without the value.

    `of` says how the subject is minted: its prefix, and the key column whose text follows if that is all
    (else None). A question about one resource then becomes a filter on the key, which reaches the scan.
    """

    s: Column
    p: str
    o: t.Term
    when: Column | None = None
    of: tuple[str, str | None] | None = None

    def about(self, rows: DataFrame, subject: str) -> DataFrame | None:
        """The rows whose subject it is, None if there can be none."""
        if self.of is None:
            return rows.where(self.s == subject)
        prefix, key = self.of
        if not subject.startswith(prefix):
            return None
        if key is None:
            return rows.where(self.s == subject)
        rest = subject[len(prefix):]
        if isinstance(rows.schema[key].dataType, IntegralType):
            return rows.where(F.col(key) == int(rest)) if re.fullmatch(WHOLE_NUMBER, rest) else None
        return rows.where(F.col(key).cast("string") == rest)

    def about_any(self, rows: DataFrame, subjects: list[str]) -> DataFrame | None:
        """The rows whose subject is one of a few, None if there can be none."""
        if self.of is None:
            return rows.where(self.s.isin(subjects))
        prefix, key = self.of
        fitting = [s for s in subjects if s.startswith(prefix)]
        if not fitting:
            return None
        if key is None:
            return rows.where(self.s.isin(fitting))
        rests = [s[len(prefix):] for s in fitting]
        if isinstance(rows.schema[key].dataType, IntegralType):
            numbers = [int(r) for r in rests if re.fullmatch(WHOLE_NUMBER, r)]
            return rows.where(F.col(key).isin(numbers)) if numbers else None
        return rows.where(F.col(key).cast("string").isin(rests))

    def columns(self) -> list[Column]:
        return [self.s.alias("s"), F.lit(self.p).alias("p"), *self.o.columns()]


@dataclass(frozen=True)
class TripleMap:
    rows: DataFrame
    rules: list[Rule]
    # True when no two (row, rule) give the same triple, so that no set-making shuffle is needed.
    unique: bool = False
    # The ways to mint subjects (`Rule.of`) that give each subject from one row at most.
    single: frozenset[tuple[str, str | None]] = frozenset()

    def triples(self) -> DataFrame:
        made = [
            F.struct(*r.columns()) if r.when is None else F.when(r.when, F.struct(*r.columns()))
            for r in self.rules
        ]
        return self.rows.select(F.inline(F.array(*made))).where(F.col("s").isNotNull())

    def match(self, p: str, subject: str | None = None, subjects: list[str] | None = None) -> list[DataFrame]:
        """The rows of each rule for a predicate, of one or of a few subjects where they are given."""
        found = []
        for r in self.rules:
            if r.p == p:
                rows = self.rows if subject is None else r.about(self.rows, subject)
                if rows is not None and subjects is not None:
                    rows = r.about_any(rows, subjects)
                if rows is not None:
                    found.append((rows if r.when is None else rows.where(r.when)).select(*r.columns()))
        return found

    def about(self, subject: str) -> list[DataFrame]:
        """All triples of one subject: a pass over the rows for each way to mint subjects that can give it."""
        found = []
        for of in dict.fromkeys(r.of for r in self.rules if r.of):
            same = [r for r in self.rules if r.of == of]
            rows = same[0].about(self.rows, subject)
            if rows is not None:
                found.append(replace(self, rows=rows, rules=same).triples().where(F.col("s") == subject))
        other = [r for r in self.rules if r.of is None]
        return found + ([replace(self, rules=other).triples().where(F.col("s") == subject)] if other else [])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def as_set(triples: DataFrame) -> DataFrame:
    """A graph is a set of triples; equal terms from two sources are one triple."""
    return triples.dropDuplicates(t.TERM)


class MappedGraph:
    """Triples that are computed from tables on demand."""

    def __init__(self, maps: list[TripleMap]):
        self.maps = maps

    def predicate_counts(self) -> DataFrame:
        """(p, triples): the size of each predicate.

        Where every rule of a row gives a triple of its own, the rules are counted and no term is made; only the
        maps that repeat triples have to make them distinct first.
        """
        counted = []
        for m in self.maps:
            if m.unique:
                there = [r.s.isNotNull() if r.when is None else r.when & r.s.isNotNull() for r in m.rules]
                sums = m.rows.agg(*[F.count_if(x).alias(f"_{i}") for i, x in enumerate(there)])
                pairs = [F.struct(F.lit(r.p).alias("p"), F.col(f"_{i}").alias("triples")) for i, r in enumerate(m.rules)]
                counted.append(sums.select(F.inline(F.array(*pairs))))
        shared = [m.triples() for m in self.maps if not m.unique]
        if shared:
            counted.append(as_set(union_all(shared)).groupBy("p").agg(F.count(F.lit(1)).alias("triples")))
        return union_all(counted).groupBy("p").agg(F.sum("triples").alias("triples")).where(F.col("triples") > 0)

    def triples(self) -> DataFrame:
        own = [m.triples() for m in self.maps if m.unique]
        shared = [m.triples() for m in self.maps if not m.unique]
        return union_all(own + ([as_set(union_all(shared))] if shared else []))

    def match(self, p: str | None, as_bag: bool = False, subject: str | None = None) -> DataFrame:
        """Triples of one predicate (None: of all, about `subject`). `as_bag` leaves out the set-making for uses that do not
        mind repeated triples, such as a minimum. With `subject` only tables that can have it are read."""
        def found(m: TripleMap) -> list[DataFrame]:
            return m.about(subject) if p is None else m.match(p, subject)

        own = [d for m in self.maps if m.unique or as_bag for d in found(m)]
        shared = [d for m in self.maps if not (m.unique or as_bag) for d in found(m)]
        frames = own + ([as_set(union_all(shared))] if shared else [])
        if not frames:
            return constant_triples(self.maps[0].rows.sparkSession, [])
        return union_all(frames)

    def match_among(self, p: str, subjects: KeySet, as_bag: bool = False) -> DataFrame:
        """Triples of one predicate about the given subjects: few of them become a filter on the key that their
        names are minted from, more are joined."""
        if subjects.values is None:
            return among(self.match(p, as_bag), "s", subjects)
        own = [d for m in self.maps if m.unique or as_bag for d in m.match(p, subjects=subjects.values)]
        shared = [d for m in self.maps if not (m.unique or as_bag) for d in m.match(p, subjects=subjects.values)]
        frames = own + ([as_set(union_all(shared))] if shared else [])
        return union_all(frames) if frames else constant_triples(self.maps[0].rows.sparkSession, [])


class StoredGraph:
    """Triples that are kept in a table, best partitioned by predicate."""

    def __init__(self, triples: DataFrame):
        self.stored = triples

    def triples(self) -> DataFrame:
        return self.stored

    def match(self, p: str | None, as_bag: bool = False, subject: str | None = None) -> DataFrame:
        rows = self.stored if p is None else self.stored.where(F.col("p") == p)
        return (rows if subject is None else rows.where(F.col("s") == subject)).select(*t.TERM)

    def match_among(self, p: str, subjects: KeySet, as_bag: bool = False) -> DataFrame:
        return among(self.match(p, as_bag), "s", subjects)

    def predicate_counts(self) -> DataFrame:
        return self.stored.groupBy("p").agg(F.count(F.lit(1)).alias("triples"))


class MergedGraph:
    """Several graphs as one: the set union of their triples."""

    def __init__(self, graphs: list):
        self.graphs = graphs

    def triples(self) -> DataFrame:
        return as_set(union_all([g.triples().select(*t.TERM) for g in self.graphs]))

    def match(self, p: str | None, as_bag: bool = False, subject: str | None = None) -> DataFrame:
        rows = union_all([g.match(p, as_bag, subject).select(*t.TERM) for g in self.graphs])
        return rows if as_bag else as_set(rows)


# --- cast lists ---------------------------------------------------------------------------------


def split_cast(films: DataFrame, strict: bool = True) -> DataFrame:
    """Three '|'-separated, position-aligned columns become `cast`, an array of structs.

    An absent or empty `cast_characters` stands for blank names. Lists of unequal length are an
    error that names the movie; with `strict=False` such rows keep `aligned = false` instead.
    """
    have = set(films.columns)
    for name in ("cast_ids", "cast_names", "cast_characters"):
        if name not in have:
            films = films.withColumn(name, F.lit(None).cast("string"))
    some = t.present(F.col("cast_ids"))
    ids = F.when(some, F.split("cast_ids", r"\|", -1)).otherwise(F.array().cast("array<string>"))
    names = F.when(some, F.split(F.coalesce("cast_names", F.lit("")), r"\|", -1)).otherwise(
        F.array().cast("array<string>")
    )
    characters = F.when(
        some & t.present(F.col("cast_characters")), F.split("cast_characters", r"\|", -1)
    ).otherwise(F.array_repeat(F.lit(""), F.size(ids)))
    aligned = (F.size(ids) == F.size(names)) & (F.size(ids) == F.size(characters))
    cast = F.transform(
        F.arrays_zip(ids.alias("id"), names.alias("name"), characters.alias("character")),
        lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"), c["character"].alias("character")),
    )
    rest = [c for c in films.columns if c not in ("cast_ids", "cast_names", "cast_characters")]
    if strict:
        message = F.concat(F.lit("unequal numbers of cast ids, names and characters, id "), F.col("id").cast("string"))
        return films.select(*rest, F.when(aligned, cast).otherwise(F.raise_error(message)).alias("cast"))
    return films.select(*rest, cast.alias("cast"), aligned.alias("aligned"))


def misaligned(films: DataFrame) -> DataFrame:
    """Quarantine: movies whose three cast columns do not line up, with their lengths."""

    def length(name: str) -> Column:
        return F.when(t.present(F.col(name)), F.size(F.split(name, r"\|", -1))).otherwise(F.lit(0))

    ids, names = length("cast_ids"), F.size(F.split(F.coalesce("cast_names", F.lit("")), r"\|", -1))
    characters = F.when(t.present(F.col("cast_characters")), length("cast_characters")).otherwise(ids)
    return films.where(t.present(F.col("cast_ids")) & ((ids != names) | (ids != characters))).select(
        "id",
        ids.cast("long").alias("n_ids"),
        names.cast("long").alias("n_names"),
        characters.cast("long").alias("n_characters"),
    )


def cast_rows(films: DataFrame) -> DataFrame:
    """One row per appearance with its 1-based billing order and the actor's first position.

    The first position is found inside the row's own array: no shuffle.
    """
    ids = F.transform("cast", lambda c: c["id"])
    return films.select(
        F.col("id").alias("movie_id"), "title", ids.alias("ids"), F.posexplode("cast").alias("pos", "c")
    ).select(
        "movie_id",
        "title",
        (F.col("pos") + 1).cast("long").alias("billing_order"),
        F.col("c.id").alias("actor_id"),
        F.col("c.name").alias("actor_name"),
        F.col("c.character").alias("character"),
        F.array_position("ids", F.col("c.id")).cast("long").alias("first_order"),
    )


def role_iri() -> Column:
    """role/<movie>-<actor>; later appearances of the same pair carry their billing order."""
    plain = t.mint(t.RES + "role/", F.col("movie_id"), F.lit("-"), F.col("actor_id"))
    later = F.concat(plain, F.lit("-"), F.col("billing_order").cast("string"))
    return F.when(F.col("billing_order") == F.col("first_order"), plain).otherwise(later)


def role_label() -> Column:
    who = F.when(
        t.present(F.col("character")), F.concat(F.col("actor_name"), F.lit(" as "), F.col("character"))
    ).otherwise(F.col("actor_name"))
    return F.concat(who, F.lit(" in "), F.col("title"))


# --- mappings -----------------------------------------------------------------------------------


def minted(rules: list[Rule], prefix: str, key: str | None) -> list[Rule]:
    """The rules with what is known of their common subject."""
    return [replace(r, of=(prefix, key)) for r in rules]


def dimension_iri(kind: str, label: Column) -> Column:
    if kind == "genre":
        return t.mint(t.ONT + "genre_", slug(label, "_"))
    return t.mint(f"{t.ONT}{kind}/", slug(label))


def movie_map(films: DataFrame, unique: bool = True) -> TripleMap:
    """Movie nodes and their links. `unique` states that `id` is a key of `films`."""
    movie = t.mint(t.RES + "movie/", F.col("id"))
    rules = [
        Rule(movie, t.TYPE, t.iri(t.MOVIE)),
        Rule(movie, t.TITLE, t.text(F.col("title"))),
        Rule(movie, t.YEAR, t.integer(F.col("year").cast("long"))),
        Rule(
            movie, t.DIRECTOR, t.iri(t.mint(t.RES + "person/", F.col("director_id"))), t.present(F.col("director_id"))
        ),
    ]
    for kind, p in (("genre", t.GENRE), ("studio", t.STUDIO), ("country", t.COUNTRY)):
        rules.append(Rule(movie, p, t.iri(dimension_iri(kind, F.col(kind))), t.present(F.col(kind))))
    single = frozenset({(t.RES + "movie/", "id")} if unique else ())
    return TripleMap(films, minted(rules, t.RES + "movie/", "id"), unique, single)


def cast_map(cast: DataFrame, unique: bool = True) -> TripleMap:
    """Binary `starring` links and the role nodes that carry character and billing order."""
    movie = t.mint(t.RES + "movie/", F.col("movie_id"))
    actor = t.mint(t.RES + "person/", F.col("actor_id"))
    role = role_iri()
    first = F.col("billing_order") == F.col("first_order")
    of_movie = [Rule(movie, t.STARRING, t.iri(actor), first), Rule(movie, t.HAS_ROLE, t.iri(role))]
    of_role = [
        Rule(role, t.TYPE, t.iri(t.ONT + "CastRole")),
        Rule(role, t.ROLE_IN, t.iri(movie)),
        Rule(role, t.PLAYED_BY, t.iri(actor)),
        Rule(role, t.BILLING, t.integer(F.col("billing_order"))),
        Rule(role, t.LABEL, t.tagged(role_label(), "en")),
        Rule(role, t.CHARACTER, t.text(F.col("character")), t.present(F.col("character"))),
    ]
    rules = minted(of_movie, t.RES + "movie/", "movie_id") + minted(of_role, t.RES + "role/", None)
    return TripleMap(cast, rules, unique, frozenset({(t.RES + "role/", None)} if unique else ()))


def person_maps(films: DataFrame, cast: DataFrame) -> list[TripleMap]:
    """Directors and actors; people repeat over movies, so they are made distinct as short rows."""
    maps = []
    for cls, people in (
        ("Director", films.where(t.present(F.col("director_id"))).select(
            F.col("director_id").alias("pid"), F.col("director_name").alias("pname"))),
        ("Actor", cast.select(F.col("actor_id").alias("pid"), F.col("actor_name").alias("pname"))),
    ):
        person = t.mint(t.RES + "person/", F.col("pid"))
        rules = [
            Rule(person, t.TYPE, t.iri(t.PERSON)),
            Rule(person, t.TYPE, t.iri(t.ONT + cls)),
            Rule(person, t.NAME, t.text(F.col("pname"))),
        ]
        maps.append(TripleMap(people.distinct(), minted(rules, t.RES + "person/", "pid")))
    return maps


def dimension_map(films: DataFrame, kind: str) -> TripleMap:
    """Genre, studio or country nodes; labels with one slug share a node and all stay."""
    node = dimension_iri(kind, F.col("label"))
    rows = films.where(t.present(F.col(kind))).select(F.col(kind).alias("label")).distinct()
    rules = [
        Rule(node, t.TYPE, t.iri(t.ONT + kind.capitalize())),
        Rule(node, t.LABEL, t.tagged(F.col("label"), "en")),
    ]
    return TripleMap(rows, minted(rules, t.ONT + ("genre_" if kind == "genre" else f"{kind}/"), None))


def film_graph(films: DataFrame, cast: DataFrame, unique_ids: bool = False) -> MappedGraph:
    """The whole lift. With `unique_ids` the big part of the graph needs no shuffle at all."""
    return MappedGraph(
        [
            movie_map(films, unique_ids),
            cast_map(cast, unique_ids),
            *person_maps(films, cast),
            *(dimension_map(films, kind) for kind in ("genre", "studio", "country")),
        ]
    )


def award_map(winners: DataFrame, award: str, label: str) -> list[TripleMap]:
    """`hasAward` per winner (column `person`) and the award's own node."""
    node = F.lit(t.ONT + award)
    one = winners.sparkSession.range(1)
    about = [Rule(node, t.TYPE, t.iri(t.ONT + "Award")), Rule(node, t.LABEL, t.tagged(label, "en"))]
    return [
        TripleMap(winners, [Rule(F.col("person"), t.HAS_AWARD, t.iri(t.ONT + award))], True),
        TripleMap(one, minted(about, t.ONT + award, None), True),
    ]


def same_as_map(report: DataFrame) -> TripleMap:
    """`owl:sameAs` for every link of a link report."""
    return TripleMap(
        report,
        [
            Rule(F.col("uri"), t.SAME_AS, t.iri(F.col("wikidata")), t.present(F.col("wikidata"))),
            Rule(F.col("uri"), t.SAME_AS, t.iri(F.col("dbpedia")), t.present(F.col("dbpedia"))),
        ],
        True,
    )


# --- graph accessors ----------------------------------------------------------------------------


def subjects(graph, p: str, o: str) -> DataFrame:
    return graph.match(p).where((F.col("o") == o) & (F.col("o_kind") == "iri")).select("s").distinct()


def subject_objects(graph, p: str) -> DataFrame:
    return graph.match(p).select("s", "o")


def value(graph, p: str) -> DataFrame:
    """One object per subject; of several the smallest, so that every run agrees."""
    return graph.match(p).groupBy("s").agg(F.min("o").alias("o"))
