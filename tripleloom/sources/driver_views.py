"""The movie domain derived from the order tables.

An order is a movie, its customer the director, its lineitems the cast and its parts the
characters. Customers and suppliers share one id space, so a person can be both director and
actor. Outside authorities are derived from the same tables by fixed rules that leave gaps,
ambiguous ids, redirects and wrong classes; the rules are listed in FIXTURES.md.

Tables are joined on their numeric ids; IRIs are minted where they are asked for.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tripleloom.functions import terms as t
from tripleloom.operators import lift
from tripleloom.operators.clean import TOP_CAST, top_cast_rows
from tripleloom.operators.joins import KeySet, among
from tripleloom.operators.lift import MappedGraph, Rule, TripleMap
from tripleloom.operators.linking import link_report
from tripleloom.operators.ontology import axioms
from tripleloom.session import bounded_reads, bounded_shuffles, cut_lineage

# Genre labels are order priorities; these two stand behind the two defined movie classes.
ACTION, COMEDY = "1-URGENT", "5-LOW"

BILLING = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def every(n: int, key: Column) -> Column:
    return key % n == 0


def text_key(key: Column) -> Column:
    return key.cast("string")


def person_name(key: Column) -> Column:
    return F.concat(F.lit("Person "), text_key(key))


def movie_title(key: Column) -> Column:
    return F.concat(F.lit("Order "), text_key(key))


def movie_iri(key: Column) -> Column:
    return t.mint(t.RES + "movie/", key)


def person_iri(key: Column) -> Column:
    return t.mint(t.RES + "person/", key)


class DriverViews:
    """`top` is the number of cast rows kept per movie, as the clean step does; None keeps all."""

    def __init__(self, spark: SparkSession, folder: str, top: int | None = TOP_CAST):
        bounded_reads(spark)
        bounded_shuffles(spark, folder)
        self.spark, self.folder, self.top = spark, folder, top
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        """A scan of its own per use; the schema is read from the file once."""
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    # --- property tables ------------------------------------------------------------------------

    def movie(self, after: int | None = None, until: int | None = None) -> DataFrame:
        """(movie_id, title, year, director_id), from the orders alone; with bounds, of the years after `after`
        and up to `until`, as a range of dates that the scan can prune by."""
        rows, day = self.table("orders"), F.col("o_orderdate")
        if after is not None:
            rows = rows.where(day >= F.lit(f"{after + 1}-01-01").cast("timestamp"))
        if until is not None:
            rows = rows.where(day < F.lit(f"{until + 1}-01-01").cast("timestamp"))
        return rows.select(
            F.col("o_orderkey").alias("movie_id"),
            movie_title(F.col("o_orderkey")).alias("title"),
            F.year("o_orderdate").cast("long").alias("year"),
            F.col("o_custkey").alias("director_id"),
        )

    def films(self) -> DataFrame:
        """The cleaned movie record with its dimensions."""
        dims = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", "c_mktsegment", "n_name")
        return self.table("orders").join(dims, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("id"),
            movie_title(F.col("o_orderkey")).alias("title"),
            F.year("o_orderdate").cast("long").alias("year"),
            F.col("o_custkey").alias("director_id"),
            person_name(F.col("o_custkey")).alias("director_name"),
            F.col("o_orderpriority").alias("genre"),
            F.col("c_mktsegment").alias("studio"),
            F.col("n_name").alias("country"),
        )

    def genres(self) -> DataFrame:
        """(id, genre), from the orders alone."""
        return self.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("genre"))

    def billed(self, only: DataFrame | None = None) -> DataFrame:
        """(movie_id, actor_id, part_id, billing_order): the first-billed rows per movie, of all
        movies or of those in `only`."""
        rows = self.table("lineitem").select("l_orderkey", *BILLING)
        if only is not None:
            rows = rows.join(only.select(F.col("movie_id").alias("l_orderkey")), "l_orderkey", "left_semi")
        ranked = top_cast_rows(rows, "l_orderkey", [F.col(c) for c in BILLING], self.top)
        return ranked.select(
            F.col("l_orderkey").alias("movie_id"),
            F.col("l_suppkey").alias("actor_id"),
            F.col("l_partkey").alias("part_id"),
            F.col("rank").cast("long").alias("billing_order"),
        )

    def movies_with(self, people: KeySet) -> DataFrame:
        """(movie_id): the movies that name one of the people in a line, distinct."""
        lines = among(self.table("lineitem").select("l_orderkey", "l_suppkey"), "l_suppkey", people)
        return lines.select(F.col("l_orderkey").alias("movie_id")).distinct()

    def with_character(self, roles: DataFrame) -> DataFrame:
        parts = self.table("part").select(
            F.col("p_partkey").alias("part_id"),
            F.when(every(10, F.col("p_size")), "").otherwise(F.col("p_name")).alias("character"),
        )
        return roles.join(parts, "part_id").drop("part_id")

    def roles(self, only: DataFrame | None = None) -> DataFrame:
        """(movie_id, actor_id, billing_order, character): one row per appearance, a missing
        character unbound."""
        roles = self.with_character(self.billed(only=only))
        return roles.withColumn("character", F.nullif("character", F.lit("")))

    def starring(self, only: DataFrame | None = None) -> DataFrame:
        """(movie_id, actor_id), distinct."""
        return self.billed(only=only).select("movie_id", "actor_id").distinct()

    def cast_rows(self) -> DataFrame:
        """Appearances in the form the lift takes; an actor's first position is looked up among the rows of
        the movie, which the ranking has brought into one task."""
        first = F.min("billing_order").over(Window.partitionBy("movie_id", "actor_id"))
        roles = self.billed().withColumn("first_order", first)
        return self.with_character(roles).select(
            "movie_id",
            movie_title(F.col("movie_id")).alias("title"),
            "billing_order",
            "actor_id",
            person_name(F.col("actor_id")).alias("actor_name"),
            "character",
            "first_order",
        )

    def directors(self) -> DataFrame:
        """(director_id, name): the table of people who may direct."""
        key = F.col("c_custkey")
        return self.table("customer").select(key.alias("director_id"), person_name(key).alias("name"))

    def actors(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(key.alias("actor_id"), person_name(key).alias("actor"))

    def people(self) -> DataFrame:
        """(id): everyone who directs or acts."""
        return (
            self.table("orders").select(F.col("o_custkey").alias("id"))
            .unionByName(self.billed().select(F.col("actor_id").alias("id"))).distinct()
        )

    # --- keys to link ---------------------------------------------------------------------------

    def movie_keys(self, only: KeySet | None = None) -> DataFrame:
        key, rows = F.col("o_orderkey"), self.table("orders")
        return (rows if only is None else among(rows, "o_orderkey", only)).select(
            F.lit("movie").alias("kind"), text_key(key).alias("id"), movie_iri(key).alias("uri"),
            movie_title(key).alias("label"),
        )

    def person_keys(self, people: DataFrame | None = None) -> DataFrame:
        key = F.col("id")
        return (self.people() if people is None else people).select(
            F.lit("person").alias("kind"), text_key(key).alias("id"), person_iri(key).alias("uri"),
            person_name(key).alias("label"),
        )

    def keys(self) -> DataFrame:
        return self.movie_keys().unionByName(self.person_keys())

    # --- authorities ----------------------------------------------------------------------------

    def known_people(self) -> DataFrame:
        """(k, nation): the people the authorities know about."""
        own = self.table("customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"))
        other = self.table("supplier").select(F.col("s_suppkey").alias("k"))
        only = other.join(own.select("k"), "k", "left_anti").withColumn("nation", F.lit(None).cast("int"))
        return own.unionByName(only)

    def person_items(self) -> DataFrame:
        k = F.col("k")
        second = F.when(k % 50 == 1, t.mint(t.WD + "Q", k, F.lit("b")))
        return (
            self.known_people().where(~every(37, k))
            .select("k", F.explode(F.array_compact(F.array(t.mint(t.WD + "Q", k), second))).alias("item"))
            .select(
                "item", F.lit("P4985").alias("id_property"), text_key(k).alias("id_value"),
                F.when(~every(11, k), t.mint(t.ENWIKI + "Person_", k)).alias("article"),
            )
        )

    def movie_items(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.table("orders").where(~every(37, k)).select(
            t.mint(t.WD + "F", k).alias("item"), F.lit("P4947").alias("id_property"),
            text_key(k).alias("id_value"), t.mint(t.ENWIKI + "Order_", k).alias("article"),
        )

    def items(self) -> DataFrame:
        return self.movie_items().unionByName(self.person_items())

    def person_same(self) -> DataFrame:
        k = F.col("k")

        def row(when: Column, res: Column, cls: str = "Person", target: Column | None = None) -> Column:
            return F.when(
                when,
                F.struct(
                    res.alias("res"), F.lit(cls).alias("class"),
                    (F.lit(None).cast("string") if target is None else target).alias("redirect_target"),
                ),
            )

        named = t.mint(t.DBR + "Person_", k)
        encoded = t.mint(t.DBR + "Person%5F", k)
        rows = F.array(
            row(~every(5, k), F.when(every(3, k), encoded).otherwise(named)),
            row(every(5, k), t.mint(t.DBR + "Person_", k, F.lit("_(old)"))),
            row(every(10, k), t.mint(t.DBR + "Other_", k)),
            row(every(4, k), t.mint(t.DBR + "Soundtrack_", k), "Work"),
            row(every(6, k), t.mint("http://fr.dbpedia.org/resource/Person_", k)),
            row(every(7, k), t.mint(t.DBR + "Redir_", k), target=named),
            row(every(13, k), t.mint(t.DBR + "Merged_", k), target=F.lit(t.DBR + "Someone_else")),
        )
        return (
            self.known_people()
            .select(t.mint(t.WD + "Q", k).alias("item"), F.explode(F.array_compact(rows)).alias("r"))
            .select("r.res", "item", "r.class", "r.redirect_target")
        )

    def movie_same(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.table("orders").where(~every(37, k)).select(
            t.mint(t.DBR + "Order_", k).alias("res"), t.mint(t.WD + "F", k).alias("item"),
            F.lit("Film").alias("class"), F.lit(None).cast("string").alias("redirect_target"),
        )

    def same(self) -> DataFrame:
        return self.movie_same().unionByName(self.person_same())

    @cached_property
    def wikidata(self) -> MappedGraph:
        """Facts of the first authority."""
        k, n = F.col("k"), F.col("n_nationkey")
        people = self.known_people()
        item = t.mint(t.WD + "Q", k)
        born = F.date_add(F.to_date(F.lit("1940-01-01")), ((k * 37) % 20000).cast("int"))

        def moment(day: Column) -> t.Term:
            return t.typed(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z")), t.XSD_DATETIME)

        unknown = t.mint("http://www.wikidata.org/.well-known/genid/", k)
        place = t.mint(t.WD + "N", F.col("nation"))
        birth = [
            Rule(item, t.WDT + "P569", moment(born), ~every(23, k)),
            Rule(item, t.WDT + "P569", moment(F.date_add(born, 400)), every(9, k)),
            Rule(item, t.WDT + "P569", t.iri(unknown), every(23, k)),
            Rule(item, t.WDT + "P19", t.iri(place), ~every(7, k) & F.col("nation").isNotNull()),
        ]
        nation = t.mint(t.WD + "N", n)
        labels = [
            Rule(nation, t.LABEL, t.tagged(F.col("n_name"), "en")),
            Rule(nation, t.LABEL, t.tagged(F.concat(F.lit("le "), F.col("n_name")), "fr")),
        ]
        shown = [Rule(t.mint(t.WD + "F", F.col("l_orderkey")), t.WDT + "P577", moment(F.col("l_shipdate")))]
        holders = self.table("customer").where(F.col("c_acctbal") > 9000)
        award = [Rule(t.mint(t.WD + "Q", F.col("c_custkey")), t.WDT + "P166", t.iri(t.WD + "Q103360"))]
        return MappedGraph(
            [
                TripleMap(people, lift.minted(birth, t.WD + "Q", "k"), True),
                TripleMap(self.table("nation"), labels, True),
                TripleMap(self.table("lineitem").select("l_orderkey", "l_shipdate"), shown),
                TripleMap(holders, award, True),
            ]
        )

    @cached_property
    def dbpedia(self) -> MappedGraph:
        """Facts of the second authority. A document is the abstract of fifteen movies."""
        k, o = F.col("k"), F.col("o_orderkey")
        named = F.array_compact(
            F.array(
                t.mint(t.DBR + "Person_", k),
                F.when(every(3, k), t.mint(t.DBR + "Person%5F", k)),
                F.when(every(5, k), t.mint(t.DBR + "Person_", k, F.lit("_(old)"))),
            )
        )
        people = self.known_people().join(
            self.table("nation"), F.col("nation") == F.col("n_nationkey"), "left"
        ).select("k", "n_name", F.explode(named).alias("res"))
        born = F.date_add(F.to_date(F.lit("1940-01-01")), ((k * 37) % 20000).cast("int"))
        placed = ~every(7, k) & F.col("n_name").isNotNull()
        person = [
            Rule(F.col("res"), t.DBO + "birthDate", t.typed(F.date_format(born, "yyyy-MM-dd"), t.XSD_DATE), ~every(8, k)),
            Rule(F.col("res"), t.DBO + "birthDate", t.typed(F.year(born), t.XSD_GYEAR), every(8, k)),
            Rule(F.col("res"), t.DBO + "birthPlace", t.iri(t.mint(t.DBR, F.col("n_name"))), placed),
            Rule(F.col("res"), t.DBP + "birthPlace", t.text(F.col("n_name")), placed),
        ]
        film = t.mint(t.DBR + "Order_", o)
        double = t.XSD + "double"
        facts = [
            Rule(film, t.LABEL, t.tagged(movie_title(o), "en")),
            Rule(film, t.LABEL, t.tagged(F.concat(F.lit("Commande "), text_key(o)), "fr")),
            Rule(film, t.DBO + "budget", t.typed(F.col("o_totalprice"), double), ~every(3, o)),
            Rule(film, t.DBO + "gross", t.typed(F.col("o_totalprice") * 2, double), ~every(4, o)),
            Rule(
                film, t.DBO + "wikiPageRedirects", t.iri(t.mint(t.DBR + "Order_", o, F.lit("_(film)"))),
                every(20, o),
            ),
        ]
        orders = self.table("orders")
        told = orders.select("o_orderkey", F.floor(o / 15).alias("doc_id")).join(
            self.table("documents").select("doc_id", "text", "lang"), "doc_id"
        )
        abstracts = [Rule(film, t.DBO + "abstract", t.tagged(F.col("text"), F.col("lang")))]
        return MappedGraph(
            [
                TripleMap(people, lift.minted(person, t.DBR + "Person", None)),
                TripleMap(orders, lift.minted(facts, t.DBR + "Order_", "o_orderkey"), True),
                TripleMap(told, lift.minted(abstracts, t.DBR + "Order_", "o_orderkey"), True),
            ]
        )

    # --- graphs ---------------------------------------------------------------------------------

    @cached_property
    def graph(self) -> MappedGraph:
        """The lifted movie graph."""
        return lift.film_graph(self.films(), self.cast_rows(), unique_ids=True)

    @cached_property
    def gappy_graph(self) -> MappedGraph:
        """`with_gaps` over stored tables, for questions that read it several times."""
        return self.with_gaps(cut_lineage(self.films()), cut_lineage(self.cast_rows()))

    def with_gaps(self, films: DataFrame, cast: DataFrame) -> MappedGraph:
        """The lifted graph with statements left out that rules can restore: `hasCastRole` of every 19th movie
        and `starring` of every 17th."""
        left_out = {t.HAS_ROLE: 19, t.STARRING: 17}
        maps = []
        for m in lift.film_graph(films, cast, unique_ids=True).maps:
            rules = []
            for rule in m.rules:
                if rule.p in left_out:
                    there = ~every(left_out[rule.p], F.col("movie_id"))
                    rule = replace(rule, when=there if rule.when is None else rule.when & there)
                rules.append(rule)
            maps.append(replace(m, rules=rules))
        return MappedGraph(maps)

    @cached_property
    def stored_graph(self) -> MappedGraph:
        """The same graph over the two property tables written once, for uses that read it many
        times: a tenth of the size of its triples, and every predicate is a narrow scan."""
        return lift.film_graph(cut_lineage(self.films()), cut_lineage(self.cast_rows()), unique_ids=True)

    def report(self) -> DataFrame:
        """Link report over all movies and people."""
        return link_report(self.keys(), self.items(), self.same())

    @cached_property
    def stored_report(self) -> DataFrame:
        """The link report written once; links and awards are read from it."""
        return cut_lineage(self.report())

    @cached_property
    def axioms(self) -> DataFrame:
        return axioms(self.spark, ACTION, COMEDY)
