"""The stored queries that look things up in outside authorities.

A remote call per row becomes one join with the extract. Facts are reduced to one row per subject
before the join wherever the question aggregates them anyway; queries that show every value keep
the multiplication. A question that starts from one name finds its few IRIs first and writes them
once (`key_set`); they filter every extract it needs. One about all movies aggregates the extract first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripleloom.functions import terms as t
from tripleloom.functions.text import name_of_resource, year_value
from tripleloom.operators.joins import KeySet, among, bind_join, key_set, regroup
from tripleloom.operators.linking import link, link_by_id, sharing
from tripleloom.operators.lift import MappedGraph, union_all
from tripleloom.plans.graph_queries import DIRECTOR, FILM, YEAR
from tripleloom.session import cut_lineage
from tripleloom.sources.driver_views import DriverViews

WITHOUT_PLACE = "Person 7"
PROBE = t.DBR + "Order_42"


def english(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("o_lang") == "en")


def number(x: str = "o") -> Column:
    return F.col(x).try_cast("double")


def concat_distinct(lists: str) -> Column:
    """All distinct texts of the group's lists in a fixed order, as one cell."""
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(lists)))), ", ")


def item_of(v: DriverViews, people: DataFrame, narrow: bool = True) -> DataFrame:
    """(id, item) of people given as (id)."""
    return link_by_id(v.person_keys(people), v.person_items(), narrow).select(F.col("id").cast("long"), "item")


def linked_to(keys: DataFrame, items: DataFrame, same: DataFrame) -> KeySet:
    """What a handful of keys is linked to."""
    return key_set(link(keys, items, same, narrow=True), "dbpedia")


def movies_of_director(v: DriverViews) -> KeySet:
    who = key_set(v.directors().where(F.col("name") == DIRECTOR), "director_id")
    return key_set(among(v.movie(), "director_id", who), "movie_id")


def seen_by_director(v: DriverViews) -> tuple[KeySet, DataFrame]:
    """The linked IRIs of the director's movies, and every local movie that shares one of them."""
    keys, items, same = v.movie_keys(), v.movie_items(), v.movie_same()
    seeds = linked_to(v.movie_keys(movies_of_director(v)), items, same)
    back = cut_lineage(sharing(seeds, keys, items, same).select(F.col("id").cast("long").alias("movie_id"), "dbp"))
    shared = among(v.movie(), "movie_id", key_set(back, "movie_id"))
    return seeds, back.join(shared, "movie_id").select("dbp", "title", "year")


def of_seeds(facts: MappedGraph, p: str, seeds: KeySet) -> DataFrame:
    """The facts of one predicate about the seeds, with the subject as `dbp`."""
    return facts.match_among(p, seeds).withColumnRenamed("s", "dbp")


def director_birth(v: DriverViews) -> DataFrame:
    who = v.directors().where(F.col("name").isin(DIRECTOR, WITHOUT_PLACE))
    items = cut_lineage(item_of(v, who.select(F.col("director_id").alias("id"))))
    own = key_set(items, "item")
    facts = v.wikidata
    labels = english(facts.match(t.LABEL)).select(F.col("s").alias("place"), F.col("o").alias("birthPlace"))
    dates = (
        bind_join(items, facts.match_among(t.WDT + "P569", own), "item", "born")
        .groupBy("id", "item").agg(F.collect_set(F.substring("born", 1, 10)).alias("dates"))
    )
    # the label filter belongs to the optional part: places without an English label do not count
    places = (
        bind_join(items, facts.match_among(t.WDT + "P19", own), "item", "place").join(labels, "place")
        .groupBy("id").agg(F.collect_set("birthPlace").alias("places"))
    )
    known = dates.join(places, "id", "left").withColumn(
        "places", F.coalesce("places", F.array(F.lit("(unknown)")))
    ).join(who, F.col("id") == F.col("director_id"))
    return (
        among(v.movie(), "director_id", key_set(items, "id")).join(known.drop("id", "item"), "director_id")
        .groupBy("name", "title", "year")
        .agg(concat_distinct("dates").alias("birthDates"), concat_distinct("places").alias("birthPlaces"))
        .select("name", "birthDates", "birthPlaces", "title", "year").orderBy("year", "title", "name")
    )


def director_age_at_first(v: DriverViews) -> DataFrame:
    busy = (
        v.movie().groupBy("director_id")
        .agg(F.count(F.lit(1)).alias("movies"), F.min("year").alias("firstYear")).where(F.col("movies") >= 6)
    )
    items = item_of(v, busy.select(F.col("director_id").alias("id")), narrow=False)
    local = busy.join(v.directors(), "director_id").join(items.withColumnRenamed("id", "director_id"), "director_id")
    return (
        bind_join(local, v.wikidata.match(t.WDT + "P569"), "item", "birthDate")
        .select(
            "name", "movies", "firstYear", "birthDate",
            (F.col("firstYear") - year_value(F.col("birthDate"))).alias("ageAtFirstMovie"),
        )
        .orderBy(F.desc("movies"), "name", "birthDate")
    )


def cast_age(v: DriverViews) -> DataFrame:
    film = v.movie().where(F.col("title") == FILM)
    cast = cut_lineage(v.starring(only=film.select("movie_id")).join(film, "movie_id").join(v.actors(), "actor_id"))
    items = cut_lineage(item_of(v, cast.select(F.col("actor_id").alias("id")).distinct()))
    born = v.wikidata.match_among(t.WDT + "P569", key_set(items, "item"))
    return (
        bind_join(cast.join(items.withColumnRenamed("id", "actor_id"), "actor_id"), born, "item", "birthDate")
        .select("title", "actor", "birthDate", (F.col("year") - year_value(F.col("birthDate"))).alias("ageAtRelease"))
        .orderBy(F.desc("ageAtRelease"), "actor", "birthDate")
    )


def budget_and_gross(v: DriverViews) -> DataFrame:
    seeds, back = seen_by_director(v)
    facts = v.dbpedia

    def largest(p: str, name: str) -> DataFrame:
        return regroup(of_seeds(facts, p, seeds).groupBy("dbp").agg(F.max(number()).alias(name)), ["dbp"])

    labels = english(of_seeds(facts, t.LABEL, seeds)).select("dbp", F.col("o").alias("label"))
    remote = (
        labels.join(largest(t.DBO + "budget", "budget"), "dbp", "left")
        .join(largest(t.DBO + "gross", "gross"), "dbp", "left")
    )
    return (
        back.join(remote, "dbp").groupBy("title", "year", "label")
        .agg(F.max("budget").alias("maxBudget"), F.max("gross").alias("maxGross")).orderBy("year", "title", "label")
    )


def year_check(v: DriverViews) -> DataFrame:
    chosen = v.movie(after=YEAR - 1, until=YEAR)
    keys = chosen.select(F.lit("movie").alias("kind"), F.col("movie_id").cast("string").alias("id"), "title", "year")
    linked = link_by_id(keys, v.movie_items(), narrow=True)
    first = (
        v.wikidata.match(t.WDT + "P577", as_bag=True).withColumnRenamed("s", "item")
        .join(linked.select("item").distinct(), "item", "left_semi").groupBy("item")
        .agg(F.min(year_value(F.col("o"))).alias("wikidataYear"))
    )
    return (
        linked.join(first, "item").groupBy("id", "title", "year").agg(F.min("wikidataYear").alias("wikidataYear"))
        .orderBy("title", "id").select("title", "year", "wikidataYear")
    )


def endpoint_probe(v: DriverViews) -> DataFrame:
    facts = v.dbpedia

    def of(p: str, name: str) -> DataFrame:
        return facts.match(p, subject=PROBE).select("s", number().alias(name))

    labels = english(facts.match(t.LABEL, subject=PROBE)).select("s", F.col("o").alias("label"))
    return (
        labels.join(of(t.DBO + "budget", "budget"), "s", "left").join(of(t.DBO + "gross", "gross"), "s", "left")
        .select("label", "budget", "gross")
    )


def links_exist(v: DriverViews) -> DataFrame:
    seeds, back = seen_by_director(v)
    facts = v.dbpedia
    named = english(of_seeds(facts, t.LABEL, seeds)).select("dbp", F.col("o").alias("label"))
    moved = of_seeds(facts, t.DBO + "wikiPageRedirects", seeds).select("dbp", F.col("o").alias("redirectsTo"))
    remote = named.unionByName(moved, allowMissingColumns=True)
    return (
        back.join(remote, "dbp").select("title", "year", "label", "redirectsTo")
        .orderBy("year", "title", "label", "redirectsTo")
    )


def abstracts(v: DriverViews) -> DataFrame:
    seeds, back = seen_by_director(v)
    told = english(of_seeds(v.dbpedia, t.DBO + "abstract", seeds)).select("dbp", F.col("o").alias("abstract"))
    return (
        back.join(told, "dbp")
        .select("title", "year", F.substring("abstract", 1, 150).alias("start")).orderBy("year", "title", "start")
    )


def cast_birth_year(v: DriverViews) -> DataFrame:
    film = v.movie().where(F.col("title") == FILM)
    starring = cut_lineage(v.starring(only=film.select("movie_id")))
    items, same = v.person_items(), v.person_same()
    cast = v.person_keys(starring.select(F.col("actor_id").alias("id")).distinct())
    seeds = linked_to(cast, items, same)
    dates = of_seeds(v.dbpedia, t.DBO + "birthDate", seeds).where(F.col("o_dt") == t.XSD_DATE)
    born = regroup(dates.groupBy("dbp").agg(F.min(year_value(F.col("o"))).alias("born")), ["dbp"])
    links = sharing(seeds, cast, items, same).select(F.col("id").cast("long").alias("actor_id"), "dbp")
    back = links.join(born, "dbp").join(v.actors(), "actor_id").join(starring, "actor_id").join(film, "movie_id")
    return (
        back.groupBy("title", "actor", "year").agg(F.min("born").alias("birthYear"))
        .select("title", "actor", "birthYear", (F.col("year") - F.col("birthYear")).alias("ageAtRelease"))
        .orderBy(F.desc("ageAtRelease"), "actor")
    )


def birthplaces(v: DriverViews) -> DataFrame:
    keys, items, same = v.person_keys(), v.person_items(), v.person_same()
    seeds = linked_to(keys.where(F.col("label") == DIRECTOR), items, same)
    links = cut_lineage(sharing(seeds, keys, items, same))
    names = among(keys, "id", key_set(links, "id")).select("id", F.col("label").alias("name"))
    facts = v.dbpedia
    places = union_all([of_seeds(facts, p, seeds) for p in (t.DBO + "birthPlace", t.DBP + "birthPlace")])
    found = places.select("dbp", name_of_resource(F.col("o"), F.col("o_kind"), t.DBR).alias("place")).distinct()
    return (
        links.join(found, "dbp").join(names, "id").select("name", "place").distinct()
        .groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("place")), ", ").alias("birthPlaces"))
    )
