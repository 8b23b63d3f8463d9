"""The stored queries over local data, on property tables.

Where the question groups by a name, rows are counted by id first, so that the join to the names
meets one row per person and not the rows of a person with very many movies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripleloom.operators.linking import link
from tripleloom.sources.driver_views import DriverViews

DIRECTOR, ACTOR, FILM, YEAR = "Person 9", "Person 5", "Order 42", 1999


def _n(alias: str):
    return F.count(F.lit(1)).alias(alias)


def movies_by_director(v: DriverViews) -> DataFrame:
    return v.movie().join(v.directors().where(F.col("name") == DIRECTOR), "director_id").select("title")


def movies_after_year(v: DriverViews) -> DataFrame:
    return v.movie(after=YEAR).select("title", "year")


def top_directors_by_name(v: DriverViews) -> DataFrame:
    counted = v.movie().groupBy("director_id").agg(_n("movies"))
    named = counted.join(v.directors(), "director_id").groupBy(F.col("name").alias("directorName"))
    return named.agg(F.sum("movies").alias("movieCount")).orderBy(F.desc("movieCount"), "directorName").limit(5)


def movies_linked(v: DriverViews) -> DataFrame:
    linked = link(v.movie_keys(), v.movie_items(), v.movie_same())
    return linked.where(F.col("dbpedia").isNotNull()).select(
        F.col("label").alias("title"), F.col("dbpedia").alias("dbpediaResource")
    )


def movies_with_actor(v: DriverViews) -> DataFrame:
    wanted = v.actors().where(F.col("actor") == ACTOR).select("actor_id")
    return v.movie().join(v.starring().join(wanted, "actor_id"), "movie_id").select("title")


def cast_of_movie(v: DriverViews) -> DataFrame:
    film = v.movie().where(F.col("title") == FILM).select("movie_id")
    return (
        v.roles(only=film).join(v.actors(), "actor_id")
        .select(F.col("billing_order").alias("order"), "actor", "character").orderBy("order")
    )


def roles_of_actor(v: DriverViews) -> DataFrame:
    wanted = v.actors().where(F.col("actor") == ACTOR).select("actor_id")
    return (
        v.roles().join(wanted, "actor_id").join(v.movie(), "movie_id")
        .select("year", "title", "character", F.col("billing_order").alias("order"))
        .orderBy("year", "title", "order")
    )


def shared_characters(v: DriverViews) -> DataFrame:
    pairs = (
        v.roles().where(F.col("character").isNotNull()).groupBy("character", "actor_id").agg(_n("roles"))
        .join(v.actors(), "actor_id")
        .groupBy("character", "actor").agg(F.sum("roles").alias("roles"), _n("ids"))
    )
    return (
        pairs.groupBy("character")
        .agg(
            F.sum("roles").alias("movies"),
            F.sum("ids").alias("actors"),
            # the cell is the answer itself: each distinct name once
            F.array_join(F.array_sort(F.collect_list("actor")), ", ").alias("playedBy"),
        )
        .where(F.col("movies") > 1).orderBy(F.desc("movies"), "character")
    )


def top_billed(v: DriverViews) -> DataFrame:
    counted = DriverViews(v.spark, v.folder, top=1).billed().groupBy("actor_id").agg(_n("times"))
    named = counted.join(v.actors(), "actor_id").groupBy("actor").agg(F.sum("times").alias("timesTopBilled"))
    return named.orderBy(F.desc("timesTopBilled"), "actor").limit(10)


def directors_in_own_movie(v: DriverViews) -> DataFrame:
    own = v.movie().withColumnRenamed("director_id", "actor_id")
    return (
        v.roles().join(own, ["movie_id", "actor_id"]).join(v.directors().withColumnRenamed("director_id", "actor_id"), "actor_id")
        .select("name", "title", "year", "character", F.col("billing_order").alias("order"))
        .orderBy("name", "year", "title", "order")
    )


def role_consistency(v: DriverViews) -> DataFrame:
    """Both counts from one aggregation over (movie, actor): no anti-joins and no cross join."""
    starring = v.starring().select("movie_id", "actor_id", F.lit(1).alias("side"), F.lit(0).alias("roles"))
    roles = v.billed().select("movie_id", "actor_id", F.lit(2).alias("side"), F.lit(1).alias("roles"))
    pairs = starring.unionByName(roles).groupBy("movie_id", "actor_id").agg(
        F.bit_or("side").alias("side"), F.sum("roles").alias("roles")
    )
    return pairs.agg(
        F.count_if(F.col("side") == 1).alias("starringWithoutRole"),
        F.coalesce(F.sum(F.when(F.col("side") == 2, F.col("roles"))), F.lit(0)).alias("roleWithoutStarring"),
    )
