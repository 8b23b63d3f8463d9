"""Selection and cleaning of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tripleloom.functions import text as x

# Fixed values of the selection.
MIN_VOTES = 1000
LIMIT = 250
TOP_CAST = 3
FIELDS = [
    "id", "title", "year", "release_date", "runtime", "director_id", "director_name",
    "genre", "genres", "cast_ids", "cast_names", "cast_characters", "studio", "country",
]

_S, _L = T.StringType(), T.LongType()
CAST = T.ArrayType(
    T.StructType([T.StructField(n, k) for n, k in (("id", _S), ("name", _S), ("character", _S), ("order", _L))])
)
CREW = T.ArrayType(T.StructType([T.StructField(n, _S) for n in ("id", "name", "job")]))


def top_cast_of_cell(cast: Column, top: int = TOP_CAST) -> Column:
    """First `top` entries by `order`; equal orders keep their place in the list."""
    placed = F.transform(
        cast,
        lambda c, at: F.struct(
            c["order"].alias("order"), at.alias("at"), c["id"].alias("id"), c["name"].alias("name"),
            c["character"].alias("character"),
        ),
    )
    return F.transform(
        F.slice(F.array_sort(placed), 1, top),
        lambda c: F.struct(
            c["id"].alias("id"), x.strip(c["name"]).alias("name"), x.character_name(c["character"]).alias("character")
        ),
    )


def directors_of_cell(crew: Column) -> Column:
    return F.filter(crew, lambda c: c["job"] == "Director")


def top_cast_rows(
    rows: DataFrame, movie: str, order: list[Column], top: int | None = TOP_CAST
) -> DataFrame:
    """Relational form of the same rule: the first `top` rows per movie (None: all), numbered from 1.

    The rank filter lets Spark cut every map task's groups to `top` rows before the shuffle, so a
    movie with a large part of all rows stays small.
    """
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(movie).orderBy(*order)))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def compact_credits(credits: DataFrame, strict: bool = True) -> DataFrame:
    """Per movie id the last credits row (column `ordinal`), cut to first director and top cast.

    The JSON is read before the shuffle, so that it moves a few names instead of whole cells.
    """
    short = credits.select(
        F.col("movie_id").alias("id"),
        "ordinal",
        F.try_element_at(directors_of_cell(x.json_cell("crew", CREW, strict)), F.lit(1)).alias("director"),
        top_cast_of_cell(x.json_cell("cast", CAST, strict)).alias("cast"),
    )
    last = short.groupBy("id").agg(F.max_by(F.struct("director", "cast"), "ordinal").alias("last"))
    return last.select("id", "last.director", "last.cast")


def clean_movies(
    movies: DataFrame,
    credits: DataFrame,
    min_votes: int = MIN_VOTES,
    limit: int | None = LIMIT,
    strict: bool = True,
) -> DataFrame:
    """The cleaned 14-column movie table, best rated first.

    Both inputs are all text and carry `ordinal`, their place in the input. Movies without credits,
    title, release date or director are dropped before the cut at `limit`.
    """
    chosen = movies.where(F.col("vote_count").cast("long") >= min_votes).where(
        (F.coalesce("title", F.lit("")) != "") & (F.coalesce("release_date", F.lit("")) != "")
    )
    # credits of other movies are left out before their cells are parsed
    own = credits.join(chosen.select(F.col("id").alias("movie_id")).distinct(), "movie_id", "left_semi")
    joined = chosen.join(compact_credits(own, strict), "id").where(F.col("director").isNotNull())
    best = joined.orderBy(
        F.desc(F.col("vote_average").cast("double")), F.desc(F.col("vote_count").cast("long")), F.asc("ordinal")
    )
    if limit is not None:
        best = best.limit(limit)
    genres = x.json_names("genres", strict)

    def joined_list(field: str) -> Column:
        return F.array_join(F.transform("cast", lambda c: c[field]), "|")

    return best.select(
        "id",
        x.strip(F.col("title")).alias("title"),
        x.year_of_date_text(F.col("release_date")).alias("year"),
        "release_date",
        x.whole_part(F.col("runtime")).alias("runtime"),
        F.col("director.id").alias("director_id"),
        x.strip(F.col("director.name")).alias("director_name"),
        x.first_or_blank(genres).alias("genre"),
        F.array_join(genres, "|").alias("genres"),
        joined_list("id").alias("cast_ids"),
        joined_list("name").alias("cast_names"),
        joined_list("character").alias("cast_characters"),
        x.first_or_blank(x.json_names("production_companies", strict)).alias("studio"),
        x.first_or_blank(x.json_names("production_countries", strict)).alias("country"),
    )
