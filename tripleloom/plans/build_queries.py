"""Named queries over cleaning, lifting, patterns and linking."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripleloom.functions import terms as t
from tripleloom.operators import lift, linking, patterns
from tripleloom.operators.clean import CREW, clean_movies, directors_of_cell
from tripleloom.functions.text import json_cell, slug, strip
from tripleloom.operators.joins import among, key_set
from tripleloom.operators.lift import MappedGraph
from tripleloom.plans.federated_queries import english
from tripleloom.plans.graph_queries import DIRECTOR, FILM
from tripleloom.session import cut_lineage, new_table_path
from tripleloom.sources.authority import award_claims
from tripleloom.sources.driver_views import (
    DriverViews, every, movie_iri, movie_title, person_iri, person_name, text_key,
)
from tripleloom.sources.tabular import read_clean_movies, read_csv, read_link_report, result_table, write_csv
from tripleloom.sources.triples_io import load_graph, read_ntriples, write_ntriples

MIN_VOTES = 4


# --- raw tables as the cleaning step takes them ---------------------------------------------------


def raw_movies(v: DriverViews) -> DataFrame:
    votes = v.table("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("votes"))
    dims = v.table("customer").join(v.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("o_orderkey")

    def named(x: str):
        return F.to_json(F.array(F.struct(F.col(x).alias("name"))))

    return (
        v.table("orders").join(votes, key == F.col("l_orderkey"))
        .join(dims, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            text_key(key).alias("id"),
            movie_title(key).alias("title"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
            F.concat(text_key(key % 180), F.lit(".0")).alias("runtime"),
            text_key(F.col("votes")).alias("vote_count"),
            text_key(F.floor(F.col("o_totalprice") / 50000)).alias("vote_average"),
            named("o_orderpriority").alias("genres"),
            named("c_mktsegment").alias("production_companies"),
            named("n_name").alias("production_countries"),
            key.alias("ordinal"),
        )
    )


def crew_cells(v: DriverViews) -> DataFrame:
    """(movie_id, crew): the customer directs, the next one writes; some movies have no director."""
    key, who = F.col("o_orderkey"), F.col("o_custkey")

    def entry(person, job):
        return F.struct(person.alias("id"), person_name(person).alias("name"), job.alias("job"))

    job = F.when(every(97, key), "Producer").otherwise("Director")
    return v.table("orders").select(
        key.alias("movie_id"), F.to_json(F.array(entry(who + 1, F.lit("Writer")), entry(who, job))).alias("crew")
    )


def raw_credits(v: DriverViews) -> DataFrame:
    """Credits cells; a cast cell lists all rows of a movie, the last one first."""
    row = F.struct(
        F.col("billing_order").alias("order"), F.col("actor_id").alias("id"),
        person_name(F.col("actor_id")).alias("name"), "character",
    )
    cells = DriverViews(v.spark, v.folder, top=None).roles().groupBy("movie_id").agg(
        F.to_json(F.reverse(F.array_sort(F.collect_list(row)))).alias("cast")
    )
    return crew_cells(v).join(cells, "movie_id", "left").select(
        text_key(F.col("movie_id")).alias("movie_id"), F.coalesce("cast", F.lit("[]")).alias("cast"), "crew",
        F.col("movie_id").alias("ordinal"),
    )


def clean_top_rated(v: DriverViews) -> DataFrame:
    return clean_movies(raw_movies(v), raw_credits(v), min_votes=MIN_VOTES)


def clean_through_csv(v: DriverViews) -> DataFrame:
    """Movies and credits as CSV files, cleaned, and the clean table as a file that the lift reads.

    The credits come in two files. The first one has the next customer as director of every movie, the second one is
    right; of several credits of a movie the last one counts. The files repeat their words, so they are compressed, and
    the cells that both credits files hold are made once.
    """
    folder = new_table_path(v.spark)
    right = cut_lineage(raw_credits(v).drop("ordinal"))
    who = F.get_json_object("crew", "$[0]")
    write_csv(raw_movies(v).drop("ordinal"), f"{folder}/movies", compression="gzip")
    write_csv(right.withColumn("crew", F.concat(F.lit("["), F.replace(who, F.lit("Writer"), F.lit("Director")), F.lit("]"))), f"{folder}/credits/a", compression="gzip")
    write_csv(right, f"{folder}/credits/b", compression="gzip")
    movies = read_csv(v.spark, f"{folder}/movies", ordinal=True, line_breaks=False)
    credits = read_csv(v.spark, [f"{folder}/credits/a", f"{folder}/credits/b"], ordinal=True, line_breaks=False)
    write_csv(clean_movies(movies, credits, min_votes=MIN_VOTES, limit=None), f"{folder}/clean", compression="gzip")
    films = lift.split_cast(read_clean_movies(v.spark, f"{folder}/clean"))
    entries = F.transform("cast", lambda c: F.concat(c["id"], F.lit(" as "), c["character"]))
    return films.select("id", "title", "year", "director_id", "director_name", "genre", F.array_join(entries, "|").alias("cast"))


def clean_top_cast(v: DriverViews) -> DataFrame:
    return v.billed().select("movie_id", "billing_order", "actor_id", "part_id")


def clean_crew_json(v: DriverViews) -> DataFrame:
    found = directors_of_cell(json_cell(F.col("crew"), CREW))
    return (
        crew_cells(v).select("movie_id", F.try_element_at(found, F.lit(1)).alias("d"))
        .where(F.col("d").isNotNull())
        .select("movie_id", F.col("d.id").alias("director_id"), strip(F.col("d.name")).alias("director_name"))
    )


# --- lift ---------------------------------------------------------------------------------------


def lift_triples(v: DriverViews) -> DataFrame:
    return v.graph.triples().groupBy("p").agg(
        F.count(F.lit(1)).alias("triples"),
        F.count_if(F.col("o_kind") == "iri").alias("iris"),
        F.count_if(F.col("o_lang") != "").alias("tagged"),
    )


def lift_dimensions(v: DriverViews) -> DataFrame:
    parts = v.table("part").select(F.col("p_name").alias("label"))
    brands = v.table("part").select(F.col("p_brand").alias("label"))
    genres = v.table("orders").select(F.col("o_orderpriority").alias("label"))
    return (
        parts.unionByName(brands).unionByName(genres).distinct()
        .select("label", slug(F.col("label")).alias("slug"), slug(F.col("label"), "_").alias("underscored"))
    )


def dimension_nodes(v: DriverViews) -> DataFrame:
    maps = [lift.dimension_map(v.films(), kind) for kind in ("genre", "studio", "country")]
    labels = MappedGraph(maps).match(t.LABEL)
    return labels.select("s", "o", "o_lang")


def roles_disambiguated(v: DriverViews) -> DataFrame:
    return v.cast_rows().select(
        "movie_id", "actor_id", "billing_order", lift.role_iri().alias("role")
    )


def role_labels(v: DriverViews) -> DataFrame:
    return v.cast_rows().select("movie_id", "billing_order", lift.role_label().alias("label"))


def cast_lists(v: DriverViews) -> DataFrame:
    """The flat form: three '|'-separated columns; some movies lack their last character."""
    row = F.struct(
        "billing_order", F.col("actor_id").cast("string").alias("id"),
        person_name(F.col("actor_id")).alias("name"), F.coalesce("character", F.lit("")).alias("character"),
    )
    cast = F.array_sort(F.collect_list(row))
    lists = v.roles().groupBy(F.col("movie_id").alias("id")).agg(cast.alias("c"))

    def flat(field: str):
        return F.transform("c", lambda x: x[field])

    characters = flat("character")
    short = every(89, F.col("id"))
    return lists.select(
        "id",
        F.array_join(flat("id"), "|").alias("cast_ids"),
        F.array_join(flat("name"), "|").alias("cast_names"),
        F.array_join(F.when(short, F.slice(characters, 1, F.size("c") - 1)).otherwise(characters), "|").alias(
            "cast_characters"
        ),
    )


def cast_alignment_quarantine(v: DriverViews) -> DataFrame:
    return lift.misaligned(cast_lists(v))


def cast_unnested(v: DriverViews) -> DataFrame:
    """The aligned movies, split back into one row per appearance."""
    films = lift.split_cast(cast_lists(v).withColumn("title", movie_title(F.col("id"))), strict=False)
    return lift.cast_rows(films.where("aligned")).select(
        "movie_id", "billing_order", "actor_id", "actor_name", "character", lift.role_iri().alias("role")
    )


# --- patterns -----------------------------------------------------------------------------------


def bgp_star(v: DriverViews) -> DataFrame:
    found = patterns.bgp(
        v.graph,
        [("?movie", t.TYPE, t.MOVIE), ("?movie", t.TITLE, "?title"), ("?movie", t.YEAR, "?year"),
         ("?movie", t.GENRE, t.ONT + "genre_1_urgent")],
    )
    return found.select("movie", "title", F.col("year").cast("long"))


def bgp_path(v: DriverViews) -> DataFrame:
    found = patterns.bgp(
        v.graph,
        [("?d", t.NAME, t.text(DIRECTOR)), ("?movie", t.DIRECTOR, "?d"), ("?movie", t.HAS_ROLE, "?role"),
         ("?role", t.PLAYED_BY, "?a"), ("?a", t.NAME, "?actor"), ("?role", t.BILLING, t.integer(1))],
    )
    return found.select("movie", "role", "actor")


def bgp_optional(v: DriverViews) -> DataFrame:
    """Roles of one movie, the character where there is one."""
    roles = patterns.bgp(
        v.graph, [("?movie", t.TITLE, t.text(FILM)), ("?movie", t.HAS_ROLE, "?role"), ("?role", t.BILLING, "?order")]
    )
    named = patterns.bgp(v.graph, [("?role", t.CHARACTER, "?character")])
    return patterns.optional(roles, named).select("role", F.col("order").cast("long"), "character")


def bgp_negation(v: DriverViews) -> DataFrame:
    """Directors that never act."""
    directs = patterns.bgp(v.graph, [("?movie", t.DIRECTOR, "?p")]).select("p").distinct()
    acts = patterns.bgp(v.graph, [("?other", t.STARRING, "?p")], {"?p"}).select("p").distinct()
    return patterns.not_exists(directs, acts)


def ask_exists(v: DriverViews) -> DataFrame:
    return patterns.ask(patterns.bgp(v.graph, [("?movie", t.TITLE, t.text(FILM)), ("?movie", t.HAS_ROLE, "?role")]))


def construct_pairs(v: DriverViews) -> DataFrame:
    """A new graph: director worksWith actor."""
    pairs = patterns.bgp(v.graph, [("?movie", t.DIRECTOR, "?d"), ("?movie", t.STARRING, "?a")])
    made = patterns.construct(pairs, [(F.col("d"), t.ONT + "worksWith", t.iri(F.col("a")))])
    return made.select("s", "p", "o")


def describe_movie(v: DriverViews) -> DataFrame:
    return patterns.describe(v.graph, t.RES + "movie/42").select(*t.TERM)


def ntriples_roundtrip(v: DriverViews) -> DataFrame:
    """Triples written as lines of text and read back, counted by predicate and kind of object."""
    path = new_table_path(v.spark)
    write_ntriples(v.graph.triples(), path, compression="gzip")
    # by datatype first: the largest text of a group would need its rows sorted, not only hashed
    counted = read_ntriples(v.spark, path).groupBy("p", "o_kind", "o_dt").agg(
        F.count(F.lit(1)).alias("triples"), F.sum(F.length("o")).alias("chars")
    )
    return counted.groupBy("p", "o_kind").agg(
        F.sum("triples").alias("triples"), F.sum("chars").alias("chars"), F.max("o_dt").alias("datatype")
    )


def graph_merge(v: DriverViews) -> DataFrame:
    """Two files that both name the people, as one graph: a triple of both is one triple."""
    folder = new_table_path(v.spark)
    people = cut_lineage(v.graph.match(t.NAME))
    write_ntriples(people.unionByName(v.graph.match(t.DIRECTOR)), f"{folder}/movies", compression="gzip")
    write_ntriples(people.unionByName(v.graph.match(t.TYPE)), f"{folder}/people", compression="gzip")
    merged = load_graph(v.spark, [f"{folder}/movies", f"{folder}/people"])
    return merged.groupBy("p").agg(F.count(F.lit(1)).alias("triples"), F.count_distinct("s").alias("subjects"))


# --- linking ------------------------------------------------------------------------------------


def linked_people(v: DriverViews) -> DataFrame:
    return linking.link_by_id(v.person_keys(), v.person_items())


def link_ids(v: DriverViews) -> DataFrame:
    return linked_people(v).select("uri", "item", "article_name")


def link_candidates(v: DriverViews) -> DataFrame:
    expected = linking.expected_names(linked_people(v))
    return linking.link_candidates(expected, v.person_same()).select("item", "candidate")


def link_choice(v: DriverViews) -> DataFrame:
    expected = linking.expected_names(linked_people(v))
    return linking.link_choice(expected, v.person_same()).select("item", "resource")


def report(v: DriverViews) -> DataFrame:
    return v.report()


def person_report(v: DriverViews) -> DataFrame:
    return linking.link_report(v.person_keys(), v.person_items(), v.person_same())


def link_coverage(v: DriverViews) -> DataFrame:
    return linking.link_coverage(report(v))


def link_gate(v: DriverViews) -> DataFrame:
    """The report against the links of a graph that has lost those of every 41st film."""
    links = v.stored_report
    number = F.substring_index("uri", "/", -1).cast("long")
    lost = (F.col("kind") == "movie") & every(41, number)
    return linking.link_gate(MappedGraph([lift.same_as_map(links.where(~lost))]).match(t.SAME_AS), links, fail=False)


def link_report_csv(v: DriverViews) -> DataFrame:
    """The link report written as CSV and read back, as a result table."""
    path = new_table_path(v.spark)
    write_csv(report(v), path)
    return result_table(read_link_report(v.spark, path))


def link_gate_written(v: DriverViews) -> DataFrame:
    """The gate over what was written: the links in the graph's file and the cells of the report's file."""
    folder = new_table_path(v.spark)
    write_csv(v.stored_report, f"{folder}/report")
    write_ntriples(MappedGraph([lift.same_as_map(v.stored_report)]).triples(), f"{folder}/graph", compression="gzip")
    links = read_ntriples(v.spark, f"{folder}/graph").where(F.col("p") == t.SAME_AS)
    return linking.link_gate(links, read_link_report(v.spark, f"{folder}/report"))


def local_facts(v: DriverViews, rows: DataFrame) -> DataFrame:
    """A short description of each local resource of a small table: a movie's year and director; a person's first
    movie as director, else as actor. Only the movies and people of `rows` are looked up."""
    number = F.substring_index("uri", "/", -1).cast("long")
    films = key_set(rows.where(F.col("kind") == "movie").select(number.alias("id")), "id")
    people = key_set(rows.where(F.col("kind") == "person").select(number.alias("id")), "id")
    movies = among(v.movie(), "movie_id", films).join(v.directors(), "director_id")
    about_movie = movies.select(
        movie_iri(F.col("movie_id")).alias("uri"),
        F.concat(F.col("year").cast("string"), F.lit(", directed by "), F.col("name")).alias("facts"),
    )
    directed = among(v.movie(), "director_id", people).select(F.col("director_id").alias("pid"), F.lit(1).alias("rank"), "movie_id")
    acted = among(v.billed(only=v.movies_with(people)), "actor_id", people).select(
        F.col("actor_id").alias("pid"), F.lit(2).alias("rank"), "movie_id"
    )
    first = cut_lineage(
        directed.unionByName(acted).groupBy("pid")
        .agg(F.min(F.struct("rank", movie_iri(F.col("movie_id")).alias("iri"), "movie_id")).alias("m"))
        .select("pid", "m.rank", "m.movie_id")
    )
    first = first.join(among(v.movie(), "movie_id", key_set(first, "movie_id")), "movie_id")
    role = F.when(F.col("rank") == 1, "director of ").otherwise("actor of ")
    about_person = first.select(
        person_iri(F.col("pid")).alias("uri"),
        F.concat(role, F.col("title"), F.lit(" ("), F.col("year").cast("string"), F.lit(")")).alias("facts"),
    )
    return rows.join(about_movie.unionByName(about_person), "uri", "left").withColumn(
        "facts", F.coalesce("facts", F.lit(""))
    )


def link_sample(v: DriverViews) -> DataFrame:
    sample = cut_lineage(linking.fixed_sample(linking.linked_only(report(v)), "kind", "uri"))
    return local_facts(v, sample).select("kind", "uri", "label", F.col("facts").alias("local_facts"), "wikidata", "dbpedia")


def link_precision(v: DriverViews) -> DataFrame:
    """Precision per target over the sample; the judgement is derived from a hash of the IRI."""
    sample = linking.fixed_sample(linking.linked_only(report(v)), "kind", "uri")
    correct = F.substring(F.md5("uri"), 1, 1) != "0"
    judged = sample.select(
        F.explode(F.array_compact(F.array(
            F.when(F.col("wikidata") != "", F.lit("wikidata")), F.when(F.col("dbpedia") != "", F.lit("dbpedia"))
        ))).alias("target"),
        correct.alias("correct"),
    )
    return linking.link_precision(judged)


def link_audit(v: DriverViews) -> DataFrame:
    links = report(v).where(F.col("dbpedia") != "").select("kind", F.col("dbpedia").alias("iri"))
    facts = v.dbpedia
    return linking.link_audit(links, english(facts.match(t.LABEL)), facts.match(t.DBO + "wikiPageRedirects"))


def awards(v: DriverViews) -> DataFrame:
    return linking.award_winners(person_report(v), award_claims(v.wikidata))


def stored_winners(v: DriverViews) -> DataFrame:
    """The same from the stored report."""
    return linking.award_winners(v.stored_report, award_claims(v.wikidata))


def award_coverage(v: DriverViews) -> DataFrame:
    people = person_report(v).where(F.col("wikidata") != "").select(F.col("wikidata").alias("s")).distinct()
    held = award_claims(v.wikidata).withColumn("held", F.lit(1))
    return people.join(held, "s", "left").agg(
        F.count_if(F.col("held").isNotNull()).alias("holders"), F.count(F.lit(1)).alias("linked")
    )
