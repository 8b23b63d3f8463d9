"""All named queries. A name is used once; the value takes the driver views and gives rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripleloom.plans import build_queries as b
from tripleloom.plans import federated_queries as f
from tripleloom.plans import graph_queries as g
from tripleloom.plans import profile_queries as p
from tripleloom.plans import rule_queries as r
from tripleloom.sources.driver_views import DriverViews

ENTRIES: list[tuple[str, str, Callable[[DriverViews], DataFrame]]] = [
    ("q01_movies_by_director", "Movies directed by a person", g.movies_by_director),
    ("q02_movies_after_year", "Movies released after a year", g.movies_after_year),
    ("q03_top_directors", "Directors with the most movies, by name", g.top_directors_by_name),
    ("q04_movies_linked", "Movies linked to the second authority", g.movies_linked),
    ("q05_movies_with_actor", "Movies with an actor", g.movies_with_actor),
    ("q06_director_birth", "Birth date and place of a director, with movies", f.director_birth),
    ("q07_director_age", "Directors of six movies or more, age at the first", f.director_age_at_first),
    ("q08_cast_age", "Cast of a movie with age at release", f.cast_age),
    ("q09_budget_gross", "Budget and gross of a director's movies", f.budget_and_gross),
    ("q10_year_check", "Release year against the earliest publication", f.year_check),
    ("q11_probe", "Facts of one constant film", f.endpoint_probe),
    ("q12_links_exist", "Do linked IRIs exist, are they redirects", f.links_exist),
    ("q13_abstracts", "Start of the English abstracts", f.abstracts),
    ("q14_cast_birth_year", "Cast of a movie with typed birth year", f.cast_birth_year),
    ("q15_birthplaces", "Birthplaces from two properties", f.birthplaces),
    ("q16_cast_of_movie", "Cast of a movie with character and order", g.cast_of_movie),
    ("q17_roles_of_actor", "All roles of an actor", g.roles_of_actor),
    ("q18_shared_characters", "Characters in more than one role", g.shared_characters),
    ("q19_top_billed", "Actors most often billed first", g.top_billed),
    ("q20_directors_acting", "Directors acting in their own movie", g.directors_in_own_movie),
    ("q21_role_consistency", "Roles against starring", g.role_consistency),
    ("stats_triples", "Triples per file sum and merged", p.stats_triples),
    ("stats_classes", "Individuals per listed class", p.stats_classes),
    ("stats_links", "Linked resources per target", p.stats_links),
    ("stats_genres", "Movies per genre", p.stats_genres),
    ("stats_top_directors", "Directors with the most movies, by id", p.stats_top_directors),
    ("clean_top_rated", "Cleaned best-rated movies", b.clean_top_rated),
    ("clean_through_csv", "Cleaning from and to files, credits given twice", b.clean_through_csv),
    ("clean_top_cast", "First-billed cast per movie", b.clean_top_cast),
    ("clean_crew_json", "Director from the crew cell", b.clean_crew_json),
    ("lift_triples", "Lifted triples by predicate", b.lift_triples),
    ("lift_dimensions", "Slugs of labels", b.lift_dimensions),
    ("lift_dimension_nodes", "Genre, studio and country nodes", b.dimension_nodes),
    ("roles_disambiguated", "Role IRIs", b.roles_disambiguated),
    ("role_labels", "Role labels", b.role_labels),
    ("cast_alignment_quarantine", "Movies with misaligned cast columns", b.cast_alignment_quarantine),
    ("cast_unnested", "Cast lists split into rows", b.cast_unnested),
    ("bgp_star", "Star pattern", b.bgp_star),
    ("bgp_path", "Path pattern", b.bgp_path),
    ("bgp_optional", "Optional pattern", b.bgp_optional),
    ("bgp_negation", "Negated pattern", b.bgp_negation),
    ("ask_exists", "Does a pattern have a solution", b.ask_exists),
    ("construct_pairs", "New graph from a pattern", b.construct_pairs),
    ("describe_movie", "Triples about a resource", b.describe_movie),
    ("ntriples_roundtrip", "Triples through their text form", b.ntriples_roundtrip),
    ("graph_merge", "Files with common triples as one graph", b.graph_merge),
    ("link_ids", "People linked by id", b.link_ids),
    ("link_candidates", "Identity candidates", b.link_candidates),
    ("link_choice", "Chosen identities", b.link_choice),
    ("link_report", "Link report", b.report),
    ("link_report_columns", "Non-empty cells of the link report", p.report_columns),
    ("link_coverage", "Link coverage per kind", b.link_coverage),
    ("link_gate", "Graph links against the report", b.link_gate),
    ("link_gate_written", "Links of a written graph against a written report", b.link_gate_written),
    ("link_report_csv", "Link report through its file", b.link_report_csv),
    ("link_sample", "Fixed sample with local facts", b.link_sample),
    ("link_precision", "Precision over a judged sample", b.link_precision),
    ("link_audit", "Outcome of linked IRIs", b.link_audit),
    ("awards", "Linked people who hold the award", b.awards),
    ("award_coverage", "Award holders among linked items", b.award_coverage),
    ("rule_equivalent", "Equivalent-class typing", r.rule_equivalent),
    ("rule_subclass", "Subclass closure", r.rule_subclass),
    ("rule_domain_range", "Domain and range typing", r.rule_domain_range),
    ("rule_has_value", "Members by value", r.rule_has_value),
    ("rule_has_value_triples", "Values by membership", r.rule_has_value_triples),
    ("rule_award_winning", "Award-winning directors", r.rule_award_winning),
    ("rule_chain_starring", "Starring from the property chain", r.rule_chain_starring),
    ("rule_inverse", "Inverse properties", r.rule_inverse),
    ("rule_functional", "Same individuals from functional properties", r.rule_functional),
    ("rule_functional_clash", "Functional literals with several values", r.rule_functional_clash),
    ("rule_actor_director", "People who direct and star in one movie", r.rule_actor_director),
    ("rule_disjoint", "Members of two disjoint classes", r.rule_disjoint),
    ("rule_same_as", "Alias clusters by size", r.rule_same_as),
    ("rule_alias_counts", "Members with and without aliases", r.rule_alias_counts),
    ("rule_agreement", "Starring against the chain on triples", r.rule_agreement),
    ("rule_members", "Local members of defined classes", r.rule_members),
    ("rule_closure", "Members per class at the fixpoint", r.rule_closure),
    ("rule_facts", "Facts added at the fixpoint", r.rule_facts),
    ("rule_closure_equal", "Members per class with one name for each individual", r.rule_closure_equal),
    ("rule_equal_names", "Individuals of several names", r.rule_equal_names),
    ("rule_explain", "Given triples behind each clash", r.rule_explain),
    ("bundle_with_bad_record", "Closure while a bad record comes and goes", r.bundle_with_bad_record),
    ("void_classes", "Class partitions", p.void_classes),
    ("void_properties", "Property partitions", p.void_properties),
    ("void_linksets", "Links per target", p.void_linksets),
    ("void_subjects", "Subjects and entities", p.void_subjects),
    ("void_dataset", "Description of the published files", p.void_dataset),
    ("void_republished", "Manifest after a second publish", p.void_republished),
    ("bundle", "Publishable graph by predicate", p.bundle),
]


def titles() -> dict[str, str]:
    return {name: title for name, title, _ in ENTRIES}


def named_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name, _, rows in ENTRIES:
        if name in out:
            raise ValueError(f"query name {name} is used twice")
        out[name] = lambda spark, folder, rows=rows: rows(DriverViews(spark, folder))
    return out
