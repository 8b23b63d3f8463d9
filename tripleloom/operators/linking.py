"""Entity linking against two outside authorities.

Keys are (kind, id, uri, label). Every aggregation runs on the authority side down to one row per
key before it meets the keys, so an id or item that holds a large part of an extract is combined
in the map tasks and never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tripleloom.functions import terms as t
from tripleloom.functions.text import cut_prefix, percent_decode
from tripleloom.operators.joins import KeySet, among, key_set, regroup
from tripleloom.session import cut_lineage

# Id property and class of each kind in the authorities.
ID_PROPERTY = {"movie": "P4947", "person": "P4985"}
CLASS = {"movie": "Film", "person": "Person"}

REPORT = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "uri", "label", "wikidata", "dbpedia")])


def by_kind(column: str, table: dict[str, str]) -> Column:
    """Kind of a row whose `column` holds one of the table's values."""
    out = F.lit(None).cast("string")
    for kind, v in table.items():
        out = F.when(F.col(column) == v, kind).otherwise(out)
    return out


def unambiguous(candidates: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Keys with exactly one distinct value. A NULL field counts as a value of its own."""
    value = F.struct(*fields)
    return (
        candidates.groupBy(*key)
        .agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
        .where(F.col("lo").eqNullSafe(F.col("hi")))
        .select(*key, *[F.col(f"lo.{f}").alias(f) for f in fields])
    )


def unambiguous_items(items: DataFrame, only: KeySet | None = None) -> DataFrame:
    """(kind, id, item, article_name) for ids carried by exactly one (item, article). `only` first
    keeps the items of the given ids: right for a handful of keys."""
    if only is not None:
        items = among(items, "id_value", only)
    own = items.select(
        by_kind("id_property", ID_PROPERTY).alias("kind"),
        F.col("id_value").alias("id"),
        "item",
        percent_decode(cut_prefix(F.col("article"), t.ENWIKI)).alias("article_name"),
    ).where(F.col("kind").isNotNull())
    return unambiguous(own, ["kind", "id"], ["item", "article_name"])


def link_by_id(keys: DataFrame, items: DataFrame, narrow: bool = False) -> DataFrame:
    """The keys whose id names exactly one item of the first authority. `narrow` first keeps the items of the given
    keys: right for a handful of keys."""
    found = unambiguous_items(items, key_set(keys, "id") if narrow else None)
    return keys.join(regroup(found, ["kind", "id"]), ["kind", "id"])


def expected_names(linked: DataFrame) -> DataFrame:
    """Per linked item the resource name its article would have in the second authority."""
    return linked.select(
        "kind", "item", F.concat(F.lit(t.DBR), F.col("article_name")).alias("expected")
    ).distinct()


def _statements(same: DataFrame) -> DataFrame:
    """Identity statements of the right class and name space, with the resource each leads to."""
    return same.where(F.startswith("res", F.lit(t.DBR))).select(
        by_kind("class", CLASS).alias("kind"),
        "item",
        F.coalesce("redirect_target", "res").alias("candidate"),
        F.col("redirect_target").isNull().alias("direct"),
    ).where(F.col("kind").isNotNull())


def link_candidates(expected: DataFrame, same: DataFrame) -> DataFrame:
    """All candidates of the linked items: resources themselves, and redirect targets only where
    the decoded target has the expected name."""
    distinct = _statements(same).groupBy("kind", "item", "candidate").agg(F.max("direct").alias("direct"))
    return (
        distinct.join(expected, ["kind", "item"])
        .where(F.col("direct") | (percent_decode(F.col("candidate")) == F.col("expected")))
        .select("kind", "item", "candidate")
    )


def _choices(same: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the statements offer, without knowing the keys: per (kind, item, name) the resource of
    that decoded name, and per (kind, item) the smallest and largest direct resource."""
    statements = _statements(same)
    own = F.when(F.col("direct"), F.col("candidate"))
    alone = statements.groupBy("kind", "item").agg(F.min(own).alias("lo"), F.max(own).alias("hi"))
    named = (
        statements.withColumn("expected", percent_decode(F.col("candidate")))
        .groupBy("kind", "item", "expected").agg(F.min("candidate").alias("named"))
    )
    return regroup(named, ["kind", "item", "expected"]), regroup(alone, ["kind", "item"])


def _chosen(linked: DataFrame, same: DataFrame) -> DataFrame:
    """`linked` (kind, item, expected, ...) with the trusted resource of each item, or NULL.

    The candidate with the expected name wins, else the only one. A redirect counts only when it
    has the expected name, so without such a candidate the choice is among direct resources, and
    smallest = largest says there is one. No group of candidates is ever gathered.
    """
    named, alone = _choices(same)
    return (
        linked.join(named, ["kind", "item", "expected"], "left")
        .join(alone, ["kind", "item"], "left")
        .withColumn("resource", F.coalesce("named", F.when(F.col("lo") == F.col("hi"), F.col("lo"))))
        .drop("named", "lo", "hi")
    )


def link_choice(expected: DataFrame, same: DataFrame) -> DataFrame:
    """The trusted candidate per item, for the items that have one."""
    return _chosen(expected, same).select("kind", "item", "resource").where(F.col("resource").isNotNull())


def link(keys: DataFrame, items: DataFrame, same: DataFrame, narrow: bool = False) -> DataFrame:
    """Keys with `wikidata` and `dbpedia`, NULL where there is no link.

    `narrow` first keeps the items and statements of the given keys: right for a handful of keys. Ids and items
    are written once each, so that the lookups that follow read a table and do not repeat the plan before them.

    One chain of left joins. A key without an item gets its own IRI as a stand-in, which matches no
    statement and keeps the unlinked keys from meeting in one task as NULLs would.
    """
    if narrow:
        own = cut_lineage(unambiguous_items(items, key_set(keys, "id")))
        same = among(same, "item", key_set(own, "item"))
    else:
        own = unambiguous_items(items)
    known = keys.join(regroup(own, ["kind", "id"]), ["kind", "id"], "left").withColumns(
        {
            "found": F.col("item"),
            "item": F.coalesce("item", "uri"),
            "expected": F.coalesce(F.concat(F.lit(t.DBR), F.col("article_name")), F.col("uri")),
        }
    )
    return _chosen(known, same).select(
        *keys.columns, F.col("found").alias("wikidata"), F.col("resource").alias("dbpedia")
    )


def sharing(seeds: KeySet, keys: DataFrame, items: DataFrame, same: DataFrame) -> DataFrame:
    """(id, dbp): every key that is linked with one of the resources `seeds`.

    Only keys whose item has a statement about such a resource can be, so all others are left out before
    anything is grouped.
    """
    about = among(same.select("item", F.coalesce("redirect_target", "res").alias("dbp")), "dbp", seeds)
    told = key_set(about, "item")
    ids = key_set(among(items, "item", told).select(F.col("id_value").alias("id")), "id")
    found = link(among(keys, "id", ids), items, same, narrow=True)
    return among(found.select("id", F.col("dbpedia").alias("dbp")), "dbp", seeds)


def link_report(keys: DataFrame, items: DataFrame, same: DataFrame) -> DataFrame:
    """Every resource with the links found; a missing link is ''."""
    blank = F.lit("")
    return link(keys, items, same).select(
        "kind",
        "uri",
        F.coalesce("label", blank).alias("label"),
        F.coalesce("wikidata", blank).alias("wikidata"),
        F.coalesce("dbpedia", blank).alias("dbpedia"),
    )


def link_coverage(report: DataFrame) -> DataFrame:
    return report.groupBy("kind").agg(
        F.count(F.lit(1)).alias("resources"),
        F.count_if(F.col("wikidata") != "").alias("wikidata"),
        F.count_if(F.col("dbpedia") != "").alias("dbpedia"),
    )


def link_gate(same_as: DataFrame, report: DataFrame, fail: bool = True) -> DataFrame:
    """The graph's links and the report's must agree in number; else the job fails (or says so)."""
    sides = (
        same_as.select(
            F.startswith("o", F.lit("http://www.wikidata.org/")).cast("long").alias("gw"),
            F.startswith("o", F.lit("http://dbpedia.org/")).cast("long").alias("gd"),
            F.lit(0).cast("long").alias("rw"),
            F.lit(0).cast("long").alias("rd"),
        )
    ).unionByName(
        report.select(
            F.lit(0).cast("long").alias("gw"),
            F.lit(0).cast("long").alias("gd"),
            (F.col("wikidata") != "").cast("long").alias("rw"),
            (F.col("dbpedia") != "").cast("long").alias("rd"),
        )
    )
    totals = sides.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("gw", "gd", "rw", "rd")])
    agree = (F.col("gw") == F.col("rw")) & (F.col("gd") == F.col("rd"))
    message = F.concat_ws(" ", F.lit("links of graph and report are not equal in number: graph"), "gw", "gd", F.lit("report"), "rw", "rd")
    verdict = F.when(agree, F.lit(True)).otherwise(F.raise_error(message).cast("boolean") if fail else F.lit(False))
    return totals.select(
        F.col("gw").alias("graph_wikidata"), F.col("rw").alias("report_wikidata"),
        F.col("gd").alias("graph_dbpedia"), F.col("rd").alias("report_dbpedia"), verdict.alias("agree"),
    )


def award_winners(report: DataFrame, claims: DataFrame) -> DataFrame:
    """Linked people who hold the award. An item shared by two people stands for the last one in
    the report's order, i.e. the largest IRI. `claims` has the item IRI in column `s`."""
    people = (
        report.where((F.col("kind") == "person") & (F.col("wikidata") != ""))
        .groupBy("wikidata")
        .agg(F.max("uri").alias("person"))
    )
    return people.join(claims.select(F.col("s").alias("wikidata")), "wikidata", "left_semi").select("person")


def fixed_sample(rows: DataFrame, strata: str, key: str, seed: int = 42, size: int = 15) -> DataFrame:
    """`size` rows per stratum in the order of a seeded hash: the same rows in every run.

    The rank filter is applied in the map tasks first, so a large stratum is never gathered."""
    order = [F.md5(F.concat(F.lit(str(seed)), F.col(key))), F.col(key)]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(strata).orderBy(*order)))
    return ranked.where(F.col("rank") <= size).drop("rank")


def linked_only(report: DataFrame) -> DataFrame:
    return report.where((F.col("wikidata") != "") | (F.col("dbpedia") != ""))


def link_precision(judged: DataFrame) -> DataFrame:
    """Share of correct links per target from judged rows (target, correct)."""
    return judged.groupBy("target").agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if("correct").alias("correct"),
        (F.count_if("correct") / F.count(F.lit(1))).alias("precision"),
    )


def link_audit(links: DataFrame, labels: DataFrame, redirects: DataFrame) -> DataFrame:
    """What becomes of linked IRIs (column `iri`): known by a label, a redirect, both or neither."""
    named = labels.select(F.col("s").alias("iri")).distinct().withColumn("named", F.lit(True))
    moved = redirects.groupBy(F.col("s").alias("iri")).agg(F.min("o").alias("target"))
    outcome = (
        F.when(F.col("target").isNotNull() & F.col("named").isNotNull(), "redirect with label")
        .when(F.col("target").isNotNull(), "redirect")
        .when(F.col("named").isNotNull(), "found")
        .otherwise("not found")
    )
    return (
        links.join(named, "iri", "left").join(moved, "iri", "left")
        .select("kind", outcome.alias("outcome"))
        .groupBy("kind", "outcome").agg(F.count(F.lit(1)).alias("links"))
    )
