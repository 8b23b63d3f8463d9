"""Named queries against DuckDB and against the pattern path, on the smallest tables."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tripleloom.functions import terms as t
from tripleloom.operators import patterns as q
from tripleloom.plans import graph_queries as g
from tripleloom.plans.catalog import named_queries, titles
from tripleloom.plans.duckdb_checks import checks
from tripleloom.sources.driver_views import DriverViews

CHOSEN = list(named_queries())
DUCKDB_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck(tiny):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                 "labels conversations").split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tiny}/{name}.parquet'")
    return con


def test_every_query_has_a_check():
    assert set(named_queries()) == set(checks()) == set(titles())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5


@pytest.mark.parametrize("name", CHOSEN)
def test_against_duckdb(spark, tiny, duck, name):
    df = named_queries()[name](spark, tiny)
    cursor = duck.execute(checks()[name])
    names, kinds = [d[0] for d in cursor.description], [str(d[1]) for d in cursor.description]
    expected = [dict(zip(names, row)) for row in cursor.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert {f.name: DUCKDB_TYPES[f.dataType.simpleString()] for f in df.schema} == dict(zip(names, kinds))
    columns = sorted(names)
    mine = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    assert mine == sorted(repr([plain(r[c]) for c in columns]) for r in expected)


@pytest.fixture(scope="module")
def views(spark, tiny):
    return DriverViews(spark, tiny)


def bag(df, *columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def test_pattern_path_agrees_with_property_tables(views):
    graph = views.graph
    by_director = q.bgp(graph, [("?m", t.TITLE, "?title"), ("?m", t.DIRECTOR, "?d"), ("?d", t.NAME, t.text(g.DIRECTOR))])
    assert bag(by_director, "title") == bag(g.movies_by_director(views), "title")
    with_actor = q.bgp(graph, [("?m", t.TITLE, "?title"), ("?m", t.STARRING, "?a"), ("?a", t.NAME, t.text(g.ACTOR))])
    assert bag(with_actor, "title") == bag(g.movies_with_actor(views), "title")
    roles = q.bgp(graph, [("?m", t.TITLE, t.text(g.FILM)), ("?m", t.HAS_ROLE, "?role"), ("?role", t.BILLING, "?order"),
                          ("?role", t.PLAYED_BY, "?a"), ("?a", t.NAME, "?actor")])
    cast = q.optional(roles, q.bgp(graph, [("?role", t.CHARACTER, "?character")])).withColumn("order", F.col("order").cast("long"))
    assert bag(cast, "order", "actor", "character") == bag(g.cast_of_movie(views), "order", "actor", "character")
    own = q.bgp(graph, [("?m", t.DIRECTOR, "?d"), ("?m", t.HAS_ROLE, "?r"), ("?r", t.PLAYED_BY, "?d"), ("?m", t.TITLE, "?title"),
                        ("?d", t.NAME, "?name"), ("?r", t.BILLING, "?order")])
    own = own.withColumn("order", F.col("order").cast("long"))
    assert bag(own, "name", "title", "order") == bag(g.directors_in_own_movie(views), "name", "title", "order")
    top = q.bgp(graph, [("?r", t.BILLING, t.integer(1)), ("?r", t.PLAYED_BY, "?a"), ("?a", t.NAME, "?actor")])
    top = top.groupBy("actor").agg(F.count(F.lit(1)).alias("timesTopBilled")).orderBy(F.desc("timesTopBilled"), "actor").limit(10)
    assert bag(top, "actor", "timesTopBilled") == bag(g.top_billed(views), "actor", "timesTopBilled")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(views):
    """Top rows per movie are cut before the shuffle, filters and columns reach the scan, and no
    plan holds a cross product or a Python operator."""
    cast = plan_of(views.billed())
    assert cast.count("WindowGroupLimit") == 2 and cast.count("Exchange") == 1
    one = plan_of(q.bgp(views.graph, [("?m", t.YEAR, "?year")]))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz" in one
    titles_only = plan_of(g.movies_after_year(views))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in titles_only and "Exchange" not in titles_only
    lifted = plan_of(views.graph.maps[1].triples())
    assert lifted.count("Exchange") == cast.count("Exchange") + lifted.count("BroadcastExchange")
    # what a question about one name needs is written once, so its plan does not multiply
    for name in ("q09_budget_gross", "q12_links_exist", "q13_abstracts", "q15_birthplaces"):
        assert plan_of(named_queries()[name](views.spark, views.folder)).count("FileScan") <= 10, name
    for name in ("q07_director_age", "q09_budget_gross", "q21_role_consistency", "link_report", "rule_functional"):
        plan = plan_of(named_queries()[name](views.spark, views.folder))
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
            assert banned not in plan, (name, banned)
