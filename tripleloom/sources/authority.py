"""Outside authorities as extract tables.

An extract has `items` (item, id_property, id_value, article), `same` (res, item, class,
redirect_target) and facts, which are triples. What a remote query asks for one resource at a time
is here a filter on the extract and a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripleloom.functions import terms as t

AWARD_RECEIVED = t.WDT + "P166"
BEST_DIRECTOR = t.WD + "Q103360"


def read_items(spark: SparkSession, path: str, properties: list[str]) -> DataFrame:
    """Items that carry one of the wanted external ids; the filter reaches the Parquet scan."""
    rows = spark.read.parquet(path).where(F.col("id_property").isin(properties))
    return rows.select("item", "id_property", "id_value", "article")


def read_same(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("res", "item", "class", "redirect_target")


def award_claims(facts, award: str = BEST_DIRECTOR) -> DataFrame:
    """Items that hold the award."""
    claims = facts.match(AWARD_RECEIVED)
    return claims.where((F.col("o") == award) & (F.col("o_kind") == "iri")).select("s").distinct()
