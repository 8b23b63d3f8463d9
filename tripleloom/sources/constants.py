"""Small constant tables as local relations: known size, no tasks to read them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {"string": pa.string(), "long": pa.int64(), "strings": pa.list_(pa.string())}


def constant_rows(spark: SparkSession, columns: dict[str, str], rows: list[tuple]) -> DataFrame:
    """`columns` maps names to 'string', 'long' or 'strings'."""
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in columns.items()])
    by_column = list(zip(*rows)) if rows else [() for _ in columns]
    arrays = [pa.array(list(values), field.type) for values, field in zip(by_column, schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))


def constant_triples(spark: SparkSession, rows: list[tuple[str, str, str, str, str, str]]) -> DataFrame:
    return constant_rows(spark, dict.fromkeys(["s", "p", "o", "o_kind", "o_dt", "o_lang"], "string"), rows)
