"""CSV in and out, and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tripleloom.operators.linking import REPORT

QUOTED = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_csv(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, ordinal: bool = False, line_breaks: bool = True
) -> DataFrame:
    """All columns as text, quoted cells of any length.

    Without `columns` the header line names them. Empty cells read as ''. Cells may hold line breaks; where
    none does, `line_breaks=False` gives the same rows from many tasks per file instead of one.
    `ordinal` adds the place of a row in the input, which grows by file name and place in the file.
    """
    reader = spark.read.options(**QUOTED, multiLine=line_breaks, emptyValue="")
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    rows = reader.csv(path)
    names = rows.columns
    if ordinal:
        # a task reads blocks of files in any order, but the rows of one block in theirs
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        rows = rows.select(*names, place.alias("ordinal"))
    return rows.na.fill("", names)


def with_optional(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that an input may lack are NULL there."""
    return rows.select("*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in rows.columns])


def read_clean_movies(spark: SparkSession, path: str) -> DataFrame:
    return with_optional(read_csv(spark, path), ["cast_ids", "cast_names", "cast_characters"])


def read_link_report(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, REPORT.fieldNames())


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None, compression: str | None = None) -> None:
    """Header and a fixed column order; the files are written in parallel. Compressed files ("gzip") are read like others,
    each by one task."""
    rows.select(*(columns or rows.columns)).write.options(**QUOTED, emptyValue="").csv(path, compression=compression)


def result_table(rows: DataFrame) -> DataFrame:
    """Every column as text, unbound as ''."""
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])
