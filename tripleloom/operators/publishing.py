"""Publishing graphs: the files first, then a manifest that names them.

A publish writes every graph as N-Triples into a folder of its own and adds one row per file to the manifest as its last
step. A publish that fails on the way leaves the earlier version in force, as readers go by the manifest alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tripleloom.operators.lift import union_all
from tripleloom.operators.profile import file_sizes
from tripleloom.sources.constants import constant_rows
from tripleloom.sources.triples_io import read_graphs, write_ntriples

MANIFEST = {
    "version": "long", "g": "string", "path": "string", "triples": "long", "bytes": "long",
    "stored_bytes": "long", "created": "string", "modified": "string",
}


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """All that was published under `folder`, one row for each version and file. Without a publish it is an error.

    Versions from before `stored_bytes` was kept have none."""
    columns = ", ".join(f"{c} {'bigint' if k == 'long' else k}" for c, k in MANIFEST.items())
    return spark.read.schema(columns).parquet(f"{folder}/manifest")


def latest(entries: DataFrame) -> DataFrame:
    """The rows of the newest version."""
    newest = entries.agg(F.max("version")).first()[0]
    return entries.where(F.col("version") == F.lit(newest))


def publish(spark: SparkSession, graphs: dict[str, DataFrame], folder: str, today: str) -> DataFrame:
    """Write a new version of the graphs (each a set of triples) and return its part of the manifest.

    Files are kept gzip-compressed. Triples and the bytes of their lines, which are what a reader of the N-Triples gets,
    are counted while they are written; `stored_bytes` are those of the compressed files. `created` of a file is the
    day of its first publish, `modified` the day of this one.
    """
    # adds no row, but makes the manifest where there is none
    constant_rows(spark, MANIFEST, []).write.mode("append").parquet(f"{folder}/manifest")
    before = manifest(spark, folder)
    # a row for each file ever published under this folder: their number is that of the names a caller gives
    first = {r["g"]: r["created"] for r in before.groupBy("g").agg(F.min("created").alias("created")).collect()}
    version = (before.agg(F.max("version")).first()[0] or 0) + 1
    rows, sizes = [], []
    for g, triples in graphs.items():
        path = f"{folder}/v{version}-{uuid.uuid4().hex}/{g}"
        counted = Observation()
        write_ntriples(triples, path, counted, "gzip")
        rows.append((version, g, path, counted.get["triples"], counted.get["bytes"], first.get(g, today), today))
        stored = F.coalesce(F.sum("bytes"), F.lit(0)).alias("stored_bytes")
        sizes.append(file_sizes(spark, path).agg(stored).select(F.lit(g).alias("g"), "stored_bytes"))
    named = {c: k for c, k in MANIFEST.items() if c != "stored_bytes"}
    made = constant_rows(spark, named, rows).join(union_all(sizes), "g").select(*MANIFEST)
    made.coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return manifest(spark, folder).where(F.col("version") == version)


def read_published(spark: SparkSession, folder: str) -> DataFrame:
    """(g, s, p, o, ...) of the newest version, from the files that the manifest names."""
    found = latest(manifest(spark, folder)).select("g", "path").collect()
    return read_graphs(spark, {r["g"]: r["path"] for r in found})
