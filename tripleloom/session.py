"""Session settings for tests and the benchmark; a cluster brings its own session."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripleloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # the Python call site of every expression is of use only in error messages, and is costly
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Upper bounds of what one task reads. Triples repeat their name spaces: in a task's memory they take ten times what
#: they take in a shuffle or file, so Spark's 64 and 128 MB would be a large part of an executor.
READ_AT_ONCE = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16, "spark.sql.files.maxPartitionBytes": 32}
#: A shuffle has a partition for so many bytes of the tables at least: with a fixed number of them, tasks grow with the tables.
DEALT_BYTES = 4 << 20
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def bounded_reads(spark: SparkSession) -> None:
    """Hold the session at `READ_AT_ONCE`; smaller values of its own stay, and it stays for what is evaluated later."""
    for name, most in READ_AT_ONCE.items():
        number, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", spark.conf.get(name).strip().lower()).groups()
        if int(number) * UNITS[unit or "b"] > most * UNITS["m"]:
            spark.conf.set(name, f"{most}m")


def bounded_shuffles(spark: SparkSession, folder: str) -> None:
    """Deal shuffles out by the size of the files in `folder`. Adaptive execution joins small partitions, so small tables
    have as few tasks as before; a larger number of the session's own stays, and it stays for what is evaluated later."""
    # the sizes come from the listing, no file is read
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    wanted = -(-(files.agg(F.sum("length")).first()[0] or 0) // DEALT_BYTES)
    if wanted > int(spark.conf.get(PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(PARTITIONS, str(wanted))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a single-machine session without one gets a temporary folder."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given is None and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
    return given or _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tripleloom-shared-")


def new_table_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tripleloom/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared folder and go on from the table.

    It survives lost executors, is computed once, and is read back by column with known size.
    """
    path = new_table_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
