"""From raw documents to packed training sequences, in stages that are each written and read again.

Every stage works on all that its predecessor kept, and all but the last return the columns of
`documents`. Rows without an id or text are judged by the rules of the operators: a null text is not
toxic, counts as an empty text for quality, has no secrets and packs as the end id alone.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripleloom.llm import quality, toxicity
from tripleloom.llm.common import small_batches, table
from tripleloom.llm.packing import best_fit_packed
from tripleloom.llm.secrets import redacted
from tripleloom.llm.simhash import without_near_copies


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches 0.5 go."""
    small_batches(spark)
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.scored(docs, fitted, "\0toxicity")
    return judged.where(F.col("\0toxicity") < 0.5).drop("\0toxicity")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is below 0.3 go."""
    small_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(docs["text"], model) >= 0.3)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays whose SimHash fingerprints over 4 words are linked by 4 or fewer differing bits."""
    small_batches(spark)
    return without_near_copies(docs, words=4, max_bits=4)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text; n_chars follows."""
    small_batches(spark)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(redacted)

    cleaned = docs.withColumn("text", clean("text"))
    length = F.when(F.col("n_chars").isNotNull(), F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return cleaned.withColumn("n_chars", length) if "n_chars" in docs.columns else cleaned


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 1024."""
    small_batches(spark)
    return best_fit_packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: (name, function of (spark, docs, sf_dir)) in the order of the run.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("simhash_near_dedup", near_copies_stage),
    ("secrets", secrets_stage),
    ("best_fit_packing", packing_stage),
]
#: Trained models, Hamming distances and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What a stage returns is written as Parquet in the cluster's shared folder."""
    docs = table(spark, sf_dir, "documents")
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="tripleloom-llm-")
    folder = f"{shared}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
