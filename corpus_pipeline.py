"""From documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and reread as the next one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paidmedia.llm import decontaminate, line_dedup, packing, quality, simhash
from paidmedia.llm.common import table, use_checkpoints


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return quality.keep_sampled(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines; n_chars follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs)
    return cleaned.withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in the packed sequences."""
    return packing.pack(docs, packing.word_tokenizer())


STAGES = [
    ("quality", quality_stage),
    ("line dedup", line_stage),
    ("simhash dedup", simhash_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Seeded sampling, fingerprints and tokenizers are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written to the shared folder."""
    use_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    # Removed when the application ends.
    fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(fs_path)
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
    return docs
