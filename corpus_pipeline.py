"""From raw documents to packed training sequences, in five stages; each is written as Parquet and read by the next.

Stages take and (but for the last) return the columns of documents; extra columns are left out. A null or empty text is
clean to the toxicity stage, goes in the language stage for want of a letter, and is a single id to the packing stage.
Repeated rows share their fate but for near_copies, which keeps one of them. A null id is an id like any other that no label
or fold refers to. Empty tables go through as such. A filtering stage drops only what its operator rejects.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, langid, nearcopies, packing, suffixes, toxicity
from ledgerline.llm.common import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic (score of 0.7 or more) by a model learned from the labels; scores whole texts."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).filter(F.coalesce(F.col("predicted"), F.lit(0)) == 0).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose text no language's model accounts for."""
    return langid.identify(docs, langid.train(docs)).filter("accepted").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group linked by a similarity of 0.8 or more over five-word shingles, candidates by SimHash and the
    Gray-order index (op2): that with the smallest id
    (a null id only where there is no other), of these that with the smallest hash of its text, of equal rows any."""
    keyed = docs.select(*COLUMNS, F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_th"))
    found = nearcopies.groups(keyed.select(F.col("_id").alias("id"), F.col("_th").alias("th"), "text"))
    rows = found.groupBy("comp", "id", "th").agg(F.count(F.lit(1)).alias("rows"))
    first = rows.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th", "rows")).alias("k")).select("k.*")
    kept = keyed.join(first, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_th") == F.col("th")))
    once, more = kept.filter("rows = 1"), kept.filter("rows > 1").dropDuplicates(["_id", "_th"])
    return once.unionByName(more).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every string of 200 bytes that also starts elsewhere; no document is dropped. A character cut in two goes."""
    cut = suffixes.deduplicate(docs, with_text=True)
    out = cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the ids of all texts into sequences of 4096."""
    return packing.pack(docs, bpe.vocabulary())


STAGES = [("toxicity", toxic), ("language", language), ("near_copies", near_copies), ("repeats", repeats), ("packing", packed)]

#: SQL can express none of the trained, fingerprinting and tokenizing stages; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
