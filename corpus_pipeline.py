"""A corpus pipeline: classify, join near copies, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on
whatever its predecessor kept, and all but the last return the columns of
``docs``.  ``run`` writes each stage's result as Parquet under the folder
that the session names in ``spark.checkpoint.dir`` and reads it again.

Rows are told apart by id and text, so null or repeated ids, repeated rows
and additional columns are carried along; a stage over no rows returns none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import decontaminate, jaccard_join, mixing, quality_pu, sharding
from lakestrata.llm.base import cut, shared_root, table, whole_row
from lakestrata.llm.queries import PREDICTED_FROM, SHARDS, fold

#: No SQL for a learned classifier, nor for the seeded mix.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below the cut go."""
    model = quality_pu.fit(cut(quality_pu.features(docs)).where(fold(5) != 0), table(spark, sf_dir, "labels"))
    packed = docs.select(whole_row(docs), "text")
    return quality_pu.features(packed, ("__row",)).where(quality_pu.score(model) >= PREDICTED_FROM).select("__row.*")


def join_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the least id, then text hash."""
    packed = docs.select(whole_row(docs), F.struct("doc_id", F.xxhash64("text").alias("h")).alias("__key"), "text")
    found = jaccard_join.near_duplicates(packed, "__key")
    stay = cut(found.where("__key = component_id").select(F.col("__key").alias("__stay"), F.col("n_shingles").alias("__n")).distinct())
    kept = packed.drop("text").join(stay, F.col("__key") == F.col("__stay"))
    # equal rows have one key; texts without a word are no copies of each other
    some, none = kept.where("__n > 0"), kept.where("__n = 0")
    return some.dropDuplicates(["__stay"]).unionByName(none).select("__row.*")


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quote a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: doc_id, size, text_crc32, shard, grown_shard, slot."""
    return sharding.shard(docs, [1.0] * SHARDS)


STAGES = [
    ("quality_classifier", classify),
    ("jaccard_join", join_copies),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = table(spark, sf_dir, "documents"), f"{shared_root(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
