"""A training corpus from ``documents``, in five stages.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the
``docs`` of the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import decontaminate, jaccard, mixing, quality, sharding
from pairloom.llm.queries import DOMAIN, MIX_SEED, WEIGHTS, shard_dims
from pairloom.session import broadcast_if_small, store

#: nine tenths of the tokens that are left, each document once
MIX_SHARE = (9, 10)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled documents of this table, does not reject."""
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, model, threshold=0.7 if model else 0.0).where("predicted = 1").select(*docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document of smallest id; a document without id only if its component has none."""
    found = store(jaccard.similar_components(docs))
    no_id = F.lit(-(1 << 63))
    drop = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.coalesce("doc_id", no_id).alias("_pl_k"), F.col("text_hash").alias("_pl_th"))
    keyed = docs.withColumn("_pl_k", F.coalesce("doc_id", no_id)).withColumn("_pl_th", F.xxhash64(F.coalesce("text", F.lit(""))))
    key = ["_pl_k", "_pl_th"]
    one = keyed.join(broadcast_if_small(drop.distinct()), key, "left_anti")
    # repeated rows are copies, too; only their texts are shuffled
    repeated = found.groupBy(F.coalesce("doc_id", no_id).alias("_pl_k"), F.col("text_hash").alias("_pl_th")).agg(F.count("*").alias("n")).where("n > 1")
    repeated = broadcast_if_small(repeated.select(*key))
    single, several = one.join(repeated, key, "left_anti"), one.join(repeated, key, "left_semi")
    return single.unionByName(several.dropDuplicates(key)).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights."""
    return mixing.mix_to_weights(docs, "doc_id", "text", F.expr(DOMAIN), WEIGHTS, MIX_SHARE, 1, MIX_SEED).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus with its shard and place in it, along the Hilbert curve."""
    return sharding.hilbert_shards(docs, "doc_id", shard_dims(), [F.octet_length("text"), F.crc32(F.coalesce("text", F.lit("")))])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_copies", keep_one_copy),
    ("benchmark", drop_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

#: trained and retrieving stages are no SQL; tests compare the stages with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
