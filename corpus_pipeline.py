"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on every row it is given and returns a frame that is
written as Parquet and read again as the next one's ``docs``.  All but the last return the columns of
``docs``; the last returns (doc_id, n_tokens, ids_sha256, decoded_sha256).

NULL texts count as empty in every stage and repeated rows are judged alike.  Clean documents stay.
An empty table stays empty.  Columns that ``documents`` has besides ``doc_id`` and ``text`` pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import decontamination, quality, simhash, toxicity
from rowmill.llm.queries import encoded_digests, remainder, table
from rowmill.operators.joins import join_small
from rowmill.session import fresh_path, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# SQL can't express compression with a dictionary, XXH64 or byte-level BPE, on which the stages rest.
ORACLE_SQL = None


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that compression distance marks as toxic go."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return docs.where(toxicity.toxicity(F.col("text"), model) < toxicity.THRESHOLD)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours are mostly of low quality go."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = quality.train(docs.select("doc_id", "text"), labels)
    return docs.where(quality.quality(F.col("text"), model, spark) >= quality.THRESHOLD)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, texts whose sets of five-word shingles have a similarity of 0.8 or
    more, one row stays: the smallest doc_id (NULL last), of rows with this doc_id the smallest digest of
    the text, of equal ones any."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", digest.alias("digest"))
    groups = simhash.similar_texts(docs.select(key.alias("key"), "text"), key="key")
    kept = settle(groups.select(F.col("component").alias("__kept")).distinct().select("__kept.*"), "kept")
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"))
    rows = docs.withColumn("__own", digest)
    same = (F.col("__own") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    chosen = join_small(rows, kept, same, "left_semi")
    return chosen.dropDuplicates(["doc_id", "__own"]).drop("__own")


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    tests = table(spark, sf_dir, "benchmark")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = decontamination.contaminated(docs.select(digest.alias("__digest"), "text"), tests, key="__digest")
    gone = settle(found.select(F.col("__digest").alias("__gone")).distinct(), "contaminated")
    return join_small(docs.withColumn("__own", digest), gone, F.col("__own") == F.col("__gone"), "left_anti").drop("__own")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every remaining document, and that they decode to it, as digests."""
    return encoded_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("quality", keep_quality),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmarks),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, storing each one's rows in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
