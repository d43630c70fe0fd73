"""A corpus pipeline of training-data operators: each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioscope.llm import bpe, decontaminate, jaccard, pseudonyms, queries, toxicity
from folioscope.llm.common import discard, read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~queries.held_out())
    return toxicity.score(docs, model).where("predicted = 0").select(docs.columns)


#: Bytes of ids that a list of documents to drop may have to be sent to every executor; longer lists meet the documents in a shuffle.
LISTED = 8 << 20


def _without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """docs without the keys of gone, a stored table, whose count is cheap."""
    return docs.join(F.broadcast(gone) if gone.count() * 16 <= LISTED else gone, key, "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one row: of least doc_id (rows without one come last). Of equal word-free rows of one doc_id one; without doc_id they stay."""
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        # then an id is a row, and texts needn't be written again with keys
        rows = stored(jaccard.cluster(docs).where("id <> component").select(F.col("id").alias("doc_id")), "copies")
        return _without(docs, rows, "doc_id").select(docs.columns)
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "keyed")
    rows = jaccard.cluster(keyed, id_="_row").withColumnRenamed("id", "_row")
    named = stored(keyed.select("_row", "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("text").isNull().alias("_none")).select("_row", "doc_id", "_none", F.sha2("text", 256).alias("_t")).join(rows, "_row"), "named")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_t", "_row"))["_row"].alias("_row")
    some = named.where("n > 0").groupBy("component").agg(least).select("_row")
    empty = named.where("n = 0 and doc_id is not null").groupBy("doc_id", "_none", "_t").agg(least).select("_row")
    kept = some.union(empty).union(named.where("n = 0 and doc_id is null").select("_row"))
    return _without(keyed, stored(named.select("_row").join(kept, "_row", "left_anti"), "copies"), "_row").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate.hits(docs, read(spark, sf_dir, "benchmark")).where(F.size("hits") == 0).select(docs.columns)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for numbers and dates."""
    out = pseudonyms.pseudonymise(docs, queries.PII_KEY)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and its text's ids."""
    out = bpe.encode(docs.select("doc_id", "text"), queries.ranks(), public_tokenizers.PATTERN, keep=["doc_id"])
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("benchmark", drop_benchmark), ("pii", replace_private), ("bpe", encode)]

#: Learned scores, edit distances and merges aren't SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
