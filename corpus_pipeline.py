"""A training-corpus pipeline over ``documents``: toxic documents go, of every
near-duplicate group one document stays, repeated passages go, what is left
is packed into token sequences.

Every stage takes (spark, docs, sf_dir); all but the last return the columns
of ``documents``. Rows without an id stay as they are in the two deduplicating
stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import minhash, packing, substring, toxicity
from meterline.llm.common import maybe_broadcast, read_table, written

TOXIC_AT = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. The machine is fitted on the
    labelled ones among them, outside the held-out fold."""
    machine = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine, score_col="__score").where(F.col("__score") < TOXIC_AT).drop("__score")


def _with_node(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with __node, a document for the near-duplicate stage: the id, or,
    where some id has several texts, a number for each (id, text) in that order.
    Rows without an id have none."""
    texts = docs.where("doc_id is not null").select("doc_id", F.coalesce(F.md5("text"), F.lit("")).alias("__text_key"))
    several = texts.groupBy("doc_id").agg(F.min("__text_key").alias("a"), F.max("__text_key").alias("b")).where("a <> b")
    if several.isEmpty():
        return docs.withColumn("__node", F.col("doc_id"))
    parts, key = int(spark.conf.get("spark.sql.shuffle.partitions")), ["doc_id", "__text_key"]
    nodes = written(texts.distinct().repartitionByRange(parts, *key).sortWithinPartitions(*key).withColumn("__node", F.monotonically_increasing_id()), "near_nodes")
    keyed = docs.withColumn("__text_key", F.coalesce(F.md5("text"), F.lit("")))
    return written(keyed.join(nodes, key, "left").select(*docs.columns, "__node"), "near_docs")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every near-duplicate group, once. Different texts
    of one id are documents of their own, after each other by their MD5; of
    rows with equal id and text the smallest by the other columns stays."""
    rows = _with_node(spark, docs)
    ids = minhash.near_duplicates(rows.select("__node", "text").where("__node is not null"), id_col="__node")
    facts = written(ids.groupBy("__node").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("not kept or n > 1"), "near_dropped")
    n = facts.count()
    gone = facts.where("not kept").select("__node")
    left = rows.join(maybe_broadcast(gone, n, 16), "__node", "left_anti")
    again = facts.where("kept").select("__node")
    if again.isEmpty():
        return left.select(*docs.columns)
    once = left.join(maybe_broadcast(again, n, 16), "__node", "left_semi").groupBy("__node").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return left.join(maybe_broadcast(again, n, 16), "__node", "left_anti").select(*docs.columns).unionByName(once.select("row.*"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 50 words that a smaller document has; texts
    that repeat nothing keep their white space."""
    cleaned = substring.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.withColumns(new).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences."""
    return packing.pack(packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("toxicity", drop_toxic), ("minhash near-dedup", drop_near_duplicates),
          ("substring dedup", drop_repeated_passages), ("best-fit packing", pack_sequences)]

# Fitted models, signatures and packing are not expressible in SQL: tests/llm
# hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "_"))
    return docs
