"""A training corpus from the table of documents, in four stages.

1. `toxicity`: documents that the classifier rejects (score of 0.5 or more) go.
2. `ngram_jaccard_join`: of documents linked by their word 5-gram sets (80 % Jaccard), directly or by others, the one with
   the smallest id stays.
3. `source_mixing`: every document is repeated or left out, so that the sources come near their target shares.
4. `best_fit_packing`: what is left, packed into sequences of 2048 tokens.

All stages but the last return the columns of documents. Nulls in any column, empty and very long texts, ties and rows that
repeat are rows like any other (each stage says what it gives them); an empty table gives an empty table; further columns
are kept by the first three stages and may have any names but those that begin with `__`. No stage can be written in SQL as a whole (a classifier, word
sets by hash, random rounding, packing), so ORACLE_SQL is None and tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medleaf.llm import jaccard_join, mixing, packing, toxicity
from medleaf.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score under 0.5; null and empty texts score low and stay. Rows that repeat score alike."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "__toxicity").filter("__toxicity < 0.5").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked rows, that with the smallest id (and of these, one by the hash of id and text).
    Rows are linked by their texts, so that rows which repeat an id with different texts are told apart. Of rows alike in id
    and text one stays; rows without an id are no one's copy and stay; rows without words are linked with nothing and stay.
    """
    key = F.when(F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.xxhash64("doc_id", "text"))
    keyed = docs.withColumn("__key", key)
    found = stored(jaccard_join.jaccard_components(keyed.select(F.col("__key").alias("doc_id"), "text"), width=5, percent=80), "components")
    copies = found.filter("doc_id <> component_id").select("doc_id", "component_id")
    linked = copies.union(copies.select("component_id", "component_id").distinct()).toDF("__key", "component")
    linked = stored(linked.join(keyed.select("__key", "doc_id"), "__key").distinct(), "linked")
    best = linked.groupBy("component").agg(F.min(F.struct("doc_id", "__key")).alias("best")).select(F.col("best.__key").alias("__key"))
    copies = stored(linked.select("__key").join(best, "__key", "left_anti"), "copies")
    again = stored(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("__key")).count().filter("count > 1").select("__key"), "again")
    once = keyed.join(copies.union(again), "__key", "left_anti")
    first = W.partitionBy("__key").orderBy(*[F.col(c).asc_nulls_last() for c in docs.columns])
    rest = keyed.join(again, "__key", "left_semi").join(copies, "__key", "left_anti").withColumn("__n", F.row_number().over(first)).filter("__n = 1")
    return once.select(*docs.columns).unionByName(rest.select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents by the target weights of their sources; a null source is a source. Documents without
    words go, as no copies of them are taken.
    """
    return mixing.mix_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; a document that the mix repeats is packed as often. Null and empty texts are an end
    token alone.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over all documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
