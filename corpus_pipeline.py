"""Corpus pipeline: language ID, quality classifier, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payx.llm import bottomk, cnn, langid, packing
from payx.llm.common import materialise, table
from payx.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones are in; text without letters or like none goes.

    Null and empty texts go, repeated rows are judged alike, and all columns stay as they are, whatever their names; with
    no labelled row, or no row at all, nothing is left.
    """
    samples = langid.learn(docs.select("doc_id", "text", "lang"))
    name = unused(docs, "language")
    return langid.identify(docs, samples, name).where(langid.accept(name)).select(*columns(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, learned from the labels of these documents, gives label 1.

    Null and empty texts are scored like others, repeated rows alike, and all columns stay as they are. Where only one
    label is known it holds for all; where none is, all stay.
    """
    labels = table(spark, sf_dir, "labels").where("quality is not null").select("doc_id", "quality")
    net = cnn.learn(docs.select("doc_id", "text").join(labels, "doc_id"))
    name = unused(docs, "quality_score")
    return docs.withColumn(name, cnn.score(F.col("text"), net)).where(F.col(name) >= 0.5).select(*columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8: the one with the smallest id.

    Every row takes part under a number of its own; of rows with one id, or none, one is left. A null id comes last.
    Null, empty and wordless texts are linked with nothing and stay; all columns stay as they are.
    """
    name = unused(docs, "row_number")
    docs, given = materialise(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), docs
    key = F.col(name)
    near = materialise(bottomk.near_duplicates(docs.select(key.alias("doc_id"), "text"), width=5, percent=80).select(F.col("doc_id").alias(name), "component_id", "kept"), "near")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), key.alias("c"))
    groups = near.join(docs.select(name, F.col("doc_id").cast("long").alias("doc_id")), name).groupBy("component_id").agg(F.count(F.lit(1)).alias("n"), F.min(order)["c"].alias("best")).where("n > 1")
    groups = materialise(groups, "groups")
    gone = near.where("not kept").select(name).unionByName(groups.select(F.col("component_id").alias(name))).join(groups.select(F.col("best").alias(name)), name, "left_anti")
    return docs.join(gone, name, "left_anti").select(*columns(given))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces, spans of their token ids, in training sequences.

    Each row is packed on its own, also of repeated ids or none; null and empty texts have one piece, the end mark.
    """
    return packing.packed(docs, packing.tokens_and_end(F.col("text"), vocabulary()))


def columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


STAGES = [("language_id", language), ("quality", quality), ("near_dedup", near_dedup), ("packing", best_fit)]
#: SQL cannot express trained models; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
