"""From raw documents to packed training sequences, in five stages.

Every stage reads what the one before it kept; all but the last return the
columns of ``documents`` with ``n_chars`` measured anew where a text changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.jaccard_join import near_documents
from touchline.llm.line_dedup import dedup_lines
from touchline.llm.packing import pack_texts
from touchline.llm.quality_rules import line_first_cleaning
from touchline.llm.secret_scan import scan
from touchline.llm.tables import share_package, table
from touchline.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = ("lang", "source")


def _documents(kept: DataFrame, text: str) -> DataFrame:
    """The columns of documents from an operator's rows that carry ``rest``."""
    out = kept.select("doc_id", F.col(text).alias("text"), "rest.lang", "rest.source")
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line rules reject go; the others lose their failed lines."""
    share_package(spark)
    return _documents(line_first_cleaning(docs, rest=REST).where("kept"), "cleaned")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more in three documents or more stay in one of them; documents without text go."""
    share_package(spark)
    return _documents(dedup_lines(docs, rest=REST).where(F.col("kept").rlike("[^ \\t-\\r]")), "kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one with the smallest id stays; rows that share an id, or have none, are told apart."""
    share_package(spark)
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        rows = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered-documents")
        groups = near_documents(rows, k=5, percent=80, key="row").select(F.col("doc_id").alias("row"), "component_id")
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
        stays = groups.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(F.min(order).alias("first"))
        return rows.join(stays.select("first.row"), "row", "left_semi").select(*COLUMNS)
    groups = near_documents(docs, k=5, percent=80)
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("first_id")).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    share_package(spark)
    return _documents(scan(docs, with_text=True, rest=REST), "redacted")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, with their ids, in sequences of at most 4096 ids."""
    import public_tokenizers

    share_package(spark)
    return pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("secret scans", secrets),
    ("packing", packing),
]

#: tokenizing and packing are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
