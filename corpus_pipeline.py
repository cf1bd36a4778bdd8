"""Training-corpus pipeline: five stages over ``documents``, each one of the operators of ``tablewise.llm``.

Every stage works on all rows that the one before it kept; all but the last
return the columns of ``documents``.  Null and empty texts pass every stage but the
second, which keeps one of them; other columns, whatever their names, pass
unchanged; an empty table gives an empty result.  The classifier is learnt, so no SQL
gives run()'s rows; tests hold each stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm import bpe, decontaminate, exact_dedup, near_dup, quality
from tablewise.llm.common import id_key, save, shared_path, table, text_or_empty
from tablewise.llm.queries import THRESHOLD, VOCABULARY

ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as one column, so that no column name can clash with an operator's."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of at least ``THRESHOLD``)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(_packed(docs), model, keep=("row",)).filter(F.col("score") >= THRESHOLD).select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.keep_first(docs, exact_dedup.DigestIndex(spark, shared_path(spark, "digests")))


def _row_key(docs: DataFrame) -> Column:
    """Id and digest of the text, which no two rows share after the exact stage; null ids are larger than any."""
    return F.struct(docs["doc_id"].isNull().alias("none"), docs["doc_id"].alias("id"), F.sha2(text_or_empty(docs["text"]), 256).alias("digest"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the smallest id, of equal or null ids the smallest digest."""
    found = near_dup.near_duplicates(docs.select(_row_key(docs).alias("doc_id"), "text"))
    gone = found.filter("NOT kept").select(id_key("doc_id").alias("_id"))
    return docs.select(F.struct("*").alias("row"), id_key(_row_key(docs)).alias("_id")).join(gone, "_id", "left_anti").select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ``benchmark``."""
    found = decontaminate.find_contamination(_packed(docs), table(spark, sf_dir, "benchmark"), keep=("row",))
    return found.filter("n_hit = 0").select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, offsets, n_tokens and whether decoding gives the text back."""
    vocabulary = bpe.broadcast_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "offsets", F.sha2("decoded", 256).alias("text_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
