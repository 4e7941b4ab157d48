"""From raw documents to packed sequences: quality rules, near-duplicates, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each one's result to the shared folder and reads it again.

All stages but the last return the columns of docs, whatever their names: operators see the id, the text and one column that holds the
rest. A null text counts as empty; rows of an empty table give an empty table with the same columns; rows repeated whole are treated
alike (the near-duplicate stage keeps one of them); texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from prospectra.llm import near_duplicates, packing, pii, quality, sentence_spans
from prospectra.llm.shared import documents, materialised

TOKENIZER = "byte_bpe_50k.json"
ID, TEXT, LENGTH = "doc_id", "text", "n_chars"


def _apart(docs: DataFrame) -> DataFrame:
    """Id, text and a column of all others, so that no operator's result takes the place of one of docs' columns."""
    others = [F.col(c) for c in docs.columns if c not in (ID, TEXT)]
    return docs.select(ID, TEXT, F.struct(*(others or [F.lit(0).alias("none")])).alias("_others"))


def _together(docs: DataFrame, out: DataFrame, text: Column) -> DataFrame:
    """docs' columns again, with another text and its length."""
    changed = {ID: F.col(ID), TEXT: text, LENGTH: F.length(text).cast(docs.schema[LENGTH].dataType) if LENGTH in docs.columns else None}
    return out.select(*((changed[c] if c in changed else F.col("_others")[c]).alias(c) for c in docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null, empty or short text fails."""
    whole = docs.select(F.struct(*docs.columns).alias("_whole"))
    return quality.judge(quality.measure(whole, text=f"_whole.{TEXT}")).filter("kept").select("_whole.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id's. Null and empty texts are like nothing and stay."""
    return near_duplicates.keep_one_of_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without sentences that an earlier one says in the same run. A null text stays null."""
    return _together(docs, sentence_spans.remove_repeated_spans(_apart(docs)), F.col(TEXT))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that disclose it replaced by marks. A null text stays null."""
    return _together(docs, pii.sanitise(_apart(docs)), F.when(F.col(TEXT).isNotNull(), F.col("clean_text")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 ids. A null text is its end id alone."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality rules", quality_stage), ("near-duplicates", near_duplicate_stage), ("substring dedup", substring_stage), ("personal data", pii_stage), ("packing", packing_stage)]

#: Tokenizing and MinHash aren't SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
