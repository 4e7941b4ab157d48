"""The thin queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_format, gif_media, html_text, near_duplicates, oracles, packing, pii, quality, sentence_spans, sentencepiece_codec, token_counts
from .shared import documents

#: The id of the end-of-document mark in the byte-level vocabulary.
END_OF_TEXT = 50256


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"), END_OF_TEXT)


def op2_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.codec_digests(documents(spark, sf_dir), _vocabulary("piece_bpe_32k.model"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"))


def op5_gif_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif_media.media_digests(gif_media.store_texts(documents(spark, sf_dir)))


def op6_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(more)))


def op7_information_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(documents(spark, sf_dir).select("doc_id", "text"))
    order = F.create_map(*(F.lit(x) for n, k in enumerate([*pii.KINDS, "term", "drop"]) for x in (k, n)))
    merged = F.sort_array(F.transform(F.concat("base_spans", "term_spans"), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(pii.span_text(F.col("base_spans")), 256).alias("base_sha256"), pii.span_text(merged).alias("spans"), "n_term")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir), k=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated_spans(documents(spark, sf_dir).select("doc_id", "text"))


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    return quality.judge(measured).select("doc_id", *quality.MEASURES, "base_failed", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_layout_text, op3_sentencepiece, op4_packing, op5_gif_columns, op6_chat_round_trip, op7_information_sanitisation, op8_near_duplicates, op9_sentence_spans, op10_weak_supervision)}


def oracle_sql() -> dict[str, str]:
    """For the operators whose results SQL can express; the others' tests hold them against plain versions."""
    return {"op6_chat_round_trip": oracles.op6(), "op8_near_duplicates": oracles.op8(), "op9_sentence_spans": oracles.op9(), "op10_weak_supervision": oracles.op10()}
