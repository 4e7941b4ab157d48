"""What the operators share: the folder all executors see, and how null texts are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.stored import materialised, shared_dir

__all__ = ["documents", "materialised", "shared_dir", "text_or_empty"]


def text_or_empty(column: str | Column) -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
