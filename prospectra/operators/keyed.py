"""One row per key. Winners are aggregates over a struct, so partial sums meet before the shuffle and a hot key is no hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _winner(df: DataFrame, keys: dict[str, Column], pick) -> DataFrame:
    row = F.struct(*df.columns)
    return df.groupBy(*(c.alias(f"_{name}") for name, c in keys.items())).agg(pick(row).alias("_row")).select("_row.*")


def first_of(df: DataFrame, order: str = "seq", **keys: Column) -> DataFrame:
    """The first row of each key, in the order of the input's ordinal."""
    return _winner(df, keys, lambda row: F.min_by(row, F.col(order)))


def last_of(df: DataFrame, order: str = "seq", **keys: Column) -> DataFrame:
    return _winner(df, keys, lambda row: F.max_by(row, F.col(order)))


def best_of(df: DataFrame, *score: Column, order: str = "seq", **keys: Column) -> DataFrame:
    """The row with the highest scores, compared in turn; of equals the first."""
    return _winner(df, keys, lambda row: F.max_by(row, F.struct(*score, -F.col(order))))


def candidate_keys() -> dict[str, Column]:
    return {name: F.lower(F.coalesce(name, F.lit(""))) for name in ("company_domain", "person_name", "designation")}


def best_candidates(df: DataFrame) -> DataFrame:
    """Most trusted per domain, person and title: of equal trust the last structured-data record, else the first record."""
    rank = F.when(F.col("confidence") == "HIGH", 3).when(F.col("confidence") == "MEDIUM", 2).when(F.col("confidence") == "LOW", 1).otherwise(0)
    structured = F.coalesce(F.col("extraction_method") == "json_ld", F.lit(False))
    return _winner(df, candidate_keys(), lambda row: F.max_by(row, F.struct(rank, structured, F.when(structured, F.col("seq")).otherwise(-F.col("seq")))))
