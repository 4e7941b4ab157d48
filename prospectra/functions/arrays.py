"""Cells that hold several values, and columns that go by several names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import rules as R
from .text import clean_text, column


def split_values(value: str | Column) -> Column:
    return F.filter(F.transform(F.split(clean_text(value), "[;,|]+"), clean_text), lambda x: x != "")


def unique_values(values: str | Column) -> Column:
    """Clean values that aren't empty, each once whatever its case; the first spelling and place win."""
    cleaned = F.filter(F.transform(column(values), clean_text), lambda x: x != "")
    return F.aggregate(cleaned, F.array().cast("array<string>"), lambda a, x: F.when(F.exists(a, lambda y: F.lower(y) == F.lower(x)), a).otherwise(F.concat(a, F.array(x))))


def unique_join(values: str | Column, separator: str = " | ") -> Column:
    return F.array_join(unique_values(values), separator)


def _named(df: DataFrame, names: list[str]) -> list[str]:
    """df's columns among names, whatever their case, in names' order."""
    have = {c.lower(): c for c in df.columns}
    return [have[n] for n in names if n in have]


def first_value(df: DataFrame, names: list[str]) -> Column:
    found = [F.nullif(clean_text(c), F.lit("")) for c in _named(df, names)]
    return F.coalesce(*found, F.lit(""))


def collect_values(df: DataFrame, names: list[str]) -> Column:
    found = [split_values(c) for c in _named(df, names)]
    return F.concat(*found) if found else F.array().cast("array<string>")


def name_tokens(value: str | Column) -> Column:
    found = F.transform(F.regexp_extract_all(clean_text(value), F.lit(f"[{R.LATIN}]{{2,}}"), F.lit(0)), F.lower)
    return F.filter(found, lambda t: ~t.isin(*R.NAME_STOP_WORDS))
