"""Text columns: white space, names, titles, keys. A null counts as empty everywhere."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from . import rules as R


def column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body) -> Column:
    """body(value) with value evaluated once and standing once in the plan, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns evaluated once a row: filters and columns on top of them aren't merged into them, as they are through a projection."""
    return df.select(*(c for c in df.columns if c not in columns), F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def clean_text(value: str | Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.btrim(F.regexp_replace(F.coalesce(column(value).cast("string"), F.lit("")), r"(?U)[\s&&[^ ]]\s*+| \s++", " "))  # lone spaces stay untouched


def match_key(value: str | Column) -> Column:
    return F.lower(clean_text(value))


def strip(value: Column, characters: str) -> Column:
    return F.btrim(value, F.lit(characters))


def company_name_valid(value: str | Column) -> Column:
    return bind(clean_text(value), lambda x: F.length(x).between(2, 200) & x.rlike(f"[{R.LATIN}0-9]"))


def person_name(value: str | Column) -> Column:
    """At extraction: one leading honorific goes, then punctuation at the ends."""
    return strip(F.regexp_replace(clean_text(value), rf"(?i)^(?:{'|'.join(R.HONORIFICS)})\.?\s+", ""), " -–—:|,")


def person_name_strict(value: str | Column) -> Column:
    """At validation: no space before punctuation; an honorific stays."""
    return strip(F.regexp_replace(clean_text(value), r"\s+([,.'’])", "$1"), " -–—|")


def designation(value: str | Column) -> Column:
    """Labels of the user interface go, one kind after the other."""
    x = clean_text(value)
    for phrase in R.ROLE_NOISE:
        x = F.regexp_replace(x, rf"(?i)\s*{re.escape(phrase)}\s*", " ")
    return strip(F.regexp_replace(x, r"\s+", " "), " -–—|,;")


def lookup(key: Column, table: dict[str, object], default: Column) -> Column:
    """A short fixed table as a map."""
    entries = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(entries[key], default)


def export_type(value: str | Column) -> Column:
    return bind(clean_text(value), lambda x: lookup(F.lower(x), R.EXPORT_TYPES, x))


def row_clean(df: DataFrame) -> DataFrame:
    """Every string column clean; the domain without www., the type in its export spelling."""
    special = {"company_domain": lambda c: F.regexp_replace(clean_text(c), r"^www\.", ""), "leadership_type": export_type}
    return df.select(*(special.get(name, clean_text)(name).alias(name) if kind == "string" else F.col(name) for name, kind in df.dtypes))
