"""Writers: CSV or Parquet with a declared column order; an empty result still writes its header or schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _flat(df: DataFrame) -> DataFrame:
    """Lists as cells, as CSV has none."""
    return df.select(*(F.array_join(c, "; ").alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes))


def write_table(df: DataFrame, path: str, columns: list[str] | None = None, format: str = "parquet") -> None:
    """The given columns, others left out, those that are missing empty."""
    names = columns or df.columns
    out = df.select(*(F.col(c) if c in df.columns else F.lit("").alias(c) for c in names))
    writer = (_flat(out) if format == "csv" else out).write.mode("overwrite")
    writer.option("header", True).option("escape", '"').csv(path) if format == "csv" else writer.parquet(path)


def write_split(df: DataFrame, path: str, parts: dict[str, Column], columns: list[str] | None = None, format: str = "parquet") -> None:
    """One folder per part, from one stored copy of the rows: the source is computed once."""
    write_table(df, f"{path}/all", columns, "parquet")
    stored = df.sparkSession.read.parquet(f"{path}/all")
    for name, condition in parts.items():
        write_table(stored.filter(condition), f"{path}/{name}", columns, format)
