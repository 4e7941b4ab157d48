"""Map-only and windowed stages over streams.

Cleaning, classification and extraction are per row, so the same columns serve a streaming frame; whole-table stages (deduplication by first
row, merging) stay with batches, except for exact duplicates within a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions import classify as C
from ..functions import extract as X
from ..functions import text as T


def read_stream(spark: SparkSession, folder: str, schema: StructType | str, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def extract_contacts(texts: DataFrame, text: str = "text") -> DataFrame:
    """E-mail addresses and phone numbers of each text as it arrives."""
    return texts.withColumn("emails", X.emails(text)).withColumn("phones", X.phones(text))


def classify_leads(leads: DataFrame) -> DataFrame:
    """Titles in their clean spelling with their type, as they arrive."""
    return leads.withColumn("leadership_type", C.leadership_type("leadership_type", "designation")).withColumn("designation", T.designation("designation"))


def windowed_counts(rows: DataFrame, time: str, *by: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts per window and columns; rows later than the watermark are left out."""
    return rows.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n"))


def distinct_rows(rows: DataFrame, time: str, *keys: str, late: str = "30 minutes") -> DataFrame:
    """Each key's first row within the watermark; state is dropped behind it."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def write_stream(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet, exactly once, for what has arrived so far."""
    return rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
