"""CSV and table scans at the pipeline's edges. Header names are matched whatever their case; every text column stays a string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from ..operators.keyed import first_of

WEBSITE_NAMES = ["website", "website_url", "url"]


def read_csv(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """A UTF-8 CSV with a header (a byte order mark is fine); a missing file raises, or gives an empty table if it isn't required."""
    from pyspark.errors import AnalysisException

    try:
        raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "seq long")
    return raw.fillna("").withColumn("seq", F.monotonically_increasing_id())


def scan_companies(spark: SparkSession, path: str) -> DataFrame:
    """(seq, company_name, website) of rows that name either."""
    raw = read_csv(spark, path, required=False)
    have = {c.lower(): c for c in raw.columns}
    website = next((have[n] for n in WEBSITE_NAMES if n in have), None)
    if "company_name" not in have or website is None:
        return spark.createDataFrame([], "seq long, company_name string, website string")
    return named_companies(raw.select("seq", F.col(have["company_name"]).alias("company_name"), F.col(website).alias("website")))


def named_companies(rows: DataFrame) -> DataFrame:
    return rows.select("seq", T.clean_text("company_name").alias("company_name"), U.input_url("website").alias("website")).filter("company_name <> '' OR website <> ''")


def distinct_companies(rows: DataFrame) -> DataFrame:
    """Each name and host once; the first row wins."""
    x = named_companies(rows).withColumn("company_domain", U.host("website"))
    return first_of(x, name=F.lower("company_name"), domain=F.col("company_domain"))


def reachable_companies(rows: DataFrame) -> DataFrame:
    return rows.filter(F.upper(F.trim("reachable")) == "YES")


def leadership_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.lower(F.trim("page_type")).isin(*R.LEADERSHIP_PAGE_TYPES) & (F.trim("page_url") != ""))
