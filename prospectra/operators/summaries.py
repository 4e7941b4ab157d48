"""Counts that runs report, as long tables of metric, value and detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def counts_by(rows: DataFrame, **metrics: Column) -> DataFrame:
    """Counts of several single columns in one pass: each row stands once for every metric."""
    cells = F.explode(F.array(*(F.struct(F.lit(name).alias("metric"), c.cast("string").alias("detail")) for name, c in metrics.items())))
    return rows.select(cells.alias("x")).groupBy("x.metric", "x.detail").agg(F.count("*").cast("string").alias("value")).select("metric", "value", "detail")


def scalars(rows: DataFrame, **metrics: Column) -> DataFrame:
    """One aggregate, a row for each metric."""
    one = rows.agg(*(c.cast("string").alias(name) for name, c in metrics.items()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("metric"), F.coalesce(n, F.lit("0")).alias("value"), F.lit("").alias("detail")) for n in metrics))))


def with_zeros(counts: DataFrame, metric: str, domain: list[str]) -> DataFrame:
    """Every value of a closed list, also those that don't occur."""
    spark = counts.sparkSession
    listed = spark.createDataFrame([(metric, d) for d in domain], "metric string, detail string")
    return listed.join(counts.filter(F.col("metric") == metric), ["metric", "detail"], "left").select("metric", F.coalesce("value", F.lit("0")).alias("value"), "detail")


def run_summary(master: DataFrame, n_leads: DataFrame, n_enriched: DataFrame, joined: DataFrame) -> DataFrame:
    """Inputs, results and removals, then counts of five columns."""
    total = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("metric"), F.col("n").cast("string").alias("value"), F.lit("").alias("detail"))
    both = joined.agg(F.count("*").alias("n")).unionAll(master.agg((-F.count("*")).alias("n")))
    removed = both.agg(F.sum("n").cast("string").alias("value")).select(F.lit("duplicates_removed").alias("metric"), "value", F.lit("").alias("detail"))
    by = counts_by(master, company=F.col("company_name"), leadership_type=F.col("leadership_type"), lead_priority=F.col("lead_priority"), verification_status=F.col("verification_status"), enrichment_status=F.when(F.col("enrichment_status") == "", "NOT_PROCESSED").otherwise(F.col("enrichment_status")))
    return total(n_leads, "phase5_input_records").unionByName(total(n_enriched, "phase51_input_records")).unionByName(total(master, "final_records")).unionByName(removed).unionByName(by)


def merge_summary(leads: DataFrame, companies: DataFrame) -> DataFrame:
    of = lambda kind: F.count_if(F.col("leadership_type") == kind)
    out = scalars(
        leads, final_lead_records=F.count("*"), leads_with_email=F.count_if(F.col("company_email") != ""), leads_with_phone=F.count_if(F.col("company_phone") != ""),
        leads_with_any_contact=F.count_if(F.col("contact_status") == "FOUND"), cxo_records=of("CXO"), board_records=of("Board"), executive_leadership_records=of("Executive Leadership"),
    )
    return out.unionByName(scalars(companies, company_contact_groups=F.count("*")))


def contact_summary(pages: DataFrame) -> DataFrame:
    any_of = lambda *cs: F.count_if(F.concat(*(F.coalesce(c, F.lit("")) for c in cs)) != "")
    return scalars(
        pages, pages=F.count("*"), successful=F.count_if(F.col("status_code").rlike("^[23]")), with_email=any_of("emails", "mailto_emails"), with_phone=any_of("phone_numbers", "tel_numbers"),
        contact_pages=F.count_if(F.col("contact_page") == "YES"), with_links=any_of("contact_links"),
    )


def candidate_summary(rows: DataFrame) -> DataFrame:
    by = counts_by(rows, company=F.col("company_name"), extraction_method=F.coalesce("extraction_method", F.lit("")), confidence=F.col("confidence"))
    return by.filter("metric <> 'confidence'").unionByName(with_zeros(by, "confidence", ["HIGH", "MEDIUM", "LOW"]))


def enrichment_summary(rows: DataFrame) -> DataFrame:
    by = counts_by(rows, enrichment_status=F.col("enrichment_status"), enrichment_confidence=F.col("enrichment_confidence"))
    sums = scalars(rows, verified=F.count_if(F.col("verification_status") == "VERIFIED"), profile_links=F.count_if(F.col("professional_profile_url") != ""), bio_records=F.count_if(F.col("public_bio_excerpt") != ""))
    return by.filter("metric = 'enrichment_status'").unionByName(with_zeros(by, "enrichment_confidence", ["HIGH", "MEDIUM", "LOW"])).unionByName(sums)
