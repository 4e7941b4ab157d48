"""Company contacts: records, an index by company and domain, and the three-step look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import arrays as A
from ..functions import classify as C
from ..functions import extract as X
from ..functions import predicates as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from .keyed import first_of

CELLS = {"email": "company_email", "phone": "company_phone", "link": "contact_page_url"}


def contact_records(pages: DataFrame, include_link_contacts: bool = False) -> DataFrame:
    """A record per page row, from whatever its columns are called.

    include_link_contacts: addresses and numbers found in links and contact links count too; by default they don't.
    """
    extra = lambda names, more: names + more if include_link_contacts else names
    domain = U.domain_of(A.first_value(pages, R.DOMAIN_COLUMNS))
    source = A.first_value(pages, R.URL_COLUMNS)
    emails = F.filter(F.transform(A.collect_values(pages, extra(R.EMAIL_COLUMNS, ["mailto_emails"])), F.lower), lambda e: P.valid_email(e))
    numbers = F.filter(F.transform(A.collect_values(pages, extra(R.PHONE_COLUMNS, ["tel_numbers"])), X.phone_cell), lambda p: p != "")
    return pages.select(
        "seq", A.first_value(pages, R.COMPANY_COLUMNS).alias("company_name"), F.when(domain == "", U.domain_of(source)).otherwise(domain).alias("company_domain"),
        A.unique_values(emails).alias("email"), A.unique_values(numbers).alias("phone"), source.alias("contact_source_url"),
        A.unique_values(A.collect_values(pages, extra(R.LINK_COLUMNS, ["contact_links"]))).alias("link"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    """Rows (seq, company_key, domain_key, company_name, company_domain, contact_source_url, email, phone, link) as one per key pair.

    Values are made distinct per key before they are gathered, so a group gathers its distinct values, not its rows.
    """
    keys = ["company_key", "domain_key"]
    filled = lambda c: F.coalesce(F.min_by(F.nullif(c, F.lit("")), F.when(F.col(c) != "", F.col("seq"))), F.lit("")).alias(c)
    heads = rows.groupBy(*keys).agg(F.min("seq").alias("seq"), *(filled(c) for c in ("company_name", "company_domain", "contact_source_url")))
    cells = rows.select("seq", *keys, F.explode(F.create_map(*(x for k in CELLS for x in (F.lit(k), F.col(k))))).alias("kind", "cell")).select("seq", *keys, "kind", F.posexplode("cell").alias("place", "value"))
    once = cells.groupBy(*keys, "kind", F.lower("value").alias("_low")).agg(F.min(F.struct("seq", "place", "value")).alias("first"))
    gathered = once.groupBy(*keys).agg(*(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("first")))), lambda x: x["value"]), " | ").alias(name) for k, name in CELLS.items()))
    return heads.join(gathered, keys, "left").select("seq", *keys, "company_name", "company_domain", *(F.coalesce(c, F.lit("")).alias(c) for c in CELLS.values()), "contact_source_url")


def contact_index(records: DataFrame) -> DataFrame:
    """One row per company and domain that has either."""
    keyed = records.withColumn("company_key", T.match_key("company_name")).withColumn("domain_key", U.domain_of("company_domain"))
    return _merged(keyed.filter("company_key <> '' OR domain_key <> ''"))


def find_contacts(leads: DataFrame, index: DataFrame) -> DataFrame:
    """leads with the contact cells of their company and domain, else of the company's first entry, else of the domain's first; found says if any."""
    cells = ["company_email", "company_phone", "contact_source_url", "contact_page_url"]
    packed = index.select("seq", "company_key", "domain_key", F.struct(*cells).alias("hit"))
    keyed = leads.withColumn("_company", T.match_key("company_name")).withColumn("_domain", U.domain_of("company_domain"))
    exact = packed.select(F.col("company_key").alias("_company"), F.col("domain_key").alias("_domain"), F.col("hit").alias("_exact"))
    company = first_of(packed.filter("company_key <> ''"), k=F.col("company_key")).select(F.col("company_key").alias("_company"), F.col("hit").alias("_by_company"))
    domain = first_of(packed.filter("domain_key <> ''"), k=F.col("domain_key")).select(F.col("domain_key").alias("_domain"), F.col("hit").alias("_by_domain"))
    joined = keyed.join(exact, ["_company", "_domain"], "left").join(company, "_company", "left").join(domain, "_domain", "left")
    hit = F.coalesce("_exact", "_by_company", "_by_domain")
    out = joined.withColumn("_hit", hit).withColumn("found", F.col("_hit").isNotNull())
    return out.select(*(c for c in leads.columns if c not in cells), *(F.coalesce(f"_hit.{c}", F.lit("")).alias(c) for c in cells), "found")


def with_contacts(leads: DataFrame, index: DataFrame) -> DataFrame:
    out = find_contacts(leads, index)
    return out.withColumn("_o", C.contact_outcome(F.col("found"), F.col("company_email"), F.col("company_phone"))).select("*", "_o.*").drop("_o", "found")


def distinct_leads(rows: DataFrame) -> DataFrame:
    return first_of(rows, company=T.match_key("company_name"), person=T.match_key("person_name"), title=T.match_key("designation"))


def company_contacts(rows: DataFrame) -> DataFrame:
    """One row per company and domain of leads with contacts, sorted."""
    keyed = rows.select(
        "seq", T.match_key("company_name").alias("company_key"), U.domain_of("company_domain").alias("domain_key"), T.clean_text("company_name").alias("company_name"),
        U.domain_of("company_domain").alias("company_domain"), F.coalesce("contact_source_url", F.lit("")).alias("contact_source_url"),
        *(A.split_values(name).alias(k) for k, name in CELLS.items()),
    )
    out = _merged(keyed)
    found = (F.col("company_email") != "") | (F.col("company_phone") != "")
    out = out.withColumn("contact_status", F.when(found, "FOUND").otherwise("NOT_FOUND")).withColumn("contact_confidence", F.when(found, "HIGH").otherwise("LOW"))
    return out.drop("company_key", "domain_key").orderBy(F.lower("company_name"), F.lower("company_domain"))


def without_placeholders(emails: DataFrame, column: str = "email") -> DataFrame:
    """Rows whose address isn't at a placeholder domain; the three domains are a broadcast table."""
    spark = emails.sparkSession
    domains = spark.createDataFrame([(d,) for d in R.PLACEHOLDER_DOMAINS], "_domain string")
    return emails.join(F.broadcast(domains), F.substring_index(column, "@", -1) == F.col("_domain"), "left_anti")
