"""Leads: validation, enrichment, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import classify as C
from ..functions import predicates as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from .keyed import best_of, first_of, last_of

GRAM = 5


def titles_naming_others(leads: DataFrame) -> DataFrame:
    """(title_key, least, greatest): titles that hold names of five letters or more, with the extremes of the names found.

    A name within a title shares its first five letters with one of the title's five-letter pieces: an equi-join finds the pairs to look at.
    """
    names = leads.select(F.lower(T.person_name_strict("person_name")).alias("name")).distinct().filter(F.length("name") >= GRAM)
    titles = leads.select(F.lower(T.designation("designation")).alias("title_key")).distinct().filter(F.length("title_key") >= GRAM)
    pieces = titles.select("title_key", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("title_key") - (GRAM - 1)), lambda i: F.substring(F.col("title_key"), i, F.lit(GRAM))))).alias("gram"))
    found = pieces.join(names.withColumn("gram", F.substring("name", 1, GRAM)), "gram").filter(F.contains("title_key", "name"))
    return found.groupBy("title_key").agg(F.min("name").alias("least"), F.max("name").alias("greatest"))


def names_another_person(leads: DataFrame) -> DataFrame:
    """leads and names_another: the title holds a name of the input that isn't the row's own."""
    keyed = leads.withColumn("title_key", F.lower(T.designation("designation"))).withColumn("_own", F.lower(T.person_name_strict("person_name")))
    joined = keyed.join(titles_naming_others(leads), "title_key", "left")
    other = F.coalesce((F.col("least") != F.col("_own")) | (F.col("greatest") != F.col("_own")), F.lit(False))
    return joined.withColumn("names_another", other).drop("title_key", "_own", "least", "greatest")


def validate(leads: DataFrame) -> DataFrame:
    """Rows in their validated spelling with validation_status, validation_reason and quality_score."""
    x = names_another_person(leads)
    reason = C.validation_reason("person_name", "designation", F.col("names_another"), "source_url", "company_name")
    score = C.quality_score("person_name", "designation", "leadership_type", "extraction_method", "source_url", "company_name")
    kind = C.leadership_type("leadership_type", "designation")
    out = x.withColumns({"validation_reason": reason, "quality_score": score.cast("int"), "leadership_type": kind, "company_name": T.clean_text("company_name"), "person_name": T.person_name_strict("person_name"), "designation": T.designation("designation"), "source_url": U.strict_url("source_url")})
    return out.withColumn("validation_status", F.when(F.col("validation_reason") == "passed_validation", "VALID").otherwise("REJECTED")).drop("names_another")


def split_by_status(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validated.filter("validation_status = 'VALID'"), validated.filter("validation_status <> 'VALID'")


def final_leads(validated: DataFrame) -> DataFrame:
    """The best valid record of each company, person and title, ready for export."""
    valid, _ = split_by_status(validated)
    return best_of(valid, F.col("quality_score"), **{k: F.lower(k) for k in ("company_name", "person_name", "designation")}).withColumn("final_status", F.lit("READY"))


def identity(df: DataFrame) -> dict:
    return {k: F.lower(F.coalesce(k, F.lit(""))) for k in ("company_name", "person_name", "designation")}


def join_enrichment(leads: DataFrame, enriched: DataFrame) -> DataFrame:
    """Master rows: a lead's own fields rule, its last enrichment record fills in what it has."""
    base = T.row_clean(leads)
    more = T.row_clean(enriched)
    fields = [f for f in R.ENRICHED_FIELDS if f in more.columns]
    more = last_of(more, **identity(more)).select(*(c.alias(f"_{k}") for k, c in identity(more).items()), *(F.nullif(f, F.lit("")).alias(f"new_{f}") for f in fields))
    joined = base.select("*", *(c.alias(f"_{k}") for k, c in identity(base).items())).join(more, [f"_{k}" for k in ("company_name", "person_name", "designation")], "left")
    old = {f: F.col(f) if f in base.columns else F.lit("") for f in R.ENRICHED_FIELDS}
    merged = {f: F.coalesce(F.col(f"new_{f}"), old[f]) if f in fields else old[f] for f in R.ENRICHED_FIELDS}
    if "validation_status" in base.columns:
        merged["verification_status"] = F.when(F.col("validation_status") == "VALID", "VERIFIED").otherwise(merged["verification_status"])
    out = joined.withColumns(merged | {"lead_priority": C.priority("leadership_type")})
    return out.select("seq", *(F.col(f) if f in out.columns else F.lit("").alias(f) for f in R.MASTER_FIELDS))


def master(leads: DataFrame, enriched: DataFrame) -> DataFrame:
    joined = join_enrichment(leads, enriched)
    return first_of(joined, **identity(joined))


PRIORITY_RANK = {"HIGH": 1, "MEDIUM": 2, "LOW": 3}


def sorted_master(rows: DataFrame) -> DataFrame:
    return rows.orderBy(T.lookup(F.col("lead_priority"), PRIORITY_RANK, F.lit(9)), F.lower("company_name"), F.lower("person_name"), "seq")


def company_sources(rows: DataFrame) -> DataFrame:
    """Each company's pages once, sorted."""
    x = rows.select("seq", "company_name", "company_domain", "source_url")
    once = first_of(x, **{c: F.lower(F.coalesce(c, F.lit(""))) for c in ("company_name", "company_domain", "source_url")})
    return once.orderBy(F.lower("company_name"), F.lower("source_url"), "seq")


def by_type(rows: DataFrame) -> dict[str, DataFrame]:
    """What the typed files hold; other types are in the master file only."""
    return {kind: rows.filter(F.col("leadership_type") == kind) for kind in R.PRIORITIES}


def candidate_links(anchors: DataFrame, needs_fragment: bool = True) -> DataFrame:
    """Profile links (lead rows with abs_url, anchor, context): scored, on the company's own hosts, each URL once, the best eight of a lead."""
    x = anchors.withColumn("url", U.strict_url("abs_url")).filter("url <> ''")
    x = first_of(x, lead=F.col("lead"), url=F.col("url"))
    x = x.filter(P.same_company_domain("url", "homepage") & P.profile_url("url", "person_name", needs_fragment))
    x = x.withColumn("score", C.link_score("person_name", "designation", "url", "anchor", "context")).filter("score > 0").withColumn("context", F.substring("context", 1, 500))
    from pyspark.sql import Window as W

    ranked = x.withColumn("place", F.row_number().over(W.partitionBy("lead").orderBy(F.desc("score"), "seq")))
    return ranked.filter(F.col("place") <= R.MAX_PROFILES)


def best_profile(links: DataFrame) -> DataFrame:
    return links.filter((F.col("place") == 1) & (F.col("score") >= R.MIN_PROFILE_SCORE))


def enrich(leads: DataFrame, pages: DataFrame, links: DataFrame) -> DataFrame:
    """Evidence of leads (seq, person_name, designation, source_url, validation_status, ...) on their own source pages.

    pages: source_url, final_url, status, content_type, error, page_text; a page is parsed once however many leads it has.
    links: best profile per lead (lead, url). Locations are never inferred.
    """
    from ..functions.arrays import name_tokens
    from ..functions.extract import bio_excerpt

    x = leads.withColumn("source_url", U.strict_url("source_url")).join(pages.withColumnRenamed("source_url", "_page"), F.col("source_url") == F.col("_page"), "left")
    x = x.join(links.select(F.col("lead").alias("_lead"), F.col("url").alias("_profile")), F.col("seq") == F.col("_lead"), "left")
    fetched = C.source_status("status", "content_type", F.when(F.col("_page").isNull(), F.lit("NotInSnapshot")).otherwise(F.col("error")))
    low = T.match_key("page_text")
    person = F.forall(name_tokens("person_name"), lambda t: F.contains(low, t))
    title = (T.match_key("designation") != "") & F.contains(low, T.match_key("designation"))
    status = F.when(T.clean_text("validation_status") == "VALID", "VERIFIED").when(T.clean_text("validation_status") == "", "UNKNOWN").otherwise(T.clean_text("validation_status"))
    x = x.withColumn("_no_source", F.col("source_url") == "").withColumn("verification_status", status)
    x = x.withColumn("source_fetch_status", F.when(F.col("_no_source"), "").otherwise(fetched))
    ok = F.col("source_fetch_status") == "ok"
    x = x.withColumn("_outcome", C.enrichment_outcome("source_fetch_status", F.col("verification_status") == "VERIFIED", person, title, F.col("_profile").isNotNull()))
    bio = F.when(ok, bio_excerpt("page_text", "person_name", "designation")).otherwise("")
    x = x.withColumn("public_bio_excerpt", bio)
    profile = F.when(ok, F.coalesce("_profile", F.lit(""))).otherwise("")
    return x.withColumns({
        "company_domain": F.coalesce(F.nullif(T.clean_text("company_domain"), F.lit("")), U.host("source_url")),
        "verification_source": F.when(ok, F.coalesce(F.nullif(U.strict_url("final_url"), F.lit("")), F.col("source_url"))).otherwise(F.col("source_url")),
        "professional_profile_url": profile,
        "public_bio_url": profile,
        "public_location": F.lit(""),
        "enrichment_method": F.when(F.col("public_bio_excerpt") == "", "company_owned_source").otherwise("company_owned_source;company_owned_page"),
        "enrichment_confidence": F.when(F.col("_no_source"), "LOW").otherwise(F.col("_outcome.confidence")),
        "enrichment_status": F.when(F.col("_no_source"), "missing_source_url").otherwise(F.col("_outcome.status")),
    }).drop("_page", "_lead", "_profile", "_no_source", "_outcome", "page_text", "status", "content_type", "error", "final_url")
