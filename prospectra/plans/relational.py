"""Queries over joins, aggregates, orders and set operations, with their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import arrays as A
from ..functions import classify as C
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from ..operators import contacts as K
from ..operators import discovery
from ..operators import keyed
from ..operators import leads as L
from ..operators import summaries as S
from ..sources import tables
from ..sources.stored import spread
from . import duck as D
from . import fixtures
from .scalar import found_emails, links_sql, resolved_links

LEAD = ["seq", "company_name", "person_name", "designation", "leadership_type", "quality_score", "validation_status", "validation_reason", "source_url"]
_ENRICHED = """SELECT seq, company_name, person_name, designation, '' AS company_domain, CASE WHEN seq % 2 = 0 THEN 'CHECKED' ELSE ' ' END AS verification_status, source_url AS verification_source,
 CASE seq % 3 WHEN 0 THEN 'person_and_designation_found' WHEN 1 THEN 'no_additional_person_evidence_found' ELSE '' END AS enrichment_status, confidence AS enrichment_confidence,
 CASE WHEN seq % 4 = 0 THEN 'https://p.example/' || CAST(seq AS STRING) ELSE '' END AS professional_profile_url, CASE WHEN seq % 5 = 0 THEN 'bio  text' ELSE '' END AS public_bio_excerpt FROM {leads} WHERE seq % 7 <> 0"""


def _load(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fixtures.load(spark, sf_dir, name)


leads, contacts, companies, crawl = map(_load, ("leads", "contacts", "companies_input", "crawl"))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_ENRICHED, leads=leads(spark, sf_dir))


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.master(L.final_leads(L.validate(leads(spark, sf_dir))), enriched(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.contact_index(K.contact_records(contacts(spark, sf_dir)))


def _with_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.with_contacts(leads(spark, sf_dir), _index(spark, sf_dir))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = C.page_type("crawl", "anchor", "homepage")
    x = resolved_links(spark, sf_dir).withColumn("page_type", kind)
    return x.select("seq", "page_id", F.col("crawl").alias("url"), "page_type", C.page_score(F.col("page_type")).alias("score"), T.clean_text("anchor").alias("anchor_text")).filter("url <> ''")


def input_scan_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.distinct_companies(companies(spark, sf_dir))


def merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.merge_candidates(_candidates(spark, sf_dir), "page_id")


def pages_top30(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_host = _candidates(spark, sf_dir).withColumn("company", U.host("url")).filter(F.col("score") >= R.MIN_PAGE_SCORE)
    return discovery.top_pages(discovery.merge_candidates(by_host, "company"), "company").select("company", "url", "score", "place")


def page_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _candidates(spark, sf_dir).withColumn("company_name", U.host("url"))
    return discovery.distinct_pages(pages.withColumnRenamed("url", "page_url")).select("company_name", "page_url", "score", "seq")


def candidate_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.best_candidates(leads(spark, sf_dir)).select("seq", "person_name", "designation", "confidence", "extraction_method")


def quality_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.final_leads(L.validate(leads(spark, sf_dir))).select(*LEAD, "final_status")


def validation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.validate(leads(spark, sf_dir)).select(LEAD)


def valid_rejected_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = L.split_by_status(L.validate(leads(spark, sf_dir)))
    return valid.select("seq", F.lit("validated").alias("part")).unionAll(rejected.select("seq", F.lit("rejected").alias("part")))


def other_person_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.names_another_person(leads(spark, sf_dir)).select("seq", "names_another")


def name_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads(spark, sf_dir).select(T.person_name_strict("person_name").alias("person")).filter("person <> ''").distinct()


def enrichment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.join_enrichment(leads(spark, sf_dir).withColumn("validation_status", F.when(F.col("seq") % 6 == 0, "VALID").otherwise("REJECTED")), enriched(spark, sf_dir)).select("seq", "company_domain", "lead_priority", "verification_status", "verification_source", "enrichment_status", "professional_profile_url", "public_bio_excerpt")


def master_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _master(spark, sf_dir).select("seq", "company_name", "person_name", "designation", "lead_priority", "enrichment_status")


def leads_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = L.sorted_master(_master(spark, sf_dir))
    return ordered.select("seq", "lead_priority", "company_name", "person_name")


def company_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.company_sources(T.row_clean(leads(spark, sf_dir))).select("seq", "company_name", "company_domain", "source_url")


def typed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [df.select("seq", F.lit(kind).alias("file")) for kind, df in L.by_type(_master(spark, sf_dir)).items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    final, more = L.final_leads(L.validate(leads(spark, sf_dir))), enriched(spark, sf_dir)
    return S.run_summary(L.master(final, more), final, more, L.join_enrichment(final, more))


def contact_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = K.contact_records(contacts(spark, sf_dir))
    return x.select("seq", "company_name", "company_domain", "contact_source_url", *(F.array_join(c, " | ").alias(c) for c in ("email", "phone", "link")))


def contact_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir)


def contact_fallback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_contacts(spark, sf_dir).select("seq", "company_email", "company_phone", "contact_source_url", "contact_page_url", "contact_status", "contact_confidence")


def output_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.distinct_leads(leads(spark, sf_dir)).select("seq", "company_name", "person_name", "designation")


def company_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.company_contacts(_with_contacts(spark, sf_dir)).drop("seq")


def merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_contacts(spark, sf_dir)
    return S.merge_summary(rows, K.company_contacts(rows))


def email_domain_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.extract import EMAIL

    docs = fixtures.load(spark, sf_dir, "phrases")
    found = docs.select("seq", F.explode(F.transform(F.regexp_extract_all("text", F.lit(EMAIL), F.lit(0)), F.lower)).alias("email"))
    return K.without_placeholders(found)


def crawl_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that point to pages of the snapshot, with what came back."""
    links = resolved_links(spark, sf_dir).select("seq", "crawl")
    pages = crawl(spark, sf_dir).select(F.concat(F.lit("https://host"), F.col("seq") % 7, F.lit(".example/leadership"), F.when(F.col("seq") < 7, "/").otherwise("")).alias("page"), "seq", "status").groupBy("page").agg(F.min_by("status", "seq").alias("status"))
    return links.join(pages, links.crawl == pages.page, "left").select("seq", "status")


def first_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = contacts(spark, sf_dir).drop("page_url").withColumnRenamed("contact_page", "Contact_Page")
    return x.select("seq", A.first_value(x, R.URL_COLUMNS).alias("source"), A.first_value(x, R.EMAIL_COLUMNS).alias("email"))


def collect_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = contacts(spark, sf_dir)
    return x.select("seq", F.array_join(A.collect_values(x, R.EMAIL_COLUMNS), "~").alias("emails"), F.array_join(A.collect_values(x, R.PHONE_COLUMNS), "~").alias("phones"))


def row_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.row_clean(leads(spark, sf_dir))


def page_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.counts_by(_candidates(spark, sf_dir), page_type=F.col("page_type")).orderBy("detail")


def candidate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.candidate_summary(leads(spark, sf_dir))


def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = L.validate(leads(spark, sf_dir))
    return S.counts_by(x, company=F.col("company_name"), leadership_type=F.col("leadership_type"))


def enrichment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.enrichment_summary(enriched(spark, sf_dir))


def contact_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = contacts(spark, sf_dir).select(F.concat(F.lit(""), F.col("seq") % 5 + 1, F.lit("00")).alias("status_code"), "emails", F.lit("").alias("mailto_emails"), "phone_numbers", F.col("contact_url").alias("tel_numbers"), "contact_page", F.col("contact_url").alias("contact_links"))
    return S.contact_summary(x)


def reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("error").isNull() & (F.col("status") < 400)
    return S.scalars(crawl(spark, sf_dir), reachable=F.count_if(ok), not_reachable=F.count_if(~ok))


def candidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four methods' candidates as one table; every method keeps its own."""
    x = leads(spark, sf_dir)
    parts = [x.filter(F.col("extraction_method") == m).select("seq", "person_name", F.lit(m).alias("method")) for m in ("json_ld", "semantic_card", "sibling_pair", "local_parent")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def sitemap_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = resolved_links(spark, sf_dir).select("seq", "page_id", F.col("abs_url").alias("url"))
    return keyed.first_of(x.unionByName(x.withColumn("seq", F.col("seq") + 1_000_000_000)), p=F.col("page_id"), u=F.col("url"))


def common_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    homes = crawl(spark, sf_dir).select("seq", F.concat(F.lit("https://www.Host"), F.col("seq"), F.lit(".example/x/y")).alias("homepage"))
    return discovery.probes(homes).select("seq", "path", "expected_type", "candidate")


def _profile_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads as people looked for on pages: each page has one, its links are the candidates."""
    x = resolved_links(spark, sf_dir)
    return x.select("seq", F.col("page_id").alias("lead"), "homepage", "abs_url", "anchor", F.concat_ws(" ", "anchor", "person_name").alias("context"), "person_name", "designation")


def profile_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.candidate_links(_profile_anchors(spark, sf_dir), needs_fragment=False).select("lead", "seq", "url", "score", "place")


def best_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.best_profile(L.candidate_links(_profile_anchors(spark, sf_dir))).select("lead", "url", "score")


_BIO = "'Profile of ' || coalesce(person_name, '') || ' who serves as ' || coalesce(designation, '') || ' at the company since the beginning of its history.'"


def bio_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.extract import bio_excerpt as excerpt

    x = spread(leads(spark, sf_dir).select("seq", "person_name", "designation"), "seq").withColumn("page", F.expr(f"repeat('x ', int(seq % 90)) || {_BIO} || repeat(' tail', int(seq % 200))"))
    return x.select("seq", excerpt("page", "person_name", "designation").alias("excerpt"))


NAMES = """input_scan_dedupe merge_candidates pages_top30 page_dedupe candidate_dedupe quality_dedupe validation_status valid_rejected_split other_person_semi_join name_set
enrichment_join master_dedupe leads_sorted company_sources typed_export run_summary contact_record contact_index contact_fallback_join output_dedupe company_contacts merge_summary
email_domain_anti_join crawl_lookup_join first_value collect_values row_clean page_type_counts candidate_summary type_counts enrichment_summary contact_summary reachability
candidate_union sitemap_distinct common_paths profile_links best_profile bio_excerpt""".split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}


def oracle_sql() -> dict[str, str]:
    w = fixtures.with_duck
    name, title, url, company = D.person_strict("person_name"), D.title("designation"), D.strict_url("source_url"), D.clean("company_name")
    another = f"EXISTS (SELECT 1 FROM names WHERE length(names.n) >= 5 AND names.n <> lower({name}) AND contains(lower({title}), names.n))"
    names = f"names AS (SELECT DISTINCT lower({name}) AS n FROM leads)"
    validated = (
        f"{w('leads')}, {names}, validated AS (SELECT seq, {company} AS company_name, company_domain, {name} AS person_name, {title} AS designation, {D.leadership('leadership_type', 'designation')} AS leadership_type,"
        f" CAST({D.quality('person_name', 'designation', 'leadership_type', 'extraction_method', 'source_url', 'company_name')} AS INT) AS quality_score, {url} AS source_url,"
        f" CASE WHEN NOT {D.person_like('person_name')} THEN 'invalid_person_name' WHEN NOT {D.clean_title('designation')} THEN 'invalid_designation' WHEN {another} THEN 'designation_contains_other_person'"
        f" WHEN {url} = '' THEN 'missing_source_url' WHEN {company} = '' THEN 'missing_company' ELSE 'passed_validation' END AS validation_reason FROM leads),"
        " v AS (SELECT *, CASE validation_reason WHEN 'passed_validation' THEN 'VALID' ELSE 'REJECTED' END AS validation_status FROM validated)"
    )
    once = lambda source, keys, order: f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
    low = "lower(company_name), lower(person_name), lower(designation)"
    final = f"{validated}, final AS ({once('v', low, 'quality_score DESC, seq').replace(' QUALIFY', ' WHERE validation_status = ' + D.q('VALID') + ' QUALIFY')}), enriched AS ({_ENRICHED.replace('{leads}', 'leads')})"
    clean = D.clean
    domain = f"regexp_replace({clean('company_domain')}, '^www\\.', '')"
    cleaned = lambda source: f"(SELECT * REPLACE ({clean('company_name')} AS company_name, {clean('person_name')} AS person_name, {clean('designation')} AS designation, {domain} AS company_domain) FROM {source})"
    filled = [f for f in R.ENRICHED_FIELDS if f in ("company_domain", "verification_status", "verification_source", "enrichment_status", "enrichment_confidence", "professional_profile_url", "public_bio_excerpt")]
    last = f"last_e AS ({once(cleaned('enriched'), low, 'seq DESC')})"

    def join(source: str) -> str:
        fields = {f: f"coalesce(nullif({domain.replace('company_domain', 'e.company_domain') if f == 'company_domain' else clean('e.' + f)}, ''), {('b.' + f) if f == 'company_domain' else D.q('')})" for f in filled}
        fields["verification_status"] = f"CASE WHEN b.validation_status = 'VALID' THEN 'VERIFIED' ELSE {fields['verification_status']} END"
        kind = D.case(D.key("b.leadership_type"), R.EXPORT_TYPES, clean("b.leadership_type"))
        return (
            f"joined AS (SELECT b.seq, b.company_name, b.person_name, b.designation, {kind} AS leadership_type, {D.case('(' + kind + ')', R.PRIORITIES, D.q('LOW'))} AS lead_priority, {', '.join(f'{x} AS {f}' for f, x in fields.items())}"
            f" FROM {cleaned(source)} b LEFT JOIN last_e e ON lower(b.company_name) = lower(e.company_name) AND lower(b.person_name) = lower(e.person_name) AND lower(b.designation) = lower(e.designation))"
        )

    master = f"{final}, {last}, {join('final')}, master AS ({once('joined', low, 'seq')})"
    cells = lambda *cs: D.unique("list_concat(" + ", ".join(cs) + ")") if len(cs) > 1 else D.unique(cs[0])
    email_list = f"list_filter(list_transform(list_concat({D.values('emails')}, {D.values('contact_email')}), lambda e: lower(e)), lambda e: {D.email('e')})"
    phone_list = f"list_filter(list_transform({D.values('phone_numbers')}, lambda p: {D.phone_cell('p')}), lambda p: p <> '')"
    source = f"coalesce(nullif({clean('page_url')}, ''), nullif({clean('contact_page')}, ''), '')"
    records = (
        f"{w('contacts', 'leads')}, records AS (SELECT seq, {company} AS company_name, CASE WHEN {D.domain_of('company_domain')} = '' THEN {D.domain_of(source)} ELSE {D.domain_of('company_domain')} END AS company_domain,"
        f" {cells(email_list)} AS email, {cells(phone_list)} AS phone, {cells(D.values('contact_url'))} AS link, {source} AS contact_source_url FROM contacts)"
    )

    def merged(source: str, target: str) -> str:
        kinds = {"email": "company_email", "phone": "company_phone", "link": "contact_page_url"}
        flat = ", ".join(f"{target}_{k} AS (SELECT company_key, domain_key, string_agg(value, ' | ' ORDER BY seq, place) AS value FROM (SELECT * FROM (SELECT company_key, domain_key, seq, unnest({k}) AS value, generate_subscripts({k}, 1) AS place FROM {source}) QUALIFY row_number() OVER (PARTITION BY company_key, domain_key, lower(value) ORDER BY seq, place) = 1) GROUP BY ALL)" for k in kinds)
        first = lambda c: f"coalesce(arg_min({c}, seq) FILTER (WHERE {c} <> ''), '') AS {c}"
        joins = " ".join(f"LEFT JOIN {target}_{k} USING (company_key, domain_key)" for k in kinds)
        values = ", ".join(f"coalesce({target}_{k}.value, '') AS {c}" for k, c in kinds.items())
        return f"{flat}, {target} AS (SELECT h.*, {values} FROM (SELECT company_key, domain_key, min(seq) AS seq, {first('company_name')}, {first('company_domain')}, {first('contact_source_url')} FROM {source} GROUP BY ALL) h {joins})"

    index = f"{records}, keyed AS (SELECT *, lower(company_name) AS company_key, {D.domain_of('company_domain')} AS domain_key FROM records WHERE lower(company_name) <> '' OR {D.domain_of('company_domain')} <> ''), {merged('keyed', 'idx')}"
    hit = lambda c: f"CASE WHEN x.seq IS NOT NULL THEN x.{c} WHEN a.seq IS NOT NULL THEN a.{c} WHEN d.seq IS NOT NULL THEN d.{c} ELSE '' END AS {c}"
    contact_cells = ["company_email", "company_phone", "contact_source_url", "contact_page_url"]
    with_contacts = (
        f"{index}, probe AS (SELECT *, {D.key('company_name')} AS ck, {D.domain_of('company_domain')} AS dk FROM leads), by_c AS ({once('idx', 'company_key', 'seq').replace(' QUALIFY', ' WHERE company_key <> ' + D.q('') + ' QUALIFY')}), by_d AS ({once('idx', 'domain_key', 'seq').replace(' QUALIFY', ' WHERE domain_key <> ' + D.q('') + ' QUALIFY')}),"
        f" hits AS (SELECT l.seq, l.company_name, l.company_domain, l.leadership_type, coalesce(x.seq, a.seq, d.seq) IS NOT NULL AS found, {', '.join(map(hit, contact_cells))} FROM probe l LEFT JOIN idx x ON l.ck = x.company_key AND l.dk = x.domain_key LEFT JOIN by_c a ON l.ck = a.company_key LEFT JOIN by_d d ON l.dk = d.domain_key),"
        " wc AS (SELECT *, CASE WHEN NOT found THEN 'NOT_FOUND' WHEN company_email <> '' OR company_phone <> '' THEN 'FOUND' ELSE 'SOURCE_FOUND' END AS contact_status, CASE WHEN NOT found THEN 'LOW' WHEN company_email <> '' OR company_phone <> '' THEN 'HIGH' ELSE 'MEDIUM' END AS contact_confidence FROM hits)"
    )
    company_rows = f"{with_contacts}, cc_in AS (SELECT seq, {D.key('company_name')} AS company_key, {D.domain_of('company_domain')} AS domain_key, {company} AS company_name, {D.domain_of('company_domain')} AS company_domain, contact_source_url, {D.values('company_email')} AS email, {D.values('company_phone')} AS phone, {D.values('contact_page_url')} AS link FROM wc), {merged('cc_in', 'cc')}"
    kind = D.page_type("crawl", "anchor", "homepage")
    cands = f"{links_sql()}, typed AS (SELECT seq, page_id, crawl AS url, {kind} AS page_type, {clean('anchor')} AS anchor_text FROM crawled WHERE crawl <> ''), cands AS (SELECT *, {D.case('page_type', R.PAGE_SCORES, '0')} AS score FROM typed)"
    best = "score DESC, length(anchor_text) DESC, seq"
    summary = lambda source, parts: " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST(count(*) AS VARCHAR) AS value, CAST({e} AS VARCHAR) AS detail FROM {source} GROUP BY {e}" for m, e in parts.items())
    scalar = lambda source, parts: " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({e} AS VARCHAR) AS value, '' AS detail FROM {source}" for m, e in parts.items())
    zeros = lambda source, metric, column: f"SELECT '{metric}' AS metric, CAST(count(s.{column}) AS VARCHAR) AS value, d.detail FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) d(detail) LEFT JOIN {source} s ON s.{column} = d.detail GROUP BY d.detail"
    site = D.input_url("website")
    profile = lambda fragment: (
        f"{links_sql()}, anchors AS (SELECT seq, page_id AS lead, homepage, {D.strict_url('abs_url')} AS url, anchor, concat_ws(' ', anchor, person_name) AS context, person_name, designation FROM crawled), firsts AS ({once('anchors', 'lead, url', 'seq').replace(' QUALIFY', ' WHERE url <> ' + D.q('') + ' QUALIFY')}),"
        f" scored AS (SELECT lead, seq, url, least({D.name_match('person_name', 'anchor')} + ({D.name_match('person_name', 'context')}) // 2 + {D.path_score('url')} + {D.role_match('designation', 'context')}, 100) AS score FROM firsts WHERE {_same('url', 'homepage')}"
        f" AND {D.any_of('lower(' + D.path('url') + ')', R.PROFILE_TERMS)} AND len(list_filter({D.tokens('person_name')}, lambda t: contains(regexp_replace(lower({D.path('url')}), '[^a-z0-9]+', '-', 'g'), t))) > 0 {fragment}),"
        " ranked AS (SELECT *, row_number() OVER (PARTITION BY lead ORDER BY score DESC, seq) AS place FROM scored WHERE score > 0)"
    )
    page = f"(repeat('x ', CAST(seq % 90 AS INT)) || {_BIO} || repeat(' tail', CAST(seq % 200 AS INT)))"
    at = f"(strpos({D.key(page)}, {D.key('person_name')}) - 1)"
    cut = f"trim(substring({clean(page)}, greatest({at} - 120, 0) + 1, least({at} + 700, length({clean(page)})) - greatest({at} - 120, 0)))"
    out = {
        "input_scan_dedupe": f"{w('companies_input')}, c AS (SELECT seq, {company} AS company_name, {site} AS website FROM companies_input), k AS (SELECT *, {D.host('website')} AS company_domain FROM c WHERE company_name <> '' OR website <> '') {once('k', 'lower(company_name), company_domain', 'seq')}",
        "merge_candidates": f"{cands} {once('cands', 'page_id, url', best)}",
        "pages_top30": f"{cands}, c AS (SELECT *, {D.host('url')} AS company FROM cands WHERE score >= 55), m AS ({once('c', 'company, url', best)}) SELECT company, url, score, row_number() OVER (PARTITION BY company ORDER BY score DESC, url) AS place FROM m QUALIFY place <= 30",
        "page_dedupe": f"{cands}, c AS (SELECT *, {D.host('url')} AS company_name FROM cands), m AS ({once('c', 'lower(company_name), lower(url)', 'score DESC, seq')}) SELECT company_name, url AS page_url, score, seq FROM m",
        "candidate_dedupe": f"{w('leads')}, r AS (SELECT *, CASE confidence WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS rank, coalesce(extraction_method = 'json_ld', false) AS js FROM leads), b AS ({once('r', 'lower(company_domain), lower(person_name), lower(designation)', 'rank DESC, js DESC, CASE WHEN js THEN -seq ELSE seq END')}) SELECT seq, person_name, designation, confidence, extraction_method FROM b",
        "validation_status": f"{validated} SELECT {', '.join(LEAD)} FROM v",
        "quality_dedupe": f"{final} SELECT {', '.join(LEAD)}, 'READY' AS final_status FROM final",
        "valid_rejected_split": f"{validated} SELECT seq, CASE validation_status WHEN 'VALID' THEN 'validated' ELSE 'rejected' END AS part FROM v",
        "other_person_semi_join": f"{w('leads')}, {names} SELECT seq, {another} AS names_another FROM leads",
        "name_set": f"{w('leads')} SELECT DISTINCT {name} AS person FROM leads WHERE {name} <> ''",
        "enrichment_join": f"{w('leads')}, enriched AS ({_ENRICHED.replace('{leads}', 'leads')}), src AS (SELECT *, CASE WHEN seq % 6 = 0 THEN 'VALID' ELSE 'REJECTED' END AS validation_status FROM leads), {last}, {join('src')} SELECT seq, company_domain, lead_priority, verification_status, verification_source, enrichment_status, professional_profile_url, public_bio_excerpt FROM joined",
        "master_dedupe": f"{master} SELECT seq, company_name, person_name, designation, lead_priority, enrichment_status FROM master",
        "leads_sorted": f"{master} SELECT seq, lead_priority, company_name, person_name FROM master ORDER BY CASE lead_priority WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, lower(company_name), lower(person_name), seq",
        "company_sources": f"{w('leads')}, c AS (SELECT seq, {company} AS company_name, {domain} AS company_domain, {clean('source_url')} AS source_url FROM leads) {once('c', 'lower(company_name), lower(company_domain), lower(source_url)', 'seq')}",
        "typed_export": f"{master} SELECT seq, leadership_type AS file FROM master WHERE leadership_type IN {D.listed(R.PRIORITIES)}",
        "run_summary": f"{master} {scalar('final', {'phase5_input_records': 'count(*)'})} UNION ALL {scalar('enriched', {'phase51_input_records': 'count(*)'})} UNION ALL {scalar('master', {'final_records': 'count(*)'})} UNION ALL SELECT 'duplicates_removed', CAST((SELECT count(*) FROM joined) - (SELECT count(*) FROM master) AS VARCHAR), '' UNION ALL "
        + summary("master", {"company": "company_name", "leadership_type": "leadership_type", "lead_priority": "lead_priority", "verification_status": "verification_status", "enrichment_status": "CASE WHEN enrichment_status = '' THEN 'NOT_PROCESSED' ELSE enrichment_status END"}),
        "contact_record": f"{records} SELECT seq, company_name, company_domain, contact_source_url, {', '.join(f'{D.joined(c)} AS {c}' for c in ('email', 'phone', 'link'))} FROM records",
        "contact_index": f"{index} SELECT seq, company_key, domain_key, company_name, company_domain, company_email, company_phone, contact_page_url, contact_source_url FROM idx",
        "contact_fallback_join": f"{with_contacts} SELECT seq, {', '.join(contact_cells)}, contact_status, contact_confidence FROM wc",
        "output_dedupe": f"{w('leads')}, o AS ({once('leads', ', '.join(D.key(c) for c in ('company_name', 'person_name', 'designation')), 'seq')}) SELECT seq, company_name, person_name, designation FROM o",
        "company_contacts": f"{company_rows} SELECT company_name, company_domain, company_email, company_phone, contact_page_url, contact_source_url, CASE WHEN company_email <> '' OR company_phone <> '' THEN 'FOUND' ELSE 'NOT_FOUND' END AS contact_status, CASE WHEN company_email <> '' OR company_phone <> '' THEN 'HIGH' ELSE 'LOW' END AS contact_confidence FROM cc",
        "merge_summary": f"{company_rows} {scalar('wc', {'final_lead_records': 'count(*)', 'leads_with_email': 'count_if(company_email <> ' + D.q('') + ')', 'leads_with_phone': 'count_if(company_phone <> ' + D.q('') + ')', 'leads_with_any_contact': 'count_if(contact_status = ' + D.q('FOUND') + ')', **{m: f'count_if(leadership_type = {D.q(k)})' for m, k in (('cxo_records', 'CXO'), ('board_records', 'Board'), ('executive_leadership_records', 'Executive Leadership'))}})} UNION ALL {scalar('cc', {'company_contact_groups': 'count(*)'})}",
        "first_value": f"{w('contacts')} SELECT seq, {clean('contact_page')} AS source, coalesce(nullif({clean('emails')}, ''), nullif({clean('contact_email')}, ''), '') AS email FROM contacts",
        "collect_values": f"{w('contacts')} SELECT seq, {D.joined('list_concat(' + D.values('emails') + ', ' + D.values('contact_email') + ')', '~')} AS emails, {D.joined(D.values('phone_numbers'), '~')} AS phones FROM contacts",
        "row_clean": f"{w('leads')} SELECT seq, {domain} AS company_domain, {D.case(D.key('leadership_type'), R.EXPORT_TYPES, clean('leadership_type'))} AS leadership_type, {', '.join(f'{clean(c)} AS {c}' for c in ('company_name', 'person_name', 'designation', 'confidence', 'extraction_method', 'source_url'))} FROM leads",
        "page_type_counts": f"{cands} {summary('cands', {'page_type': 'page_type'})}",
        "candidate_summary": f"{w('leads')} {summary('leads', {'company': 'company_name', 'extraction_method': 'coalesce(extraction_method, ' + D.q('') + ')'})} UNION ALL {zeros('leads', 'confidence', 'confidence')}",
        "type_counts": f"{validated} {summary('v', {'company': 'company_name', 'leadership_type': 'leadership_type'})}",
        "enrichment_summary": f"{w('leads')}, enriched AS ({_ENRICHED.replace('{leads}', 'leads')}) {summary('enriched', {'enrichment_status': 'enrichment_status'})} UNION ALL {zeros('enriched', 'enrichment_confidence', 'enrichment_confidence')} UNION ALL {scalar('enriched', {'verified': 'count_if(verification_status = ' + D.q('VERIFIED') + ')', 'profile_links': 'count_if(professional_profile_url <> ' + D.q('') + ')', 'bio_records': 'count_if(public_bio_excerpt <> ' + D.q('') + ')'})}",
        "contact_summary": f"{w('contacts')} {scalar('contacts', {'pages': 'count(*)', 'successful': 'count_if(seq % 5 + 1 IN (2, 3))', 'with_email': 'count_if(coalesce(emails, ' + D.q('') + ') <> ' + D.q('') + ')', 'with_phone': 'count_if(coalesce(phone_numbers, ' + D.q('') + ') || coalesce(contact_url, ' + D.q('') + ') <> ' + D.q('') + ')', 'contact_pages': 'count_if(contact_page = ' + D.q('YES') + ')', 'with_links': 'count_if(coalesce(contact_url, ' + D.q('') + ') <> ' + D.q('') + ')'})}",
        "reachability": f"{w('crawl')} {scalar('crawl', {'reachable': 'count_if(error IS NULL AND status < 400)', 'not_reachable': 'count_if(NOT (error IS NULL AND status < 400))'})}",
        "candidate_union": f"{w('leads')} SELECT seq, person_name, extraction_method AS method FROM leads WHERE extraction_method IN ('json_ld', 'semantic_card', 'sibling_pair', 'local_parent')",
        "sitemap_distinct": f"{links_sql()} SELECT seq, page_id, abs_url AS url FROM crawled QUALIFY row_number() OVER (PARTITION BY page_id, abs_url ORDER BY seq) = 1",
        "crawl_lookup_join": f"{links_sql()}, {w('crawl').removeprefix('WITH ')}, pg AS (SELECT 'https://host' || seq % 7 || '.example/leadership' || CASE WHEN seq < 7 THEN '/' ELSE '' END AS page, arg_min(status, seq) AS status FROM crawl GROUP BY 1) SELECT l.seq, p.status FROM crawled l LEFT JOIN pg p ON l.crawl = p.page",
        "email_domain_anti_join": f"{w('phrases')}, found AS (SELECT seq, unnest({found_emails('text')}) AS email FROM phrases) SELECT seq, email FROM found WHERE split_part(email, '@', 2) NOT IN {D.listed(R.PLACEHOLDER_DOMAINS)}",
        "common_paths": f"{w('crawl')}, paths(path, expected_type) AS (VALUES {', '.join(f'({D.q(a)}, {D.q(b)})' for a, b in R.COMMON_PATHS)}) SELECT seq, path, expected_type, 'https://host' || seq || '.example/' || path AS candidate FROM crawl, paths",
        "profile_links": f"{profile('')} SELECT lead, seq, url, score, place FROM ranked WHERE place <= 8",
        "best_profile": f"{profile('AND ' + D.part('url', 6) + ' <> ' + D.q(''))} SELECT lead, url, score FROM ranked WHERE place = 1 AND score >= 55",
        "bio_excerpt": f"{w('leads')} SELECT seq, CASE WHEN len({D.tokens('person_name')}) > 0 AND len(list_filter({D.tokens('person_name')}, lambda t: NOT contains({D.key(page)}, t))) = 0 AND ({D.role_match('designation', page)}) > 0 AND {at} >= 0 AND length({cut}) >= 40 THEN substring({cut}, 1, 700) ELSE '' END AS excerpt FROM leads",
    }
    return {n: out[n] for n in NAMES if n in out}


def _same(a: str, b: str) -> str:
    x, y = D.host(a), D.host(b)
    return f"{x} <> '' AND {y} <> '' AND ({x} = {y} OR ends_with({x}, '.' || {y}) OR ends_with({y}, '.' || {x}))"
