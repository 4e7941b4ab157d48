"""Queries over column functions: a fixture, and each result as a Spark column beside DuckDB's expression for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import arrays as A
from ..functions import classify as C
from ..functions import extract as X
from ..functions import predicates as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from . import duck as D
from . import fixtures

#: name -> (fixture, {result: (what makes the Spark column, DuckDB expression)}); columns need a session, SQL text doesn't.
Specs = dict[str, tuple[str, dict[str, tuple[Callable[[], Column], str]]]]


def resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = fixtures.load(spark, sf_dir, "links")
    return links.withColumn("abs_url", U.resolve("homepage", T.clean_text("href"))).withColumn("crawl", U.crawl_url("href", "homepage"))


def links_sql() -> str:
    r = D.resolve("homepage", D.clean("href"))
    return f"{fixtures.with_duck('links')}, abs_links AS (SELECT *, CASE WHEN href = '' THEN homepage ELSE {r} END AS abs_url, CASE WHEN {D.clean('href')} = '' THEN '' ELSE {r} END AS joined FROM links), crawled AS (SELECT *, {D.crawl_url('joined')} AS crawl FROM abs_links)"


def specs() -> Specs:
    c = F.col
    role, got = lambda: C.role("designation"), lambda: C.extracted_designation("designation")
    return {
        "text_clean": ("leads", {"company": (lambda: T.clean_text("company_name"), D.clean("company_name")), "title": (lambda: T.clean_text("designation"), D.clean("designation"))}),
        "match_key": ("leads", {"company_key": (lambda: T.match_key("company_name"), D.key("company_name")), "name_key": (lambda: T.match_key("person_name"), D.key("person_name"))}),
        "type_normalize": ("leads", {"export_type": (lambda: T.export_type("leadership_type"), D.case(D.key("leadership_type"), R.EXPORT_TYPES, D.clean("leadership_type")))}),
        "company_name_valid": ("companies_input", {"valid": (lambda: T.company_name_valid("company_name"), f"length({D.clean('company_name')}) BETWEEN 2 AND 200 AND regexp_matches({D.clean('company_name')}, '[{R.LATIN}0-9]')")}),
        "person_name_norm_extract": ("leads", {"person": (lambda: T.person_name("person_name"), D.person("person_name"))}),
        "person_name_norm_validate": ("leads", {"person": (lambda: T.person_name_strict("person_name"), D.person_strict("person_name"))}),
        "designation_clean": ("leads", {"title": (lambda: T.designation("designation"), D.title("designation"))}),
        "url_normalize_input": ("companies_input", {"url": (lambda: U.input_url("website"), D.input_url("website"))}),
        "url_normalize_strict": ("leads", {"url": (lambda: U.strict_url("source_url"), D.strict_url("source_url"))}),
        "url_host": ("leads", {"url_host": (lambda: U.host("source_url"), D.host("source_url")), "domain": (lambda: U.domain_of("company_domain"), D.domain_of("company_domain"))}),
        "url_valid": ("leads", {"valid": (lambda: U.is_web_url("source_url"), D.web("source_url"))}),
        "contact_split": ("contacts", {"emails": (lambda: F.array_join(A.split_values("emails"), "~"), D.joined(D.values("emails"), "~")), "phones": (lambda: F.array_join(A.split_values("phone_numbers"), "~"), D.joined(D.values("phone_numbers"), "~"))}),
        "unique_join": ("contacts", {"emails": (lambda: A.unique_join(F.concat(A.split_values("emails"), A.split_values("contact_email"))), D.joined(D.unique(f"list_concat({D.values('emails')}, {D.values('contact_email')})")))}),
        "name_tokens": ("leads", {"tokens": (lambda: F.array_join(A.name_tokens("person_name"), " "), D.joined(D.tokens("person_name"), " "))}),
        "likely_person_name": ("leads", {"likely": (lambda: P.likely_person_name("person_name"), D.likely_person("person_name"))}),
        "looks_like_person_name": ("leads", {"likely": (lambda: P.person_like("person_name"), D.person_like("person_name"))}),
        "clean_designation": ("leads", {"clean": (lambda: P.clean_designation("designation"), D.clean_title("designation"))}),
        "valid_email": ("contacts", {"valid": (lambda: F.coalesce(P.valid_email("emails"), F.lit(False)), f"coalesce({D.email('emails')}, false)")}),
        "probable_phone": ("contacts", {"probable": (lambda: F.coalesce(P.probable_phone("phone_numbers"), F.lit(False)), f"coalesce(length({D.digits('phone_numbers')}) BETWEEN 7 AND 15, false)")}),
        "role_classify": ("leads", {"title": (lambda: role()["title"], D.role("designation", 1)), "kind": (lambda: role()["kind"], D.role("designation", 2))}),
        "designation_extract": ("leads", {"title": (lambda: got()["designation"], f"CASE WHEN {D.role('designation', 1)} = '' THEN '' WHEN length({D.clean('designation')}) <= 180 THEN {D.clean('designation')} ELSE {D.role('designation', 1)} END"), "kind": (lambda: got()["leadership_type"], D.role("designation", 2))}),
        "leadership_type": ("leads", {"kind": (lambda: C.leadership_type("leadership_type", "designation"), D.leadership("leadership_type", "designation"))}),
        "lead_priority": ("leads", {"priority": (lambda: C.priority("leadership_type"), D.case("leadership_type", R.PRIORITIES, "'LOW'"))}),
        "http_status_enum": ("crawl", {
            "input_status": (lambda: C.input_status("status", "error"), "CASE WHEN error IS NOT NULL THEN 'REQUEST_ERROR:' || error WHEN status < 400 THEN 'VALIDATED' WHEN status IN (401, 403) THEN 'BLOCKED_' || status WHEN status = 429 THEN 'RATE_LIMITED_429' ELSE 'HTTP_' || status END"),
            "source_status": (lambda: C.source_status("status", "content_type", "error"), "CASE WHEN error IS NOT NULL THEN 'request_error:' || error WHEN status IN (401, 403) THEN 'blocked_' || status WHEN status = 429 THEN 'rate_limited_429' WHEN status >= 400 THEN 'http_error_' || status WHEN NOT contains(lower(coalesce(content_type, '')), 'html') THEN 'non_html' ELSE 'ok' END"),
        }),
        "source_quality": ("leads", {"points": (lambda: C.source_quality("extraction_method", "source_url"), D.source_quality("extraction_method", "source_url"))}),
        "role_quality": ("leads", {"points": (lambda: C.role_quality(T.designation("designation"), C.leadership_type("leadership_type", "designation")), D.role_quality(D.title("designation"), f"({D.leadership('leadership_type', 'designation')})"))}),
        "quality_score": ("leads", {"points": (lambda: C.quality_score("person_name", "designation", "leadership_type", "extraction_method", "source_url", "company_name"), D.quality("person_name", "designation", "leadership_type", "extraction_method", "source_url", "company_name"))}),
        "page_title_regex": ("crawl", {"title": (lambda: X.regex_title("body"), D.clean("regexp_replace(regexp_extract(body, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', ' ', 'g')"))}),
        "phone_normalize": ("contacts", {"phone": (lambda: X.phone_cell("phone_numbers"), D.phone_cell("phone_numbers"))}),
        "extract_emails": ("phrases", {"emails": (lambda: F.array_join(X.emails("text"), "; "), _emails_sql("text"))}),
        "extract_phones": ("phrases", {"phones": (lambda: F.array_join(X.phones("text"), "; "), _phones_sql("text"))}),
        "contact_outcome": ("contacts", {n: (lambda n=n: C.contact_outcome(c("contact_page") == "YES", A.unique_join(A.split_values("emails")), X.phone_cell("phone_numbers"))[f"contact_{n}"], f"CASE WHEN contact_page <> 'YES' THEN '{a}' WHEN {D.joined(D.unique(D.values('emails')))} <> '' OR {D.phone_cell('phone_numbers')} <> '' THEN '{b}' ELSE '{e}' END") for n, a, b, e in (("status", "NOT_FOUND", "FOUND", "SOURCE_FOUND"), ("confidence", "LOW", "HIGH", "MEDIUM"))}),
        "enrichment_outcome": ("crawl", {n: (lambda n=n: _outcome(c)[n], _outcome_sql(n)) for n in ("confidence", "status")}),
        # over links, resolved first
        "url_resolve": ("crawled", {"abs_url": (lambda: c("abs_url"), "abs_url")}),
        "url_normalize_crawl": ("crawled", {"url": (lambda: c("crawl"), "crawl")}),
        "url_segments": ("crawled", {"segments": (lambda: F.array_join(U.segments("crawl"), "~"), D.joined(D.segments("crawl"), "~"))}),
        "url_terminal": ("crawled", {"terminal": (lambda: U.terminal("crawl"), D.terminal("crawl"))}),
        "same_domain": ("crawled", {"same": (lambda: P.same_domain("crawl", "homepage"), f"{D.host('crawl')} = {D.host('homepage')}")}),
        "same_company_domain": ("crawled", {"same": (lambda: P.same_company_domain("crawl", "homepage"), _same_company("crawl", "homepage"))}),
        "excluded_path": ("crawled", {"excluded": (lambda: P.excluded_path("crawl"), D.excluded("crawl"))}),
        "homepage_flag": ("crawled", {"is_home": (lambda: P.is_homepage("crawl", "homepage"), D.homepage("crawl", "homepage"))}),
        "content_slug": ("crawled", {"slug": (lambda: P.content_slug("crawl"), D.slug("crawl"))}),
        "page_classify": ("crawled", {"page_type": (lambda: C.page_type("crawl", "anchor", "homepage"), D.page_type("crawl", "anchor", "homepage")), "score": (lambda: C.page_score(C.page_type("crawl", "anchor", "homepage")), D.case(D.page_type("crawl", "anchor", "homepage"), R.PAGE_SCORES, "0"))}),
        "contact_page_flag": ("crawled", {"contact": (lambda: P.contact_page("crawl", C.page_type("crawl", "anchor", "homepage")), f"({D.page_type('crawl', 'anchor', 'homepage')}) = 'contact' OR len(list_intersect(string_split(lower({D.path('crawl')}), '/'), [{', '.join(map(D.q, R.CONTACT_SEGMENTS))}])) > 0")}),
        "generic_anchor": ("crawled", {"generic": (lambda: P.generic_anchor("abs_url"), f"{D.part('abs_url', 6)} = ''")}),
        "profile_url_flag": ("crawled", {"profile": (lambda: P.profile_url("abs_url", "person_name"), _profile_sql())}),
        "name_match_score": ("crawled", {"points": (lambda: C.name_match_score("person_name", "anchor"), D.name_match("person_name", "anchor"))}),
        "path_score": ("crawled", {"points": (lambda: C.path_score("abs_url"), D.path_score("abs_url"))}),
        "role_match_score": ("crawled", {"points": (lambda: C.role_match_score("designation", "anchor"), D.role_match("designation", "anchor"))}),
        "link_score": ("crawled", {"points": (lambda: C.link_score("person_name", "designation", "abs_url", "anchor", F.concat_ws(" ", "anchor", "person_name")), f"least({D.name_match('person_name', 'anchor')} + ({D.name_match('person_name', _CONTEXT)}) // 2 + {D.path_score('abs_url')} + {D.role_match('designation', _CONTEXT)}, 100)")}),
    }


_CONTEXT = "concat_ws(' ', anchor, person_name)"


def _same_company(a: str, b: str) -> str:
    x, y = D.host(a), D.host(b)
    return f"{x} <> '' AND {y} <> '' AND ({x} = {y} OR ends_with({x}, '.' || {y}) OR ends_with({y}, '.' || {x}))"


def _profile_sql() -> str:
    path = f"lower({D.path('abs_url')})"
    return f"{D.part('abs_url', 6)} <> '' AND {D.any_of(path, R.PROFILE_TERMS)} AND len(list_filter({D.tokens('person_name')}, lambda t: contains(regexp_replace({path}, '[^a-z0-9]+', '-', 'g'), t))) > 0"


def found_emails(x: str) -> str:
    """RE2 has no look-around: boundaries are taken in, white space doubled so that neighbours don't share one."""
    doubled = f"regexp_replace({x}, '(\\s)', '\\1\\1', 'g')"
    pattern = f"(?:^|[^{X._WORD}.+-])([{R.EMAIL_CLASS}]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+)(?:$|[^{X._WORD}.-])"
    return f"list_transform(regexp_extract_all({doubled}, {D.q(pattern)}, 1), lambda e: lower(e))"


def _emails_sql(x: str) -> str:
    real = f"list_filter({found_emails(x)}, lambda e: split_part(e, '@', 2) NOT IN {D.listed(R.PLACEHOLDER_DOMAINS)})"
    return D.joined(f"list_slice({D.unique(real)}, 1, 20)", "; ")


def _phones_sql(x: str) -> str:
    inner = r"(?:\+?\d{1,3}[\s().-]*)?(?:\(?\d{2,5}\)?)[\s.-]*\d{3,5}[\s.-]*\d{3,5}"
    found = f"list_transform(regexp_extract_all(regexp_replace({x}, '([^0-9+()\\s.{X._WORD}-]|\\s)', '\\1\\1', 'g'), {D.q('(?:^|[^' + X._WORD + '])(' + inner + ')(?:$|[^' + X._WORD + '])')}, 1), lambda p: {D.clean('p')})"
    likely = f"list_filter({found}, lambda p: length({D.digits('p')}) BETWEEN 7 AND 15)"
    first = f"list_filter(list_transform({likely}, lambda s, i: {{'s': s, 'i': i}}), lambda p: list_position(list_transform({likely}, lambda s: {D.digits('s')}), {D.digits('p.s')}) = p.i)"
    return D.joined(f"list_slice(list_transform({first}, lambda p: p.s), 1, 20)", "; ")


def _outcome(c) -> Column:
    return C.enrichment_outcome(C.source_status("status", "content_type", "error"), c("seq") % 2 == 0, c("seq") % 3 == 0, c("seq") % 5 == 0, c("seq") % 4 == 0)


def _outcome_sql(field: str) -> str:
    s = "CASE WHEN error IS NOT NULL THEN 'request_error:' || error WHEN status IN (401, 403) THEN 'blocked_' || status WHEN status = 429 THEN 'rate_limited_429' WHEN status >= 400 THEN 'http_error_' || status WHEN NOT contains(lower(coalesce(content_type, '')), 'html') THEN 'non_html' ELSE 'ok' END"
    if field == "status":
        return f"CASE WHEN error IS NOT NULL THEN {s} WHEN ({s}) <> 'ok' THEN 'additional_evidence_unavailable:' || {s} WHEN seq % 15 = 0 THEN 'person_and_designation_found' WHEN seq % 3 = 0 THEN 'person_found_designation_not_confirmed' WHEN seq % 4 = 0 THEN 'profile_link_candidate_found' ELSE 'no_additional_person_evidence_found' END"
    return f"CASE WHEN error IS NOT NULL THEN 'LOW' WHEN ({s}) <> 'ok' THEN CASE WHEN seq % 2 = 0 THEN 'MEDIUM' ELSE 'LOW' END WHEN seq % 15 = 0 THEN 'HIGH' WHEN seq % 3 = 0 OR seq % 4 = 0 THEN 'MEDIUM' ELSE 'LOW' END"


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fixture, results = specs()[name]
        df = resolved_links(spark, sf_dir) if fixture == "crawled" else fixtures.load(spark, sf_dir, fixture)
        return df.select("seq", *(make().alias(alias) for alias, (make, _) in results.items()))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(name) for name in specs()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (fixture, results) in specs().items():
        source = links_sql() if fixture == "crawled" else fixtures.with_duck(fixture)
        out[name] = f"{source} SELECT seq, {', '.join(f'{sql} AS {alias}' for alias, (_, sql) in results.items())} FROM {fixture}"
    return out
