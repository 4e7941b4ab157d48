"""Invented companies, leads, contacts and links, derived row by row from the driver's tables, in both engines' SQL.

Every value is picked from a short list by arithmetic on the row's key, so both engines see the same rows at any scale and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COMPANIES = ["Aldora Works", "  Brellin  Group ", "Corvane Ltd", "Dunmere Öl AG", "Estrel  Partners", "", "Fallow & Finch", "G", "Harrow\tTextiles", "Ilvane"]
SITES = [
    "https://www.Aldora.example/", "http://brellin.example:8080/en/", "corvane.example", "HTTPS://user@Dunmere.example/home;v=1?x=1#top", "https://estrel.example", "",
    "ftp://fallow.example/a", "https://", "www.harrow.example/about", " https://ilvane.example/a b ",
]
NAMES = [
    "Dr. Mira Tolvane", "Jonas  Perrin", "Élise Marchand-Roy", "Anton Vale , Jr.", "Read More", "Leadership Team", "Priya Kesh", "O’Dell , Sam", "Ove",
    "The Board", "Mr Tomas Lindqvist", "Contact Us", "Karim Bel Hadj Ould Amar Ben Sidi Ali", "http://x.y", "- Lena Ford -", "Nils <b>", "about the leadership", "Ana María Sol",
]
TITLES = [
    "Chief Executive Officer", "CEO, Aldora Works", "Non-Executive Director", "Vice Chairman and Managing Director", "Founder", "Chairman Read more", "Jonas Perrin Chairman",
    "Chief Strategy and Risk Officer View profile", "Director", "lead director", "Company Secretary", "Senior Vice President", "Head of things", "", "Co-Founder & President",
    "Chief  Financial Officer |", "Chief Executive Officer Designate", "click here Chief Officer", "Executive Director", "Independent Director, see https://x.y", "General Counsel",
    "Chief of many long things " * 9 + "director",
]
TYPES = ["CXO", "board", "Executive Leadership", "Founder", "", " executive ", "Unknown", None]
METHODS = ["sibling_pair", "local_parent", "json_ld", "Semantic_Card", "structural_pair", "", None]
CONFIDENCES = ["HIGH", "MEDIUM", "LOW", ""]
SOURCES = ["https://www.aldora.example/leadership/", "http://brellin.example/team//", "https://corvane.example/about#people", "", "not a url", "https://sub.dunmere.example/x?y=1/", "//host.example/a"]
DOMAINS = ["www.aldora.example", "brellin.example", "Corvane.example", "", "https://estrel.example/x", "dunmere.example:81/a", "sub.aldora.example"]
EMAIL_CELLS = ["Info@Aldora.example; sales@aldora.example", "info@aldora.example, bad@x", "", "a@b.test|A@B.test | c@d.test", "no mail", None, "press@ilvane.example;;"]
PHONE_CELLS = ["+1 (555) 010-0199 ext. 5", "555 0100", "12345", "", "+49 30 1234567, +49 30 1234567", "tel 020 7946 0958 extension 12", None]
LINK_CELLS = ["https://aldora.example/contact | /reach-us", "", None, "/contact;/contact"]
HREFS = [
    "/leadership/", "about_us", "../team/index.html", "https://www.host3.example/management-team", "//other.example/board", "?page=2", "#top", "/services/contact/", "/project-management/",
    "/people-profiles.php", "mailto:a@b.test", "contact-us?x=1#form", "./a/../founders.aspx", "/our_people", "http://host5.example:8080/executive", "/x/y/who-we-are", "/news/leadership", "",
    "/a-very-long-slug/", "tel:+15550100", "/board-of-directors;v=2", "JavaScript:void(0)", "/en/team/jonas-perrin#bio", "/leadership/mira-tolvane/profile#Career", "/Contact", "https://sub.host1.example/about",
]
ANCHORS = ["Our  Team", "Contact Us", "", "Board of Directors", "More", "Mira Tolvane", "Jonas Perrin, Chief Financial Officer", "Who we are", "LEADERSHIP"]
ERRORS = [None, None, None, None, "ConnectionError"]
STATUSES = ["200", "301", "401", "403", "404", "429", "500"]
CONTENT = ["text/html; charset=utf-8", "TEXT/HTML", "application/pdf", None]
PHRASES = [
    "call +1 (555) 010-0199 now", "ref 1234 5678 9012 3456", "tel 020 7946 0958, 020-7946-0958", "mail a@b.test.", "write Info@Aldora.example or x@example.com; info@aldora.example",
    "10.20.30.40 and 555 0100", "no contact here", "é12345678", "_4930123456 +49.30.1234.567", "first.last+tag@sub.mail-host.test, next",
]


class Spark:
    @staticmethod
    def text(value: str | None) -> str:
        return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    @classmethod
    def pick(cls, values: list, index: str) -> str:
        return f"element_at(array({', '.join(map(cls.text, values))}), CAST(({index}) % {len(values)} AS INT) + 1)"

    pages = "(SELECT page_id, url, html, k FROM {pages} LATERAL VIEW explode(sequence(0, 7)) t AS k)"


class Duck:
    @staticmethod
    def text(value: str | None) -> str:
        return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"

    @classmethod
    def pick(cls, values: list, index: str) -> str:
        return f"list_extract([{', '.join(map(cls.text, values))}], CAST(({index}) % {len(values)} AS INT) + 1)"

    pages = "(SELECT page_id, url, html, k FROM pages, range(8) t(k))"


def _sql(d) -> dict[str, str]:
    t = (lambda name: "{" + name + "}") if d is Spark else (lambda name: name)
    key = "c_custkey"
    return {
        "companies_input": f"SELECT CAST(c_custkey AS BIGINT) AS seq, {d.pick(COMPANIES, 'c_custkey * 3')} || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE ' ' || CAST(c_custkey % 50 AS STRING) END AS company_name, {d.pick(SITES, 'c_custkey')} AS website FROM {t('customer')}",
        "leads": f"SELECT CAST(c_custkey AS BIGINT) AS seq, {d.pick(COMPANIES, key)} AS company_name, {d.pick(DOMAINS, 'c_custkey * 3')} AS company_domain, {d.pick(NAMES, 'c_custkey * 5 + c_custkey // 7' if d is Duck else 'c_custkey * 5 + c_custkey div 7')} AS person_name, {d.pick(TITLES, 'c_custkey * 7 + c_custkey // 3' if d is Duck else 'c_custkey * 7 + c_custkey div 3')} AS designation, {d.pick(TYPES, key)} AS leadership_type, {d.pick(CONFIDENCES, key)} AS confidence, {d.pick(METHODS, 'c_custkey * 2')} AS extraction_method, {d.pick(SOURCES, 'c_custkey * 4')} AS source_url FROM {t('customer')}",
        "contacts": f"SELECT CAST(s_suppkey AS BIGINT) AS seq, {d.pick(COMPANIES, 's_suppkey')} AS company_name, {d.pick(DOMAINS, 's_suppkey * 2')} AS company_domain, {d.pick(SOURCES, 's_suppkey * 3')} AS page_url, {d.pick(EMAIL_CELLS, 's_suppkey')} AS emails, {d.pick(EMAIL_CELLS, 's_suppkey * 3 + 1')} AS contact_email, {d.pick(PHONE_CELLS, 's_suppkey * 5')} AS phone_numbers, {d.pick(LINK_CELLS, 's_suppkey')} AS contact_url, CASE WHEN s_suppkey % 3 = 0 THEN 'YES' ELSE 'NO' END AS contact_page FROM {t('supplier')}",
        "links": f"SELECT CAST(page_id * 8 + k AS BIGINT) AS seq, CAST(page_id AS BIGINT) AS page_id, CAST(k AS BIGINT) AS k, 'https://www.Host' || CAST(page_id % 7 AS STRING) || '.example/' || CASE WHEN page_id % 3 = 0 THEN '' WHEN page_id % 3 = 1 THEN 'en/' ELSE 'en/start' END AS homepage, {d.pick(HREFS, 'page_id * 7 + k')} AS href, {d.pick(ANCHORS, 'page_id * 3 + k')} AS anchor, {d.pick(NAMES, 'page_id')} AS person_name, {d.pick(TITLES, 'page_id + k')} AS designation FROM {d.pages}",
        "crawl": f"SELECT CAST(page_id AS BIGINT) AS seq, url AS requested_url, CAST({d.pick(STATUSES, 'page_id')} AS INT) AS status, {d.pick(CONTENT, 'page_id')} AS content_type, {d.pick(ERRORS, 'page_id')} AS error, html AS body FROM {t('pages')}",
        "phrases": f"SELECT CAST(doc_id AS BIGINT) AS seq, text || ' ' || {d.pick(PHRASES, 'doc_id')} AS text FROM {t('documents')}",
    }


TABLES = {"companies_input": "customer", "leads": "customer", "contacts": "supplier", "links": "pages", "crawl": "pages", "phrases": "documents"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = TABLES[name]
    return spark.sql(_sql(Spark)[name], **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def with_duck(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({_sql(Duck)[n]})" for n in names)
