"""Fetching as a join: a snapshot table of what was fetched, keyed by comparable URL. No operator opens a connection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import classify as C
from ..functions import extract as X
from ..functions import predicates as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from ..operators.keyed import first_of

COLUMNS = ["url_key", "requested_url", "final_url", "status", "content_type", "body", "error"]


def from_pages(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) as a snapshot in which everything answered."""
    return pages.select("page_id", U.crawl_url("url").alias("url_key"), F.col("url").alias("requested_url"), F.col("url").alias("final_url"), F.lit(200).alias("status"), F.lit("text/html").alias("content_type"), F.col("html").alias("body"), F.lit(None).cast("string").alias("error"))


def distinct_snapshot(crawl: DataFrame) -> DataFrame:
    """One answer for each URL: the least status, then the first by addresses and content."""
    order = F.struct(F.coalesce("status", F.lit(1000)).alias("status"), "requested_url", "final_url", F.xxhash64("body", "content_type", "error").alias("content"))
    return first_of(crawl.withColumn("_order", order), order="_order", url=F.col("url_key")).drop("_order")


def fetch(rows: DataFrame, url: str, crawl: DataFrame, distinct: bool = False) -> DataFrame:
    """rows with what the snapshot holds for their URL (and its page_id, where it has one); a miss has no status.

    distinct: the snapshot is known to hold each URL once.
    """
    told = [*COLUMNS, *(c for c in ("page_id",) if c in crawl.columns and c not in rows.columns)]
    snapshot = (crawl if distinct else distinct_snapshot(crawl)).select(*told)
    return rows.withColumn("_url", U.crawl_url(url)).join(snapshot.withColumnRenamed("url_key", "_url"), "_url", "left").drop("_url")


def check_companies(companies: DataFrame, crawl: DataFrame, distinct: bool = False) -> DataFrame:
    """Companies (company_name, website) with reachability, title and status of their first request."""
    x = fetch(companies.withColumnRenamed("website", "input_website"), "input_website", crawl, distinct)
    x = x.withColumn("_valid", T.company_name_valid("company_name")).withColumn("_error", F.when(F.col("status").isNull() & F.col("error").isNull(), "NotInSnapshot").otherwise(F.col("error")))
    asked = F.col("_valid") & (F.col("input_website") != "")
    answered = asked & F.col("_error").isNull()
    status = F.when(~F.col("_valid"), "INVALID_COMPANY_NAME").when(F.col("input_website") == "", "INVALID_WEBSITE").otherwise(C.input_status("status", "_error"))
    good = answered & (F.col("status") < 400)
    html = F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("html"))
    final = F.when(answered, U.input_url("final_url")).otherwise("")
    return x.withColumn("_final", final).select(
        "seq", "company_name", "input_website", F.col("input_website").alias("website"), U.host(F.when(F.col("_final") == "", F.col("input_website")).otherwise(F.col("_final"))).alias("company_domain"),
        F.col("_final").alias("final_url"), F.when(answered, F.col("status").cast("string")).otherwise("").alias("status_code"), F.when(good, "YES").otherwise("NO").alias("reachable"),
        F.when(good & html, X.regex_title("body")).otherwise("").alias("page_title"), status.alias("validation_status"),
    )


#: Text in which every & begins an entity of XML: a named one, or the number of a character that XML allows.
_ENTITIES = r"^(?:[^<&]|&(?:amp|lt|gt|quot|apos|#(?:3[2-9]|[4-9][0-9]|[1-9][0-9]{2,3}|[1-4][0-9]{4})|#x0{0,4}(?:[2-9A-Fa-f][0-9A-Fa-f]|[1-9A-Fa-f][0-9A-Fa-f]{2}|[1-9A-Ca-c][0-9A-Fa-f]{3}));)*$"


def _decoded(x: Column) -> Column:
    """XML's entities as the characters they stand for; text that isn't well-formed keeps what isn't &amp;."""
    well = x.contains("&") & x.rlike(_ENTITIES)
    return F.when(well, F.xpath_string(F.concat(F.lit("<a>"), x, F.lit("</a>")), F.lit("/a"))).otherwise(F.replace(x, F.lit("&amp;"), F.lit("&")))


def sitemap_locations(xml) -> Column:
    """Clean <loc> texts of a sitemap in their order."""
    found = F.regexp_extract_all(F.coalesce(T.column(xml), F.lit("")), F.lit(r"(?is)<loc\b[^>]*>(.*?)</loc>"), F.lit(1))
    plain = F.transform(found, lambda x: T.clean_text(_decoded(F.regexp_replace(x, r"^\s*<!\[CDATA\[|\]\]>\s*$", ""))))
    return F.filter(plain, lambda x: x != "")


def is_sitemap(content_type, body) -> Column:
    start = F.lower(F.substring(T.column(body), 1, 1000))
    return F.contains(F.lower(F.coalesce(T.column(content_type), F.lit(""))), F.lit("xml")) | F.ltrim(T.column(body)).startswith("<?xml") | start.rlike("<urlset|<sitemapindex")


def sitemap_urls(homes: DataFrame, crawl: DataFrame, distinct: bool = False) -> DataFrame:
    """(company, homepage, seq, url): what homes' sitemaps list, each once in order; indexes are followed one level, ten children each.

    homes: company, homepage. Sitemaps stand at three fixed places or are named by robots.txt.
    """
    good = (crawl if distinct else distinct_snapshot(crawl)).filter("error IS NULL AND status < 400")
    fixed = F.array(*(F.lit(p) for p in R.SITEMAP_PATHS))
    places = homes.select("company", "homepage", F.posexplode(fixed).alias("rank", "path")).withColumn("sitemap", U.resolve("homepage", "path")).drop("path")
    robots = fetch(homes.withColumn("robots", U.resolve("homepage", F.lit("/robots.txt"))), "robots", good, distinct=True).filter("body IS NOT NULL")
    named = robots.select("company", "homepage", F.posexplode(F.regexp_extract_all("body", F.lit(r"(?im)^sitemap:(.*)$"), F.lit(1))).alias("rank", "value"))
    named = named.select("company", "homepage", (F.col("rank") + len(R.SITEMAP_PATHS)).alias("rank"), T.clean_text("value").alias("sitemap")).filter("sitemap <> ''")
    maps = first_of(places.unionByName(named), order="rank", company=F.col("company"), sitemap=F.col("sitemap"))
    read = fetch(maps, "sitemap", good, distinct=True).filter(is_sitemap("content_type", "body"))
    listed = read.select("company", "homepage", "rank", F.lower(F.substring("body", 1, 5000)).contains("<sitemapindex").alias("is_index"), F.posexplode(sitemap_locations("body")).alias("place", "url"))
    direct = listed.filter("NOT is_index").select("company", "homepage", F.col("rank").alias("a"), F.col("place").alias("b"), F.lit(0).alias("c"), "url")
    children = T.computed(listed.filter(F.col("is_index") & (F.col("place") < R.MAX_CHILD_SITEMAPS)), child=U.crawl_url("url")).filter((F.col("child") != "") & P.same_domain("child", "homepage"))
    deeper = fetch(children, "child", good, distinct=True).filter("body IS NOT NULL").select("company", "homepage", F.col("rank").alias("a"), F.col("place").alias("b"), F.posexplode(sitemap_locations("body")).alias("c", "url"))
    everything = direct.unionByName(deeper).withColumn("order", F.struct("a", "b", "c"))
    once = first_of(everything, order="order", company=F.col("company"), url=F.col("url"))
    return once.select("company", "homepage", (F.col("a") * (1 << 40) + F.col("b").cast("long") * (1 << 20) + F.col("c")).alias("seq"), "url")
