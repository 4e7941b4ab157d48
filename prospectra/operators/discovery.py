"""Page discovery: candidates from links, sitemaps and common paths, merged and ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import classify as C
from ..functions import predicates as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from ..sources.crawl import distinct_snapshot
from .keyed import best_of, first_of


def merge_candidates(candidates: DataFrame, company: str) -> DataFrame:
    """Per company and URL the highest score, then the longest anchor, then the first."""
    return best_of(candidates, F.col("score"), F.length("anchor_text"), company=F.col(company), url=F.col("url"))


def top_pages(candidates: DataFrame, company: str) -> DataFrame:
    """The best thirty of each company; the rank limit is applied before rows are exchanged."""
    place = F.row_number().over(W.partitionBy(company).orderBy(F.desc("score"), "url"))
    return candidates.withColumn("place", place).filter(F.col("place") <= R.MAX_PAGES)


def distinct_pages(pages: DataFrame) -> DataFrame:
    """Over all companies, each company's page once; sorted by company, score, URL."""
    best = best_of(pages, F.col("score"), company=F.lower("company_name"), url=F.lower("page_url"))
    return best.orderBy(F.lower("company_name"), F.desc("score"), "page_url")


def probes(homes: DataFrame) -> DataFrame:
    """(seq, homepage) by the 24 common paths, one row per distinct address."""
    paths = F.array(*(F.struct(F.lit(n).alias("path_no"), F.lit(p).alias("path"), F.lit(t).alias("expected_type")) for n, (p, t) in enumerate(R.COMMON_PATHS)))
    # a path changes nothing of its address but the end and the length, so a homepage is taken apart once for all of them
    x = T.computed(homes, _root=U.crawl_url(F.lit("/"), "homepage"), _room=R.MAX_URL_LENGTH - F.length(U.resolve("homepage", F.lit("/"))))
    x = x.filter("_root <> ''").select("*", F.inline(paths)).filter(F.length("path") <= F.col("_room"))
    return x.withColumn("candidate", F.concat("_root", "path")).drop("_root", "_room")


def _judged(x: DataFrame, url: str, anchor: str | Column, home: str) -> DataFrame:
    kind = C.page_type(url, anchor, home)
    return T.computed(x, page_type=kind).withColumn("score", C.page_score(F.col("page_type")))


def probed_candidates(homes: DataFrame, crawl: DataFrame, distinct: bool = False) -> DataFrame:
    """Common paths that answered on the company's own host; what the address doesn't say, the path's expected type does."""
    answered = (crawl if distinct else distinct_snapshot(crawl)).filter("error IS NULL AND status < 400").select("url_key", "final_url")
    x = probes(homes).join(answered, F.col("candidate") == F.col("url_key")).drop("url_key")
    x = x.withColumn("url", F.coalesce(F.nullif(U.crawl_url("final_url"), F.lit("")), F.col("candidate"))).filter(P.same_domain("url", "homepage") & ~P.excluded_path("url"))
    x = _judged(x.withColumn("_anchor", F.translate("path", "-", " ")), "url", "_anchor", "homepage")
    x = x.withColumn("page_type", F.when(F.col("page_type") == "other", F.col("expected_type")).otherwise(F.col("page_type")))
    x = x.withColumn("score", F.when(F.col("score") < R.MIN_PAGE_SCORE, C.page_score(F.col("page_type"))).otherwise(F.col("score")))
    return x.filter(F.col("score") >= R.MIN_PAGE_SCORE).select("company", "homepage", F.col("path_no").cast("long").alias("seq"), "url", "page_type", "score", F.initcap("_anchor").alias("anchor_text"))


def link_candidates(anchors: DataFrame) -> DataFrame:
    """Anchors (company, homepage, seq, href, anchor_text) that lead to useful pages of the same host, each URL once."""
    low = F.lower(F.trim("href"))
    shunned = F.lit(False)
    for start in R.SKIPPED_LINKS:
        shunned = shunned | low.startswith(start)
    x = T.computed(anchors.filter((low != "") & ~shunned), url=U.crawl_url("href", "homepage")).filter((F.col("url") != "") & P.same_domain("url", "homepage") & ~P.excluded_path("url"))
    x = _judged(x, "url", "anchor_text", "homepage").filter(F.col("score") >= R.MIN_PAGE_SCORE)
    return first_of(x.select("company", "homepage", "seq", "url", "page_type", "score", T.clean_text("anchor_text").alias("anchor_text")), company=F.col("company"), url=F.col("url"))


def sitemap_candidates(urls: DataFrame, homepage_read: bool = True) -> DataFrame:
    """URLs of sitemaps (company, homepage, seq, url). Without a readable homepage they are neither normalised nor held to a score."""
    x = T.computed(urls, url=U.crawl_url("url")) if homepage_read else urls
    x = _judged(x.filter((F.col("url") != "") & P.same_domain("url", "homepage")).withColumn("anchor_text", F.lit("")), "url", "anchor_text", "homepage")
    x = x.filter(F.col("score") >= R.MIN_PAGE_SCORE) if homepage_read else x.filter(~P.excluded_path("url"))
    return x.select("company", "homepage", "seq", "url", "page_type", "score", "anchor_text")


def discover(*sets: DataFrame) -> DataFrame:
    """Candidate sets in their order of precedence as each company's ranked pages. Ordinals within a set are below 2 ** 56."""
    ordered = [s.withColumn("seq", F.col("seq") + (n << 56)) for n, s in enumerate(sets)]
    union = ordered[0]
    for s in ordered[1:]:
        union = union.unionByName(s)
    return top_pages(merge_candidates(union, "company"), "company")
