"""The engine's phases from a company list and a snapshot of pages to leads with contacts. Tables meet as Parquet in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from ..operators import contacts as K
from ..operators import discovery
from ..operators import leads as L
from ..operators import pages as O
from ..operators import people, summaries
from ..operators.keyed import first_of
from ..sources import crawl, dom, sinks, tables


def run(spark: SparkSession, companies: DataFrame, snapshot: DataFrame, folder: str, include_link_contacts: bool = False) -> dict[str, DataFrame]:
    """companies: seq, company_name, website. snapshot: page_id, url_key, requested_url, final_url, status, content_type, body, error."""

    def stored(df: DataFrame, name: str) -> DataFrame:
        sinks.write_table(df, f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    snapshot = stored(crawl.distinct_snapshot(snapshot), "snapshot")
    checked = stored(crawl.check_companies(tables.distinct_companies(companies).select("seq", "company_name", "website"), snapshot, distinct=True), "companies")
    readable = snapshot.filter("error IS NULL AND status < 400 AND lower(content_type) LIKE '%html%'")
    nodes = stored(dom.dom_nodes(readable, html="body"), "dom_nodes")
    homes = tables.reachable_companies(checked).select("seq", F.col("seq").alias("company"), "company_name", "company_domain", U.crawl_url("final_url").alias("homepage")).filter("homepage <> ''")
    homes = stored(homes.join(readable.select("page_id", "url_key"), F.col("homepage") == F.col("url_key"), "left").drop("url_key"), "homes")
    home_pages, unread = homes.filter("page_id IS NOT NULL"), homes.filter("page_id IS NULL").drop("page_id")
    anchors = O.homepage_anchors(nodes).join(home_pages.select("page_id", "company", "homepage"), "page_id")
    listed = lambda some: crawl.sitemap_urls(some, snapshot, distinct=True)
    probed = lambda some: discovery.probed_candidates(some.drop("page_id"), snapshot, distinct=True)
    found = discovery.discover(discovery.link_candidates(anchors), discovery.sitemap_candidates(listed(home_pages)), probed(home_pages))
    # without a readable home page only probes and sitemaps tell, the latter as they are
    found = found.unionByName(discovery.discover(probed(unread), discovery.sitemap_candidates(listed(unread), homepage_read=False)))
    named = found.drop("homepage").join(homes.select("company", "company_name", "company_domain", "homepage"), "company")
    # pages are sorted, so their numbers rise with company, score and URL: the order in which "first" is meant from here on
    ordered = discovery.distinct_pages(named.withColumnRenamed("url", "page_url").drop("place")).withColumn("page_no", F.monotonically_increasing_id())
    pages = stored(ordered, "website_pages")
    fetched = stored(crawl.fetch(pages, "page_url", snapshot, distinct=True).drop("body"), "fetched_pages")
    contacts = O.page_contacts(fetched, nodes, also=["page_no"])
    page_contacts = stored(contacts.withColumnRenamed("page_no", "seq"), "page_contacts")
    leading = tables.leadership_pages(fetched).select("page_id", "page_no", "company_name", "company_domain", F.col("page_url").alias("source_url"))
    candidates = stored(people.page_people(nodes.join(leading.select("page_id").distinct(), "page_id", "left_semi"), leading), "cxo_people")
    validated = stored(L.validate(candidates), "validated")
    final = stored(L.final_leads(validated), "final")
    texts = O.page_texts(nodes, ["script", "style", "noscript", "svg"])
    sources = fetched.select(U.strict_url("page_url").alias("source_url"), "page_id", "page_no", "final_url", "status", "content_type", "error")
    sources = first_of(sources, order="page_no", source_url=F.col("source_url")).join(texts, "page_id", "left").drop("page_id", "page_no")
    links = fetched.select(U.strict_url("page_url").alias("source_url"), "page_id", F.col("final_url").alias("homepage")).join(O.anchors(nodes).select("page_id", "node_id", "parent_id", "href", F.col("text").alias("anchor")), "page_id")
    context = nodes.select("page_id", F.col("node_id").alias("parent_id"), F.col("text").alias("context"))
    links = links.join(context, ["page_id", "parent_id"], "left").withColumn("abs_url", U.resolve("homepage", T.clean_text("href")))
    wanted = final.select(F.col("seq").alias("lead"), "person_name", "designation", U.strict_url("source_url").alias("source_url")).join(links, "source_url")
    profiles = L.best_profile(L.candidate_links(wanted.withColumn("seq", F.col("node_id").cast("long"))))
    enriched = stored(L.enrich(final, sources, profiles), "enriched")
    joined = L.join_enrichment(final, enriched)
    master = stored(L.sorted_master(L.master(final, enriched)), "leads_master")
    index = K.contact_index(K.contact_records(page_contacts, include_link_contacts))
    merged = stored(K.distinct_leads(K.with_contacts(master, index)), "leads_master_with_contacts")
    companies_out = stored(K.company_contacts(merged), "company_contacts")
    summary = stored(summaries.run_summary(master, final, enriched, joined).unionByName(summaries.merge_summary(merged, companies_out)), "run_summary")
    sinks.write_split(merged, f"{folder}/by_type", {kind.replace(" ", "_").lower(): F.col("leadership_type") == kind for kind in R.PRIORITIES}, format="csv")
    return {"companies": checked, "pages": pages, "page_contacts": page_contacts, "candidates": candidates, "validated": validated, "leads": merged, "company_contacts": companies_out, "summary": summary}
