"""Contacts of pages, from the element relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import extract as X
from ..functions import predicates as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U

# fixed values: elements whose content isn't shown
DROPPED = ["script", "style", "noscript", "svg", "canvas", "iframe", "template"]


def shown(nodes: DataFrame, dropped: list[str] = DROPPED) -> DataFrame:
    return nodes.filter(~F.col("tag").isin(*dropped) & ~F.arrays_overlap("ancestor_tags", F.array(*map(F.lit, dropped))))


def _first_distinct(df: DataFrame, key: Column, most: int | None = None) -> DataFrame:
    """(page_id, values): each key's first value per page in document order."""
    once = df.groupBy("page_id", key.alias("_k")).agg(F.min(F.struct("node_id", "value")).alias("v"))
    listed = once.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list("v")), lambda x: x["value"]).alias("values"))
    return listed if most is None else listed.withColumn("values", F.slice("values", 1, most))


def anchors(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("tag") == "a") & F.col("attrs")["href"].isNotNull()).withColumn("href", F.trim(F.col("attrs")["href"])).filter("href <> ''")


def page_titles(nodes: DataFrame) -> DataFrame:
    titles = nodes.filter("tag = 'title'")
    return titles.groupBy("page_id").agg(F.min_by(T.clean_text("text"), "node_id").alias("page_title"))


def page_texts(nodes: DataFrame, dropped: list[str] = DROPPED) -> DataFrame:
    """(page_id, page_text): all shown text of a page in document order.

    Pieces come from whole elements: the text of an element without dropped content is taken as it is, others are taken apart.
    """
    inner = nodes.filter(F.col("tag").isin(*dropped) & ~F.col("tag").isin("script", "style", "template")).select("page_id", F.explode("ancestors").alias("node_id")).distinct()
    roots = shown(nodes, dropped).join(inner, ["page_id", "node_id"], "left_anti")
    # topmost elements without dropped parts, and the own text of the others
    parents = shown(nodes, dropped).join(inner, ["page_id", "node_id"], "left_semi")
    top = roots.join(parents.select("page_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("cut")), ["page_id", "parent_id"], "left").filter("cut OR parent_id IS NULL")
    pieces = top.select("page_id", "node_id", "text").union(parents.select("page_id", "node_id", F.col("own_text").alias("text"))).filter("text <> ''")
    return pieces.groupBy("page_id").agg(T.clean_text(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "text"))), lambda x: x["text"]), " ")).alias("page_text"))


def mailto_emails(nodes: DataFrame) -> DataFrame:
    x = anchors(nodes).filter(F.lower("href").startswith("mailto:"))
    value = F.trim(F.substring_index(F.trim(F.regexp_replace("href", "^mailto:", "")), "?", 1))
    return _first_distinct(x.withColumn("value", value).filter(F.contains("value", F.lit("@"))), F.col("value"))


def tel_numbers(nodes: DataFrame) -> DataFrame:
    x = anchors(nodes).filter(F.lower("href").startswith("tel:"))
    value = F.trim(F.substring_index(F.trim(F.regexp_replace("href", "^tel:", "")), ";", 1))
    return _first_distinct(x.withColumn("value", value).filter(F.length(P.digits("value")) >= 7), F.col("value"))


def contact_links(nodes: DataFrame, bases: DataFrame) -> DataFrame:
    """bases: page_id, final_url."""
    x = anchors(nodes).filter(~F.lower("href").rlike("^(?:mailto|tel):") & P.holds_any(F.concat_ws(" ", F.lower("href"), T.match_key("text")), R.CONTACT_SEGMENTS))
    x = x.join(bases, "page_id").withColumn("value", F.regexp_replace(U.resolve("final_url", "href"), "#.*$", ""))
    return _first_distinct(x, F.col("value"), R.MAX_CONTACT_LINKS)


def page_contacts(pages: DataFrame, nodes: DataFrame, also: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """A contact row, with the columns of pages named by also, per fetched page (page_id, company_name, company_domain, page_url, page_type, score, final_url, status, content_type, error)."""
    failed = F.col("status").isNull() | F.col("error").isNotNull() | (F.col("status") >= 400)
    html = F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("html"))
    trouble = F.when(F.coalesce("page_url", F.lit("")) == "", "Page URL is empty").when(failed, "Page request failed").when(~html, "Page did not return HTML").otherwise("")
    x = pages.withColumn("_failed", failed).withColumn("error", trouble)
    kept = shown(nodes)
    lists = {"mailto_emails": mailto_emails(kept), "tel_numbers": tel_numbers(kept), "contact_links": contact_links(kept, pages.select("page_id", "final_url"))}
    out = x.join(page_titles(kept), "page_id", "left").join(page_texts(nodes), "page_id", "left")
    for name, values in lists.items():
        out = out.join(values.withColumnRenamed("values", name), "page_id", "left")
    ok = F.col("error") == ""
    cell = lambda c: F.when(ok, F.coalesce(F.array_join(c, "; "), F.lit(""))).otherwise("")
    text = F.when(ok, F.coalesce("page_text", F.lit(""))).otherwise("")
    return out.withColumn("page_text", text).select(
        "page_id", "company_name", "company_domain", "page_url", "page_type", "score", F.when(ok, F.coalesce("page_title", F.lit(""))).otherwise("").alias("page_title"),
        F.when(F.col("_failed"), "").otherwise(F.col("final_url")).alias("final_url"), F.when(F.col("_failed"), "").otherwise(F.col("status").cast("string")).alias("status_code"), cell(X.emails("page_text")).alias("emails"),
        cell(F.col("mailto_emails")).alias("mailto_emails"), cell(X.phones("page_text")).alias("phone_numbers"), cell(F.col("tel_numbers")).alias("tel_numbers"),
        F.when(ok & P.contact_page("page_url", "page_type"), "YES").otherwise("NO").alias("contact_page"), cell(F.col("contact_links")).alias("contact_links"), "page_text", "error", *also,
    )


def homepage_anchors(nodes: DataFrame) -> DataFrame:
    """Anchors within the first twelve navigation containers, 300 of each and 600 in all; every anchor where there are none."""
    from pyspark.sql import Window as W

    rank = lambda by, order: F.row_number().over(W.partitionBy(*by).orderBy(*order))
    containers = nodes.filter(F.col("tag").isin("nav", "header", "main", "footer")).withColumn("container", rank(["page_id"], ["node_id"])).filter(F.col("container") <= R.MAX_CONTAINERS).select("page_id", F.col("node_id").alias("holder"), "container")
    links = nodes.filter((F.col("tag") == "a") & F.col("attrs")["href"].isNotNull()).select("page_id", "node_id", "ancestors", F.col("attrs")["href"].alias("href"), T.clean_text("text").alias("anchor_text"))
    inside = links.select("page_id", "node_id", F.explode("ancestors").alias("holder")).join(containers, ["page_id", "holder"]).withColumn("place", rank(["page_id", "container"], ["node_id"])).filter(F.col("place") <= R.MAX_ANCHORS)
    first = inside.groupBy("page_id", "node_id").agg(F.min(F.struct("container", "place")).alias("at"))
    none = links.join(first.select("page_id").distinct(), "page_id", "left_anti").withColumn("at", F.struct(F.lit(0).alias("container"), F.col("node_id").alias("place")))
    chosen = links.join(first, ["page_id", "node_id"]).select("page_id", "node_id", "href", "anchor_text", "at").union(none.select("page_id", "node_id", "href", "anchor_text", "at"))
    return chosen.withColumn("seq", rank(["page_id"], ["at"]).cast("long")).filter(F.col("seq") <= R.MAX_LINKS).drop("at")
