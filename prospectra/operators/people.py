"""Leadership candidates from page structure: structured data, cards, siblings, near parents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import classify as C
from ..functions import predicates as P
from ..functions import rules as R
from ..functions import text as T
from ..functions import urls as U
from .keyed import best_candidates, candidate_keys, first_of

METHODS = ["json_ld", "semantic_card", "sibling_pair", "local_parent"]


def _with_roles(nodes: DataFrame, most: int | None = R.MAX_ROLE_CHARS) -> DataFrame:
    """nodes and role (designation, leadership_type); empty for long texts unless most is None."""
    got = C.extracted_designation("text")
    none = F.struct(F.lit("").alias("designation"), F.lit("").alias("leadership_type"))
    return nodes.withColumn("text", T.clean_text("text")).withColumn("role", got if most is None else F.when(F.length("text").between(1, most), got).otherwise(none))


def container_names(nodes: DataFrame) -> DataFrame:
    """(page_id, container, name): elements within which exactly one person is named, by headings or, failing any, by links."""
    named = nodes.filter(F.col("tag").isin(*R.NAME_TAGS, "a")).withColumn("name", T.clean_text("text")).filter(P.likely_person_name("name"))
    cells = named.select("page_id", "node_id", "name", (F.col("tag") == "a").alias("link"), F.explode("ancestors").alias("container"))
    by = lambda link: [f(F.when(F.col("link") == link, x)).alias(f"{n}_{link}") for n, f, x in (("least", F.min, F.lower("name")), ("most", F.max, F.lower("name")), ("first", F.min, F.struct("node_id", "name")))]
    sums = cells.groupBy("page_id", "container").agg(*by(False), *by(True))
    pick = lambda n: F.when(F.col("least_False").isNotNull(), F.col(f"{n}_False")).otherwise(F.col(f"{n}_True"))
    return sums.filter(pick("least") == pick("most")).select("page_id", "container", pick("first")["name"].alias("name"))


def container_roles(nodes: DataFrame) -> DataFrame:
    """(page_id, container, role): elements within which exactly one designation stands; texts before headings."""
    texts = _with_roles(nodes.filter(F.col("tag").isin(*R.ROLE_TAGS))).withColumn("rank", F.lit(0))
    heads = _with_roles(nodes.filter(F.col("tag").isin(*R.HEADINGS)), None).withColumn("rank", F.lit(1))
    cells = texts.unionByName(heads).filter("role.designation <> ''").select("page_id", "rank", "node_id", "role", F.explode("ancestors").alias("container"))
    key = F.struct(F.lower("role.designation"), F.lower("role.leadership_type"))
    sums = cells.groupBy("page_id", "container").agg(F.min(key).alias("least"), F.max(key).alias("most"), F.min(F.struct("rank", "node_id", "role"))["role"].alias("role"))
    return sums.filter("least = most").select("page_id", "container", "role")


def _candidates(found: DataFrame, pages: DataFrame, method: str, confidence: str) -> DataFrame:
    """found: page_id, node_id, name, role and perhaps place within the element. pages: page_id, company_name, company_domain, source_url, and
    page_no where pages have an order of their own.
    """
    x = found.join(pages, "page_id").withColumn("person_name", T.person_name("name")).filter(P.likely_person_name("person_name"))
    given = F.regexp_replace(T.match_key("company_domain"), r"^www\.", "")
    # page, method, element, place: 38 digits hold them side by side
    page = F.col("page_no" if "page_no" in pages.columns else "page_id").cast("decimal(19,0)")
    within = F.col("node_id").cast("long") * (1 << 31) + (F.col("place") if "place" in found.columns else F.lit(0))
    place = page * F.lit(Decimal(10**19)).cast("decimal(20,0)") + (F.lit(METHODS.index(method) * 10**18).cast("decimal(20,0)") + within.cast("decimal(20,0)"))
    place = place.cast("decimal(38,0)")
    return x.select(
        place.alias("seq"), T.clean_text("company_name").alias("company_name"), F.when(given == "", U.host("source_url")).otherwise(given).alias("company_domain"), "person_name",
        T.clean_text("role.designation").alias("designation"), F.col("role.leadership_type").alias("leadership_type"), F.lit(confidence).alias("confidence"), F.lit(method).alias("extraction_method"), "source_url",
    ).filter("designation <> ''")


def json_ld_people(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Person records of structured data: an object, its graph, or a list of objects. What isn't an object is passed over."""
    scripts = nodes.filter((F.col("tag") == "script") & F.col("attrs")["type"].rlike(r"(?i)application/ld\+json"))
    data = scripts.select("page_id", "node_id", F.try_parse_json("own_text").alias("v")).filter("v IS NOT NULL")
    listed = lambda path: F.coalesce(F.try_variant_get("v", path, "array<variant>"), F.array().cast("array<variant>"))
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    items = data.select("page_id", "node_id", F.posexplode(F.when(is_list, listed("$")).otherwise(F.concat(F.array("v"), listed('$["@graph"]')))).alias("place", "item"))
    field = lambda name, kind="string": F.try_variant_get("item", f'$["{name}"]', kind)
    kinds = F.coalesce(field("@type", "array<string>"), F.array(field("@type")))
    people = items.filter(F.exists(kinds, lambda k: F.lower(k) == "person")).select("page_id", "node_id", "place", T.clean_text(field("name")).alias("name"), C.extracted_designation(field("jobTitle")).alias("role"))
    return _candidates(people.filter("name <> '' AND role.designation <> ''"), pages, "json_ld", "HIGH")


def semantic_cards(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Small articles, list items and profile-like divisions that name one person and one role."""
    classes = F.lower(F.array_join("classes", " "))
    cards = nodes.filter(F.col("tag").isin("article", "li") | ((F.col("tag") == "div") & P.holds_any(classes, R.CARD_CLASSES))).filter(F.length(T.clean_text("text")).between(1, R.MAX_CARD_CHARS))
    x = cards.select("page_id", "node_id", F.col("node_id").alias("container")).join(container_names(nodes), ["page_id", "container"]).join(container_roles(nodes), ["page_id", "container"])
    return _candidates(x, pages, "semantic_card", "HIGH")


def sibling_pairs(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Names with exactly one role among the two elements before and after them under the same parent."""
    line = W.partitionBy("page_id", "parent_id").orderBy("child_index")
    roles = _with_roles(nodes.filter("parent_id IS NOT NULL")).withColumn("_r", F.when(F.col("role.designation") != "", F.col("role")))
    near = roles.withColumn("around", F.array_compact(F.array(F.lag("_r", 2).over(line), F.lag("_r", 1).over(line), F.lead("_r", 1).over(line), F.lead("_r", 2).over(line))))
    x = near.filter(F.col("tag").isin(*R.NAME_TAGS, "a") & (F.size("around") == 1)).filter(P.likely_person_name("text"))
    return _candidates(x.select("page_id", "node_id", F.col("text").alias("name"), F.col("around")[0].alias("role")), pages, "sibling_pair", "HIGH")


def local_parent_pairs(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Roles whose nearest of three enclosing elements with exactly one name isn't beyond one of over 500 characters."""
    roles = _with_roles(nodes.filter(F.col("tag").isin("p", "span", "small", "div", "li"))).filter("role.designation <> ''")
    up = roles.select("page_id", "node_id", "role", F.posexplode(F.slice("ancestors", 1, 3)).alias("level", "container"))
    sizes = nodes.select("page_id", F.col("node_id").alias("container"), (F.length(T.clean_text("text")) > R.MAX_CARD_CHARS).alias("large"))
    x = up.join(sizes, ["page_id", "container"]).join(container_names(nodes), ["page_id", "container"], "left")
    found = x.groupBy("page_id", "node_id").agg(F.first("role").alias("role"), F.min(F.when(F.col("large"), F.col("level"))).alias("stop"), F.min(F.when(F.col("name").isNotNull(), F.struct("level", "name"))).alias("hit"))
    return _candidates(found.filter("hit IS NOT NULL AND (stop IS NULL OR hit.level < stop)").select("page_id", "node_id", F.col("hit.name").alias("name"), "role"), pages, "local_parent", "MEDIUM")


def all_candidates(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    parts = [f(nodes, pages) for f in (json_ld_people, semantic_cards, sibling_pairs, local_parent_pairs)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def page_people(nodes: DataFrame, pages: DataFrame, by_method: bool = False) -> DataFrame:
    """Each domain's person and title once, the most trusted method's.

    Of equal trust: as page follows page, and the last structured-data record; by_method: as METHODS follow each other, and the first page.
    """
    found = all_candidates(nodes, pages)
    if not by_method:
        return best_candidates(found)
    rank = F.array_position(F.array(*map(F.lit, METHODS)), F.col("extraction_method"))
    return first_of(found.withColumn("_order", F.struct(rank.alias("method"), "seq")), order="_order", **candidate_keys()).drop("_order")
