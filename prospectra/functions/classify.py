"""Ordered classification and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from . import predicates as P
from . import rules as R
from . import text as T
from . import urls as U
from .arrays import name_tokens


def page_type(url, anchor, homepage) -> Column:
    """other unless the last segment, then the anchor, then a lone segment names a type."""
    of = lambda table: {name: kind for kind, names in reversed(table.items()) for name in names}

    def judged(u: Column, parts: Column, last: Column) -> Column:
        nothing = P.is_homepage(u, homepage) | P.excluded_segments(parts) | (last == "") | T.bind(F.translate(last, "-", " "), P.slug_words)
        lone = F.when(F.size(parts) == 1, F.translate(last, "-_", "  ")).otherwise("")
        by_place = T.lookup(T.match_key(anchor), of(R.ANCHOR_PATTERNS), T.lookup(lone, R.SINGLE_SEGMENTS, F.lit("other")))
        return F.when(nothing, "other").otherwise(T.lookup(last, of(R.PAGE_PATTERNS), by_place))

    return T.bind(T.column(url), lambda u: T.bind(U.segments(u), lambda parts: T.bind(U.last(parts), lambda last: judged(u, parts, last))))


def page_score(kind: Column) -> Column:
    return T.lookup(kind, R.PAGE_SCORES, F.lit(0))


def role(value) -> Column:
    """(title, kind) of the first role in order that the text names; both empty if none."""

    def first(x: Column) -> Column:
        pair = lambda title, kind: F.struct(F.lit(title).alias("title"), F.lit(kind).alias("kind"))
        return reduce(lambda w, r: w.when(x.rlike(f"(?i){r[0]}"), pair(*r[1:])), R.ROLES, F.when(x == "", pair("", ""))).otherwise(pair("", ""))

    return T.bind(T.clean_text(value), first)


def extracted_designation(value) -> Column:
    """The whole clean text when short, else the role's title."""
    shown = lambda x, r: F.struct(F.when(r["title"] == "", "").when(F.length(x) <= R.MAX_ROLE_CHARS, x).otherwise(r["title"]).alias("designation"), r["kind"].alias("leadership_type"))
    return T.bind(T.clean_text(value), lambda x: T.bind(role(x), lambda r: shown(x, r)))


def leadership_type(supplied, title) -> Column:
    """By the title first: board, then chiefs, then executives; then what was supplied."""
    chiefs = rf"\bchief\s+(?:{R.CHIEF_ROLES})\s+officer\b|\bmanaging\s+director\b"
    board = rf"\b(?:{'|'.join(R.BOARD_ROLES)})\b|\A\s*(?:lead\s+)?director\s*\z"
    named = lambda low: F.when(low.rlike(board), "Board").when(low.rlike(chiefs), "CXO").when(low.rlike(rf"\b(?:{'|'.join(R.EXECUTIVE_ROLES)})\b"), "Executive Leadership")
    return T.bind(F.lower(T.designation(title)), lambda low: named(low).otherwise(T.lookup(T.match_key(supplied), R.SUPPLIED_TYPES, F.lit("Unknown"))))


def priority(kind) -> Column:
    return T.lookup(T.column(kind), R.PRIORITIES, F.lit("LOW"))


def input_status(code, error) -> Column:
    """What became of a company's first request."""
    c = T.column(code)
    return F.when(T.column(error).isNotNull(), F.concat(F.lit("REQUEST_ERROR:"), error)).when(c < 400, "VALIDATED").when(c.isin(401, 403), F.concat(F.lit("BLOCKED_"), c)).when(c == 429, "RATE_LIMITED_429").otherwise(F.concat(F.lit("HTTP_"), c))


def source_status(code, content_type, error) -> Column:
    """What became of an evidence page's request."""
    c = T.column(code)
    return F.when(T.column(error).isNotNull(), F.concat(F.lit("request_error:"), error)).when(c.isin(401, 403), F.concat(F.lit("blocked_"), c)).when(c == 429, "rate_limited_429").when(c >= 400, F.concat(F.lit("http_error_"), c)).when(~F.contains(F.lower(F.coalesce(T.column(content_type), F.lit(""))), F.lit("html")), "non_html").otherwise("ok")


def source_quality(method, url) -> Column:
    place = T.bind(U.strict_url(url), lambda u: F.when(u == "", 0).when(U.host(u) == "", 15).otherwise(25))
    return T.lookup(T.match_key(method), R.METHOD_BONUS, F.lit(10)) + place


def role_quality(title: Column, kind: Column) -> Column:
    base = T.bind(kind, lambda k: F.when(k == "CXO", 25).when(k.isin("Board", "Executive Leadership"), 20).otherwise(0))
    words = T.bind(F.lower(title), lambda low: sum(F.when(F.contains(low, F.lit(w)), 10).otherwise(0) for w in ("chief", "officer", "managing director")))
    return F.least(base + words, F.lit(50))


def quality_score(name, title, supplied, method, url, company) -> Column:
    points = source_quality(method, url) + role_quality(T.designation(title), leadership_type(supplied, title))
    points += F.when(P.person_like(name), 10).otherwise(0) + F.when(P.clean_designation(title), 10).otherwise(0) + F.when(T.clean_text(company) != "", 5).otherwise(0)
    return F.least(points, F.lit(100))


def validation_reason(name, title, names_another: Column, url, company) -> Column:
    return (
        F.when(~P.person_like(name), "invalid_person_name").when(~P.clean_designation(title), "invalid_designation")
        .when(names_another, "designation_contains_other_person").when(U.strict_url(url) == "", "missing_source_url")
        .when(T.clean_text(company) == "", "missing_company").otherwise("passed_validation")
    )


def name_match_score(name, candidate) -> Column:
    points = lambda n, hits: F.when(n == 0, 0).when(hits == n, 70).when(hits >= 2, 50).when(hits == 1, 20).otherwise(0)
    hits = lambda tokens: T.bind(T.match_key(candidate), lambda low: F.size(F.filter(tokens, lambda t: F.contains(low, t))))
    return T.bind(name_tokens(name), lambda tokens: T.bind(hits(tokens), lambda h: points(F.size(tokens), h)))


def path_score(url) -> Column:
    count = lambda path, terms: sum(F.when(F.contains(path, F.lit(t)), 1).otherwise(0) for t in terms)
    return T.bind(F.lower(U.bare_path(url)), lambda path: F.greatest(12 * count(path, R.PROFILE_TERMS) - 20 * count(path, R.IGNORED_TERMS), F.lit(0)))


def role_match_score(title, candidate) -> Column:
    return T.bind(T.match_key(candidate), lambda b: role_match(title, b))


def role_match(title, low: Column) -> Column:
    """role_match_score of a text that is a match key already."""
    shared = lambda a: sum(F.when(F.contains(a, F.lit(t)) & F.contains(low, F.lit(t)), 1).otherwise(0) for t in R.MATCH_TERMS)
    return T.bind(T.match_key(title), lambda a: F.when((a == "") | (low == ""), 0).when(F.contains(low, a), 35).otherwise(F.least(8 * shared(a), F.lit(25))))


def link_score(name, title, url, anchor, context) -> Column:
    """Capped at 100; 0 means no evidence."""
    half = F.floor(name_match_score(name, context) / 2).cast("int")
    return F.least(name_match_score(name, anchor) + half + path_score(url) + role_match_score(title, context), F.lit(100))


def enrichment_outcome(fetch_status, verified: Column, person: Column, title: Column, profile: Column) -> Column:
    s = T.column(fetch_status)
    pair = lambda confidence, status: F.struct(confidence.alias("confidence"), status.alias("status"))
    seen = F.when(person & title, pair(F.lit("HIGH"), F.lit("person_and_designation_found"))).when(person, pair(F.lit("MEDIUM"), F.lit("person_found_designation_not_confirmed")))
    seen = seen.when(profile, pair(F.lit("MEDIUM"), F.lit("profile_link_candidate_found"))).otherwise(pair(F.lit("LOW"), F.lit("no_additional_person_evidence_found")))
    failed = pair(F.when(verified, "MEDIUM").otherwise("LOW"), F.concat(F.lit("additional_evidence_unavailable:"), s))
    return F.when(s.startswith("request_error"), pair(F.lit("LOW"), s)).when(s != "ok", failed).otherwise(seen)


def contact_outcome(found: Column, email: Column, phone: Column) -> Column:
    reached = (F.coalesce(email, F.lit("")) != "") | (F.coalesce(phone, F.lit("")) != "")
    pair = lambda status, confidence: F.struct(F.lit(status).alias("contact_status"), F.lit(confidence).alias("contact_confidence"))
    return F.when(~found, pair("NOT_FOUND", "LOW")).when(reached, pair("FOUND", "HIGH")).otherwise(pair("SOURCE_FOUND", "MEDIUM"))
