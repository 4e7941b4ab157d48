"""Yes-or-no columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import rules as R
from . import text as T
from . import urls as U
from .arrays import name_tokens


def any_of(words: list[str]) -> str:
    return "|".join(map(re.escape, words))


def holds_any(value: Column, phrases: list[str]) -> Column:
    return value.rlike(any_of(phrases))


def same_domain(a, b) -> Column:
    return U.host(a) == U.host(b)


def same_company_domain(a, b) -> Column:
    related = lambda x, y: (x != "") & (y != "") & ((x == y) | F.endswith(x, F.concat(F.lit("."), y)) | F.endswith(y, F.concat(F.lit("."), x)))
    return T.bind(U.host(a), lambda x: T.bind(U.host(b), lambda y: related(x, y)))


def excluded_path(url) -> Column:
    return excluded_segments(U.segments(url))


def excluded_segments(segments: Column) -> Column:
    return F.exists(segments, lambda s: s.isin(*R.EXCLUDED_SEGMENTS) | holds_any(s, R.EXCLUDED_KEYWORDS))


def is_homepage(url, homepage) -> Column:
    return same_domain(url, homepage) & U.bare_path(url).rlike(r"\A/*\z")


def content_slug(url) -> Column:
    return T.bind(F.translate(U.terminal(url), "-", " "), slug_words)


def slug_words(words: Column) -> Column:
    return (words != "") & ((F.size(F.filter(F.split(words, r"\s+"), lambda w: w != "")) >= 4) | holds_any(words, R.CONTENT_SIGNALS))


def likely_person_name(value) -> Column:
    """The careful rule of extraction: a false name costs more than a missed one."""
    return T.bind(T.person_name(value), lambda name: T.bind(F.lower(name), lambda low: T.bind(F.split(low, " "), lambda words: _likely(name, low, words))))


def _likely(name: Column, low: Column, words: Column) -> Column:
    return (
        (name != "") & ~low.isin(*R.INVALID_NAMES) & ~holds_any(low, R.INVALID_NAME_PHRASES) & F.length(name).between(3, 100) & (F.size(words) <= 7)
        & ~low.rlike(r"@|http|www\.|\.com")
        & ~F.exists(words, lambda w: w.isin(*R.NAVIGATION_WORDS) | T.strip(w, ".,()").isin(*R.ROLE_WORDS))
        & ~F.concat(F.lit(" "), low, F.lit(" ")).rlike(f" (?:{'|'.join(R.SENTENCE_MARKERS)}) ")
        & name.rlike(rf"\A[{R.LATIN}0-9.'’&()\-–— ]+\z")
    )


def person_like(value) -> Column:
    """The rule of validation."""
    split = lambda low: F.filter(F.split(low, " "), lambda w: w != "")
    return T.bind(T.person_name_strict(value), lambda name: T.bind(F.lower(name), lambda low: T.bind(split(low), lambda words: _person_like(name, low, words))))


def _person_like(name: Column, low: Column, words: Column) -> Column:
    letters = F.length(F.regexp_replace(name, r"[^\p{L}]", ""))
    return (
        (name != "") & ~holds_any(low, R.BLOCKED_PHRASES) & F.length(name).between(4, 100) & F.size(words).between(2, 7) & (letters >= 3)
        & ~low.rlike("https?://|[<>]") & (F.size(F.filter(words, lambda w: w.isin(*R.SENTENCE_WORDS))) < 2)
    )


def clean_designation(value) -> Column:
    return T.bind(T.designation(value), _clean_title)


def _clean_title(x: Column) -> Column:
    low = F.lower(x)
    return (x != "") & (F.length(x) <= R.MAX_ROLE_CHARS) & ~holds_any(low, R.BLOCKED_PHRASES) & ~low.rlike("https?://") & holds_any(low, R.ROLE_TERMS)


def valid_email(value) -> Column:
    return T.column(value).rlike(rf"\A[{R.EMAIL_CLASS}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\z")


def digits(value) -> Column:
    return F.regexp_replace(T.column(value), "[^0-9]", "")


def probable_phone(value) -> Column:
    return F.length(digits(value)).between(7, 15)


def contact_page(url, page_type) -> Column:
    named = F.arrays_overlap(F.split(F.lower(U.bare_path(url)), "/"), F.array(*map(F.lit, R.CONTACT_SEGMENTS)))
    return (F.coalesce(T.column(page_type), F.lit("")) == "contact") | named


def generic_anchor(url) -> Column:
    """A URL's fragment never holds its own mark, so only an empty one is generic."""
    return U.part(url, "fragment") == ""


def profile_url(url, name, needs_fragment: bool = True) -> Column:
    """needs_fragment: off, pages without a fragment can be profiles too."""
    names = lambda slug: F.exists(name_tokens(name), lambda t: F.contains(slug, t))
    found = T.bind(F.lower(U.bare_path(url)), lambda path: holds_any(path, R.PROFILE_TERMS) & T.bind(F.regexp_replace(path, "[^a-z0-9]+", "-"), names))
    return found & ~generic_anchor(url) if needs_fragment else found
