"""URL columns from one RFC 3986 pattern; engines' own URL functions lose case, blanks and underscores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import rules as R
from .text import bind, clean_text, column

#: Groups: scheme, authority with slashes, authority, path, query, fragment.
PATTERN = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_GROUPS = {"scheme": 1, "slashes": 2, "authority": 3, "path": 4, "query": 5, "fragment": 6}


def part(url: str | Column, name: str) -> Column:
    x = F.regexp_extract(column(url), PATTERN, _GROUPS[name])
    return F.lower(x) if name == "scheme" else x


def bare_path(url: str | Column) -> Column:
    """The path without the last segment's parameters."""
    return F.regexp_replace(part(url, "path"), ";[^/]*$", "")


def _host(authority: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[^:]*$", "")), r"^www\.", "")


def host(url: str | Column) -> Column:
    """Lower-case host without www.; empty for anything without one."""
    return _host(part(url, "authority"))


def is_web_url(url: str | Column) -> Column:
    return part(url, "scheme").isin("http", "https") & (part(url, "authority") != "")


def _or_root(path: Column) -> Column:
    return F.when(path == "", "/").otherwise(path)


def _asked(query: Column) -> Column:
    return F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))


def input_url(value: str | Column) -> Column:
    """As typed by people: https unless said otherwise; parameters and fragment go."""

    def built(full: Column) -> Column:
        url = F.concat(part(full, "scheme"), F.lit("://"), F.lower(part(full, "authority")), bind(bare_path(full), _or_root), bind(part(full, "query"), _asked))
        return F.when(is_web_url(full), url).otherwise("")

    typed = lambda x: F.when((x == "") | x.rlike("(?i)^https?://"), x).otherwise(F.concat(F.lit("https://"), x))
    return bind(bind(clean_text(value), typed), built)


def crawl_url(value: str | Column, base: str | Column | None = None) -> Column:
    """For comparing fetched pages: resolved, without www., user and fragment; empty if too long or not of the web."""

    def built(full: Column, port: Column, name: Column) -> Column:
        shown = F.when(port.rlike("^0*$"), "").otherwise(F.concat(F.lit(":"), F.regexp_replace(port, "^0+", "")))
        url = F.concat(part(full, "scheme"), F.lit("://"), name, shown, bind(bare_path(full), _or_root), bind(part(full, "query"), _asked))
        good = (F.length(full) <= R.MAX_URL_LENGTH) & is_web_url(full) & (name != "") & port.rlike("^[0-9]{0,5}$") & (F.coalesce(F.substring(port, 1, 5).try_cast("int"), F.lit(0)) <= 65535)
        return F.when(good, url).otherwise("")

    absolute = clean_text(value) if base is None else bind(clean_text(value), lambda x: F.when(x == "", "").otherwise(resolve(base, x)))
    port = lambda full: F.regexp_extract(part(full, "authority"), r":([^:@\]]*)$", 1)
    return bind(F.regexp_replace(absolute, "#.*$", ""), lambda full: bind(port(full), lambda p: bind(host(full), lambda h: built(full, p, h))))


def strict_url(value: str | Column) -> Column:
    """For evidence: kept as it is but for trailing slashes; empty unless absolute."""
    return bind(clean_text(value), lambda x: F.when(is_web_url(x), F.regexp_replace(x, "/+$", "")).otherwise(""))


def domain_of(value: str | Column) -> Column:
    """The host of a URL, or what stands before the first slash of a bare domain."""
    bare = lambda x: F.regexp_replace(F.lower(F.regexp_extract(x, "^[^/]*", 0)), r"^www\.", "")
    return bind(clean_text(value), lambda x: F.when(part(x, "authority") != "", host(x)).otherwise(bare(x)))


def segments(url: str | Column) -> Column:
    """Lower-case path segments without page suffixes and blanks."""
    cut = F.transform(F.split(F.lower(bare_path(url)), "/"), lambda s: F.regexp_replace(F.trim(s), r"\.(?:html?|php|aspx?)\z", ""))
    return F.filter(cut, lambda s: s != "")


def terminal(url: str | Column) -> Column:
    return last(segments(url))


def last(parts: Column) -> Column:
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))


def _joined(base_path: Column, path: Column) -> Column:
    """Dot segments are taken back from the growing path, which is a string: '..' cuts its last segment."""
    folder = bind(F.regexp_replace(base_path, "[^/]+$", ""), _or_root)
    relative = F.regexp_replace(F.concat(folder, path), "(?<=.)/+(?=/)|(?<=^/)/+", "")
    step = lambda a, s: F.when(s == "..", F.regexp_replace(a, "/[^/]*$", "")).when(s == ".", a).otherwise(F.concat(a, F.lit("/"), s))
    steps = lambda full: bind(F.split(full, "/", -1), lambda xs: F.slice(xs, F.lit(2), F.size(xs)))
    walked = lambda full: F.concat(F.aggregate(steps(full), F.lit(""), step), F.when(full.rlike(r"/\.\.?$"), "/").otherwise(""))
    return bind(F.when(path.startswith("/"), path).otherwise(relative), walked)


def resolve(base: str | Column, reference: str | Column) -> Column:
    """The absolute form of a reference found on base."""

    def found(b: Column, r: Column, path: Column, query: Column) -> Column:
        tail = bind(part(r, "fragment"), lambda f: F.when(f == "", "").otherwise(F.concat(F.lit("#"), f)))
        kept = F.concat(part(b, "path"), F.when(query == "", bind(part(b, "query"), _asked)).otherwise(query))
        inner = F.when(path == "", kept).otherwise(F.concat(bind(part(b, "path"), lambda p: _joined(p, path)), query))
        local = F.concat(part(b, "scheme"), F.lit("://"), part(b, "authority"), inner, tail)
        other = F.concat(part(b, "scheme"), F.lit("://"), part(r, "authority"), path, query, tail)
        return F.when(r == "", b).when(part(r, "scheme") != "", r).when(part(r, "authority") != "", other).otherwise(local)

    parts = lambda b, r: bind(part(r, "path"), lambda p: bind(bind(part(r, "query"), _asked), lambda q: found(b, r, p, q)))
    return bind(column(base), lambda b: bind(column(reference), lambda r: parts(b, r)))
