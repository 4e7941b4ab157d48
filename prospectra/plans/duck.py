"""The same expressions in DuckDB's SQL, for oracles. Every function takes and returns SQL text."""

from __future__ import annotations

import re

from ..functions import rules as R

URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SPACE = r"[\s\p{Z}\x{0B}\x{85}]+"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{SPACE}', ' ', 'g'))"


def key(x: str) -> str:
    return f"lower({clean(x)})"


def any_of(x: str, phrases) -> str:
    return f"regexp_matches({x}, {q('|'.join(map(re.escape, phrases)).replace(chr(92) + ' ', ' ').replace(chr(92) + '-', '-'))})"


def case(x: str, table: dict, default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}" for k, v in table.items()) + f" ELSE {default} END"


def person(x: str) -> str:
    return f"trim(regexp_replace({clean(x)}, '^(?i:{'|'.join(R.HONORIFICS)})\\.?\\s+', ''), ' -–—:|,')"


def person_strict(x: str) -> str:
    return f"trim(regexp_replace({clean(x)}, '\\s+([,.''’])', '\\1', 'g'), ' -–—|')"


def title(x: str) -> str:
    out = clean(x)
    for p in R.ROLE_NOISE:
        out = f"regexp_replace({out}, '(?i)\\s*{p}\\s*', ' ', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'), ' -–—|,;')"


def part(x: str, group: int) -> str:
    return f"regexp_extract({x}, '{URL}', {group})"


def scheme(x: str) -> str:
    return f"lower({part(x, 1)})"


def authority(x: str) -> str:
    return part(x, 3)


def path(x: str) -> str:
    return f"regexp_replace({part(x, 4)}, ';[^/]*$', '')"


def host(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower(regexp_replace({authority(x)}, '^.*@', '')), ':[^:]*$', ''), '^www\\.', '')"


def web(x: str) -> str:
    return f"({scheme(x)} IN ('http', 'https') AND {authority(x)} <> '')"


def asked(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN '' ELSE '?' || {x} END"


def or_root(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN '/' ELSE {x} END"


def strict_url(x: str) -> str:
    c = clean(x)
    return f"CASE WHEN {web(c)} THEN rtrim({c}, '/') ELSE '' END"


def input_url(x: str) -> str:
    c = clean(x)
    full = f"(CASE WHEN regexp_matches({c}, '(?i)^https?://') THEN {c} ELSE 'https://' || {c} END)"
    return f"CASE WHEN {c} = '' OR NOT {web(full)} THEN '' ELSE {scheme(full)} || '://' || lower({authority(full)}) || {or_root(path(full))} || {asked(part(full, 5))} END"


def domain_of(x: str) -> str:
    c = clean(x)
    return f"CASE WHEN {authority(c)} <> '' THEN {host(c)} ELSE regexp_replace(lower(split_part({c}, '/', 1)), '^www\\.', '') END"


def segments(x: str) -> str:
    return f"list_filter(list_transform(string_split(lower({path(x)}), '/'), lambda s: regexp_replace(trim(s), '\\.(?:html?|php|aspx?)$', '')), lambda s: s <> '')"


def terminal(x: str) -> str:
    return f"coalesce(list_extract({segments(x)}, -1), '')"


def excluded(x: str) -> str:
    return f"len(list_filter({segments(x)}, lambda s: s IN {listed(R.EXCLUDED_SEGMENTS)} OR {any_of('s', R.EXCLUDED_KEYWORDS)})) > 0"


def homepage(x: str, home: str) -> str:
    return f"({host(x)} = {host(home)} AND trim({path(x)}, '/') = '')"


def slug(x: str) -> str:
    t = terminal(x)
    return f"({t} <> '' AND (len(list_filter(string_split(replace({t}, '-', ' '), ' '), lambda w: w <> '')) >= 4 OR {any_of(f'replace({t}, ' + q('-') + ', ' + q(' ') + ')', R.CONTENT_SIGNALS)}))"


def values(x: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({clean(x)}, '[;,|]+'), lambda s: trim(s)), lambda s: s <> '')"


def unique(x: str) -> str:
    """Ordered, case-insensitive: a value stays if no earlier one equals it."""
    return f"list_transform(list_filter(list_transform({x}, lambda s, i: {{'s': s, 'i': i}}), lambda p: list_position(list_transform({x}, lambda s: lower(s)), lower(p.s)) = p.i), lambda p: p.s)"


def joined(x: str, sep: str = " | ") -> str:
    return f"coalesce(array_to_string({x}, {q(sep)}), '')"


def tokens(x: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all({clean(x)}, '[{R.LATIN}]{{2,}}'), lambda t: lower(t)), lambda t: t NOT IN {listed(R.NAME_STOP_WORDS)})"


def likely_person(x: str) -> str:
    n = person(x)
    low = f"lower({n})"
    return (
        f"({n} <> '' AND {low} NOT IN {listed(R.INVALID_NAMES)} AND NOT {any_of(low, R.INVALID_NAME_PHRASES)} AND length({n}) BETWEEN 3 AND 100 AND len(string_split({n}, ' ')) <= 7"
        f" AND NOT regexp_matches({low}, '@|http|www\\.|\\.com') AND len(list_filter(string_split({low}, ' '), lambda w: w IN {listed(R.NAVIGATION_WORDS)} OR trim(w, '.,()') IN {listed(R.ROLE_WORDS)})) = 0"
        f" AND NOT regexp_matches(' ' || {low} || ' ', ' (?:{'|'.join(R.SENTENCE_MARKERS)}) ') AND regexp_full_match({n}, '[{R.LATIN}0-9.''’&()\\-–— ]+'))"
    )


def person_like(x: str) -> str:
    n = person_strict(x)
    low = f"lower({n})"
    words = f"list_filter(string_split({low}, ' '), lambda w: w <> '')"
    return (
        f"({n} <> '' AND NOT {any_of(low, R.BLOCKED_PHRASES)} AND length({n}) BETWEEN 4 AND 100 AND len({words}) BETWEEN 2 AND 7 AND length(regexp_replace({n}, '[^\\p{{L}}]', '', 'g')) >= 3"
        f" AND NOT regexp_matches({low}, 'https?://|[<>]') AND len(list_filter({words}, lambda w: w IN {listed(R.SENTENCE_WORDS)})) < 2)"
    )


def clean_title(x: str) -> str:
    t = title(x)
    return f"({t} <> '' AND length({t}) <= 180 AND NOT {any_of(f'lower({t})', R.BLOCKED_PHRASES)} AND NOT regexp_matches(lower({t}), 'https?://') AND {any_of(f'lower({t})', R.ROLE_TERMS)})"


def email(x: str) -> str:
    return f"regexp_full_match({x}, {q('[' + R.EMAIL_CLASS + ']+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+')})"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def phone_cell(x: str) -> str:
    v = f"regexp_replace({clean(x)}, '(?i)\\b(?:ext\\.?|extension)\\s*', ' x', 'g')"
    v = f"trim(regexp_replace(regexp_replace({v}, '[^0-9+()xX.\\-\\s]', '', 'g'), '\\s+', ' ', 'g'))"
    return f"CASE WHEN length({digits(v)}) < 7 THEN '' ELSE {v} END"


def leadership(supplied: str, x: str) -> str:
    low = f"lower({title(x)})"
    return (
        f"CASE WHEN regexp_matches({low}, '\\b(?:{'|'.join(R.BOARD_ROLES)})\\b') OR regexp_full_match({low}, '\\s*(?:lead\\s+)?director\\s*') THEN 'Board'"
        f" WHEN regexp_matches({low}, '\\bchief\\s+(?:{R.CHIEF_ROLES})\\s+officer\\b|\\bmanaging\\s+director\\b') THEN 'CXO'"
        f" WHEN regexp_matches({low}, '\\b(?:{'|'.join(R.EXECUTIVE_ROLES)})\\b') THEN 'Executive Leadership' ELSE {case(key(supplied), R.SUPPLIED_TYPES, q('Unknown'))} END"
    )


def role(x: str, at: int) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({clean(x)}, {q('(?i)' + r[0])}) THEN {q(r[at])}" for r in R.ROLES) + " ELSE '' END"


def source_quality(method: str, url: str) -> str:
    u = strict_url(url)
    return f"({case(key(method), R.METHOD_BONUS, '10')} + CASE WHEN {u} <> '' THEN 15 ELSE 0 END + CASE WHEN {u} <> '' AND {host(f'({u})')} <> '' THEN 10 ELSE 0 END)"


def role_quality(t: str, kind: str) -> str:
    return f"least(CASE {kind} WHEN 'CXO' THEN 25 WHEN 'Board' THEN 20 WHEN 'Executive Leadership' THEN 20 ELSE 0 END" + "".join(f" + CASE WHEN contains(lower({t}), '{w}') THEN 10 ELSE 0 END" for w in ("chief", "officer", "managing director")) + ", 50)"


def quality(name: str, t: str, supplied: str, method: str, url: str, company: str) -> str:
    return f"least({source_quality(method, url)} + {role_quality(title(t), '(' + leadership(supplied, t) + ')')} + CASE WHEN {person_like(name)} THEN 10 ELSE 0 END + CASE WHEN {clean_title(t)} THEN 10 ELSE 0 END + CASE WHEN {clean(company)} <> '' THEN 5 ELSE 0 END, 100)"


def name_match(name: str, x: str) -> str:
    hits = f"len(list_filter({tokens(name)}, lambda t: contains({key(x)}, t)))"
    return f"CASE WHEN len({tokens(name)}) = 0 THEN 0 WHEN {hits} = len({tokens(name)}) THEN 70 WHEN {hits} >= 2 THEN 50 WHEN {hits} = 1 THEN 20 ELSE 0 END"


def path_score(x: str) -> str:
    p = f"lower({path(x)})"
    count = lambda terms: " + ".join(f"CASE WHEN contains({p}, '{t}') THEN 1 ELSE 0 END" for t in terms)
    return f"greatest(12 * ({count(R.PROFILE_TERMS)}) - 20 * ({count(R.IGNORED_TERMS)}), 0)"


def role_match(t: str, x: str) -> str:
    a, b = key(t), key(x)
    shared = " + ".join(f"CASE WHEN contains({a}, '{w}') AND contains({b}, '{w}') THEN 1 ELSE 0 END" for w in R.MATCH_TERMS)
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 WHEN contains({b}, {a}) THEN 35 ELSE least(8 * ({shared}), 25) END"


def resolve(base: str, ref: str) -> str:
    """Dot segments fold over a string; base is absolute."""
    tail = f"CASE WHEN {part(ref, 6)} = '' THEN '' ELSE '#' || {part(ref, 6)} END"
    folder = f"regexp_replace({part(base, 4)}, '[^/]+$', '')"
    full = f"CASE WHEN {part(ref, 4)} LIKE '/%' THEN {part(ref, 4)} ELSE CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || {part(ref, 4)} END"
    walk = f"list_reduce(string_split({full}, '/')[2:], lambda a, s: CASE WHEN s = '..' THEN regexp_replace(a, '/[^/]*$', '') WHEN s = '.' THEN a ELSE a || '/' || s END, '')"
    end = f"CASE WHEN regexp_matches({full}, '/\\.\\.?$') THEN '/' ELSE '' END"
    at = f"{scheme(base)} || '://' || {authority(base)}"
    return (
        f"CASE WHEN {ref} = '' THEN {base} WHEN {part(ref, 1)} <> '' THEN {ref} WHEN {authority(ref)} <> '' THEN {scheme(base)} || '://' || {authority(ref)} || {part(ref, 4)} || {asked(part(ref, 5))} || {tail}"
        f" WHEN {part(ref, 4)} = '' THEN {at} || {part(base, 4)} || CASE WHEN {part(ref, 5)} = '' THEN {asked(part(base, 5))} ELSE '?' || {part(ref, 5)} END || {tail}"
        f" ELSE {at} || {walk} || {end} || {asked(part(ref, 5))} || {tail} END"
    )


def crawl_url(x: str) -> str:
    f = f"regexp_replace({x}, '#.*$', '')"
    port = f"regexp_extract({authority(f)}, ':([^:@\\]]*)$', 1)"
    return f"CASE WHEN {x} = '' OR length({f}) > 2048 OR NOT {web(f)} OR {host(f)} = '' THEN '' ELSE {scheme(f)} || '://' || {host(f)} || CASE WHEN {port} = '' THEN '' ELSE ':' || {port} END || {or_root(path(f))} || {asked(part(f, 5))} END"


def page_type(url: str, anchor: str, home: str) -> str:
    lone = f"CASE WHEN len({segments(url)}) = 1 THEN replace(replace({terminal(url)}, '-', ' '), '_', ' ') ELSE '' END"
    out = f"CASE WHEN {homepage(url, home)} OR {excluded(url)} OR {terminal(url)} = '' OR {slug(url)} THEN 'other'"
    for table, k in ((R.PAGE_PATTERNS, terminal(url)), (R.ANCHOR_PATTERNS, key(anchor))):
        for kind, names in table.items():
            out += f" WHEN {k} IN {listed(names)} THEN {q(kind)}"
    return out + f" ELSE {case(lone, R.SINGLE_SEGMENTS, q('other'))} END"
