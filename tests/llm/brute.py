"""Plain versions of the operators' contracts, a document at a time."""

import hashlib
import math
import re
import zlib

import regex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def pii(text):
    spans = sorted((m.start(), n, m.end(), k) for n, (k, p) in enumerate(KINDS.items()) for m in p.finditer(text or "") if holds(k, m[0]))
    joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    return [sum(s[3] == k for s in spans) for k in KINDS], hashlib.sha256(joined.encode()).hexdigest(), joined


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows, at = [tuple(words[i : i + 3]) for i in range(len(words) - 2)], {}
    for i, w in enumerate(windows):
        at.setdefault(w, []).append(i)
    repeated = {i + d for v in at.values() if len(v) > 1 for i in v for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), n < 50 or 100 * len(repeated) > 50 * n)


def ascii_lower(text):
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def shingles(text, k=3):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset({tuple(words)} if len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)})


def near_components(docs, k=3, percent=85):
    """{doc_id: (set size, smallest reachable doc_id)}; docs: unique ids with texts."""
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posts = {}
    for d, s in sets.items():
        common = {}
        for x in s:
            for other in posts.setdefault(x, []):
                common[other] = common.get(other, 0) + 1
            posts[x].append(d)
        for other, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = root(d), root(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


LETTERS = regex.compile(r"\p{L}+")


def terms_of(text):
    return {w for w in LETTERS.findall(text.lower()) if len(w) >= 3}


def base_spans(text):
    return sorted((m.start(), n, m.end(), k, m[0]) for n, (k, p) in enumerate(KINDS.items()) for m in p.finditer(text) if holds(k, m[0]))


def sanitised(texts, window=64, z=1.645, generalise_bits=2.0, remove_bits=1.0):
    """[(spans as (start, stop, kind), clean text)] of each text: counts over distinct texts, the bound of p(e | t), marks."""
    near, held, blanked = {}, {}, {}
    for text in set(texts):
        spans, blank = base_spans(text), list(text)
        for a, _, b, *_ in spans:
            blank[a:b] = " " * (b - a)
        blank = blanked[text] = "".join(blank)
        for w in terms_of(blank):
            held[w] = held.get(w, 0) + 1
        for a, _, b, kind, value in spans:
            part = blank[max(a - window, 0) : b + window]
            if a > window:
                part = regex.sub(r"^\p{L}+", "", part)
            if b + window < len(blank):
                part = regex.sub(r"\p{L}+$", "", part)
            for w in terms_of(part):
                near.setdefault((w, kind, value), set()).add(text)
    left = {}
    for (w, kind, value), where in near.items():
        n = held[w]
        p = len(where) / n
        left[w, kind, value] = -math.log2((p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n))
    out = []
    for text in texts:
        listed = {}
        for (w, kind, value), where in near.items():
            if text in where and left[w, kind, value] <= generalise_bits:
                listed[w] = listed.get(w, False) or left[w, kind, value] <= remove_bits
        base = base_spans(text)
        own = [(m.start(), m.end(), "drop" if listed[m[0].lower()] else "term") for m in LETTERS.finditer(text) if m[0].lower() in listed]
        own = [s for s in own if not any(a < s[1] and s[0] < b for a, _, b, *_ in base)]
        marks = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "drop": ""}
        clean, at = "", 0
        for a, b, kind in sorted([(a, b, k) for a, _, b, k, _ in base] + own):
            if a >= at:
                clean += text[at:a] + marks[kind]
            at = max(at, b)
        out.append((own, clean + text[at:]))
    return out
