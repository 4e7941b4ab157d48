"""Personal data: patterns find it, and information theory finds the terms that give it away.

``find_base`` finds e-mail addresses, IP addresses, payment cards and phone numbers. Each different value is a protected entity e.
``disclosing_terms`` estimates from all documents how strongly a term t reveals e: of the n(t) different texts that hold t, n(t, e) hold it
within ``WINDOW`` code points of e. PMI(t; e) = log2 p(e | t) / p(e) reaches the entity's whole information content IC(e) = -log2 p(e) where
p(e | t) is 1, so IC(e) - PMI(t; e) = -log2 p(e | t) bits are what a reader who knows t still lacks, at every corpus size. p(e | t) counts
by its lower confidence bound (Wilson, ``CONFIDENCE`` standard errors), so a few texts are weaker evidence than many. A term that
leaves ``generalise_bits`` or less becomes a class mark, with ``remove_bits`` or less it goes, wherever the text that holds it beside e
has it. Copies of one text count once. Everything is DataFrame and SQL expressions.

Rows: a null text counts as empty; repeated rows and ids get results of their own; other columns pass through (result columns of the same
name are replaced); an empty table gives an empty result; texts of any length are searched whole, with patterns that never scan a run again.
Spans are in code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import materialised, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
#: A run of a class can only match from its start or where the last match ended: every other start would fail the same way, only later.
_FROM = lambda c: f"(?:\\G|(?<![{c}]))"
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": f"{_FROM(_LOCAL)}[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": f"{_FROM('0-9')}[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: What a text must hold before its pattern is tried.
_HINTS = {"email": "@", "ip": ".", "phone": "+"}
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "drop": ""}
RESULTS = ["n_email", "n_ip", "n_card", "n_phone", "n_term", "base_spans", "term_spans", "clean_text"]
_SPANS = "array<struct<start:bigint,stop:bigint,kind:string,value:string>>"
_BLOCK = 256
#: Code points on either side of a value that are its surroundings, and standard errors of the bound (95 % one-sided).
WINDOW, CONFIDENCE = 64, 1.645
#: Hashes that are sent to every executor at most (8 bytes each); more are joined by shuffle.
BROADCAST_HASHES = 1_000_000


def _bind(value: Column, body) -> Column:
    """A name for a value within one expression: evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_totals(lengths: Column) -> Column:
    """Sums of all earlier elements, block by block, so that a long array isn't copied once for each element."""
    scan = lambda xs: F.aggregate(xs, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    blocks = _bind(lengths, lambda xs: F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(_BLOCK)), lambda i: F.slice(xs, i, F.lit(_BLOCK))))
    inner = F.transform(blocks, scan)
    return _bind(inner, lambda cs: F.flatten(F.zip_with(cs, F.slice(scan(F.transform(cs, lambda c: F.element_at(c, -1))), F.lit(1), F.size(cs)), lambda c, b: F.transform(F.slice(c, F.lit(1), F.size(c) - 1), lambda x: x + b))))


def located(text: Column, pattern: Column | str, kind: str, hint: Column) -> Column:
    """Leftmost non-overlapping matches with places: what split leaves between them gives the distances."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.when(hint, F.regexp_extract_all(text, p, F.lit(0)))
    gaps = lambda: F.split(text, p, -1)
    pairs = lambda ms: F.slice(F.arrays_zip(gaps().alias("g"), ms.alias("m")), F.lit(1), F.size(ms))

    def placed(zs: Column) -> Column:
        before = running_totals(F.transform(zs, lambda z: (F.length(z["g"]) + F.length(z["m"])).cast("long")))
        return F.zip_with(zs, before, lambda z, b: F.struct((b + F.length(z["g"])).alias("start"), (b + F.length(z["g"]) + F.length(z["m"])).alias("stop"), F.lit(kind).alias("kind"), z["m"].alias("value")))

    return _bind(found, lambda ms: F.when(F.size(ms) > 0, _bind(pairs(ms), placed)).otherwise(F.array().cast(_SPANS)))


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, "\\."), lambda p: _bind(F.regexp_replace(p, "^0+(?=.)", ""), lambda q: (F.length(q) <= 3) & (F.substring(q, 1, 3).cast("int") <= 255)))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "card":
        doubled = lambda d, k: F.when(k % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))
        total = lambda ds: F.aggregate(F.transform(F.reverse(F.filter(F.split(ds, ""), lambda x: x != "")), lambda d, k: doubled(d.cast("int"), k)), F.lit(0), lambda a, x: a + x)
        return _bind(digits, lambda ds: F.when(F.length(ds).between(14, 19), total(ds) % 10 == 0).otherwise(F.lit(False)))
    return F.lit(True)


def _keeper(kind: str):
    return lambda s: _holds(kind, s["value"])


def find_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with base_spans (by start, then kind as listed) and a count for each kind."""
    out = docs.drop(*RESULTS).withColumn("_text", text_or_empty(text))
    t = F.col("_text")
    for kind in KINDS:
        hint = t.contains(_HINTS[kind]) if kind in _HINTS else t.rlike("[0-9]")
        out = out.withColumn(f"_{kind}", F.filter(F.coalesce(located(t, PATTERNS[kind], kind, hint), F.array().cast(_SPANS)), _keeper(kind)))
    order = F.create_map(*(F.lit(x) for n, k in enumerate(KINDS) for x in (k, n)))
    spans = F.transform(F.sort_array(F.transform(F.concat(*(f"_{k}" for k in KINDS)), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["value"].alias("value")))), lambda s: F.struct(s["start"], s["stop"], s["kind"], s["value"]))
    return out.withColumns({f"n_{k}": F.size(f"_{k}").cast("long") for k in KINDS} | {"base_spans": spans}).drop(*(f"_{k}" for k in KINDS))


def _replaced(text: Column, spans: Column, mark) -> Column:
    """text with mark(span) in place of each span; spans by start, those within others go with them."""
    between = lambda a, s: F.substring(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int"))
    over = lambda a, s: F.struct(F.greatest(a["at"], s["stop"]).alias("at"), a["out"].alias("out"))
    whole = lambda a, s: F.struct(s["stop"].alias("at"), F.concat(a["out"], between(a, s), mark(s)).alias("out"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda a: F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, F.length(text)))
    return F.aggregate(spans, start, lambda a, s: F.when(s["start"] < a["at"], over(a, s)).otherwise(whole(a, s)), rest)


def _words(text: Column) -> Column:
    """Distinct lower-case words of three letters or more."""
    return F.filter(F.array_distinct(F.split(F.lower(text), "[^\\p{L}]+")), lambda w: F.length(w) >= 3)


def surroundings(found: DataFrame) -> DataFrame:
    """(_row, _key, entity, term) for the whole words within WINDOW code points of a value; entity is a hash of kind and value.

    Values themselves are blank there. found: written rows with _row, _key, _text and base_spans.
    """
    blank = lambda s: F.repeat(F.lit(" "), (s["stop"] - s["start"]).cast("int"))
    bearing = found.filter(F.size("base_spans") > 0).select("_row", "_key", "base_spans", _replaced(F.col("_text"), F.col("base_spans"), blank).alias("_blanked"))
    # a value overlapped by another is as long as what was blanked before it, so places hold
    near = bearing.select("_row", "_key", "_blanked", F.explode("base_spans").alias("s"))
    begin = F.greatest(F.col("s.start") - WINDOW, F.lit(0)).cast("int")
    around = F.substring("_blanked", begin + 1, (F.col("s.stop") - begin).cast("int") + WINDOW)
    whole = F.when(begin > 0, F.regexp_replace(around, "^\\p{L}+", "")).otherwise(around)
    whole = F.when(F.col("s.stop") + WINDOW < F.length("_blanked"), F.regexp_replace(whole, "\\p{L}+$", "")).otherwise(whole)
    rows = near.select("_row", "_key", F.xxhash64("s.kind", "s.value").alias("entity"), F.explode(_words(whole)).alias("term"))
    return rows.withColumn("term_hash", F.xxhash64("term")).distinct()


def disclosing_terms(found: DataFrame, near: DataFrame, generalise_bits: float, remove_bits: float) -> DataFrame:
    """(term_hash, entity, removed) of terms that leave a reader generalise_bits at most. near: as surroundings gives it."""
    copies = found.groupBy("_key").agg(F.count("*").alias("times"), F.min("_row").alias("first")).filter("times > 1")
    few = lambda keys: F.broadcast(keys) if keys.count() <= BROADCAST_HASHES else keys
    again = materialised(found.select("_row", "_key").join(copies, "_key").filter("_row <> first").select("_row"), "copies")
    again = few(again)
    joint = near.join(again, "_row", "left_anti").groupBy("term_hash", "entity").agg(F.count("*").alias("n_te"))
    asked = few(materialised(joint.select("term_hash").distinct(), "terms"))
    blank = lambda s: F.repeat(F.lit(" "), (s["stop"] - s["start"]).cast("int"))
    words = F.when(F.size("base_spans") > 0, _words(_replaced(F.col("_text"), F.col("base_spans"), blank))).otherwise(_words(F.col("_text")))
    said = found.join(again, "_row", "left_anti").select(F.explode(words).alias("term")).select(F.xxhash64("term").alias("term_hash"))
    often = said.join(asked, "term_hash", "left_semi").groupBy("term_hash").agg(F.count("*").alias("n_t"))
    n, p, z = F.col("n_t"), F.col("n_te") / F.col("n_t"), CONFIDENCE
    bound = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    strong = joint.join(often, "term_hash").withColumn("left", -F.log2(F.greatest(bound, F.lit(1e-300))))
    return strong.filter(F.col("left") <= generalise_bits).select("term_hash", "entity", (F.col("left") <= remove_bits).alias("removed"))


def sanitise(docs: DataFrame, text: str = "text", generalise_bits: float = 2.0, remove_bits: float = 1.0) -> DataFrame:
    """docs with base_spans, term_spans, the counts and clean_text."""
    base = find_base(docs, text).withColumns({"_key": F.xxhash64("_text"), "_row": F.monotonically_increasing_id()})
    found = materialised(base, "personal-data")  # the patterns run once, and rows have numbers from here on
    near = materialised(surroundings(found), "surroundings")
    terms = disclosing_terms(found, near, generalise_bits, remove_bits)
    listed = near.join(terms, ["term_hash", "entity"]).groupBy("_row", "term").agg(F.max("removed").alias("removed"))
    listed = listed.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("term", "removed"))).alias("_listed"))  # words beside a document's own values
    marked = found.filter(F.size("base_spans") > 0).join(listed, "_row", "left")
    words = lambda removed: F.filter("_listed", lambda x: x["removed"] == removed)["term"]
    pattern = lambda removed: F.concat(F.lit("(?iu)(?<!\\p{L})(?:"), F.array_join(words(removed), "|"), F.lit(")(?!\\p{L})"))
    spans = [located(F.col("_text"), pattern(removed), kind, F.size(words(removed)) > 0) for removed, kind in ((False, "term"), (True, "drop"))]
    clear = lambda s: ~F.exists("base_spans", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    none = F.array().cast(_SPANS)
    own = F.when(F.col("_listed").isNull(), none).otherwise(F.sort_array(F.filter(F.concat(*(F.coalesce(s, none) for s in spans)), clear)))
    marked = marked.withColumn("term_spans", own).drop("_listed")
    mark = F.create_map(*(F.lit(x) for pair in MARKS.items() for x in pair))
    clean = _replaced(F.col("_text"), F.sort_array(F.concat("base_spans", "term_spans")), lambda s: mark[s["kind"]])
    plain = found.filter(F.size("base_spans") == 0).withColumns({"term_spans": none, "clean_text": F.col("_text")})
    return marked.withColumn("clean_text", clean).unionByName(plain).withColumn("n_term", F.size("term_spans").cast("long")).drop("_text", "_key", "_row")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.when(s["kind"] == "drop", "term").otherwise(s["kind"]), s["start"], s["stop"])), ",")
