"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides.

``measure`` computes counts of each whole text; ``judge`` turns them into votes (1 good, -1 bad, 0 abstains), counts the distinct
vote patterns over all documents (at most 3 to the number of rules), estimates each rule's accuracy on good and on bad documents and the
share of good documents by expectation-maximisation over those counts (first posteriors: by the number of bad votes), and keeps documents whose posterior reaches ``keep_at``. All of it
is DataFrame and SQL expressions; the estimate runs as one fold over the pattern table's single row.

Rows: a null text counts as empty and fails; repeated rows get equal results; other columns pass through, and a column named as
one of the results is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import materialised, text_or_empty

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_WHITE = "[ \\t\\n\\x0B\\f\\r]+"
#: name -> (bad, good) as SQL over the measures; a rule abstains where neither holds.
RULES = {
    "length": ("n_words < 50", "n_words >= 100"),
    "word_length": ("word_chars < 2.5D * n_words OR word_chars > 12D * n_words", "word_chars BETWEEN 3D * n_words AND 9D * n_words"),
    "symbols": ("n_symbols > 0.1D * n_words", "n_symbols <= 0.01D * n_words"),
    "symbol_share": ("n_symbols > 0.03D * word_chars", "n_symbols <= 0.005D * word_chars"),
    "repeated_lines": ("n_dup_lines > 0.3D * n_lines", "n_dup_lines <= 0.05D * n_lines"),
    "repeated_words": ("n_repeat_words > 0.2D * n_words", "n_repeat_words <= 0.05D * n_words"),
    "capitals": ("n_capitals > 0.3D * word_chars", "n_capitals <= 0.1D * word_chars"),
    "sentences": ("n_marks < 0.01D * n_words", "n_marks BETWEEN 0.03D * n_words AND 0.5D * n_words"),
}
#: Rounds of the estimate, and what a rule's rates are drawn to, with the weight of two documents.
ITERATIONS, FIRST_GOOD, FIRST_BAD = 25, 0.8, 0.5


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs and, as longs, the counts that the rules use."""
    t = text_or_empty(text)
    trimmed = F.regexp_replace(t, f"^{_WHITE}|{_WHITE}\\z", "")
    out = docs.drop(*MEASURES, "n_lines", "n_capitals", "n_marks").withColumn("_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WHITE)))
    words = F.col("_words")
    windows = F.when(F.size(words) >= 3, F.transform(F.slice(F.arrays_zip(words.alias("a"), F.slice(words, 2, F.size(words)).alias("b"), F.slice(words, 3, F.size(words)).alias("c")), 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w: F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    out = out.select("*", windows.alias("_windows"), lines.alias("_lines"))
    ordered = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_ordered", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered))
    s, n = F.col("_ordered"), F.size("_ordered")
    none = F.array(F.lit(None).cast("bigint"))
    # a window is found again if its neighbour in hash order is equal
    twice = F.filter(F.arrays_zip(s["i"].alias("i"), s["h"].alias("h"), F.concat(none, s["h"]).alias("p"), F.concat(F.slice(s["h"], 2, n), none).alias("q")), lambda x: x["i"].isNotNull() & (x["h"].eqNullSafe(x["p"]) | x["h"].eqNullSafe(x["q"])))
    out = out.withColumn("_again", F.when(s.isNotNull(), F.sort_array(twice["i"])))
    again = F.col("_again")
    covered = F.aggregate(F.zip_with(again, F.slice(again, 2, F.size(again)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("_lines"),
        "n_capitals": F.length(t) - F.length(F.regexp_replace(t, "[A-ZÀ-ÖØ-Þ]+", "")),
        "n_marks": F.length(t) - F.length(F.regexp_replace(t, "[.!?]+", "")),
    }
    return out.select(*(c for c in docs.columns if c not in counts), *(c.cast("long").alias(name) for name, c in counts.items()))


def _votes() -> Column:
    return F.array(*(F.expr(f"CAST(CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS INT)") for bad, good in RULES.values()))


def pattern_posteriors(voted: DataFrame, votes: str = "votes") -> DataFrame:
    """Distinct vote patterns with the posterior probability that a document with them is good."""
    rules = len(RULES) - 1
    # P(votes good | good) is g, P(votes bad | bad) is b, both given that the rule votes; b >= 1 - g, so no vote counts against what it says
    weigh = "CASE v WHEN 1 THEN ln(a.g / (1D - a.b)) WHEN -1 THEN ln((1D - a.g) / a.b) ELSE 0D END"
    posterior = f"transform(pats, q -> 1D / (1D + exp(-(ln(m.prior / (1D - m.prior)) + aggregate(zip_with(q.v, m.acc, (v, a) -> {weigh}), 0D, (s, x) -> s + x)))))"
    total = lambda value: f"aggregate(zip_with(pats, post, (q, p) -> q.n * {value}), 0D, (s, x) -> s + x)"
    rate = lambda first, hits, votes: f"least(0.99D, greatest(0.01D, ({2 * first}D + {total(hits)}) / (2D + {total(votes)})))"
    good = rate(FIRST_GOOD, "IF(q.v[r] = 1, p, 0D)", "IF(q.v[r] = 0, 0D, p)")
    bad = rate(FIRST_BAD, "IF(q.v[r] = -1, 1D - p, 0D)", "IF(q.v[r] = 0, 0D, 1D - p)")
    prior = f"least(0.95D, greatest(0.05D, (1D + {total('p')}) / (2D + {total('1D')})))"
    rates = f"transform(sequence(0, {rules}), r -> transform(array(named_struct('g', {good}, 'b', {bad})), a -> named_struct('g', a.g, 'b', greatest(a.b, 1D - a.g)))[0])"
    step = f"transform(array(named_struct('prior', {prior}, 'acc', {rates})), m -> {posterior})[0]"
    start = "transform(pats, q -> 1D / (1D + exp(2D * size(filter(q.v, v -> v = -1)) - 2D)))"
    table = voted.groupBy(F.col(votes).alias("v")).agg(F.count("*").cast("double").alias("n")).agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("pats"))
    estimated = F.expr(f"aggregate(sequence(1, {ITERATIONS}), {start}, (post, i) -> {step})").alias("post")
    return table.select("pats", estimated).select(F.explode(F.arrays_zip(F.col("pats.v").alias("v"), F.col("post").alias("posterior"))).alias("x")).select(F.col("x.v").alias(votes), "x.posterior")


def judge(measured: DataFrame, keep_at: float = 0.25) -> DataFrame:
    """measured rows with votes, posterior, base_failed and kept; written to the shared folder once, as both the estimate and the verdict read them."""
    voted = materialised(measured.drop("votes", "posterior", "base_failed", "kept").withColumn("votes", _votes()), "votes")
    table = pattern_posteriors(voted)  # 3 ** len(RULES) rows at most
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.join(F.broadcast(table), "votes").withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("posterior") >= keep_at))
