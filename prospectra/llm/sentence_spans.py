"""Substring dedup by sliding sentence spans.

A text is cut behind sentence marks and line ends. From every sentence on, the run of the ``span`` next ones is hashed, longer by
as many more as it takes to hold ``words`` words: three short sentences that many documents share (a greeting) are no passage, but are part of
the longer run that is one. Runs are joined over all documents, and the sentences that any non-first occurrence of a repeated run
covers are removed. The first occurrence is the one with the smallest id (then text hash, then place), and removal looks at the texts as they
came.

A passage may begin and end within a sentence. Where sentences are short, all but their ragged ends are whole sentences; sentences of more than LONG
words (lists, tables, texts without marks) are cut further, behind words that a fixed share of all words' digests choose, so that
the same words are cut the same way wherever they stand. A word stands between spaces; in scripts without spaces each letter is one.

Rows: null texts count as empty and stay null; rows repeated whole are one document and get the same result; texts that hold no run
are left alone; a text all of whose sentences repeat becomes empty; other columns pass through, and a column named n_removed is
replaced; null ids come first; an empty table gives an empty result; a text of any length is cut whole, batches are bounded by characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import materialised, text_or_empty

SPAN, WORDS, LONG = 3, 12, 16
#: A word whose MD5 digest begins with one of these hexadecimal digits ends a piece of a long sentence.
CHOSEN = "012"
MARKS = ".!?"
#: Scripts that are written without spaces (Thai to Tibetan, Burmese, Khmer, kana, Han) as a regular expression's class, and their sentence marks.
DENSE, DENSE_MARKS = "฀-࿿က-႟ក-៿ぁ-ヿ㐀-鿿豈-﫿", "。！？"
#: Text keys that are sent to every executor at most (8 bytes each); more are joined by shuffle.
BROADCAST_KEYS = 1_000_000
BLANK, _CUT, _BATCH, _CACHE = " \t\r\n", "\0", 1 << 20, 500_000
_SENTENCE = re.compile(f"(?<=\n)|(?<=[{MARKS}][ \t])|(?<=[{DENSE_MARKS}])")
_DENSE_LETTER = re.compile(f"[{DENSE}]")
_TOKEN = re.compile(f"[{BLANK}]*(?:[{DENSE}]|[^{BLANK}{DENSE}]+)[{BLANK}]*|[{BLANK}]+")
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class _Chosen(dict):
    def __missing__(self, token: str) -> bool:
        if len(self) >= _CACHE:
            self.clear()
        self[token] = found = md5(token.strip(BLANK).encode()).hexdigest()[0] in CHOSEN
        return found


_chosen = _Chosen()


def weight(piece: str, dense: bool) -> int:
    """How many words a piece without blanks around it has."""
    return piece.count(" ") + 1 + (len(_DENSE_LETTER.findall(piece)) if dense else 0)


def _shorter(sentence: str) -> list[str]:
    """The pieces of a long sentence."""
    out, begin, at = [], 0, 0
    for token in _TOKEN.findall(sentence):
        at += len(token)
        if _chosen[token]:
            out.append(sentence[begin:at])
            begin = at
    if begin < len(sentence):
        out.append(sentence[begin:])
    return out


def pieces(text: str) -> list[str]:
    """What a text is cut into; joined, it is the text."""
    dense = not text.isascii() and _DENSE_LETTER.search(text) is not None
    if dense or _CUT in text:
        sentences = _SENTENCE.split(text)
    else:
        marked = text.replace("\n", f"\n{_CUT}")
        for mark in MARKS:
            marked = marked.replace(f"{mark} ", f"{mark} {_CUT}").replace(f"{mark}\t", f"{mark}\t{_CUT}")
        sentences = marked.split(_CUT)
    out: list[str] = []
    for s in sentences:
        if (dense or s.count(" ") >= LONG) and weight(s.strip(BLANK), dense) > LONG:
            out += _shorter(s)
        elif s:
            out.append(s)
    return out


def filled(text: str) -> tuple[list[str], list[int]]:
    """The pieces of a text that aren't blank, without blanks around them, and how many words each has."""
    dense = not text.isascii() and _DENSE_LETTER.search(text) is not None
    own = list(filter(None, (p.strip(BLANK) for p in pieces(text))))
    return own, [p.count(" ") + 1 for p in own] if not dense else [weight(p, True) for p in own]


def run_ends(weights: np.ndarray, limits: np.ndarray, span: int, words: int) -> np.ndarray:
    """For each piece where its run ends (exclusive), beyond limits where there is none. limits: where its text's pieces end."""
    total = np.concatenate([[0], np.cumsum(weights)])
    return np.maximum(np.arange(len(weights)) + span, np.searchsorted(total, total[:-1] + words)).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _range_hashes(x: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """Hashes of x[start:stop], the same wherever a range lies: differences of a polynomial's running sum, moved back to its start."""
    powers = lambda b: np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(max(len(x) - 1, 0), b, _U)]))[: len(x)]
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(x * powers(base))])
    return _mixed((sums[stops] - sums[starts]) * powers(pow(base, -1, 1 << 64))[starts])


def _runs(batches: Iterator[pa.RecordBatch], span: int, words: int) -> Iterator[pa.RecordBatch]:
    """(_id, _key, _text) to (_id, _key, h, g, j): a row for each run, by two hashes, and the number of its first piece."""
    import xxhash

    hashed = xxhash.xxh64_intdigest
    for batch in batches:
        texts, begin, chars = batch.column(2).to_pylist(), 0, 0
        for end, text in enumerate(texts, 1):
            chars += len(text) + 1
            if chars < _BATCH and end < len(texts):
                continue
            hashes, weights, sizes = [], [], []
            for t in texts[begin:end]:
                own, heavy = filled(t)
                sizes.append(len(own))
                hashes += [hashed(p.encode()) for p in own]
                weights += heavy
            limits = np.repeat(np.cumsum(sizes), sizes)
            stops = run_ends(np.array(weights, np.int64), limits, span, words)
            starts = np.flatnonzero(stops <= limits)
            x = _mixed(np.array(hashes, _U) + _U(1))
            rows = pa.array(np.repeat(np.arange(begin, end), sizes)[starts], pa.int64())
            numbers = np.arange(len(x)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            h, g = (_range_hashes(x, starts, stops[starts], b).view(np.int64) for b in _BASES)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(h), pa.array(g.astype(np.int32)), pa.array(numbers[starts].astype(np.int32))], ["_id", "_key", "h", "g", "j"])
            begin, chars = end, 0


def cut_out(text: str, starts: list[int], span: int, words: int) -> tuple[str, int]:
    """The text without the runs that begin with these pieces, and how many pieces that were."""
    own, at = [], 0
    for p in pieces(text):
        if p.strip(BLANK):
            own.append((at, at + len(p)))
        at += len(p)
    weights = np.array(filled(text)[1], np.int64)
    stops = run_ends(weights, np.full(len(weights), len(weights)), span, words)
    kept, done, after, removed = [], 0, 0, 0
    for j in sorted(set(starts)):
        stop = int(stops[j])
        removed += stop - max(j, after)
        after = stop
        a, b = own[j][0], own[stop - 1][1]
        kept.append(text[done : max(a, done)])
        done = b
    return "".join(kept) + text[done:], removed


def remove_repeated_spans(docs: DataFrame, span: int = SPAN, words: int = WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with a shorter text where others said it first, and n_removed, the sentences (pieces) that went."""
    own = docs.drop("n_removed").withColumn("_key", F.xxhash64(text_or_empty(text)))
    head = f"_id {docs.schema[id].dataType.simpleString()}, _key long, h long, g int, j int"
    runs = own.select(F.col(id).alias("_id"), "_key", text_or_empty(text).alias("_text")).mapInArrow(lambda batches: _runs(batches, span, words), head)
    runs = materialised(runs, "runs")
    # most runs stand once: their hashes alone travel to tell which don't, and only the others go on with their places
    repeated = materialised(runs.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "repeated")
    again = materialised(runs.join(repeated.hint("shuffle_hash"), "h", "left_semi"), "again")
    place = F.struct("_id", "_key", "j")
    # written, so that a passage which many documents share can be dealt out over several tasks of the join
    first = materialised(again.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n"), "first")
    later = again.join(first.hint("shuffle_hash"), ["h", "g"]).filter(place != F.col("first"))
    lost = materialised(later.groupBy("_id", "_key").agg(F.collect_set("j").alias("_starts")), "lost")  # a document's own runs at most

    # only documents that lose something travel; the others are told by their keys
    keys = lost.select("_key").distinct()
    few = keys.count() <= BROADCAST_KEYS
    keyed = own.join((F.broadcast(keys) if few else keys).withColumn("_hit", F.lit(True)), "_key", "left")
    shorter = F.udf(lambda t, starts: cut_out(t, starts, span, words) if starts else (t, 0), "struct<text:string,n:bigint>", useArrow=True)
    other = lost.withColumnsRenamed({"_id": "_other_id", "_key": "_other_key"})
    touched = keyed.filter("_hit").join(other, F.col(id).eqNullSafe(F.col("_other_id")) & (F.col("_key") == F.col("_other_key")), "left")
    changed = touched.withColumn("_new", shorter(text, "_starts")).drop("_other_id", "_other_key", "_starts")
    result = changed.unionByName(keyed.filter("_hit IS NULL").withColumn("_new", F.struct(F.col(text).alias("text"), F.lit(0).cast("long").alias("n"))))
    return result.withColumn("n_removed", F.col("_new.n")).withColumn(text, F.col("_new.text")).select(*(c for c in docs.columns if c != "n_removed"), "n_removed")
