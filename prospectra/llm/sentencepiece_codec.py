"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

An agenda of adjacent symbol pairs is ordered by the merged piece's score, then by place, and merged from its top; what stays unknown falls
back to bytes. A batch's short segments share one agenda: a matrix with a row of pair ranks for each segment, whose least, leftmost entries
are merged in all rows at once. Longer segments and whole normalised texts have an agenda of their own, a heap.

No piece of a usual vocabulary holds a word mark behind another character, nor a line feed, so merges never cross those places and texts are
encoded by segments that a bounded cache keeps as packed ids. That, and a normaliser that leaves texts as they are but for the
leading mark, is verified when a model is loaded; with any other model whole texts as the library normalises them go through the heap.
Either way every distinct text of a batch is compared, whole, with the ``sentencepiece`` library's ids; a difference stops the job.
Decoding is the library's.

Rows: a null text counts as empty (no ids, decoded empty); repeated rows get equal results; other columns don't matter; an empty
table gives no rows. A text of any length is encoded whole, one at a time where it fills a batch of BATCH_CHARS.
Lone surrogates can't occur in Spark's UTF-8 strings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import text_or_empty

#: Segments that a worker's cache keeps before it starts again, characters of a batch, and the longest segment that shares a matrix.
MARK, CACHE_SEGMENTS, BATCH_CHARS, SHORT = "▁", 1_000_000, 1 << 20, 24
_SEGMENTS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
_STRANGE = re.compile("[\x00-\x08\x0b-\x1f\x7f]")
_NEVER = np.uint32(0xFFFFFFFF)
#: Texts whose normal form tells whether a model's normaliser only adds the leading mark and turns spaces into marks.
_PROBES = ("a b", " a", "a  b ", "a\nb", "\n a", "é è ﬁ ² ½ Å", "日本　語 かが", "x▁y", "🙂 a\t b", "a b ​", "ＡＢ é")


class _Pairs:
    """An open hash table from two symbols to the merged piece's rank and symbol; looked up by arrays."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks, self.merged = np.zeros(1 << bits, np.uint64), np.full(1 << bits, _NEVER), np.zeros(1 << bits, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at[left]] == 0
            _, first = np.unique(at[left[free]], return_index=True)
            put = left[free][first]
            self.keys[at[put]], self.ranks[at[put]], self.merged[at[put]] = keys[put], ranks[put], merged[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask
        self.longest = 1
        wrong = self.keys[self._slot(keys)] != keys
        while wrong.any():
            wrong = wrong & (self.keys[(self._slot(keys) + self.longest) & self.mask] != keys)
            self.longest += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of each pair; the rank is _NEVER where no piece results."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self._slot(keys)
        for _ in range(self.longest - 1):
            miss = (self.keys[at] != keys) & (self.keys[at] != 0)
            if not miss.any():
                break
            at = np.where(miss, (at + 1) & self.mask, at)
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], _NEVER), self.merged[at]


class MergeCodec:
    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        plain = [i for i in range(size) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        if any(lib.is_unused(i) for i in range(size)):
            raise ValueError("a vocabulary with unused pieces is resegmented by rules of its own")
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.scores = {piece: -lib.get_score(i) for piece, i in self.ids.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = lib.unk_id()
        self.fallback = all(lib.is_byte(i) for i in self.bytes)
        apart = not any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.by_segment = apart and all(lib.normalize(t) == self._marked(t) for t in _PROBES)
        self.packed: dict[str, bytes] = {}
        self.decimal = [str(i) for i in range(size)]
        self._symbols()

    @staticmethod
    def _marked(text: str) -> str:
        return (MARK + text).replace(" ", MARK) if text else ""

    def _symbols(self) -> None:
        """A number for every character and piece, 0 for none; and what each pair of them merges into."""
        self.symbols = {s: n for n, s in enumerate(sorted({c for p in self.ids for c in p} | set(self.ids)), 1)}
        order = {score: rank for rank, score in enumerate(sorted(set(self.scores.values())))}
        found = [(self.symbols[p[:k]], self.symbols[p[k:]], order[self.scores[p]], self.symbols[p]) for p in self.ids for k in range(1, len(p)) if p[:k] in self.symbols and p[k:] in self.symbols]
        left, right, ranks, merged = (np.array(x) for x in zip(*found, strict=True))
        self.pairs = _Pairs((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64), ranks.astype(np.uint32), merged.astype(np.int32))
        self.of_symbol = {n: s for s, n in self.symbols.items()}
        self.of_point = np.zeros(0x110000, np.int32)
        self.id_of, self.single = np.zeros(len(self.symbols) + 1, "<i4"), np.ones(len(self.symbols) + 1, bool)
        for s, n in self.symbols.items():
            if len(s) == 1:
                self.of_point[ord(s)] = n
            if s in self.ids:
                self.id_of[n] = self.ids[s]
            else:
                self.single[n] = False

    def _own(self, symbol: str) -> bytes:
        """Ids of a symbol that merges no further."""
        if (i := self.ids.get(symbol)) is not None:
            ids = [i]
        else:
            ids = [self.bytes[b] for b in symbol.encode()] if self.fallback else [self.unknown]
        return np.array(ids, "<i4").tobytes()

    def encode_symbols(self, text: str) -> list[int]:
        """Ids of a normalised text by an agenda of its own, a heap of (score, place, length); merged symbols leave an empty string behind."""
        symbols, scores, n = list(text), self.scores, len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(scores[p], i, 2) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in scores]
        heapify(agenda)
        while agenda:
            _, left, length = heappop(agenda)
            head = symbols[left]
            right = after[left]
            # a pair whose symbols merged with others since then has another length
            if not head or right >= n or len(head) + len(symbols[right]) != length:
                continue
            symbols[left] = merged = head + symbols[right]
            symbols[right] = ""
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                if (p := merged + symbols[following]) in scores:
                    heappush(agenda, (scores[p], left, len(p)))
            if (previous := before[left]) >= 0 and (p := symbols[previous] + merged) in scores:
                heappush(agenda, (scores[p], previous, len(p)))
        return np.frombuffer(b"".join(map(self._own, filter(None, symbols))), "<i4").tolist()

    def _encode_short(self, segments: list[str]) -> None:
        """Segments of SHORT characters at most, by length, by one agenda, into the cache."""
        lengths = np.array([len(x) for x in segments])
        width = int(lengths[-1])
        points = np.frombuffer("".join(segments).encode("utf-32-le"), "<u4").astype(np.int64)
        numbers = self.of_point[points]
        rows = np.zeros((len(segments), width), np.int32)
        # a letter that no piece holds merges with nothing; it is kept as a negative number
        rows[np.arange(width) < lengths[:, None]] = np.where(numbers > 0, numbers, -1 - points)
        ranks, merged = self.pairs.find(np.maximum(rows[:, :-1], 0), np.maximum(rows[:, 1:], 0))
        at, column = np.arange(len(segments)), np.arange(width)
        final = rows.copy()
        while ranks.size:
            top = ranks.argmin(axis=1)  # the leftmost of equals
            going = ranks[np.arange(len(ranks)), top] != _NEVER
            if not going.all():
                final[at[~going], : rows.shape[1]] = rows[~going]
                final[at[~going], rows.shape[1] :] = 0
                at, rows, ranks, merged, top = at[going], rows[going], ranks[going], merged[going], top[going]
            if not len(at):
                break
            own = np.arange(len(at))
            rows[own, top] = merged[own, top]
            # what stands behind the merged pair moves up by one
            source = column[: rows.shape[1]] + (column[: rows.shape[1]] > top[:, None])
            rows = np.take_along_axis(np.pad(rows, ((0, 0), (0, 1))), source, axis=1)[:, :-1]
            source = column[: ranks.shape[1]] + (column[: ranks.shape[1]] >= top[:, None])
            ranks = np.take_along_axis(np.pad(ranks, ((0, 0), (0, 1)), constant_values=_NEVER), source, axis=1)[:, :-1]
            merged = np.take_along_axis(np.pad(merged, ((0, 0), (0, 1))), source, axis=1)[:, :-1]
            if not ranks.shape[1]:
                break
            for where, ok in ((top - 1, top > 0), (top, top < ranks.shape[1])):
                r, c = own[ok], where[ok]
                ranks[r, c], merged[r, c] = self.pairs.find(np.maximum(rows[r, c], 0), np.maximum(rows[r, c + 1], 0))
        if len(at):
            final[at, : rows.shape[1]] = rows
            final[at, rows.shape[1] :] = 0
        plain = (self.single[np.maximum(final, 0)] & (final >= 0)).all(axis=1)
        kept = final[plain]
        ids, stops = self.id_of[kept[kept > 0]].tobytes(), (4 * np.cumsum((kept > 0).sum(axis=1))).tolist()
        ends = iter(stops)
        start, packed = 0, self.packed
        for segment, ok, symbols in zip(segments, plain.tolist(), final, strict=True):
            if ok:
                stop = next(ends)
                packed[segment] = ids[start:stop]
                start = stop
            else:
                packed[segment] = b"".join(self._own(chr(-1 - n) if n < 0 else self.of_symbol[n]) for n in symbols.tolist() if n)

    def _segments(self, text: str) -> list[str]:
        if "  " in text or MARK in text or text[0] == " " or "\0" in text:
            return _SEGMENTS.findall(self._marked(text))
        # no run of marks: cuts stand before every mark and around line feeds
        return list(filter(None, (MARK + text).replace(" ", "\0" + MARK).replace("\n", "\0\n\0").split("\0")))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        out: list[bytes] = [b""] * len(texts)
        cut: dict[int, list[str]] = {}
        for n, text in enumerate(texts):
            if text and self.by_segment and not _STRANGE.search(text):
                cut[n] = self._segments(text)
            elif text:  # the library's normaliser has its own view of control characters
                out[n] = np.array(self.encode_symbols(self.library.normalize(text)), "<i4").tobytes()
        if len(self.packed) >= CACHE_SEGMENTS:
            self.packed.clear()
        get, missing = self.packed.get, set()
        found = {n: list(map(get, segments)) for n, segments in cut.items()}
        for n, parts in found.items():
            if None in parts:
                missing.update(s for s, p in zip(cut[n], parts, strict=True) if p is None)
        short = sorted((s for s in missing if len(s) <= SHORT), key=len)
        for at in range(0, len(short), 4096):
            self._encode_short(short[at : at + 4096])
        long = [s for s in missing if len(s) > SHORT]
        self.packed |= {s: np.array(self.encode_symbols(s), "<i4").tobytes() for s in long}
        for n, parts in found.items():
            out[n] = b"".join([get(s) if p is None else p for s, p in zip(cut[n], parts, strict=True)] if None in parts else parts)
        for s in long:  # the cache's bound counts segments, so none of them may be large
            if len(s) > 4 * SHORT:
                del self.packed[s]
        return out

    def checked(self, texts: list[str]) -> list[bytes]:
        """encode, each result compared with the library's."""
        coded = self.encode(texts)
        for text, ids, other in zip(texts, coded, self.library.encode_as_numpy(texts, num_threads=1), strict=True):
            if ids != other.astype("<i4", copy=False).tobytes():
                raise ValueError(f"the agenda and the library differ on {text[:200]!r}")
        return coded


@cache
def codec(path: str) -> MergeCodec:
    return MergeCodec(path)


def encode_and_decode(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of docs: id, ids, ids_text (decimal, joined by commas), decoded."""
    return _mapped(docs, model, id, text, "ids array<int>, ids_text string, decoded string", lambda ids, joined, decoded: (ids, joined, decoded))


def codec_digests(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of docs: id, n_tokens, ids_sha256, decoded_sha256."""
    digest = lambda ids, joined, decoded: (len(ids), sha256(joined.encode()).hexdigest(), sha256(decoded.encode()).hexdigest())
    return _mapped(docs, model, id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest)


def _mapped(docs: DataFrame, model: str, id: str, text: str, columns: str, row) -> DataFrame:
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = [{"array<int>": pa.list_(pa.int32()), "string": pa.string(), "long": pa.int64()}[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            at = 0
            while at < len(batch):
                texts, chars, start = [], 0, at
                while at < len(batch) and (chars < BATCH_CHARS or at == start):
                    texts.append(batch.column(1)[at].as_py())
                    chars += len(texts[-1])
                    at += 1
                distinct = list(dict.fromkeys(texts))  # copies are encoded once
                results = {}
                for t, packed in zip(distinct, own.checked(distinct), strict=True):
                    ids = np.frombuffer(packed, "<i4").tolist()
                    results[t] = row(ids, ",".join(map(own.decimal.__getitem__, ids)), own.library.decode(ids) if ids else "")
                rows = zip(*(results[t] for t in texts), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *(pa.array(c, k) for c, k in zip(rows, kinds, strict=True))], [id, *names])

    return docs.select(F.col(id).cast("long").alias(id), text_or_empty(text).alias("text")).mapInArrow(run, f"`{id}` long, {columns}")
