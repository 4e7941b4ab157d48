"""Packing: bounded-space best-fit into fixed windows.

A partition keeps a fixed number of open windows. A document's full windows are cut off first; its rest goes into
the open window that it fills best. When it fits none, the fullest window is emitted: its gap is filled from the piece's head
if the gap is worth a cut, and the piece's remainder goes on. At the partition's end the windows still open are merged, cutting at
window ends, and the last, partial one is cut into powers of two, which need no padding. Nothing is
shuffled and no window waits for another partition; only the windows' gaps and pieces' places are held.

Rows: a null text is an empty one (only its end id); repeated rows and ids are packed each on their own; other columns don't matter;
an empty table gives no rows; a text of any length is one row's encoding at a time.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .byte_bpe import byte_bpe
from .shared import text_or_empty

WINDOW, OPEN_WINDOWS, LEAST_CUT = 1024, 64, 32
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


class BoundedPacker:
    """Yields emitted windows as lists of (key, data) pieces; data is bytes of 4-byte ids."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, least_cut: int = LEAST_CUT):
        self.window, self.most, self.least_cut = window, open_windows, least_cut
        self.gaps: list[tuple[int, int]] = []  # (ids that still fit, window), ascending
        self.held: dict[int, list] = {}
        self.opened = 0

    def place(self, key, start: int, ids: memoryview) -> Iterator[list]:
        """A document's ids, from start on; pieces are (key, start, ids)."""
        size = self.window * 4
        while len(ids) >= size:
            yield [(key, start, ids[:size])]
            ids, start = ids[size:], start + self.window
        while n := len(ids) // 4:
            at = bisect_left(self.gaps, (n, -1))
            if at < len(self.gaps):
                gap, which = self.gaps.pop(at)
            elif len(self.gaps) < self.most:
                gap, which = self.window, self.opened
                self.opened += 1
                self.held[which] = []
            else:
                gap, which = self.gaps.pop(0)
                pieces = self.held.pop(which)
                if gap >= self.least_cut and n - gap >= self.least_cut:
                    pieces.append((key, start, ids[: gap * 4]))
                    ids, start = ids[gap * 4 :], start + gap
                yield pieces
                continue
            self.held[which].append((key, start, ids))
            if gap == n:
                yield self.held.pop(which)
            else:
                insort(self.gaps, (gap - n, which))
            return

    def finish(self) -> Iterator[list]:
        """Merge what is open, cutting at window ends; the last one is cut into powers of two."""
        pieces = [p for _, which in self.gaps for p in self.held[which]]
        total = sum(len(p[2]) // 4 for p in pieces)
        sizes = [self.window] * (total // self.window) + [1 << k for k in reversed(range((total % self.window).bit_length())) if total % self.window >> k & 1]
        pieces.reverse()
        for size in sizes:
            out, room = [], size
            while room:
                key, start, ids = pieces.pop()
                if len(ids) // 4 > room:
                    pieces.append((key, start + room, ids[room * 4 :]))
                    ids = ids[: room * 4]
                out.append((key, start, ids))
                room -= len(ids) // 4
            yield out
        self.gaps, self.held = [], {}


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text", window: int = WINDOW, open_windows: int = OPEN_WINDOWS, least_cut: int = LEAST_CUT) -> DataFrame:
    """A row per piece: its document, place and checksum there, and its sequence and place there."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, end = byte_bpe(tokenizer), BoundedPacker(window, open_windows, least_cut), end_id.to_bytes(4, "little")
        sequence, rows = TaskContext.get().partitionId() << 33, []

        def emitted(windows) -> None:
            nonlocal sequence
            for pieces in windows:
                offset, total = 0, sum(len(p[2]) // 4 for p in pieces)
                for (doc, tokens), start, ids in pieces:
                    n = len(ids) // 4
                    rows.append((doc, start, n, crc32(ids), tokens, sequence, offset, total))
                    offset += n
                sequence += 1

        def flushed() -> pa.RecordBatch:
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * len(names), names)
            rows.clear()
            return batch

        for batch in batches:
            for doc, coded in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1)), strict=True):
                ids = memoryview(b"".join((coded, end)))
                emitted(packer.place((doc, len(ids) // 4), 0, ids))
                if len(rows) >= 5000:
                    yield flushed()
        emitted(packer.finish())
        yield flushed()

    return docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(pack, SCHEMA)
