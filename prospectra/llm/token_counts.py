"""Token counts from flat token files that have no index.

``write_token_files`` stores texts as flat files of little-endian ids, an end-of-document id after each text and nothing
else; which document stands where is told beside them. ``count_tokens`` knows nothing but the files: it cuts them into blocks, searches every block for
the separator with one vectorised comparison, and stitches documents over block ends with a prefix scan over one small row per block
(a running maximum of the last separator's place, a running sum of the separators seen).

Rows: a null text counts as empty (a separator only); null ids and repeated rows stay, each with a count of its own; other columns don't matter; an empty
table gives no rows; a text of any length is written as one piece and counted over as many blocks as it fills.
Ids in a file after its last separator are a document without an end and are reported with ``closed`` false.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .byte_bpe import byte_bpe
from .shared import materialised, shared_dir, text_or_empty

#: Ids in a block, bytes of a file after which its writer starts another, and documents that one row beside the files tells of at most.
BLOCK_TOKENS, FILE_BYTES, TOLD = 1 << 20, 256 << 20, 10_000


def write_token_files(docs: DataFrame, tokenizer: str, separator: int, folder: str, dtype: str = "<u2", id: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write every row's ids and the separator to flat files in folder (any URI that pyarrow opens).

    A row for up to TOLD documents of a file: path, n_bytes that it holds with them, first_doc (the first one's number there) and their ids.
    An attempt writes under a name of its own and only the names that a finished task returns count, so a task that runs again does no harm.
    The separator must be an id that no text can produce: control strings within texts are encoded as ordinary text.
    """
    top = np.iinfo(np.dtype(dtype)).max

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        encoder = byte_bpe(tokenizer, special_as_text=True)
        end, out = np.array([separator], dtype).tobytes(), None
        name, written, first, told = "", 0, 0, []

        def beside() -> pa.RecordBatch:
            nonlocal first
            rows = [pa.array([name]), pa.array([written], pa.int64()), pa.array([first], pa.int64()), pa.array([told], pa.list_(pa.int64()))]
            first += len(told)
            told.clear()
            return pa.RecordBatch.from_arrays(rows, ["path", "n_bytes", "first_doc", "ids"])

        for batch in batches:
            for key, coded in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1)), strict=True):
                if out is None:
                    name, written, first = f"{base}/{uuid.uuid4().hex}.bin", 0, 0
                    out = store.open_output_stream(name)
                ids = np.frombuffer(coded, "<u4")
                if len(ids) and ids.max() > top:
                    raise ValueError(f"ids above {top} don't fit {dtype}")
                written += out.write(ids.astype(dtype).tobytes() + end)
                told.append(key)
                if written >= file_bytes:
                    out.close()
                    out = None
                if out is None or len(told) >= TOLD:
                    yield beside()
        if out is not None:
            out.close()
            if told:
                yield beside()

    return docs.select(F.col(id).cast("long").alias("id"), text_or_empty(text).alias("text")).mapInArrow(write, "path string, n_bytes long, first_doc long, ids array<long>")


def files_of(written: DataFrame) -> DataFrame:
    """A row per file: path and n_bytes."""
    return written.groupBy("path").agg(F.max("n_bytes").alias("n_bytes"))


def count_tokens(files: DataFrame, folder: str, separator: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row per document of the files (path, n_bytes): path, doc_no in the file, start and n_tokens in ids without the separator, closed."""
    width = np.dtype(dtype).itemsize

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, block, size in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                with store.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(size, block * block_tokens * width), dtype)
                ends = np.flatnonzero(ids == separator) + block * block_tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int64()), pa.array([len(ends)], pa.int64()), pa.array([int(ends[-1]) + 1 if len(ends) else None], pa.int64()), pa.array([block * block_tokens + len(ids)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    ["path", "block", "n_ends", "last_end", "stop", "ends"],
                )

    blocks = files.select("path", F.explode(F.sequence(F.lit(0), F.expr(f"greatest(n_bytes - 1, 0) div {block_tokens * width}"))).alias("block"), "n_bytes").select("path", F.col("block").cast("long"), F.least(F.lit(block_tokens * width), F.col("n_bytes") - F.col("block") * block_tokens * width).cast("long").alias("size"))
    found = materialised(blocks.repartition("path", "block").mapInArrow(scan, "path string, block long, n_ends long, last_end long, stop long, ends array<long>"), "separators")
    before = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = found.select("path", "block", F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("doc_base"), F.coalesce(F.max("last_end").over(before), F.lit(0)).alias("open_start"))
    ends = found.filter("n_ends > 0").join(carried, ["path", "block"])
    closed = ends.select("path", "doc_base", F.inline(F.arrays_zip(F.concat(F.array("open_start"), F.transform("ends", lambda x: x + 1)).alias("start"), F.col("ends").alias("end"), F.sequence(F.lit(0).cast("long"), F.col("n_ends")).alias("k")))).filter("end IS NOT NULL").select("path", (F.col("doc_base") + F.col("k")).alias("doc_no"), "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed"))
    tail = found.groupBy("path").agg(F.max("stop").alias("stop"), F.coalesce(F.max("last_end"), F.lit(0)).alias("start"), F.sum("n_ends").alias("doc_no")).filter("stop > start")
    return closed.unionByName(tail.select("path", "doc_no", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")))


def document_token_counts(docs: DataFrame, tokenizer: str, separator: int, dtype: str = "<u2", id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of docs: its id and n_tokens. Its flat files are written to the shared folder once, then scanned."""
    folder = shared_dir(docs.sparkSession, "tokens")
    written = materialised(write_token_files(docs, tokenizer, separator, folder, dtype, id, text), "token-files")
    counted = count_tokens(files_of(written), folder, separator, dtype).select("path", "doc_no", "n_tokens")
    named = written.select("path", "first_doc", F.posexplode("ids").alias("at", "id")).select("path", (F.col("first_doc") + F.col("at")).alias("doc_no"), "id")
    return named.join(counted, ["path", "doc_no"]).select(F.col("id").alias(id), "n_tokens")
