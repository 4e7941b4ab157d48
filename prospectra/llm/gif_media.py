"""Media columns: GIF.

``decode`` reads any GIF: block structure, LZW code streams with growing codes, local and global palettes, interlacing, transparency and
the four disposal rules; it yields timed full-canvas RGB frames with colour histograms. Code streams of a group of frames are expanded together:
code widths follow from how many codes were read, a code is a copy of earlier output, and copies are resolved by following
pointers to literals, twice as far each round. Streams that clear their table on the way, or break off, are expanded one by one by ``lzw``.
``encode_samples`` writes 8-bit samples losslessly as frames of a grey animation, with a growing LZW dictionary for each frame.

Rows: a null text or media counts as empty (a text still yields one padded frame, empty media no frames); media that aren't a GIF, or whose canvas
has no pixels or more than MOST_PIXELS, have no frames and a status that says so; a stream that breaks off ends with its last whole image block, whose missing
pixels have index 0; repeated rows get equal results; other columns don't matter; an empty table gives no rows; long media go through in groups of frames
that hold GROUP_BYTES of canvas at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import text_or_empty

SIDE, FRAME, DELAY, GROUP_BYTES, MOST_PIXELS = 24, 576, 10, 4 << 20, 1 << 24
#: Frames (of FRAME pixels, or as many larger or smaller ones) that are expanded together.
TOGETHER = 1024
#: Levels of red, green and blue that a colour histogram tells apart.
LEVELS = 4


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    delay: int
    disposal: int
    transparent: int | None
    interlaced: bool
    palette: np.ndarray
    code_size: int
    data: bytes
    indices: np.ndarray | None = None


def lzw_encode(pixels: bytes) -> bytes:
    """8-bit samples, at most 3837 of them, as a code stream that never fills its table: clear, growing codes, end."""
    codes, following, table = [256], 258, {}
    get, now = table.get, pixels[0]
    for value in pixels[1:]:
        pair = now << 8 | value
        code = get(pair)
        if code is None:
            codes.append(now)
            table[pair] = following
            following += 1
            now = value
        else:
            now = code
    codes += (now, 257)
    # after n codes behind the clear the reader's table holds 257 + n, so the code that follows has as many bits as that number
    held = bits = at = 0
    for width, stop in ((9, 256), (10, 768), (11, 1792), (12, len(codes))):
        for code in codes[at:stop]:
            held |= code << bits
            bits += width
        at = min(stop, len(codes))
        if at == len(codes):
            break
    return held.to_bytes(-(-bits // 8), "little")


def encode_samples(samples: bytes) -> bytes:
    """8-bit samples, a multiple of FRAME, as a grey GIF of one timed frame per FRAME samples."""
    side = SIDE.to_bytes(2, "little")
    grey = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()
    out = [b"GIF89a" + side + side + b"\xf7\x00\x00" + grey]
    head = b"\x21\xf9\x04\x04" + DELAY.to_bytes(2, "little") + b"\x00\x00\x2c\x00\x00\x00\x00" + side + side + b"\x00\x08"
    for at in range(0, len(samples), FRAME):
        stream = lzw_encode(samples[at : at + FRAME])
        out.append(head)
        for k in range(0, len(stream), 255):
            block = stream[k : k + 255]
            out += (bytes((len(block),)), block)
        out.append(b"\x00")
    return b"".join([*out, b"\x3b"])


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray, int]:
    size = 3 * (2 << (flags & 7))
    table = np.zeros((256, 3), np.uint8)
    held = np.frombuffer(data[at : at + size], np.uint8)
    held = held[: len(held) // 3 * 3].reshape(-1, 3)
    table[: len(held)] = held
    return table, at + size


class NotAGif(ValueError):
    """Media without frames: other bytes, or a canvas of no or too many pixels."""


def parse(data: bytes) -> tuple[int, int, list[Frame]]:
    """Width, height and frames, their code streams still packed. A stream that breaks off ends with its last whole frame."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise NotAGif("not a GIF")
    width, height = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    shared, at = np.zeros((256, 3), np.uint8), 13
    if data[10] & 0x80:
        shared, at = _palette(data, at, data[10])
    frames, delay, disposal, transparent = [], 0, 0, None
    try:
        while data[at] != 0x3B:
            kind, at = data[at], at + 1
            if kind == 0x21:
                label, at = data[at], at + 1
                if label == 0xF9:
                    flags, delay = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "little")
                    disposal, transparent = flags >> 2 & 7, data[at + 4] if flags & 1 else None
                while data[at]:
                    at += data[at] + 1
                at += 1
            elif kind == 0x2C:
                left, top, w, h = (int.from_bytes(data[at + k : at + k + 2], "little") for k in (0, 2, 4, 6))
                flags, at, palette = data[at + 8], at + 9, shared
                if flags & 0x80:
                    palette, at = _palette(data, at, flags)
                code_size, at, parts = data[at], at + 1, []
                while n := data[at]:
                    parts.append(data[at + 1 : at + 1 + n])
                    at += n + 1
                at += 1
                frames.append(Frame(left, top, w, h, delay, disposal, transparent, bool(flags & 0x40), palette, code_size, b"".join(parts)))
                delay, disposal, transparent = 0, 0, None
            else:
                break
    except IndexError:
        pass
    return width, height, frames


def lzw(data: bytes, code_size: int, n: int) -> bytes:
    """n indices at most from a code stream of any kind."""
    clear, end = 1 << code_size, (1 << code_size) + 1
    first = [bytes([i]) for i in range(clear)] + [b"", b""]
    table, width, last, out, size = first[:], code_size + 1, None, [], 0
    held = bits = 0
    for byte in data:
        held |= byte << bits
        bits += 8
        while bits >= width:
            code, held, bits = held & (1 << width) - 1, held >> width, bits - width
            if code == clear:
                table, width, last = first[:], code_size + 1, None
                continue
            if code == end or size >= n:
                return b"".join(out)[:n]
            if last is None:
                entry = table[code] if code < clear else b""
            elif code < len(table):
                entry = table[code]
            elif code == len(table):
                entry = last + last[:1]
            else:
                return b"".join(out)[:n]
            if last is not None and len(table) < 4096:
                table.append(last + entry[:1])
                if len(table) == 1 << width and width < 12:
                    width += 1
            out.append(entry)
            size += len(entry)
            last = entry
    return b"".join(out)[:n]


def _widths(code_size: int, n: int) -> np.ndarray:
    """Bits of each of n codes that follow a clear: the k-th is read with a table of 2 ** code_size + 1 + k entries, but the first."""
    entries = (1 << code_size) + 1 + np.arange(n)
    entries[:1] += 1
    return np.minimum(np.maximum(np.ceil(np.log2(entries + 1)).astype(np.int64), code_size + 1), 12)


def lzw_together(streams: list[bytes], code_size: int, n: int) -> list[np.ndarray | None]:
    """n indices of each stream that begins with a clear, has no other, and yields n at least; None for others."""
    clear, rows, most = 1 << code_size, len(streams), n + 2
    size = max(map(len, streams))
    first = code_size + 1
    starts = first + np.concatenate([[0], np.cumsum(_widths(code_size, most))])
    most = min(most, int(np.searchsorted(starts, size * 8, "right")) - 1)
    if most < 1 or not n:
        return [None] * rows
    data = np.zeros((rows, size + 8), np.uint8)
    lengths = np.array([len(x) for x in streams])
    data[np.arange(size + 8) < lengths[:, None]] = np.frombuffer(b"".join(streams), np.uint8)

    def read(offsets: np.ndarray, widths: np.ndarray) -> np.ndarray:
        at, shift = offsets >> 3, (offsets & 7).astype(np.uint32)
        three = data[:, at].astype(np.uint32) | data[:, at + 1].astype(np.uint32) << np.uint32(8) | data[:, at + 2].astype(np.uint32) << np.uint32(16)
        return (three >> shift & ((1 << widths) - 1).astype(np.uint32)).astype(np.int64)

    begins = read(np.zeros(1, np.int64), np.array([first]))[:, 0] == clear
    codes = read(starts[:most], _widths(code_size, most))
    ended = codes == clear + 1
    stop = np.where(ended.any(axis=1), ended.argmax(axis=1), most)
    stop = np.minimum(stop, np.maximum(np.searchsorted(starts, lengths * 8, "right") - 1, 0))  # whole codes within each stream
    most = max(1, int(stop.max()))
    codes = codes[:, :most]
    number = np.arange(most)
    used = number < stop[:, None]
    # entry clear + 2 + k is what code k says and the first letter of code k + 1; a code may name entries of earlier codes only
    made = codes - clear - 2
    good = begins & ((codes < clear) | (made >= 0) & (made < number) | ~used).all(axis=1)
    made = np.where(used & (made >= 0) & (made < number), made, -1)
    said = np.ones((rows, most), np.int64)
    every = np.arange(rows)
    for k in range(1, most):
        said[:, k] = np.where(made[:, k] >= 0, said[every, made[:, k]] + 1, 1)
    said[~used] = 0
    ends = np.cumsum(said, axis=1)
    good &= ends[:, -1] >= n
    # each index of the output: which code says it, and where from; a letter of its own points to itself
    width = int(ends[:, -1].max())
    total = ends[:, -1]
    owner = np.repeat(np.tile(number, rows), said.ravel())
    row = np.repeat(every, total)
    place = np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
    begin = ends - said
    from_code = made[row, owner]
    origin = np.where(from_code >= 0, begin[row, np.maximum(from_code, 0)] + place - begin[row, owner], place)
    pointer = (origin + row * width).astype(np.int64)
    letters = np.zeros((rows, width), np.uint8)
    letters[row, place] = np.where(codes[row, owner] < clear, codes[row, owner], 0).astype(np.uint8)
    flat = np.arange(rows * width)
    flat[place + row * width] = pointer
    while True:
        further = flat[flat]
        if (further == flat).all():
            break
        flat = further
    shown = letters.ravel()[flat].reshape(rows, width)[:, :n]
    return [shown[k] if ok else None for k, ok in enumerate(good)]


def expand(frames: list[Frame]) -> None:
    """Fills in frames' indices; those of one size and code size are expanded together, TOGETHER at a time."""
    shapes: dict[tuple[int, int], list[Frame]] = {}
    for f in frames:
        if f.indices is None and 2 <= f.code_size <= 8 and 0 < f.width * f.height <= 1 << 14:
            shapes.setdefault((f.code_size, f.width * f.height), []).append(f)
    for (code_size, n), group in shapes.items():
        size = max(1, TOGETHER * FRAME // n)
        for at in range(0, len(group), size):
            part = group[at : at + size]
            for f, row in zip(part, lzw_together([f.data for f in part], code_size, n), strict=True):
                f.indices = row
    for f in frames:
        if f.indices is None:
            n = f.width * f.height
            got = np.frombuffer(lzw(f.data, f.code_size, n), np.uint8) if 1 <= f.code_size <= 8 else np.zeros(0, np.uint8)
            f.indices = np.pad(got, (0, n - len(got)))


def checked(data: bytes) -> tuple[int, int, list[Frame]]:
    """parse, for a canvas that can be shown; image blocks larger than any canvas are left out."""
    width, height, frames = parse(data)
    if not 0 < width * height <= MOST_PIXELS:
        raise NotAGif(f"a canvas of {width} x {height}")
    return width, height, [f for f in frames if f.width * f.height <= MOST_PIXELS]


def show(width: int, height: int, frames: list[Frame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of (delays in hundredths of a second, full-canvas RGB frames)."""
    canvas, size = np.zeros((height, width, 3), np.uint8), max(1, GROUP_BYTES // (3 * width * height))
    for at in range(0, len(frames), size):
        group = frames[at : at + size]
        expand(group)
        delays, indices = np.array([f.delay for f in group]), [f.indices for f in group]
        if all((f.left, f.top, f.width, f.height) == (0, 0, width, height) and not f.interlaced and f.transparent is None and f.disposal < 2 and f.palette is group[0].palette for f in group):
            shown = group[0].palette[np.stack(indices)].reshape(-1, height, width, 3)
            canvas = shown[-1].copy()
        else:
            shown = np.empty((len(group), height, width, 3), np.uint8)
            for k, (f, flat) in enumerate(zip(group, indices, strict=True)):
                before = canvas.copy() if f.disposal == 3 else None
                rows = flat.reshape(f.height, f.width)
                if f.interlaced and f.height:
                    order = [y for first, by in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(first, f.height, by)]
                    rows = rows[np.argsort(order)]
                part = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
                rows = rows[: part.shape[0], : part.shape[1]]
                opaque = np.ones(rows.shape, bool) if f.transparent is None else rows != f.transparent
                part[opaque] = f.palette[rows][opaque]
                shown[k] = canvas
                if f.disposal == 2:
                    part[:] = 0
                elif f.disposal == 3:
                    canvas = before
        for f in group:
            f.indices = None
        yield delays, shown


def decode(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """show, from a GIF's bytes."""
    yield from show(*checked(data))


def histograms(frames: np.ndarray) -> np.ndarray:
    """For each frame, how many pixels have each of LEVELS ** 3 colours: LEVELS of red, then green, then blue."""
    n, bins = len(frames), LEVELS**3
    level = frames.reshape(n, -1, 3).astype(np.int64) * LEVELS >> 8
    colour = (level[:, :, 0] * LEVELS + level[:, :, 1]) * LEVELS + level[:, :, 2]
    return np.bincount((colour + (np.arange(n) * bins)[:, None]).ravel(), minlength=n * bins).reshape(n, bins)


def frames_of(media: list[bytes | None]) -> Iterator[tuple[str, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """For each of some media (status, groups of frames): the status is "ok", "empty", or why there are none.

    Frames of several small media are expanded together; those of one that has more than TOGETHER of them are expanded as it is shown.
    """
    held: list[tuple[str, tuple[int, int, list[Frame]] | None]] = []
    waiting: list[Frame] = []

    def shown() -> Iterator[tuple[str, Iterator[tuple[np.ndarray, np.ndarray]]]]:
        expand(waiting)
        for status, parsed in held:
            yield status, show(*parsed) if parsed else iter(())
        held.clear()
        waiting.clear()

    for data in media:
        try:
            parsed = checked(data) if data else None
            held.append(("empty" if not data else "ok" if parsed[2] else "no frames", parsed))
        except NotAGif as e:
            parsed = None
            held.append((str(e), None))
        if parsed and len(parsed[2]) <= TOGETHER and sum(f.width * f.height for f in parsed[2]) <= TOGETHER * FRAME:
            waiting += parsed[2]
        if len(waiting) >= TOGETHER or len(held) >= TOGETHER:
            yield from shown()
    yield from shown()


def media_status(media: DataFrame, id: str, column: str = "media") -> DataFrame:
    """A row per row of media: id, status and n_frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(status, sum(len(shown) for _, shown in groups)) for status, groups in frames_of(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["id", "status", "n_frames"])

    return media.select(F.col(id).cast("long").alias("id"), column).mapInArrow(run, "id long, status string, n_frames long").withColumnRenamed("id", id)


def decode_frames(media: DataFrame, id: str, column: str = "media") -> DataFrame:
    """A row per frame: id, frame_no, start_ms, delay_ms, width, height, rgb, histogram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, (_, groups) in zip(batch.column(0), frames_of(batch.column(1).to_pylist()), strict=True):
                no = clock = 0
                for delays, shown in groups:
                    n, start = len(shown), clock + np.cumsum(delays) - delays
                    clock += int(delays.sum())
                    for at in range(0, n, 256):
                        part = shown[at : at + 256]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([key.as_py()] * len(part), pa.int64()), pa.array(range(no + at, no + at + len(part)), pa.int64()), pa.array(start[at : at + 256] * 10, pa.int64()), pa.array(delays[at : at + 256] * 10, pa.int64()), pa.array([shown.shape[2]] * len(part), pa.int32()), pa.array([shown.shape[1]] * len(part), pa.int32()), pa.array([f.tobytes() for f in part], pa.binary()), pa.array(list(histograms(part)), pa.list_(pa.int64()))],
                            ["id", "frame_no", "start_ms", "delay_ms", "width", "height", "rgb", "histogram"],
                        )
                    no += n

    return media.select(F.col(id).cast("long").alias("id"), column).mapInArrow(run, "id long, frame_no long, start_ms long, delay_ms long, width int, height int, rgb binary, histogram array<long>").withColumnRenamed("id", id)


def store_texts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes and media: each text's bytes, filled up with 255, as a GIF."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                raw = [t.as_buffer() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array([encode_samples(_filled(r.to_pybytes())) for r in raw], pa.binary())], ["id", "n_bytes", "media"])

    return docs.select(F.col(id).cast("long").alias("id"), text_or_empty(text).alias("text")).mapInArrow(run, "id long, n_bytes long, media binary").withColumnRenamed("id", id)


def _filled(raw: bytes) -> bytes:
    return raw + b"\xff" * (-len(raw) % FRAME if raw else FRAME)


def media_digests(stored: DataFrame, id: str = "doc_id") -> DataFrame:
    """Of stored texts (id, n_bytes, media): checks and features of what decoding the stored bytes gives back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            stored = [x or b"" for x in batch.column(2).to_pylist()]
            for media, (_, groups) in zip(stored, frames_of(stored), strict=True):
                total, tail, digest, counts, frames = 0, b"", sha256(), np.zeros(LEVELS**3, np.int64), 0
                for _, shown in groups:
                    samples = np.ascontiguousarray(shown[..., 0]).tobytes()  # grey: every channel holds the sample
                    digest.update(samples)
                    total, tail, frames = total + len(samples), (tail + samples[-32:])[-32:], frames + len(shown)
                    counts += histograms(shown).sum(axis=0)
                rows.append((total, digest.hexdigest(), crc32(tail), len(media), sha256(media).hexdigest(), f"{frames}:" + ",".join(map(str, counts[counts > 0])) + ":" + ",".join(map(str, np.flatnonzero(counts)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in zip(*rows, strict=True))] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return stored.select(F.col(id).alias("id"), "n_bytes", "media").mapInArrow(run, "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string").withColumnRenamed("id", id)
