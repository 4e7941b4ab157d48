"""Tokens, packing, SentencePiece, GIF, chat and HTML against plain versions."""

import random
import re
import time
from hashlib import sha256
from html.parser import HTMLParser
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from prospectra.llm import byte_bpe, chat_format, gif_media, html_text, packing, sentencepiece_codec, token_counts
from prospectra.llm.byte_bpe import ByteBpe
from prospectra.llm.shared import shared_dir

from . import brute

BPE, SPM = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "\n", "  a  b", " a\n\n b \n", "a \n b", "x\t\ty  \r\n z", "it's don't 's  's\n's 're", "<|endoftext|> a <|endoftext|>", "a\xa0b c　d", "é È ßß 12 34  ½ ²", "\x1c a\x1db",
    "a   ", "   a", " \n \n", "▁▁x ▁", "<s></s> <0x0A>", "\x00\x01a\x7f", "日本 🙂 " + "x" * 3000, "﻿x​ y", "Á", "thon, thon. Thon!? (thon)", "word " * 4000,
]


def texts():
    rng = random.Random(3)
    return ODD + ODD[1:4] + ["".join(rng.choice([" ", " ", "\n", "\t", "a", "the", "ing", ".", ",", "é", "▁", "🙂", "\r", "'s", "12"]) for _ in range(rng.randrange(90))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts())] + [(9999, None), (None, "no id")], "doc_id long, text string").withColumnRenamed("doc_id", "doc_id").repartition(5).cache()


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_byte_bpe(plain):
    own = ByteBpe(BPE)
    for t in texts():
        assert np.frombuffer(own.encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_byte_bpe_control_string_behind_white_space(plain):
    own = ByteBpe(BPE)
    for t in ("x\n\n<|endoftext|>y", "x\n \n<|endoftext|>\n\n", "\t\n\n<|endoftext|> 's  a"):
        assert np.frombuffer(own.encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_byte_bpe_batches(plain, monkeypatch):
    own, many = ByteBpe(BPE), [*texts(), "été.*** ÷a×. ÿ% a.b,c", "a\tb\r\n", "\n\n"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in many]
    for slice_bytes, cache_pieces in ((1, 3), (500, 100), (1 << 20, 1 << 20)):
        monkeypatch.setattr(byte_bpe, "SLICE_BYTES", slice_bytes)
        monkeypatch.setattr(byte_bpe, "CACHE_PIECES", cache_pieces)
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode_all(pa.array(["cut off", *many, None, "cut off"]).slice(1, len(many) + 1))]
        assert got == [*want, []]
    assert list(own.encode_all(pa.array([], pa.string()))) == []


def test_byte_bpe_asks_for_a_word_once_whatever_marks_follow():
    own, asked = ByteBpe(BPE), []
    model, tokenizer = own.model, own.tokenizer
    own.model = SimpleNamespace(tokenize=lambda piece: asked.append(piece) or model.tokenize(piece))
    own.tokenizer = SimpleNamespace(encode=lambda text, **options: asked.append(text) or tokenizer.encode(text, **options))
    for _ in range(3):
        list(own.encode_all(pa.array(["x thon été thon. été. thon*** été*** thon$$$ été$$$\nthon, été, thon," * 9] * 50)))
    assert len(asked) == len(set(asked)) <= 14, asked


def test_packing(spark, docs, plain):
    rows = packing.pack_documents(docs, BPE).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for r in docs.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]
        at = 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == brute.crc(ids[at : at + p.length]) and p.doc_tokens == len(ids)
            at += p.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == pieces[0].sequence_tokens <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 0.02 * 1024 * len(by_sequence)
    assert packing.pack_documents(docs.limit(0), BPE).count() == 0


def test_bounded_packer_keeps_every_id():
    rng, packer = random.Random(1), packing.BoundedPacker(64, 4, 4)
    out, sizes = [], [rng.randrange(1, 150) for _ in range(500)]
    for k, n in enumerate(sizes):
        out += packer.place(k, 0, memoryview(b"".join(i.to_bytes(4, "little") for i in range(n))))
        assert len(packer.held) <= 4
    out += packer.finish()
    pieces = {}
    for window in out:
        assert 0 < sum(len(i) // 4 for *_, i in window) <= 64
        for k, start, ids in window:
            pieces.setdefault(k, []).append((start, len(ids) // 4, int.from_bytes(ids[:4], "little")))
    for k, n in enumerate(sizes):
        at = 0
        for start, length, first in sorted(pieces[k]):
            assert start == at == first
            at += length
        assert at == n


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 20])
def test_token_counts(spark, docs, block):
    own = ByteBpe(BPE, special_as_text=True)
    folder = shared_dir(spark, "test-tokens")
    written = token_counts.write_token_files(docs, BPE, 50256, folder, file_bytes=4000) if block > 3 else token_counts.write_token_files(docs.filter("length(text) < 60"), BPE, 50256, folder)
    files = token_counts.files_of(written.cache())
    counted = token_counts.count_tokens(files, folder, 50256, block_tokens=block).collect()
    source = docs if block > 3 else docs.filter("length(text) < 60")
    assert sorted(r.n_tokens for r in counted) == sorted(len(own.encode(r.text or "")) // 4 for r in source.collect())
    assert all(r.closed for r in counted)
    for path in {r.path for r in counted}:
        at = 0
        for n, r in enumerate(sorted((r for r in counted if r.path == path), key=lambda r: r.doc_no)):
            assert (r.doc_no, r.start) == (n, at)
            at += r.n_tokens + 1


def test_counts_of_documents(spark, docs):
    own = ByteBpe(BPE, special_as_text=True)
    key = lambda d, n: (d is not None, d or 0, n)
    got = sorted((key(*r) for r in token_counts.document_token_counts(docs, BPE, 50256).collect()))
    assert got == sorted(key(r.doc_id, len(own.encode(r.text or "")) // 4) for r in docs.collect())
    assert token_counts.document_token_counts(docs.limit(0), BPE, 50256).count() == 0


def test_token_file_without_a_last_separator(spark, tmp_path):
    np.array([5, 9, 0, 0, 7, 7, 7], "<u2").tofile(tmp_path / "a.bin")
    np.array([], "<u2").tofile(tmp_path / "b.bin")
    files = spark.createDataFrame([(str(tmp_path / "a.bin"), 14), (str(tmp_path / "b.bin"), 0)], "path string, n_bytes long")
    rows = token_counts.count_tokens(files, f"file://{tmp_path}", 0, block_tokens=2).orderBy("doc_no").collect()
    assert [(r.doc_no, r.start, r.n_tokens, r.closed) for r in rows] == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 3, False)]


def test_sentencepiece(spark, docs):
    lib = sentencepiece_codec.codec(SPM).library
    for r in sentencepiece_codec.codec_digests(docs.filter("doc_id IS NOT NULL"), SPM).join(docs, "doc_id").collect():
        ids = lib.encode(r.text or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((lib.decode(ids) if ids else "").encode()).hexdigest())
    assert sentencepiece_codec.encode_and_decode(docs, SPM).filter("size(ids) > 0").count() > 300


def test_sentencepiece_agenda_alone():
    codec = sentencepiece_codec.MergeCodec(SPM)
    for t in texts():
        assert codec.encode_symbols(codec.library.normalize(t)) == codec.library.encode(t), t


def test_gif_columns(spark, docs):
    rows = gif_media.media_digests(gif_media.store_texts(docs)).collect()
    source = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert len(rows) == len(source)
    for r in rows:
        raw = source[r.doc_id]
        payload = gif_media._filled(raw)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), sha256(payload).hexdigest(), crc32(payload[-32:]))
    frames = gif_media.decode_frames(gif_media.store_texts(docs), "doc_id").filter("doc_id = 22").orderBy("frame_no").collect()
    assert b"".join(f.rgb[::3] for f in frames) == gif_media._filled(source[22]) and [f.start_ms for f in frames] == [100 * k for k in range(len(frames))]
    assert all(sum(f.histogram) == 576 for f in frames)


def lzw_codes(data, size):
    """A plain encoder with growing codes."""
    clear, out, bits, held = 1 << size, bytearray(), 0, 0
    table, width = {bytes([i]): i for i in range(clear)}, size + 1

    def put(code):
        nonlocal held, bits
        held |= code << bits
        bits += width
        while bits >= 8:
            out.append(held & 255)
            held >>= 8
            bits -= 8

    put(clear)
    w, count = b"", clear + 2
    for b in data:
        if w + bytes([b]) in table:
            w += bytes([b])
            continue
        put(table[w])
        table[w + bytes([b])] = count
        count += 1
        if count - 1 == 1 << width and width < 12:
            width += 1
        if count > 4095:
            put(clear)
            table, width, count = {bytes([i]): i for i in range(clear)}, size + 1, clear + 2
        w = bytes([b])
    put(table[w])
    put(clear + 1)
    out.append(held & 255)
    return bytes(out)


def gif_frame(x, y, w, h, pixels, delay=1, disposal=0, transparent=None, interlaced=False, palette=None, size=2):
    data = lzw_codes(bytes(pixels), size)
    blocks = b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255))
    le = lambda *v: b"".join(n.to_bytes(2, "little") for n in v)
    return b"\x21\xf9\x04" + bytes([disposal << 2 | (transparent is not None)]) + le(delay) + bytes([transparent or 0, 0]) + b"\x2c" + le(x, y, w, h) + bytes([0x40 * interlaced | (0x81 if palette else 0)]) + (palette or b"") + bytes([size]) + blocks + b"\x00"


def test_gif_rules():
    shared = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    local = bytes([9] * 12)
    gif = b"GIF89a\x04\x00\x04\x00\x81\x00\x00" + shared + b"\x21\xfe\x02hi\x00"
    gif += gif_frame(0, 0, 4, 4, [1] * 16, delay=5)
    gif += gif_frame(1, 1, 2, 2, [2, 3, 3, 2], disposal=2, transparent=3)
    gif += gif_frame(0, 0, 1, 1, [3], disposal=3)
    gif += gif_frame(3, 3, 1, 1, [0], palette=local)
    gif += gif_frame(0, 0, 4, 4, [0] * 4 + [2] * 4 + [1] * 4 + [3] * 4, interlaced=True) + b"\x3b"
    (delays, shown), = gif_media.decode(gif)
    red, green, blue, none = (255, 0, 0), (0, 255, 0), (0, 0, 255), (0, 0, 0)
    at = lambda k, x, y: tuple(int(v) for v in shown[k, y, x])
    assert delays.tolist() == [5, 1, 1, 1, 1] and at(0, 3, 3) == red
    assert at(1, 1, 1) == green and at(1, 2, 1) == red and at(1, 2, 2) == green
    assert at(2, 1, 1) == none and at(2, 0, 0) == blue
    assert at(3, 0, 0) == red and at(3, 3, 3) == (9, 9, 9)
    assert [at(4, 0, y) for y in range(4)] == [none, red, green, blue]
    data = random.Random(4).choices(range(200), k=40000)
    assert list(gif_media.lzw(lzw_codes(bytes(data), 8), 8, 40000)) == data
    assert list(gif_media.decode(gif[:-10]))[0][1].shape[0] == 4


def test_lzw_together():
    """Streams expanded together give what the plain decoder gives, and those it can't do are left to that."""
    rng = random.Random(6)
    plain = [bytes(rng.choices(range(top), k=576)) for top in (1, 2, 4, 30, 256) for _ in range(6)] + [(b"abcab" * 200)[:576]]
    streams = [gif_media.lzw_encode(x) for x in plain]
    for stream, x in zip(streams, plain, strict=True):
        assert gif_media.lzw(stream, 8, 576) == x == lzw_codes_back(stream)
    broken = [s[: len(s) // 2] for s in streams] + [b"", b"\x00" * 40, streams[3][::-1], lzw_codes(b"a" * 100, 8)]
    got = gif_media.lzw_together(streams + broken, 8, 576)
    assert [g.tobytes() for g in got[: len(plain)]] == plain
    for stream, g in zip(broken, got[len(plain) :], strict=True):
        assert g is None or g.tobytes() == gif_media.lzw(stream, 8, 576)
    for size in (2, 3, 5):
        pixels = bytes(rng.choices(range(1 << size), k=300))
        assert gif_media.lzw_together([lzw_codes(pixels, size)], size, 300)[0].tobytes() == pixels


def lzw_codes_back(stream):
    """Pixels of a stream by the textbook's decoder, over single bits."""
    bits = "".join(f"{b:08b}"[::-1] for b in stream)
    table, out, last, at, width = {i: bytes([i]) for i in range(256)}, b"", None, 9, 9
    while True:
        code, at = int(bits[at : at + width][::-1], 2), at + width
        if code == 257:
            return out
        said = table[code] if code in table else last + last[:1]
        if last is not None:
            table[len(table) + 2] = last + said[:1]
        width = max(9, (len(table) + 2).bit_length())
        out, last = out + said, said


def test_odd_media(spark):
    good = gif_media.encode_samples(bytes(1152))
    large = b"GIF89a" + b"\xff" * 4 + b"\x00" * 3 + b";"
    outside = b"GIF89a\x02\x00\x02\x00\x81\x00\x00" + bytes(12) + gif_frame(9, 9, 4, 4, [1] * 16) + gif_frame(0, 0, 60000, 60000, [1]) + b"\x3b"
    size12 = b"GIF89a\x02\x00\x02\x00\x81\x00\x00" + bytes(12) + b"\x2c" + bytes(4) + b"\x02\x00\x02\x00\x00\x0c\x01\x00\x00\x3b"
    rows = [(1, good), (2, None), (3, b""), (4, b"GIF89a"), (5, b"no"), (6, b"GIF89a" + bytes(7) + b";"), (7, large), (8, good[:-20]), (9, outside), (10, size12), (1, good)]
    df = spark.createDataFrame([(k, bytearray(m) if m is not None else None) for k, m in rows], "doc_id long, media binary").repartition(2)
    status = sorted((r.doc_id, r.status, r.n_frames) for r in gif_media.media_status(df, "doc_id").collect())
    assert status == [(1, "ok", 2), (1, "ok", 2), (2, "empty", 0), (3, "empty", 0), (4, "not a GIF", 0), (5, "not a GIF", 0), (6, "a canvas of 0 x 0", 0), (7, "a canvas of 65535 x 65535", 0), (8, "ok", 1), (9, "ok", 1), (10, "ok", 1)]
    assert gif_media.decode_frames(df, "doc_id").count() == 7 and gif_media.decode_frames(df.limit(0), "doc_id").count() == 0
    red, green = np.zeros((1, 2, 2, 3), np.uint8), np.zeros((1, 2, 2, 3), np.uint8)
    red[..., 0], green[..., 1] = 128, 65
    assert gif_media.histograms(red)[0].nonzero()[0].tolist() == [32] and gif_media.histograms(green)[0].nonzero()[0].tolist() == [4]


def test_chat(spark):
    rng = random.Random(2)
    bits = ["\\", "### ", "</turn>", ": ", "a", "\n", "#", "</turn", ":", " ", "assistant", "é🙂"]
    make = lambda n: "".join(rng.choice(bits) for _ in range(rng.randrange(n)))
    rows = [(c, t, rng.choice(["user", "assistant", make(3), None]), rng.choice([make(9), make(9), None])) for c in range(60) for t in range(rng.randrange(1, 7))]
    rows += rows[:3] + [(None, 0, "assistant", "alone"), (None, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    assert len(got) == 61
    for conv, r in got.items():
        own = sorted([(t is not None, t or 0, a or "", b or "") for c, t, a, b in rows if c == conv])
        said = "".join(b for *_, a, b in own if a == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == sha256("".join(f"{a}\n{b}\n" for *_, a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(said), sha256(said.encode()).hexdigest())
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<title>t</title><p>One<p>Two <b>bold</b><br>three", "One\n\nTwo bold\nthree"),
    ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
    ("<table><tr><td>aa<td>b<tr><th>c<td>dddd</table>after", "aa | b\nc  | dddd\n\nafter"),
    ("<div hidden>no</div><div style='color:red; display : none'>no<p>no</div>yes<input type=hidden value=no><script>'</p>'</script>", "yes"),
    ("<pre>  k\n l</pre>", "  k\n l"), ("<dl><dt>T<dd>D<dt>U</dl>", "T\n  D\nU"),
    ("a</p></div>b<!-- no --><i>c", "abc"), ("<p>a<table><tr><td>1</td></tr></table>b", "a\n\n1\n\nb"),
    ("<table><tr><td><table><tr><td>i<td>j</table></td><td>k</td></tr></table>", "i | j | k"),
    ("<table><tr><td colspan=2>wide<td>c<tr><td>a<td>b b<td>d</table>", "wide    | c\na | b b | d"),
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b>no</div>", "yes"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details><dialog>no</dialog><dialog open>d</dialog>", "S\nT\nyes\nd"),
    ('<a href="x>hello</a>', "hello"), ("a <b", "a <b"), ("1 < 2 <3 <", "1 < 2 <3 <"), ("<svg><title>no</title><text>label</text></svg>", "label"),
    ("<input type=submit value='Go on'><input value=no><input type=hidden value=no>", "Go on"), ("<ol start=x><li>a</ol>", "1. a"),
    ("<script>no", ""), ("<!-- no", ""), ("<p>a<script>if (a<b) '</p>'</SCRIPT >b", "ab"), ("<textarea> k\n</textarea>", " k"),
])
def test_html(html, text):
    assert html_text.html_to_text(html) == text


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a '" * 250_000, "<a \"" * 250_001 + ">", "<p><button>" + "<div>" * 200_000 + "x", "<b><table><td>" + "<i>" * 600 + "</b>" * 240_000,
    "<i>a" * 250_000, "<ul><li>x" * 110_000, "<table>" + "<tr><td>a" * 60_000 + "<tr><td>" + "b" * 500_000, "<table><tr>" + "<td>" * 120_000 + "<br>x" * 100_000,
    "<table><tr><td>" + "y" * 80 + "<td>" * 2 + "<table><tr><td>z<td>" * 9_000 + "<br>x" * 100_000, "<" * 1_000_000, "&amp" * 200_000, "<!--" * 250_000, "<blockquote>a" * 80_000,
], ids=range(14))
def test_hostile_html(page):
    """A megabyte of trouble takes about as long as a megabyte of text, and its output stays in proportion."""
    began = time.process_time()
    text = html_text.html_to_text(page)
    assert time.process_time() - began < 30 and len(text) < 120 * len(page)


class PlainText(HTMLParser):
    """The words that a page shows, in order, by the standard library's tokenizer."""

    def __init__(self):
        super().__init__()
        self.words, self.unseen = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in html_text.VOID and (self.unseen or tag in html_text.UNSEEN or "hidden" in dict(attrs) or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", dict(attrs).get("style") or "")):
            self.unseen.append(tag)

    def handle_endtag(self, tag):
        if tag in self.unseen:
            while self.unseen.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.unseen:
            self.words += data.split()


def test_html_shows_what_a_plain_reader_finds(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert len(pages) > 10
    for r in pages:
        plain = PlainText()
        plain.feed(r.html or "")
        plain.close()
        shown = re.sub(r"(?m)^( *(?:\d+\.|-) )+|^---$", "", html_text.html_to_text(r.html).replace(" | ", " ")).replace("|", "")
        assert "".join(shown.split()) == "".join(plain.words).replace("|", ""), r.page_id


def test_html_deep_and_table(spark):
    assert html_text.html_to_text("<div>" * 20000 + "x") == "x"
    pages = spark.createDataFrame([(1, "<p>a"), (1, "<p>a"), (2, None), (None, "")], "page_id long, html string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(pages).collect()) == [(0, "", 0), (1, "a", 1), (1, "a", 1), (2, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0
