"""Byte-level BPE ids of whole texts, from the ``tokenizers`` library, a batch of texts at a time.

The vocabulary's pre-tokenizer cuts a text before the last character of a run of white space that something visible follows (a space
there joins it), around the run's rest and behind words, whatever stands elsewhere. A batch's bytes are therefore cut into pieces
by comparisons of whole arrays; every different piece of a batch is encoded once, by the library, and a bounded cache
keeps it for the next batch. Texts with other white space, or with a control string, take the library's own path.
"""

from __future__ import annotations

import re
import string
from codecs import charmap_decode
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that one cache keeps before it starts again, bytes of texts that are encoded at a time (or one text), and bytes that are
#: compared at a time; bound a Python worker's memory.
CACHE_PIECES, SLICE_BYTES, BLOCK_BYTES = 300_000, 2 << 20, 1 << 18
#: White space (in any engine's reading) besides space, tab, line feed and carriage return.
_STRANGE = "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
#: A word of these letters is one pre-token, in any Unicode version, with or without a space before it.
_LETTERS = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_WHITE, _LETTER, _MARK = 1, 2, 3


def _byte_letters() -> str:
    """At each byte's place the visible character that stands for it in a byte-level vocabulary: itself where printable, else one from U+0100 on.

    A line feed stays one: it parts words.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(b) if b in shown or b == 10 else chr(0x100 + hidden.index(b)) for b in range(256))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of large strings (or binaries), from the first one on."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


class _Packed(dict):
    """Id -> its four bytes."""

    def __missing__(self, n: int) -> bytes:
        self[n] = out = n.to_bytes(4, "little")
        return out


class ByteBpe:
    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.model, self.known = self.tokenizer.model, {}
        self.letters = _byte_letters()
        self.packed = _Packed()
        # A control string is found before white space is looked at: "  <|x|>" is two spaces, not one and a word.
        control = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (t.special and special_as_text)]
        self.strange = "|".join([_STRANGE, *map(re.escape, control)])
        self.kinds = np.zeros(256, np.uint8)
        # An apostrophe may belong to what follows, so it is no mark.
        for kind, characters in ((_WHITE, " \n\t\r"), (_LETTER, string.ascii_letters), (_MARK, string.punctuation.replace("'", ""))):
            self.kinds[list(characters.encode())] = kind

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit bytes."""
        return bytes(*self.encode_all(pa.array([text], pa.large_string())))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes | memoryview]:
        """The ids of each of an array's whole texts, in their order, as little-endian unsigned 32-bit bytes. A null is empty.

        What is yielded is a view of a slice's ids: a caller that keeps it copies it.
        """
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        ends, start = _buffers(texts)[0][1:] if len(texts) else (), 0
        while start < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            part, start = texts.slice(start, stop - start), stop
            strange = pc.match_substring_regex(part, self.strange)
            even = self._even(part.filter(pc.invert(strange)) if pc.any(strange).as_py() else part)
            for n, other in enumerate(strange.to_pylist()):
                yield b"".join(map(self.packed.__getitem__, self._ids(part[n].as_py()))) if other else next(even)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _even(self, texts: pa.Array) -> Iterator[memoryview]:
        """The ids of large strings without strange white space or control strings."""
        offsets, data = _buffers(texts)
        bounds = self._bounds(offsets, data)
        pieces = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        places = np.searchsorted(bounds, offsets)
        del bounds
        coded, ids = _buffers(pa.array(self._coded(pieces.dictionary), pa.large_binary()).take(pieces.indices))
        places, ids = coded[places].tolist(), memoryview(ids)
        for n in range(len(texts)):
            yield ids[places[n] : places[n + 1]]

    def _bounds(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where pieces start and the last one ends: a word starts with the space before it, what follows it with a mark or white space."""
        cut, final = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        final[offsets[1:] - 1] = True
        for at in range(1, len(data), BLOCK_BYTES):
            first = max(at - 2, 0)
            block = data[first : at + BLOCK_BYTES + 1]
            kinds = self.kinds[block]
            white, letter = kinds == _WHITE, kinds == _LETTER
            letter[1:] |= (block[:-1] == 0xC3) & (block[1:] != 0x97) & (block[1:] != 0xB7)  # À to ÿ, but for × and ÷
            here = white[1:] & ~white[:-1] | ~white[1:] & white[:-1] & (block[:-1] != 0x20) | (kinds[1:] == _MARK) & letter[:-1]
            # The last one of a run of white space, if something follows in the same text.
            here[:-1] |= white[1:-1] & ~white[2:] & ~final[first + 1 : first + len(block) - 1]
            stop = min(at + BLOCK_BYTES, len(data))
            cut[at:stop] = here[at - first - 1 : stop - first - 1]
        cut[offsets] = True
        return np.flatnonzero(cut)

    def _coded(self, pieces: pa.Array) -> list[bytes]:
        """The ids of different pieces."""
        words, packed, tokenize = pieces.to_pylist(), self.packed, self.model.tokenize
        out = list(map(self.known.get, words))
        new = [n for n, ids in enumerate(out) if ids is None]
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
        simple = pc.match_substring_regex(pieces.take(pa.array(new, pa.int64())), _LETTERS).to_pylist()
        shown = charmap_decode("\n".join(words[n] for n, one in zip(new, simple, strict=True) if one).encode(), "strict", self.letters)[0]
        shown = iter(shown.split("\n"))
        for n, one in zip(new, simple, strict=True):
            word = words[n]
            out[n] = ids = b"".join([packed[t.id] for t in tokenize(next(shown))] if one else [packed[k] for k in self._ids(word)])
            if len(word) <= 64:
                self.known[word] = ids
        return out


@cache
def byte_bpe(path: str, special_as_text: bool = False) -> ByteBpe:
    """One encoder for each Python worker and vocabulary."""
    return ByteBpe(path, special_as_text)
