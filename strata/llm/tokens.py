"""Exact token ids of whole texts with a public tokenizer, many texts at once.

Most words of a corpus repeat. A batch of texts is cut where the tokenizer itself
always cuts, each distinct piece is encoded once by the library, and the ids are
gathered back, so the result equals the library's ids for every whole text. Cuts:

* before a lone space between two characters that are not white space (a byte-level
  pre-tokenizer keeps that space with the next word, a word-level one drops it);
* before and after a lone newline between two such characters;
* between an ASCII letter and a following ASCII punctuation mark.

No pattern of these tokenizers matches across such a place or looks behind it, and
no Unicode normalisation composes across it. Everywhere else the text is not cut.
A text that holds a special token's string goes to the library whole. The memory
of pieces is bounded in bytes (``limit``): once half of it is new, what was not used since the last time
is forgotten. It changes speed, never ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from strata.llm import spans

_OTHER, _LETTER, _MARK, _SPACE, _LINE, _ODD = range(6)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[:33] = _ODD
_CLASS[127] = _ODD
_CLASS[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = _MARK
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[32], _CLASS[10] = _SPACE, _LINE
#: Bytes of pieces a worker remembers, and what Python needs beside the bytes of one (two objects, a dict's slot).
REMEMBERED = 40 << 20
_ENTRY = 170
#: First two UTF-8 bytes of characters outside ASCII that are white space (or share their first bytes).
_WIDE = ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))


def pieces(texts: spans.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the spans between cuts; they cover the texts without gaps."""
    data, offs = texts
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    c = _CLASS[data]
    if (data >= 0xC2).any():
        for a, b in _WIDE:
            at = np.flatnonzero((data[:-1] == a) & (data[1:] == b))
            for k in range(2 if a == 0xC2 else 3):
                c[np.minimum(at + k, n - 1)] = _ODD
    white = c >= _SPACE
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    lone = white.copy()  # one white-space character with other characters on both sides
    lone[1:] &= ~white[:-1]
    lone[:-1] &= ~white[1:]
    lone &= ~edge[:-1] & ~edge[1:]
    cut = edge
    cut[:-1] |= lone & ((c == _SPACE) | (c == _LINE))
    cut[1:] |= lone & (c == _LINE)
    cut[1:-1] |= (c[:-1] == _LETTER) & (c[1:] == _MARK)
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    return starts, ends, np.searchsorted(starts, offs)


class Encoder:
    """Ids of whole texts for one vocabulary file. ``limit``: bytes of the pieces that a worker remembers."""

    def __init__(self, path: str, limit: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.model, self.normalizer = self.tok.model, self.tok.normalizer
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.vocab <= 1 << 16 else "<u4")
        self.specials = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.bytes_to_chars = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        same = self._library(" a") == self._library("a")
        self.space = "" if same else self.bytes_to_chars.pre_tokenize_str(" ")[0][0]
        self.limit, self.held = limit, 0
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """Ids of one piece. A word of letters is one pre-token, which the library's model takes directly."""
        text = piece.decode("utf-8", "replace")
        word, lead = (text[1:], self.space) if text[:1] == " " else (text, "")
        if word.isalpha():
            if self.normalizer is not None:
                word = word.lower() if word.isascii() else self.normalizer.normalize_str(word)
            if word.isalpha():
                chars = word if word.isascii() else self.bytes_to_chars.pre_tokenize_str(word)[0][0]
                return np.array([t.id for t in self.model.tokenize(lead + chars)], dtype=self.dtype).tobytes()
        return self._library(text)

    def _lookup(self, piece: bytes) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = self._piece(piece)
            self.held += len(piece) + len(ids) + _ENTRY
            if 2 * self.held > self.limit:
                self.older, self.known = self.known, {}
                self.held = len(piece) + len(ids) + _ENTRY
            self.known[piece] = ids
        return ids

    def encode(self, column: pa.Array, step: int = 2 << 20):
        """Yields (first row, ids, ids before each row) for runs of rows of about ``step`` bytes; the last
        array has one entry more than rows. Null and empty texts have no ids."""
        texts = spans.texts_of(column)
        row, n = 0, len(texts)
        while row < n:
            to = max(row + 1, int(np.searchsorted(texts.offsets, texts.offsets[row] + step, side="right")) - 1)
            o = texts.offsets[row:to + 1]
            yield row, *self._run(spans.Texts(texts.data[o[0]:o[-1]], o - o[0]))
            row = to

    def _run(self, texts: spans.Texts) -> tuple[np.ndarray, np.ndarray]:
        whole = texts.data.tobytes()
        if any(s in whole for s in self.specials):
            parts = [np.frombuffer(self._library(texts.bytes(i).decode("utf-8", "replace")), self.dtype)
                     if texts.offsets[i] < texts.offsets[i + 1] else np.zeros(0, self.dtype)
                     for i in range(len(texts))]
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        starts, ends, first = pieces(texts)
        if len(starts) == 0:
            return np.zeros(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        _, inverse, _ = spans.group(spans.hash_spans(texts.data, starts, ends))
        sample = np.empty(int(inverse.max()) + 1, dtype=np.int64)
        sample[inverse] = np.arange(len(inverse))
        lookup = self._lookup
        found = [lookup(whole[a:b]) for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)]
        lens = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(found), dtype=self.dtype)
        at = np.cumsum(lens) - lens
        count = lens[inverse]
        ids = pool[spans.ragged(at[inverse], count)]
        return ids, np.concatenate([[0], np.cumsum(count)])[first]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The Python worker's encoder for a vocabulary file (loaded once per worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
