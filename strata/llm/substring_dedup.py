"""Substring deduplication with a count-min prefilter (operator 3).

A window is ``window`` consecutive words of one text. Words covered by a window whose words also start
anywhere else go. To count all windows exactly would shuffle a row a word, so:

1. every part of the corpus hashes its windows into the cells of a count-min sketch (``rows`` rows, each
   with at least ``load`` cells a window) and sends its distinct cells, a bit or two above the entropy;
2. each block of cells is merged over all parts, and every part learns which of its cells were counted
   twice. A window all of whose cells were is *estimated repeated*; the sketch only overestimates, so no
   repeated window is lost;
3. the second pass groups exactly the windows estimated repeated, by a 128-bit hash, and every part learns
   which are;
4. the last pass drops the covered words.

The sketch is spread over tasks block by block and never held whole or broadcast; its width follows the
input, so the share of windows that pass by chance stays the same at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common, parts, spans

U64 = np.uint64
EXACT = 100  # kind of the exact pass; kinds below are rows of the sketch
BLOCK_BITS = 22


def window_hashes(words: tuple, data: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each window, its first word). ``words``: see ``spans.words``; windows do not cross texts."""
    starts, ends, first = words
    last = np.repeat(first[1:], np.diff(first))  # the end of each word's text
    at = np.flatnonzero(np.arange(len(starts)) + window <= last)
    out = np.empty(len(at), dtype=U64)
    if len(at) == 0:
        return out, at
    word = spans.hash_spans(data, starts, ends, seed)
    step = 1 << 18
    power, inverse = spans.powers(spans.odd(seed + 1), step + window)
    i = 0
    while i < len(at):
        lo = at[i]
        j = int(np.searchsorted(at, lo + step))
        a = at[i:j] - lo
        piece = word[lo:lo + int(a[-1]) + window]
        c = np.zeros(len(piece) + 1, dtype=U64)
        np.cumsum(piece * power[:len(piece)], out=c[1:])
        out[i:j] = (c[a + window] - c[a]) * inverse[a]
        i = j
    return spans.mix(out), at


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return spans.mix(h + U64((row + 1) * 0xA0761D6478BD642F & (2**64 - 1))) >> U64(64 - bits)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=n).astype(bool)


def merge_block(keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    """Merge the cells of one block over all parts; tell each part which of its cells count twice or more."""
    total = np.zeros(1 << BLOCK_BITS, dtype=np.uint8)
    own = [common.unpack_sorted(k) for k in keys]
    for c, twice in zip(own, extras, strict=True):
        total[c] = np.minimum(total[c] + 1 + _flags(twice, len(c)), 2)
    return [_bits(total[c] >= 2) for c in own]


def count_exactly(keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    """Group 128-bit window keys of one bucket; tell each part which of its windows start elsewhere too."""
    both = [np.frombuffer(k, dtype="<u8").reshape(2, -1) for k in keys]
    n = np.array([b.shape[1] for b in both])
    h = np.concatenate(both, axis=1)
    count = 1 + np.concatenate([_flags(x, k) for x, k in zip(extras, n, strict=True)]).astype(np.int64)
    order = np.lexsort((h[1], h[0]))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h[:, order[1:]] != h[:, order[:-1]]).any(axis=0)
    run = np.cumsum(new) - 1
    repeated = np.empty(len(order), dtype=bool)
    repeated[order] = np.bincount(run, weights=count[order])[run] >= 2
    return [_bits(x) for x in np.split(repeated, np.cumsum(n)[:-1])]


class _Part:
    """The windows of one part of the corpus."""

    def __init__(self, table: pa.Table, window: int):
        self.texts = spans.texts_of(parts.column(table, "text"))
        self.words = spans.words(self.texts)
        self.window = window
        self.h, self.at = window_hashes(self.words, self.texts.data, window, 1)

    def estimated(self, replies: dict[int, dict[int, bytes]], rows: int, bits: int) -> np.ndarray:
        """Positions (in ``h``) of the windows whose cells all count twice or more."""
        ok = np.ones(len(self.h), dtype=bool)
        for r in range(rows):
            own, inverse, _ = spans.group(cells(self.h, r, bits), bits)
            flags = np.concatenate([np.zeros(0, bool)] + [
                _flags(replies[r][b], to - a) for b, a, to in parts.slices(own >> U64(BLOCK_BITS))])
            ok &= flags[inverse]
        return np.flatnonzero(ok)

    def keys(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct 128-bit keys in order, key of each chosen window, counts in this part)."""
        if len(chosen) == 0:
            return np.zeros((2, 0), U64), chosen, chosen
        k = np.stack([self.h[chosen], window_hashes(self.words, self.texts.data, self.window, 101)[0][chosen]])
        order = np.lexsort((k[1], k[0]))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (k[:, order[1:]] != k[:, order[:-1]]).any(axis=0)
        inverse = np.empty(len(order), dtype=np.int64)
        inverse[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        return k[:, order[at]], inverse, np.diff(at, append=len(order))


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                     rows: int = 2, load: int = 4) -> DataFrame:
    """Remove each word covered by a window of ``window`` words whose words also start anywhere else, the same
    text included; windows are judged on the input.

    Returns a row per row of ``docs``: ``id_col``, ``n_words``, ``n_removed``, ``text_col`` (the words that
    stay, joined by one space). Null and empty texts have no words and give an empty text; texts shorter than
    a window keep all words; of repeated rows each loses the repeated words. Null ids are kept. An empty table
    gives an empty result. ``rows`` and ``load`` shape the sketch and change no result.
    """
    text_id = docs.schema[id_col].dataType.typeName() == "string"
    ident = F.col(id_col) if text_id else F.col(id_col).cast("long")
    corpus = parts.copy(docs, {"doc": ident, "text": F.col(text_col)})
    windows = max(corpus.n_bytes // 6, 1)  # a word and its space are some six bytes
    bits = max(BLOCK_BITS, int(windows * load - 1).bit_length())
    bucket_shift = U64(64 - max(1, (windows >> 18).bit_length()))

    def ask_cells(part: int, table: pa.Table) -> Iterator[tuple]:
        p = _Part(table, window)
        for r in range(rows):
            c = np.sort(cells(p.h, r, bits))
            new = np.ones(len(c), dtype=bool)
            new[1:] = c[1:] != c[:-1]
            at = np.flatnonzero(new)
            twice = np.diff(at, append=len(c)) > 1
            own = c[at]
            for b, i, j in parts.slices(own >> U64(BLOCK_BITS)):
                yield r, b, common.pack_sorted(own[i:j] & U64((1 << BLOCK_BITS) - 1)), _bits(twice[i:j])

    sketch = parts.Answers(parts.answer(parts.ask(corpus, ["text"], ask_cells),
                                        lambda kind, bucket, keys, extras: merge_block(keys, extras)), "sketch")

    def ask_windows(part: int, table: pa.Table) -> Iterator[tuple]:
        p = _Part(table, window)
        own, _, count = p.keys(p.estimated(sketch.of(part), rows, bits))
        for b, i, j in parts.slices(own[0] >> bucket_shift):
            yield EXACT, b, own[:, i:j].astype("<u8").tobytes(), _bits(count[i:j] > 1)

    exact = parts.Answers(parts.answer(parts.ask(corpus, ["text"], ask_windows),
                                       lambda kind, bucket, keys, extras: count_exactly(keys, extras)), "windows")
    ids = pa.string() if text_id else pa.int64()
    schema = pa.schema([(id_col, ids), ("n_words", pa.int64()), ("n_removed", pa.int64()), (text_col, pa.string())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in parts.parts_of(batches):
            p = _Part(table, window)
            chosen = p.estimated(sketch.of(part), rows, bits)
            own, inverse, _ = p.keys(chosen)
            replies = exact.of(part).get(EXACT, {})
            flags = np.concatenate([np.zeros(0, bool)] + [
                _flags(replies[b], j - i) for b, i, j in parts.slices(own[0] >> bucket_shift)])
            begin = p.at[chosen[flags[inverse]]] if len(chosen) else p.at[:0]
            n = len(p.words[0])
            depth = np.bincount(begin, minlength=n + 1) - np.bincount(np.minimum(begin + window, n), minlength=n + 1)
            gone = np.cumsum(depth[:n]) > 0
            first = p.words[2]
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            texts = []
            for i, k in enumerate(removed.tolist()):
                words = p.texts.bytes(i).split()  # the white space of the word rule
                if k:
                    words = [w for w, x in zip(words, gone[first[i]:first[i + 1]].tolist(), strict=True) if not x]
                texts.append(b" ".join(words).decode("utf-8", "replace"))
                if len(texts) == 4096 or i == len(removed) - 1:
                    a = i + 1 - len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [parts.column(table, "doc").slice(a, len(texts)).cast(ids), pa.array(np.diff(first)[a:i + 1]),
                         pa.array(removed[a:i + 1]), pa.array(texts, pa.string())], schema=schema)
                    texts = []

    out = f"`{id_col}` {'string' if text_id else 'long'}, n_words long, n_removed long, `{text_col}` string"
    return corpus.map(rebuild, ["doc", "text"], out)
