"""Importance resampling towards a target text collection (operator 11).

Features are hashed runs of one to ``order`` words. The bucket of a feature is the CRC-32 of its bytes, and a
CRC can be put together: crc(a + b) follows from crc(a), crc(b) and the length of b. So no feature is ever
built as a string:

1. distinct words are counted by a distributed aggregate, and the most frequent ones, as many whole doublings
   of the count as fit into ``dictionary_bytes``, become a dictionary (a bound in bytes, not in rows);
2. a task puts them, bounded by delimiters on both sides, into an Aho-Corasick automaton; each carries its CRC
   and its length as payload. A scan of a run of texts emits the payloads in order. Words that are not in the
   dictionary are the gaps of the scan and get theirs on the spot, so the dictionary changes speed, not results;
3. payloads of neighbours are composed into buckets. One pass counts them (corpus and target), a second one sums
   the buckets' gains over each document;
4. scores with Gumbel noise from the document's id are ordered by a distributed prefix count, and the highest
   are drawn.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common, spans
from strata.operators.rank import fixed_partitions, prefix_sums

#: A-Z to a-z, every other ASCII character that is no word character to a space.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_STEP = 1 << 20  # bytes of text in a run
_SHORT = 64  # lengths whose shift is a table of its own; dictionary words are shorter
_HITS = np.dtype([("end", np.int64), ("payload", np.int64)])


# ------------------------------------------------------------- composition of CRCs

def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by the images of each value of each byte."""
    return (tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24])


@lru_cache(maxsize=1)
def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """What appending n bytes does to a CRC, beside their own CRC: tables for n < _SHORT, and for n = 2^k."""
    values = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    zero = zlib.crc32(b"\0")
    one = np.array([[zlib.crc32(b"\0", int(v)) ^ zero for v in row] for row in values], dtype=np.uint32)
    short = [np.array(values)]
    for _ in range(_SHORT - 1):
        short.append(_apply(one, short[-1]))
    doubled = [one]
    for _ in range(40):
        doubled.append(_apply(doubled[-1], doubled[-1]))
    return np.array(short), doubled


def compose(crc: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings one after the other, from both CRCs and the length of the second."""
    short, doubled = _shifts()
    out = np.empty(len(crc), dtype=np.uint32)
    few = length < _SHORT
    if not few.all():
        far = crc[~few].copy()
        for k, tables in enumerate(doubled):
            on = (length[~few] >> k) & 1 == 1
            far[on] = _apply(tables, far[on])
        out[~few] = far
    c = crc[few]
    at = length[few] * 1024
    flat = short.ravel()
    out[few] = (flat[at + (c & 255)] ^ flat[at + 256 + ((c >> 8) & 255)]
                ^ flat[at + 512 + ((c >> 16) & 255)] ^ flat[at + 768 + (c >> 24)])
    return out ^ tail


# ------------------------------------------------------------- words and payloads

def _runs(column: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    """(plain text of some rows, each between spaces; where each row begins in it, and the end)."""
    texts = spans.texts_of(column)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(texts.offsets, texts.offsets[row] + _STEP, side="right")) - 1)
        plain = b" ".join([b"", *(texts.bytes(i) for i in range(row, to)), b""]).translate(_PLAIN)
        o = texts.offsets[row:to + 1]
        yield plain, o - o[0] + np.arange(len(o)) + 1
        row = to


class Scanner:
    """The automaton of a dictionary (words one after the other with spaces between them)."""

    def __init__(self, dictionary: bytes):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.words = dictionary.split()
        for w in self.words:
            self.automaton.add_word(f" {w.decode('latin-1')} ", len(w) << 32 | zlib.crc32(w))
        self.automaton.make_automaton()

    def payloads(self, plain: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, CRC, length) of every word of a plain text, in order."""
        inside = np.frombuffer(plain, dtype=np.uint8) != 32
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # it begins and ends with a space
        begins, length = edge[::2], edge[1::2] - edge[::2]
        crc = np.zeros(len(begins), dtype=np.uint32)
        gap = np.ones(len(begins), dtype=bool)
        if self.words:
            hits = np.fromiter(self.automaton.iter(plain.decode("latin-1")), dtype=_HITS)
            at = np.searchsorted(begins, hits["end"] - (hits["payload"] >> 32))
            crc[at] = (hits["payload"] & 0xFFFFFFFF).astype(np.uint32)
            gap[at] = False
        rest = np.flatnonzero(gap)
        crc[rest] = [zlib.crc32(plain[a:a + n]) for a, n in zip(begins[rest].tolist(), length[rest].tolist())]
        return begins, crc, length


@lru_cache(maxsize=1)
def scanner(dictionary: bytes) -> Scanner:
    """The Python worker's automaton (built once for a dictionary)."""
    return Scanner(zlib.decompress(dictionary))


def _features(column: pa.Array, dictionary: bytes, order: int, buckets: int):
    """For runs of rows: (words before each row, and in all; a list over 1 .. ``order`` of (bucket of every feature
    of that many words, features before each row, and in all))."""
    space = np.uint32(zlib.crc32(b" "))
    for plain, rows in _runs(column):
        begins, crc, length = scanner(dictionary).payloads(plain)
        first = np.searchsorted(begins, rows)
        words = np.diff(first)
        gram, at, out = crc, np.arange(len(crc)), []
        for k in range(order):
            if k:  # runs of k words that have a next word in their row
                last = np.repeat(first[1:], words)[at] - k
                on = at < last
                at, gram = at[on], gram[on]
                one = np.ones(len(gram), dtype=np.int64)
                gram = compose(compose(gram, np.full(len(gram), space), one), crc[at + k], length[at + k])
            out.append(((gram % np.uint32(buckets)).astype(np.int64),
                        np.concatenate([[0], np.cumsum(np.maximum(words - k, 0))])))
        yield first, out


def dictionary_of(docs: DataFrame, text_col: str, limit: int) -> bytes:
    """The most frequent words of ``docs``, as many whole doublings of the count as fit into ``limit`` bytes,
    compressed. Words of ``_SHORT`` bytes and more are left to the scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for plain, _ in _runs(b.column(0)):
                found = Counter(plain.split())
                words = [w for w in found if len(w) < _SHORT]
                if words:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words, pa.binary()), pa.array([found[w] for w in words], pa.int64())], names=["word", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long")
    words = common.store(counted.groupBy("word").agg(F.sum("n").alias("n")), "resampling-words")
    level = F.floor(F.log2("n")).cast("int")
    sizes = words.groupBy(level.alias("level")).agg(F.sum(F.length("word") + 1).alias("size")).collect()  # at most 63 rows
    total, least = 0, 63
    for r in sorted(sizes, key=lambda r: -r["level"]):
        total += r["size"]
        if total > limit:
            break
        least = r["level"]
    chosen = words.where(level >= least).select("word").collect()  # at most ``limit`` bytes, measured above
    return zlib.compress(b" ".join(sorted(bytes(r["word"]) for r in chosen)))


def bucket_counts(docs: DataFrame, text_col: str, dictionary: bytes, order: int, buckets: int) -> DataFrame:
    """``(bucket, n)``: how many features of all rows fall into each bucket. A task sends its sums alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, grams in _features(b.column(0), dictionary, order, buckets):
                for bucket, _ in grams:
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """For each bucket floor(1000 ln(((t+1) (S+buckets)) / ((s+1) (T+buckets)))) with its counts t, s in the target
    and the corpus, of T and S features in all. Both tables hold at most ``buckets`` rows."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for into, table in ((s, corpus), (t, target)):
        for r in table.collect():
            into[r["bucket"]] = r["n"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, dictionary: bytes, *, id_col: str, text_col: str,
            order: int) -> DataFrame:
    """Per row: ``id_col``, ``version`` (the text's hash), ``n_words``, ``n_features``, ``weight``."""
    kind = "string" if docs.schema[id_col].dataType.typeName() == "string" else "long"
    packed = zlib.compress(gain.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(zlib.decompress(packed), dtype=np.int64)
        for b in batches:
            row = 0
            for first, grams in _features(b.column(2), dictionary, order, len(own)):
                n = len(first) - 1
                total, count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                for bucket, before in grams:
                    total += np.diff(np.concatenate([[0], np.cumsum(own[bucket])])[before])
                    count += np.diff(before)
                weight = np.where(count > 0, total // np.maximum(count, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, n), b.column(1).slice(row, n), pa.array(np.diff(first)), pa.array(count),
                     pa.array(weight)], names=["doc", "version", "n_words", "n_features", "weight"])
                row += n

    rows = docs.select(F.col(id_col).cast(kind).alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc {kind}, version long, n_words long, n_features long, weight long")


def _noise(ident: Column, seed: int) -> Column:
    """Gumbel noise of a document in thousandths, from its id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", order: int = 2, buckets: int = 10_000, min_words: int = 20,
             percent: int = 25, seed: int = 7, dictionary_bytes: int = 1 << 20) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_words``, ``n_features``, ``weight`` (floored mean gain of its features),
    ``score`` (weight plus Gumbel noise) and ``rank``: of the N rows with at least ``min_words`` words the
    floor(percent N / 100) highest scores are drawn and ranked from 1, ties to the smaller id; others have null.

    Null and empty texts have no words and weight 0. Repeated rows are scored and ranked each; rows of one id with
    other texts are ordered by their text's hash; a null id takes its noise from an empty id and comes last among
    equal scores. An empty table gives an empty table; an empty target counts 0 everywhere. Columns of ``docs``
    beside the two are ignored.
    """
    dictionary = dictionary_of(docs, text_col, dictionary_bytes)
    count = lambda df, col: bucket_counts(df, col, dictionary, order, buckets)
    gain = gains(count(docs, text_col), count(target, target_text_col), buckets)
    scored = weights(docs, gain, dictionary, id_col=id_col, text_col=text_col, order=order)
    scored = common.store(scored.withColumn("score", F.col("weight") + _noise(F.col("doc"), seed)), "resampling-scores")
    ordered = prefix_sums(scored.where(F.col("n_words") >= min_words),
                          [F.col("score").desc(), F.col("doc").asc_nulls_last(), F.col("version").asc()], partitions=fixed_partitions(scored))
    drawn = F.col("pos") < F.floor(F.col("total_rows") * percent / 100)
    columns = [F.col("doc").alias(id_col), "n_words", "n_features", "weight", "score"]
    ranked = ordered.select(*columns, F.when(drawn, F.col("pos") + 1).cast("long").alias("rank"))
    return ranked.unionByName(scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))
