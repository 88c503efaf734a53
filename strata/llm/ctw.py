"""Language-model scoring by context-tree weighting over bytes (operator 10).

A byte is eight binary decisions, each with a context tree of its own over the bytes before it (depths 0
to ``depth``). At every node a Krichevsky-Trofimov estimator predicts the next bit, and the weighted
probability mixes all prunings of the tree:  P_w(s) = 1/2 KT(s) + 1/2 prod P_w(children), with P_w = KT at
the full depth. The trained trees give a text its probability with the mixture's posterior weights
lambda(s) = 1/2 KT(s) / P_w(s):  P(bit) = lambda KT(bit) + (1 - lambda) P(bit | one byte deeper).

Texts are scored with A-Z lower-cased, as UTF-8 bytes followed by one end symbol (byte 255, which UTF-8 does
not use); contexts before a text's start are end symbols. The model is never held in one place: the
distinct (depth+1)-byte grams of every part go to buckets by their last two context bytes, so a bucket holds
whole subtrees from depth 2 down; depths 0 and 1 have at most 257 x 255 nodes and are merged from the
buckets' sums. Counts of a bucket are summed over groups of parts first, in a tree, and the trees are built from
its merged distinct grams; their log probabilities are stored and groups of parts are answered from them, so
neither a frequent byte pair nor the number of parts makes a group grow beyond its distinct grams.

The unigram baseline (add-one over words, as a point of comparison) travels the same way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common, parts, spans

U64 = np.uint64
GRAM, WORD = 0, 1
PART_BYTES = 8 << 20
#: Parts whose blobs of a bucket one group merges or answers; merged blobs that one group merges further.
PARTS, MERGED = 256, 16
MODEL = -1  # in place of a part: the merged keys of a bucket with what is answered
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HALF = math.log(0.5)


def _log_gamma_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(n, dtype=np.float64)
    return np.concatenate([[0.0], np.cumsum(np.log(k + 0.5))]), np.concatenate([[0.0], np.cumsum(np.log(k + 1.0))])


_HALVES, _WHOLES = _log_gamma_tables(1 << 14)


def _stirling(x: np.ndarray) -> np.ndarray:
    """log Gamma(x) for large x."""
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with ``a`` zeros and ``b`` ones."""

    def halves(n):  # log Gamma(n + 1/2) / Gamma(1/2)
        small = n < len(_HALVES)
        return np.where(small, _HALVES[np.where(small, n, 0)], _stirling(np.maximum(n, 9) + 0.5) - 0.5 * math.log(math.pi))

    def wholes(n):  # log n!
        small = n < len(_WHOLES)
        return np.where(small, _WHOLES[np.where(small, n, 0)], _stirling(np.maximum(n, 9) + 1.0))

    return halves(a) + halves(b) - wholes(a + b)


class _Level:
    """The nodes of one context depth: distinct grams of depth + 1 bytes with their counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts
        self.keys, self.run, self.n0, self.n1, self.log_kt = [], [], [], [], []
        for bit in range(8):
            key = codes >> U64(8 - bit)
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(new)
            one = ((codes >> U64(7 - bit)) & U64(1)).astype(np.int64) * counts
            n = np.add.reduceat(counts, at) if len(at) else counts[:0]
            n1 = np.add.reduceat(one, at) if len(at) else counts[:0]
            self.keys.append(key[at])
            self.run.append(np.cumsum(new) - 1)
            self.n0.append(n - n1)
            self.n1.append(n1)
            self.log_kt.append(log_kt(n - n1, n1))


class Subtrees:
    """Trees of a set of grams (distinct, ascending) that is closed under: same last two context bytes."""

    def __init__(self, every: np.ndarray, total: np.ndarray, depth: int):
        self.depth = depth
        self.levels = {depth: _Level(every, total)}
        self.place = {depth: np.arange(len(every))}
        for d in range(depth - 1, 1, -1):
            codes, place, _ = spans.group(every & U64((1 << (8 * (d + 1))) - 1))
            self.levels[d] = _Level(codes, np.bincount(place, weights=total, minlength=len(codes)).astype(np.int64))
            self.place[d] = place
        self.log_pw = {depth: self.levels[depth].log_kt}
        for d in range(depth - 1, 1, -1):
            up, down = self.levels[d], self.levels[d + 1]
            self.log_pw[d] = []
            for bit in range(8):
                parent = np.searchsorted(up.keys[bit], down.keys[bit] & U64((1 << (8 * d + bit)) - 1))
                children = np.bincount(parent, weights=self.log_pw[d + 1][bit], minlength=len(up.keys[bit]))
                self.log_pw[d].append(np.logaddexp(_HALF + up.log_kt[bit], _HALF + children))

    def sums(self) -> tuple[np.ndarray, ...]:
        """(context byte, node, zeros, ones, sum of log P_w) of the depth-2 nodes by their last byte."""
        top, node, n0, n1, s = self.levels[2], [], [], [], []
        for bit in range(8):
            key = top.keys[bit] & U64((1 << (8 + bit)) - 1)  # last context byte, then the byte's first bits
            node.append(((key >> U64(bit)).astype(np.int64) << 8) | (1 << bit) | (key & U64((1 << bit) - 1)).astype(np.int64))
            n0.append(top.n0[bit])
            n1.append(top.n1[bit])
            s.append(self.log_pw[2][bit])
        node = np.concatenate(node)
        own, at = np.unique(node, return_inverse=True)
        return (own >> 8, own & 255, *(np.bincount(at, weights=np.concatenate(x), minlength=len(own)) for x in (n0, n1, s)))

    def log10_probability(self, top: tuple) -> np.ndarray:
        """log10 P(byte | context) of every gram, in ascending order. ``top``: see ``top_levels``."""
        codes = self.levels[self.depth].codes
        byte, context = (codes & U64(255)).astype(np.int64), ((codes >> U64(8)) & U64(255)).astype(np.int64)
        (one1, weight1), (one0, weight0) = top
        out = np.zeros(len(codes))
        for bit in range(8):
            is_one = ((byte >> (7 - bit)) & 1).astype(bool)
            node = (1 << bit) | (byte >> (8 - bit))
            p = None
            for d in range(self.depth, 1, -1):
                level = self.levels[d]
                run = level.run[bit][self.place[d]]
                kt = (level.n1[bit] + 0.5) / (level.n0[bit] + level.n1[bit] + 1.0)
                kt = kt[run]
                if p is None:
                    p = kt
                else:
                    weight = np.exp(_HALF + level.log_kt[bit] - self.log_pw[d][bit])[run]
                    p = weight * kt + (1 - weight) * p
            w = weight1[context, node]
            p = w * one1[context, node] + (1 - w) * p
            w = weight0[node]
            p = w * one0[node] + (1 - w) * p
            out += np.log10(np.where(is_one, p, 1 - p))
        return out


def top_levels(rows) -> tuple:
    """((P(one), weight) of depth 1, of depth 0) from the summed rows (context, node, n0, n1, log P_w)."""
    n0, n1, s = (np.zeros((256, 256)) for _ in range(3))
    for context, node, a, b, c in rows:
        n0[context, node], n1[context, node], s[context, node] = a, b, c
    kt = log_kt(n0.astype(np.int64), n1.astype(np.int64))
    pw = np.logaddexp(_HALF + kt, _HALF + s)
    r0, r1 = n0.sum(axis=0), n1.sum(axis=0)
    root = log_kt(r0.astype(np.int64), r1.astype(np.int64))
    root_pw = np.logaddexp(_HALF + root, _HALF + pw.sum(axis=0))
    return ((n1 + 0.5) / (n0 + n1 + 1), np.exp(_HALF + kt - pw)), ((r1 + 0.5) / (r0 + r1 + 1), np.exp(_HALF + root - root_pw))


class _Part:
    """Grams and words of one part, as (distinct keys by bucket, place of each occurrence, text of each)."""

    def __init__(self, table: pa.Table, depth: int, buckets: int):
        plain = spans.texts_of(parts.column(table, "text"))
        self.texts = texts = spans.Texts(_LOWER[plain.data], plain.offsets)
        self.n = n = len(texts)
        lens = np.diff(texts.offsets)
        # per text: ``depth`` end symbols as context, the bytes, one end symbol
        stream = np.full(len(texts.data) + n * (depth + 1), 255, dtype=np.uint8)
        row = np.repeat(np.arange(n), lens)
        stream[np.arange(len(texts.data)) + row * (depth + 1) + depth] = texts.data
        here = np.bincount(stream, minlength=256) > 0
        dense = (np.cumsum(here) - 1).astype(np.uint8)
        radix = int(here.sum())
        at = spans.ragged(texts.offsets[:-1] + np.arange(n) * (depth + 1), lens + 1)  # first byte of each gram
        at = at.astype(np.int32) if len(stream) < 1 << 31 else at
        code = np.zeros(len(at), dtype=U64)
        small = dense[stream]
        for k in range(depth + 1):
            code *= U64(radix)
            code += small[at + k]
        del at, small, stream, row
        own, inverse, _ = spans.group(code, max(1, (radix ** (depth + 1) - 1).bit_length()))
        del code
        letters = np.flatnonzero(here).astype(U64)
        key, rest = np.zeros(len(own), dtype=U64), own.copy()
        for k in range(depth + 1):  # the same order: the alphabet is mapped in ascending order
            key |= letters[(rest % U64(radix)).astype(np.int64)] << U64(8 * k)
            rest //= U64(radix)
        bucket = (spans.mix((key >> U64(8)) & U64(0xFFFF)) % U64(buckets)).astype(np.int64)
        self.grams = _Keys(key, bucket, inverse, np.repeat(np.arange(n), lens + 1))
        starts, ends, first = spans.words(texts)
        own, inverse, _ = spans.group(spans.hash_spans(texts.data, starts, ends, 11))
        self.words = _Keys(own, (own % U64(buckets)).astype(np.int64), inverse, np.repeat(np.arange(n), np.diff(first)))


class _Keys:
    def __init__(self, keys, bucket, inverse, text):
        order = np.argsort(bucket, kind="stable")
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        self.keys, self.bucket, self.place, self.text = keys[order], bucket[order], back[inverse], text

    def ask(self, kind: int, learn: np.ndarray) -> Iterator[tuple]:
        seen = np.bincount(self.place[learn[self.text]], minlength=len(self.keys)).astype("<u4")
        for b, i, j in parts.slices(self.bucket):
            yield kind, b, common.pack_sorted(self.keys[i:j]), common.compress(seen[i:j].tobytes())

    def answers(self, replies: dict[int, bytes], dtype: str) -> np.ndarray:
        """The reply of each occurrence."""
        found = [np.frombuffer(common.decompress(replies[b]), dtype=dtype) for b, _, _ in parts.slices(self.bucket)]
        return np.concatenate([np.zeros(0, dtype), *found])[self.place]


def merged(blobs: list[bytes], extras: list[bytes], dtype: str, pending: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in ascending order, their summed counts) of some blobs, which are opened one at a time:
    held are the distinct keys and about as many more, or ``pending``."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = own = 0

    def fold() -> None:
        keys, inverse, _ = spans.group(np.concatenate([k for k, _ in held]))
        total = np.bincount(inverse, weights=np.concatenate([c for _, c in held]), minlength=len(keys))
        held[:] = [(keys, total.astype(np.int64))]

    for k, c in zip(blobs, extras, strict=True):
        held.append((common.unpack_sorted(k), np.frombuffer(common.decompress(c), dtype=dtype).astype(np.int64)))
        n += len(held[-1][0])
        if n > max(pending, 2 * own):
            fold()
            n = own = len(held[0][0])
    fold()
    return held[0]


def merge(asked: DataFrame, n_parts: int) -> DataFrame:
    """One row (kind, bucket, part, keys, extra) a bucket: distinct keys with counts summed over all parts, in a
    tree of groups (bucket, range of parts), so that a bucket's group does not grow with the corpus."""
    fan, dtype, rows, n = PARTS, "<u4", asked, n_parts
    while True:
        n = -(-n // fan)

        def run(key, group):
            import pandas as pd

            keys, counts = merged(group["keys"].tolist(), group["extra"].tolist(), dtype)
            return pd.DataFrame({"kind": [int(key[0])], "bucket": [int(key[1])], "part": [int(key[2])],
                                 "keys": [common.pack_sorted(keys)], "extra": [common.compress(counts.astype("<u8").tobytes())]})

        rows = common.store(rows.groupBy("kind", "bucket", _share("part", n).alias("share")).applyInPandas(run, parts.ASK), "merged")
        if n <= 1:
            return rows
        fan, dtype = MERGED, "<u8"


def _share(part: str, n: int) -> Column:
    return F.pmod(F.xxhash64(part), F.lit(max(n, 1)))


def score(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", depth: int = 5) -> DataFrame:
    """Score all rows with a model learned from those where ``learn`` is true (null: not).

    Returns per row ``id_col``, ``held_out`` (not learned from), ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (words with add-one), ``score`` (log10 probability of the lower-cased text and its end),
    ``bits_per_byte`` (code length of the text and its end symbol over their number of symbols).

    Null and empty texts are their end symbol alone. Without any text to learn from every bit has
    probability 1/2. Repeated rows are learned and returned each; null ids are kept; an empty table gives
    an empty result. Words are told apart by a 64-bit hash.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth must be 2 to 7 bytes")
    text_id = docs.schema[id_col].dataType.typeName() == "string"
    ident = F.col(id_col) if text_id else F.col(id_col).cast("long")
    corpus = parts.copy(docs, {"doc": ident, "text": F.col(text_col), "learn": F.coalesce(learn, F.lit(False))})
    buckets = int(np.clip(1 << (corpus.n_bytes >> 22).bit_length(), 16, 4096))

    def keys_of(part: int, table: pa.Table) -> Iterator[tuple]:
        p = _Part(table, depth, buckets)
        chosen = parts.column(table, "learn").to_numpy(zero_copy_only=False).astype(bool)
        yield from p.grams.ask(GRAM, chosen)
        yield from p.words.ask(WORD, chosen)

    asked = common.store(parts.ask(corpus, ["text", "learn"], keys_of, PART_BYTES), "grams")

    n_parts = asked.select("part").distinct().count()
    whole = merge(asked, n_parts)

    def summed(key, group):
        import pandas as pd

        keys, counts = merged(group["keys"].tolist(), group["extra"].tolist(), "<u8")
        if int(key[0]) == WORD:
            context, node, n0, n1, s = [-1], [-1], [float(counts.sum())], [float((counts > 0).sum())], [0.0]
        else:
            context, node, n0, n1, s = Subtrees(keys, counts, depth).sums()
        return pd.DataFrame({"context": context, "node": node, "n0": n0, "n1": n1, "s": s})

    sums = (whole.groupBy("kind", "bucket").applyInPandas(summed, "context int, node int, n0 double, n1 double, s double")
            .groupBy("context", "node").agg(F.sum("n0"), F.sum("n1"), F.sum("s")))
    rows = [tuple(r) for r in sums.collect()]  # at most 256 x 255 nodes and the totals of the words
    ends = corpus.map(lambda batches: batches, ["learn"], "file long, learn boolean").where("learn").count()
    tokens, types = next(((int(r[2]), int(r[3])) for r in rows if r[0] < 0), (0, 0))
    tokens, types = tokens + ends, types + (ends > 0)
    top = top_levels(r for r in rows if r[0] >= 0)

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merged counts to what is answered: log probabilities of grams, counts of words."""
        add, flush = common.arrow_rows(parts.ASK_SCHEMA, 16)
        for b in batches:
            for kind, bucket, _, keys, extra in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == GRAM:
                    own, total = merged([keys], [extra], "<u8")
                    extra = common.compress(Subtrees(own, total, depth).log10_probability(top).astype("<f8").tobytes())
                yield from add((kind, bucket, MODEL, keys, extra))
        yield from flush()

    # a bucket's parts are answered in groups, each with the bucket's model
    shares = max(1, -(-n_parts // PARTS))
    share, = common.internal(asked, "share")
    models = common.store(whole.mapInArrow(model, parts.ASK), "model")
    both = asked.drop("extra").withColumn("extra", F.lit(None).cast("binary")).withColumn(share, _share("part", shares)).unionByName(
        models.withColumn(share, F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<bigint>"))))

    def reply(key, group):
        import pandas as pd

        own = group["part"] == MODEL
        m, group = group[own].iloc[0], group[~own]
        keys = common.unpack_sorted(m["keys"])
        values = np.frombuffer(common.decompress(m["extra"]), dtype="<u8" if int(key[0]) == WORD else "<f8")
        out = [common.compress(values[np.searchsorted(keys, common.unpack_sorted(k))].tobytes()) for k in group["keys"]]
        return pd.DataFrame({"kind": group["kind"], "bucket": group["bucket"], "part": group["part"], "reply": out})

    answers = parts.Answers(both.groupBy("kind", "bucket", share).applyInPandas(reply, parts.ANSWER), "scores")
    schema = pa.schema([(id_col, pa.string() if text_id else pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64()), ("bits_per_byte", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in parts.parts_of(batches, PART_BYTES):
            p = _Part(table, depth, buckets)
            found = answers.of(part)
            logp = np.bincount(p.grams.text, weights=p.grams.answers(found.get(GRAM, {}), "<f8"), minlength=p.n).astype(float)
            c = p.words.answers(found.get(WORD, {}), "<u8").astype(np.float64)
            base = np.bincount(p.words.text, weights=np.log10((c + 1) / (tokens + types + 1)), minlength=p.n).astype(float)
            base += math.log10((ends + 1) / (tokens + types + 1))
            n = np.bincount(p.words.text, minlength=p.n) + 1
            known = np.bincount(p.words.text[c > 0], minlength=p.n) + (ends > 0)
            size = np.diff(p.texts.offsets) + 1
            yield pa.RecordBatch.from_arrays(
                [parts.column(table, "doc").cast(schema.field(0).type),
                 pa.array(~parts.column(table, "learn").to_numpy(zero_copy_only=False).astype(bool)),
                 pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)),
                 pa.array(np.full(p.n, tokens, dtype=np.int64)), pa.array(base), pa.array(logp),
                 pa.array(-logp * math.log2(10) / size)], schema=schema)

    out = (f"`{id_col}` {'string' if text_id else 'long'}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double, bits_per_byte double")
    return corpus.map(scored, ["doc", "text", "learn"], out)
