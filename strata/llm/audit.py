"""Filter interaction audit: what each of five filters removes in every order (operator 12).

Four filters judge a text by itself. The fifth, E, asks for an equal text under a smaller id anywhere in the table,
and is answered without shuffling the corpus:

1. a part of the corpus (see ``parts``) adds its texts to a counting Bloom filter: two cells in the block that the
   text's hash names. It sends the cells it touched, once or more often, and a task for each block merges those of
   all parts and answers every part which of its cells count twice or more;
2. a text with a cell that counts once is unique for certain and is cleared. Only the others, the possible
   repeats, are shuffled, each once a part, and grouped by their full text, which gives the smallest id exactly;
3. the five flags of a document are one mask. Rows are counted by (part, mask, label), and all removals, in any
   order of the filters, are sums over at most 32 masks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common, parts, spans

FILTERS = "ABCDE"
_SAME = 1 << FILTERS.index("E")
U64 = np.uint64
BLOCK_BITS = 20  # cells of a block of the sketch
LOAD = 8  # cells a text
PART_BYTES = 16 << 20


# ------------------------------------------------------------- the sketch

def hashes(texts: spans.Texts) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(texts.bytes(i)) for i in range(len(texts))], dtype=U64)


def cells(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, first cell, second cell) of each hash; both cells are in the block."""
    mixed = spans.mix(h)
    keep = U64((1 << BLOCK_BITS) - 1)
    return (h % U64(blocks)).astype(np.int64), mixed & keep, (mixed >> U64(32)) & keep


class _Cells:
    """The cells that one part touches: ``own`` in ascending order (block and cell), ``count`` of each, and the
    places of both cells of every text in them."""

    def __init__(self, table: pa.Table, blocks: int):
        block, a, b = cells(hashes(spans.texts_of(parts.column(table, "text"))), blocks)
        head = block.astype(U64) << U64(BLOCK_BITS)
        self.own, place, _ = spans.group(np.concatenate([head | a, head | b]))
        self.a, self.b = place[:len(a)], place[len(a):]
        second = self.b[self.a != self.b]  # a text whose cells are one and the same counts once there
        self.count = np.bincount(self.a, minlength=len(self.own)) + np.bincount(second, minlength=len(self.own))

    def blocks(self) -> Iterator[tuple[int, int, int]]:
        return parts.slices((self.own >> U64(BLOCK_BITS)).astype(np.int64))

    def asked(self) -> Iterator[tuple]:
        for block, i, j in self.blocks():
            yield (0, block, common.pack_sorted(self.own[i:j] & U64((1 << BLOCK_BITS) - 1)),
                   np.packbits(self.count[i:j] > 1).tobytes())

    def possible(self, replies: dict[int, bytes]) -> np.ndarray:
        """Whether each text may be repeated: both of its cells count twice or more over all parts."""
        twice = np.concatenate([np.zeros(0, bool)] + [
            np.unpackbits(np.frombuffer(replies[block], dtype=np.uint8), count=j - i).astype(bool)
            for block, i, j in self.blocks()])
        return twice[self.a] & twice[self.b]


def merge_block(keys: list[bytes], extras: list[bytes]) -> list[bytes]:
    """Merge one block over all parts (a cell counts up to two); tell each part which of its cells count twice."""
    total = np.zeros(1 << BLOCK_BITS, dtype=np.uint8)
    for k, twice in zip(keys, extras, strict=True):
        own = common.unpack_sorted(k)
        total[own] = np.minimum(total[own] + 1 + np.unpackbits(np.frombuffer(twice, dtype=np.uint8), count=len(own)), 2)
    return [np.packbits(total[common.unpack_sorted(k)] >= 2).tobytes() for k in keys]


# ------------------------------------------------------------- flags

def own_flags(texts: spans.Texts, min_words: int, distinct_percent: int, upper_percent: int, symbols: str) -> np.ndarray:
    """The mask of the filters that judge a text by itself (A to D, the lowest bits)."""
    data, offs = texts

    def count(marked: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(marked)])[offs])

    table = np.zeros(256, dtype=bool)
    table[list(symbols.encode())] = True
    few, same = np.zeros(len(texts), dtype=bool), np.zeros(len(texts), dtype=bool)
    for i in range(len(texts)):
        words = texts.bytes(i).split()  # bytes.split: the white space of the word rule
        few[i], same[i] = len(words) < min_words, 100 * len(set(words)) < distinct_percent * len(words)
    upper = 100 * count((data >= 65) & (data <= 90)) > upper_percent * count((data & 0xC0) != 0x80)
    marked = count(table[data]) > 0
    return few + 2 * same + 4 * upper + 8 * marked


def flags(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", min_words: int = 100,
          distinct_percent: int = 80, upper_percent: int = 10, symbols: str = "#$%&*|") -> DataFrame:
    """Per row of ``docs``: ``doc`` (the id), ``part`` (null: empty string) and ``mask``, a bit for each filter it
    fails, A the lowest: A fewer than ``min_words`` words (runs of ``[^\\x20\\x09-\\x0D]``), B distinct words below
    ``distinct_percent`` of all, C more than ``upper_percent`` of the code points are A-Z, D a character of
    ``symbols`` (ASCII), E a row with the same text and a smaller id.

    A null text is an empty one. A null id is larger than all others, so such a row fails E if any row with an id
    holds its text, and makes no other fail. Rows that share an id and a text do not fail E by each other. An
    empty table gives an empty table; other columns are ignored.
    """
    text_id = docs.schema[id_col].dataType.typeName() == "string"
    kind, ids = ("string", pa.string()) if text_id else ("long", pa.int64())
    corpus = parts.copy(docs, {"doc": F.col(id_col).cast(kind), "text": F.coalesce(text_col, F.lit("")),
                               "part": F.coalesce(F.col(part_col).cast("string"), F.lit(""))})
    blocks = max(1, -(-corpus.n_rows * LOAD >> BLOCK_BITS))
    asked = parts.ask(corpus, ["text"], lambda _, table: _Cells(table, blocks).asked(), PART_BYTES)
    sketch = parts.Answers(parts.answer(asked, lambda kind, block, keys, extras: merge_block(keys, extras)), "bloom")

    def judged(seed: int) -> tuple[DataFrame, DataFrame]:
        """(doc, part, mask without E, key of a possible repeat or null; key, first id of each text)."""
        import xxhash

        def key_of(raw: bytes) -> bytes:
            return xxhash.xxh3_128_digest(raw, seed)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, table in parts.parts_of(batches, PART_BYTES):
                texts = spans.texts_of(parts.column(table, "text"))
                maybe = _Cells(table, blocks).possible(sketch.of(part).get(0, {}))
                keys = [key_of(texts.bytes(i)) if m else None for i, m in enumerate(maybe.tolist())]
                mask = own_flags(texts, min_words, distinct_percent, upper_percent, symbols)
                yield pa.RecordBatch.from_arrays(
                    [parts.column(table, "doc").cast(ids), parts.column(table, "part").cast(pa.string()),
                     pa.array(mask.astype(np.int32)), pa.array(keys, pa.binary())], names=["doc", "part", "mask", "key"])

        def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, table in parts.parts_of(batches, PART_BYTES):
                texts = spans.texts_of(parts.column(table, "text"))
                least: dict[bytes, object] = {}
                docs_ = parts.column(table, "doc").to_pylist()
                for i in np.flatnonzero(_Cells(table, blocks).possible(sketch.of(part).get(0, {}))).tolist():
                    raw = texts.bytes(i)
                    least[raw] = min((d for d in (least.get(raw), docs_[i]) if d is not None), default=None)
                if least:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key_of(t) for t in least], pa.binary()), pa.array(list(least), pa.binary()),
                         pa.array(list(least.values()), ids)], names=["key", "text", "doc"])

        own = corpus.map(judge, ["doc", "text", "part"], f"doc {kind}, part string, mask int, key binary")
        shuffled = corpus.map(repeats, ["doc", "text"], f"key binary, text binary, doc {kind}")
        firsts = shuffled.groupBy("key", "text").agg(F.min("doc").alias("first")).select("key", "first")
        return own, common.store(firsts, "first-ids")

    for seed in range(8):
        own, firsts = judged(seed)
        # full texts were grouped: two texts under one 128-bit key show as two rows, and another seed is taken
        if firsts.groupBy("key").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("different texts share a 128-bit key under every seed")
    own = common.store(own, "filter-flags")
    # unique texts have no key and are not shuffled for the join
    cleared = own.where("key is null").drop("key")
    again = own.where("key is not null").join(firsts, "key")
    later = F.col("first").isNotNull() & (F.col("doc").isNull() | (F.col("first") < F.col("doc")))
    return cleared.unionByName(again.select("doc", "part", (F.col("mask") + F.when(later, _SAME).otherwise(0)).alias("mask")))


# ------------------------------------------------------------- the audit

def _steps() -> Column:
    """The rows (filter_order, step, bit of its filter, bits of the filters before it) of all orders."""
    rows = [{"filter_order": "".join(p), "step": k + 1, "bit": 1 << FILTERS.index(p[k]),
             "before": sum(1 << FILTERS.index(x) for x in p[:k])} for p in permutations(FILTERS) for k in range(len(p))]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order string, step int, bit int, before int>>")


def counted(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id", good: str = "quality", bad: str = "toxic") -> DataFrame:
    """``(part, mask, n, good, toxic)``: rows of each mask, and how many of them ``labels`` calls good and toxic."""
    kind = masks.schema["doc"].dataType.simpleString()
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast(kind).alias("doc")).agg(
        F.max((F.col(good) == 1).cast("int")).alias("good"), F.max((F.col(bad) == 1).cast("int")).alias("toxic"))
    said = common.store(said, "labels")  # stored, so that the adaptive join can split an id that is everywhere
    known = masks.where("doc is not null").join(said, "doc", "left")
    none = masks.where("doc is null").withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    return known.unionByName(none).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")))


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_id_col: str = "doc_id", **options) -> DataFrame:
    """For each part, each order of the five filters of ``flags`` and each step: ``kept`` (rows left after it),
    ``removed`` (by it), ``redundant`` (fail its filter but were removed before), ``unique_fails`` (fail its filter
    alone), ``good_lost`` and ``toxic_lost`` (removed rows that ``labels`` gives quality 1, toxic 1) and ``shapley``
    (its filter's removals summed over all 120 orders).

    Steps that remove nothing have their row. Where ``labels`` repeats an id, one row that says so is enough; ids
    without a label, null labels and null ids count as neither. An empty table of documents has no part and gives
    no row.
    """
    table = common.store(counted(flags(docs, id_col=id_col, **options), labels, label_id_col), "mask-counts")
    # at most 32 masks a part
    each = table.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = each.select("part", "masks", F.inline(_steps()))

    def total(value: str, when) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"),
                           lambda s, m: s + F.when(when(m["mask"]), m[value]).otherwise(F.lit(0).cast("long")))

    bit, before = F.col("bit"), F.col("before")
    fails = lambda mask: mask.bitwiseAND(bit) != 0
    gone = lambda mask: mask.bitwiseAND(before) != 0
    here = lambda mask: fails(mask) & ~gone(mask)
    # of the orders of the filters that a row fails, an equal share has this one first
    orders = len(list(permutations(FILTERS)))
    shapley = F.aggregate("masks", F.lit(0).cast("long"), lambda s, m: s + F.when(
        fails(m["mask"]), (m["n"] * F.try_divide(F.lit(orders), F.bit_count(m["mask"]))).cast("long")).otherwise(F.lit(0).cast("long")))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda mask: mask.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda mask: fails(mask) & gone(mask)).alias("redundant"),
        total("n", lambda mask: mask == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        shapley.alias("shapley"))
