"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 7).

Two fingerprints within ``radius`` bits share a value that lies within half the radius of both. So
every distinct fingerprint emits all its variants with up to ``radius // 2`` flipped bits (the radius is
even), and fingerprints that meet in a variant are linked. The shuffle is on the variants' leading
bits: a fingerprint sends one row for each way of flipping those, with the flips that are left, and the
task that receives a prefix expands the remaining bits, finds the variants that several fingerprints
share, verifies the distance and deduplicates the links. With a 16-bit prefix and radius 4 that is 137
rows a fingerprint instead of 2081, for the same variants.

All fingerprints in a variant are within the radius of each other, so linking each to the smallest one
keeps every connection without pairs within the group. Prefixes that very many fingerprints share (near copies by
the million) are found by a count before anything is sent; what meets in them goes on to longer prefixes, which are
shuffle keys of their own, until no prefix is crowded. Within a task a prefix is expanded in slices of its variants.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common, spans
from strata.llm.components import components

_RUN = 1 << 16  # shingles hashed at a time
_DEEPER = 8  # bits by which an overfull prefix is sliced, or a crowded one made longer
CROWDED = 1 << 14  # distinct fingerprints of one prefix from which on it is made longer


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of a text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, ``shingle``-word shingles
    with repeats (fewer words: the whole sequence; none: 0). A bit is set if it is in over half of the
    shingles' XXH64 (seed 42)."""
    import xxhash

    words = raw.lower().split()  # bytes.split: the white space of the word rule
    if not words:
        return 0
    text = b" ".join(words)
    k = min(shingle, len(words))
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lens + 1) - lens - 1
    n = len(words) - k + 1
    starts, ends = starts[:n], (starts + lens)[k - 1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, n, _RUN):
        spans_ = zip(starts[i:i + _RUN].tolist(), ends[i:i + _RUN].tolist(), strict=True)
        h = b"".join([digest(text[a:b], 42) for a, b in spans_])
        ones += np.unpackbits(np.frombuffer(h, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(doc, version, fp)``, stored: the text's hash and the fingerprint of every row as a signed 64-bit integer."""
    text_id = docs.schema[id_col].dataType.typeName() == "string"
    ident = F.col(id_col) if text_id else F.col(id_col).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = spans.texts_of(b.column(2))
            fp = np.array([fingerprint(texts.bytes(i), shingle) for i in range(len(texts))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=["doc", "version", "fp"])

    rows = docs.select(ident.alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    return common.store(rows.mapInArrow(run, f"doc {'string' if text_id else 'long'}, version long, fp long"), "fingerprints")


def _masks(lo: int, hi: int, flips: int) -> np.ndarray:
    """All 64-bit masks with exactly ``flips`` bits set among bits lo..hi-1."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(lo, hi), flips)], dtype=np.uint64)


@lru_cache(maxsize=None)
def _low_masks(bits: int, flips: int) -> np.ndarray:
    """All masks with up to ``flips`` bits set among the lowest ``bits``."""
    return np.concatenate([_masks(0, bits, t) for t in range(flips + 1)])


SENT = "at long, fp long, flips byte"


def _deeper(batches: Iterator[pa.RecordBatch], depth: int, step: int) -> Iterator[pa.RecordBatch]:
    """Rows (prefix of ``depth`` bits, fingerprint, flips left) as rows for prefixes of ``step`` more bits: one for
    each value of those bits that the flips allow."""
    values = np.arange(1 << step, dtype=np.uint64)
    for b in batches:
        for i in range(0, b.num_rows, 4096):
            at, fp = (np.asarray(b.column(k)[i:i + 4096]).view(np.uint64) for k in (0, 1))
            left = np.asarray(b.column(2)[i:i + 4096])
            bits = (fp >> np.uint64(64 - depth - step)) & np.uint64((1 << step) - 1)
            need = np.bitwise_count(bits[:, None] ^ values[None, :]).astype(np.int8)
            row, value = np.nonzero(need <= left[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(((at[row] << np.uint64(step)) | value.astype(np.uint64)).view(np.int64)),
                 pa.array(fp[row].view(np.int64)), pa.array(left[row] - need[row, value])], names=["at", "fp", "flips"])


def dealt(fps: DataFrame, sent: DataFrame, prefix: int, half: int, crowded: int) -> list[tuple[int, DataFrame]]:
    """(depth, rows): what is sent, with longer prefixes wherever more than ``crowded`` fingerprints share one of
    ``depth`` bits or one of those that are up to ``half`` flips away. A row for each crowded prefix is stored."""
    out, depth = [], prefix
    while True:
        step = min(_DEEPER, 64 - depth)
        own = F.shiftrightunsigned("fp", 64 - depth) if depth < 64 else F.col("fp")
        hot = common.store(fps.groupBy(own.alias("at")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded).select("at"), "crowded")
        if step <= 0 or hot.isEmpty():
            return [*out, (depth, sent)]
        masks = np.concatenate([_masks(0, depth, t) for t in range(half + 1)]).view(np.int64)
        near = hot.mapInArrow(lambda batches, masks=masks: (pa.RecordBatch.from_arrays(
            [pa.array((np.asarray(b.column(0))[i:i + 1024, None] ^ masks[None, :]).ravel())], names=["at"])
            for b in batches for i in range(0, b.num_rows, 1024)), "at long").distinct()
        near, _ = common.small_side(common.store(near, "crowded-near"))
        out.append((depth, sent.join(near, "at", "left_anti")))
        sent = sent.join(near, "at", "left_semi").mapInArrow(lambda batches, d=depth, k=step: _deeper(batches, d, k), SENT)
        depth += step


def linked(fps: DataFrame, radius: int = 4, prefix: int | None = None, budget: int = 1 << 20,
           crowded: int = CROWDED) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``): every two within ``radius`` bits are
    connected by links, and every link joins two within it. ``radius`` is even; ``budget`` is the number of
    variants a task expands at a time; ``crowded`` the fingerprints of a prefix from which on it is made longer."""
    if radius % 2:
        raise ValueError("the radius must be even")
    half = radius // 2
    if prefix is None:
        # a prefix of more bits as fingerprints grow, so that those that meet in one stay some hundreds
        prefix = int(np.clip(np.log2(max(fps.count(), 1) / 4) if half else 16, 8, 32))
    masks = [(_masks(64 - prefix, 64, t), t) for t in range(half + 1)]
    top = np.concatenate([m for m, _ in masks])
    left = np.concatenate([np.full(len(m), half - t, dtype=np.int8) for m, t in masks])
    shift = np.uint64(64 - prefix)
    sent = pa.schema([("at", pa.int64()), ("fp", pa.int64()), ("flips", pa.int8())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0)).view(np.uint64)
            for i in range(0, len(fp), 1024):
                x = fp[i:i + 1024]
                at = ((x[:, None] ^ top[None, :]) >> shift).astype(np.int64).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(np.repeat(x, len(top)).view(np.int64)),
                     pa.array(np.tile(left, len(x)))], schema=sent)

    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(at: np.ndarray, fp: np.ndarray, flips: np.ndarray, depth: int) -> Iterator[pa.RecordBatch]:
        """Links among the rows of some whole prefixes of ``depth`` bits: expand, sort the variants, link
        each run of equals."""
        keep = np.uint64((1 << (64 - depth)) - 1)
        head = at << np.uint64(64 - depth)
        variants, rows = [], []
        for f in range(half + 1):
            own, low = np.flatnonzero(flips == f), _low_masks(64 - depth, f)
            variants.append(((head[own] | (fp[own] & keep))[:, None] ^ low[None, :]).ravel())
            rows.append(np.repeat(own, len(low)))
        variant, row = spans.mix(np.concatenate(variants)), np.concatenate(rows)  # mix is one to one
        order = spans.order_of(variant)
        variant = variant[order]
        same = variant[1:] == variant[:-1]
        if not same.any():
            return
        hit = np.zeros(len(order), dtype=bool)
        hit[1:] |= same
        hit[:-1] |= same
        run = np.concatenate([[0], np.cumsum(variant[hit][1:] != variant[hit][:-1])])
        b = fp[row[order[hit]]]
        first = np.full(run[-1] + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
        np.minimum.at(first, run, b)
        a = first[run]
        ok = (a != b) & (np.bitwise_count(a ^ b) <= radius)  # the verified distance
        pairs = np.unique(np.stack([a[ok], b[ok]], axis=1).view(np.int64), axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], schema=links)

    def whole(at, fp, flips, depth: int) -> Iterator[pa.RecordBatch]:
        """``meet`` over runs of whole prefixes (rows are sorted by prefix) of about ``budget`` variants;
        a prefix beyond it is sliced by the next bits of its variants."""
        cost = np.array([len(_low_masks(64 - depth, f)) for f in range(half + 1)])
        begins = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]])
        total = np.concatenate([[0], np.cumsum(cost[flips])])[begins]
        i = 0
        while i < len(begins) - 1:
            j = max(i + 1, int(np.searchsorted(total, total[i] + budget, side="right")) - 1)
            a, b = begins[i], begins[j]
            if total[j] - total[i] > budget and depth < 64:
                yield from sliced(at[a], fp[a:b], flips[a:b], depth)
            else:
                yield from meet(at[a:b], fp[a:b], flips[a:b], depth)
            i = j

    def sliced(at, fp, flips, depth: int) -> Iterator[pa.RecordBatch]:
        """``whole`` over the rows of one prefix, one value of the next bits at a time."""
        step = min(_DEEPER, 64 - depth)
        bits = (fp >> np.uint64(64 - depth - step)) & np.uint64((1 << step) - 1)
        for value in range(1 << step):
            need = np.bitwise_count(bits ^ np.uint64(value)).astype(np.int8)
            own = np.flatnonzero(need <= flips)
            if len(own) > 1:
                deeper = np.full(len(own), (int(at) << step) | value, dtype=np.uint64)
                yield from whole(deeper, fp[own], flips[own] - need[own], depth + step)

    def collide(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            now = [np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1)).view(np.uint64),
                   np.asarray(batch.column(2))]
            if held is not None:
                now = [np.concatenate([h, x]) for h, x in zip(held, now, strict=True)]
            last = int(np.searchsorted(now[0], now[0][-1]))  # this prefix may go on in the next batch
            if last:
                yield from whole(*(x[:last] for x in now), depth)
            held = [x[last:] for x in now]
        if held is not None:
            yield from whole(*held, depth)

    met = [rows.repartition("at").sortWithinPartitions("at").mapInArrow(
        lambda batches, depth=depth: collide(batches, depth), "a long, b long")
        for depth, rows in dealt(fps, fps.select("fp").mapInArrow(emit, SENT), prefix, half, crowded)]
    return reduce(DataFrame.unionByName, met).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``fp`` (signed 64-bit fingerprint), ``component_id`` (the smallest id
    reachable over links between fingerprints at most ``radius`` bits apart, its own included).

    Equal fingerprints are one node (pre-aggregated, so a large group of copies is one row before any
    expansion). Null and empty texts have fingerprint zero and are linked like any other; repeated rows
    are all returned; null ids are kept and name no component unless it has no other id. An empty table
    gives an empty result. Other columns are ignored.
    """
    found = _named(docs, id_col, text_col, shingle, radius)
    return found.select(F.col("doc").alias(id_col), "fp", "component_id")


def _named(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """``(doc, version, fp, component_id)`` of every row."""
    prints = fingerprints(docs, id_col, text_col, shingle)
    classes = common.store(prints.groupBy("fp").agg(F.min("doc").alias("first")), "fingerprint-classes")
    links = common.store(linked(classes, radius), "fingerprint-links")
    roots = components(links, "a", "b")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = common.store(rooted, "fingerprint-roots")
    # stored: a component of very many fingerprints is split by the adaptive join
    least = common.store(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc", "version", "fp", "component_id")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               radius: int = 4) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id. Of rows that share an id, those
    whose own component has that smallest id are kept; rows without an id are kept if their component has no
    other id. Texts of one id are told apart by a 64-bit hash."""
    found = _named(docs, id_col, text_col, shingle, radius)
    key, version = common.internal(docs, "__kept", "__version")
    stay = found.where(F.col("doc").eqNullSafe(F.col("component_id"))).select(
        F.col("doc").alias(key), F.col("version").alias(version)).distinct()
    own = F.col(id_col) if docs.schema[id_col].dataType.typeName() == "string" else F.col(id_col).cast("long")
    return docs.join(stay, own.eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(version)), "left_semi")
