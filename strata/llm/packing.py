"""Packing along a space-filling curve (operator 1).

Each document's hashed bag of words is projected to a few dimensions with a fixed
integer matrix, the mean projection is a point on a grid, and the point's place on
the Hilbert curve is the document's key. Documents are range-sorted by that key, so
neighbours on the curve meet in one task, and each task cuts its stream of ids into
sequences: documents that are alike share a sequence.

One shuffle carries the texts; nothing is gathered in one place. A task's stream is cut
every ``seq_len`` ids; what is left at its end is cut at powers of two (11 sequences at
most for 2048), so no sequence needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common, spans
from strata.llm.tokens import encoder

BUCKETS = 4096


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of grid points (rows; each coordinate below 2**bits; dims * bits <= 63).

    Skilling's transform (Programming the Hilbert curve, 2004): undo the excess rotations from the
    highest bit down, Gray-encode, then interleave the bits.
    """
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for d in range(dims):
            swap = (x[:, d] & q) == 0
            t = np.where(swap, (x[:, 0] ^ x[:, d]) & low, 0)
            x[:, 0] = np.where(swap, x[:, 0], x[:, 0] ^ low)
            x[:, 0] ^= t
            x[:, d] ^= t
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    t = np.zeros(len(x), dtype=np.int64)
    for b in range(bits - 1, 0, -1):
        t ^= np.where(x[:, dims - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= t[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> b) & 1)
    return key


def projection(dims: int, seed: int = 7) -> np.ndarray:
    """The fixed BUCKETS x dims matrix; integers, so that sums do not depend on their order."""
    return np.random.default_rng(seed).integers(-1023, 1024, size=(BUCKETS, dims), dtype=np.int64)


def curve_keys(column: pa.Array, matrix: np.ndarray, bits: int, step: int = 1 << 20) -> np.ndarray:
    """Hilbert keys of the texts of an Arrow column (no words: the centre of the grid)."""
    texts = spans.texts_of(column)
    out = np.empty(len(texts), dtype=np.int64)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(texts.offsets, texts.offsets[row] + step, side="right")) - 1)
        o = texts.offsets[row:to + 1]
        run = spans.Texts(texts.data[o[0]:o[-1]], o - o[0])
        starts, ends, first = spans.words(run)
        bucket = (spans.hash_spans(run.data, starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
        n = np.diff(first)
        point = np.empty((to - row, matrix.shape[1]), dtype=np.int64)
        for d in range(matrix.shape[1]):
            total = np.concatenate([[0], np.cumsum(matrix[bucket, d])])[first]
            point[:, d] = ((np.diff(total) << (bits - 11)) // np.maximum(n, 1)) + (1 << (bits - 1))
        out[row:to] = hilbert_key(point, bits)
        row = to
    return out


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 2048,
         end_id: int = 1, dims: int = 4, bits: int = 12, with_ids: bool = False) -> DataFrame:
    """Pack whole documents (their ids, then ``end_id``) into sequences of at most ``seq_len`` ids.

    Returns a row per piece of a document: ``id_col``, ``start`` (ids of the document before the piece),
    ``length``, ``ids_crc32`` (unsigned crc32 of the piece's ids as little-endian unsigned 32-bit
    integers), ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, ``curve_key`` and, if asked
    for, ``ids``. Every id lies in one piece; a sequence's pieces follow each other without gaps.

    Null and empty texts hold the end id alone. Repeated rows are all packed. Null ids are kept (and
    sort first among equals). An empty table gives no piece. Other columns are ignored.
    """
    key, ident, text = "curve_key", *common.internal(docs.limit(0), "__id", "__text")
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias(ident), F.col(text_col).alias(text))
    id_arrow = pa.string() if id_type.typeName() == "string" else pa.int64()
    id_sql = "string" if id_arrow == pa.string() else "long"
    rows = rows.withColumn(ident, F.col(ident).cast(id_sql))
    matrix = projection(dims)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(curve_keys(b.column(1), matrix, bits))],
                    names=[ident, text, key])

    # equal keys (copies) are told apart by id and text, so a large group of copies is spread over tasks
    order = [F.col(key), F.col(ident), F.xxhash64(text)]
    ordered = (rows.mapInArrow(keyed, f"`{ident}` {id_sql}, `{text}` string, {key} long")
               .repartitionByRange(*order).sortWithinPartitions(*order, F.col(text)))
    schema = pa.schema([(id_col, id_arrow)] + [(c, pa.int64()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", key)]
        + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        add, flush = common.arrow_rows(schema)
        enc = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 32
        end = np.array([end_id], dtype="<u4")
        open_, held = [], 0  # pieces of the sequence that is being filled: (id, start, ids, doc_tokens, key)

        def emit(pieces: list) -> Iterator[pa.RecordBatch]:
            at = 0
            for ident_, start, ids, total, k in pieces:
                row = (ident_, start, len(ids), zlib.crc32(ids), total, sequence, at, k)
                yield from add((*row, ids.tolist()) if with_ids else row)
                at += len(ids)

        for batch in batches:
            names, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, every, offs in enc.encode(batch.column(1)):
                offs = offs.tolist()
                for i in range(len(offs) - 1):
                    ids = np.concatenate([every[offs[i]:offs[i + 1]].astype("<u4"), end])
                    a = 0
                    while a < len(ids):
                        b = min(len(ids), a + seq_len - held)
                        open_.append((names[row + i], a, ids[a:b], len(ids), keys[row + i]))
                        held += b - a
                        a = b
                        if held == seq_len:
                            yield from emit(open_)
                            sequence += 1
                            open_, held = [], 0
        # the rest of the task: sequences whose lengths are powers of two
        while held:
            room, now = 1 << (held.bit_length() - 1), []
            held -= room
            while room:
                ident_, start, ids, total, k = open_.pop(0)
                now.append((ident_, start, ids[:room], total, k))
                if len(ids) > room:
                    open_.insert(0, (ident_, start + room, ids[room:], total, k))
                room -= len(now[-1][2])
            yield from emit(now)
            sequence += 1
        yield from flush()

    columns = [f"`{id_col}` {id_sql}"] + [f"{f.name} long" for f in schema if f.name not in (id_col, "ids")]
    return ordered.mapInArrow(cut, ", ".join(columns + ["ids array<int>"] * with_ids))
