"""Token-ID output: fixed-width bit packing with block offsets (operator 6).

File format (little endian), one file per task, documents in ascending id order::

    b"SBID" | version u16 | bits u16 | block u32 | end id u32     16-byte header
    block 0 | block 1 | ...            each: ``block`` ids, ``bits`` bits per id, lowest bit first,
                                       padded to whole bytes (the last block may hold fewer ids)
    block offsets u64[n_blocks + 1]    byte positions in the file
    document ids (i64, or length-prefixed UTF-8 for strings), null flags u8[n_docs]
    document ends u64[n_docs]          ids in the file up to and with each document
    footer position u64 | n_docs u64 | n_ids u64 | kind u64 | b"SBID"

``bits`` is the least width that holds every id of the vocabulary and the end id. Eight
ids fill ``bits`` bytes, so packing and unpacking are a few shifts over whole columns,
and any range of ids is read by seeking to its blocks.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common
from strata.llm.tokens import encoder

MAGIC = b"SBID"
_HEADER = struct.Struct("<4sHHII")
_TRAILER = struct.Struct("<QQQQ4s")


def width(vocab: int, end_id: int) -> int:
    return max(1, int(max(vocab - 1, end_id)).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, lowest bit first, padded to whole bytes."""
    n = len(ids)
    lanes = np.zeros((-(-n // 8), 8), dtype=np.uint64)
    lanes.ravel()[:n] = ids
    out = np.zeros((len(lanes), bits), dtype=np.uint8)
    for k in range(8):
        at, shift = divmod(k * bits, 8)
        v = lanes[:, k] << np.uint64(shift)
        for j in range(-(-(bits + shift) // 8)):
            out[:, at + j] |= (v >> np.uint64(8 * j)).astype(np.uint8)
    return out.tobytes()[: -(-n * bits // 8)]


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a packed block, as uint32."""
    raw = np.zeros(-(-n // 8) * bits, dtype=np.uint8)
    raw[: -(-n * bits // 8)] = np.frombuffer(data, dtype=np.uint8, count=-(-n * bits // 8))
    raw = raw.reshape(-1, bits)
    out = np.empty((len(raw), 8), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(8):
        at, shift = divmod(k * bits, 8)
        v = np.zeros(len(raw), dtype=np.uint64)
        for j in range(-(-(bits + shift) // 8)):
            v |= raw[:, at + j].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = ((v >> np.uint64(shift)) & mask).astype(np.uint32)
    return out.ravel()[:n]


class Writer:
    """Streams documents into one file; holds one block of ids and the document table."""

    def __init__(self, stream, bits: int, end_id: int, block: int):
        self.stream, self.bits, self.block = stream, bits, block
        stream.write(_HEADER.pack(MAGIC, 1, bits, block, end_id))
        self.offsets, self.pending, self.held = [_HEADER.size], [], 0
        self.doc_ids, self.ends, self.n_ids = [], [], 0

    def _write(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.stream.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def add(self, doc_ids: list, ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents with their ids one after the other; ``ends``: positions in ``ids`` after each."""
        self.doc_ids += doc_ids
        self.ends.append(ends.astype("<u8") + np.uint64(self.n_ids))
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            every = np.concatenate(self.pending)
            full = len(every) // self.block * self.block
            for a in range(0, full, self.block):
                self._write(every[a:a + self.block])
            self.pending, self.held = [every[full:]], len(every) - full

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.pending))
        at = self.offsets[-1]
        text = any(isinstance(x, str) for x in self.doc_ids)
        self.stream.write(np.array(self.offsets, dtype="<u8").tobytes())
        if text:
            for x in self.doc_ids:
                raw = (x or "").encode()
                self.stream.write(len(raw).to_bytes(4, "little") + raw)
        else:
            self.stream.write(np.array([x or 0 for x in self.doc_ids], dtype="<i8").tobytes())
        self.stream.write(bytes(x is None for x in self.doc_ids))
        self.stream.write(np.concatenate([np.zeros(0, "<u8"), *self.ends]).tobytes())
        self.stream.write(_TRAILER.pack(at, len(self.doc_ids), self.n_ids, int(text), MAGIC))


class Reader:
    """Random access to one file: ``docs()`` in order, ``ids(a, b)`` for any range of ids."""

    def __init__(self, stream, size: int):
        self.stream = stream
        stream.seek(0)
        magic, _, self.bits, self.block, self.end_id = _HEADER.unpack(stream.read(_HEADER.size))
        stream.seek(size - _TRAILER.size)
        at, n_docs, self.n_ids, text, tail = _TRAILER.unpack(stream.read(_TRAILER.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError("not a packed id file")
        stream.seek(at)
        foot = stream.read(size - _TRAILER.size - at)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(foot, "<u8", n_blocks + 1)
        p = 8 * (n_blocks + 1)
        if text:
            ids = []
            for _ in range(n_docs):
                k = int.from_bytes(foot[p:p + 4], "little")
                ids.append(foot[p + 4:p + 4 + k].decode())
                p += 4 + k
        else:
            ids = np.frombuffer(foot, "<i8", n_docs, p).tolist()
            p += 8 * n_docs
        self.doc_ids = [None if null else x for x, null in zip(ids, foot[p:p + n_docs], strict=True)]
        self.ends = np.frombuffer(foot, "<u8", n_docs, p + n_docs).astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids ``a`` to ``b`` of the file; reads only the blocks that hold them."""
        if a >= b:
            return np.zeros(0, np.uint32)
        first, last = a // self.block, (b - 1) // self.block
        lo, hi = int(self.offsets[first]), int(self.offsets[last + 1])
        self.stream.seek(lo)
        raw = self.stream.read(hi - lo)
        out = []
        for k in range(first, last + 1):
            n = min(self.block, self.n_ids - k * self.block)
            out.append(unpack(raw[int(self.offsets[k]) - lo:int(self.offsets[k + 1]) - lo], n, self.bits))
        return np.concatenate(out)[a - first * self.block:b - first * self.block]

    def runs(self, step: int = 1 << 20) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """(document ids, ids, positions after each document) for runs of documents of about ``step`` ids."""
        i, n = 0, len(self.doc_ids)
        while i < n:
            start = int(self.ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(self.ends, start + step, side="right")))
            yield self.doc_ids[i:j], self.ids(start, int(self.ends[j - 1])), self.ends[i:j] - start
            i = j


def write_ids(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
              path: str | None = None, block: int = 1 << 16) -> DataFrame:
    """Encode whole texts and write them as packed id files in ascending ``id_col`` order.

    Returns the manifest, a stored table with a row per file: ``part`` (order of the files),
    ``file``, ``n_docs``, ``n_ids``. Only files it lists are valid: a task that is run again
    writes a file of another name, and the manifest holds the attempt that was committed.

    Null ids come first; rows with equal ids are all kept, ordered by their text. Null and
    empty texts hold the end id alone. An empty table gives an empty manifest.
    """
    path = path or common.scratch_path(docs.sparkSession, "token-ids")
    fs, base = common.filesystem(path)
    fs.create_dir(base)
    key, text = common.internal(docs.limit(0), "__id", "__text")
    rows = docs.select(F.col(id_col).alias(key), F.col(text_col).alias(text))
    tie = F.xxhash64(text)  # rows of one id may go to several tasks; their order is that of this hash
    ordered = rows.repartitionByRange(F.col(key), tie).sortWithinPartitions(F.col(key), tie, F.col(text))
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = None
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype=np.uint32)
        files, dir_ = common.filesystem(path)
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex[:12]}.sbid"
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if writer is None:
                stream = files.open_output_stream(f"{dir_}/{name}")
                writer = Writer(stream, width(enc.vocab, end_id), end_id, block)
            names = batch.column(0).to_pylist()
            for row, ids, offs in enc.encode(batch.column(1)):
                n = len(offs) - 1
                at = np.asarray(offs[1:])
                every = np.insert(ids.astype(np.uint32), at, end[0])
                writer.add(names[row:row + n], every, at + np.arange(1, n + 1))
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array([len(writer.doc_ids)], pa.int64()),
                 pa.array([writer.n_ids], pa.int64())], schema=schema)

    manifest = ordered.mapInArrow(write, "part int, file string, n_docs long, n_ids long")
    return common.store(manifest.withColumn("file", F.concat(F.lit(path + "/"), "file")), "token-ids-manifest")


def read_ids(manifest: DataFrame, id_type: str = "long", *, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document, read back from the files: ``id_col``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` (unsigned crc32 of its ids as little-endian unsigned 32-bit integers) and,
    if asked for, ``ids``. Starts of files are running sums over the manifest (a row per file)."""
    from pyspark.sql import Window as W

    spark = manifest.sparkSession
    before = F.coalesce(F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    n_files = manifest.count()
    files = manifest.withColumn("start", before).repartition(max(1, n_files), "part")
    out = f"`{id_col}` {id_type}, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    schema = pa.schema([(id_col, pa.string() if id_type == "string" else pa.int64()), ("start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                       + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, flush = common.arrow_rows(schema)
        for batch in batches:
            for f in batch.to_pylist():
                fs, p = common.filesystem(f["file"])
                with fs.open_input_file(p) as stream:
                    reader = Reader(stream, stream.size())
                    start = f["start"]
                    for names, ids, ends in reader.runs():
                        data = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                        a = 0
                        for name, b in zip(names, ends.tolist(), strict=True):
                            row = (name, start + a, b - a, zlib.crc32(data[4 * a:4 * b]))
                            yield from add((*row, ids[a:b].tolist()) if with_ids else row)
                            a = b
                        start += a
        yield from flush()

    del spark
    return files.select("file", "start").mapInArrow(read, out)
