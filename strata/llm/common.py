"""Helpers shared by the operators: column names, shared files, compact blobs, bounded broadcasts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, store, table_path

__all__ = ["scratch_path", "store", "read_table", "internal", "filesystem", "shared_delete",
           "small_side", "pack_sorted", "unpack_sorted", "compress", "decompress", "arrow_rows"]

#: Rows and bytes up to which a side may be broadcast (both are measured first; beyond either it shuffles).
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def internal(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that clash with no column of ``df`` (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` with a broadcast hint if it holds at most ``rows`` rows of at most ``size`` bytes in all (both
    are measured; pass a stored frame), else ``df`` itself, which then joins by shuffle."""
    width = F.octet_length(F.to_json(F.struct("*"))).cast("long").alias("width")
    n, total = df.select(width).limit(rows + 1).agg(F.count(F.lit(1)), F.sum("width")).first()
    small = n <= rows and (total or 0) <= size
    return (F.broadcast(df) if small else df), small


# ------------------------------------------------------------- shared files

def filesystem(uri: str):
    """(pyarrow filesystem, path) of a path in the shared folder, from the driver or a task."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", uri)
    if local.startswith("/"):
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(uri)


def shared_delete(uri: str) -> None:
    """Remove a folder of intermediate files that this library wrote."""
    filesystem_, path = filesystem(uri)
    filesystem_.delete_dir(path)


# ------------------------------------------------------------- blobs

def compress(data: bytes) -> bytes:
    """zstd, with the plain length in front."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def decompress(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd",
                         asbytes=True)


def pack_sorted(values: np.ndarray) -> bytes:
    """A strictly increasing uint64 array as compressed byte planes of its gaps (exact)."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


# ------------------------------------------------------------- Arrow

def arrow_rows(schema: pa.Schema, rows_per_batch: int = 4096) -> tuple[Callable, Callable]:
    """(add, flush): collect rows as tuples and get them back as record batches."""
    rows: list[tuple] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
            rows.clear()

    def add(row: tuple) -> Iterator[pa.RecordBatch]:
        rows.append(row)
        if len(rows) >= rows_per_batch:
            yield from flush()

    return add, flush
