"""Corpus parts and the exchange between them and hashed buckets.

Counting or looking up very many keys (windows, n-grams) across a corpus without shuffling them row by
row: the corpus is copied once into files of bounded size, which a stored table lists; each file is cut into *parts*, and

* a part sends its sorted distinct keys, cut into buckets, each as one compact blob (``ask``);
* a task per bucket combines the blobs of all parts and answers every part in the order of its keys
  (``answer``), a bit or a number a key;
* answers are written to the shared folder grouped by the file of the part, and a later pass over the
  copy reads the answers for its own part there (``Answers``).

Nothing is broadcast and nothing grows in one task: a part is bounded by its bytes, a bucket by their
number, and a key that is everywhere is one entry a part.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm import common, spans

#: Rows and bytes of text of one file of the copy; bytes of text after which a part ends.
FILE_ROWS = 4096
FILE_BYTES = 64 << 20
PART_BYTES = 8 << 20
_SUB = 10  # low bits of a part's number: parts of one file


class Corpus(NamedTuple):
    """A stored copy: ``files`` is the table of its files (``file`` their number, ``name``, ``n_rows``, ``n_bytes``
    of text), ``schema`` that of the rows: the columns that were copied, and ``file``."""

    files: DataFrame
    path: str
    schema: StructType
    n_files: int
    n_rows: int
    n_bytes: int

    def map(self, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], columns: list[str],
            out: str | StructType) -> DataFrame:
        """``run`` over the rows (``file`` and ``columns``) of whole files, file by file. A task opens the files that
        the table names; nothing about them passes through the driver."""
        path = self.path

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from run(_read(path, batches, ["file", *columns]))

        dealt = self.files.select("file", "name").repartitionByRange(max(1, self.n_files), "file")
        return dealt.mapInArrow(each, out)

    @property
    def rows(self) -> DataFrame:
        return self.map(lambda batches: batches, [f for f in self.schema.names if f != "file"],
                        StructType([self.schema["file"], *(f for f in self.schema.fields if f.name != "file")]))


def _read(path: str, batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    files, dir_ = common.filesystem(path)
    for b in batches:
        for name in b.column(1).to_pylist():
            with files.open_input_file(f"{dir_}/{name}") as stream:
                for rows in pq.ParquetFile(stream).iter_batches(1024, columns=columns):
                    yield rows.select(columns)


def copy(docs: DataFrame, columns: dict[str, Column], file_rows: int = FILE_ROWS, file_bytes: int = FILE_BYTES) -> Corpus:
    """Copy ``columns`` (``doc`` and ``text`` among them) into files of at most ``file_rows`` rows and
    ``file_bytes`` bytes of text (or one row). A task writes each of its files itself and names them in the table
    of files, which is stored: it lists those of committed attempts alone, and only they are read. A file is
    always read by one task and in one order."""
    spark = docs.sparkSession
    d = docs.select(*[c.alias(n) for n, c in columns.items()])
    path = common.scratch_path(spark, "corpus")
    fs, base = common.filesystem(path)
    fs.create_dir(base)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, dir_ = common.filesystem(path)
        task = TaskContext.get().partitionId()
        for k, (table, size) in enumerate(_files_of(batches, file_rows, file_bytes)):
            number, name = (task << 32) + k, f"part-{task:06d}-{k:06d}-{uuid.uuid4().hex[:12]}.parquet"
            n = table.num_rows
            table = table.append_column("file", pa.array(np.full(n, number)))
            with files.open_output_stream(f"{dir_}/{name}") as out:
                pq.write_table(table, out, compression="zstd", compression_level=3,
                               use_dictionary=[c for c in table.column_names if c != "text"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())],
                names=["file", "name", "n_rows", "n_bytes"])

    files = common.store(d.mapInArrow(write, "file long, name string, n_rows long, n_bytes long"), "corpus-files")
    total = files.agg(F.count(F.lit(1)), F.sum("n_rows"), F.sum("n_bytes")).first()
    schema = StructType([*d.schema.fields, StructField("file", LongType())])
    return Corpus(files, path, schema, total[0], total[1] or 0, total[2] or 0)


def _files_of(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[tuple[pa.Table, int]]:
    """(rows of one file, bytes of their texts): at most ``rows`` rows and ``size`` bytes, or one row."""
    held: list[pa.RecordBatch] = []
    n, total = 0, 0
    for b in batches:
        lens = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index("text"))), 0).to_pylist()
        begin = 0
        for i, k in enumerate(lens):
            if n and (n == rows or total + k > size):
                if i > begin:
                    held.append(b.slice(begin, i - begin))
                yield pa.Table.from_batches(held), total
                held, begin, n, total = [], i, 0, 0
            n, total = n + 1, total + k
        if b.num_rows > begin:
            held.append(b.slice(begin))
    if n:
        yield pa.Table.from_batches(held), total


def parts_of(batches: Iterator[pa.RecordBatch], part_bytes: int = PART_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """(part number, its rows) from batches of a copy. Where a part ends depends on the rows of its file
    alone, not on how they come in batches."""
    held: list[pa.RecordBatch] = []
    file, sub, size = None, 0, 0

    def table() -> pa.Table:
        return pa.Table.from_batches(held).combine_chunks()

    for b in batches:
        if b.num_rows == 0:
            continue
        files = b.column(b.schema.get_field_index("file")).to_numpy()
        lens = np.diff(spans.texts_of(b.column(b.schema.get_field_index("text"))).offsets)
        begin = 0
        for i, (f, n) in enumerate(zip(files.tolist(), lens.tolist(), strict=True)):
            if f != file or (size and size + n > part_bytes):
                if i > begin:
                    held.append(b.slice(begin, i - begin))
                if held:
                    yield (file << _SUB) + sub, table()
                held, begin, size = [], i, 0
                sub = sub + 1 if f == file else 0
                if sub >= 1 << _SUB:
                    raise ValueError("a file of the copy has too many parts; use fewer rows a file")
                file = f
            size += n
        held.append(b.slice(begin))
    if held:
        yield (file << _SUB) + sub, table()


def column(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name)
    return c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type)


def slices(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the runs in an ascending array of bucket numbers."""
    if len(buckets):
        at = np.concatenate([[0], np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, [len(buckets)]])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield int(buckets[a]), a, b


ASK = "kind int, bucket long, part long, keys binary, extra binary"
ASK_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("part", pa.int64()),
                        ("keys", pa.binary()), ("extra", pa.binary())])
ANSWER = "kind int, bucket long, part long, reply binary"


def ask(corpus: Corpus, columns: list[str], keys_of: Callable[[int, pa.Table], Iterator[tuple]],
        part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (kind, bucket, part, keys, extra) that ``keys_of(part, rows)`` yields (without the part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, flush = common.arrow_rows(ASK_SCHEMA, 512)
        for part, table in parts_of(batches, part_bytes):
            for kind, bucket, keys, extra in keys_of(part, table):
                yield from add((kind, bucket, part, keys, extra))
        yield from flush()

    return corpus.map(run, columns, ASK)


def answer(asked: DataFrame, reply: Callable) -> DataFrame:
    """One call of ``reply(kind, bucket, keys, extras)`` for each bucket, with lists over the parts (in
    ascending order); it returns a blob a part."""
    def run(key, group):
        import pandas as pd

        group = group.sort_values("part", kind="stable")
        out = reply(int(key[0]), int(key[1]), group["keys"].tolist(), group["extra"].tolist())
        return pd.DataFrame({"kind": group["kind"], "bucket": group["bucket"], "part": group["part"], "reply": out})

    return asked.groupBy("kind", "bucket").applyInPandas(run, ANSWER)


class Answers:
    """Stored answers, read by the task that handles a part."""

    def __init__(self, answers: DataFrame, name: str):
        self.path = common.scratch_path(answers.sparkSession, name)
        by_file = answers.withColumn("file", F.shiftright("part", _SUB))
        by_file.repartition("file").sortWithinPartitions("file", "part", "kind", "bucket").write.partitionBy("file").parquet(self.path)

    def of(self, part: int) -> dict[int, dict[int, bytes]]:
        """{kind: {bucket: reply}} for one part."""
        from pyarrow import fs

        files, base = common.filesystem(self.path)
        out: dict[int, dict[int, bytes]] = {}
        chosen = fs.FileSelector(f"{base}/file={part >> _SUB}", allow_not_found=True)
        for info in files.get_file_info(chosen):
            if not info.base_name.startswith(("_", ".")):
                t = pq.ParquetFile(files.open_input_file(info.path)).read(["kind", "bucket", "part", "reply"])
                for kind, bucket, p, reply in zip(*(c.to_pylist() for c in t.columns), strict=True):
                    if p == part:
                        out.setdefault(kind, {})[bucket] = reply
        return out
