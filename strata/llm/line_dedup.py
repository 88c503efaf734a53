"""Line deduplication (operator 2): explode normalised lines, hash, count documents, drop, reassemble.

1. Every text is exploded into its lines; the key of a line (stripped, A-Z lower-cased) is hashed to
   128 bits. Rows ``(hash, document, position)`` are written to the shared folder: some bytes a line.
2. Rows are reduced to (hash, document), then per hash to the number of documents and the smallest one.
   Both steps combine before the shuffle, so a line that a third of all documents hold stays cheap.
3. Hashes over the threshold are joined back to the rows (a skewed hash is split by the adaptive join),
   which gives the positions each document loses; the document is reassembled without them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased (bytes methods touch ASCII alone)."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def _code_points(raw: bytes) -> int:
    return len(raw) if raw.isascii() else len(raw.decode("utf-8", "replace"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                min_docs: int = 2) -> DataFrame:
    """``docs`` with ``text_col`` reassembled from the lines it keeps, plus ``n_lines`` and ``n_dropped``.

    A line whose key has at least ``min_chars`` code points and is held by at least ``min_docs`` documents
    is kept in the smallest ``id_col`` that holds it, every time it occurs there, and dropped elsewhere.
    Documents are told apart by ``id_col``: rows with the same id count as one document (and null ids as
    one, the largest). Null and empty texts are one empty line; a null text stays null if it is asked
    nothing of (no line is dropped). Shorter keys are always kept. All other columns pass through; an
    empty table gives an empty table. Column names ``n_lines`` and ``n_dropped`` are replaced if present.
    """
    ident, text = F.col(id_col), F.col(text_col)
    text_id = docs.schema[id_col].dataType.typeName() == "string"
    own = ident if text_id else ident.cast("long")
    # rows that share an id may differ in text: ``version`` keeps their positions apart
    narrow = docs.select(own.alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))
    schema = pa.schema([("hash", pa.binary()), ("doc", pa.string() if text_id else pa.int64()),
                        ("version", pa.int64()), ("pos", pa.int32())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, flush = common.arrow_rows(schema, 65536)
        for b in batches:
            for doc, version, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                for pos, line in enumerate(raw.split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_chars and _code_points(key) >= min_chars:
                        yield from add((hashlib.blake2b(key, digest_size=16).digest(), doc, version, pos))
        yield from flush()

    doc_type = "string" if text_id else "long"
    lines = common.store(narrow.mapInArrow(explode, f"hash binary, doc {doc_type}, version long, pos int"), "lines")
    order = F.struct(F.col("doc").isNull().alias("last"), F.col("doc").alias("doc"))
    holders = (lines.select("hash", "doc").distinct().groupBy("hash")
               .agg(F.count(F.lit(1)).alias("docs"), F.min(order).alias("keeper"))
               .where(F.col("docs") >= min_docs).select("hash", F.col("keeper.doc").alias("keeper")))
    # stored: both sides of the join below are then shuffled for it, and a hot line's rows can be split
    holders = common.store(holders, "line-holders")
    lost = (lines.join(holders, "hash").where(~F.col("doc").eqNullSafe(F.col("keeper")))
            .groupBy("doc", "version").agg(F.collect_set("pos").alias("lost")))
    out = docs.drop("n_lines", "n_dropped")
    key, version, drop = common.internal(out, "__doc", "__version", "__lost")
    lost = lost.select(F.col("doc").alias(key), F.col("version").alias(version), F.col("lost").alias(drop))
    joined = out.join(lost, own.eqNullSafe(F.col(key)) & (F.xxhash64(text) == F.col(version)), "left")
    return _reassemble(joined.drop(key, version), text_col, drop)


def _reassemble(joined: DataFrame, text_col: str, drop: str) -> DataFrame:
    """Texts without the lines at the positions in ``drop``, and the two counts."""
    from pyspark.sql import types as T

    fields = [f for f in joined.schema.fields if f.name != drop]
    out_type = T.StructType(fields + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = [f.name for f in fields]
    at_text = names.index(text_col)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for t, lost in zip(b.column(text_col), b.column(drop), strict=True):
                gone = lost.as_py()
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                if not gone:
                    texts.append(t.as_py())
                    n_lines.append(raw.count(b"\n") + 1)
                    n_dropped.append(0)
                    continue
                gone, parts = set(gone), raw.split(b"\n")
                keep = [x for i, x in enumerate(parts) if i not in gone]
                texts.append(b"\n".join(keep).decode("utf-8", "replace"))
                n_lines.append(len(parts))
                n_dropped.append(len(parts) - len(keep))
            columns = [pa.array(texts, pa.string()) if i == at_text else b.column(n) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*names, "n_lines", "n_dropped"])

    return joined.mapInArrow(rebuild, out_type)
