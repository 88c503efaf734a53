"""WARC archives and the monolithic-gzip normaliser (operator 8).

``write_archives`` writes records as whole-file gzip streams (one member a file, as many crawlers and
plain ``gzip`` leave them): no record can be read without inflating all before it. ``normalise``
inflates each such stream once, in bounded pieces, rewrites every record as a gzip member of its own
and writes a sidecar index (``.idx``: offset, length, id and type of every record, a JSON line each).
``read_archives`` then reads records through the index, any of them alone.

Tasks stream files through the shared folder. A task writes under a name of its own, and the manifest
(a stored Parquet table) lists the files of the attempts that were committed: a task that is lost and
run again leaves at most a file that nothing reads.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common, spans

_PIECE = 1 << 20
_END = b"\r\n\r\n"


def digest32(sha1_hex: str) -> str:
    """Bare upper-case base32 of a SHA-1 given in hex."""
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_urn(page_id) -> str:
    return f"urn:page:{page_id}"


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in fields) + "\r\n").encode()


def parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:] if x)


def deduplicated(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", url_col: str = "url",
                 min_bytes: int = 0) -> DataFrame:
    """Columns ``id, url, sha1, bytes, refers_to, body``: of records with equal payloads of at least
    ``min_bytes`` bytes, that with the largest id is the response and keeps its body; the others refer to
    it. Digests are grouped (combined before the shuffle) and stored, so that the adaptive join can split a payload
    that most pages share; bodies are shuffled once, by id."""
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    url = F.col(url_col) if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), body.alias("body"))
    rows = rows.withColumns({"sha1": F.sha1("body"), "bytes": F.octet_length("body").cast("long")})
    keys = common.store(rows.select("id", "sha1", "bytes"), "warc-keys")
    held = (keys.where(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes")
            .agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    held = common.store(held, "warc-shared")
    refers = (keys.join(held, ["sha1", "bytes"]).where("not (id <=> last)")
              .select(F.col("id").alias("own"), F.col("sha1").alias("own_sha1"), "last").distinct())
    joined = rows.join(refers, F.col("id").eqNullSafe(F.col("own")) & (F.col("sha1") == F.col("own_sha1")), "left")
    revisit = F.col("own_sha1").isNotNull()
    return joined.select("id", "url", "sha1", "bytes", revisit.alias("revisit"),
                         F.when(revisit, F.col("last")).alias("refers_to"),
                         F.when(~revisit, F.col("body")).alias("body"))


def write_archives(records: DataFrame, *, date: str = "1970-01-01T00:00:00Z", level: int = 1,
                   path: str | None = None) -> DataFrame:
    """Write the rows of ``deduplicated`` as monolithic archives, one per partition; returns the stored
    manifest (``file``, ``n_records``)."""
    path = path or common.scratch_path(records.sparkSession, "warc-mono")
    fs_, dir_ = common.filesystem(path)
    fs_.create_dir(dir_)
    schema = pa.schema([("file", pa.string()), ("n_records", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, d = common.filesystem(path)
        stream, n = None, 0
        for b in batches:
            if b.num_rows == 0:
                continue
            if stream is None:
                name = f"mono-{uuid.uuid4().hex}.warc.gz"
                stream, gz = fs.open_output_stream(f"{d}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
            bodies = spans.texts_of(b.column(b.schema.get_field_index("body")))
            plain = b.drop_columns(["body"]).to_pylist()
            for i, r in enumerate(plain):
                body = bodies.bytes(i)
                fields = [("WARC-Type", "revisit" if r["revisit"] else "response"),
                          ("WARC-Record-ID", f"<{record_urn(r['id'])}>"), ("WARC-Date", date)]
                if r["url"] is not None:
                    fields.append(("WARC-Target-URI", r["url"]))
                fields += [("WARC-Payload-Digest", f"sha1:{digest32(r['sha1'])}"),
                           ("WARC-Payload-Length", str(r["bytes"]))]
                if r["revisit"]:
                    fields += [("WARC-Refers-To", f"<{record_urn(r['refers_to'])}>"),
                               ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
                stream.write(gz.compress(head(fields) + body + _END))
                n += 1
        if stream is not None:
            stream.write(gz.flush())
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{path}/{name}"]), pa.array([n], pa.int64())], schema=schema)

    return common.store(records.mapInArrow(write, "file string, n_records long"), "warc-mono-manifest")


def inflate(stream) -> Iterator[bytes]:
    """The plain bytes of a gzip file of one or many members, in pieces of bounded size."""
    gz, data = zlib.decompressobj(31), b""
    while True:
        data = data or stream.read(_PIECE)
        if not data:
            break
        out = gz.decompress(data, 4 * _PIECE)
        if out:
            yield out
        if gz.eof:
            data = gz.unused_data
            gz = zlib.decompressobj(31)
        else:
            data = gz.unconsumed_tail
    rest = gz.flush()
    if rest:
        yield rest


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(head fields, whole record with its head) of each record in a plain WARC stream. Holds one record."""
    held, at = bytearray(), 0

    def more() -> bool:
        nonlocal held, at
        piece = next(pieces, None)
        if piece is None:
            return False
        if at > _PIECE:
            del held[:at]
            at = 0
        held += piece
        return True

    while True:
        while (stop := held.find(b"\r\n\r\n", at)) < 0:
            left = len(held) - at
            if not more():
                if left:
                    raise ValueError("the archive ends inside a record's head")
                return
        fields = parse_head(bytes(held[at:stop]))
        size = stop - at + 4 + int(fields["Content-Length"]) + 4
        while len(held) - at < size:
            if not more():
                raise ValueError("the archive ends inside a record")
        raw = bytes(held[at:at + size])
        if raw[-4:] != _END:
            raise ValueError("a record's length does not match its block")
        at += size
        yield fields, raw


def normalise(manifest: DataFrame, *, level: int = 6, path: str | None = None) -> DataFrame:
    """Rewrite monolithic archives with a gzip member per record and a sidecar index each. A task
    inflates a file's stream once and holds one record. Returns the stored manifest of the new files:
    ``file``, ``index``, ``n_records``."""
    spark = manifest.sparkSession
    path = path or common.scratch_path(spark, "warc")
    fs_, dir_ = common.filesystem(path)
    fs_.create_dir(dir_)
    schema = pa.schema([("file", pa.string()), ("index", pa.string()), ("n_records", pa.int64())])

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, d = common.filesystem(path)
        for b in batches:
            for source in b.column(0).to_pylist():
                name = f"{d}/part-{uuid.uuid4().hex}.warc.gz"
                sfs, sp = common.filesystem(source)
                offset, n = 0, 0
                with sfs.open_input_stream(sp, compression=None) as src, fs.open_output_stream(name, compression=None) as out, \
                        fs.open_output_stream(name + ".idx", compression=None) as index:
                    for fields, raw in records_of(inflate(src)):
                        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = gz.compress(raw) + gz.flush()
                        out.write(member)
                        index.write(json.dumps({"offset": offset, "length": len(member), "id": fields["WARC-Record-ID"],
                                                "type": fields["WARC-Type"]}).encode() + b"\n")
                        offset += len(member)
                        n += 1
                file = f"{path}/{name.rsplit('/', 1)[1]}"
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([file + ".idx"]), pa.array([n], pa.int64())],
                                                 schema=schema)

    files = manifest.select("file").repartition(max(1, manifest.count()), "file")
    return common.store(files.mapInArrow(rewrite, "file string, index string, n_records long"), "warc-manifest")


def read_record(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """(head fields, payload) of the record whose member lies at ``offset``."""
    stream.seek(offset)
    raw = zlib.decompress(stream.read(length), 31)
    stop = raw.index(b"\r\n\r\n")
    fields = parse_head(raw[:stop])
    return fields, raw[stop + 4:stop + 4 + int(fields["Content-Length"])]


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Per record of normalised archives, read through their indexes: ``record_id``, ``record_type``,
    ``refers_to`` (record id), ``target_uri``, ``payload_bytes``, ``payload_digest`` and, if asked for,
    ``payload``. A response's digest is computed from the payload that was read and must agree with its
    head (a damaged archive is an error); a revisit's digest and size are those of the payload it stands for."""
    columns = [("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
               ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    schema = pa.schema(columns + [("payload", pa.binary())] * with_payload)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, flush = common.arrow_rows(schema, 256 if with_payload else 4096)
        for b in batches:
            for file, idx in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, p = common.filesystem(file)
                ifs, ip = common.filesystem(idx)
                with fs.open_input_file(p) as stream, ifs.open_input_stream(ip, compression=None) as lines:
                    index = [json.loads(x) for x in lines.read().splitlines()]
                    for e in index:
                        fields, payload = read_record(stream, e["offset"], e["length"])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(fields["WARC-Payload-Length"])
                        if fields["WARC-Type"] == "response":
                            if digest32(hashlib.sha1(payload).hexdigest()) != digest or len(payload) != size:
                                raise ValueError(f"{file}: payload of {fields['WARC-Record-ID']} does not match its digest")
                        row = (fields["WARC-Record-ID"].strip("<>"), fields["WARC-Type"],
                               fields["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in fields else None,
                               fields.get("WARC-Target-URI"), size, digest)
                        yield from add((*row, payload) if with_payload else row)
        yield from flush()

    out = "record_id string, record_type string, refers_to string, target_uri string, payload_bytes long, payload_digest string"
    files = manifest.select("file", "index").repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(read, out + ", payload binary" * with_payload)


def archive(pages: DataFrame, **columns) -> DataFrame:
    """``pages`` written as monolithic archives, normalised; returns the manifest.

    Null payloads are empty and null urls are left out of the record; line breaks in a url are escaped.
    Rows that share an id and a payload are all written; the response's id names each of them. Null ids
    are written as ``urn:page:None`` and never referred to while another id holds the payload. An empty
    table gives no archive. Other columns are ignored.
    """
    path = common.scratch_path(pages.sparkSession, "warc-mono")
    out = normalise(write_archives(deduplicated(pages, **columns), path=path))
    common.shared_delete(path)  # every record is in the committed files by now
    return out
