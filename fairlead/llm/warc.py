"""WARC archives written and read as chunks.

Writing: one gzip member per record (WARC/1.1), one file per task up to ``FILE_BYTES``. Of records with equal payloads of ``MIN_BYTES`` or more the one with the largest id is the response, the others are revisits that name it. A file gets its name only when it is complete, and the manifest of complete files is itself written to shared storage, so a task that is run again leaves nothing behind that is read.

Reading: the chunked record table. A reader takes a file as a stream and emits rows (file, record, chunk_no, data, n_bytes, sha1, last) of at most ``CHUNK`` bytes; each row has the digest and length of the payload up to and including it, so the record's digest stands in its last row and no record is ever held whole. A response whose digest differs from its header is an error.

Defined results: a null payload is empty. Records with a null id are written, never referred to if another has the payload, and read back with a null id; repeated rows give repeated records, and of equal payloads all with the largest id are responses. Extra columns are ignored. An empty table gives no archive and no rows. Chunks of empty payloads: one, empty.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from .common import materialize, shared_path, skew_join

CHUNK = 1 << 20
FILE_BYTES = 1 << 30
MIN_BYTES = 1000

MANIFEST = T.StructType([T.StructField("file", T.StringType()), T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())])

CHUNKS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("record", T.LongType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("uri", T.StringType()),
        T.StructField("header_digest", T.StringType()),
        T.StructField("header_bytes", T.LongType()),
        T.StructField("chunk_no", T.LongType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("sha1", T.StringType()),
        T.StructField("last", T.BooleanType()),
    ]
)


def plan_records(pages: DataFrame, *, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """(id, uri, payload, digest, size, refers_to): what each record will be. Digests alone are grouped and joined, hot ones by broadcast."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    copies = materialize(rows.filter(F.col("size") >= min_bytes).groupBy("digest").agg(F.count("*").alias("_w"), F.max("id").alias("_to")).filter("_w > 1"), "copies")
    joined = skew_join(rows, copies, "digest", "_w")
    return joined.withColumn("refers_to", F.when((F.col("size") >= min_bytes) & ~F.coalesce(F.col("id") == F.col("_to"), F.lit(False)), F.col("_to"))).drop("_to")


def _urn(n: int | None) -> str:
    return f"<urn:page:{'' if n is None else n}>"


def _number(urn: str | None) -> int | None:
    text = (urn or "").strip("<>").rpartition(":")[2]
    return int(text) if text else None


def header(kind: str, n: int | None, uri: str | None, digest: str, size: int, length: int, refers_to: int | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(n)}", "WARC-Date: 2024-01-01T00:00:00Z"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {quote(uri, safe=':/?#[]@!$&()*+,;=%~-._')}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    lines.append(f"X-Payload-Length: {size}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI that Arrow can open (local, hdfs, s3, gs, abfs), and the path within it."""
    path = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_archives(records: DataFrame, folder: str, *, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes (id, uri, payload, digest, size, refers_to) to files in ``folder`` and returns the manifest, materialised."""
    names = ["id", "uri", "payload", "digest", "size", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        out = name = None
        count = size = 0
        done = []

        def finish() -> None:
            nonlocal out
            out.close()
            store.move(f"{root}/{name}.open", f"{root}/{name}")
            done.append((f"{folder}/{name}", count, size))
            out = None

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
            for i in range(batch.num_rows):
                n, uri, digest, full, to = (cols[k][i].as_py() for k in (0, 1, 3, 4, 5))
                if out is None:
                    name, count, size = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}.open", compression=None)
                kind = "response" if to is None else "revisit"
                body = memoryview(cols[2][i].as_buffer()) if to is None and full else b""
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                pieces = [header(kind, n, uri, digest, full, len(body), to), *(body[k : k + chunk] for k in range(0, len(body), chunk)), b"\r\n\r\n"]
                for piece in pieces:
                    if data := press.compress(piece):
                        out.write(data)
                        size += len(data)
                data = press.flush()
                out.write(data)
                size += len(data)
                count += 1
                if size >= file_bytes:
                    finish()
        if out is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], schema=to_arrow_schema(MANIFEST))

    return materialize(records.select(*names).mapInArrow(run, MANIFEST), "manifest")


class _Stream:
    """Bytes of a sequence of gzip members, a block at a time."""

    def __init__(self, raw, block: int) -> None:
        self.raw, self.block, self.held, self.inflate, self.rest = raw, block, bytearray(), None, b""

    def more(self) -> bool:
        if not self.rest:
            self.rest = self.raw.read(self.block)
            if not self.rest:
                return False
        if self.inflate is None:
            self.inflate = zlib.decompressobj(31)
        self.held += self.inflate.decompress(self.rest, self.block)
        self.rest = self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.rest = self.inflate.unused_data
            self.inflate = None
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and including ``mark``; None at the end of the file."""
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                if self.held.strip():
                    raise ValueError("the archive ends within a header")
                return None
        got = bytes(self.held[: at + len(mark)])
        del self.held[: at + len(mark)]
        return got

    def take(self, most: int) -> bytes:
        while len(self.held) < most:
            if not self.more():
                raise ValueError("the archive ends within a record")
        got = bytes(self.held[:most])
        del self.held[:most]
        return got


def read_stream(raw, *, chunk: int = CHUNK) -> Iterator[tuple]:
    """(record, fields, chunk_no, data, n_bytes, sha1, last) for each chunk of the records in a file object."""
    stream, record = _Stream(raw, min(chunk, 1 << 18)), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        left, so_far, number, digest = int(fields["content-length"]), 0, 0, hashlib.sha1()
        while True:
            data = stream.take(min(chunk, left))
            left -= len(data)
            so_far += len(data)
            digest.update(data)
            yield record, fields, number, data, so_far, digest.hexdigest(), left == 0
            number += 1
            if not left:
                break
        stream.take(4)
        record += 1


def read_chunks(manifest: DataFrame, *, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunked record table of the files in ``manifest``. Without ``data`` the chunks' bytes are checked and digested but not returned."""
    n = max(1, manifest.count())
    schema = to_arrow_schema(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = _store(file)
                with store.open_input_stream(path, compression=None) as raw:
                    for record, f, number, part, so_far, sha1, last in read_stream(raw, chunk=chunk):
                        given = f.get("warc-payload-digest", "").removeprefix("sha1:")
                        kind = f.get("warc-type")
                        if last and kind == "response" and given != sha1:
                            raise ValueError(f"{file}, record {record}: payload digest {sha1}, header {given}")
                        uri = unquote(f["warc-target-uri"]) if "warc-target-uri" in f else None
                        to = _number(f.get("warc-refers-to"))
                        rows.append((file, record, _number(f.get("warc-record-id")), kind, to, uri, given, int(f.get("x-payload-length", so_far)), number, part if data else None, so_far, sha1, last))
                        held += len(part) if data else 0
                        if len(rows) >= 1000 or held >= 4 * chunk:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    files = manifest.select("file").repartition(min(n, 10_000), "file")
    return files.mapInArrow(run, CHUNKS)


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: page_id, payload_bytes, payload_digest, record_type, refers_to. A revisit's length and digest are those its header gives for the full payload."""
    is_response = F.col("record_type") == "response"
    return chunks.filter("last").select(
        F.col("record_id").alias("page_id"),
        F.when(is_response, F.col("n_bytes")).otherwise(F.col("header_bytes")).alias("payload_bytes"),
        F.when(is_response, F.col("sha1")).otherwise(F.col("header_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def archive(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes a record per page to ``folder`` (by default a fresh one in shared storage) and returns the manifest."""
    return write_archives(plan_records(pages, **options), folder or shared_path(pages.sparkSession, "warc"))
