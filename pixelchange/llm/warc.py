"""WARC archives as a chunked record table.

Writing: each task streams its rows into compressed archives (a gzip member
a record) in the shared scratch folder and returns a manifest row for each
finished archive.  A repeated task writes new files; only files named in
the manifest, which is written once, are ever read.

Reading: a task decompresses an archive piece by piece and emits a row for
each chunk of a payload: record, chunk number, bytes, and SHA-1 and length
of the payload so far.  No record is held whole; the last chunk of a record
carries the digest and length of all of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import materialise
from pixelchange.session import scratch_path

CHUNK_BYTES = 1 << 20       # of a payload that one row carries
ARCHIVE_BYTES = 256 << 20   # compressed bytes after which a task begins a new archive
DATE = "1970-01-01T00:00:00Z"   # the tables have no capture times


def _file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def payload_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``digest`` (hex SHA-1), ``n_bytes``, ``record_type`` and ``refers_to``.

    Of rows with equal payloads of at least ``min_bytes`` the largest page_id
    is the response (all rows of it, if it repeats); others revisit it.  Rows
    meet by digest; counts are combined in the tasks first and a digest that
    a large part of the rows share is split by Spark's skew join."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html").withColumn("digest", F.sha1(body)).withColumn("n_bytes", F.octet_length(body).cast("long"))
    first = (pages.select("page_id", F.sha1(body).alias("digest")).groupBy("digest")
             .agg(F.max("page_id").alias("_first")))
    revisit = (F.col("n_bytes") >= min_bytes) & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return (rows.join(first, "digest")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("_first"))).drop("_first"))


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _header(page_id, url, digest, n_bytes, kind, refers_to, length) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{_base32(digest)}", f"WARC-Payload-Length: {n_bytes}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    else:
        head.append("Content-Type: text/html")
    head.append(f"Content-Length: {length}")
    return "\r\n".join(head).encode() + b"\r\n\r\n"


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 1) -> DataFrame:
    """Write a WARC record for each row of ``payload_roles`` and return the manifest
    (``archive``, ``n_records``, ``n_bytes``), one row a file."""

    def run(batches):
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        out, name, records, written = None, "", 0, 0

        def close():
            out.close()
            fs.move(f"{base}/{name}.part", f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"archive": [name], "n_records": pa.array([records], pa.int64()), "n_bytes": pa.array([written], pa.int64())})

        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            body = columns[2]
            for i in range(batch.num_rows):
                if out is None:
                    name, records, written = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}.part", compression=None)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                page_id, url, digest, n_bytes, kind, refers_to = (c[i].as_py() for c in columns if c is not body)
                payload = memoryview(body[i].as_buffer() or b"") if kind == "response" else memoryview(b"")
                pieces = [_header(page_id, url, digest, n_bytes, kind, refers_to, len(payload)),
                          *(payload[a:a + CHUNK_BYTES] for a in range(0, len(payload), CHUNK_BYTES)), b"\r\n\r\n"]
                for piece in pieces:
                    packed = packer.compress(piece)
                    written += len(packed)
                    out.write(packed)
                packed = packer.flush()
                written += len(packed)
                out.write(packed)
                records += 1
                if written >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    ordered = rows.select("page_id", "url", "html", "digest", "n_bytes", "record_type", "refers_to")
    return materialise(ordered.mapInArrow(run, "archive string, n_records long, n_bytes long"), "warc-manifest")


class _Stream:
    """Plain bytes of an archive of gzip members, read piece by piece."""

    def __init__(self, source):
        self.source, self.packed, self.plain = source, zlib.decompressobj(31), b""

    def fill(self) -> bool:
        while True:
            rest = self.packed.unused_data if self.packed.eof else self.packed.unconsumed_tail
            if self.packed.eof:
                self.packed = zlib.decompressobj(31)
            raw = rest or self.source.read(1 << 18)
            if not raw:
                return False
            got = self.packed.decompress(raw, CHUNK_BYTES)
            if got:
                self.plain += got
                return True

    def header(self) -> dict[str, str] | None:
        while b"\r\n\r\n" not in self.plain:
            if not self.fill():
                if self.plain.strip():
                    raise ValueError("the archive ends inside a record")
                return None
        head, _, self.plain = self.plain.partition(b"\r\n\r\n")
        lines = head.decode().lstrip("\r\n").split("\r\n")
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}

    def take(self, n: int) -> bytes:
        """At most ``n`` bytes, at least one."""
        if not self.plain and not self.fill():
            raise ValueError("the archive ends inside a record")
        got, self.plain = self.plain[:n], self.plain[n:]
        return got


def _id(value: str | None) -> int | None:
    text = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


CHUNK_SCHEMA = ("archive string, record_no long, chunk_no int, last boolean, data binary, payload_bytes long, payload_digest string, "
                "page_id long, record_type string, refers_to long, header_digest string, header_bytes long")


def read_chunks(manifest: DataFrame, folder: str, with_data: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk table of all archives of a manifest.

    ``payload_bytes`` and ``payload_digest`` (base32 SHA-1) are of the payload
    up to and with this chunk; a record without payload has one empty chunk.
    ``with_data=False`` leaves the bytes themselves out."""
    schema = pa.schema([("archive", pa.string()), ("record_no", pa.int64()), ("chunk_no", pa.int32()), ("last", pa.bool_()),
                        ("data", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("page_id", pa.int64()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("header_digest", pa.string()), ("header_bytes", pa.int64())])

    def records(stream, name):
        number = 0
        while (head := stream.header()) is not None:
            left, sha, size, chunk = int(head["content-length"]), hashlib.sha1(), 0, 0
            fixed = [_id(head.get("warc-record-id")), head["warc-type"], _id(head.get("warc-refers-to")),
                     head["warc-payload-digest"].removeprefix("sha1:"), int(head["warc-payload-length"])]
            while True:
                parts, want = [], min(left, chunk_bytes)
                while want:
                    parts.append(stream.take(want))
                    want -= len(parts[-1])
                data = b"".join(parts)
                sha.update(data)
                size, left = size + len(data), left - len(data)
                yield [name, number, chunk, left == 0, data if with_data else None, size, base64.b32encode(sha.digest()).decode(), *fixed], len(data)
                chunk += 1
                if not left:
                    break
            for _ in range(4):      # the two line ends behind a record
                stream.take(1)
            number += 1

    def run(batches):
        fs, base = _file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for row, size in records(_Stream(source), name):
                        rows.append(row)
                        held += size if with_data else 0
                        if held >= 4 * chunk_bytes or len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    n = max(1, manifest.count())
    # One archive a task: archives are alike in size, and their number grows with the data.
    dealt = manifest.select("archive").repartition(n, "archive")
    return dealt.mapInArrow(run, CHUNK_SCHEMA)


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """One row a record, from its last chunk: digest and length of the whole
    payload (of a revisit: of the payload that it refers to)."""
    revisit = F.col("record_type") == "revisit"
    return read_chunks(manifest, folder, with_data=False).where("last").select(
        "page_id", F.when(revisit, F.col("header_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("header_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


def read_payloads(manifest: DataFrame, folder: str) -> DataFrame:
    """Payload of each response, put together from its chunks (which must fit a row)."""
    chunks = read_chunks(manifest, folder).where("record_type = 'response'")
    whole = chunks.groupBy("archive", "record_no", "page_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk_no", "data"))).alias("c"))
    return whole.select("page_id", F.expr("aggregate(c, cast('' as binary), (a, x) -> concat(a, x.data))").alias("payload"))


def op8_warc(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives and read the records back.

    A null html is an empty payload; a null page_id is written without
    number and read back as null; no page, no archive."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(payload_roles(pages), folder), folder)


def base32_sql(hex_digest: str) -> str:
    """DuckDB expression for the base32 form of a hex SHA-1."""
    digit = f"(strpos('0123456789abcdef', substr({hex_digest}, ({{}}) + 1, 1)) - 1)"
    a, b = digit.format("(5 * i) // 4"), digit.format("(5 * i) // 4 + 1")
    return (f"array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
            f"((({a} * 16 + {b}) >> (3 - (5 * i) % 4)) & 31) + 1, 1)), '')")


WARC_SQL = f"""
    WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS first FROM p)
    SELECT page_id, payload_bytes, {base32_sql('d')} AS payload_digest,
           CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM f"""
