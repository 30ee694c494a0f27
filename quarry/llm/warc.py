"""ZIP-packaged web archives: writer, and a reader that never extracts.

A package is a ZIP file with two stored members: ``archive/data.warc.gz`` (one
gzip member per WARC record) and ``indexes/index.cdxj`` (a line per record:
where it lies in the archive member, and its main fields). ``write_packages``
writes packages from the tasks to the shared folder; the names of packages of
lost or repeated attempts are never reported, so they are never read.

``index_of`` reads the end of a package, parses its central directory (ZIP64
records too), locates the stored members and reads the index alone.
``fetch`` reads the records of index rows by byte range, neighbours in one
read, so a filter on index columns leaves the other records unread.

Records with equal payloads of at least ``MIN_REVISIT`` bytes: those of the
smallest page_id are responses, others are revisits that hold no payload.

Defined results: a null html is an empty payload; a null url gives no target
URI; rows that repeat a page_id are records of their own (with an equal payload
they are all responses if it is the smallest id); a null page_id is never the
smallest; other columns are not looked at; an empty table writes no package.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.blocks import gathered, scratch

MIN_REVISIT = 100            # bytes
PACKAGE_BYTES = 8 << 20      # payload per package
READ_BYTES = 4 << 20         # most that neighbouring records are read at once (a longer record: its own length)
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # that of URLs, RFC 4122


def decided(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``; refers_to is set for revisits.

    Only digests that occur more than once are written and joined: the pages
    themselves are shuffled only if that table is too large to be broadcast.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    path = scratch(spark, "warc-repeated")
    (rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
     .where("n > 1").select("digest", "first").write.parquet(path))
    return (rows.join(spark.read.parquet(path), "digest", "left")
            .select("page_id", "url", "payload", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to")))


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id} {digest}')}>"


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A WARC/1.1 response or revisit record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    head += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("X-Page-ID", json.dumps(page_id, default=str))]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", json.dumps(refers_to, default=str))]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def package(rows: list[tuple]) -> bytes:
    """A package of (page_id, url, payload, digest, refers_to) rows."""
    archive, lines = io.BytesIO(), []
    for page_id, url, payload, digest, refers_to in rows:
        at = archive.tell()
        c = zlib.compressobj(1, zlib.DEFLATED, 31)  # a gzip member
        archive.write(c.compress(record(page_id, url, payload, digest, refers_to)) + c.flush())
        lines.append(json.dumps({"offset": at, "length": archive.tell() - at, "digest": digest, "url": url,
                                 "type": "response" if refers_to is None else "revisit"}))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        z.writestr(zipfile.ZipInfo(ARCHIVE), archive.getbuffer())
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
    return out.getvalue()


def write_packages(rows: DataFrame, folder: str) -> DataFrame:
    """Write the packages below ``folder`` (any URI that the executors can write to); returns (path, records) of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for b in gathered(batches, "payload", PACKAGE_BYTES):
            name = f"{uuid.uuid4().hex}.wacz"
            data = package(list(zip(*(b.column(k).to_pylist() for k in ("page_id", "url", "payload", "digest", "refers_to")))))
            with system.open_output_stream(f"{base}/{name}") as f:
                f.write(data)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([b.num_rows], pa.int64())], names=["path", "records"])

    return rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "path string, records long")


def directory(f, size: int) -> dict[str, tuple[int, int, int, int]]:
    """Central directory: name to (method, offset of the local header, stored size, size), ZIP64 fields resolved."""
    tail_at = max(0, size - 65557 - 20 - 56)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    _, _, _, entries, length, at, _ = struct.unpack("<4H2LH", tail[end + 4:end + 22])
    if entries == 0xFFFF or length == 0xFFFFFFFF or at == 0xFFFFFFFF:
        if tail[end - 20:end - 16] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        where = struct.unpack("<Q", tail[end - 12:end - 4])[0]
        f.seek(where)
        whole = f.read(56)
        if whole[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, at = struct.unpack("<3Q", whole[32:56])
    f.seek(at)
    raw, out, pos = f.read(length), {}, 0
    for _ in range(entries):
        if raw[pos:pos + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack("<2H", raw[pos + 8:pos + 12])
        stored, full, n_name, n_extra, n_comment = struct.unpack("<2L3H", raw[pos + 20:pos + 34])
        local = struct.unpack("<L", raw[pos + 42:pos + 46])[0]
        name = raw[pos + 46:pos + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = raw[pos + 46 + n_name:pos + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            tag, n = struct.unpack("<2H", extra[e:e + 4])
            if tag == 1:  # in this order, only those that the fixed field leaves open
                big = iter(struct.unpack(f"<{n // 8}Q", extra[e + 4:e + 4 + n // 8 * 8]))
                full = next(big) if full == 0xFFFFFFFF else full
                stored = next(big) if stored == 0xFFFFFFFF else stored
                local = next(big) if local == 0xFFFFFFFF else local
            e += 4 + n
        out[name] = (method, local, stored, full)
        pos += 46 + n_name + n_extra + n_comment
    return out


def member_at(f, local: int) -> int:
    """Where a member's bytes begin."""
    f.seek(local)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack("<2H", head[26:30])
    return local + 30 + n_name + n_extra


def index_of(packages: DataFrame) -> DataFrame:
    """``(path, at, length, digest, url, type)`` of every record of the packages; ``at`` is its place in the package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                system, name = pafs.FileSystem.from_uri(path)
                with system.open_input_file(name) as f:
                    found = directory(f, f.size())
                    for member, (method, *_) in found.items():
                        if method:
                            raise ValueError(f"{path}: {member} isn't stored")
                    begin = member_at(f, found[ARCHIVE][1])
                    f.seek(member_at(f, found[INDEX][1]))
                    rows = [json.loads(x) for x in f.read(found[INDEX][2]).splitlines()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(rows)), pa.array([begin + r["offset"] for r in rows], pa.int64()), pa.array([r["length"] for r in rows], pa.int64()),
                    *(pa.array([r[k] for r in rows], pa.string()) for k in ("digest", "url", "type"))], names=["path", "at", "length", "digest", "url", "type"])

    return packages.select("path").mapInArrow(run, "path string, at long, length long, digest string, url string, type string")


def parse(raw: bytes) -> tuple[dict, dict, bytes]:
    """(WARC fields, HTTP fields, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode("latin-1").split("\r\n")[1:])}, payload


def fetch(index: DataFrame, id_type: T.DataType) -> DataFrame:
    """``(page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest)`` of the index rows' records.

    Of a revisit, payload is null, and length and digest are those that its record states.
    """
    schema = T.StructType([T.StructField("page_id", id_type), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
                           T.StructField("refers_to", id_type), T.StructField("payload", T.BinaryType()), T.StructField("payload_bytes", T.LongType()),
                           T.StructField("payload_digest", T.StringType())])
    names = schema.names

    def rows_of(path: str, wanted: list[tuple[int, int]]) -> Iterator[tuple]:
        system, name = pafs.FileSystem.from_uri(path)
        with system.open_input_file(name) as f:
            k = 0
            while k < len(wanted):
                at, end, to = wanted[k][0], wanted[k][0] + wanted[k][1], k + 1
                while to < len(wanted) and wanted[to][0] == end and wanted[to][0] + wanted[to][1] - at <= READ_BYTES:
                    end, to = wanted[to][0] + wanted[to][1], to + 1
                f.seek(at)
                raw = f.read(end - at)
                for a, n in wanted[k:to]:
                    fields, http, payload = parse(gzip.decompress(raw[a - at:a - at + n]))
                    page, revisit = json.loads(fields["x-page-id"]), fields["warc-type"] == "revisit"
                    refers = json.loads(fields["x-refers-to-page-id"]) if revisit else None
                    stated = fields["warc-payload-digest"].removeprefix("sha256:")
                    digest = stated if revisit else hashlib.sha256(payload).hexdigest()
                    if digest != stated:
                        raise ValueError(f"{path}: payload of page {page} doesn't have its digest")
                    yield (page, fields.get("warc-target-uri"), fields["warc-type"], refers, None if revisit else payload,
                           int(http["content-length"]) if revisit else len(payload), digest)
                k = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in schema.fields]
        for b in batches:
            paths, places = b.column("path").to_pylist(), list(zip(b.column("at").to_pylist(), b.column("length").to_pylist()))
            held, size, k = [], 0, 0
            while k < len(paths):
                to = k
                while to < len(paths) and paths[to] == paths[k]:
                    to += 1
                for row in rows_of(paths[k], sorted(places[k:to])):
                    held.append(row)
                    size += len(row[4] or b"")
                    if size > PACKAGE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
                        held, size = [], 0
                k = to
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)

    return index.select("path", "at", "length").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to packages in the shared folder and read every record back."""
    spark = pages.sparkSession
    base = scratch(spark, "warc")
    write_packages(decided(pages), f"{base}/packages").write.parquet(f"{base}/manifest")
    return fetch(index_of(spark.read.parquet(f"{base}/manifest")), pages.schema["page_id"].dataType)
