"""WARC records in ZIP-packaged archives: written by tasks, read by ranges.

An archive is a ZIP file with stored members: ``archive/data.warc.gz``, one gzip member
per record, and ``indexes/index.cdxj``, one line per record with its place. The reader
finds the central directory from the end of the file (with its ZIP64 forms), locates
the stored members, reads the index, and fetches only the byte ranges that hold the
records asked for. Nothing is extracted, and no file is read whole.

Files are reached through Arrow's file systems, so any store that Arrow knows will do.
A task names its archives uniquely and reports them; only the archives of tasks that
succeeded are in the staged list, so tasks that ran again leave nothing in the result.

Defined results: a null payload counts as empty, a null address is written as a name made
from the id. A null id is written as ``null``: such a row is a revisit if a row with an id
has its payload, else a response. Repeated rows of the smallest id are all responses.
"""

from __future__ import annotations

import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propgraph.llm.common import slices
from propgraph.operators.joins import hub_join
from propgraph.staging import new_path, stage

REVISIT_BYTES = 100  # smaller payloads are never replaced by a revisit
ARCHIVE_BYTES = 256 << 20  # a task begins a new archive beyond so many bytes
SPAN_BYTES = 4 << 20  # neighbouring records are fetched in ranges of about so many bytes
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
TAIL = 66_000  # the end record and a comment of any length lie within

ARCHIVES = "path string, size long, records long"
SPANS = "path string, start long, size long, lengths array<long>"
RECORDS = "page_id long, uri string, record_type string, payload binary, declared string, refers_to long"


# writing


def classify(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES
) -> DataFrame:
    """page_id, uri, payload (binary), digest, refers_to: null for a response, else the page it repeats."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(uri_col).cast("string").alias("uri"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    # copies are combined before the shuffle: one row per digest and task
    shared = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    first = F.col("first_id")
    # they grow with the pages: the payloads are shuffled once, at every size
    shared = stage(shared, "shared-payloads").hint("merge")
    return hub_join(rows, shared, ["digest"], "left").select(
        "page_id",
        "uri",
        "payload",
        "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") > first), first).alias("refers_to"),
    )


def _name(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def _address(page_id: int | None, uri: str | None) -> str:
    """The address without spaces or line breaks, which would end a header or an index key."""
    return "".join(f"%{ord(c):02X}" if c <= " " else c for c in uri) if uri else _name(page_id)


def _record(page_id: int | None, uri: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_name(page_id)}>",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_name(refers_to)}>"]
        block = http + b"\r\n"
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Archive:
    """One ZIP file that grows record by record; its index is written at the end."""

    def __init__(self, folder: str):
        store, base = fs.FileSystem.from_uri(folder)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.size = f"{folder}/{name}", 0
        self.out = store.open_output_stream(f"{base}/{name}")
        self.zip = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.lines: list[str] = []

    def add(self, record: bytes, uri: str, digest: str) -> None:
        packed = _gzip(record)
        place = {"url": uri, "digest": f"sha256:{digest}", "offset": self.size, "length": len(packed), "filename": DATA}
        self.lines.append(f"{uri} {json.dumps(place)}")
        self.data.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            for line in self.lines:
                index.write(line.encode() + b"\n")
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.path, size, len(self.lines)


class _Forward:
    """A stream that cannot seek, as ``zipfile`` wants to see it."""

    def __init__(self, out: pa.NativeFile):
        self.write, self.flush, self.tell = out.write, out.flush, out.tell

    def seekable(self) -> bool:
        return False


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``classify`` to archives in ``folder``; path, size, records of each archive (staged)."""
    spark = pages.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in slices(batches, "payload"):
            for row in zip(*batch.columns, strict=True):
                page_id, uri, payload, digest, refers_to = (v.as_py() for v in row)
                uri = _address(page_id, uri)
                archive = archive or _Archive(folder)
                archive.add(_record(page_id, uri, payload, digest, refers_to), uri, digest)
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["path", "size", "records"],
        )

    rows = pages.select("page_id", "uri", "payload", "digest", "refers_to")
    return stage(rows.mapInArrow(run, ARCHIVES), "archives")


# reading


@dataclass(frozen=True)
class Member:
    """A member of a ZIP file; ``start`` is where its bytes begin."""

    name: str
    method: int
    start: int
    size: int


def _zip64(extra: bytes, wanted: list[int]) -> list[int]:
    """Replace the values that do not fit 32 bits by those of the ZIP64 field, in its order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(values) if v == 0xFFFFFFFF else v for v in wanted]
        at += 4 + size
    return wanted


def read_directory(file: pa.NativeFile) -> list[Member]:
    """The members of a ZIP file, from its central directory."""
    size = file.size()
    tail_at = max(0, size - TAIL)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("not a ZIP file: it has no end record")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or 0xFFFFFFFF in (length, offset):
        sign, _, at = struct.unpack_from("<IIQ", tail, end - 20)
        if end < 20 or sign != 0x07064B50:
            raise ValueError("the ZIP64 locator is missing")
        record = file.read_at(56, at)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is missing")
        count, length, offset = struct.unpack_from("<QQQ", record, 32)
    directory, members, at = file.read_at(length, offset), [], 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        name, extra = directory[at + 46 : at + 46 + n], directory[at + 46 + n : at + 46 + n + m]
        plain, packed, local = _zip64(extra, [plain, packed, local])
        # the local header's own extra field may differ in length from the directory's
        head = file.read_at(30, local)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name!r} has no local header")
        members.append(Member(name.decode(), method, local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed))
        at += 46 + n + m + k
    return members


def _open(path: str) -> pa.NativeFile:
    store, base = fs.FileSystem.from_uri(path)
    return store.open_input_file(base)


def _lines(file: pa.NativeFile, member: Member, block: int = 4 << 20) -> Iterator[bytes]:
    rest = b""
    for at in range(0, member.size, block):
        *whole, rest = (rest + file.read_at(min(block, member.size - at), member.start + at)).split(b"\n")
        yield from whole
    if rest:
        yield rest


def locate(archives: DataFrame, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """The byte ranges to fetch: path, start, size, and the lengths of the records in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _open(path) as file:
                    members = {m.name: m for m in read_directory(file)}
                    if any(members[n].method for n in (DATA, INDEX)):
                        raise ValueError(f"{path}: its members are not stored")
                    yield from _spans(path, file, members, span_bytes)

    # an archive is one row here, so each becomes a task of its own
    return archives.select("path").repartition(F.col("path")).mapInArrow(run, SPANS)


def _spans(path: str, file: pa.NativeFile, members: dict[str, Member], most: int) -> Iterator[pa.RecordBatch]:
    base, start, lengths = members[DATA].start, 0, []

    def span() -> pa.RecordBatch:
        columns = [[path], [base + start], [sum(lengths)], [lengths]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["path", "start", "size", "lengths"])

    for line in _lines(file, members[INDEX]):
        place = json.loads(line[line.index(b" {") + 1 :])
        at, length = place["offset"], place["length"]
        if lengths and (at != start + sum(lengths) or sum(lengths) + length > most):
            yield span()
            lengths = []
        if not lengths:
            start = at
        lengths.append(length)
    if lengths:
        yield span()


def _parse(record: bytes) -> tuple:
    """page_id, uri, record_type, payload, declared digest, refers_to of one unpacked record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(fields[b"Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]

    def page(field: bytes) -> int | None:
        name = fields.get(field, b"<urn:page:null>")[len("<urn:page:") : -1]
        return None if name == b"null" else int(name)

    return (
        page(b"WARC-Record-ID"),
        fields[b"WARC-Target-URI"].decode(),
        fields[b"WARC-Type"].decode(),
        payload,
        fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:"),
        page(b"WARC-Refers-To"),
    )


def read_records(spans: DataFrame) -> DataFrame:
    """The records in the ranges of ``locate``; a revisit's payload is empty."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64()]
    names = ["page_id", "uri", "record_type", "payload", "declared", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _open(path) as file:
                    data, at, rows = file.read_at(size, start), 0, []
                for length in lengths:
                    rows.append(_parse(zlib.decompress(data[at : at + length], 31)))
                    at += length
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    # many ranges of one archive spread over the tasks
    return spans.repartition(F.col("path"), F.col("start")).mapInArrow(run, RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit takes the size from its response.

    Fails if a payload does not have the digest that its record declares.
    """
    actual = F.sha2("payload", 256)
    checked = F.when(
        (F.col("record_type") == "response") & (actual != F.col("declared")),
        F.raise_error(F.concat(F.lit("payload differs from its digest: page "), F.col("page_id").cast("string"))),
    ).otherwise(F.col("declared"))
    rows = stage(
        records.select(
            "page_id",
            F.octet_length("payload").cast("long").alias("bytes"),
            checked.alias("payload_digest"),
            "record_type",
            "refers_to",
        ),
        "records",
    )
    responses = rows.where("record_type = 'response' AND page_id IS NOT NULL")
    sizes = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("bytes").alias("full")).distinct()
    wanted = rows.where("refers_to IS NOT NULL")
    full = hub_join(wanted, sizes, ["refers_to", "payload_digest"], "left").withColumn("bytes", F.col("full")).drop("full")
    return (
        rows.where("refers_to IS NULL")
        .unionByName(full)
        .select("page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    )


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back (see ``resolve``)."""
    archives = write_archives(classify(pages), new_path(spark, "warc"))
    return resolve(read_records(locate(archives)))
