"""WARC archives: a writer with revisit records, and a Python data source that reads them.

A record's block is an HTTP response: its header gives the payload's length, and a revisit record
holds that header alone. In compressed archives every record is a gzip member of its own whose extra
field `sl` states the member's compressed and uncompressed length, so that the reader inflates only
the first bytes of a record, decides by its headers, and steps over the rest.

The reader plans partitions of whole files by bytes, takes predicates on record type, record id, target
URI, payload digest and the page referred to, parses headers first, and inflates and decodes a payload
only if the record is wanted and the option `payload` is not "false".

A null payload counts as empty, and equal payloads include empty ones. Rows with the same page id and
payload give a record each, one of them the response. A null page id gives a record without page;
revisits of it refer to no page. An empty table gives a folder without archives, which reads as empty.
Only the id, the URL and the payload column are read; line breaks in a URL are written as %0A and %0D.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tidemill.llm.common import columns, small_batches, store
from tidemill.session import materialize

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 256 << 20  # an archive is closed once it is this long
HEAD_BYTES = 4096  # read at once to parse a record's headers
PAGE = "urn:page:"
LOWEST = -(1 << 63)

SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, "
    "payload_bytes bigint, payload binary"
)
HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 20-byte digest given in hexadecimal: five bytes become eight letters."""
    groups = [
        F.lpad(F.conv(F.substring(hex_digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)
    ]
    # fixed values: the digits of base 32 and the letters that stand for them
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def assign_records(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """Each page with its digest, its record type and, for revisits, the page of the response.

    Of equal payloads the page with the largest id is the response, among rows of that id the one with the largest URL,
    and of rows equal in all three, one: decided by their values alone, so that every plan of the input gives the same.
    Groups are reduced to one row before they are joined back, so a payload that a third of the pages share costs no
    more than others; only rows that are equal in all three are put together.
    """
    source = columns(pages, id_col, url_col, payload_col)
    text = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    page = F.col(f"`{id_col}`").cast("long")
    source = source.select(
        page.alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        text.alias("payload"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha1(text.cast("binary")).alias("sha1"),
        F.struct(F.coalesce(page, F.lit(LOWEST)).alias("page"), F.col(f"`{url_col}`").cast("string").alias("url")).alias("place"),
    )
    places = source.where(F.col("n_bytes") >= min_bytes).groupBy("sha1", "n_bytes", "place").agg(F.count("*").alias("rows"))
    best = places.groupBy("sha1", "n_bytes").agg(F.max("place").alias("last"), F.max_by("rows", "place").alias("rows"))
    best = materialize(best, "responses")
    met = source.join(best, ["sha1", "n_bytes"], "left").withColumn("first", F.col("last").isNull() | F.col("place").eqNullSafe(F.col("last")))
    named = met.where(~F.col("first") | (F.coalesce("rows", F.lit(1)) == 1))
    named = named.withColumn("again", ~F.col("first"))
    tied = best.where("rows > 1")
    if not tied.isEmpty():  # some rows are equal in page, URL and payload: one of them is the response
        equal = source.join(tied, ["sha1", "n_bytes"]).where(F.col("place").eqNullSafe(F.col("last")))
        equal = equal.groupBy("sha1", "n_bytes", "page_id", "url", "last").agg(F.any_value("payload").alias("payload"), F.count("*").alias("rows"))
        equal = equal.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        named = named.unionByName(equal.withColumn("again", F.col("copy") > 1), allowMissingColumns=True)
    return named.select(
        "page_id",
        "url",
        F.when(~F.col("again"), F.col("payload")).alias("payload"),
        "n_bytes",
        base32(F.col("sha1")).alias("digest"),
        F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
        F.when(F.col("again") & (F.col("last.page") != LOWEST), F.col("last.page")).alias("refers_to"),
    )


def record(page_id, url, payload: bytes | None, n_bytes: int, digest: str, kind: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: <{PAGE}{refers_to}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """One gzip member with the `sl` extra field: its own length and that of the data."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, length, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    compressed: bool = True,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> str:
    """Write one record per page; each task writes its own archives. Returns the folder."""
    fs, base = store(folder)
    fs.create_dir(base, recursive=True)
    records = assign_records(pages, min_bytes, id_col, url_col, payload_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, out_base = store(folder)
        part, files, sink, draft, written, total = TaskContext.get().partitionId(), 0, None, "", 0, 0

        def close() -> None:
            sink.close()
            out_fs.move(draft, f"{out_base}/part-{part:05d}-{files:04d}.warc{'.gz' if compressed else ''}")

        for batch in batches:
            payloads = batch.column(2).cast(pa.binary()).to_pylist()
            others = [batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5, 6)]
            for payload, page_id, url, n_bytes, digest, kind, refers_to in zip(payloads, *others, strict=True):
                if sink is None:
                    draft = f"{out_base}/_draft-{part:05d}-{uuid.uuid4().hex}"
                    sink, written = out_fs.open_output_stream(draft), 0
                data = record(page_id, url, payload, n_bytes, digest, kind, refers_to)
                data = member(data) if compressed else data
                sink.write(data)
                written += len(data)
                total += 1
                if written >= FILE_BYTES:
                    close()
                    sink, files = None, files + 1
        if sink is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["records"])

    small_batches(records).mapInArrow(run, "records bigint").agg(F.sum("records")).collect()
    return folder


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.bytes = int(options.get("partitionBytes", str(32 << 20)))
        self.wanted: list[tuple[str, frozenset[str]]] = []

    def pushFilters(self, filters: list[Filter]):
        """Take equality and membership tests on headers; Spark keeps the others."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if name not in HEADER_OF:
                yield f
            else:
                self.wanted.append((name, frozenset(f.value if isinstance(f, In) else [f.value])))

    def partitions(self):
        fs, base = store(self.folder)
        found = fs.get_file_info(pafs.FileSelector(base, recursive=True))
        found = sorted((x for x in found if x.is_file and x.path.endswith((".warc", ".warc.gz"))), key=lambda x: -x.size)
        plan: list[Files] = []
        room = 0
        for x in found:
            if x.size > room:
                plan.append(Files([]))
                room = max(self.bytes, x.size)
            plan[-1].paths.append(x.path)
            room -= x.size
        return plan or [Files([])]

    def read(self, partition: Files):
        fs, _ = store(self.folder)
        schema = pa.schema([(n, pa.string()) for n in HEADER_OF] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, size = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as f:
                for row in (self._members if path.endswith(".gz") else self._plain)(f):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 300
                    if size > 4 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _row(self, head: bytes) -> dict | None:
        """The header columns, or None if a pushed predicate rules the record out."""
        found = {}
        for line in head.split(b"\r\n")[1:]:
            name, _, value = line.decode().partition(":")
            found[name.strip().lower()] = value.strip()
        row = {n: found.get(h) for n, h in HEADER_OF.items()}
        for n in ("record_id", "refers_to"):
            row[n] = row[n] and row[n].strip("<>")
        row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
        if any(row[n] not in values for n, values in self.wanted):
            return None
        return row | {"length": int(found["content-length"])}

    def _finish(self, row: dict, block: bytes, whole) -> dict:
        """Payload length from the HTTP header; the payload only if it is asked for and there."""
        http, _, _ = block.partition(b"\r\n\r\n")
        lengths = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        row["payload_bytes"] = int(lengths[0]) if lengths else None
        keep = self.payload and row["record_type"] != "revisit"
        row["payload"] = whole()[len(http) + 4 : row["length"]] if keep else None
        del row["length"]
        return row

    def _members(self, f):
        at, end = 0, f.size()
        while at < end:
            f.seek(at)
            raw = f.read(HEAD_BYTES)
            if raw[:4] != b"\x1f\x8b\x08\x04" or raw[12:14] != b"sl":
                raise ValueError("a gzip member without its length: recompress the archive record by record")
            length = struct.unpack("<I", raw[16:20])[0]
            inflate = zlib.decompressobj(-15)
            data = inflate.decompress(raw[24:], HEAD_BYTES)
            fed = len(raw)
            while (cut := data.find(b"\r\n\r\n")) < 0 or data.find(b"\r\n\r\n", cut + 4) < 0:
                more = inflate.unconsumed_tail
                if not more:
                    more = f.read(min(HEAD_BYTES, at + length - fed))
                    if not more:
                        break
                    fed += len(more)
                data += inflate.decompress(more, HEAD_BYTES)
            row = self._row(data[:cut])
            if row is not None:
                def whole(f=f, at=at, length=length, fed=fed, data=data, inflate=inflate, cut=cut):
                    rest = inflate.decompress(inflate.unconsumed_tail) if inflate.unconsumed_tail else b""
                    f.seek(at + fed)
                    rest += inflate.decompress(f.read(max(0, length - fed)))
                    return (data + rest)[cut + 4 :]

                yield self._finish(row, data[cut + 4 :], whole)
            at += length

    def _plain(self, f):
        at, end = 0, f.size()
        while at < end:
            f.seek(at)
            data = f.read(HEAD_BYTES)
            while (cut := data.find(b"\r\n\r\n")) < 0 and (more := f.read(HEAD_BYTES)):
                data += more
            row = self._row(data[:cut])
            start = at + cut + 4
            length = int([x for x in data[:cut].lower().split(b"\r\n") if x.startswith(b"content-length:")][0].split(b":")[1])
            if row is not None:
                def whole(f=f, start=start, length=length):
                    f.seek(start)
                    return f.read(length)

                f.seek(start)
                yield self._finish(row, f.read(min(length, HEAD_BYTES)), whole)
            at = start + length + 4


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    records = spark.read.format("warc").option("payload", str(payload).lower()).load(folder)
    # A plan without any predicate would be read by those that an earlier plan of the same frame pushed down.
    return records.where("record_id IS NOT NULL")


def page_of(uri: Column) -> Column:
    return F.nullif(F.substring(uri, len(PAGE) + 1, 30), F.lit("")).cast("long")
