"""WARC archives as a Spark data source, and pages archived with revisit records.

Writing: every task writes its records as gzip members of their own into files of
about ``FILE_BYTES``; a member's extra field states its length (the format's
skip-lengths). The files of the tasks that succeeded are named in a manifest when
the job commits, so files a lost task leaves behind are never read.

Reading: the files of all manifests are dealt to partitions of about
``PARTITION_BYTES``. Comparisons of header columns are taken over from Spark
(``spark.sql.python.filterPushdown.enabled``): a record's headers are inflated first
and parsed; a record that fails, or whose payload nobody wants (``payload`` is
``false``), is stepped over by its stated length, its payload neither inflated nor
decoded. The digest of a payload that is read is compared with the header.

Pages: rows with equal payloads (length and SHA-256) are one response, of the row
with the largest page id, and revisits of it. The counted payloads decide: those that
occur in more than a thousandth of the rows are fewer than a thousand and are
broadcast, all others are joined by a shuffle, so no payload's rows meet in one task.

A null payload is empty; a null page id is the smallest, and its header is absent;
of rows that repeat a page id and a payload one is the response. Columns other than
id, address and payload are not read. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import time
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

from tributary.llm.common import stored

FORMAT = "warc"
FILE_BYTES = 32 << 20
PARTITION_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
READ_BYTES = 1 << 16
HEAD_BYTES = 1 << 16  # inflated in search of the end of the headers, and again as long as it is missing
HOT_SHARE = 1000  # a payload with more than this part of the rows is hot
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
MANIFEST = re.compile(r"_files-[0-9a-f]{32}\.json")

# Column of a record, and the header it holds.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
HTTP = "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE, REFERS_TO_PAGE = "X-Page-Id", "X-Refers-To-Page-Id"
RECORD = """
record_type string, record_id string, target_uri string, date string, content_type string,
payload_digest string, refers_to string, http_length long, payload binary
"""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32(digest: Column) -> Column:
    """Upper-case base32 of a SHA-1 digest in hex: 20 bits are four digits, whatever the alphabet."""
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# Records


def header_value(text: str) -> str:
    """A value that fits one header line: control characters and spaces at its ends are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]|^ +| +$", lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), text)


def member(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """A record as a gzip member whose extra field holds its whole and its inflated length."""
    lines = [f"{name}: {header_value(value)}\r\n" for name, value in headers]
    head = ("WARC/1.1\r\n" + "".join(lines) + f"Content-Length: {len(block)}\r\n\r\n").encode()
    record = head + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(record) + packer.flush()
    fixed = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff"
    size = len(fixed) + 2 + 12 + len(body) + 8
    stated = (size, len(record)) if max(size, len(record)) < 1 << 32 else (0, 0)
    extra = b"sl" + struct.pack("<HII", 8, *stated)
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    return fixed + struct.pack("<H", len(extra)) + extra + body + tail


class BrokenArchive(ValueError):
    """A file that is no archive of records, or a payload that is not what its header says."""


class Members:
    """The records of one archive file, read front to back; a record can be left before its end."""

    def __init__(self, stream, name: str = ""):
        self.stream, self.name, self.held, self.inflated = stream, name, b"", 0

    def _fill(self, size: int) -> bool:
        while len(self.held) < size:
            more = self.stream.read(max(READ_BYTES, size - len(self.held)))
            if not more:
                return False
            self.held += more
        return True

    def _skip(self, size: int) -> None:
        if size > len(self.held):
            self.stream.seek(size - len(self.held), 1)
            self.held = b""
        else:
            self.held = self.held[size:]

    def _start(self) -> tuple[int, int]:
        """Bytes before the deflated data, and the stated length of the member, 0 if it is not stated."""
        self._need(12)
        if self.held[:3] != b"\x1f\x8b\x08":
            raise BrokenArchive(f"{self.name}: no gzip member where one should begin")
        flags, at, stated = self.held[3], 10, 0
        if flags & 4:
            (size,) = struct.unpack_from("<H", self.held, 10)
            self._need(12 + size)
            field, at = self.held[12 : 12 + size], 12 + size
            while len(field) >= 4:
                kind, (own,) = field[:2], struct.unpack_from("<H", field, 2)
                if kind == b"sl" and own == 8:
                    (stated,) = struct.unpack_from("<I", field, 4)
                field = field[4 + own :]
        for flag in (8, 16):
            if flags & flag:
                while (end := self.held.find(b"\x00", at)) < 0:
                    self._need(len(self.held) + 1)
                at = end + 1
        return at + 2 if flags & 2 else at, stated

    def _need(self, size: int) -> None:
        if not self._fill(size):
            raise BrokenArchive(f"{self.name}: ends inside a record")

    def records(self, wanted: Callable[[dict[str, str]], bool], payload: bool) -> Iterator[tuple[dict, bytes | None]]:
        """Headers of the wanted records, by lower-case name, and their blocks if payloads are asked for."""
        while self._fill(1):
            start, stated = self._start()
            self._skip(start)
            left = stated - start if stated else None  # bytes of the member not yet taken
            unpacker, text = zlib.decompressobj(-zlib.MAX_WBITS), b""

            def inflate(most: int, unpacker=unpacker) -> bytes:
                nonlocal left
                while not unpacker.eof:
                    source = unpacker.unconsumed_tail
                    if not source:
                        self._need(1 if left is None or left else len(self.held) + 1)
                        source, self.held = self.held[:left], b"" if left is None else self.held[left:]
                        left = None if left is None else left - len(source)
                    if part := unpacker.decompress(source, most):
                        return part
                return b""

            while (end := text.find(b"\r\n\r\n")) < 0:
                if not (part := inflate(HEAD_BYTES)):
                    raise BrokenArchive(f"{self.name}: a record without headers")
                text += part
            headers = parse_headers(text[:end])
            size = int(headers.get("content-length", "0"))
            take = wanted(headers)
            if take and payload:
                parts, held = [text[end + 4 :]], len(text) - end - 4
                while held < size:
                    if not (part := inflate(size - held)):
                        raise BrokenArchive(f"{self.name}: ends inside a payload")
                    parts.append(part)
                    held += len(part)
                self.inflated += held
                yield headers, b"".join(parts)[:size]
            elif take:
                yield headers, None
            if left is None:
                while inflate(READ_BYTES):
                    pass
                self.held, left = unpacker.unused_data + self.held, 8
            if left:
                self._skip(left - 1)
                self._need(1)
                self._skip(1)


def parse_headers(text: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with white space carries on the one before."""
    headers: dict[str, str] = {}
    last = None
    for line in text.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            headers[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            headers[last] = value.strip()
    return headers


def http_payload(headers: dict[str, str], block: bytes) -> tuple[int | None, bytes]:
    """Length stated by the HTTP headers of a block, and the payload behind them."""
    if not headers.get("content-type", "").startswith("application/http"):
        return None, block
    head, _, payload = block.partition(b"\r\n\r\n")
    length = parse_headers(head).get("content-length")
    return int(length) if length else None, payload


# Storage


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (fs.LocalFileSystem(), path)


def committed(path: str) -> list[tuple[str, int]]:
    """Names and sizes of the files of all committed writes."""
    system, root = place(path)
    found = []
    for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if MANIFEST.fullmatch(info.base_name):
            with system.open_input_file(info.path) as file:
                found += [tuple(x) for x in json.loads(file.read())]
    return sorted(found)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of (record_type, record_id, target_uri, date, ..., block) as records.

    Every column but ``block`` is a header, by the names of ``HEADERS`` or its own;
    null ones are left out.
    """

    def __init__(self, path: str, names: list[str], file_bytes: int):
        self.path, self.names, self.file_bytes = path, names, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = place(self.path)
        system.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in zip(*(batch.column(n).to_pylist() for n in self.names), strict=True):
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, size = system.open_output_stream(f"{root}/{name}", compression=None), 0
                    cells = dict(zip(self.names, row, strict=True))
                    block = cells.pop("block") or b""
                    headers = [(HEADERS.get(n, n), str(v)) for n, v in cells.items() if v is not None]
                    size += out.write(record := member(headers, block)) or len(record)
                    if size >= self.file_bytes:
                        out.close()
                        files.append((name, size))
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written([*files, (name, size)] if out is not None else files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = place(self.path)
        system.create_dir(root, recursive=True)
        files = [f for m in messages if m for f in m.files]
        with system.open_output_stream(f"{root}/_files-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Nothing names the files that were written."""


class Files(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)
        self.names = names


# Whether the text of a header, None without it, passes a comparison.
PASSES = {
    "IsNull": lambda held, _: held is None,
    "IsNotNull": lambda held, _: held is not None,
    "EqualNullSafe": lambda held, value: held == value,
    "EqualTo": lambda held, value: held is not None and held == value,
    "In": lambda held, values: held is not None and held in values,
    "StringStartsWith": lambda held, value: held is not None and value is not None and held.startswith(value),
}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: dict[str, str], payload: bool):
        self.path, self.columns, self.payload = path, columns, payload
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        """Comparisons of header columns with texts are ours; Spark keeps all others."""
        for one in filters:
            name = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
            header = self.columns.get(name)
            if header and isinstance(one, (IsNull, IsNotNull)):
                self.tests.append((type(one).__name__, header, None))
            elif header and isinstance(one, (EqualTo, EqualNullSafe, In, StringStartsWith)):
                self.tests.append((type(one).__name__, header, one.value))
            else:
                yield one

    def wanted(self, headers: dict[str, str]) -> bool:
        return all(PASSES[kind](headers.get(header), value) for kind, header, value in self.tests)

    def partitions(self) -> list[Files]:
        parts, size = [], 0
        for name, own in committed(self.path):
            if not parts or size + own > PARTITION_BYTES:
                parts.append([])
                size = 0
            parts[-1].append(name)
            size += own
        return [Files(names) for names in parts or [[]]]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, root = place(self.path)
        rows, size = [], 0
        for name in partition.names:
            with system.open_input_file(f"{root}/{name}") as file:
                for headers, block in Members(file, name).records(self.wanted, self.payload):
                    length, payload = None, None
                    if block is not None:
                        length, payload = http_payload(headers, block)
                        payload = self._checked(name, headers, payload)
                    rows.append([*(headers.get(h) for h in self.columns.values()), length, payload])
                    size += len(payload or b"") + 500
                    if size > BATCH_BYTES:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[list]) -> pa.RecordBatch:
        kinds = [*[pa.string()] * len(self.columns), pa.int64(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[*self.columns, "http_length", "payload"])

    def _checked(self, name: str, headers: dict[str, str], payload: bytes) -> bytes | None:
        """The payload, which a revisit has none of, if it is what its digest says."""
        if headers.get("warc-type") == "revisit":
            return None
        stated = headers.get("warc-payload-digest", "")
        if stated.startswith("sha1:") and stated != f"sha1:{sha1_base32(payload)}":
            raise BrokenArchive(f"{name}: payload of {headers.get('warc-record-id')} does not have its digest")
        return payload


class Warc(DataSource):
    """Options: ``path``; ``payload`` (``false`` leaves payloads undecoded); ``fields``, a comma
    separated list of further headers to give as columns; ``fileBytes``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _fields(self) -> list[str]:
        return [f for f in self.options.get("fields", "").split(",") if f]

    def schema(self) -> str:
        base, http = RECORD.strip().rsplit(", http_length", 1)
        return ", ".join([base, *(f"`{f}` string" for f in self._fields()), f"http_length{http}"])

    def reader(self, schema) -> WarcReader:
        columns = {c: h.lower() for c, h in HEADERS.items()} | {f: f.lower() for f in self._fields()}
        return WarcReader(self.options["path"], columns, self.options.get("payload", "true") != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"], schema.fieldNames(), int(self.options.get("filebytes", FILE_BYTES)))


def read_warc(spark: SparkSession, path: str, payload: bool = True, fields: str = "") -> DataFrame:
    """Records of an archive; comparisons of header columns are handed to the source."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(Warc)
    return spark.read.format(FORMAT).options(payload=str(payload).lower(), fields=fields).load(path)


def write_warc(records: DataFrame, path: str) -> None:
    """Appends records: a column ``block`` and headers, named as in ``HEADERS`` or by themselves."""
    records.sparkSession.dataSource.register(Warc)
    records.write.format(FORMAT).mode("append").save(path)


# Pages


def with_responses(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``best``: the order columns of the row that stands for all with equal keys, null if it is alone.

    ``rows`` is a stored table; the last order column is unique.
    """
    groups = rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("best"), F.count("*").alias("copies"))
    several = stored(groups.filter("copies > 1"), "copies")
    limit = rows.count() / HOT_SHARE
    hot = F.broadcast(several.filter(F.col("copies") > limit).drop("copies"))  # fewer than HOT_SHARE rows
    rest = several.filter(F.col("copies") <= limit).drop("copies")
    return rows.join(hot, keys).unionByName(
        rows.join(hot, keys, "left_anti").join(rest.hint("shuffle_hash"), keys, "left")
    )


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str | None = None
) -> DataFrame:
    """The record of every page: headers and block, ready to be written."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = stored(
        pages.select(
            F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
        ).select(
            "*",
            F.monotonically_increasing_id().alias("row"),
            F.octet_length("payload").cast("long").alias("length"),
            F.unhex(F.sha2("payload", 256)).alias("sha256"),
        ),
        "pages",
    )
    decided = with_responses(rows, ["length", "sha256"], ["page_id", "row"])
    revisit = F.col("best").isNotNull() & (F.col("best.row") != F.col("row"))
    digest = F.concat(F.lit("sha1:"), base32(F.sha1("payload")))

    def name(row: Column) -> Column:
        """A record's id, made of the payload and the row."""
        text = F.md5(F.concat(F.hex("sha256"), F.lit("/"), row.cast("string")))
        parts = [F.substring(text, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    answer = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("length").cast("string"),
        F.lit("\r\n\r\n"),
    ).cast("binary")
    stamp = date or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    return decided.select(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        name(F.col("row")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(stamp).alias("date"),
        F.lit(HTTP).alias("content_type"),
        digest.alias("payload_digest"),
        F.when(revisit, name(F.col("best.row"))).alias("refers_to"),
        F.when(revisit, F.lit(PROFILE)).alias("WARC-Profile"),
        F.col("page_id").cast("string").alias(PAGE),
        F.when(revisit, F.col("best.page_id").cast("string")).alias(REFERS_TO_PAGE),
        F.when(revisit, answer).otherwise(F.concat(answer, F.col("payload"))).alias("block"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The archived pages: page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload.

    ``payload_bytes`` is measured for responses; revisits state it.
    """
    records = read_warc(spark, path, fields=f"{PAGE},{REFERS_TO_PAGE}")
    response = F.col("record_type") == "response"
    return records.select(
        F.col(PAGE).cast("long").alias("page_id"),
        F.col("target_uri").alias("url"),
        "record_type",
        F.substring("payload_digest", len("sha1:") + 1, 32).alias("payload_digest"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.col(REFERS_TO_PAGE).cast("long").alias("refers_to"),
        "payload",
    )
