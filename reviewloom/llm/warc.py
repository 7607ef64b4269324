"""Web archives with a two-level capture index.

Pages become WARC records, one gzip member each, in one file a task. Of records with equal payloads (of at
least ``revisit_bytes`` bytes) the one with the smallest page id is a response; the others are revisits that
refer to it and carry no payload. The capture index is sorted by reversed-host URL key and page id, over all
files: lines in compressed blocks, and per index file a sparse directory with the first key of every block.
A look-up searches the list of index files, then a directory, then a block, each by bisection, and reads the
record as a byte range.

A null html is an empty payload; a null url gives the key ``-`` and no target URI. A null page id is kept as a
null. Repeated rows of the smallest page id are all responses. Other columns are ignored. An empty table gives
an archive without files and no captures.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm import files
from reviewloom.llm.columns import utf8
from reviewloom.plans.storage import materialise, scratch_path

REVISIT_BYTES = 100
BLOCK_LINES = 1000
CAPTURE_TIME = "2024-01-01T00:00:00Z"
_RECORD = "urn:x-page:"


def url_key(url: str | None) -> str:
    """The URL with its host reversed: ``com,example,www)/path?query``; the same for its form in a header."""
    if not url:
        return "-"
    url = _header(url)
    try:
        parts = urlsplit(url)
        host, port = unquote(parts.hostname or "", errors="surrogateescape").lower(), parts.port
    except ValueError:
        return quote(url, safe="%/:?=&;+,()[]@!$'*~#")
    if not host:
        return quote(url, safe="%/:?=&;+,()[]@!$'*~#")
    host = quote(host.removeprefix("www."), safe="!$&'()*+,;=:[]~", errors="surrogateescape")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")"
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return key + quote(rest, safe="%/:?=&;+,()[]@!$'*~")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Sorts by URL key, then page id."""
    return f"{url_key(url)} {'-' if page_id is None else f'{page_id + (1 << 63):020d}'}"


def _header(value: str) -> str:
    return quote(value, safe="%/:?=&;+,()[]@!$'*~#")


def response(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = {
        "WARC-Type": "response",
        "WARC-Payload-Digest": f"sha256:{sha256(payload).hexdigest()}",
        "Content-Type": "application/http;msgtype=response",
    }
    return _record(page_id, url, lines, http + payload)


def revisit(page_id: int | None, url: str | None, digest: str, refers_to: int, refers_url: str | None) -> bytes:
    lines = {
        "WARC-Type": "revisit",
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Refers-To": f"<{_RECORD}{refers_to}>",
    }
    if refers_url:
        lines["WARC-Refers-To-Target-URI"] = _header(refers_url)
    return _record(page_id, url, lines, b"")


def _record(page_id: int | None, url: str | None, lines: dict[str, str], block: bytes) -> bytes:
    first = {"WARC-Record-ID": f"<{_RECORD}{'' if page_id is None else page_id}>", "WARC-Date": CAPTURE_TIME}
    if url:
        first["WARC-Target-URI"] = _header(url)
    every = first | lines | {"Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in every.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; the payload of a revisit is empty."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(lines["Content-Length"])]
    return lines, block.partition(b"\r\n\r\n")[2]


def _page(record_id: str) -> int | None:
    number = record_id.strip("<>").removeprefix(_RECORD)
    return int(number) if number else None


@dataclass(frozen=True)
class IndexFile:
    """First key of an index file and the place of its directory."""

    first: str
    path: str
    offset: int
    length: int


def revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, refers_to, refers_url) of the pages whose payload an earlier page id has."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    captures = pages.select(
        "page_id", "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")
    ).where((F.col("n") >= least_bytes) & F.col("page_id").isNotNull())
    firsts = captures.groupBy("digest").agg(
        F.min(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("copies")
    ).where("copies > 1")
    return (
        captures.join(firsts, "digest")
        .where(F.col("page_id") != F.col("first.page_id"))
        .select("page_id", "digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"))
        .distinct()
    )


def write_archive(pages: DataFrame, least_bytes: int = REVISIT_BYTES, folder: str | None = None) -> list[IndexFile]:
    """Writes archives and index; the result is one entry for each index file, in the order of keys."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at = files.new_name(folder, TaskContext.get().partitionId(), ".warc.gz"), None, 0
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            page_ids, urls, digests, refers, refers_urls = (batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5))
            keys, places = [], []
            for k, (page_id, url) in enumerate(zip(page_ids, urls)):
                if refers[k] is None:
                    record = response(page_id, url, data[offsets[k] : offsets[k + 1]].tobytes())
                else:
                    record = revisit(page_id, url, digests[k], refers[k], refers_urls[k])
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(record) + packer.flush()
                out = out or files.create(path)
                out.write(member)
                keys.append(capture_key(url, page_id))
                places.append((at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array([path] * len(keys), pa.string()),
                    pa.array([p[0] for p in places], pa.int64()),
                    pa.array([p[1] for p in places], pa.int64()),
                ],
                names=["key", "path", "offset", "length"],
            )
        if out:
            out.close()

    again = revisits(pages, least_bytes).select(
        F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to", "refers_url"
    )
    payload = F.coalesce("html", F.lit(""))
    same = (F.col("page_id") == F.col("again_id")) & (F.sha2(payload.cast("binary"), 256) == F.col("again_digest"))
    rows = pages.select("page_id", "url", "html").join(again, same, "left").select(
        F.col("page_id").cast("long"),
        "url",
        F.when(F.col("refers_to").isNull(), payload).otherwise(F.lit("")).alias("html"),
        "again_digest",
        F.col("refers_to").cast("long"),
        "refers_url",
    )
    captures = materialise(rows.mapInArrow(write, "key string, path string, offset long, length long"))
    return write_index(captures, folder)


def write_index(captures: DataFrame, folder: str) -> list[IndexFile]:
    """Sorts captures (key, path, offset, length) into index files of compressed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = files.new_name(folder, TaskContext.get().partitionId(), ".cdx")
        out, at, directory, lines = None, 0, [], []

        def block() -> None:
            nonlocal out, at
            out = out or files.create(path)
            packed = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
            out.write(packed)
            directory.append((lines[0][0], at, len(packed)))
            at += len(packed)
            lines.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(line)
                if len(lines) == BLOCK_LINES:
                    block()
        if lines:
            block()
        if out:
            packed = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(packed)
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([directory[0][0]]), pa.array([path]), pa.array([at]), pa.array([len(packed)])],
                names=["first", "path", "offset", "length"],
            )

    ordered = captures.repartitionByRange("key").sortWithinPartitions("key")
    index = materialise(ordered.mapInArrow(run, "first string, path string, offset long, length long"))
    # One row a partition of the index.
    return [IndexFile(*row) for row in index.orderBy("first").collect()]


class Reader:
    """Looks captures up through the index, with a few directories, blocks and files at hand."""

    def __init__(self, index: list[IndexFile]):
        self.index = index
        self.firsts = [x.first for x in index]
        self.kept: OrderedDict = OrderedDict()

    def _keep(self, key: tuple, make, most: int = 64):
        if key in self.kept:
            self.kept.move_to_end(key)
        else:
            self.kept[key] = make()
            if len(self.kept) > most:
                self.kept.popitem(last=False)
        return self.kept[key]

    def _read(self, path: str, offset: int, length: int) -> bytes:
        return self._keep(("file", path), lambda: files.open_ranges(path)).read_at(length, offset)

    def _unpacked(self, path: str, offset: int, length: int):
        return json.loads(zlib.decompress(self._read(path, offset, length)))

    def _lines(self, path: str, offset: int, length: int) -> tuple[list[str], list]:
        text = zlib.decompress(self._read(path, offset, length)).decode()
        lines = [json.loads(line) for line in text.split("\n")]
        return [line[0] for line in lines], lines

    def find_all(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(path, offset, length) of every record with this capture key, which may go on in further blocks."""
        k = max(bisect_left(self.firsts, key) - 1, 0)
        while k < len(self.index) and self.firsts[k] <= key:
            at = self.index[k]
            directory = self._keep(("directory", at.path), lambda at=at: self._unpacked(at.path, at.offset, at.length))
            b = max(bisect_left(directory, key, key=lambda x: x[0]) - 1, 0)
            while b < len(directory) and directory[b][0] <= key:
                place = directory[b][1:]
                keys, lines = self._keep(("block", at.path, b), lambda at=at, place=place: self._lines(at.path, *place))
                for line in lines[bisect_left(keys, key) : bisect_right(keys, key)]:
                    yield tuple(line[1:])
                b += 1
            k += 1

    def find(self, key: str) -> tuple[str, int, int] | None:
        """(path, offset, length) of the first record with this capture key."""
        return next(self.find_all(key), None)

    def records(self, key: str) -> Iterator[tuple[dict[str, str], bytes]]:
        for place in self.find_all(key):
            yield parse(zlib.decompress(self._read(*place), 31))

    def payload(self, lines: dict[str, str]) -> tuple[int, str]:
        """Bytes and digest of the payload that a revisit refers to, from that response."""
        refers_to, named = _page(lines["WARC-Refers-To"]), lines["WARC-Payload-Digest"].partition(":")[2]
        key = capture_key(lines.get("WARC-Refers-To-Target-URI"), refers_to)

        def measure() -> tuple[int, str]:
            for own, payload in self.records(key):
                if own["WARC-Type"] == "response" and (digest := sha256(payload).hexdigest()) == named:
                    return len(payload), digest
            raise LookupError(f"a revisit refers to page {refers_to}, which is not in the archive")

        return self._keep(("payload", key, named), measure)


def capture_keys(pages: DataFrame) -> DataFrame:
    """(key) of every row of ``pages`` (page_id, url)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [capture_key(u, p) for p, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"])

    return pages.select(F.col("page_id").cast("long"), "url").mapInArrow(run, "key string")


def look_up(keys: DataFrame, index: list[IndexFile]) -> DataFrame:
    """The captures with these keys, read from the archives; keys that are not there give no row.

    A key that is asked for several times, as that of several rows of one page and address, is looked up once, and gives
    every record that has it. Columns: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(index)
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                for lines, payload in reader.records(key):
                    page_id, kind = _page(lines["WARC-Record-ID"]), lines["WARC-Type"]
                    if kind == "revisit":
                        rows.append((page_id, *reader.payload(lines), kind, _page(lines["WARC-Refers-To"])))
                    else:
                        rows.append((page_id, len(payload), sha256(payload).hexdigest(), kind, None))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )

    # Sorted keys meet each block of the index once.
    # Keys are small and the records behind them are not, so partitions are not merged by size.
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.select("key").distinct().repartitionByRange(parts, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


