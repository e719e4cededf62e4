"""WARC archives with a two-level capture index.

Every task writes its records, each a gzip member of its own, to a file in the shared
folder.  The index has a line per record, sorted by reversed-host url key and page, in
compressed blocks of ``BLOCK_LINES``; for every block a sparse directory keeps its first key
and where it lies.  A range-partitioned index is a file of blocks and a small directory
per partition, and a table with a row per partition on top.

A look-up searches the partitions, then the directory of one, by bisection, reads one
block, and reads the record's range of bytes.  Look-ups come sorted, so neighbours
share blocks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm.storage import located, new_folder
from twinfold.llm.urls import after_scheme, host_of, reversed_host
from twinfold.session import stage

REVISIT_BYTES = 1000
BLOCK_LINES = 1000
FILE_BYTES = 1 << 30
GZIP_LEVEL = 6
READ_BYTES = 32 << 20  # of archives that a task reads
OPEN_FILES = 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """``org,example,www,)/path?query``: sorts a site's hosts and pages together."""
    rest = F.regexp_extract(after_scheme(url), "^[^/?#]*([^#]*)", 1)
    return F.concat(reversed_host(host_of(url), ","), F.lit(")"), rest)


def capture_key() -> Column:
    """The url key and the page, so that many captures of one url are many keys."""
    page = F.coalesce(F.format_string("%020d", F.col("page_id")), F.lit("-"))
    return F.concat(url_key(F.col("url")), F.lit(" "), page)


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit of another page's."""
    sha = hashlib.sha1(payload).digest()
    name = "null" if page_id is None else str(page_id)
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha).decode()}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    else:
        body += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Page, type, size and digest of the payload and the page referred to.

    A response's payload is measured and digested anew and must fit its header.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = body.partition(b"\r\n\r\n")[2]
        if (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    page = lambda name: name.removeprefix("<urn:page:").removesuffix(">")
    own = page(fields["WARC-Record-ID"])
    return {
        "page_id": None if own == "null" else int(own),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": int(page(fields["WARC-Refers-To"])) if "WARC-Refers-To" in fields else None,
    }


ENTRY = "capture_key string, file string, position long, bytes long"


def _write_records(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, name, at = None, "", 0
        for batch in batches:
            out: dict[str, list] = {"capture_key": [], "file": [], "position": [], "bytes": []}
            for row in batch.to_pylist():
                if stream is None or at >= FILE_BYTES:
                    if stream is not None:
                        stream.close()
                    name, at = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0
                    system, path = located(name)
                    stream = system.open_output_stream(path, compression=None)
                raw = record(row["page_id"], row["url"], row["payload"], row["refers_to"])
                member = gzip.compress(raw, GZIP_LEVEL, mtime=0)
                stream.write(member)
                for column, value in zip(out, (row["capture_key"], name, at, len(member))):
                    out[column].append(value)
                at += len(member)
            yield pa.RecordBatch.from_pydict(out)
        if stream is not None:
            stream.close()

    return run


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for each page to ``folder``; ``capture_key, file, position, bytes`` per record."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1("html"))
    # Only payloads that occur again; a row per payload.
    again = (
        rows.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("sha")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response_id"))
        .where("n > 1")
        .select("sha", "response_id")
    )
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
    records = rows.join(stage(again), "sha", "left").select(
        "page_id",
        "url",
        F.encode("html", "UTF-8").alias("payload"),
        refers_to.alias("refers_to"),
        capture_key().alias("capture_key"),
    )
    return stage(records.mapInArrow(_write_records(folder), ENTRY))


def _write_index(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = f"{folder}/index-{uuid.uuid4().hex}.cdx"
        system, path = located(blocks)
        directory: list[tuple[str, int, int]] = []
        waiting: list[list] = []
        with system.open_output_stream(path, compression=None) as stream:
            at = 0

            def close_block() -> int:
                block = zlib.compress("\n".join(map(json.dumps, waiting)).encode())
                stream.write(block)
                directory.append((waiting[0][0], at, len(block)))
                waiting.clear()
                return at + len(block)

            last = ""
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    waiting.append(list(row))
                    last = row[0]
                    if len(waiting) == BLOCK_LINES:
                        at = close_block()
            if waiting:
                close_block()
        if directory:
            system, path = located(f"{blocks}.directory")
            with system.open_output_stream(path, compression=None) as stream:
                stream.write(zlib.compress(json.dumps(directory).encode()))
            yield pa.RecordBatch.from_pydict(
                {"first_key": [directory[0][0]], "last_key": [last], "blocks": [blocks]}
            )

    return run


def write_index(entries: DataFrame, folder: str) -> DataFrame:
    """Write the index of ``entries``; a row per partition: ``first_key, last_key, blocks``."""
    dealt = entries.repartitionByRange("capture_key").sortWithinPartitions("capture_key", "file", "position")
    return stage(dealt.mapInArrow(_write_index(folder), "first_key string, last_key string, blocks string"))


class IndexReader:
    """Looks captures up; keeps the directory and the block read last, and a few open files."""

    def __init__(self, parts: list[tuple[str, str, str]]):
        self.parts = sorted(parts)
        self.firsts = [p[0] for p in self.parts]
        self.open: OrderedDict[str, object] = OrderedDict()
        self.directory_of = self.block_of = None

    def _read(self, uri: str, at: int, n: int) -> bytes:
        if uri not in self.open:
            if len(self.open) >= OPEN_FILES:
                self.open.popitem(last=False)[1].close()
            system, path = located(uri)
            self.open[uri] = system.open_input_file(path)
        self.open.move_to_end(uri)
        return self.open[uri].read_at(n, at)

    def _directory(self, blocks: str) -> list:
        if self.directory_of != blocks:
            system, path = located(f"{blocks}.directory")
            with system.open_input_stream(path, compression=None) as stream:
                self.directory = json.loads(zlib.decompress(stream.read()))
            self.directory_keys = [d[0] for d in self.directory]
            self.directory_of = blocks
        return self.directory

    def _block(self, blocks: str, at: int, n: int) -> list:
        if self.block_of != (blocks, at):
            lines = zlib.decompress(self._read(blocks, at, n)).split(b"\n")
            self.block = [json.loads(x) for x in lines]
            self.block_keys = [b[0] for b in self.block]
            self.block_of = (blocks, at)
        return self.block

    def find(self, key: str) -> Iterator[list]:
        """Index lines of ``key``, over blocks and partitions if there are many."""
        part = max(bisect_left(self.firsts, key) - 1, 0)
        for first, last, blocks in self.parts[part:]:
            if first > key:
                return
            if last < key:
                continue
            directory = self._directory(blocks)
            k = max(bisect_left(self.directory_keys, key) - 1, 0)
            while k < len(directory) and directory[k][0] <= key:
                lines = self._block(blocks, *directory[k][1:])
                yield from lines[bisect_left(self.block_keys, key) : bisect_right(self.block_keys, key)]
                k += 1

    def record(self, line: list) -> bytes:
        _, file, at, n = line
        return gzip.decompress(self._read(file, at, n))


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_captures(parts: DataFrame, keys: DataFrame, read_tasks: int | None = None) -> DataFrame:
    """Parsed records of the captures that ``keys`` (column ``capture_key``) names; repeated keys
    count once, unknown ones give nothing.

    ``parts`` is what ``write_index`` gives: a row per index partition.  ``read_tasks`` says into how
    many tasks the reading is cut: keys are short, so their bytes say nothing about it.
    """
    places = [tuple(r) for r in parts.collect()]  # bounded by the number of partitions
    tasks = read_tasks or keys.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last = IndexReader(places), None
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for key in batch.column("capture_key").to_pylist():
                if key != last:
                    last = key
                    for line in reader.find(key):
                        for name, value in parse(reader.record(line)).items():
                            out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], pa.string() if n in ("payload_digest", "record_type") else pa.int64()) for n in names],
                names=names,
            )

    dealt = keys.select("capture_key").repartitionByRange(tasks, "capture_key")
    return dealt.sortWithinPartitions("capture_key").mapInArrow(run, RECORD)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write a WARC record per page, then read every page back through the index:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Of equal payloads of ``REVISIT_BYTES`` or more the record of the largest ``page_id`` is the
    response that the others revisit.  A null html is an empty payload.  A null url is kept
    under an empty key.  Repeated rows of a ``page_id`` have a record each; those of the largest
    are all responses.  Among payloads whose pages have no id at all every record is a
    response.  Other columns are not read.
    """
    folder = new_folder(spark, "warc")
    entries = write_warc(pages, folder)
    size = entries.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES))
    return read_captures(write_index(entries, folder), entries, tasks)
