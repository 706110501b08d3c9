"""WARC archives with a two-level capture index.

Records are gzip members, so each can be read alone. The capture index has one line for a record, keyed by the reversed
host, path and capture number; the lines are sorted across the cluster and packed into compressed blocks, and a sparse
directory keeps each block's first key. A lookup searches the directory, then the block, by bisection, and reads the
record's byte range; neighbouring ranges of a file are read together.

Files are written once, under a fresh name for each attempt of a task, and become visible through the index alone, so a
lost executor or a repeated attempt leaves at most a file that nothing names.

Defined results: null html is an empty payload and a null url has an empty key; of records with equal payloads, all
rows with the smallest id are responses and the rest revisit it; a null id revisits any other, or all are responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.common import materialize, new_path, shared_fs, slices, small_batches

#: Lines of an index block at least; blocks grow so that the directory has at most DIRECTORY_ENTRIES of KEY_CHARS each.
BLOCK_LINES, DIRECTORY_ENTRIES, KEY_CHARS = 3000, 100_000, 512
#: Bytes after which a task begins another archive; most bytes read at once; gap that is read over.
FILE_BYTES, READ_BYTES, GAP_BYTES = 1 << 28, 4 << 20, 1 << 16
CAPTURED = "1970-01-01T00:00:00Z"


def reversed_host_key(url: str | None) -> str:
    """com,example,news)/path?query of http://news.example.com:80/path?query#part."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return url.strip().lower()
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + path


def capture_key(url: str | None, number: int) -> str:
    """One line's key: the url key without blanks, then the capture's number in fixed width."""
    return f"{quote(reversed_host_key(url), safe='/,)?&=:;@!$*+.~%-_')} {number:020d}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, name: str = "") -> bytes:
    """One record: response with the HTTP message, or revisit with its head alone. name tells records of one page apart."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {name}')}>"),
        ("WARC-Date", CAPTURED),
        ("WARC-Target-URI", quote(url or "", safe="/,()?&=:;@!$*+.~%-_#[]'")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", str(refers_to))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=4, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one gzip member; raises if lengths or digest do not fit."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.0" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not one whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    http_fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    if fields["WARC-Type"] == "response" and (len(payload) != int(http_fields["Content-Length"]) or f"sha1:{payload_digest(payload)}" != fields["WARC-Payload-Digest"]):
        raise ValueError(f"payload of page {fields['X-Page-ID']} does not fit its digest")
    return fields, http_fields, payload


def write(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives; (page_id, key, file, offset, length) for each record. Payloads under least_bytes are never revisits."""
    small_batches(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.unhex(F.sha1(html)).alias("sha1"))
    # Only payloads held more than once meet the pages; counts are combined before they are shuffled, and a hot payload's
    # rows in the join below are split by adaptive execution.
    copies = pages.select(F.col(id_col).alias("page_id"), F.unhex(F.sha1(html)).alias("sha1"), F.octet_length(html).alias("n"))
    copies = copies.where(F.col("n") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    copies = copies.where((F.col("copies") > 1) & F.col("first_id").isNotNull()).select("sha1", "first_id")
    rows = rows.join(copies, "sha1", "left").select("page_id", "url", "html", "first_id")
    folder = new_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        out, path = None, ""
        for whole in batches:
            for batch in slices(whole, 2):
                made = []
                for page_id, url, body, first in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    revisit = first is not None and page_id != first
                    member = record(page_id, url, body.encode(), first, revisit, f"{folder} {part} {serial}")
                    if out is None or out.tell() > FILE_BYTES:
                        if out is not None:
                            out.close()
                        path = f"{folder}/pages-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                        fs, plain = shared_fs(path)
                        fs.create_dir(plain.rsplit("/", 1)[0], recursive=True)
                        out = fs.open_output_stream(plain, compression=None)
                    # A page's number in the key: its id, or its place among rows without one.
                    number = page_id if page_id is not None and page_id >= 0 else 10**19 + part * 10**10 + serial
                    serial += 1
                    made.append((page_id, capture_key(url, number) + f" {part:06d}{serial:012d}", path, out.tell(), len(member)))
                    out.write(member)
                columns = zip(*made, strict=True)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["page_id", "key", "file", "offset", "length"])
        if out is not None:
            out.close()

    return materialize(rows.mapInArrow(run, "page_id bigint, key string, file string, offset bigint, length bigint"), "warc-written")


def build_index(written: DataFrame, least_lines: int = BLOCK_LINES) -> DataFrame:
    """(block, first_key, lines, data): compressed blocks of sorted lines "key\\tfile\\toffset\\tlength"."""
    total = written.count()
    most = max(least_lines, -(-total // DIRECTORY_ENTRIES))
    rows = written.select("key", "file", "offset", "length").repartitionByRange("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial, held, first = TaskContext.get().partitionId(), 0, [], ""

        def block() -> pa.RecordBatch:
            nonlocal serial, held
            data = zlib.compress("\n".join(held).encode())
            out = pa.RecordBatch.from_pydict(
                {"block": [part * (1 << 32) + serial], "first_key": [first], "lines": [len(held)], "data": [data]},
                schema=pa.schema([("block", pa.int64()), ("first_key", pa.string()), ("lines", pa.int64()), ("data", pa.binary())]),
            )
            serial, held = serial + 1, []
            return out

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not held:
                    first = line[0]
                held.append("%s\t%s\t%d\t%d" % line)
                if len(held) >= most:
                    yield block()
        if held:
            yield block()

    return materialize(rows.mapInArrow(run, "block bigint, first_key string, lines bigint, data binary"), "warc-index")


def locate(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, file, offset, length) of every distinct key that the index has."""
    spark = index.sparkSession
    # The directory: at most DIRECTORY_ENTRIES + one a partition, each key cut to KEY_CHARS.
    entries = sorted((row["k"], row["block"]) for row in index.select("block", F.substring("first_key", 1, KEY_CHARS).alias("k")).collect())
    sent = spark.sparkContext.broadcast(([k for k, _ in entries], [b for _, b in entries]))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, blocks = sent.value
        for batch in batches:
            asked, found = [], []
            for key in batch.column(0).to_pylist():
                # Cut keys may be equal: every block that may hold the key is asked.
                cut = key[:KEY_CHARS]
                lo, hi = max(0, bisect_left(firsts, cut) - 1), bisect_right(firsts, cut)
                asked += [key] * (hi - lo)
                found += blocks[lo:hi]
            yield pa.RecordBatch.from_arrays([pa.array(asked, pa.string()), pa.array(found, pa.int64())], names=["key", "block"])

    asked = keys.select("key").where("key is not null").distinct().mapInArrow(choose, "key string, block bigint")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[str, str, int, int]] = []
        for data in right.column("data").to_pylist():
            lines = [x.split("\t") for x in zlib.decompress(data).decode().split("\n")]
            names = [x[0] for x in lines]
            for key in left.column("key").to_pylist():
                at = bisect_left(names, key)
                if at < len(names) and names[at] == key:
                    out.append((key, lines[at][1], int(lines[at][2]), int(lines[at][3])))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.string(), pa.int64(), pa.int64()], strict=True)], names=["key", "file", "offset", "length"])

    return asked.groupBy("block").cogroup(index.select("block", "data").groupBy("block")).applyInArrow(search, "key string, file string, offset bigint, length bigint")


def fetch(located: DataFrame, payloads: bool = True) -> DataFrame:
    """(key, page_id, payload_bytes, payload_digest, record_type, refers_to, payload) by ranges of the archives. Each payload is
    held against its digest; payloads=False leaves it out of the rows."""
    rows = located.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo, at = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)), 0
            while at < len(todo):
                _, path, start, length = todo[at]
                to, end = at + 1, start + length
                while to < len(todo) and todo[to][1] == path and todo[to][2] - end <= GAP_BYTES and todo[to][2] + todo[to][3] - start <= READ_BYTES:
                    end, to = max(end, todo[to][2] + todo[to][3]), to + 1
                fs, plain = shared_fs(path)
                with fs.open_input_file(plain) as file:
                    data = file.read_at(end - start, start)
                out = []
                for key, _, offset, n in todo[at:to]:
                    fields, http, payload = parse(data[offset - start : offset - start + n])
                    page, refers = fields["X-Page-ID"], fields.get("X-Refers-To-Page-ID")
                    out.append((key, int(page) if page else None, int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], int(refers) if refers else None, payload if payloads else None))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=made)
                at = to

    made = ["key", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return rows.select("key", "file", "offset", "length").mapInArrow(run, "key string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")
