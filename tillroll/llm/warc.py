"""WARC archives of pages, written with their index and read by byte ranges.

Writing (``write_archives``): every task writes files of its own into a shared
folder, one gzip member per record, and returns an index row for each: file,
offset, length, URL, payload digest, kind of record. The index is a Parquet
table beside the files and the only list of what they hold: a file that a
failed or repeated task attempt left is in no index row and never read.

Of pages with the same payload one is written in full (``response``), the
others as ``revisit`` records that name it and keep its HTTP head. Payloads
are compared by SHA-256 before any is moved; the table of repeated ones is
broadcast if it is measured small, and a plain join beyond that.

Reading (``read_records``): starts from index rows, all or selected ones.
They are dealt out by stripes of their files and sorted by place, neighbours
closer than GAP_BYTES share a read of at most READ_BYTES, and every record is
checked against its digest. Only index rows are shuffled, never payloads.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import bound_batches, cut, raw_texts, record_batch
from tillroll.operators.sizing import join_small

#: Payloads shorter than this are never replaced by a revisit.
MIN_REVISIT_BYTES = 1000
#: A task starts another file beyond this.
FILE_BYTES = 1 << 30
#: Records of one stripe of a file are read by one task.
STRIPE_BYTES = 32 << 20
#: Ranges with a smaller gap between them are read at once, up to READ_BYTES.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
_LEVEL = 6

# The names of the format (WARC 1.1).
_VERSION = b"WARC/1.1"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"
_LINE = b"\r\n"

_INDEX = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
    ]
)
_INDEX_DDL = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
_RECORD_DDL = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


# -- records ---------------------------------------------------------------


def _name(page_id: int | None) -> str:
    return f"{_ID}{'' if page_id is None else page_id}"


def _header_value(text: str) -> bytes:
    """As one header line: control characters and spaces percent-encoded."""
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], text.encode())


def _record(fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = b"".join(k + b": " + v + _LINE for k, v in [*fields, (b"Content-Length", b"%d" % len(block))])
    return _VERSION + _LINE + head + _LINE + block + _LINE + _LINE


def _page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: bytes) -> bytes:
    kind = b"response" if refers_to is None else b"revisit"
    fields = [(b"WARC-Type", kind), (b"WARC-Record-ID", b"<%s>" % _name(page_id).encode()), (b"WARC-Date", date)]
    if url is not None:
        fields.append((b"WARC-Target-URI", _header_value(url)))
    fields.append((b"WARC-Payload-Digest", b"sha1:" + digest.encode()))
    if refers_to is not None:
        fields += [(b"WARC-Profile", _PROFILE), (b"WARC-Refers-To", b"<%s>" % _name(refers_to).encode())]
    fields.append((b"Content-Type", b"application/http; msgtype=response"))
    # a revisit keeps the HTTP head, and so the length of the payload it lacks
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return _record(fields, head + (payload if refers_to is None else b""))


def _member(record: bytes) -> bytes:
    squeeze = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in head.split(_LINE)[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page_of(name: bytes) -> int | None:
    digits = name.decode().strip("<>").removeprefix(_ID)
    return int(digits) if digits else None


def parse_record(member: bytes) -> dict:
    """A record from its gzip member. Raises ValueError if it is cut short or
    its payload does not have the digest it states."""
    record = zlib.decompress(member, 31)
    head, _, rest = record.partition(_LINE + _LINE)
    if not head.startswith(_VERSION):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    block = rest[: int(fields[b"content-length"])]
    if len(rest) != len(block) + 4:
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(_LINE + _LINE)
    refers_to = fields.get(b"warc-refers-to")
    digest = fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
    size = int(_fields(http)[b"content-length"])
    if fields[b"warc-type"] == b"response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of record {fields[b'warc-record-id'].decode()} does not have its digest")
    return {
        "page_id": _page_of(fields[b"warc-record-id"]),
        "record_type": fields[b"warc-type"].decode(),
        "refers_to": _page_of(refers_to) if refers_to else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if fields[b"warc-type"] == b"response" else None,
    }


# -- files -----------------------------------------------------------------


def _open(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, as executors see it."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(folder)


class _Writer:
    """Members one after the other, in files of about FILE_BYTES."""

    def __init__(self, folder: str, part: int, date: bytes) -> None:
        self._fs, self._root = _open(folder)
        self._folder, self._part, self._date, self._out = folder, part, date, None

    def _start(self) -> None:
        name = f"part-{self._part:05d}-{uuid.uuid4().hex}.warc.gz"
        self._out, self.at, self.file = self._fs.open_output_stream(f"{self._root}/{name}", compression=None), 0, f"{self._folder}/{name}"
        info = [(b"WARC-Type", b"warcinfo"), (b"WARC-Record-ID", b"<urn:uuid:%s>" % str(uuid.uuid4()).encode()), (b"WARC-Date", self._date)]
        self.write(_member(_record([*info, (b"Content-Type", b"application/warc-fields")], b"format: WARC File Format 1.1\r\n")))

    def write(self, member: bytes) -> tuple[str, int, int]:
        if self._out is None or self.at >= FILE_BYTES:
            self.close()
            self._start()
        self._out.write(member)
        self.at += len(member)
        return self.file, self.at - len(member), len(member)

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None


def repeated_payloads(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(body, keep_id) for each payload of at least ``min_bytes`` that more
    than one row of (page_id, body, size) has: the largest page_id has it."""
    long = pages.where(F.col("size") >= min_bytes)
    met = long.groupBy("body").agg(F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return met.where("n > 1 and keep_id is not null").select(F.col("body").alias("k_body"), "keep_id")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, date: str | None = None) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) below
    ``folder``, which every executor must reach, and returns the index: file,
    offset, length, page_id, url, payload_digest (SHA-1) and record_type, read
    from ``folder``/index.

    Defined results: a null html is an empty payload; a null url leaves the
    record without a target; of equal payloads of ``min_bytes`` the row with
    the largest page_id is the response, rows that tie for it all are; a row
    without page_id revisits like any other and is never revisited; an empty
    table gives an empty index; other columns are ignored."""
    bound_batches(pages.sparkSession)
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("body", F.unhex(F.sha2("html", 256)))
    keepers = cut(repeated_payloads(rows.select("page_id", "body", F.octet_length("html").alias("size")), min_bytes))
    met = join_small(rows, keepers, rows.body == keepers.k_body, "left")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("keep_id")), F.col("keep_id"))
    stamp = (date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        out = _Writer(folder, context.partitionId() if context else 0, stamp)
        try:
            for batch in batches:
                ids, urls, digests, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
                places = [out.write(_member(_page_record(*row, stamp))) for row in zip(ids, urls, raw_texts(batch.column(2)), digests, refers, strict=True)]
                kinds = ["response" if x is None else "revisit" for x in refers]
                columns = list(zip(*places, strict=True)) if places else [[], [], []]
                yield record_batch(_INDEX, [*columns, ids, urls, digests, kinds])
        finally:
            out.close()

    met.select("page_id", "url", "html", "digest", other.alias("refers_to")).mapInArrow(run, _INDEX_DDL).write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload) of the records that ``index`` lists, read from their files.

    payload_bytes and payload_digest are those of the full payload, for
    revisits too; ``payload`` is null for revisits (see ``read_pages``), and
    everywhere without ``payload``. A record that is cut short or lacks its
    digest fails the job."""
    spark = index.sparkSession
    bound_batches(spark)
    # a task per stripe's worth of bytes, so that their number follows the input
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // STRIPE_BYTES))
    stripe = F.floor(F.col("offset") / STRIPE_BYTES)
    dealt = index.select("file", "offset", "length", "url").repartition(tasks, "file", stripe).sortWithinPartitions("file", "offset")

    def flush(rows: list[dict]) -> pa.RecordBatch:
        return record_batch(_RECORD, [[r[f.name] for r in rows] for f in _RECORD])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            wanted = list(zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True))
            for file, start, end, part in _ranges(wanted):
                if file != name:
                    fs, path = _open(file)
                    name, source = file, fs.open_input_file(path)
                read = source.read_at(end - start, start)
                if len(read) != end - start:
                    raise ValueError(f"{file} ends before an indexed record does")
                rows = []
                for _, at, length, url in part:
                    found = parse_record(read[at - start : at - start + length])
                    rows.append(found | {"url": url} | ({} if payload else {"payload": None}))
                yield flush(rows)

    return dealt.mapInArrow(run, _RECORD_DDL)


def _ranges(wanted: list[tuple]) -> Iterator[tuple[str, int, int, list[tuple]]]:
    """(file, start, end, rows): neighbouring ranges of rows (file, offset,
    length, ...) in order of place, coalesced."""
    rows: list[tuple] = []
    for row in wanted:
        if rows and (row[0] != rows[0][0] or row[1] - (rows[-1][1] + rows[-1][2]) > GAP_BYTES or row[1] + row[2] - rows[0][1] > READ_BYTES):
            yield rows[0][0], rows[0][1], rows[-1][1] + rows[-1][2], rows
            rows = []
        rows.append(row)
    if rows:
        yield rows[0][0], rows[0][1], rows[-1][1] + rows[-1][2], rows


def read_pages(index: DataFrame, condition: Column | None = None) -> DataFrame:
    """(page_id, url, payload) of the pages whose index rows meet
    ``condition`` (all without one); a revisit gets the payload of the record
    it refers to, which is read even where it is not wanted itself."""
    wanted = cut(read_records(index if condition is None else index.where(condition)))
    full = wanted.where("record_type = 'response'").select("page_id", "url", "payload")
    thin = wanted.where("record_type = 'revisit'").select("page_id", "url", "refers_to", "payload_digest")
    needed = thin.select(F.col("refers_to").alias("n_id"), F.col("payload_digest").alias("n_digest")).distinct()
    responses = index.where("record_type = 'response'")
    match = (responses.page_id == needed.n_id) & (responses.payload_digest == needed.n_digest)
    found = read_records(responses.join(needed, match, "left_semi"))
    # one record each, where rows repeat a page
    found = found.groupBy(F.col("page_id").alias("f_id"), F.col("payload_digest").alias("f_digest")).agg(F.first("payload").alias("payload"))
    resolved = thin.join(found, (F.col("refers_to") == F.col("f_id")) & (F.col("payload_digest") == F.col("f_digest")))
    return full.unionByName(resolved.select("page_id", "url", "payload"))
