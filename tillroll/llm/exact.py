"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every partition reads its texts in chunks, fingerprints the normalised
   text (48 leading bits of its SHA-256) and sends each owner, which holds a
   range of fingerprints, the sorted distinct ones Golomb-coded, with one bit
   each for "more than once here".
2. An owner decodes what it got and returns to each chunk a bitmap of the
   fingerprints that occur again, there or elsewhere.
3. Rows with a marked fingerprint are suspects. Only their texts are shuffled
   (a bit table of fixed size keeps the others back) and compared byte by
   byte: they are grouped on the text itself, copies being merged before the
   shuffle, so a text that makes up a third of all rows is one row per task.

Truncated fingerprints can only add suspects, never lose one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import golomb
from tillroll.llm.common import WHITE, code_points, cut, id_text, raw_texts, record_batch, shuffle_partitions

FINGERPRINT_BITS = 48
CHUNK_ROWS = 1 << 16
#: Bits of the table that tells a sender which texts to ship: 1 MB, whatever
#: the input. Past some million suspects it lets others through, which costs
#: shuffle but changes no result.
TABLE_BITS = 1 << 23
_SEGMENT = 1 << 16  # bytes of the table in one row

_CHUNK = pa.schema(
    [("chunk", pa.string()), ("owner", pa.int32()), ("coded", pa.binary()), ("again", pa.binary()), ("at", pa.binary()), ("ids", pa.list_(pa.int64())), ("digests", pa.binary()), ("points", pa.binary())]
)
_DDL_CHUNK = "chunk string, owner int, coded binary, again binary, at binary, ids array<long>, digests binary, points binary"


def normalised(raw: bytes) -> bytes:
    """The text without any character of [\\x20\\x09-\\x0D]."""
    return raw.translate(None, WHITE)


def _leading(digests: np.ndarray, bits: int = FINGERPRINT_BITS) -> np.ndarray:
    """The leading ``bits`` of 32-byte digests (n x 32, uint8)."""
    return np.ascontiguousarray(digests[:, :8]).view(">u8").ravel().astype(np.uint64) >> np.uint64(64 - bits)


def _chunks(docs: DataFrame, owners: int, bits: int, chunk_rows: int) -> DataFrame:
    """One row for each chunk of rows and owner: the coded fingerprints, and
    what the sender keeps of its rows (ids, digests, code points)."""

    def flush(name: str, ids: list, digests: list[bytes], points: list[int]) -> pa.RecordBatch:
        table = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
        fps = _leading(table, bits)
        order = np.argsort(fps, kind="stable")
        fps = fps[order]
        owner = (fps * np.uint64(owners)) >> np.uint64(bits)
        size = np.array(points, np.int64)
        columns: list[list] = [[] for _ in _CHUNK]
        for rows in np.split(np.arange(len(fps)), np.flatnonzero(np.diff(owner)) + 1):
            distinct, at, count = np.unique(fps[rows], return_inverse=True, return_counts=True)
            src = order[rows]
            values = (
                name,
                int(owner[rows[0]]),
                golomb.encode(distinct),
                np.packbits(count > 1).tobytes(),
                at.astype("<u4").tobytes(),
                [ids[i] for i in src],
                table[src].tobytes(),
                size[src].tobytes(),
            )
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        return record_batch(_CHUNK, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids: list = []
        digests: list[bytes] = []
        points: list[int] = []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            digests += [hashlib.sha256(normalised(x)).digest() for x in raw_texts(batch.column(1))]
            points += code_points(batch.column(1)).to_pylist()
            if len(ids) >= chunk_rows:
                yield flush(f"{part}-{made}", ids, digests, points)
                made, ids, digests, points = made + 1, [], [], []
        if ids:
            yield flush(f"{part}-{made}", ids, digests, points)

    # owners have equal ranges; fps * owners stays below 2**64
    return id_text(docs).mapInArrow(run, _DDL_CHUNK)


def _bitmaps(chunks: DataFrame) -> DataFrame:
    """(chunk, owner, marks): what each owner returns to each chunk."""

    def owner(key, table):
        names = table.column("chunk").to_pylist()
        coded = [golomb.decode(x) for x in table.column("coded").to_pylist()]
        sizes = [len(x) for x in coded]
        again = [np.unpackbits(np.frombuffer(x, np.uint8))[:n] for x, n in zip(table.column("again").to_pylist(), sizes, strict=True)]
        fps = np.concatenate(coded)
        _, at, count = np.unique(fps, return_inverse=True, return_counts=True)
        many = (count > 1) | (np.bincount(at, weights=np.concatenate(again), minlength=len(count)) > 0)
        marks = [np.packbits(x).tobytes() for x in np.split(many[at], np.cumsum(sizes)[:-1])]
        return pa.table({"chunk": names, "owner": pa.array([key[0].as_py()] * len(names), pa.int32()), "marks": pa.array(marks, pa.binary())})

    return chunks.select("chunk", "owner", "coded", "again").groupBy("owner").applyInArrow(owner, "chunk string, owner int, marks binary")


def _rows(chunks: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, digest, points, suspect), one row per input row."""
    marks = bitmaps.select(F.col("chunk").alias("m_chunk"), F.col("owner").alias("m_owner"), "marks")
    met = chunks.join(marks, (F.col("chunk") == F.col("m_chunk")) & (F.col("owner") == F.col("m_owner")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, ids, digests, points, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.frombuffer(at, "<u4")
                suspect = np.unpackbits(np.frombuffer(marks, np.uint8))[at].astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([digests[i : i + 32] for i in range(0, len(digests), 32)], pa.binary()),
                        pa.array(np.frombuffer(points, np.int64)),
                        pa.array(suspect),
                    ],
                    names=["doc_id", "digest", "points", "suspect"],
                )

    return met.select("at", "ids", "digests", "points", "marks").mapInArrow(run, "doc_id long, digest binary, points long, suspect boolean")


def _bit_table(digests: DataFrame) -> np.ndarray:
    """A table of TABLE_BITS bits with those of ``digest`` set. It reaches
    the driver in segments already merged: 1 MB for any input."""
    size = TABLE_BITS // 8

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(TABLE_BITS, bool)
        for batch in batches:
            fps = _leading(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, 32))
            bits[(fps % np.uint64(TABLE_BITS)).astype(np.int64)] = True
        packed = np.packbits(bits)
        parts = {i // _SEGMENT: packed[i : i + _SEGMENT].tobytes() for i in range(0, size, _SEGMENT) if packed[i : i + _SEGMENT].any()}
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(list(parts.values()), pa.binary())], names=["segment", "bits"])

    def merge(key, table):
        out = np.zeros(_SEGMENT, np.uint8)
        for x in table.column("bits").to_pylist():
            out |= np.frombuffer(x, np.uint8)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([out.tobytes()], pa.binary())})

    table = np.zeros(size, np.uint8)
    merged = digests.mapInArrow(local, "segment int, bits binary").groupBy("segment").applyInArrow(merge, "segment int, bits binary")
    for row in merged.collect():  # at most TABLE_BITS / 8 / _SEGMENT rows
        at = row["segment"] * _SEGMENT
        table[at : at + _SEGMENT] = np.frombuffer(row["bits"], np.uint8)
    return table


def _texts(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """(digest, body, points, inverse_id, rows): the normalised texts that the
    table lets through, equal ones of an Arrow batch already merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(table)
        for batch in batches:
            if not batch.num_rows:
                continue
            bodies = [normalised(x) for x in raw_texts(batch.column(1))]
            digests = [hashlib.sha256(x).digest() for x in bodies]
            fps = _leading(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32))
            through = bits[(fps % np.uint64(TABLE_BITS)).astype(np.int64)]
            best: dict[bytes, list] = {}
            points, ids = code_points(batch.column(1)).to_pylist(), batch.column(0).to_pylist()
            for i in np.flatnonzero(through).tolist():
                here = (points[i], None if ids[i] is None else ~ids[i])
                known = best.setdefault(bodies[i], [digests[i], here, 0])
                known[1] = max(known[1], here, key=lambda x: (x[0], x[1] is not None, x[1] or 0))
                known[2] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([v[0] for v in best.values()], pa.binary()),
                    pa.array(list(best), pa.binary()),
                    pa.array([v[1][0] for v in best.values()], pa.int64()),
                    pa.array([v[1][1] for v in best.values()], pa.int64()),
                    pa.array([v[2] for v in best.values()], pa.int64()),
                ],
                names=["digest", "body", "points", "inverse_id", "rows"],
            )

    return id_text(docs).mapInArrow(run, "digest binary, body binary, points long, inverse_id long, rows long")


def exact_groups(docs: DataFrame, bits: int = FINGERPRINT_BITS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for every row of ``docs``.

    Texts are equal when their bytes are after deleting white space
    [\\x20\\x09-\\x0D]; digest is the SHA-256 of those bytes. Of equal texts
    the row with the most code points, then the smallest doc_id, stays.
    Defined results: a null text counts as empty; a row without doc_id loses
    every tie, and keep_id is null where only such rows are equal; rows that
    repeat doc_id and text count in group_size and are all marked alike; an
    empty table gives an empty table; other columns are ignored."""
    owners = min(shuffle_partitions(docs), 1 << 15)
    chunks = cut(_chunks(docs, owners, bits, chunk_rows))
    rows = cut(_rows(chunks, _bitmaps(chunks)))
    suspects = rows.where("suspect")
    table = _bit_table(suspects.select("digest"))
    wanted = suspects.select(F.col("digest").alias("wanted")).distinct()
    texts = _texts(docs, table)
    texts = texts.join(wanted, texts.digest == wanted.wanted, "left_semi")
    best = F.max(F.struct("points", "inverse_id")).alias("best")
    # grouped on the bytes themselves: a group is equal byte for byte
    groups = cut(texts.groupBy("digest", "body").agg(F.sum("rows").alias("group_size"), best).drop("body"))
    if not groups.groupBy("digest").count().where("count > 1").isEmpty():
        raise ValueError("different texts share a SHA-256 digest")
    clear = groups.select(
        F.col("digest").alias("g_digest"), "group_size", F.col("best.points").alias("most"), F.bitwise_not("best.inverse_id").alias("keep_id")
    )
    named = rows.join(clear, rows.digest == clear.g_digest, "left")
    alone = F.col("group_size").isNull()
    return named.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | ((F.col("points") == F.col("most")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps. Rows that
    repeat doc_id with equal texts are one document: of one that stays, one
    row with the most code points does; copies that all lack a doc_id cannot
    be told apart and stay."""
    found = cut(exact_groups(docs))
    named = found.where("doc_id is not null and group_size > 1")
    keys = named.groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("__rows"))
    left = _match(docs, keys.where("not __kept").select("__id", "__digest"), "left_anti")
    repeats = keys.where("__kept and __rows > 1").select("__id", "__digest")
    if repeats.isEmpty():
        return left
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    longest = F.max_by(F.struct("*"), F.struct(F.length(text), text))
    once = _match(left, repeats, "left_semi").groupBy(docs["doc_id"].cast("long"), _digest(docs)).agg(longest.alias("row")).select("row.*")
    return _match(left, repeats, "left_anti").unionByName(once)


def _digest(docs: DataFrame):
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return F.sha2(F.translate(text, WHITE.decode(), "").cast("binary"), 256)


def _match(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` joined on (doc_id, digest of the normalised text)."""
    same = (docs["doc_id"].cast("long") == keys["__id"]) & (_digest(docs) == F.lower(F.hex(keys["__digest"])))
    return docs.join(keys, same, how)
