"""Periodic runs of words, by tiles that fit the scale of the period.

A run is a stretch of words with smallest period q and a length of at least
``min_length`` and ``min_exponent`` * q that no neighbouring word extends. For
each octave m = 2**k of periods m <= q < 2m, a document is exploded into tiles:
one around every m-th place c, from c - m to c + 4m, so that tiles overlap and
any run of the octave holds several boundaries c. A tile is solved on its own:

* its boundary Z-values say how far the words from c agree with those from
  c + q; only q with Z >= m can belong to a run of exponent 3 and more. They
  are found for all tiles at once by names of blocks: equal blocks of 2**j
  words have equal names (exact ones, built by doubling, no hashes), so the
  test is one comparison for each q, and the rest of Z, forwards up to 2m and
  backwards up to m, a descent over smaller blocks;
* a q whose block is itself a power of a shorter one is no smallest period;
* what remains is a fragment: an interval of places whose words recur q later.

Fragments of a span of tiles are merged, and those that end inside their tiles
are runs or nothing at once. The others are cut at a tile's edge; they are
shuffled by (document, period) and stitched to whole intervals there. Texts of
documents that hold a fragment travel once more, all others are finished in
the first pass. Memory and time of a task follow its longest document, n words
of which take n log n steps.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut, id_text, raw_texts

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words whose tiles are merged before the shuffle; eight octaves at least.
SPAN_WORDS = 4096
#: Text solved at a time, or one document.
_SLICE_BYTES = 4 << 20
#: Words that are Python objects at a time.
_PENDING_WORDS = 1 << 18
_PIECE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

_FRAGMENT = pa.list_(pa.struct([("period", pa.int64()), ("first", pa.int64()), ("past", pa.int64())]))
_FIRST_DDL = "key binary, doc_id long, text string, fragments array<struct<period:long,first:long,past:long>>"
RUNS_DDL = "array<struct<start:long,period:long,length:long>>"


# -- words -------------------------------------------------------------------


class _Numbers:
    """Words of documents as numbers, equal ones equal."""

    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}
        self._pending: list[bytes] = []
        self._done: list[np.ndarray] = []

    def _flush(self) -> None:
        if self._pending:
            codes, words = pd.factorize(np.array(self._pending, object))
            numbers = np.fromiter((self._known.setdefault(w, len(self._known)) for w in words), np.int64, len(words))
            self._done.append(numbers[codes])
            self._pending = []

    def add(self, words: list[bytes]) -> None:
        self._pending += words
        if len(self._pending) >= _PENDING_WORDS:
            self._flush()

    def all(self) -> np.ndarray:
        self._flush()
        return np.concatenate(self._done) if self._done else np.zeros(0, np.int64)


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about a megabyte at a time."""
    at = 0
    while at < len(raw):
        end = _SPACE.search(raw, at + _PIECE_BYTES) if len(raw) - at > _PIECE_BYTES else None
        stop = end.start() if end else len(raw)
        yield raw[at:stop].split()
        at = stop


# -- tiles -------------------------------------------------------------------


def _doubled(names: np.ndarray, step: int, size: int) -> np.ndarray:
    """Names of blocks of 2 * step words from those of step words, for the
    first ``size`` places. A block that occurs once gets a negative name of
    its own, and so does one that holds another such."""
    out = -1 - np.arange(size)
    left, right = names[: size - step], names[step:size]
    both = np.flatnonzero((left >= 0) & (right >= 0))
    if len(both):
        codes, _ = pd.factorize(left[both] * (int(right.max()) + 1) + right[both])
        often = np.bincount(codes)[codes] > 1
        out[both[often]] = codes[often]
    return out


class _Blocks:
    """``names[j][i]``: the name of the block of 2**j words at place i."""

    def __init__(self, names: list[np.ndarray]) -> None:
        self.names = names

    def same(self, j: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        names = self.names[j]
        inside = (a >= 0) & (b < len(names))  # a < b throughout
        return inside & (names[np.where(inside, a, 0)] == names[np.where(inside, b, 0)])

    def forwards(self, c: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
        """Places from c on that equal those from d, known for 2**k, sought to
        twice that."""
        z = np.full(len(c), 1 << k)
        for j in range(k, -1, -1):
            z += np.where((z < 2 << k) & self.same(j, c + z, d + z), 1 << j, 0)
        return z

    def backwards(self, c: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
        """Places before c that equal those before d, up to 2**k."""
        z = np.zeros(len(c), np.int64)
        for j in range(k, -1, -1):
            z += np.where((z < 1 << k) & self.same(j, c - z - (1 << j), d - z - (1 << j)), 1 << j, 0)
        return z

    def agree(self, c: np.ndarray, d: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` places from c equal those from d."""
        good, at = np.ones(len(c), bool), np.zeros(len(c), np.int64)
        for j in range(int(size.max(initial=0)).bit_length() - 1, -1, -1):
            has = (size >> j) & 1 == 1
            good &= ~has | self.same(j, c + at, d + at)
            at += has << j
        return good

    def primitive(self, c: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether the block of p words at c is no power of a shorter one."""
        out, rest = np.ones(len(c), bool), p.copy()
        least = _least_factor(int(p.max(initial=1)))
        while (open_ := np.flatnonzero((rest > 1) & out)).size:
            r = least[rest[open_]]
            d = p[open_] // r
            out[open_] = ~self.agree(c[open_], c[open_] + d, p[open_] - d)
            left = rest[open_]
            while (more := left % r == 0).any():
                left = np.where(more, left // r, left)
            rest[open_] = left
        return out


def _least_factor(n: int) -> np.ndarray:
    """The least prime factor of each number up to n."""
    out = np.arange(n + 1)
    for r in range(2, int(n**0.5) + 1):
        if out[r] == r:
            part = out[r * r :: r]
            part[part == np.arange(r * r, n + 1, r)] = r
    return out


def fragments(words: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, span: int = SPAN_WORDS) -> tuple[np.ndarray, ...]:
    """(document, period, first, past) of the intervals of equal places that
    are or may be part of a run. ``words``: those of all documents, longest
    document first; ``sizes``: how many each has. min_exponent is 3 at least."""
    count = len(sizes)
    # a place of its own behind each document
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    names = -1 - np.arange(int(ends[-1]) if count else 0)
    names[np.arange(len(words)) + np.repeat(np.arange(count), sizes)] = words
    blocks, found, k = _Blocks([names]), [], 0
    while True:
        m = 1 << k
        docs = int(np.searchsorted(-sizes, -max(min_length, min_exponent * m), side="right"))
        if not docs:
            break
        size = int(ends[docs - 1])
        if k:
            blocks.names.append(_doubled(blocks.names[-1], m >> 1, size))
        here = blocks.names[k][:size]
        tiles = size // m - 1
        row, off = np.nonzero(here[m : m + tiles * m].reshape(tiles, m) == here[: tiles * m : m, None])
        c, p = row * m, m + off
        keep = blocks.primitive(c, p)
        c, p = c[keep], p[keep]
        z, back = blocks.forwards(c, c + p, k), blocks.backwards(c, c + p, k)
        doc = np.searchsorted(ends, c, side="right")
        begin = begins[doc]
        part = (c - begin) // max(span, 8 * m)
        order = np.lexsort((c, p, part, doc))
        c, p, z, back, doc, begin, part = (x[order] for x in (c, p, z, back, doc, begin, part))
        first, past = c - back, c + z
        new = np.ones(len(c), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]) | (p[1:] != p[:-1]) | (first[1:] > past[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(c))[: len(at)] - 1
        cut_off = (back[at] == m) | (z[last] == 2 * m)
        p, doc, begin, first, past = p[at], doc[at], begin[at], first[at], past[last]
        keep = cut_off | (past - first + p >= np.maximum(min_length, min_exponent * p))
        found.append(np.stack([doc, p, first - begin, past - begin])[:, keep])
        k += 1
    return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 4


# -- Spark -------------------------------------------------------------------


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[bytes]]]:
    ids, texts, size = [], [], 0
    for i, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
        if ids and size + len(raw) > _SLICE_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(raw)
        size += len(raw)
    if ids:
        yield ids, texts


def _first_pass(docs: DataFrame, min_length: int, min_exponent: int, span: int, digest: bool) -> DataFrame:
    """(key, doc_id, text, fragments): text has single spaces; where there are
    no fragments it is final, and its digest if that is asked for."""

    def solve(ids: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
        numbers, sizes, plain = _Numbers(), np.zeros(len(texts), np.int64), []
        for i, raw in enumerate(texts):
            parts = []
            for words in _pieces(raw):
                numbers.add(words)
                sizes[i] += len(words)
                parts.append(b" ".join(words))
            plain.append(b" ".join(x for x in parts if x))
        words, ends = numbers.all(), np.cumsum(sizes)
        order = np.argsort(-sizes, kind="stable")
        ranked = np.concatenate([words[ends[i] - sizes[i] : ends[i]] for i in order])
        doc, period, first, past = fragments(ranked, sizes[order], min_length, min_exponent, span)
        doc = order[doc]
        by_doc = np.argsort(doc, kind="stable")
        offsets = np.searchsorted(doc[by_doc], np.arange(len(texts) + 1))
        values = pa.StructArray.from_arrays([pa.array(x[by_doc]) for x in (period, first, past)], fields=list(_FRAGMENT.value_type))
        has = np.diff(offsets) > 0
        keys = [hashlib.blake2b(b"%r\0" % ids[i] + texts[i], digest_size=16).digest() if has[i] else None for i in range(len(ids))]
        final = [hashlib.sha256(x).hexdigest().encode() if digest and not has[i] else x for i, x in enumerate(plain)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(final, pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
            names=["key", "doc_id", "text", "fragments"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _slices(batch):
                yield solve(ids, texts)

    return docs.mapInArrow(run, _FIRST_DDL)


def _stitched(pieces: DataFrame, min_length: int, min_exponent: int) -> DataFrame:
    """(key, runs) from rows (key, period, first, past): intervals of a
    (document, period) that meet are one."""
    by_place = Window.partitionBy("key", "period").orderBy("first", "past")
    before = F.max("past").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    parted = pieces.distinct().withColumn("new", (F.coalesce(before, F.lit(-1)) < F.col("first")).cast("int"))
    parted = parted.withColumn("part", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = parted.groupBy("key", "period", "part").agg(F.min("first").alias("start"), (F.max("past") - F.min("first") + F.col("period")).alias("length"))
    runs = whole.where(F.col("length") >= F.greatest(F.lit(min_length), min_exponent * F.col("period")))
    return runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def _collapsed(met: DataFrame, digest: bool) -> DataFrame:
    """(doc_id, runs, text) from rows (doc_id, text, runs): without the words
    that a run has after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, runs in zip(raw_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = np.array(raw.split(b" "), object)
                keep = np.ones(len(words), bool)
                for r in runs or ():
                    keep[r["start"] + r["period"] : r["start"] + r["length"]] = False
                left = b" ".join(words[keep].tolist())
                out.append(hashlib.sha256(left).hexdigest().encode() if digest else left)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.string())], names=["doc_id", "runs", "text"])

    return met.select("doc_id", "text", "runs").mapInArrow(run, f"doc_id long, runs {RUNS_DDL}, text string")


def collapse_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, digest: bool = False, span: int = SPAN_WORDS) -> DataFrame:
    """(doc_id, runs, text) for every row of ``docs``.

    ``runs``: array of (start, period, length), in words from 0, by start and
    period; a run has at least ``min_length`` words and ``min_exponent`` (3 or
    more) periods. ``text``: the words that no run holds after its first
    period, joined by one space; its SHA-256 in hex with ``digest``. Words are
    the maximal pieces without white space [\\x20\\x09-\\x0D], compared as
    they are. Defined results: a null, empty or white text has no runs and an
    empty text; rows that repeat a doc_id are solved one by one; a null doc_id
    stays null; an empty table gives an empty table; other columns are
    ignored."""
    if min_exponent < 3 or min_length < 1:
        raise ValueError("runs have three periods at least")
    first = cut(_first_pass(id_text(docs), min_length, min_exponent, span, digest))
    open_ = first.where("key is not null")
    runs = _stitched(open_.select("key", F.inline("fragments")), min_length, min_exponent)
    # dealt anew, so that Spark can split the partition of a row that is
    # repeated very often
    runs = runs.select(F.col("key").alias("r_key"), "runs").hint("rebalance")
    met = open_.join(runs, open_.key == runs.r_key, "left")
    none = F.array().cast(RUNS_DDL)
    done = first.where("key is null").select("doc_id", none.alias("runs"), "text")
    return done.unionByName(_collapsed(met.select("doc_id", "text", F.coalesce("runs", none).alias("runs")), digest))
