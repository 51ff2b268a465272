"""Best-fit packing of tokenised documents after a dominance reduction.

Lengths are integers up to the sequence length, so the whole instance is a
histogram with at most ``capacity`` entries, whatever the number of
documents. The plan is made on that histogram:

1. Martello-Toth reduction. The largest length j is fixed together with the
   set that provably dominates every alternative: a partner that fills the
   sequence exactly; nothing, if nothing fits; the largest partner that fits,
   if no two others fit beside j, or if every two that fit can change places
   with it and no three fit. Fixed sets leave the instance.
2. Best-fit decreasing over what remains, a whole length at a time: equal
   lengths fill the fullest sequence they fit before the next one, so runs
   of equal sequences stay one entry of the plan.

The plan says which ranks among the documents of a length go to which
sequences. Ranks are dealt by a window over (length, salt): a frequent length
is split over as many salts as it needs, and the salts' counts, summed per
length, give each salt its first rank.
"""

from __future__ import annotations

import math
import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import WHITE, cut, id_text, raw_texts, record_batch

CAPACITY = 2048
END_ID = 0
#: Words a task remembers, in two generations of this size.
MEMORY = 400_000
#: Pieces of one (length, salt) that a task ranks, until a length has more
#: than the square of it; from there on the square root of its count.
RANKED_TOGETHER = 64

_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])


# Marks of the short way, and words it is tried on.
_MARKS = ".,;:!?#$%&*|"
_PROBES = ("Hello", "the", "Ab.", "straße,", "Éaux!!", "ñandú", "x###", "Zürich$$$", "ÀÿÆ", "µm", "a%%%", "Ça?!")


def _byte_signs() -> dict[int, str]:
    """The signs a byte-level model shows bytes as: printable Latin-1 bytes as
    themselves, the others, in order, from U+0100 on; here for letters of
    two UTF-8 bytes."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    signs = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(signs[b] for b in chr(c).encode()) for c in range(128, 256)}


_SHOWN = _byte_signs()
_BYTES = np.arange(256)
_INK = ~np.isin(_BYTES, list(WHITE))
_MARK = np.isin(_BYTES, list(_MARKS.encode()))
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | (_BYTES >= 97) & (_BYTES <= 122)
_FOLD = (_BYTES + 32 * _UPPER).astype(np.uint8)


class WordEncoder:
    """Ids of a text by a ``tokenizers`` definition that never joins what
    white space parts, so each word is encoded once and remembered. By the
    short way, words are also parted between a Latin letter and a mark, with
    A-Z lower-cased first: fewer different ones are left. What reads like an
    added token (``<|endoftext|>``), in whatever case, stays as it is."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.forget()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added]
        # the short way is taken only if this tokenizer treats the probes so
        self.short = not any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added)
        self.short = self.short and all(self.encode(w.encode()) == self._long([w])[0] for w in _PROBES)
        self.forget()

    def forget(self) -> None:
        """Give the memory back: the worker lives on after the task."""
        self.fresh: dict[str, bytes] = {}
        self.aged: dict[str, bytes] = {}

    def encode(self, raw: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([raw])[0].to_pybytes()

    def encode_all(self, raws: list[bytes], end: bytes = b"") -> tuple[pa.Buffer, np.ndarray]:
        """The texts' ids one after another, ``end`` after each text's, and
        where each text's end there. What repeats in any of the texts is
        looked up once."""
        joined = np.frombuffer(bytearray(b"").join([part for raw in raws for part in (raw, b" ")]), np.uint8)
        ink = _INK[joined]
        step = np.diff(ink.view(np.int8), prepend=np.int8(0))
        first, after = step == 1, step == -1
        if self.short:
            kept = np.zeros(len(joined), bool)
            for content in self.added:
                at = _read_like(joined, content)
                for i in range(len(content)):
                    kept[at + i] = True
            cuts = _cuts(joined)
            cuts = cuts[~kept[cuts]]
            first[cuts] = after[cuts] = True
            _lower(joined, kept)
        starts = np.flatnonzero(first)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(np.flatnonzero(after) - starts, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined[ink])]
        words = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        codes = self._codes(_listed(words.dictionary))
        until = np.searchsorted(starts, np.cumsum([len(raw) + 1 for raw in raws]))
        order = np.insert(words.indices.to_numpy(), until, len(codes))
        taken = pa.array([*codes, end], pa.large_binary()).take(pa.array(order))
        stops = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[until + np.arange(1, len(raws) + 1)]
        return taken.buffers()[2] or pa.py_buffer(b""), stops

    def _codes(self, words: list[str]) -> list[bytes]:
        """Each word's ids; no word comes twice."""
        out = list(map(self.fresh.get, words))
        new = [w for w, x in zip(words, out, strict=True) if x is None]
        if not new:
            return out
        learnt = iter(self._learn(new))
        return [next(learnt) if x is None else x for x in out]

    def _learn(self, words: list[str]) -> list[bytes]:
        if len(self.fresh) + len(words) > MEMORY:
            self.fresh, self.aged = {}, self.fresh
        out = list(map(self.aged.get, words))
        rest = []
        for i, known in enumerate(out):
            if known is None:
                w = words[i]
                if self.short and w.isalpha() and (w.isascii() or max(w) <= "\xff"):
                    out[i] = self._merge(w.lower())
                else:
                    rest.append(i)
        for i, packed in zip(rest, self._long([words[i] for i in rest]), strict=True):
            out[i] = packed
        if len(words) <= MEMORY:
            self.fresh.update(zip(words, out, strict=True))
        return out

    def _long(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in coded]

    def _merge(self, letters: str) -> bytes:
        """Lower-cased Latin letters go to the merges directly."""
        shown = letters if letters.isascii() else letters.translate(_SHOWN)
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)


def _cuts(joined: np.ndarray) -> np.ndarray:
    """Where a mark follows a Latin letter (A-Z, a-z, U+00C0 to U+00FF
    without the two signs): a run of letters ends there in any word."""
    at = np.flatnonzero(_MARK[joined])
    at = at[at > 0]
    last = joined[at - 1]
    wide = (joined[np.maximum(at - 2, 0)] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    return at[_LETTER[last] | wide]


def _read_like(joined: np.ndarray, content: bytes) -> np.ndarray:
    """Where ``content`` starts, A-Z and a-z alike."""
    wanted = np.frombuffer(content, np.uint8)
    at = np.flatnonzero((joined == _FOLD[wanted[0]]) | (joined == content[:1].upper()[0]))
    at = at[at + len(wanted) <= len(joined)]
    for i, byte in enumerate(wanted):
        at = at[_FOLD[joined[at + i]] == _FOLD[byte]]
    return at


def _lower(joined: np.ndarray, kept: np.ndarray) -> None:
    """A-Z lower-cased in place, but where ``kept`` or the next sign could
    combine with the letter: some pairs compose in one case only."""
    at = np.flatnonzero(_UPPER[joined] & ~kept)
    follows = joined[at + 1]  # a text is followed by a space
    joined[at[(follows < 0x80) | (follows == 0xC3)]] += 32


def _listed(words: pa.Array) -> list[str]:
    """The words of an array, none of which holds a space."""
    n = len(words)
    if not n:
        return []
    return pc.binary_join(pa.ListArray.from_arrays([0, n], words), pa.scalar(" ", words.type))[0].as_py().split(" ")


@lru_cache(maxsize=2)
def _encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition)


def pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids): the documents' ids, each followed
    by END_ID, cut into pieces of ``capacity`` where longer. ``definition``:
    the JSON of a tokenizer."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, stops = encoder.encode_all(raw_texts(batch.column(1)), end)
            total = np.diff(stops, prepend=0) // 4
            n = -(-total // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(total[doc] - start, capacity)
            # the pieces lie end to end in the ids
            bounds = np.concatenate([[0], 4 * np.cumsum(length)]).astype(np.int32)
            parts = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(bounds), ids])
            yield record_batch(_PIECE, [batch.column(0).take(pa.array(doc)), piece, start, length, parts])
        encoder.forget()

    return id_text(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def with_crc(df: DataFrame) -> DataFrame:
    """``ids`` (binary) replaced by its CRC-32 as ``ids_crc32``."""
    return df.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _reduce(count: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Fixed sets (lengths, times), taken out of ``count`` in place."""
    fixed = []
    for j in range(capacity, 0, -1):
        while count[j]:
            room = capacity - j
            count[j] -= 1
            there = np.flatnonzero(count[: room + 1])
            count[j] += 1
            if not len(there):
                fixed.append(([j], int(count[j])))
                count[j] = 0
                break
            k = int(there[-1])
            if k != room and not _dominates(count, j, k, there, room):
                break
            times = int(count[j] // 2 if j == k else min(count[j], count[k]))
            fixed.append(([j, k], times))
            count[j] -= times
            count[k] -= times
    return fixed


def _dominates(count: np.ndarray, j: int, k: int, there: np.ndarray, room: int) -> bool:
    """Whether j with k dominates every set of j with two or more others."""
    smallest = []
    for x in there[:3].tolist():
        smallest += [x] * int(min(3, count[x] - (x == j)))
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return True  # no two fit
    if len(smallest) > 2 and sum(smallest[:3]) <= room:
        return False  # three fit: not decided by this rule
    lo, hi, most = 0, len(there) - 1, 0
    while lo <= hi:  # the fullest pair
        pair = int(there[lo] + there[hi])
        if pair > room:
            hi -= 1
        else:
            if lo < hi or count[there[lo]] - (there[lo] == j) > 1:
                most = max(most, pair)
            lo += 1
    return most <= k


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots (length, first rank, copies in a sequence, first sequence, first
    offset) for a histogram of lengths, and the number of sequences. Document
    r of its length, in the last slot whose first rank is not over r, goes to
    sequence first + (r - rank) // copies, at offset + (r - rank) % copies *
    length."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] += n
    done: list[tuple[list[tuple[int, int]], int]] = []  # ((length, copies), ...), times
    for lengths, times in _reduce(count, capacity):
        done.append(([(x, lengths.count(x)) for x in dict.fromkeys(lengths)], times))
    free: dict[int, list[tuple[tuple, int]]] = {}  # room left: (contents, times)
    for length in range(capacity, 0, -1):
        left = int(count[length])
        while left:
            room = next((r for r in range(length, capacity) if r in free), capacity)
            contents, times = ((), math.inf) if room == capacity else free[room].pop()
            if room < capacity and not free[room]:
                del free[room]
            fit = room // length
            full = int(min(times, left // fit))
            rest = left - full * fit if full < times else 0
            rest = min(rest, fit - 1) if rest else 0
            for n, copies in ((full, fit), (1 if rest else 0, rest)):
                if n:
                    free.setdefault(room - copies * length, []).append(((*contents, (length, copies)), n))
            over = times - full - (1 if rest else 0)
            if room < capacity and over:
                free.setdefault(room, []).append((contents, over))
            left -= full * fit + rest
    done += [(list(contents), n) for groups in free.values() for contents, n in groups]
    slots, first, rank = [], 0, [0] * (capacity + 1)
    for contents, times in done:
        offset = 0
        for length, copies in contents:
            slots.append((length, rank[length], copies, first, offset))
            rank[length] += copies * times
            offset += copies * length
        first += times
    return sorted(slots), first


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with ``length`` from 1 to ``capacity``) with sequence_id and
    offset. ``parts`` should be cheap to read again (cut it first). An empty
    table stays empty; rows that repeat are packed one by one."""
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    slots, _ = plan(histogram, capacity)
    salts = [0] * (capacity + 1)
    for length, n in histogram.items():
        salts[length] = math.ceil(min(n / RANKED_TOGETHER, math.sqrt(n)))
    of_length = F.element_at(F.array(*map(F.lit, salts)), (F.col("length") + 1).cast("int"))
    columns = parts.columns
    salted = parts.withColumn("__salt", F.pmod(F.xxhash64(*columns), of_length))
    here = Window.partitionBy("length", "__salt").orderBy(*columns)
    ranked = salted.withColumn("__rank", F.row_number().over(here) - 1)
    sizes = salted.groupBy(F.col("length").alias("__length"), F.col("__salt").alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__length").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__length", "__of", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    ranked = ranked.join(sizes, (F.col("length") == F.col("__length")) & (F.col("__salt") == F.col("__of")))
    ranked = ranked.select(*columns, (F.col("__rank") + F.col("__first")).alias("__rank"))

    table = np.array(slots, np.int64).reshape(-1, 5)  # a few entries for each length
    shift = np.int64(1) << np.int64(48)
    keys = table[:, 0] * shift + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(columns.index("length")).to_numpy()
            rank = batch.column(len(columns)).to_numpy()
            length_, first, copies, sequence, offset = table[np.searchsorted(keys, length * shift + rank, side="right") - 1].T
            own = rank - first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(sequence + own // copies), pa.array(offset + own % copies * length_)],
                names=[*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{n}` {t}" for n, t in parts.dtypes)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, definition: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every
    piece of every row of ``docs``. Defined results: a null or empty text is
    the single id END_ID; rows that repeat are packed one by one; a row
    without doc_id is packed like any other; other columns are ignored. The
    ids themselves stay with ``pieces`` (join on doc_id, piece)."""
    return pack(cut(with_crc(pieces(docs, definition, capacity))), capacity)
