"""Byte-level BPE in two tiers.

Tier one resolves a whole pre-token through a minimal perfect hash of the
vocabulary: the key's hash picks a bucket, the bucket's displacement picks
the one slot the key can be in, and the slot's bytes confirm it. Tier two
merges what is not in the vocabulary: the bytes form a linked list, adjacent
pairs wait in a heap by (rank, position), and stale entries are skipped,
so a pre-token of n bytes costs n log n however long it is.

The vocabulary (its size is fixed, some 50,000 entries) is read on the
driver and travels with the function; executors need no file.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tillroll.llm.common import id_text, record_batch

#: Pre-tokens a worker remembers, in two generations of this size.
MEMORY = 200_000

_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (one "base64 rank" a line), by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for coded, rank in pairs:
        tokens[int(rank)] = base64.b64decode(coded)
    return tokens


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: n keys, n slots.

    Keys fall into buckets; the largest buckets first, each finds a seed that
    sends all its keys to free slots. A bucket of one key simply names its
    slot (stored as -slot - 1)."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.buckets = n // 3 + 1
        self.shift = [0] * self.buckets
        self.slots: list[bytes] = [b""] * n
        self.values = [0] * n
        members: dict[int, list[int]] = {}
        for i, key in enumerate(keys):
            members.setdefault(xxhash.xxh3_64_intdigest(key) % self.buckets, []).append(i)
        free = bytearray(b"\x01") * n
        left = []
        for bucket, own in sorted(members.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:
                left.append((bucket, own[0]))
                continue
            seed = 1
            while True:
                to = [xxhash.xxh3_64_intdigest(keys[i], seed) % n for i in own]
                if len(set(to)) == len(to) and all(free[x] for x in to):
                    break
                seed += 1
            self.shift[bucket] = seed
            for i, x in zip(own, to, strict=True):
                free[x], self.slots[x], self.values[x] = 0, keys[i], i
        empty = (x for x in range(n) if free[x])
        for bucket, i in left:
            x = next(empty)
            self.shift[bucket] = -x - 1
            self.slots[x], self.values[x] = keys[i], i

    def find(self, key: bytes) -> int:
        """The key's index, or -1."""
        shift = self.shift[xxhash.xxh3_64_intdigest(key) % self.buckets]
        if shift == 0:
            return -1
        x = -shift - 1 if shift < 0 else xxhash.xxh3_64_intdigest(key, shift) % len(self.slots)
        return self.values[x] if self.slots[x] == key else -1


class Encoder:
    """Encodes and decodes by ``tokens`` (by rank) and a pre-token pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.table = PerfectHash(tokens)
        self.pattern = pattern
        self._start()

    def _start(self) -> None:
        self.split = regex.compile(self.pattern).findall
        self.ranks = {token: rank for rank, token in enumerate(self.tokens)}
        self.fresh: dict[str, bytes] = {}
        self.aged: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {"tokens": self.tokens, "table": self.table, "pattern": self.pattern}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no token: always the pair of lowest rank,
        the leftmost of equals, is merged next."""
        rank_of, n = self.ranks.get, len(piece)
        after = list(range(1, n + 1))  # where the symbol that starts here ends
        before = list(range(-1, n))  # where the symbol that ends here starts
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := rank_of(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            _, i, end = pop(heap)
            j = after[i]
            # stale when a symbol has gone (0) or either one has grown since
            if j == 0 or j >= n or after[j] != end:
                continue
            after[i], after[j], before[end] = end, 0, i
            if end < n and (rank := rank_of(piece[i : after[end]])) is not None:
                push(heap, (rank, i, after[end]))
            if i and (rank := rank_of(piece[(h := before[i]) : end])) is not None:
                push(heap, (rank, h, end))
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(piece[i : after[i]]))
            i = after[i]
        return ids

    def _piece(self, piece: str) -> bytes:
        packed = self.aged.get(piece)
        if packed is None:
            raw = piece.encode()
            whole = self.table.find(raw)
            packed = np.array([whole] if whole >= 0 else self.merge(raw), "<u4").tobytes()
        if len(self.fresh) >= MEMORY:
            self.fresh, self.aged = {}, self.fresh
        if len(piece) < 64:
            self.fresh[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = self.split(text)
        out = list(map(self.fresh.get, pieces))
        if None in out:
            known = self._piece
            out = [known(p) if x is None else x for p, x in zip(pieces, out, strict=True)]
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def bpe(docs: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row of ``docs``: ids are
    packed little-endian unsigned 32-bit integers, decoded the bytes that the
    ids stand for. Defined results: a null or empty text has no tokens; rows
    that repeat are encoded one by one; other columns are ignored. Any text
    can be encoded if the vocabulary holds all 256 single bytes (checked)."""
    missing = {bytes([b]) for b in range(256)} - set(tokens)
    if missing:
        raise ValueError("the vocabulary must hold every single byte")
    encoder = Encoder(tokens, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [encoder.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            yield record_batch(_OUT, [batch.column(0), [len(x) // 4 for x in ids], ids, [encoder.decode(x) for x in ids]])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def bpe_digests(docs: DataFrame, tokens: list[bytes], pattern: str) -> DataFrame:
    """``bpe`` with ids and decoded replaced by their SHA-256 in hex, taken
    where they are made: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    made = bpe(docs, tokens, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [[hashlib.sha256(x.as_py()).hexdigest() for x in batch.column(i)] for i in (2, 3)]
            yield record_batch(schema, [batch.column(0), batch.column(1), *digests])

    return made.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
