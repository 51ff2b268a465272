"""SimHash near-duplicates by a segment-popcount embedding.

A document's fingerprint is the bitwise majority of its shingles' XXH64
values. Fingerprints are embedded as the bit counts of their two-bit
segments: 32 numbers from 0 to 2, whose Manhattan distance never exceeds the
Hamming distance, so it is a lower bound that loses no link. The embedding
is cut into ``max_bits // 2 + 1`` blocks of segments; two fingerprints
within ``max_bits`` differ by at most 1 in the counts of one block at least.
The grid join therefore probes, block by block, a fingerprint's own cell and
the cells one step up in one segment (a step down is the partner's step up),
as an equi-join on (block, cell). Pairs that meet in a cell are verified at
once on all 64 bits.

Only distinct fingerprints are joined, so copies never form pairs; components
are contracted in ``components.py``; both the links and the labels stay
distributed. A random pair meets in a cell with probability 7e-6 for the
default 3 bits; past some hundred million distinct fingerprints a third
block (``blocks``) does not help, and one-bit segments would be the choice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import cut, id_text, raw_texts, unused
from tillroll.llm.components import components

SEED = 42
_EVEN = 0x5555555555555555  # the low bit of every two-bit segment


def _long(bits: int):
    """An unsigned 64-bit constant as Spark's signed long."""
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    words = raw.lower().split()  # ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    packed = np.array(hashes, dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(packed), 1 << 16):  # bounded memory for very long texts
        counts += np.unpackbits(packed[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x, shingle) for x in raw_texts(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def links(distinct_fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): every pair of different fingerprints of the column ``fp`` of
    ``distinct_fps`` (no repeats) within ``max_bits`` bits. A pair may be
    found in more than one block and then appears again."""
    blocks = max_bits // 2 + 1
    # the count of segment j (0, 1 or 2) sits in bits 2j and 2j+1; bitwise
    # throughout, since signed sums could overflow
    low, high = F.col("fp").bitwiseAND(F.lit(_EVEN)), F.shiftrightunsigned("fp", 1).bitwiseAND(F.lit(_EVEN))
    embedded = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    rows = distinct_fps.select("fp", embedded.alias("counts"))
    cuts = [round(32 * i / blocks) for i in range(blocks + 1)]
    base, probes = [], []
    for k in range(blocks):
        mask = sum(3 << (2 * j) for j in range(cuts[k], cuts[k + 1]))
        cell = F.col("counts").bitwiseAND(_long(mask))
        base.append(F.struct(F.lit(k).alias("block"), cell.alias("cell")))
        probes.append(F.struct(F.lit(k).alias("block"), cell.alias("cell"), F.lit(False).alias("up")))
        for j in range(cuts[k], cuts[k + 1]):
            below_two = F.getbit("counts", F.lit(2 * j + 1)) == 0
            to_one_or_two = F.when(F.getbit("counts", F.lit(2 * j)) == 0, _long(1 << (2 * j))).otherwise(_long(3 << (2 * j)))
            step = F.struct(F.lit(k).alias("block"), cell.bitwiseXOR(to_one_or_two).alias("cell"), F.lit(True).alias("up"))
            probes.append(F.when(below_two, step))
    own = rows.select(F.col("fp").alias("b"), F.explode(F.array(*base)).alias("at")).select("b", "at.*")
    probe = rows.select(F.col("fp").alias("a"), F.explode(F.array_compact(F.array(*probes))).alias("to"))
    probe = probe.select("a", F.col("to.block").alias("to_block"), F.col("to.cell").alias("to_cell"), F.col("to.up").alias("up"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    meet = (F.col("block") == F.col("to_block")) & (F.col("cell") == F.col("to_cell"))
    return probe.join(own, meet & (F.col("up") | (F.col("a") < F.col("b"))) & near).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, the row's own included. Defined results: a
    null or white text has fingerprint 0 and links like any other; fewer words
    than ``shingle`` make one shingle of the whole sequence; rows that repeat
    a doc_id are fingerprinted one by one; a row without doc_id takes part,
    and a component of such rows only has a null component_id; an empty table
    gives an empty table; other columns are ignored."""
    fps = cut(fingerprints(docs, shingle))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(links(distinct.select("fp"), max_bits))
    linked = distinct.join(labels, distinct.fp == labels.node).select("fp", "first_id", "root")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("linked_id"))
    linked = linked.join(smallest, "root").select(F.col("fp").alias("linked_fp"), "linked_id")
    named = distinct.join(linked, distinct.fp == linked.linked_fp, "left")
    named = named.select(F.col("fp").alias("named_fp"), F.coalesce("linked_id", "first_id").alias("component_id"))
    # dealt anew, so that the join has an exchange on both sides and Spark can
    # split the partition of a frequent fingerprint
    named = named.hint("rebalance")
    return fps.join(named, fps.fp == named.named_fp).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with
    the smallest doc_id. Rows without a doc_id cannot be named and are all
    kept; of rows that repeat the kept doc_id, each stays (they are one
    document of the input; exact dedup removes repeats). Of rows that repeat
    a doc_id with different texts, each goes or stays with its own text."""
    found = cut(near_duplicates(docs, shingle, max_bits)).where("doc_id is not null")
    gone = F.col("doc_id") != F.col("component_id")
    ids = found.groupBy(F.col("doc_id").alias("gone_id")).agg(F.bool_or(gone).alias("any_gone"), F.bool_and(gone).alias("all_gone"))
    own_id = docs["doc_id"].cast("long")
    whole = ids.where("all_gone").select("gone_id")
    left = docs.join(whole, own_id == whole["gone_id"], "left_anti")
    # only rows of these doc_ids need their fingerprint beside the other columns
    mixed = ids.where("any_gone and not all_gone").select("gone_id")
    if mixed.isEmpty():
        return left
    signed = F.udf(lambda raw: int(np.uint64(fingerprint(bytes(raw), shingle)).astype(np.int64)), "long")
    column = unused("fp", docs)
    some = left.join(mixed, own_id == mixed["gone_id"], "left_semi").withColumn(column, signed(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")))
    parts = found.where(gone).select(F.col("doc_id").alias("gone_id"), F.col("fp").alias("gone_fp")).distinct()
    some = some.join(parts, (own_id == parts["gone_id"]) & (some[column] == parts["gone_fp"]), "left_anti").drop(column)
    return left.join(mixed, own_id == mixed["gone_id"], "left_anti").unionByName(some)
