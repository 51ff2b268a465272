"""Ranked lexical search by exact inner products over sparse ball trees.

A document is the sparse vector of its terms' saturated frequencies, an item
the vector of its terms' weights, and a score their inner product, all in
integers. Only coordinates that some item has can add to a score, so vectors
are kept for the items' terms alone, while the corpus statistics (documents,
terms, document frequencies) count every document.

1. One pass over the texts writes the vectors (term numbers and frequencies)
   and each document's number of terms.
2. Statistics are aggregated from them; there is one number per item term.
3. Every task builds ball trees over TREE_DOCS vectors at a time. A node has
   the centroid and radius of its documents: a document x of a node with
   centroid u and radius r scores at most <q, u> + |q'| r for an item q, where
   q' is q on the terms that the node's documents hold. All three are rounded
   up by more than floating point can lose.
4. Each item descends best-first: the node with the highest bound is opened
   next, a leaf's documents are scored in exact 64-bit integers, and the
   search ends when no open bound reaches the item's k-th best score.
5. The k best of every task meet in one window per item.

First a slice of the tasks' vectors is searched: its k-th best scores are
lower bounds of the final ones, with which all trees then start to prune.

Items are the small side: they travel to every task in blocks of ITEM_BLOCK.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut, id_text, raw_texts, record_batch

# Fixed value: terms are the maximal matches of
# [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+, with A-Z lower-cased: ASCII letters
# and digits, and every character beyond ASCII. On bytes, all others become
# spaces.
_UPPER = bytes(range(65, 91))
_OTHERS = bytes(b for b in range(128) if not chr(b).isalnum())
_SPACED = bytes.maketrans(_UPPER + _OTHERS, _UPPER.lower() + b" " * len(_OTHERS))

#: Items searched together, and their text: what every task gets of them.
ITEM_BLOCK = 256
ITEM_BLOCK_BYTES = 4 << 20
#: Vectors in a tree, their entries, and documents in a leaf.
TREE_DOCS = 8192
TREE_ENTRIES = 2 << 20
LEAF_DOCS = 24
#: One in so many documents is searched first, for the thresholds.
FIRST_SLICE = 16
#: Relative slack of the bounds: sums of n products of doubles are off by less
#: than n * 2**-52 of their terms, so this covers vectors of a million terms.
_SLACK = 1e-9

_VECTOR_DDL = "doc_id long, n long, terms array<int>, counts array<int>"
_FOUND = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "item int, item_id long, doc_id long, score long"


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_SPACED).split()


# -- vectors and statistics ----------------------------------------------------


def _vectors(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): each text's number of terms, and how often
    it has those that are numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, offsets, terms, counts = [], [0], [], []
            for raw in raw_texts(batch.column(1)):
                words = terms_of(raw)
                sizes.append(len(words))
                own = Counter(words)
                for word in own.keys() & numbers.keys():
                    terms.append(numbers[word])
                    counts.append(own[word])
                offsets.append(len(terms))
            lists = (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return id_text(docs).mapInArrow(run, _VECTOR_DDL)


def _document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; a task counts its own before the
    shuffle, and ``size`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], names=["term", "held"])

    out = np.zeros(size, np.int64)
    for row in vectors.select("terms").mapInArrow(run, "term int, held long").groupBy("term").agg(F.sum("held").alias("held")).collect():
        out[row["term"]] = row["held"]
    return out


def term_weight(documents: int, held: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


class Items:
    """A block of items as sparse integer vectors, by item and by term."""

    def __init__(self, ids: list[int | None], terms: list[list[int]], weights: np.ndarray) -> None:
        self.ids = ids
        self.size = len(weights)
        item = np.repeat(np.arange(len(ids)), [len(t) for t in terms])
        term = np.array([t for own in terms for t in own], np.int64)
        order = np.argsort(term, kind="stable")
        self.by_term = item[order]
        self.begin = np.searchsorted(term[order], np.arange(self.size + 1))
        self.weights = weights
        self.terms = [np.array(t, np.int64) for t in terms]

    def dense(self, item: int) -> np.ndarray:
        out = np.zeros(self.size, np.int64)
        out[self.terms[item]] = self.weights[self.terms[item]]
        return out

    def products(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """For every row and item: the sum of value * weight over the row's
        (term, value), and of the squared weights of these terms."""
        many = (self.begin[term + 1] - self.begin[term]).astype(np.int64)
        entry = np.repeat(np.arange(len(term)), many)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many) + self.begin[term[entry]]
        cell = row[entry] * len(self.ids) + self.by_term[place]
        weight = self.weights[term[entry]].astype(float)
        shape = (rows, len(self.ids))
        inner = np.bincount(cell, value[entry] * weight, rows * len(self.ids)).reshape(shape)
        return inner, np.bincount(cell, weight * weight, rows * len(self.ids)).reshape(shape)


# -- trees -----------------------------------------------------------------------


class BallTree:
    """Sparse vectors (rows of ``begin``, ``term``, ``value``), none empty, in
    a binary tree; ``order`` lists them leaf by leaf."""

    def __init__(self, begin: np.ndarray, term: np.ndarray, value: np.ndarray, size: int, leaf: int = LEAF_DOCS) -> None:
        self.order = np.arange(len(begin) - 1)
        self.low, self.high, self.children, self.radius = [], [], [], []
        centres: list[tuple[np.ndarray, np.ndarray]] = []
        real = value.astype(float)
        square = np.add.reduceat(real * real, begin[:-1]) if len(self.order) else np.zeros(0)
        waiting = [(0, len(self.order), -1)] if len(self.order) else []
        while waiting:
            low, high, parent = waiting.pop()
            node, rows = len(self.low), self.order[low:high]
            sizes = begin[rows + 1] - begin[rows]
            starts = np.cumsum(sizes) - sizes
            entry = np.arange(sizes.sum()) + np.repeat(begin[rows] - starts, sizes)
            terms, values = term[entry], real[entry]
            centre = np.bincount(terms, values, size) / len(rows)
            own = np.flatnonzero(np.bincount(terms, minlength=size))
            length = float(centre @ centre)
            apart = square[rows] - 2 * np.add.reduceat(values * centre[terms], starts) + length
            slack = _SLACK * (square[rows].max() + length)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            self.radius.append(math.sqrt(max(apart.max(), 0.0) + slack))
            centres.append((own, centre[own]))
            if parent >= 0:
                self.children[parent].append(node)
            if len(rows) > leaf:
                # towards the farthest document from the centre, or from the
                # one that is farthest from it
                def spread(i: int, terms=terms, values=values, starts=starts, sizes=sizes) -> np.ndarray:
                    pivot = np.zeros(size)
                    pivot[terms[starts[i] : starts[i] + sizes[i]]] = values[starts[i] : starts[i] + sizes[i]]
                    return np.add.reduceat(values * pivot[terms], starts)

                one = int(apart.argmax())
                to_one = spread(one)
                other = int((square[rows] - 2 * to_one).argmax())
                side = np.argsort(to_one - spread(other), kind="stable")
                self.order[low:high] = rows[side]
                middle = low + len(rows) // 2
                waiting += [(low, middle, node), (middle, high, node)]
        self._node = np.repeat(np.arange(len(centres)), [len(t) for t, _ in centres])
        self._term = np.concatenate([t for t, _ in centres]) if centres else np.zeros(0, np.int64)
        self._centre = np.concatenate([v for _, v in centres]) if centres else np.zeros(0)

    def bounds(self, items: Items) -> np.ndarray:
        """(nodes, items): no document of a node scores more for an item."""
        inner, squares = items.products(self._node, self._term, self._centre, len(self.low))
        return (inner + np.sqrt(squares) * np.array(self.radius)[:, None]) * (1 + _SLACK) + 1


class Best:
    """The k best (score, doc_id) of an item so far; ties go to the smaller
    id, a null id loses them. Scores below ``least`` are not wanted."""

    def __init__(self, k: int, least: int) -> None:
        self.k, self.heap, self.least = k, [], max(least, 1)

    def add(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, 0 if doc_id is None else -doc_id)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)
        if len(self.heap) == self.k:
            self.least = max(self.least, self.heap[0][0])

    def rows(self) -> list[tuple[int, int | None]]:
        return [(score, -negative if known else None) for score, known, negative in self.heap]


def search_tree(ids: list[int | None], begin: np.ndarray, term: np.ndarray, value: np.ndarray, items: Items, best: list[Best]) -> int:
    """Adds to ``best`` what the vectors have; returns how many documents were
    scored, over all items."""
    tree = BallTree(begin, term, value, items.size)
    if not tree.low:
        return 0
    bounds = tree.bounds(items)
    # the entries leaf by leaf, so that a leaf's are one slice
    sizes = (begin[1:] - begin[:-1])[tree.order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    entry = np.arange(starts[-1]) + np.repeat(begin[:-1][tree.order] - starts[:-1], sizes)
    terms, values = term[entry], value[entry]
    scored = 0
    for item, found in enumerate(best):
        if bounds[0, item] < found.least:
            continue
        weights = items.dense(item)
        open_ = [(-bounds[0, item], 0)]
        while open_ and -open_[0][0] >= found.least:
            _, node = heapq.heappop(open_)
            for child in tree.children[node]:
                if bounds[child, item] >= found.least:
                    heapq.heappush(open_, (-bounds[child, item], child))
            if not tree.children[node]:
                low, high = tree.low[node], tree.high[node]
                a, b = starts[low], starts[high]
                scores = np.add.reduceat(values[a:b] * weights[terms[a:b]], starts[low:high] - a)
                scored += high - low
                for i in np.flatnonzero(scores >= found.least).tolist():
                    found.add(int(scores[i]), ids[tree.order[low + i]])
    return scored


# -- Spark -------------------------------------------------------------------


def _saturated(n: np.ndarray, counts: np.ndarray, documents: int, length: int, base: int = 50) -> np.ndarray:
    """(10**9 tf) div (1000 tf + 20 m), with m = 100 - base + (base n N) div L."""
    if len(n) and base * int(n.max()) * documents >= 1 << 62:  # beyond 64 bits on the way
        m = np.array([100 - base + base * int(x) * documents // length for x in n], np.int64)
    else:
        m = 100 - base + base * n * documents // max(length, 1)
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


def _searched(vectors: DataFrame, items: Items, k: int, least: list[int], documents: int, length: int) -> DataFrame:
    """(item, item_id, doc_id, score): the k best of each task and item with a
    score of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, x) for x in least]
        ids, sizes, parts, entries = [], [], [], 0

        def flush() -> None:
            nonlocal ids, sizes, parts, entries
            if ids:
                begin = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
                term, value = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                search_tree(ids, begin, term, value, items, best)
            ids, sizes, parts, entries = [], [], [], 0

        for whole in batches:
            for at in range(0, whole.num_rows, TREE_DOCS):
                batch = whole.slice(at, TREE_DOCS)
                size = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
                term = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                counts = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                n = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), size)
                has = size > 0
                if ids and (len(ids) + has.sum() > TREE_DOCS or entries + len(term) > TREE_ENTRIES):
                    flush()
                ids += [x for x, h in zip(batch.column(0).to_pylist(), has.tolist(), strict=True) if h]
                sizes.append(size[has])
                parts.append((term, _saturated(n, counts, documents, length)))
                entries += len(term)
        flush()
        rows = [(i, items.ids[i], doc_id, score) for i, found in enumerate(best) for score, doc_id in found.rows()]
        yield record_batch(_FOUND, list(zip(*rows, strict=True)) if rows else [[], [], [], []])

    return vectors.mapInArrow(run, _FOUND_DDL)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their distinct terms, so many at a time as fit a block."""
    block, size = [], 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.toLocalIterator():
        terms = sorted(set(terms_of((row["text"] or "").encode())))
        own = sum(map(len, terms))
        if block and (len(block) == ITEM_BLOCK or size + own > ITEM_BLOCK_BYTES):
            yield block
            block, size = [], 0
        if terms:
            block.append((row["item_id"], terms))
            size += own
    if block:
        yield block


def _search_block(docs: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    numbers = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}))}
    vectors = cut(_vectors(docs, numbers))
    counted = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    documents, length = counted["documents"], counted["length"]
    held = _document_frequencies(vectors, len(numbers))
    weights = np.array([term_weight(documents, int(x)) for x in held], np.int64)
    items = Items([i for i, _ in block], [[numbers[t] for t in own] for _, own in block], weights)
    some = vectors.where(F.size("terms") > 0)
    first = _searched(some.where(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_SLICE)) == 0), items, k, [1] * len(block), documents, length)
    least = [1] * len(block)
    for row in _top(first, k).where(F.col("rank") == k).select("item", "score").collect():  # a row an item
        least[row["item"]] = row["score"]
    return _top(_searched(some, items, k, least, documents, length), k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id,
    text) the ``k`` rows of ``docs`` with the highest scores above 0, ranks
    from 1, equal scores by ascending doc_id.

    Defined results: a null text has no terms, so an item without terms gets
    no rows and a document without terms none either (nor does it count in
    the statistics); rows that repeat a doc_id are documents of their own, a
    null doc_id is ranked last among equals; rows that repeat an item_id are
    items of their own; empty tables give no rows; other columns are
    ignored."""
    out = None
    for block in _blocks(items):
        found = _search_block(docs, block, k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
