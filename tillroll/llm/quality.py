"""Quality rules with an isolation forest on their statistics.

The rules' statistics of a text (word lengths, symbols, repeated lines and
word windows, capitals, marks, line shapes) make a vector. An isolation forest
of TREES trees, each grown on SAMPLE labelled good rows that the base rules
let through, gives a text the mean depth at which random splits set it apart.
A node splits any statistic, between bounds that reach MARGIN of the sample's
range beyond it, so a text out there is parted from all good ones in a step or
two, while the good ones still share the rest of the path.

Half of the labelled rows (by hash of doc_id) grow the trees, the other half
sets the depth below which a text is rejected: where the two labels are told
apart best (F1 of the bad ones among the rows that the base rules let
through).

The fit reads at most MAX_LABELLED labelled rows (those with the smallest
hash of doc_id). Statistics and verdicts cover every row and whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WHITE, id_text, raw_texts

MAX_LABELLED = 20_000
TREES = 200
SAMPLE = 256
SEED = 20
MARGIN = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The symbols of the contract, and the base statistics.
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols_a_word", "dup_lines", "repeat_words", "capitals", "marks_a_word", "stops_a_word", "digits", "words_a_line", "distinct_words",
)


def _repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    code = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    v = len(number)
    if v < 1 << 20:
        windows = (code[:-2] * v + code[1:-1]) * v + code[2:]
    else:  # number the pairs first, so that the product fits
        _, pairs = np.unique(code[:-1] * v + code[1:], return_inverse=True)
        windows = pairs[:-1].astype(np.int64) * v + code[2:]
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    if not equal.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    return int((twice | np.roll(twice, 1) | np.roll(twice, 2)).sum())


def statistics(raw: bytes) -> tuple[list[int], list[float]]:
    """(base counts in the order of BASE, features in that of FEATURES)."""
    words = raw.split()
    n = len(words)
    chars = len(raw) if raw.isascii() else len(raw.decode())
    word_chars = chars - sum(raw.count(WHITE[i : i + 1]) for i in range(len(WHITE)))
    symbols = sum(raw.count(s.encode()) for s in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip(WHITE)]
    dup_lines = len(lines) - len(set(lines))
    repeat = _repeat_words(words)
    upper = sum(map(bytes.isupper, words))
    per = 1 / max(1, n)
    features = [
        float(np.log1p(n)),
        word_chars * per,
        symbols * per,
        dup_lines / max(1, len(lines)),
        repeat * per,
        upper * per,
        (raw.count(b"!") + raw.count(b"?")) * per,
        (raw.count(b".") + raw.count(b",")) * per,
        sum(raw.count(b"%d" % d) for d in range(10)) * per,
        float(np.log1p(n / max(1, len(lines)))),
        len(set(words)) * per,
    ]
    return [n, word_chars, symbols, dup_lines, repeat], features


def base_failed(base) -> np.ndarray:
    """Rows (counts in the order of BASE) that the base rules reject."""
    base = np.array(base, np.int64).reshape(-1, len(BASE))
    return (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])


def _depth_left(n: int) -> float:
    """Mean depth of an unsuccessful search among n: what a leaf of n adds."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: a node's feature (-1: leaf), split, children and, for
    a leaf, its depth; ``least`` is the smallest mean depth that passes."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    least: float = 0.0

    def depths(self, x: np.ndarray) -> np.ndarray:
        """Mean depth of each row of ``x``."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            while True:
                f = self.feature[t][node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= self.split[t][node]
                node = np.where(inner, self.child[t][node] + right, node)
            total += self.depth[t][node]
        return total / max(1, len(self.feature))


def grow(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(2, min(sample, len(x))))))
    width = 2 ** (limit + 1)
    feature = np.full((trees, width), -1, np.int64)
    split, depth, child = np.zeros((trees, width)), np.zeros((trees, width)), np.zeros((trees, width), np.int64)
    for t in range(trees):
        own = x[rng.choice(len(x), min(sample, len(x)), replace=False)]
        reach = MARGIN * np.maximum(own.max(0) - own.min(0), 1e-3)
        todo, used = [(0, own, 0, own.min(0) - reach, own.max(0) + reach)], 1
        while todo:
            node, rows, level, low, high = todo.pop()
            if level >= limit or len(rows) < 2:
                depth[t, node] = level + _depth_left(len(rows))
                continue
            f = int(rng.integers(x.shape[1]))
            s = rng.uniform(low[f], high[f])
            feature[t, node], split[t, node], child[t, node] = f, s, used
            below, above = high.copy(), low.copy()
            below[f] = above[f] = s
            todo += [(used, rows[rows[:, f] < s], level + 1, low, below), (used + 1, rows[rows[:, f] >= s], level + 1, above, high)]
            used += 2
    return Forest(feature, split, child, depth)


def fit(docs: DataFrame, labels: DataFrame) -> Forest | None:
    """The calibrated forest, from (doc_id, quality) labels; a doc_id with
    several labels counts as bad if one is 0. None without good rows, and
    then the base rules alone decide; without bad rows no depth rejects."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("quality").cast("int").alias("quality")).na.drop()
    wanted = wanted.groupBy("l_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("l_id"), "l_id").limit(MAX_LABELLED)
    # at most MAX_LABELLED rows of two numbers are broadcast, and as many
    # short vectors are collected
    sample = id_text(docs).join(F.broadcast(wanted), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [statistics(t) for t in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f for _, f in counts], pa.list_(pa.float64())), pa.array(base_failed([b for b, _ in counts])), batch.column(2)],
                names=["doc_id", "features", "failed", "quality"],
            )

    found = sample.mapInArrow(run, "doc_id long, features array<double>, failed boolean, quality int").collect()
    found.sort(key=lambda r: (r["doc_id"], r["features"]))
    x = np.array([r["features"] for r in found]).reshape(-1, len(FEATURES))
    good, passed = (np.array([r[c] == v for r in found], bool) for c, v in (("quality", 1), ("failed", False)))
    if not (good & passed).any():
        return None
    half = np.array([zlib.crc32(b"%d" % r["doc_id"]) % 2 == 0 for r in found])
    grown = good & passed & half
    forest = grow(x[grown if grown.any() else good & passed])
    rated = passed & ~half
    if not (rated & ~good).any():  # too few rows to spare half of them
        rated = passed
    depths, bad = forest.depths(x[rated]), ~good[rated]
    if not bad.any():
        return forest
    order = np.argsort(depths, kind="stable")
    d, caught = depths[order], np.cumsum(bad[order])
    f1 = np.where(np.append(d[1:] > d[:-1], True), 2 * caught / (np.arange(1, len(d) + 1) + bad.sum()), -1)
    best = int(np.argmax(f1))
    return replace(forest, least=float((d[best] + d[best + 1]) / 2 if best + 1 < len(d) else d[best]))


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, depth, kept) for every row of ``docs``. Defined results: a
    null or empty text has no words and fails the base rules; repeated rows
    are judged one by one; without a forest depth is null and the base rules
    decide; an empty table stays empty; other columns are never read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in raw_texts(batch.column(1))]
            base = np.array([b for b, _ in found], np.int64).reshape(-1, len(BASE))
            failed = base_failed(base)
            if forest is None:
                depth, passed = pa.nulls(len(base), pa.float64()), np.ones(len(base), bool)
            else:
                depths = forest.depths(np.array([f for _, f in found]).reshape(-1, len(FEATURES)))
                depth, passed = pa.array(depths), depths >= forest.least
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in base.T), pa.array(failed), depth, pa.array(~failed & passed)],
                names=["doc_id", *BASE, "base_failed", "depth", "kept"],
            )

    counts = ", ".join(f"{c} long" for c in BASE)
    return id_text(docs).mapInArrow(run, f"doc_id long, {counts}, base_failed boolean, depth double, kept boolean")
