"""Toxicity by maximum-scoring segments.

Fitting. On labelled rows, every token gets the log-odds of occurring in a
toxic against a clean text, with a Dirichlet prior of PRIOR occurrences a
token at the pooled rate. Tokens count once a text, and equal texts once, so
that one long or much-copied text does not make its own words toxic. The
log-odds are shrunk by how sure they are: with z, their size in posterior
standard deviations, a weight keeps the share z^2 / (z^2 + DOUBT). No token
is left out: one seen once weighs little, an unseen one nothing, clean-leaning
ones count against, and each token costs DRIFT, so that a clean text's sum
falls.

Scoring. One linear scan over a text's tokens finds all its maximal scoring
segments (Ruzzo and Tompa). Under the clean token shares a segment of score S
in n tokens has an expected count of at most E = n exp(-lambda S); lambda
solves the usual equation for those shares. The text's evidence is the sum of
-ln E over its significant segments (E below SIGNIFICANT), or the best -ln E
above zero if none is. A logistic curve maps evidence to a score; its 0.7 lies
where labelled rows are told apart best. The curve is set out of fold: the
evidence of each labelled row comes from weights learnt without its fold
(FOLDS of them, by hash of the text, so that copies are never on both sides).

The fit reads at most MAX_LABELLED labelled rows (those with the smallest
hash of doc_id); scoring covers every row and whole texts.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bound_batches, cut, id_text

MAX_LABELLED = 40_000
PRIOR = 1.0
DOUBT = 9.0
DRIFT = 0.1
FOLDS = 5
SAME = 0.01
SIGNIFICANT = 0.05
THRESHOLD = 0.7

# punctuation and other ASCII signs part tokens, like white space
_PARTS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_PARTS).split()


def maximal_segments(weights: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a
    text whose tokens weigh ``weights``."""
    left: list[float] = []  # total before the segment
    right: list[float] = []  # total at its end
    link: list[int] = []  # the last segment with a smaller left
    span: list[tuple[int, int]] = []
    total = 0.0
    for p, w in enumerate(weights):
        if w <= 0:
            total += w
            continue
        low, start = total, p
        total += w
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= low:
                j = link[j]
            if j < 0 or right[j] >= total:
                break
            low, start = left[j], span[j][0]
            del left[j:], right[j:], link[j:], span[j:]
        left.append(low)
        right.append(total)
        link.append(j)
        span.append((start, p))
    return [(s, e, r - lo) for (s, e), lo, r in zip(span, left, right, strict=True)]


@dataclass(frozen=True)
class Model:
    """Token weights (less DRIFT), the extreme-value rate and the logistic
    curve. Tokens and weights travel as two strings; the table of them is
    built where it is used, and not on the driver."""

    words: bytes = b""  # parted by line ends
    values: bytes = b""  # as many 32-bit floats
    rate: float = 1.0  # lambda
    slope: float = 0.0
    middle: float = 0.0

    @cached_property
    def weights(self) -> dict[bytes, float]:
        return dict(zip(self.words.split(b"\n"), np.frombuffer(self.values, np.float32).tolist())) if self.words else {}

    def passages(self, words: list[bytes]) -> list[tuple[int, int, float, float]]:
        """(first token, last token, score, -ln E) of each maximal segment."""
        weight = self.weights.get
        base = math.log(len(words)) if words else 0.0
        return [(s, e, score, self.rate * score - base) for s, e, score in maximal_segments([weight(w, -DRIFT) for w in words])]

    def evidence(self, passages: list[tuple[int, int, float, float]]) -> float:
        sure = [x[3] for x in passages if x[3] > -math.log(SIGNIFICANT)]
        return sum(sure) if sure else max([0.0, *(x[3] for x in passages)])

    def score(self, evidence: float) -> float:
        if not self.slope:
            return 0.0
        x = self.slope * (evidence - self.middle) + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def _weights(clean: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, float]:
    """Each token's weight from the texts of either kind that hold it, and
    lambda."""
    n_clean, n_bad = clean.sum(), bad.sum()
    rate = n_bad / (n_clean + n_bad)
    bad, clean = bad + PRIOR * rate, clean + PRIOR * (1 - rate)
    odds = np.log(bad / bad.sum()) - np.log(clean / clean.sum())
    z2 = odds * odds / (1 / bad + 1 / clean)
    weights = odds * z2 / (z2 + DOUBT) - DRIFT
    shares = clean / clean.sum()
    lo, hi = 1e-9, 1.0
    while np.dot(shares, np.exp(np.minimum(600.0, hi * weights))) < 1 and hi < 100:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if np.dot(shares, np.exp(np.minimum(600.0, mid * weights))) < 1 else (lo, mid)
    return weights, (lo + hi) / 2


def _stored(words: np.ndarray, weights: np.ndarray) -> tuple[bytes, bytes]:
    """What a model carries: weights within SAME of an unseen token's, such as
    those of words that one clean text has, need no place in the table."""
    apart = np.abs(weights + DRIFT) >= SAME
    return b"\n".join(words[apart].tolist()), weights[apart].astype(np.float32).tobytes()


def _curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve: the middle lies in the gap of
    the sorted evidence that gives the best F1."""
    order = np.argsort(-evidence, kind="stable")
    e, y = evidence[order], toxic[order].astype(float)
    last = np.append(e[1:] < e[:-1], True)
    f1 = np.where(last & (e > 0), 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum()), -1)
    best = int(np.argmax(f1))
    middle = (e[best] + (e[best + 1] if best + 1 < len(e) else 0.0)) / 2
    if e[best] <= 0:  # no text has evidence: none is called toxic
        middle = -math.log(SIGNIFICANT)
    shift = math.log(THRESHOLD / (1 - THRESHOLD))

    def loss(slope: float) -> float:
        x = slope * (evidence - middle) + shift
        return float(np.mean(np.logaddexp(0, np.where(toxic, -x, x)))) + 1e-4 * slope * slope

    return min((0.02 * 1.5**i for i in range(18)), key=loss), float(middle)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """``labels``: (doc_id, toxic) rows that may be learnt from; a doc_id with
    several labels counts as toxic if one is 1; null labels do not count.
    Without both classes in the sample the model scores everything 0."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).na.drop()
    wanted = wanted.groupBy("l_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("l_id"), "l_id").limit(MAX_LABELLED)
    # at most MAX_LABELLED rows of two numbers are broadcast
    sample = id_text(docs).join(F.broadcast(wanted), F.col("doc_id") == F.col("l_id")).select("text", "toxic")
    # and so many texts are kept
    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int").alias("fold")
    sample = cut(sample.select("text", "toxic", fold))
    unique = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"), F.first("fold").alias("fold"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, int], Counter] = defaultdict(Counter)
            for text, toxic, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen[part, toxic].update(set(tokens(text)))
            for (part, toxic), own in seen.items():
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(own), pa.binary()), pa.array([part] * n, pa.int32()), pa.array([toxic] * n, pa.int32()), pa.array(list(own.values()), pa.int64())],
                    names=["token", "fold", "toxic", "n"],
                )

    counts = unique.select("text", "toxic", "fold").mapInArrow(count, "token binary, fold int, toxic int, n long")
    of = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == y), F.col("n")).otherwise(0)).cast("int").alias(f"{'cb'[y]}{f}") for y in (0, 1) for f in range(FOLDS)]
    # the words of a bounded sample
    known = counts.groupBy("token").agg(*of).toArrow()
    words = np.array(known.column(0).to_pylist(), object)
    tables = [np.stack([known.column(1 + y * FOLDS + f).to_numpy() for f in range(FOLDS)]) for y in (0, 1)]
    del known
    clean, bad = (x.sum(axis=0) for x in tables)
    if not clean.sum() or not bad.sum():
        return Model()
    rated: list[tuple[float, int]] = []
    for f in range(FOLDS):
        learnt = [total - x[f] for total, x in zip((clean, bad), tables, strict=True)]
        if learnt[0].sum() and learnt[1].sum():
            weights, rate = _weights(*learnt)
            part = _evidence(sample.where(F.col("fold") == f), Model(*_stored(words, weights), rate))
            rated += [(r["evidence"], r["toxic"]) for r in part.collect()]  # of a bounded sample, two numbers a row
    if not any(y for _, y in rated):
        return Model()
    weights, rate = _weights(clean, bad)
    slope, middle = _curve(np.array([e for e, _ in rated]), np.array([y == 1 for _, y in rated]))
    return Model(*_stored(words, weights), rate, slope, middle)


def _evidence(sample: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.evidence(model.passages(tokens(t))) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column(1)], names=["evidence", "toxic"])

    return sample.select("text", "toxic").mapInArrow(run, "evidence double, toxic int")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, passages) for every row of ``docs``;
    passages: the significant ones as (first token, last token, score), by
    place. Defined results: a null or empty text has no passage and the score
    of no evidence; repeated rows are scored one by one; an empty table stays
    empty; other columns are never read."""
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.passages(tokens(t)) for t in batch.column(1).to_pylist()]
            scores = [model.score(model.evidence(x)) for x in found]
            sure = [[(s, e, w) for s, e, w, x in one if x > -math.log(SIGNIFICANT)] for one in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(x >= THRESHOLD) for x in scores], pa.int32()), pa.array(sure, kind)],
                names=["doc_id", "score", "predicted", "passages"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, score double, predicted int, passages array<struct<first:int,last:int,score:double>>")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose own text is predicted toxic, in one
    pass and without a shuffle; columns and null texts stay as they are."""
    bound_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score(model.evidence(model.passages(tokens(t)))) < THRESHOLD for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
