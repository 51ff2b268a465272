"""Licence scan by the Dice coefficient over word bigrams.

Every line, every paragraph (parted by an empty line) and the whole text is
normalised to lower-case words of letters and digits and compared with the
licence templates: 2 * shared / (own + template's), bigrams with repeats.
At a threshold t only templates of between t / (2 - t) and (2 - t) / t times
the unit's bigrams can reach it; the others, and units beyond every
template, are never compared. What is left meets only templates it shares a
bigram with.

A notice inside a longer unit (a sentence in a line, a part of a comment or
of a file without such empty lines) is a run of the text's words: a licence
that no unit reaches is looked for in every run of at least the template's
bigrams (a shorter one would leave out what differs at its ends). The best
has at most (2 - t) / t times the template's bigrams and shares t times them
or more, so only starts with that many of them so near are followed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Container, Iterator, Sequence
from math import ceil, floor

import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import id_text, raw_texts

THRESHOLD = 0.8
_WORDS = re.compile(rb"[a-z0-9]+")


def bigrams(raw: bytes) -> list[tuple[bytes, bytes]]:
    words = _WORDS.findall(raw.lower())
    return list(zip(words, words[1:], strict=False))


class Templates:
    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float):
        counted = sorted(((Counter(bigrams(text.encode())), name) for name, text in templates), key=lambda x: (x[0].total(), x[1]))
        counted = [x for x in counted if x[0]]
        self.names = [name for _, name in counted]
        self.counts = [c for c, _ in counted]
        self.sizes = [c.total() for c in self.counts]
        self.threshold, self.ratio = threshold, threshold / (2 - threshold)
        self.largest = max(self.sizes, default=0) / self.ratio
        self.having: dict[tuple[bytes, bytes], list[int]] = {}
        for i, c in enumerate(self.counts):
            for pair in c:
                self.having.setdefault(pair, []).append(i)

    def matches(self, unit: list[tuple[bytes, bytes]]) -> dict[str, float]:
        """The best coefficient of each licence that reaches the threshold."""
        n, out = len(unit), {}
        if not n or n > self.largest:
            return out
        first = bisect_left(self.sizes, self.ratio * n - 1e-9)
        last = bisect_right(self.sizes, n / self.ratio + 1e-9)
        if first >= last or not any(p in self.having for p in unit):
            return out
        own = Counter(unit)
        shared: Counter = Counter()
        for pair, times in own.items():
            for i in self.having.get(pair, ()):
                if first <= i < last:
                    shared[i] += min(times, self.counts[i][pair])
        for i, both in shared.items():
            dice = 2 * both / (n + self.sizes[i])
            if dice >= self.threshold:
                out[self.names[i]] = max(dice, out.get(self.names[i], 0.0))
        return out

    def runs(self, text: list[tuple[bytes, bytes]], known: Container[str]) -> dict[str, float]:
        """The best coefficient that any run of ``text``, no shorter than the
        template, reaches, of each licence that is not ``known``."""
        places: dict[int, list[int]] = {}
        for at, pair in enumerate(text):
            for i in self.having.get(pair, ()):
                places.setdefault(i, []).append(at)
        out: dict[str, float] = {}
        for i, at in places.items():
            name, counts, size = self.names[i], self.counts[i], self.sizes[i]
            least, longest = max(1, ceil(self.threshold * size - 1e-9)), floor(size / self.ratio + 1e-9)
            if name in known or len(text) < size or len(at) < least:
                continue
            for k in range(len(at) - least + 1):
                start = at[k]
                if at[k + least - 1] - start >= longest:
                    continue
                shared, left = 0, {}
                for end in at[k : bisect_left(at, start + longest, k)]:
                    pair = text[end]
                    spare = left.get(pair, counts[pair])
                    if spare:
                        left[pair] = spare - 1
                        shared += 1
                        dice = 2 * shared / (max(end - start + 1, size) + size)
                        if dice >= self.threshold:
                            out[name] = max(dice, out.get(name, 0.0))
        return out


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, license, dice, n_lines): for every row of ``docs`` and licence
    found in it, the best coefficient of any unit, or where no unit reaches the
    threshold of any run of words, and the number of lines that reach it.
    Defined results: a null or empty text, and a text without a match, give no
    row; repeated rows are scanned one by one; an empty table gives an empty
    table; other columns are never read."""
    known = Templates(templates, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                lines, best = Counter(), {}
                units = [bigrams(x) for x in raw.split(b"\n")]
                for unit in units:
                    for name, dice in known.matches(unit).items():
                        lines[name] += 1
                        best[name] = max(dice, best.get(name, 0.0))
                # units of several lines: paragraphs, and the text if it has
                # more than one; a unit beyond every template matches none
                wider = [x for x in raw.split(b"\n\n") if b"\n" in x] if len(units) > 1 else []
                if len(units) > 1 and b"\n\n" in raw and sum(map(len, units)) <= known.largest:
                    wider.append(raw)
                for x in wider:
                    for name, dice in known.matches(bigrams(x)).items():
                        best[name] = max(dice, best.get(name, 0.0))
                best |= known.runs(bigrams(raw), best)
                rows += [(doc, name, dice, lines[name]) for name, dice in best.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.float64(), pa.int64()))],
                names=["doc_id", "license", "dice", "n_lines"],
            )

    return id_text(docs).mapInArrow(run, "doc_id long, license string, dice double, n_lines long")
