"""Main text of web pages by a tree-structured graphical model.

Every DOM node carries a hidden label: content, clutter, or a frame around
parts of either kind. A node's own evidence (its tag, the words of its class
and id, how much text it holds and how much of that is links) gives a unary
potential; parent and child labels are tied by a potential that depends on the
child's tag. Sum-product messages go up the tree, then down, and give each
node its marginals; text belongs to the page's main text if the element that
holds it is content with a probability over one half. Frames let a page do
without an element that names its article: paragraphs in the body, a plain
wrapper or a table's cell may be content there, and not in a footer.

Potentials are smoothed counts over labelled pages (``labelled_pages.py``
by default), in which elements are marked; the label of a node is that of
its nearest marked ancestor, and without one it is a frame.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bound_batches
from tillroll.llm.dom import BLOCK, RAW, Node, parse

SMOOTHING = 0.5
#: Exponents of a trait's potential: the size and links of nested elements
#: repeat each other, names and text of its own do not.
WEIGHTS = {"name": 2.0, "own": 1.0}
OTHER_WEIGHT = 0.4
#: Attribute of labelled pages: "1" marks content, "0" what is not.
MARK = "data-main"
# The labels; the first two as they are marked.
CLUTTER, CONTENT, FRAME = 0, 1, 2
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small span strike strong sub sup time tt u var math mi mn mo mtext mrow msup msub mfrac msqrt semantics".split())
# elements without readable text, whatever the model thinks of them; of a form
# these are its controls, and the model judges what else it holds
_SILENT = (RAW - {"textarea"}) | {"head", "button", "select", "option", "input", "textarea", "label"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _evidence(nodes: list[Node]) -> list[list[str]]:
    """The observed traits of each node."""
    chars, linked, own = [0] * len(nodes), [0] * len(nodes), [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        for x in node.items:
            if isinstance(x, str):
                chars[i] += len(x.strip())
                own[i] += len(x.strip())
            else:
                chars[i] += chars[x]
                linked[i] += chars[x] if nodes[x].tag == "a" else linked[x]
                own[i] += own[x] if nodes[x].tag in INLINE and nodes[x].tag != "a" else 0
        if node.tag in RAW:
            chars[i] = 0
    out = []
    for i, node in enumerate(nodes):
        size = min(6, int(math.log(chars[i] + 1, 4)))
        share = 0 if not chars[i] else min(3, int(4 * linked[i] / chars[i]))
        traits = [f"tag={node.tag}", f"links={share}", f"size={size}"]
        if node.tag in BLOCK:  # text of its own, beside that of its blocks
            traits.append(f"own={node.tag}:{min(3, int(math.log(own[i] + 1, 16)))}")
        if node.attrs:
            names = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')} {node.attrs.get('role', '')}"
            traits += sorted({f"name={w.lower()}" for w in _WORD.findall(names)})
        out.append(traits)
    return out


Three = tuple[float, float, float]


@dataclass(frozen=True)
class Model:
    """Log potentials by label: of a trait, of the labels of parent and child
    by the child's tag (a row a parent's label), and of the document."""

    traits: dict[str, Three]
    edges: dict[str, tuple[Three, Three, Three]]
    any_edge: tuple[Three, Three, Three]
    root: Three

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of each node, by one pass up and one down."""
        n = len(nodes)
        belief = [[0.0, 0.0, 0.0] for _ in nodes]
        for own, traits in zip(belief, _evidence(nodes), strict=True):
            for t in traits:
                if t in self.traits:
                    for x, w in enumerate(self.traits[t]):
                        own[x] += w
        edge = [self.edges.get(node.tag, self.any_edge) for node in nodes]
        # message[i]: what the node and all below it tell its parent
        message: list[Three] = [(0.0, 0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            b0, b1, b2 = belief[i]
            message[i] = m = tuple(_plus(e0 + b0, e1 + b1, e2 + b2) for e0, e1, e2 in edge[i])
            above = belief[nodes[i].parent]
            above[0] += m[0]
            above[1] += m[1]
            above[2] += m[2]
        for x in range(3):
            belief[0][x] += self.root[x]
        # down: the parent's belief without what this child told it
        for i in range(1, n):
            p0, p1, p2 = (b - m for b, m in zip(belief[nodes[i].parent], message[i], strict=True))
            e0, e1, e2 = edge[i]
            own = belief[i]
            for x in range(3):
                own[x] += _plus(e0[x] + p0, e1[x] + p1, e2[x] + p2)
            top = max(own)
            own[0] -= top
            own[1] -= top
            own[2] -= top
        return [math.exp(b[CONTENT] - _plus(*b)) for b in belief]


def _plus(a: float, b: float, c: float) -> float:
    """log(exp(a) + exp(b) + exp(c))"""
    top = max(a, b, c)
    return top + math.log(math.exp(a - top) + math.exp(b - top) + math.exp(c - top))


def train(pages: list[str]) -> Model:
    """Potentials from pages whose elements are marked with MARK: "1" is
    content and "0" clutter, both with all below them; what no mark holds is a
    frame."""
    seen = (Counter(), Counter(), Counter())
    size, steps, all_steps, roots = [0, 0, 0], {}, Counter(), Counter()
    for page in pages:
        nodes = parse(page)
        label = [FRAME] * len(nodes)
        for i, node in enumerate(nodes):
            above = label[node.parent] if node.parent >= 0 else FRAME
            label[i] = int(node.attrs.pop(MARK, above))
        for i, (node, traits) in enumerate(zip(nodes, _evidence(nodes), strict=True)):
            seen[label[i]].update(traits)
            size[label[i]] += 1
            if node.parent >= 0:
                steps.setdefault(node.tag, Counter())[label[node.parent], label[i]] += 1
                all_steps[label[node.parent], label[i]] += 1
            else:
                roots[label[i]] += 1

    def tie(counts: Counter) -> tuple[Three, Three, Three]:
        out = []
        for p in range(3):
            total = sum(counts[p, c] for c in range(3)) + 3 * SMOOTHING
            out.append(tuple(math.log((counts[p, c] + SMOOTHING) / total) for c in range(3)))
        return tuple(out)

    def potential(t: str) -> Three:
        weight = WEIGHTS.get(t.split("=")[0], OTHER_WEIGHT)
        return tuple(weight * math.log((seen[x][t] + SMOOTHING) / (size[x] + 2 * SMOOTHING)) for x in range(3))

    root = tuple(math.log(roots[x] + SMOOTHING) for x in range(3))
    return Model({t: potential(t) for t in {*seen[0], *seen[1], *seen[2]}}, {t: tie(c) for t, c in steps.items()}, tie(all_steps), root)


def main_text(page: str | None, model: Model) -> str:
    """The main text of one page: blocks in page order, joined by one \\n; in
    a block white space is one space. Inline elements take the label of the
    element around them, unless their names mark them off."""
    if not page:
        return ""
    nodes = parse(page)
    content = model.marginals(nodes)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    # depth first, without recursion: pages may nest deeply
    todo: list[tuple] = [(0, False)]
    while todo:
        x, kept = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            if kept:
                line.append(x)
        else:
            node = nodes[x]
            if node.tag in _SILENT:
                continue
            if node.tag not in INLINE or node.attrs.get("class") or node.attrs.get("id"):
                kept = content[x] > 0.5
            block = node.tag in BLOCK
            if block:
                flush()
                todo.append((None, False))
            todo.extend((y, kept) for y in reversed(node.items))
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``. Defined
    results: null or empty html, and a page without main text, give an empty
    text; repeated rows are read one by one; an empty table stays empty;
    columns but page_id, url and html are never read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, model) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    bound_batches(pages.sparkSession)
    wanted = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return wanted.mapInArrow(run, "page_id long, url string, text string, n_chars long")
