"""Ranked search, periodic runs and archives, against brute force."""

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.llm import periodic, ranked, warc
from tillroll.llm.queries import QUERIES

# -- WARC ----------------------------------------------------------------------

_PAGES = "page_id long, url string, html string, payload string, file string, digest string, k_body binary, keep_id long"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y", None, 7) for r in rows], _PAGES)


def _archived(rows, least):
    """What the contract says of (page_id, url, html) rows."""
    keep = {}
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least and i is not None:
            keep[body] = max(keep.get(body, i), i)
    out = []
    for i, url, html in rows:
        body = (html or "").encode()
        refers = keep.get(body) if keep.get(body) != i else None
        out.append((i, url, "response" if refers is None else "revisit", refers, len(body), hashlib.sha1(body).hexdigest()))
    return out


WARC_CASES = [
    (1, "https://a.org/x", "same " * 300), (2, "https://a.org/y", "same " * 300), (9, None, "same " * 300), (None, "u", "same " * 300),
    (3, "https://a.org/\r\nWARC-Type: x y", "short"), (4, "", "short"), (5, "https://é.org/ü?q=1#z", None), (6, "n", ""),
    (7, "l", "é\x00\r\n\r\nWARC/1.1\r\n" * 200_000), (8, "t", "tie" * 400), (8, "t", "tie" * 400), (8, "v", "other"), (None, None, None),
]


def test_warc_round_trip_equals_brute_force(spark, tmp_path):
    hot = [(100 + i, f"https://h.org/{i}", "hot page " * 200) for i in range(400)]
    own = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    rows = WARC_CASES + hot + [(1000 + i, u, h) for i, u, h in own]
    for n, least in enumerate((1000, 1)):
        index = warc.write_archives(_pages(spark, rows).repartition(5), f"file://{tmp_path}/{n}", least)
        found = warc.read_records(index)
        got = [tuple(r)[:6] for r in found.collect()]
        assert sorted(got, key=repr) == sorted(_archived(rows, least), key=repr)
        bodies = sorted(((r.page_id, bytes(r.payload)) for r in warc.read_pages(index).select("page_id", "payload").collect()), key=repr)
        assert bodies == sorted(((i, (h or "").encode()) for i, _, h in rows), key=repr)


def test_warc_reads_only_what_is_selected(spark, tmp_path, monkeypatch):
    rows = [(i, f"https://{'a' if i % 2 else 'b'}.org/{i}", f"page {i // 3} " * 200) for i in range(60)]
    index = warc.write_archives(_pages(spark, rows).coalesce(1), str(tmp_path / "w"))
    some = warc.read_pages(index, F.col("url").startswith("https://a."))
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in some.collect()) == [(i, h) for i, _, h in rows if i % 2]
    assert warc.read_records(index.where("page_id = -1")).count() == 0
    # the index's rows are the places of whole gzip members
    for r in index.collect():
        with open(r.file.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            head = zlib.decompress(f.read(r.length), 31).split(b"\r\n")
        assert head[0] == b"WARC/1.1" and f"WARC-Type: {r.record_type}".encode() in head and f"WARC-Record-ID: <urn:page:{r.page_id}>".encode() in head


def test_warc_files_without_index_rows_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write_archives(_pages(spark, [(1, "u", "x" * 2000)]), folder)
    left = next(f for f in os.listdir(folder) if f.endswith(".warc.gz"))
    os.link(f"{folder}/{left}", f"{folder}/part-00000-attempt.warc.gz")
    assert warc.read_records(warc.read_index(spark, folder)).count() == 1
    with open(f"{folder}/{left}", "r+b") as f:  # another payload in the record's place
        f.write(os.urandom(index.first().offset + index.first().length))
    with pytest.raises(Exception, match="zlib|incorrect header|Error"):
        warc.read_records(index).collect()


def test_warc_ranges_are_coalesced_and_bounded():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 20 + warc.GAP_BYTES, 5), ("a", 26 + 2 * warc.GAP_BYTES, 5), ("b", 0, 5), ("b", 5, warc.READ_BYTES), ("b", 5 + warc.READ_BYTES, 1)]
    got = [(f, s, e, len(p)) for f, s, e, p in warc._ranges(rows)]
    assert got == [("a", 0, 25 + warc.GAP_BYTES, 3), ("a", 26 + 2 * warc.GAP_BYTES, 31 + 2 * warc.GAP_BYTES, 1), ("b", 0, 5, 1), ("b", 5, 5 + warc.READ_BYTES, 1), ("b", 5 + warc.READ_BYTES, 6 + warc.READ_BYTES, 1)]
    assert list(itertools.chain.from_iterable(p for *_, p in warc._ranges(rows))) == rows
    assert list(warc._ranges([])) == []


def test_warc_empty_table_and_bad_digest(spark, tmp_path):
    index = warc.write_archives(_pages(spark, []), str(tmp_path / "e"))
    assert index.count() == 0 and warc.read_records(index).count() == 0 and warc.read_pages(index).count() == 0
    good = warc._member(warc._page_record(1, "u", b"body", hashlib.sha1(b"body").hexdigest(), None, b"d"))
    assert warc.parse_record(good)["payload"] == b"body"
    for bad in (warc._page_record(1, "u", b"body", "0" * 40, None, b"d"), warc._page_record(1, "u", b"body", "0" * 40, None, b"d")[:-2]):
        with pytest.raises(ValueError):
            warc.parse_record(warc._member(bad))


# -- periodic runs -------------------------------------------------------------


def _runs(w, min_length=6, min_exponent=4):
    """Every run (start, period, length), by start and period."""
    n, out = len(w), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if i > s and size >= max(min_length, min_exponent * q):
                part = w[s : s + size]
                if all(part[x:] != part[:-x] for x in range(1, q)):
                    out.append((s, q, size))
            i += 1
    return sorted(out)


def _left(w, runs):
    gone = {i for s, q, size in runs for i in range(s + q, s + size)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def _planted(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def _random_texts(seed, count):
    rnd = random.Random(seed)
    for _ in range(count):
        n = rnd.choice([0, 1, 5, 6, 12, 40, 150])
        w = [rnd.choice("abcde"[: rnd.randint(1, 5)]) for _ in range(n)]
        at, q = rnd.randrange(n + 1), rnd.randint(1, 1 + n // 4)
        for i in range(at + q, n):
            w[i] = w[i - q]
        yield rnd.choice([" ", "\t", " \n"]).join(w)


@pytest.mark.parametrize(("min_length", "min_exponent", "span"), [(6, 4, 4096), (6, 4, 8), (1, 3, 16), (10, 5, 8)])
def test_runs_equal_brute_force(spark, min_length, min_exponent, span):
    texts = [*_random_texts(3, 250), None, "", " \x0b", "x " * 900, ("p q r " * 700).strip(), "é e e é " * 5, "A a " * 9]
    pairs = [(i // 2, t) for i, t in enumerate(texts)] + [(None, "n " * 9)] + [(7, "u v " * 8)] * 40
    df = spark.createDataFrame([(*p, "c", None, 1) for p in pairs], "doc_id long, text string, runs string, key binary, period long").repartition(4)
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.text) for r in periodic.collapse_runs(df, min_length, min_exponent, span=span).collect()]
    want = []
    for i, t in pairs:
        w = (t or "").encode().split()
        found = _runs(w, min_length, min_exponent)
        want.append((i, found, _left(w, found).decode()))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_runs_of_an_empty_table(spark):
    assert periodic.collapse_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        periodic.collapse_runs(spark.createDataFrame([], "doc_id long, text string"), min_exponent=2)


def test_long_texts_are_numbered_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic, "_PIECE_BYTES", 7)
    monkeypatch.setattr(periodic, "_PENDING_WORDS", 3)
    raw = b"  ab c ab \n c ab c  ddddddddddddddd ab c ab c ab c ab c e "
    numbers, words = periodic._Numbers(), []
    for piece in periodic._pieces(raw):
        numbers.add(piece)
        words += piece
    assert words == raw.split()
    got = numbers.all().tolist()
    assert [words.index(w) for w in words] == [got.index(x) for x in got]


def test_op12_equals_brute_force(spark, tmp_path):
    own = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    pairs = own + [(10_000 + i, t) for i, t in enumerate(_random_texts(5, 400))] + [(None, "z " * 20), (3, None)]
    spark.createDataFrame(pairs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    want = []
    for i, t in pairs:
        w = _planted(i, t)
        found = _runs(w)
        size, start, q = min(((-n, s, q) for s, q, n in found), default=(None,) * 3)
        listed = "".join(f"{s},{n},{q}\n" for s, q, n in found)
        digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(_left(w, found)).hexdigest())
        want.append((i, len(found), start, -size if found else None, q, 1000 * -size // q if found else None, *digests))
    assert sum(x[1] > 0 for x in want) > 100
    assert sorted(got, key=repr) == sorted(want, key=repr)


# -- ranked search -------------------------------------------------------------

_TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return _TERMS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def _ranked(docs, items, k):
    """What the contract says, document by document."""
    own = [(d, Counter(_terms(t))) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    total, count, df = sum(n for *_, n in own), len(own), Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in own:
            m = 100 - 50 + 50 * n * count // total
            score = 0
            for t in set(_terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -score) for i, (score, none, d) in enumerate(sorted(found)[:k])]
    return out


def _search_tables(spark, docs, items):
    docs = spark.createDataFrame([(*d, 1, "x", [1], 2) for d in docs], "doc_id long, text string, n long, terms string, counts array<int>, item long")
    return docs.repartition(5), spark.createDataFrame([(*i, 3, "y") for i in items], "item_id long, text string, rank long, score string")


def test_search_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(9)
    common = ["the", "de", "Und", "é", "x1", "ÄÖ"]
    rare = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rnd.choices(common, k=rnd.randint(0, 40)) + rnd.choices(rare, k=rnd.randint(0, 30)))) for i in range(500)]
    docs += [(1000 + i, "copy of the w1 w2 w3 passage") for i in range(200)] + [(None, "w1 w2 w3"), (None, "w1 w2 w3"), (7, "w1, W2;w3"), (-5, "w1_w2"), (2000, None), (2001, " .,-\n"), (2002, "w9 " * 30_000)]
    items = [(i, " ".join(rnd.choices(common + rare, k=rnd.randint(1, 25)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "nowhere else"), (None, "w1 W1 w2"), (3, "w1 w2 w3"), (3, "the"), (60, "copy passage"), (61, " ".join(rare + common))]
    tables = _search_tables(spark, docs, items)
    want = sorted(_ranked(docs, items, 20), key=repr)
    for trees, slices, block in ((8192, 16, 256), (40, 3, 7)):
        monkeypatch.setattr(ranked, "TREE_DOCS", trees)
        monkeypatch.setattr(ranked, "FIRST_SLICE", slices)
        monkeypatch.setattr(ranked, "ITEM_BLOCK", block)
        assert sorted((tuple(r) for r in ranked.search(*tables, 20).collect()), key=repr) == want


def test_search_without_rows(spark):
    docs, items = _search_tables(spark, [(1, "a b"), (2, "!?")], [(1, "a"), (2, "zzz")])
    assert [tuple(r)[:3] for r in ranked.search(docs, items).collect()] == [(1, 1, 1)]
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id = 2"), items)):
        found = ranked.search(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def _csr(vectors):
    begin = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    return begin, np.array([t for v in vectors for t in v], np.int64), np.array([x for v in vectors for x in v.values()], np.int64)


@given(st.data())
@settings(max_examples=150, deadline=None)
def test_ball_bounds_hold_and_search_is_exact(data):
    size = data.draw(st.integers(1, 12))
    value = st.sampled_from([1, 2, 7, 10**6, 999_999])
    vectors = data.draw(st.lists(st.dictionaries(st.integers(0, size - 1), value, min_size=1), max_size=60))
    weights = np.array(data.draw(st.lists(st.sampled_from([0, 1, 3000, 30_000]), min_size=size, max_size=size)), np.int64)
    queries = [sorted(q) for q in data.draw(st.lists(st.sets(st.integers(0, size - 1), min_size=1), min_size=1, max_size=4))]
    items, csr = ranked.Items(list(range(len(queries))), queries, weights), _csr(vectors)
    scores = [[sum(int(weights[t]) * v.get(t, 0) for t in q) for v in vectors] for q in queries]
    tree = ranked.BallTree(*csr, size, leaf=3)
    assert sorted(tree.order.tolist()) == list(range(len(vectors)))
    if vectors:
        bounds = tree.bounds(items)
        for node, (low, high) in enumerate(zip(tree.low, tree.high, strict=True)):
            assert all(scores[i][d] <= bounds[node, i] for i in range(len(queries)) for d in tree.order[low:high])
    best = [ranked.Best(5, 1) for _ in queries]
    ranked.search_tree(list(range(len(vectors))), *csr, items, best)
    for i, found in enumerate(best):
        want = sorted((-s, d) for d, s in enumerate(scores[i]) if s > 0)[:5]
        assert sorted((-s, d) for s, d in found.rows()) == want


def test_search_prunes_subtrees():
    # two groups without a term in common: the item's own is all that is scored
    rng = np.random.default_rng(4)
    vectors = [{int(t) + 50 * (i % 2): int(x) for t, x in zip(rng.choice(50, 8, replace=False), rng.integers(1, 10**6, 8), strict=True)} for i in range(2000)]
    items = ranked.Items([1], [list(range(50, 60))], np.full(100, 5000))
    scored = ranked.search_tree(list(range(2000)), *_csr(vectors), items, [ranked.Best(5, 1)])
    assert scored <= 1100
