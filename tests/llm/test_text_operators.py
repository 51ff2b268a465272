"""Operators that look at one text or page at a time."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tillroll.llm import licenses, main_text, quality, toxicity
from tillroll.llm.bpe import Encoder, PerfectHash, bpe, read_ranks
from tillroll.llm.labelled_pages import labelled_pages
from tillroll.llm.license_texts import TEMPLATES
from tillroll.llm.packing import WordEncoder
from tillroll.llm.queries import BYTE_RANKS, ORACLE_SQL, QUERIES, URL_RULES, held_out, word_tokenizer
from tillroll.llm.urls import judge_urls

DOCS = "doc_id long, text string, score string, ids int, url long"
ODD_TEXTS = ["", " ", "\n\n", "a", "don't WE'LL it's", "日本語テスト x", "a\x00b", "ab" * 3000, " " * 2000 + "x", "é́ ß µ ª ǅ", "<|endoftext|> z", "x\x85y\u2028z\x1cw", "😀‍👩‍👧 ok", "\r\n\t\x0b\x0c"]


@pytest.fixture(scope="module")
def tokens():
    return read_ranks(public_tokenizers.path(BYTE_RANKS))


@pytest.fixture(scope="module")
def odd(spark):
    """Every column null somewhere, empty and long texts, repeats, a clash of
    names with what operators return."""
    rows = [(i, t, None, 7, None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id at all", "s", None, 3), (90, None, None, None, None), (91, "twice", "a", 1, 1), (91, "twice", "a", 1, 1)]
    return spark.createDataFrame(rows, DOCS)


def test_perfect_hash_is_minimal_and_rejects_strangers(tokens):
    table = PerfectHash(tokens[:5000])
    assert sorted(table.values) == list(range(5000)) and len(table.slots) == 5000
    assert [table.find(t) for t in tokens[:5000]] == list(range(5000))
    assert all(table.find(t) == -1 for t in tokens[5000:9000])


def test_bpe_equals_tiktoken_and_round_trips(spark, tokens, odd):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(r.doc_id, r.text) for r in odd.collect()]
    got = bpe(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), tokens, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for r, (doc, text) in zip(got, rows, strict=True):
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.doc_id == doc and r.n_tokens == len(ids) and ids == own.encode_ordinary(text or "")
        assert bytes(r.decoded) == (text or "").encode()


def test_bpe_remembers_within_bounds(tokens, monkeypatch):
    monkeypatch.setattr("tillroll.llm.bpe.MEMORY", 3)
    own, fresh = Encoder(tokens, public_tokenizers.PATTERN), Encoder(tokens, public_tokenizers.PATTERN)
    text = "one two three four five one two seven eight one"
    for _ in range(3):
        assert own.encode(text) == b"".join(fresh._piece(p) for p in fresh.split(text))
        assert len(own.fresh) <= 3


def test_word_encoder_equals_the_library(monkeypatch):
    encoder, library = WordEncoder(word_tokenizer()), Tokenizer.from_str(word_tokenizer())
    assert encoder.short
    texts = [t for t in ODD_TEXTS] + ["Straße, ÀÉÎ. Ünï### ſ K ΑΣ İI a.b 12x $$$ 'll"]
    for memory in (400_000, 2):
        monkeypatch.setattr("tillroll.llm.packing.MEMORY", memory)
        for t in texts * 2:
            assert np.frombuffer(encoder.encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_word_encoder_looks_up_what_repeats_in_a_batch_once():
    """Words are parted at Latin letter and mark, A-Z lower-cased, before they
    are looked up; never where that could change the ids."""
    encoder, library = WordEncoder(word_tokenizer()), Tokenizer.from_str(word_tokenizer())
    repeats = ["abc Abc, abc.", "", "ABC! aBc abc!\nabc. ABC,"]
    odd = ["H\u0331 h\u0331 H\u0331, a.b -! !- x'S. 'LL, \u00d7. \u00f7, \u00ff. \u0178, \u00c3.\u00c3 K. \u03a3. A\u0308. !\u0338 $a$", " ", "\x1cA.\x85B,\u3000c!", ".", "\u00c9,"]
    odd += ["<|endoftext|>", "a.<|endoftext|>.B!", "<|ENDOFTEXT|> <|EndOfText|>", "<|endoftext|", "<|<|startoftext|>|> X|", "A<|", "endoftext|>"]
    for texts in (["", " ", ""], repeats, odd):
        encoder.forget()
        ids, stops = encoder.encode_all([t.encode() for t in texts], b"\xff" * 4)
        got = [x.tolist() for x in np.split(np.frombuffer(ids, "<u4"), stops[:-1] // 4)]
        assert got == [[*library.encode(t, add_special_tokens=False).ids, 2**32 - 1] for t in texts]
        if texts is repeats:
            assert sorted(encoder.fresh) == ["!", ",", ".", "abc"]


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, SF_SMALL)
        got = sorted((tuple(r) for r in df.collect()), key=repr)
        want = sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall(), key=repr)
        assert got == want, name


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "https://www.example.org/en/2/es/", "ftp://org", "ftp://org/", "x://notexample.org/es/",
            "http://a.com/fr/x", "http://com/de/", "http://b.com/de", "http://u:p@h.com:80/fr/", "a://b://c", "http://x.com?/fr/", "http://é.com/fr/é", "http://.org/", "http://example.org./es/"]
    df = spark.createDataFrame([(i, u, "clash", None) for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, rule string, r_digest string")
    rules = spark.createDataFrame([*URL_RULES, URL_RULES[0], (None, "/", "block")], "host string, path string, verdict string")
    for limit in (100_000, 0):  # broadcast and shuffled rules
        from tillroll.llm import urls as module

        old, module.BROADCAST_RULES = module.BROADCAST_RULES, limit
        got = {r.page_id: r for r in judge_urls(df, rules).collect()}
        module.BROADCAST_RULES = old
        assert len(got) == len(urls) + 1
        for i, u in enumerate([*urls, urls[3]]):
            rest = u.split("://", 1)[1] if u and "://" in u else ""
            host = "".join(c.lower() if c.isascii() else c for c in re.split("[/?#]", rest)[0])
            path = re.split("[?#]", rest[len(host) :])[0]
            fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
            rule, verdict = (max(fits)[3], max(fits)[4]) if fits else (None, "allow")
            assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert {r.verdict for r in judge_urls(df, rules.limit(0)).collect()} == {"allow"}
    assert judge_urls(df.limit(0), rules).count() == 0


def test_license_scan_equals_all_comparisons(spark, odd):
    texts = [t for _, t in TEMPLATES] + ["Released under the  MIT  licence!", "x\n\nReleased under the MIT License.\nReleased under the MIT license", "x\n" + TEMPLATES[5][1].replace(" and ", "\nand "), "nothing here at all"]
    texts += [None, "", "one"]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, dice double")
    got = {(r.doc_id, r.license): (r.dice, r.n_lines) for r in licenses.scan(df, TEMPLATES).collect()}

    def pairs(t):
        w = re.findall("[a-z0-9]+", t.lower())
        return Counter(zip(w, w[1:], strict=False))

    want: dict = {}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        for kind, units in (("line", lines), ("wide", [*(t or "").split("\n\n"), t or ""])):
            for u in units:
                best: dict = {}
                for name, text in TEMPLATES:
                    a, b = pairs(u), pairs(text)
                    dice = 2 * (a & b).total() / (a.total() + b.total()) if a else 0
                    if dice >= 0.8:
                        best[name] = max(dice, best.get(name, 0))
                for name, dice in best.items():
                    known = want.get((i, name), (0, 0))
                    want[i, name] = (max(dice, known[0]), known[1] + (kind == "line"))
    assert got == want
    assert licenses.scan(odd, TEMPLATES).count() == 0


def test_license_scan_finds_notices_inside_longer_units(spark):
    mit, bsd = TEMPLATES[5][1], TEMPLATES[6][1]
    prose = "The tool was written in one summer by two people who needed it for their own work and it is Released under the MIT License. so that all may use it as they like and change what they want"
    rest = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the work. The work is provided as is, without warranty of any kind, and in no event shall its authors be liable for any claim, damages or other liability that may come from it or its use by anyone."
    wrap = lambda text, lead: "\n".join(lead + " ".join(w) for w in itertools.batched(text.split(), 9))
    comment = lambda text, lead: f"{lead}\n{wrap('Copyright 2020 Some One', lead)}\n{lead}\n{wrap(text, lead)}\n{lead}\n{wrap(rest, lead)}\n"
    crlf = "\r\n\r\n".join(["First words of a file of several parts. " * 9, wrap(bsd, "").replace("\n", "\r\n"), rest])
    spread = " ".join(w + " inserted" * (i % 9 == 4) for i, w in enumerate(mit.split()))  # longer than its template
    texts = [prose, comment(mit, " * "), comment(bsd, "# "), crlf, f"{rest} {spread} {rest}", rest, "the license under the license under the mit and the mit under a license"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.license): (r.dice, r.n_lines) for r in licenses.scan(df, TEMPLATES).collect()}

    def pairs(t):
        w = re.findall("[a-z0-9]+", t.lower())
        return list(zip(w, w[1:], strict=False))

    want: dict = {}
    for i, t in enumerate(texts):
        own = pairs(t)
        for name, text in TEMPLATES:
            template = Counter(pairs(text))
            for a in range(len(own)):
                run, shared = Counter(), 0
                for b in range(a, len(own)):
                    run[own[b]] += 1
                    shared += run[own[b]] <= template[own[b]]
                    dice = 2 * shared / (b - a + 1 + template.total())
                    if dice >= 0.8 and b - a + 1 >= template.total():
                        want[i, name] = (max(dice, want.get((i, name), (0, 0))[0]), 0)
    assert got == want
    assert {k for k, v in got.items() if v[0] == 1} == {(0, "MIT"), (1, "MIT"), (2, "BSD-3-Clause"), (3, "BSD-3-Clause")} and (4, "MIT") in got


def test_main_text_of_odd_pages_and_held_out_labels():
    model = main_text.train(labelled_pages())
    right = total = 0
    for page in labelled_pages(150, seed=99):
        nodes = main_text.parse(page)
        label = [0] * len(nodes)
        for i, n in enumerate(nodes):
            label[i] = int(n.attrs.pop(main_text.MARK, label[n.parent] if n.parent >= 0 else 0))
        for n, a, p in zip(nodes, label, model.marginals(nodes), strict=True):
            if n.tag not in ("title", "style", "button") and any(isinstance(x, str) and x.strip() for x in n.items):
                right, total = right + ((p > 0.5) == a), total + 1
    assert right / total > 0.97
    page = (
        "<!DOCTYPE html><html><head><title>t</title><script>var x='<p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        "<!-- c --><div class='ad'>Buy now, it is cheap.</div><article><h1>A  title &amp; more</h1><p>First <b>bold</b>\n text &#233;.<p>Second &am x<br>"
        "</p><aside><p>See also this other page of ours.</p></aside></article><footer>&copy; me</footer>"
    )
    assert main_text.main_text(page, model) == "A title & more\nFirst bold text é.\nSecond &am x"
    for odd in (None, "", "<", "<p", "<a href='", "<!-- x", "</p></div>", "<div>" * 3000 + "x", "<script>", "<b" * 500):
        assert isinstance(main_text.main_text(odd, model), str)


def test_stray_quotes_in_tags_lose_no_text():
    model = main_text.train(labelled_pages(200))
    for tag in ("<p title=it's>", '<p class="a"">', "<p title = it's class='b''>", '<p title="open>', "<p ' title='x>y' \" lang=\"e>n\">", "<p title=a=\"b>"):
        page = f"<article>{tag}First words of the page.</p><p>More words here.</p></article>"
        assert main_text.main_text(page, model) == "First words of the page.\nMore words here.", tag
    page = "<article><p title=it's>First words.</p><p>More words here.</p></article>"
    assert main_text.main_text(page, model) == "First words.\nMore words here."
    (node,) = [n for n in main_text.parse("<p class='a>b' id = \"c\"\" title=it's hidden lang=en/>") if n.tag == "p"]
    assert [node.attrs[k] for k in ("class", "id", "title", "hidden", "lang")] == ["a>b", "c", "it's", "", "en/"]


def test_self_closed_icons_lose_no_text():
    model = main_text.train(labelled_pages(200))
    article = "<article><p>First words of the page.</p><p>More words here.</p></article>"
    for icon in ('<svg class="icon"/>', "<svg/>", "<math />"):
        for later in ("", "<footer><svg><text>x</text></svg><math><mi>y</mi></math></footer>"):
            page = f"<header>{icon}</header>{article}{later}"
            assert main_text.main_text(page, model) == "First words of the page.\nMore words here.", page


def test_messages_equal_enumeration():
    """Marginals against the sum over all labellings of a small tree."""
    import itertools
    import math

    model = main_text.train(labelled_pages(60))
    nodes = main_text.parse("<body><nav><a href=x>home</a></nav><article><h1>Title</h1><p>Some text of the page</p></article>")
    own = [[sum(model.traits.get(t, (0.0,) * 3)[y] for t in ts) for y in range(3)] for ts in main_text._evidence(nodes)]
    own[0] = [x + r for x, r in zip(own[0], model.root, strict=True)]
    weight = [0.0] * len(nodes)
    total = 0.0
    for labels in itertools.product(range(3), repeat=len(nodes)):
        x = sum(o[y] for o, y in zip(own, labels, strict=True))
        x += sum(model.edges.get(n.tag, model.any_edge)[labels[n.parent]][y] for n, y in zip(nodes[1:], labels[1:], strict=True))
        p = math.exp(x)
        total += p
        weight = [w + p * (y == main_text.CONTENT) for w, y in zip(weight, labels, strict=True)]
    assert model.marginals(nodes) == pytest.approx([w / total for w in weight])


def test_extract_rows(spark):
    model = main_text.train(labelled_pages(200))
    df = spark.createDataFrame([(1, None, None, "x"), (2, "u", "", None), (3, "u", "<article><p>Some longer text of the page.</p></article>", "t"), (3, "u", "<p>", None)], "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in main_text.extract(df, model).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (3, "u", "Some longer text of the page.", 29), (3, "u", "", 0)], key=repr)
    assert main_text.extract(df.limit(0), model).count() == 0


def _base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(w, w[1:], w[2:], strict=False))
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_counts_and_verdicts(spark, odd):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    forest = quality.fit(docs, labels)
    for df in (docs, odd):
        texts = sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
        got = sorted(quality.judge(df, forest).collect(), key=lambda r: repr((r.doc_id,)))
        assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got if r.doc_id is not None) == sorted((d, *_base(t)) for d, t in texts if d is not None)
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and r.depth >= forest.least)
    verdict = {r.doc_id: r.kept for r in quality.judge(docs, forest).collect()}
    marked = [(r.quality, verdict[r.doc_id]) for r in labels.collect()]
    assert not any(k for q, k in marked if q == 0) and np.mean([k for q, k in marked if q == 1]) > 0.85
    assert quality.fit(docs, labels.limit(0)) is None
    assert all(r.depth is None and r.kept != r.base_failed for r in quality.judge(odd, None).collect())
    assert quality.judge(odd.limit(0), forest).count() == 0


def test_repeat_words_of_long_texts():
    words = [f"w{i}".encode() for i in range(1_100_000)]  # more kinds than a product of three can hold
    assert quality._repeat_words([*words, *words[:3]]) == 6


def test_isolation_depths_are_path_lengths():
    x = np.random.default_rng(0).normal(size=(400, 3))
    forest = quality.grow(x, trees=20, sample=64)

    def walk(t, row):
        node = 0
        while forest.feature[t, node] >= 0:
            node = forest.child[t, node] + (row[forest.feature[t, node]] >= forest.split[t, node])
        return forest.depth[t, node]

    rows = np.vstack([x[:20], [[9, 9, 9]]])
    depths = forest.depths(rows)
    assert depths == pytest.approx([np.mean([walk(t, r) for t in range(20)]) for r in rows])
    assert depths[-1] < depths[:-1].min()


def _all_maximal(value):
    """Ruzzo and Tompa by definition: the best span, then left and right."""

    def inner(lo, hi):
        best = None
        for a in range(lo, hi):
            s = 0.0
            for b in range(a, hi):
                s += value[b]
                if s > 1e-12 and (best is None or s > best[0] + 1e-9):
                    best = (s, a, b)
        if best is None:
            return []
        s, a, b = best
        return [*inner(lo, a), (a, b, s), *inner(b + 1, hi)]

    return inner(0, len(value))


def test_segments_equal_their_definition():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(1, 30))
        weights = [float(w) for w in np.where(rng.random(n) < 0.3, rng.uniform(0.1, 2, n), rng.uniform(-1.5, 0, n))]
        got, want = toxicity.maximal_segments(weights), _all_maximal(weights)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_toxicity_on_held_out_labels(spark, odd):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in got.items())
    marked = [(r.toxic, got[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    hits = sum(t and p for t, p in marked)
    # 14 of 18; the other four hold no word that a learnt toxic text has
    assert hits >= 0.75 * sum(t for t, _ in marked) and hits >= 0.9 * sum(p for _, p in marked)
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~held_out()))
    kept = toxicity.keep_clean(docs, model)
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.predicted} and kept.schema == docs.schema
    scored = toxicity.score(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r.score < 0.7 and r.passages == [] for r in scored)
    assert toxicity.keep_clean(odd, model).count() == odd.count() and toxicity.score(odd.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.where("toxic = 0")):
        empty = toxicity.fit(docs, none)
        assert empty == toxicity.Model() and toxicity.score(docs, empty).where("score <> 0").count() == 0


def test_every_token_has_a_weight_and_sure_ones_more():
    clean, bad = np.array([40.0, 1, 0, 0, 30, 500]), np.array([0.0, 0, 1, 20, 30, 50])
    weights, rate = toxicity._weights(clean, bad)
    weights = weights + toxicity.DRIFT
    assert weights[0] < weights[1] < 0 < weights[2] < 0.5 < weights[3] and (weights != 0).all()
    shares = (clean + 0.5) / (clean + 0.5).sum()
    assert rate > 0 and np.dot(shares, weights - toxicity.DRIFT) < 0  # a clean text's sum falls


def test_digests_of_queries(spark):
    ids = QUERIES["op8_byte_bpe"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(ids) == len(texts) and all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in ids)


# -- pages of any layout, written by hand -----------------------------------------

_STORY = [
    "The ferry left the harbour at dawn, and for an hour nothing could be seen but fog over the grey water.",
    "By noon the crew had counted eleven whales, more than in any week since the survey began nine years ago.",
    "Dr Ines Alvor, who leads the work, says that the animals follow the herring north as the sea grows warmer.",
    "A second voyage is planned for the autumn; the council has paid for the fuel, and the town for the rest.",
]
_P = "".join(f"<p>{s}</p>" for s in _STORY)
_BR = "<br><br>\n".join(_STORY)

# (page, what it says beside the story)
HAND_PAGES = [
    (f"<html><body><h1>Eleven whales</h1>{_P}</body></html>", ["Eleven whales"]),
    (f"<body><nav><a href='/'>Home</a> <a href='/n'>News</a></nav><h1>Eleven whales</h1>{_P}<footer>All rights reserved, the paper.</footer>", ["Eleven whales"]),
    (_P, []),
    (f'<div class="wrapper"><div class="container">{_P}</div></div>', []),
    (f"<html><body>{_BR}</body></html>", []),
    (f"<center><font face='serif'>{_BR}</font></center>", []),
    (f"<table><tr><td><a href='1'>Front page</a><br><a href='2'>Sport</a><br><a href='3'>Weather</a></td><td>{_P}</td></tr></table>", []),
    (f"<body><form action='/' method='post'><div><article>{_P}</article></div><input type='submit' value='go'></form></body>", []),
    (f"<article><!-->{_P}<!---></article>", []),
    (f"<article>{_P}<p>The ratio <math><mi>n</mi><mo>=</mo><mn>11</mn></math> was a record for the bay.</p></article>", ["The ratio n=11 was a record for the bay."]),
    (f"<div id='menu'><ul><li><a href='/a'>Arts</a></li><li><a href='/b'>Books</a></li></ul></div><div id='body-text'>{_P}</div><div id='footer'><p>Printed in Porto by the harbour press.</p></div>", []),
    (f"<body><form class='search'><label>Search the archive</label><input name='q'></form><h2>Eleven whales</h2>{_P}</body>", ["Eleven whales"]),
    (f"<div class='cookie-banner'><p>We use cookies to keep you signed in.</p><button>Fine</button></div><main><h1>Eleven whales</h1>{_P}</main><div class='comments'><h3>Replies</h3><p>I saw them too, from the pier!</p></div>", ["Eleven whales"]),
    (f"<div class='row'><div class='col'>{_P}</div><div class='sidebar'><h3>Most read</h3><ul><li><a href='/1'>Storm warning</a></li><li><a href='/2'>New bridge</a></li></ul></div></div>", []),
    (f"<section><h2>Eleven whales</h2>{_P}<blockquote><p>We had never seen so many at once, said the mate.</p></blockquote></section>", ["Eleven whales", "We had never seen so many at once, said the mate."]),
    (f"<body><div class='ad'><p>Buy two nets, get a third one free this week only.</p></div>{_P}<div class='share'><a href='#'>Mail</a> <a href='#'>Print</a></div></body>", []),
    (f"<body bgcolor='white'><hr>{_STORY[0]}<hr>{_STORY[1]}<hr>{_STORY[2]}<hr>{_STORY[3]}</body>", []),
    (f"<div><div><div><div><div>{_P}</div></div></div></div></div></b></i></span>", []),
]


def test_main_text_of_pages_of_any_layout():
    model = main_text.train(labelled_pages())
    held = extra = wanted = 0
    for page, more in HAND_PAGES:
        got = main_text.main_text(page, model)
        assert all(s in got for s in _STORY), page
        want, have = Counter(" ".join([*_STORY, *more]).split()), Counter(got.split())
        held, extra, wanted = held + (want & have).total(), extra + (have - want).total(), wanted + want.total()
    assert held / wanted >= 0.98 and held / (held + extra) >= 0.98, (held, extra, wanted)


def test_stray_end_tags_and_empty_comments_cost_nothing():
    model = main_text.train(labelled_pages(200))
    began = time.perf_counter()
    page = "<div>" * 20_000 + "</b>" * 20_000 + f"<article>{_P}</article>"
    main_text.main_text(page, model)
    assert time.perf_counter() - began < 20  # quadratic work took minutes
    assert main_text.main_text(f"<article><!--->{_P}<!-- gone > --></article>", model).split("\n") == _STORY


def test_forest_on_held_out_labels(spark):
    """Depths of rows that neither grew the trees nor set the threshold."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learnt, held = labels.where("doc_id % 5 < 3"), {r.doc_id: r.quality for r in labels.where("doc_id % 5 >= 3").collect()}
    rated = [(held[r.doc_id], r.kept, r.depth) for r in quality.judge(docs, quality.fit(docs, learnt)).where("not base_failed").collect() if r.doc_id in held]
    good, bad = ([(k, d) for q, k, d in rated if q == v] for v in (1, 0))
    assert np.mean([not k for k, _ in good]) <= 0.01 and np.mean([k for k, _ in bad]) <= 0.03
    assert len({d for _, d in good}) > 0.9 * len(good)  # the forest tells good rows apart too


def test_weights_of_no_account_are_not_stored():
    words, weights = np.array([b"a", b"b", b"c"], object), np.array([0.5, -0.004, -0.3]) - toxicity.DRIFT
    model = toxicity.Model(*toxicity._stored(words, weights))
    assert model.weights == {b"a": np.float32(0.4), b"c": np.float32(-0.4)}
    assert toxicity.Model().weights == {} and toxicity.Model().passages([b"a", b"b"]) == []
