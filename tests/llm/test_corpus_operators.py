"""Operators over the whole corpus, against brute force on small tables."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tillroll.llm import exact, golomb, packing, simhash, suffix, toxicity
from tillroll.llm.anchors import find_runs
from tillroll.llm.common import WHITE
from tillroll.llm.components import components
from tillroll.llm.lyndon import suffix_arrays
from tillroll.llm.queries import QUERIES, held_out, word_tokenizer

#: Columns that clash with names the operators use inside or return.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp int, gone_id long, __id long, length double, no_text boolean"


def _table(spark, pairs):
    rows = [(d, t, None, "hot" if i % 3 else None, None if t is None else len(t), "x", None, d, 1, None, True) for i, (d, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, CLASH)


def _documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


# -- exact dedup ---------------------------------------------------------------


def _normal(text):
    return (text or "").encode().translate(None, WHITE)


def _exact(pairs):
    groups = defaultdict(list)
    for d, t in pairs:
        groups[_normal(t)].append((-len(t or ""), d is None, d))
    return [(d, min(groups[_normal(t)])[2], len(groups[_normal(t)]), hashlib.sha256(_normal(t)).digest()) for d, t in pairs]


def test_golomb_round_trip():
    rng = np.random.default_rng(0)
    for n, top in itertools.product((0, 1, 2, 7, 1000), (1, 5, 1000, 2**48, 2**64 - 1)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        assert (golomb.decode(golomb.encode(values)) == values).all()


EXACT_CASES = [(1, "a b"), (2, "ab "), (3, "a\tb\n"), (4, None), (5, ""), (6, " \x0b"), (7, "a b"), (None, "ab"), (None, "zz"), (8, "zz"), (9, "q" * 100_000), (10, "q" * 100_000 + " "), (11, "rep"), (11, "rep"), (12, "é"), (13, "é"), (None, "only"), (None, "only")]


def test_exact_groups_equal_brute_force(spark):
    hot = [(100 + i, "the hot text") for i in range(300)]
    pairs = EXACT_CASES + hot + _documents(spark)
    for bits, chunk in ((48, 1 << 16), (10, 50)):  # few bits: many false suspects
        got = exact.exact_groups(_table(spark, pairs).repartition(5), bits, chunk).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in got), key=repr) == sorted(_exact(pairs), key=repr)
        longest = {}
        for _, t in pairs:
            longest[_normal(t)] = max(longest.get(_normal(t), 0), len(t or ""))
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id is not None)
    assert exact.exact_groups(_table(spark, pairs).limit(0)).count() == 0


def test_drop_copies_keeps_one_row_of_each_text(spark):
    df = _table(spark, EXACT_CASES)
    left = exact.drop_copies(df)
    assert left.schema == df.schema
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    want = sorted([(3, "a\tb\n"), (6, " \x0b"), (7, "a b"), (None, "ab"), (None, "zz"), (8, "zz"), (10, "q" * 100_000 + " "), (11, "rep"), (12, "é"), (13, "é"), (None, "only"), (None, "only")], key=repr)
    assert got == want
    assert exact.drop_copies(df.limit(0)).count() == 0


def test_drop_copies_keeps_a_text_whose_doc_id_repeats(spark):
    pairs = [(5, "a b"), (5, "a  b"), (5, "ab"), (7, "ab"), (None, "ab"), (6, "alone"), (6, "al one"), (6, "other"), (8, "c d"), (9, "c  d"), (9, "cd"), (10, None), (10, " "), (11, "rep"), (11, "rep")]
    df = _table(spark, pairs).repartition(3)
    left = exact.drop_copies(df)
    assert left.schema == df.schema
    # copies without a doc_id are never told apart
    want = [(5, "a  b"), (None, "ab"), (6, "al one"), (6, "other"), (9, "c  d"), (10, " "), (11, "rep")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)


# -- SimHash -------------------------------------------------------------------


def _fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _reachable(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_links_equal_all_pairs(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(150)] + [0, 2**64 - 1, 2**63]
    fps = set(seeds)
    for s in seeds:
        for flips in (1, 2, 3, 4, 5):
            fps.add(s ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long").cache()
    for bits in (0, 1, 2, 3, 4, 5):
        got = {frozenset(x & (2**64 - 1) for x in r) for r in simhash.links(df, bits).collect()}
        assert got == {frozenset(p) for p in itertools.combinations(fps, 2) if (p[0] ^ p[1]).bit_count() <= bits}, bits


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(-5, 1030), (2000, 2000)] + [(3000, 3001 + i) for i in range(80)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = _reachable({x for e in edges if e[0] != e[1] for x in e}, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_equal_brute_force(spark):
    text = " ".join(f"word{i % 97}x{i % 13}" for i in range(400))
    near = [(500 + i, text.replace(f"word{i}x{i % 13} ", "CHANGED ", 1)) for i in range(12)]
    odd = [(400, None), (401, ""), (402, " \n"), (403, "One"), (404, "one"), (405, "one two"), (406, "k " * 50_000), (None, "one two"), (407, "twice x"), (407, "other y")]
    pairs = odd + near + _documents(spark)
    fp = {t: _fingerprint(t) for _, t in pairs}
    kinds = set(fp.values())
    groups = _reachable(kinds, [p for p in itertools.combinations(kinds, 2) if (p[0] ^ p[1]).bit_count() <= 3])
    smallest = {}
    for d, t in pairs:
        if d is not None:
            smallest[groups[fp[t]]] = min(d, smallest.get(groups[fp[t]], d))
    df = _table(spark, pairs)
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted(((d, fp[t], smallest.get(groups[fp[t]])) for d, t in pairs), key=repr)
    kept = simhash.keep_first(df)
    assert kept.schema == df.schema
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((d, t) for d, t in pairs if d is None or smallest[groups[fp[t]]] == d), key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_first(df.limit(0)).count() == 0


def test_keep_first_goes_by_text_where_a_doc_id_repeats(spark):
    text = " ".join(f"word{i % 97}x{i % 13}" for i in range(400))
    near, other = text.replace("word9x9 ", "CHANGED ", 1), " ".join(f"other{i}" for i in range(50))
    assert (_fingerprint(text) ^ _fingerprint(near)).bit_count() <= 3
    pairs = [(1, text), (5, near), (5, other), (5, near), (6, near), (7, other), (8, ""), (None, near)]
    df = _table(spark, pairs).repartition(3)
    left = simhash.keep_first(df)
    assert left.schema == df.schema
    want = [(1, text), (5, other), (8, ""), (None, near)]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)


# -- suffix arrays -------------------------------------------------------------


def test_suffix_arrays_equal_sorting():
    rng = np.random.default_rng(0)
    cases = [[b"graindraining", b"", b"a", b"aaaa", b"banana", b"abababab", b"mississippi"]]
    cases += [[bytes(rng.integers(97, 97 + k, rng.integers(0, n)).astype(np.uint8)) for _ in range(30)] for k in (1, 2, 3, 26) for n in (5, 40, 120)]
    for lanes in cases:
        parts = [np.append(np.frombuffer(x, np.uint8).astype(np.int64) + 1, 0) for x in lanes]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        got = suffix_arrays(np.concatenate(parts), bounds)
        for p, a, b in zip(parts, bounds, bounds[1:], strict=False):
            p = p.tolist()
            assert (got[a:b] - a).tolist() == sorted(range(len(p)), key=lambda i: p[i:])


def test_runs_cover_every_window_and_agree(monkeypatch):
    rng = random.Random(1)
    shared = bytes(rng.randrange(256) for _ in range(400))
    texts = [b"x" * 49, b"", shared[:50], bytes(rng.randrange(97, 99) for _ in range(5000)) + shared + b"tail", b"lead" + shared, b"a" * 300]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    whole = data.tobytes()
    seen = {}
    for block in (1 << 18, 600):
        monkeypatch.setattr("tillroll.llm.anchors._BLOCK", block)
        runs = find_runs(data, offsets)
        starts = [s + i for s, n in zip(runs.start.tolist(), runs.windows.tolist(), strict=True) for i in range(n)]
        assert sorted(starts) == [s for a, b in zip(offsets, offsets[1:], strict=False) for s in range(a, b - 49)]
        for anchor, s, n, place in zip(runs.anchor.tolist(), runs.start.tolist(), runs.windows.tolist(), runs.place.tolist(), strict=True):
            for i in range(n):  # equal windows: equal anchors at equal places
                assert seen.setdefault(whole[s + i : s + i + 50], (anchor, place - i)) == (anchor, place - i)


def _without(pairs):
    first = {}
    for d, t in sorted(((d, t) for d, t in pairs if d is not None), key=lambda x: x[0]):
        raw = (t or "").encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], d)
    out = []
    for d, t in pairs:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        if d is not None:
            for i in range(len(raw) - 49):
                if first[raw[i : i + 50]] < d:
                    gone[i : i + 50] = b"\x01" * 50
        spans = len(bytes(gone).replace(b"\x00", b" ").split())
        out.append((d, len(raw), sum(gone), spans, bytes(c for c, g in zip(raw, gone, strict=True) if not g)))
    return out


def _passages():
    rng = random.Random(1)
    known = ["".join(rng.choice("ab") for _ in range(rng.randint(30, 200))) for _ in range(30)]
    fresh = lambda: "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 80)))
    pairs = [(rng.randint(0, 400) if i % 20 == 0 else i, "".join(rng.choice(known) if rng.random() < 0.6 else fresh() for _ in range(rng.randint(0, 6)))) for i in range(200)]
    pairs += [(1000 + i, "a" * rng.randint(0, 300)) for i in range(40)]
    hot = "".join(rng.choice("abcdefghijklmnop ") for _ in range(120))
    pairs += [(1100 + i, fresh() + hot + fresh()) for i in range(120)]  # one passage, every edge another
    return pairs + [(2000, ""), (2001, "x" * 49), (2002, "x" * 50), (2003, "x" * 50), (2004, None), (None, "x" * 50), (None, None), (2005, "é" * 30), (2006, "è" + "é" * 29), (2007, "b" + "é" * 30)]


def _own_contexts(pairs):
    """All runs of the texts as one group's contexts, one for each run."""
    raw = [(t or "").encode() for _, t in pairs]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    runs = find_runs(data, offsets)
    whole = data.tobytes()
    ids = np.array([d for d, _ in pairs], np.int64)[runs.row]
    texts, body = [], b""
    for anchor, s, n, place in zip(runs.anchor.tolist(), runs.start.tolist(), runs.windows.tolist(), runs.place.tolist(), strict=True):
        texts.append(whole[s : s + n + 49])
        body += (anchor << 16 | place << 8 | n).to_bytes(8, "little") + texts[-1]
    return ids, texts, suffix._pack(runs.windows.astype("u1"), ids, body)


@pytest.mark.parametrize("setting", [{}, {"TOGETHER": 1}, {"TOGETHER": 3, "_LANE_BYTES": 64}, {"_SORTED_BYTES": 2000}, {"TOGETHER": 10_000}])
def test_answers_are_the_smallest_ids_of_equal_windows(monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(suffix, name, value)
    ids, texts, blob = _own_contexts([p for p in _passages() if p[0] is not None])
    first: dict[bytes, int] = {}
    for d, t in zip(ids.tolist(), texts, strict=True):
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(d, first.get(t[i : i + 50], d))
    (answer,) = suffix._answers([blob])
    counts, lengths, values = suffix._unpack(answer, "u1", "u1", "<i8")
    along = iter([v for n, v in zip(lengths.tolist(), values.tolist(), strict=True) for _ in range(n)])
    assert len(counts) == len(texts)
    for t in texts:
        assert [next(along) for _ in range(len(t) - 49)] == [first[t[i : i + 50]] for i in range(len(t) - 49)]


def test_frequent_anchors_are_parted_consistently():
    """Parts cover the runs' windows once, and equal windows of different
    texts get equal new anchors at equal places."""
    pairs = [p for p in _passages() if p[0] is not None]
    raw = [(t or "").encode() for _, t in pairs]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    runs, whole = find_runs(data, offsets), b"".join(raw)
    anchor, row, start, windows, place = suffix._parted(data, runs.anchor, runs.row, runs.start, runs.windows, runs.place)
    assert sorted(w for s, n in zip(start.tolist(), windows.tolist(), strict=True) for w in range(s, s + n)) == sorted(w for s, n in zip(runs.start.tolist(), runs.windows.tolist(), strict=True) for w in range(s, s + n))
    seen = {}
    for a, s, n, p in zip(anchor.tolist(), start.tolist(), windows.tolist(), place.tolist(), strict=True):
        assert 1 <= n <= suffix.PART and 0 <= p <= 26
        for i in range(n):
            assert seen.setdefault(whole[s + i : s + i + 50], (a, p - i)) == (a, p - i)


def test_slices_hold_every_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["abc", None, "x" * 40, "", "abcdefgh", "z"])], names=["doc_id", "text"])
    slices = list(suffix._slices(batch))
    assert sum((x.to_pylist() for x in slices), []) == batch.to_pylist() and len(slices) > 2


@pytest.mark.parametrize(("size", "slices"), [(suffix.GROUP_BYTES, 3), (3000, 3), (9000, 200)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, size, slices):
    """200 slices make the passages of 120 texts frequent."""
    monkeypatch.setattr(suffix, "GROUP_BYTES", size)
    pairs = _passages()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.remove_repeats(_table(spark, pairs).repartition(slices)).collect()]
    assert sorted(got, key=repr) == sorted(_without(pairs), key=repr)


def test_removed_bytes_of_documents(spark):
    pairs = _documents(spark)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_suffix_dedup"](spark, SF_SMALL).collect()]
    want = [(d, n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in _without(pairs)]
    assert sorted(got) == sorted(want) and sum(x[2] for x in got) > 0


def test_without_repeats_keeps_rows_and_columns(spark):
    pairs = _passages()
    df = _table(spark, pairs)
    got = suffix.without_repeats(df)
    assert got.schema == df.schema
    want = [(d, None if t is None else k.decode(errors="ignore")) for (d, t), (_, _, _, _, k) in zip(pairs, _without(pairs), strict=True)]
    rows = got.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    assert Counter((r.source, r.gone_id) for r in rows) == Counter((r.source, r.gone_id) for r in df.collect())
    assert suffix.without_repeats(df.limit(0)).count() == 0 and suffix.remove_repeats(df.limit(0)).count() == 0


# -- packing -------------------------------------------------------------------


def _spread(slots, histogram, capacity):
    """The lengths in each sequence of a plan, placed one by one."""
    bins = defaultdict(list)
    for length, n in histogram.items():
        own = [s for s in slots if s[0] == length]
        for r in range(n):
            _, first, copies, sequence, offset = [s for s in own if s[1] <= r][-1]
            bins[sequence + (r - first) // copies].append((offset + (r - first) % copies * length, length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


def _fewest(lengths, capacity):
    """Bin packing by search."""
    lengths = sorted(lengths, reverse=True)
    for k in range(-(-sum(lengths) // capacity), len(lengths) + 1):

        def fits(i, rooms):
            if i == len(lengths):
                return True
            return any(fits(i + 1, (*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :])) for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values())

        if fits(0, (capacity,) * k):
            return k
    return 0


def test_plans_are_tight_and_gapless():
    rng = random.Random(4)
    extra = 0
    for _ in range(120):
        capacity = rng.choice([10, 20, 37])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 11))]
        slots, n = packing.plan(Counter(lengths), capacity)
        bins = _spread(slots, Counter(lengths), capacity)
        assert len(bins) == n and sorted(x for b in bins.values() for _, x in b) == sorted(lengths)
        extra += n - _fewest(lengths, capacity)
    assert extra <= 3  # of some 400 sequences


def test_reduction_never_costs_a_sequence():
    """Fixing the dominating sets leaves an instance whose optimum, with the
    fixed ones, is the whole optimum."""
    rng = random.Random(9)
    for _ in range(150):
        capacity = rng.choice([10, 16, 23])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
        count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        fixed = packing._reduce(count, capacity)
        rest = [x for x in range(capacity + 1) for _ in range(int(count[x]))]
        assert sum(t for _, t in fixed) + _fewest(rest, capacity) == _fewest(lengths, capacity)


def test_packed_documents(spark):
    tokenizer = Tokenizer.from_str(word_tokenizer())
    pairs = [(900, None), (901, ""), (902, "w " * 2047), (903, "w " * 2048), (904, "x " * 9000), (None, "no id"), (905, "same"), (905, "same")]
    pairs += [(1000 + i, "one two three") for i in range(700)] + _documents(spark)
    got = packing.pack_documents(_table(spark, pairs).repartition(4), word_tokenizer()).collect()
    want = []
    for d, t in pairs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r.length for r in got) // 2048) + 2
    assert packing.pack_documents(_table(spark, pairs).limit(0), word_tokenizer()).count() == 0


# -- pipeline ------------------------------------------------------------------


def _brute_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()))
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    pairs = [(d, t) for d, t in pairs if model.score(model.evidence(model.passages(toxicity.tokens(t)))) < toxicity.THRESHOLD]
    pairs = [(d, t) for (d, t), (_, keep, _, _) in zip(pairs, _exact(pairs), strict=True) if d == keep]
    fp = {d: _fingerprint(t) for d, t in pairs}
    groups = _reachable(set(fp.values()), [p for p in itertools.combinations(set(fp.values()), 2) if (p[0] ^ p[1]).bit_count() <= 3])
    first = {}
    for d in sorted(fp):
        first.setdefault(groups[fp[d]], d)
    pairs = [(d, t) for d, t in pairs if first[groups[fp[d]]] == d]
    return [(d, k.decode(errors="ignore")) for d, _, _, _, k in _without(pairs)]


def test_pipeline_equals_brute_force(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    tokenizer = Tokenizer.from_str(word_tokenizer())
    want = []
    for d, t in _brute_pipeline(spark, SF_SMALL):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)


def test_stages_pass_odd_rows_and_empty_tables_on(spark):
    docs = _table(spark, [*EXACT_CASES, (50, "x " * 3000), (51, None), (None, None)])
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out, none = stage(spark, docs, SF_SMALL), stage(spark, empty, SF_SMALL)
        if name != "best_fit_packing":
            assert out.schema == docs.schema == none.schema, name
        assert none.count() == 0 and out.count() > 0
        assert out.where(F.col("doc_id").isNull()).count() > 0, name
