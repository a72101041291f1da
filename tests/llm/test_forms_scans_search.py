"""Fill-in-middle, license scans and ranked search against brute force on small tables."""

import collections
import hashlib
import math
import random
import re

import pytest
from check_oracles import compare, connect
from conftest import SF
from pyspark.sql import functions as F

from lamina.llm import fim, lexical, licenses, queries

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GPL = "This work is licensed under the GNU General Public License, version 3."
ODD = [
    None, "", " ", "one", "<P>", "a <S> b", "<M", "<P", "P>", "x" * 5000, "é🎉" * 3000, "ΣΑΣ K İ ſ ½ GNU General public LICENSE", GPL, GPL + " " + GPL, "cc by", "cc-BY 4.0", "mit licenses mit License",
    "w " * 50 + GPL + " w" * 200 + " MIT\nlicense", "licensed under cc by nc 4 0", "apache apache license", "Permission hereby granted free of charge to any person obtaining a copy of this software and associated files documentation is",
    "word " * 30000 + "apache license", "one",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "mine", 7) for i, t in enumerate(ODD)] + [(0, None, "mine", 7), (None, "no id", "mine", 7), (None, GPL, "mine", 7), (12, GPL, "mine", 7), (12, "another cc by", "mine", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, labels string, form int")


def key(r):
    return tuple((v is None, v) for v in r)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fim(doc_id, text):
    text = text or ""
    n = len(text)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    a, b = min(h[0] % (n + 1), h[1] % (n + 1)), max(h[0] % (n + 1), h[1] % (n + 1))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    return doc_id, n, form, a, b - a, f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}", text


@pytest.mark.parametrize("chunk", [1, 3, 2048])
def test_fill_in_middle(odd, monkeypatch, chunk):
    monkeypatch.setattr(fim, "CHUNK", chunk)
    rows = odd if chunk > 1 else odd.where("coalesce(char_length(text), 0) < 200")
    want = sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in (plain_fim(r.doc_id, r.text) for r in rows.collect())), key=key)
    assert sorted((tuple(r) for r in fim.transform(rows).collect()), key=key) == want
    assert fim.transform(rows).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    texts = sorted((tuple(r) for r in fim.texts(rows).collect()), key=key)
    assert texts == sorted(((w[0], w[2], w[5]) for w in (plain_fim(r.doc_id, r.text) for r in rows.collect())), key=key)
    assert fim.transform(rows.where("false")).count() == 0


def test_sections_are_found_whatever_the_pieces():
    rng = random.Random(3)
    for _ in range(500):
        p, m, s = ("".join(rng.choice("<PSM>a") for _ in range(rng.randrange(6))) for _ in range(3))
        if any(x in p + m + s for x in fim.SENTINELS):
            continue
        for form, output in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
            reader, got = fim.Reader(form), {0: "", 1: "", 2: ""}
            while output:
                n = rng.randrange(1, 5)
                piece, output = output[:n], output[n:]
                for section, at, text in reader.feed(piece):
                    assert at == len(got[section])
                    got[section] += text
            for section, _, text in reader.feed("", last=True):
                got[section] += text
            assert (got[0], got[1], got[2]) == (p, m, s)


def test_pieces_are_bounded_and_one_document_is_streamed(spark):
    df = spark.createDataFrame([(1, "x" * 100_000)], "doc_id long, text string")
    assert fim.pieces(df).agg(F.max(F.char_length("piece"))).first()[0] <= fim.CHUNK + 3
    plan = fim.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def plain_scan(text, templates=licenses.TEMPLATES, percent=90, width=64):
    w = re.findall(WORD, lower(text))
    base = [(i, label) for i in range(len(w)) for phrase, label in licenses.PHRASES if w[i : i + len(phrase.split())] == phrase.split()]
    found, best, step = set(), 0.0, width // 2
    starts = range(0, step * max(1, (len(w) - 1) // step), step) if w else ()
    assert not w or max(starts) + width >= len(w)
    for label, t in templates:
        t = set(re.findall(WORD, lower(t)))
        for i in starts:
            c = len(t & set(w[i : i + width]))
            if t and 100 * c >= percent * len(t):
                found.add(label)
                best = max(best, c / len(t))
    labels = sorted({x for _, x in base})
    return len(w), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None), labels, sorted(found | set(labels)), 1.0 if base else best


@pytest.mark.parametrize("room, broadcast_bytes", [(512, 64 << 20), (20, 64 << 20), (512, 0)])
def test_license_scan(spark, odd, monkeypatch, room, broadcast_bytes):
    monkeypatch.setattr(licenses, "ROOM", room)
    got = sorted((tuple(r) for r in licenses.scan(odd, licenses.template_table(spark), broadcast_bytes=broadcast_bytes).collect()), key=key)
    assert got == sorted(((r.doc_id, *plain_scan(r.text)) for r in odd.collect()), key=key)


def test_license_scan_of_odd_templates(spark, odd):
    templates = (("a", "ΣΑΣ GNU K é"), ("a", "ΣΑΣ GNU K é"), ("b", ""), ("c", "one"), ("d", "ONE"))
    got = sorted((tuple(r) for r in licenses.scan(odd, licenses.template_table(spark, templates), percent=70, phrases=()).collect()), key=key)
    assert got == sorted(((r.doc_id, w[0], 0, None, None, [], sorted(set(w[5]) - set(w[4])), 0.0 if w[5] == w[4] else 1.0 if "c" in w[5] else 0.75) for r in odd.collect() for w in [plain_scan(r.text, templates, 70)]), key=key)
    assert licenses.scan(odd, licenses.template_table(spark, ())).where("n_base > 0 AND size(labels) = 0").count() == 0
    assert licenses.scan(odd.where("false"), licenses.template_table(spark)).count() == 0


def test_no_template_is_missed_by_the_filters(spark):
    """Random sets: the filtered join finds what comparing all blocks with all templates finds."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    templates = tuple((f"t{i}", " ".join(rng.sample(vocabulary, rng.randrange(1, 12)))) for i in range(30))
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for percent in (50, 80, 100):
        got = {r.doc_id: r.labels for r in licenses.scan(df, licenses.template_table(spark, templates), percent=percent, width=16).collect()}
        assert got == {i: plain_scan(t, templates, percent, 16)[5] for i, t in enumerate(texts)}


def plain_search(docs, items, k):
    terms = [re.findall(WORD, lower(t)) for _, t in docs]
    big_n, big_l = sum(map(bool, terms)), sum(map(len, terms))
    counts = [collections.Counter(t) for t in terms]
    df = collections.Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), own, c in zip(docs, terms, counts):
            if own:
                m = 100 - 25 + (25 * len(own) * big_n) // big_l
                score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in re.findall(WORD, lower(text)) if c[t])
                if score > 0:
                    scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, d[3], -d[0]) for r, d in enumerate(sorted(scored, key=lambda d: d[:3])[:k])]
    return sorted(out, key=key)


@pytest.mark.parametrize("segment, block", [(16384, 200_000), (7, 200_000), (50, 6)])
def test_ranked_search(spark, odd, monkeypatch, segment, block):
    monkeypatch.setattr(lexical, "SEGMENT", segment)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    rng = random.Random(segment)
    vocabulary = [f"t{i}" for i in range(30)]
    texts = [" ".join(vocabulary[min(29, int(rng.expovariate(0.2)))] for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    docs = [(i % 280, t) for i, t in enumerate(texts)] + [(r.doc_id, r.text) for r in odd.collect()]
    items = [(f"i{i}", " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 12)))) for i in range(12)] + [("x", None), ("", "t1"), (None, "GNU license"), ("i1", "t2 t2 t2 nowhere"), ("none", "nowhere")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, rank int").repartition(3)
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id string, text string, score string")
    for k in (1, 5, 1000):
        got = lexical.search(d, i, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        got = sorted((tuple(r) for r in got.collect()), key=key)
        want = plain_search(docs, items, k)
        # rows of one id and score are alike; items that share an id keep a list each
        assert got == want
    assert lexical.search(d.where("false"), i).count() == 0 and lexical.search(d, i.where("false")).count() == 0


def test_pair_bounds_hold_and_are_tighter(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    doc = np.repeat(np.arange(400), 6)
    term = np.concatenate([rng.choice(20, 6, replace=False) for _ in range(400)]).astype(np.int32)
    weight = rng.integers(1, 5000, 20)
    s = lexical.Segment(np.arange(400), np.zeros(400, bool), [int(x) for x in rng.integers(6, 90, 400)], term, doc, rng.integers(1, 9, len(term)).astype(np.int32), weight, 400, 20_000)
    query = lexical.Query({int(t): int(c) for t, c in zip(range(20), rng.integers(1, 3, 20))}, weight)
    s.add_pairs(set(query.pairs), 10)
    tighter = 0
    for a, b in query.pairs:
        points = np.zeros(400, dtype=np.int64)
        for t in (a, b):
            docs, impact = s.list_of(t)
            points[docs] += query.counts[t] * impact
        bound, loose = s.bound(a, b, query.counts), query.counts[a] * s.largest[a] + query.counts[b] * s.largest[b]
        assert points.max() <= bound <= loose
        tighter += bound < loose
    assert tighter


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_license_scan", "op13_lexical_search"])
def test_queries_match_their_sql(spark, name):
    assert compare(spark, connect(SF), queries.QUERIES[name], queries.ORACLES[name], SF) is None


@pytest.mark.parametrize("small", [1_000_000, 0])
def test_matched_keeps_what_a_join_keeps(spark, small):
    """Broadcast keys, and a filter before a join: with repeated rows, negative hashes and keys that only share a bit."""
    from lamina.llm.common import matched
    from lamina.session import cut_lineage

    rows = spark.range(3000).select(F.col("id"), F.xxhash64("id").alias("p1"), F.xxhash64(F.lit(1), "id").alias("p2"), F.lit("wide").alias("t"))
    rows = rows.unionByName(rows.where("id < 5")).unionByName(rows.where("id = 9").withColumn("p2", F.lit(0).cast("long")))
    keys = cut_lineage(rows.where("id % 7 = 2").select("p1", "p2").distinct().where("p2 <> 0"))
    for keep, how in ((True, "left_semi"), (False, "left_anti")):
        got = matched(rows, keys, ["p1", "p2"], keep, small)
        want = rows.join(keys, ["p1", "p2"], how)
        assert got.columns == ["p1", "p2", "id", "t"] or set(got.columns) == set(rows.columns)
        assert sorted(map(tuple, got.select(*rows.columns).collect())) == sorted(map(tuple, want.select(*rows.columns).collect()))
