"""Training-data operators against brute force on small tables, with nulls, empty and long texts, repeated rows and clashing columns."""

import bisect
import collections
import datetime
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from check_oracles import compare, connect
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lamina.llm import bpe, chat, decontaminate, near_dups, pii, queries, sharding, token_counts, topk, toxicity, url_filter

ODD = [
    None, "", " ", "\n\t ", "one", "a  b   c\n\n d \n e", "\x1ca\x1db c", "ΣΑΣ İstanbul é ½²Ⅷ ٣ <|endoftext|> x<|startoftext|>", "  lead", "trail \n", "a\n \nb", "it's we'll 'sab 's't",
    " x\u00a0y\u3000z\x85q\u200bw", "🎉🎉 ok👩‍👩‍👧", "x" * 5000, "ab" * 3000 + " " + "\n" * 50 + "z", "don't" + "!" * 300, "word " * 20000, "one",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, the last repeated, with columns named like results."""
    rows = [(i, t, "mine", 7) for i, t in enumerate(ODD)] + [(0, None, "mine", 7), (None, "no id", "mine", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


def empty(df):
    return df.where("false")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_bpe_is_the_library(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = bpe.decode(bpe.encode(odd, path), path)
    assert got.columns.count("ids") == 1 and got.count() == len(ODD) + 2
    for r in got.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        assert (r.ids, r.decoded) == (ids, lib.decode(ids, skip_special_tokens=False)), r.text
    assert bpe.encode(empty(odd), path).count() == 0


def test_long_words_merge_like_short_ones():
    v = bpe.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 300):
        parts = [v.first[rng.choice(b"aehinrst")] for _ in range(n)]
        assert v.merge_short(list(parts)) == v.merge_long(list(parts))


def test_token_counts_are_the_library(odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    for r in token_counts.count_tokens(odd, path).collect():
        assert r.n_tokens == len(lib.encode(r.text or "", add_special_tokens=False).ids), r.text
    assert token_counts.count_tokens(empty(odd), path).count() == 0


def test_whole_tokens_are_proven():
    v = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.json"))
    whole = token_counts.whole_tokens(v)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(whole) > 40_000
    assert all(len(lib.encode(t).ids) == 1 for t in random.Random(2).sample(sorted(whole), 500))


def test_pieces_cut_anywhere_safe(monkeypatch):
    v = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counter = token_counts.Counter(v, token_counts.whole_tokens(v))
    monkeypatch.setattr(token_counts, "PIECE", 7)
    text = "  some  text\n \n here, it's   cut  " * 20
    assert counter.count(text) == len(lib.encode(text).ids)


def brute_classes(rows, width, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return collections.Counter((d, len(s), min(low[find(i)], default=None), d == min(low[find(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed, n, edits, length=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("edits", [2, 7])
def test_near_duplicates(spark, edits):
    texts = [*ODD, *near_copies(3, 60, edits), *["the same text of some words"] * 9, *near_copies(4, 3, 1)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "alone without an id"), (5, "a repeated id with another text")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string")
    got = near_dups.near_duplicates(df, width=4).select("doc_id", "n_shingles", "component_id", "kept").collect()
    expected = collections.Counter((d, n, c, k if d is not None else True) for (d, n, c, k), m in brute_classes(rows, 4, 80).items() for _ in range(m))
    assert collections.Counter(tuple(r) for r in got) == expected


@pytest.mark.parametrize("copies", [4, 40])
def test_near_duplicates_without_ids(spark, copies):
    base = near_copies(8, 1, 0, length=60)[0]
    chain = [base + " " + " ".join(f"y{j}" for j in range(k)) for k in (0, 10, 20)]  # the ends are linked only by the text between
    alike = near_copies(9, copies, 7)
    rows = [(1, chain[0]), (None, chain[1]), (2, chain[2]), *((None, t) for t in alike), *[(None, alike[0])] * 3, (None, "alone without an id"), (None, None), (None, "")]
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    expected = brute_classes(rows, 4, 80)
    assert collections.Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()) == expected
    assert expected[(2, 77, 1, False)] == 1
    left = [tuple(r) for r in near_dups.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()]
    assert len([t for _, t in left if t in alike]) == got.where("doc_id IS NULL AND component_id IS NULL AND n_shingles > 10").select("class_digest").distinct().count()


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dups.near_duplicates(df).count() == 0 and near_dups.drop_near_duplicates(df).count() == 0


def test_dropping_near_duplicates_keeps_columns_and_one_each(spark):
    texts = near_copies(5, 12, 1) + ["alone here with its own words"] * 2 + [None, "", ""]
    df = spark.createDataFrame([(i // 2 if i == 13 else i, t, i) for i, t in enumerate(texts)] + [(14, None, 14)], "doc_id long, text string, component_id int")
    left = near_dups.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [0, 6, 14, 15, 16] or sorted(r.doc_id for r in left.collect()) == [0, 6, 12, 14, 15, 16]


def test_dropping_near_duplicates_keeps_unrelated_texts_without_an_id_or_under_one_id(spark):
    texts = [f"an unrelated text number {i} of its own words {i * i}" for i in range(6)]
    copies = near_copies(6, 4, 1)
    rows = [(None, t, 0) for t in texts[:4]] + [(None, texts[0], 1), (7, texts[4], 2), (7, texts[5], 3), (None, texts[5], 4), (8, copies[0], 5), (8, copies[1], 6), (9, copies[2], 7)]
    rows += [(None, "", 8), (None, " ", 8), (None, None, 8), (None, "", 9), (None, "", 9), (7, None, 8), (7, "\n", 8), (None, "\x1c", 8)]
    left = [tuple(r) for r in near_dups.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()]
    kept = collections.Counter((d, t) for d, t, n in left if t not in copies and n < 8)
    assert kept == collections.Counter([*((None, t) for t in texts[:4]), (7, texts[4]), (7, texts[5])])
    assert [d for d, t, _ in left if t in copies] == [8]
    assert sorted((r for r in left if r[2] >= 8), key=repr) == sorted(set(rows[11:]), key=repr)


def test_a_pair_at_the_threshold_survives_every_batch():
    least = near_dups.survives(80)
    assert len(least) == near_dups.BANDS * near_dups.ROWS // near_dups.BATCH and least == sorted(least)
    assert least[-1] < 0.8 * near_dups.BANDS * near_dups.ROWS


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=8).round(1).tolist() for _ in range(120)]
    vectors[3], vectors[4], vectors[5], vectors[6], vectors[7] = None, [1.0, None], [float("nan")] * 8, [], [float("inf")]
    vectors[60] = vectors[61] = vectors[62]
    rows = [(i, v, 1.0) for i, v in enumerate(vectors)] + [(62, vectors[62], 1.0), (None, vectors[1], 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0).collect()]
    ints = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in enumerate(vectors) if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    expected = []
    for q in (i for i in ints if i % 10 == 0):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in [*ints.items(), (62, ints[62])] if i != q)[:5]  # 62 is there twice
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(got) == sorted(expected)
    assert topk.top_k(empty(df), F.lit(True)).count() == 0


@pytest.mark.parametrize("shard, block", [(65_536, 8192), (2, 1)])
def test_top_k_keeps_repeated_rows(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    df = spark.createDataFrame([(0, [1.0]), (1, [3.0]), (1, [3.0]), (2, [2.0]), (4, [1.0])], "vec_id long, embedding array<double>")
    best = [(1, 3), (1, 3), (2, 2), (4, 1)]
    assert sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0).collect()) == [(0, k + 1, j, 256 * 256 * s) for k, (j, s) in enumerate(best)]
    several = sorted(tuple(r)[1:] for r in topk.top_k(df, F.col("vec_id") == 1, k=4).collect())
    assert several == [(1, 2, 256 * 256 * 6), (2, 2, 256 * 256 * 6), (3, 0, 256 * 256 * 3), (4, 0, 256 * 256 * 3)]


def test_top_k_gives_all_where_there_are_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 256 * 512)]


def test_top_k_keeps_vectors_that_share_an_id_and_large_components(spark):
    big = float(2**40)
    rows = [(0, [1.0, 1.0]), (0, [0.0, 2.0]), (1, [-9.0, 0.0]), (1, [3.0, 0.5]), (2, [big, -big + 1 / 4]), (2, [2.0, 0.0]), (3, [1e30, -1e30]), (3, [-1e300, 1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    pairs = sorted((-sum(a * b for a, b in zip(q, c)), j) for i, q in ints for j, c in ints if i == 0 and j in (1, 2))
    got = [tuple(r) for r in topk.top_k(df.where("vec_id < 3"), F.col("vec_id") == 0, k=6).orderBy("rank").collect()]
    assert got == [(0, k + 1, j, -s) for k, (s, j) in enumerate(pairs[:6])]
    low = topk.top_k(df.where("vec_id = 1 OR embedding[0] = 1e30"), F.col("vec_id") == 5)
    assert low.count() == 0
    zero = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1e308, 1.0]), (2, [5.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(zero, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1, 0), (0, 2, 2, 0)]


def test_shards(spark):
    rows = [(i % 300 if i % 3 else 7, f"text {i}" if i % 5 else None, "x") for i in range(500)] + [(None, "no id", "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    got = sharding.assign(df, 7, virtual=16).collect()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.size == 16 + len((r.text or "").encode())
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} <= {len(rows) // 7, len(rows) // 7 + 1}
    assert sharding.assign(empty(df), 7).count() == 0
    loose = sharding.assign(df, 7, virtual=16, load_factor=1.25).groupBy("shard").count().agg(F.max("count")).first()[0]
    assert loose <= -(-5 * len(rows) // 28)


def test_walk_is_the_walk_of_single_keys():
    rng = random.Random(3)
    points = [rng.randrange(5) for _ in range(40)]
    counts = {(p, s): rng.randrange(6) for p in range(40) for s in range(2)}
    total = sum(counts.values())
    room = [total // 5 + (s < total % 5) for s in range(5)]
    where = {(p, s, r): (shard, base + r - lo) for p, s, lo, hi, shard, base in sharding.walk(points, room, counts) for r in range(lo, hi)}
    free, seen, left = list(room), [0] * 5, []
    for (p, s), n in sorted(counts.items()):
        for r in range(n):
            if free[points[p]]:
                assert where[p, s, r] == (points[p], seen[points[p]])
                free[points[p]] -= 1
                seen[points[p]] += 1
            else:
                left.append((p, s, r))
    for p, s, r in left:
        at = p
        while not free[points[at]]:
            at = (at + 1) % len(points)
        assert where[p, s, r] == (points[at], seen[points[at]])
        free[points[at]] -= 1
        seen[points[at]] += 1
    assert len(where) == total and not any(free)


def plain_ring(rows, shards, virtual, room):
    """Shard of every (place, tie) by bisection and a walk of single keys; rows in ring order of point, split, place and tie."""
    points = sharding.ring(shards, virtual)
    kinds = collections.Counter(rows)
    hot = sorted(k for k, n in kinds.items() if n * sharding.HOT > len(rows))
    keyed = []
    for place, tie in rows:
        point = bisect.bisect_left([p for p, _ in points], place) % len(points)
        keyed.append((point, sharding.SPLITS + hot.index((place, tie)) if (place, tie) in hot else tie % sharding.SPLITS, place, tie))
    free, out, left = list(room), collections.Counter(), []
    for row in sorted(keyed):
        shard = points[row[0]][1]
        if free[shard]:
            free[shard] -= 1
            out[row[2:], shard] += 1
        else:
            left.append(row)
    for row in left:
        at = row[0]
        while not free[points[at][1]]:
            at = (at + 1) % len(points)
        free[points[at][1]] -= 1
        out[row[2:], points[at][1]] += 1
    return out


@pytest.mark.parametrize("hot", [1000, 5])
def test_assign_is_the_plain_ring(spark, monkeypatch, hot):
    monkeypatch.setattr(sharding, "HOT", hot)
    texts = [None, "", "é🎉", "x" * 9000]
    rows = [(i, texts[i % 4] if i % 7 == 0 else f"text {i}", "mine", i) for i in range(1500)] + [(5, "same", "mine", 0)] * 700 + [(None, None, "mine", 0)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, Slot string, size int").repartition(6)
    hashed = [tuple(r) for r in df.select(F.xxhash64("doc_id"), F.xxhash64("doc_id", "text")).collect()]
    got = sharding.assign(df, 9, virtual=20)
    assert got.columns == ["doc_id", "text", "size", "text_crc32", "shard", "slot"]
    room = [len(rows) // 9 + (s < len(rows) % 9) for s in range(9)]
    placed = collections.Counter(((r[0], r[1]), r.shard) for r in got.select(F.xxhash64("doc_id"), F.xxhash64("doc_id", "text"), "shard").collect())
    assert placed == plain_ring(hashed, 9, 20, room)
    out = got.collect()
    assert all(r.text_crc32 == zlib.crc32((r.text or "").encode()) and r.size == 16 + len((r.text or "").encode()) for r in out)
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(room[s])) for s in range(9))
    assert sharding.assign(df, 9, virtual=20, keep_text=False).columns == ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_equal_rows_are_split(spark):
    df = spark.range(8000).selectExpr("IF(id < 4000, 1, id) AS doc_id", "'same' AS text")
    got = sharding.assign(df, 4, virtual=8)
    assert got.groupBy("shard").count().agg(F.max("count")).first()[0] == 2000
    kinds = sharding._hot_splits(df.select(F.xxhash64("doc_id").alias("__place"), F.xxhash64("doc_id", "text").alias("__tie")))
    assert [k[2:] for k in kinds] == [(sharding.SPLITS, 500)]


def test_a_larger_ring_moves_few_keys(spark):
    points, more = sharding.ring(10, 64), sharding.ring(11, 64)
    assert set(points) <= set(more)
    df = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    before, after = ({r.doc_id: r.shard for r in sharding.assign(df, n, virtual=128, load_factor=1.25, keep_text=False).collect()} for n in (10, 11))
    moved = sum(before[k] != after[k] for k in before)
    # an eleventh has to move; dealing anew would move ten elevenths
    assert 20_000 * 0.06 < moved < 20_000 * 0.25


def test_urls(spark):
    urls = [None, "", "no scheme/en/", "http://EXAMPLE.com/en/x?q", "http://www.example.com/en/", "https://a.www.example.com/en/#t", "ftp://example.com", "http://notexample.com/en/", "x://net/es/", "x://b.net/fr/y", "x://b.net/fr",
            "a://b://c.com/", "://com/", "http://example.com/EN/", "http://com./en/", "http://" + "a." * 300 + "com/" + "p" * 5000]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls + urls[:5])], "page_id long, url string, rule string")
    got = url_filter.judge(df, url_filter.rule_table(spark, queries.RULES))
    for r in got.collect():
        rest = (r.url or "").split("://", 1)
        rest = rest[1] if len(rest) > 1 else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        fits = sorted(((len(h + p), len(h), h + p, v) for v, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)), reverse=True)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, fits[0][2] if fits else None, fits[0][3] if fits else "allow"), r.url
    assert url_filter.judge(empty(df), url_filter.rule_table(spark, queries.RULES)).count() == 0
    none = url_filter.judge(df, url_filter.rule_table(spark, queries.RULES).where("false"))
    assert none.where("verdict = 'allow' AND rule IS NULL").count() == len(urls) + 5


def test_rules_no_url_can_have_fit_nothing(spark):
    df = spark.createDataFrame([(0, "http://example.com/en/x")], "page_id long, url string")
    rules = [("block", "example.com/en", "/"), ("block", "exa", "mple.com/"), ("block", "com", "?"), ("allow", None, "/")]
    odd = spark.createDataFrame(rules, "verdict string, host string, path string")
    assert [tuple(r) for r in url_filter.judge(df, odd).collect()] == [(0, "http://example.com/en/x", "example.com", "/en/x", None, "allow")]


def test_many_rules_and_a_host_of_many_labels(spark):
    rules = spark.range(100_000).selectExpr("IF(id % 3 = 0, 'allow', 'block') AS verdict", "concat('h', id, IF(id % 2 = 0, '.example.com', '.net')) AS host", "substring('/a/b/', 1, 1 + id % 5) AS path")
    urls = spark.range(2000).selectExpr("id AS page_id", "concat('http://www.h', id * 100, IF(id % 2 = 0, '.example.com', '.net'), '/a/b/c') AS url")
    long = spark.createDataFrame([(-1, "http://" + "a." * 20_000 + "h5.net/x"), (-2, "http://" + "h4.example.com." * 5000 + "/a/b/"), (-3, "http://h1.net/" + "a" * 2_000_000)], "page_id long, url string")
    got = url_filter.judge(urls.union(long), rules)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    for r in got.drop("url").collect():
        want, n = None, None
        if r.page_id == -1:
            want, n = "h5.net/", 5
        elif r.page_id >= 0 and r.page_id * 100 < 100_000 and r.page_id % 2 == 0:  # ids ending in 00 have even rule numbers only
            n = r.page_id * 100
            want = f"h{n}.example.com" + "/a/b/"[: 1 + n % 5]
        elif r.page_id == -3:
            want, n = "h1.net/a", 1
        assert r.rule == want and r.verdict == ("allow" if n is None or n % 3 == 0 else "block"), r.page_id


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).select(F.concat(F.lit("key "), "id").alias("key"))
    listed = universe.where("substring(key, -2) = '07'")
    levels = url_filter.cascade(listed, universe, 3000)
    got = url_filter.holding(universe, levels).where(url_filter.member(levels, "key"))
    assert len(levels) > 1 and {r.key for r in got.collect()} == {r.key for r in listed.collect()}


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_windows_of_many_items_and_long_runs_of_hits(spark, broadcast_bytes):
    common = " ".join(f"c{i}" for i in range(13))
    items = [(i, f"{common} own{i} " + " ".join(f"i{i}w{j}" for j in range(14))) for i in range(300)] + [(None, "x " * 20)]
    b = spark.createDataFrame(items, "item_id long, text string")
    long = " ".join(["x"] * 60_000)
    d = spark.createDataFrame([(1, f"a b {common} c"), (2, long), (3, " ".join(f"i7w{j}" for j in range(14)) + " gap " + common), (4, "nothing here"), (5, f"{common} {common}")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.mark(d, b, broadcast_bytes=broadcast_bytes).collect()}
    every = sorted(str(i) for i in range(300))
    assert got[1].item_ids == every and [tuple(s) for s in got[1].spans] == [(2, 15)]
    assert got[2].item_ids == [] and [tuple(s) for s in got[2].spans] == [(0, 60_000)] and got[2].n_hit == 60_000 and got[2].contaminated
    assert got[3].item_ids == every and [tuple(s) for s in got[3].spans] == [(0, 14), (15, 28)]
    assert got[4].spans is None and not got[4].contaminated
    assert [tuple(s) for s in got[5].spans] == [(0, 26)] and got[5].n_hit == 26


@pytest.mark.parametrize("n", [2, 5])
def test_decontamination(spark, n):
    rng = random.Random(n)
    vocabulary = ["alpha", "Beta", "GAMMA", "délta", "É", "x1", "y-z", "w"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 9)))) for i in range(12)] + [(20, None), (21, ""), (22, "!!"), (23, "alpha"), (0, "É alpha w w w w")]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(60)] + [(1, "alpha é"), (1, "alpha é"), (None, "alpha Beta w"), (99, None), (98, "word " * 5000)]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, n_hit string")
    b = spark.createDataFrame(items, "item_id long, text string")
    table = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - n + 1) if w else 0):
            table[tuple(w[j : j + n])].add(str(i))
    expected = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for k, v in table.items():
            for j in range(len(w) - len(k) + 1):
                if tuple(w[j : j + len(k)]) == k:
                    hit |= set(range(j, j + len(k)))
                    ids |= v
        expected.append((i, len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    for settings in ({}, {"broadcast_bytes": 0}):
        got = decontaminate.mark(d, b, n=n, **settings)
        rows = [(r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in got.collect()]
        assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert decontaminate.mark(empty(d), b).count() == 0
    assert decontaminate.mark(d, empty(b)).where("contaminated OR n_hit > 0").count() == 0
    assert decontaminate.drop_contaminated(d, b, n=n).count() == sum(not x[4] for x in expected)


def test_a_large_benchmark_shuffles_windows_not_texts(spark):
    d = spark.createDataFrame([(1, "of the in of the in of the a b"), (2, "of the in"), (None, "x of the a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "of the in q"), (2, "of the a b"), (3, "in")], "item_id long, text string")
    found = decontaminate.hits(d, b, n=4, broadcast_bytes=0)
    assert sorted(((r.id, [tuple(s) for s in r.spans], r.item_ids) for r in found.collect()), key=repr) == [(1, [(2, 3), (5, 10)], ["2", "3"]), (2, [(2, 3)], ["3"]), (None, [(1, 5)], ["2"])]
    lines = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(lines) if "Join Inner" in line)
    left = next(line for line in lines[join + 1 :] if "Project" in line)
    assert "own#" in left and not re.search(r"\b(w|low)#\d+(,|\])", re.sub(r"\([^()]*\)|slice\(.*?\) AS", "", left)), left


def test_cutting_spans(spark):
    d = spark.createDataFrame([(1, "Keep this, one TWO three! and that"), (2, "nothing"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert [r.text for r in decontaminate.cut_spans(d, b, n=3, mask="#").orderBy("doc_id").collect()] == ["Keep this, #! and that", "nothing", None]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pseudonyms(spark):
    texts = [
        None, "", "nothing here 12 3", "card 4539578763621486 and 4539 5787 6362 1486.", "bad card 4539578763621487", "call +1 (017) 555-7713 or 017-555-7713!", "ssn 123-45-6789, not 000-12-3456", "ip 10.0.0.255 not 10.0.0.256 1.2.3",
        "born 1999-02-28, 28.02.1999, not 1999-02-30", "Mail joe.x+1@mail7.example.com. And JOE.X+1@mail7.example.com", "long " * 30000 + "4539578763621486", "7536784127813050 4845168114407329", "x" * 100000 + "@",
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts + texts[3:4])], "doc_id long, text string, n_pii string")
    got = [r.text for r in pii.pseudonymise(df, "key").orderBy("doc_id").collect()]
    assert got[:3] == texts[:3] and got[4] == texts[4] and got[-1] == got[3]
    card, same = re.fullmatch(r"card (\d{16}) and ((?:\d{4} ){3}\d{4})\.", got[3]).groups()
    assert card == same.replace(" ", "") and card != "4539578763621486" and luhn(card) and got[10] == "long " * 30000 + card
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \d{3}-\d{3}-\d{4}!", got[5]) and "555-7713" not in got[5]
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}, not 000-12-3456", got[6]) and "123-45-6789" not in got[6]
    assert got[7].endswith("not 10.0.0.256 1.2.3") and all(int(p) < 256 for p in got[7].split()[1].split("."))
    iso, german = re.fullmatch(r"born (\S+), (\S+), not 1999-02-30", got[8]).groups()
    assert iso == "-".join(reversed(german.split("."))) and iso != "1999-02-28"
    a, b = re.fullmatch(r"Mail (\S+@\S+)\. And (\S+)", got[9]).groups()
    assert a == b and "joe" not in got[9].lower()
    assert pii.pseudonymise(df, "other").where("doc_id = 3").first().text != got[3]
    assert pii.pseudonymise(empty(df), "key").count() == 0


def test_spaced_phones_and_month_first_dates(spark):
    df = spark.createDataFrame([(0, "call 212 555 1234 or 212-555-1234, born 12/31/1990 not 02/30/1990 13/13/2000")], "doc_id long, text string")
    r = pii.pseudonymise(df, "key").first()
    a, b, day = re.fullmatch(r"call (\d{3} \d{3} \d{4}) or (\d{3}-\d{3}-\d{4}), born (\d{2}/\d{2}/\d{4}) not 02/30/1990 13/13/2000", r.text).groups()
    assert a == b.replace("-", " ") != "212 555 1234" and day != "12/31/1990" and r.n_pii == 3
    days = spark.range(73049).select(F.expr("date_format(date_add(DATE'1900-01-01', CAST(id AS int)), 'MM/dd/yyyy')").alias("text")).where("substring(text, 4, 2) > '12'")
    out = pii.pseudonymise(days.repartition(8), "key").select("text")
    assert days.count() == 44249 and out.distinct().count() == 44249 and out.where("text NOT RLIKE '^(0[1-9]|1[0-2])/[0-3][0-9]/(19|20)[0-9]{2}$'").isEmpty()


def feistel(value, left, right, key, tag):
    a, b = divmod(value, right)
    for r in range(pii.ROUNDS):
        noise = int(hashlib.sha256(f"{key}|{tag}|{r}|{a if r % 2 else b}".encode()).hexdigest()[:15], 16)
        a, b = (a, (b + noise) % right) if r % 2 else ((a + noise) % left, b)
    return a * right + b


def test_values_are_linked_in_all_formats_and_permuted_by_a_plain_feistel(spark):
    day = datetime.date(1900, 1, 1) + datetime.timedelta(days=feistel((datetime.date(1990, 12, 31) - datetime.date(1900, 1, 1)).days, 17, 4297, "secret key", "date"))
    n = feistel((212 * 800 + 555 - 200) * 10000 + 1234, 800_000, 10000, "secret key", "nanp")
    phone = f"{n // 8_000_000:03d}", f"{n // 10000 % 800 + 200}", f"{n % 10000:04d}"
    far = f"{feistel(2079460958, 10**5, 10**5, 'secret key', 'phone10'):010d}"
    ip = feistel(10 << 24 | 255, 65536, 65536, "secret key", "ip")
    ssn = feistel(((123 - 1) * 99 + 45 - 1) * 9999 + 6789 - 1, 898 * 99, 9999, "secret key", "ssn")
    area, group, serial = ssn // 989901, ssn // 9999 % 99 + 1, ssn % 9999 + 1
    card = f"{feistel(453957876362148, 10**7, 10**8, 'secret key', 'card15'):015d}"
    cases = {
        "1990-12-31": f"{day:%Y-%m-%d}", "1990/12/31": f"{day:%Y/%m/%d}", "31.12.1990": f"{day:%d.%m.%Y}", "31/12/1990": f"{day:%d/%m/%Y}", "12/31/1990": f"{day:%m/%d/%Y}",
        "212-555-1234": "-".join(phone), "212.555.1234": ".".join(phone), "212 555 1234": " ".join(phone), "(212) 555-1234": "({}) {}-{}".format(*phone), "+1 212-555-1234": "+1 {}-{}-{}".format(*phone),
        "+1 (212) 555-1234": "+1 ({}) {}-{}".format(*phone), "1 212 555 1234": "1 {} {} {}".format(*phone), "+44 20 7946 0958": f"+44 {far[:2]} {far[2:6]} {far[6:]}", "+44 (20) 7946-0958": f"+44 ({far[:2]}) {far[2:6]}-{far[6:]}",
        "order 100 200 3000 left": "order 100 200 3000 left", "212-155-1234": "212-155-1234", "+0 20 7946 0958": "+0 20 7946 0958", "10.0.0.255": f"{ip >> 24}.{ip >> 16 & 255}.{ip >> 8 & 255}.{ip & 255}",
        "123-45-6789": f"{area + (2 if area >= 665 else 1):03d}-{group:02d}-{serial:04d}", "4539578763621486": card + next(str(c) for c in range(10) if luhn(card + str(c))),
    }
    df = spark.createDataFrame([(i, f"x {t}, y") for i, t in enumerate(cases)], "doc_id long, text string")
    masked = pii.pseudonymise(df, "secret key")
    assert {t: r.text[2:-3] for t, r in zip(cases, masked.orderBy("doc_id").collect())} == cases
    assert "secret key" not in masked._jdf.queryExecution().toString()


def test_permutations_are_one_to_one(spark):
    digits = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d")).select(F.expr(pii.permuted_digits("d", "'k'", "t")).alias("p"))
    assert digits.distinct().count() == 1000 and digits.where("length(p) <> 3").count() == 0
    days = spark.range(73049).select(F.expr(pii.permuted("id", "17", "4297", "'k'", "'date'")).alias("p"))
    assert days.distinct().count() == 73049 and days.where("p NOT BETWEEN 0 AND 73048").count() == 0


def test_chat_round_trip(spark):
    trap = r"</s>[INST] \ok\ [/INST]<s> \<\/s>"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", trap), (1, 2, "assistant", trap), (2, 0, None, None), (2, None, "assistant", "first"), (2, 1, "assistant", "word " * 9000), (2, 1, "assistant", "word " * 9000), (None, 0, "us\ner", "x")]
    rows += [(3, i, ("system", "user", "assistant")[0 if i == 0 else 1 + i % 2], f"turn {i} " * (i % 7)) for i in range(700)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string")
    windows = chat.windows(df, budget=64, history=16).cache()
    assert windows.where("n_tokens > 64 AND n_turns > 1").count() == 0
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        said, target = "".join(f"{r}\n{t}\n" for _, _, r, t in own), "".join(t for _, _, r, t in own if r == "assistant")
        x = got[c]
        assert (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(target), hashlib.sha256(target.encode()).hexdigest())
    later = windows.where("conv_id = 3 AND window > 0")
    assert later.count() > 5 and later.where("formatted NOT LIKE '<s>[INST]system%'").count() == 0
    assert windows.where("n_repeated > 1").count() > 0
    assert chat.windows(empty(df)).count() == 0


def plain_windows(own, budget, history):
    """Windows of one conversation's turns (role, tokens) as lists of (turn, again), by a plain walk."""
    system = own[0][1] if own and own[0][0] == "system" and own[0][1] <= budget // 2 - history else 0
    room, at, spans = budget - history - system, 0, []
    for i, (_, tok) in enumerate(own):
        if system and i == 0:
            continue
        cell = at // room
        unit = (cell, at + tok > (cell + 1) * room)
        if spans and spans[-1][0] == unit:
            spans[-1][1].append((i, tok))
        else:
            spans.append((unit, [(i, tok)]))
        at += tok
    joined = []
    for unit, turns in spans:
        if joined and joined[-1][0][1] and not unit[1] and sum(t for _, t in joined[-1][1] + turns) <= room:
            joined[-1] = ((unit[0], False), joined[-1][1] + turns)
        else:
            joined.append((unit, turns))
    out, before = [], []
    for _, turns in joined:
        size = sum(t for _, t in turns)
        repeated = [i for n, (i, _) in enumerate(before) if size <= room and sum(t for _, t in before[n:]) <= history]
        first = not out
        if system and system + size <= budget:
            out.append([(0, not first), *((i, True) for i in repeated), *((i, False) for i, _ in turns)])
        else:
            if system and first:
                out.append([(0, False)])
            out.append([*((i, True) for i in repeated), *((i, False) for i, _ in turns)])
        before = turns
    return out or ([[(0, False)]] if system else [])


def test_chat_windows_hold_their_budget(spark):
    """Against a plain walk; no window is above the budget but a single longer turn, alone or with the system turn that fits."""
    rng = random.Random(8)
    rows = []
    for c in range(60):
        sizes = [rng.choice([1, 5, 20, 60, 90, 99, 100, 101, 130, 400, 2000, rng.randrange(300)]) for _ in range(rng.randrange(1, 40))]
        rows += [(c, i, ("system" if c % 2 else "user") if i == 0 else ("assistant", "user")[i % 2], f"{i}" + "x" * (4 * max(0, n - 4) - len(str(i)))) for i, n in enumerate(sizes)]
    rows += [(99, 0, "system", "only"), (98, 0, "system", "s"), (98, 1, "user", "y" * 395), (97, 0, "system", "s" * 80), (97, 1, "user", "y" * 395)]
    got = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=100, history=25)
    found = [(r.conv_id, r.window, [(t.role, t.text) for t in r.turns], r.n_repeated, r.n_tokens) for r in got.withColumn("turns", chat.parsed(F.col("formatted"))).collect()]
    for c in {r[0] for r in rows}:
        own = [(r[2], r[3]) for r in sorted(r for r in rows if r[0] == c)]
        tok = [-(-len(t) // 4) + 4 for _, t in own]
        want = plain_windows([(r, n) for (r, _), n in zip(own, tok)], 100, 25)
        mine = [x for x in sorted(found) if x[0] == c]
        assert [x[2] for x in mine] == [[own[i] for i, _ in w] for w in want]
        assert [x[3] for x in mine] == [sum(again for _, again in w) for w in want]
        for _, _, turns, _, n in mine:
            assert n <= 100 or len(turns) == 1


def test_toxicity_learns_and_scores_odd_texts(spark):
    rng = random.Random(4)
    plain = [f"{a}{b}" for a in ("lor", "mip", "sut", "dol") for b in ("em", "an", "is", "or", "ul")]
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        w = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        if bad:
            for _ in range(4):
                w[rng.randrange(len(w))] = "zarg" + rng.choice(plain)
        rows.append((i, " ".join(w), "en" if i % 2 else "fr", "x"))
        labels.append((i, int(bad)))
    rows += [(1000 + i, t, None, "x") for i, t in enumerate(ODD)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string"), spark.createDataFrame(labels + [(2000, None)], "doc_id long, toxic int")
    classifier = toxicity.train(docs, marks, use=F.col("doc_id") % 4 != 2)
    got = toxicity.score(docs, classifier).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    test = [r for r in got if r.doc_id < 1000 and r.doc_id % 4 == 2]
    assert sum((r.score >= 0.3) == (r.doc_id % 5 == 0) for r in test) >= 0.95 * len(test)
    assert toxicity.score(empty(docs), classifier).count() == 0
    assert toxicity.score(docs.drop("lang"), toxicity.train(docs, empty(marks))).where("toxic").count() == 0


def test_toxicity_skips_only_the_text_that_does_not_fit(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda read, labels: seen.extend(zip((int(n[0]) for _, _, n in read), labels)) or toxicity.Model.fresh(np.zeros(toxicity.BUCKETS, np.float32)))
    docs = [(i, "long " * 500 if i < 8 else f"short text {i}", "en") for i in range(40)]
    toxicity.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"), max_words=100)
    held = [i for i in range(8, 40) if toxicity.xxhash.xxh3_64_intdigest(docs[i][1]) % 5 == 0]
    assert sorted((n, int(y)) for n, y in seen) == sorted((3, i % 2) for i in range(8, 40) if i not in held)


def test_toxicity_learns_from_every_labelled_text_in_several_parts(spark, monkeypatch):
    """Words that only the labelled texts with the largest hashes hold are learnt, and copies trained on parts make one model."""
    order = [r.id for r in spark.range(2400).orderBy(F.xxhash64("id")).collect()]
    late = set(order[2100:])
    rows = [(i, f"zarg mip n{i}" if i in late else f"bad{i % 7} mip n{i}", "en") for i in range(2400)] + [(i, f"lor{i % 9} mip n{i}", "fr") for i in range(2400, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, int(i < 2400)) for i in range(3000)], "doc_id long, toxic int")
    odds, fresh = [], toxicity.Model.fresh
    monkeypatch.setattr(toxicity.Model, "fresh", staticmethod(lambda log_odds, seed=7: odds.append(log_odds) or fresh(log_odds, seed)))
    monkeypatch.setattr(toxicity, "PART_TEXTS", 700, raising=False)
    got = toxicity.score(docs, toxicity.train(docs, marks)).collect()
    assert odds[0][np.frombuffer(toxicity.features("zarg"), np.int32)[0]] > 1
    assert all(r.toxic == (r.doc_id < 2400) for r in got)
    rng = np.random.default_rng(3)
    steps, toxic, n = rng.integers(0, 50, 400), rng.random(400) < 0.4, rng.integers(1, 5, 400)
    assert toxicity.best_threshold(steps / 50, toxic, counts=n) == toxicity.best_threshold(np.repeat(steps / 50, n), np.repeat(toxic, n))


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_oracles(spark, key):
    assert compare(spark, connect(SF), queries.QUERIES[key], queries.ORACLES[key], SF) is None


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dups", "decontaminate", "pii", "bpe"]
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and 0 < out.count() < given.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given, sf).columns == given.columns
    private = corpus_pipeline.mask_private(spark, given, sf)
    assert private.where("n_chars <> char_length(text)").count() == given.where("n_chars <> char_length(text)").count()


def test_pipeline_keeps_the_rows_of_brute_force(spark, tmp_path):
    """All stages on a table with nulls and repeated ids; without labels the toxicity stage rejects nothing."""
    import corpus_pipeline

    item = " ".join(f"bench{i}" for i in range(13))
    base = near_copies(11, 1, 0, length=60)[0]
    rows = [(None, f"no id {i} and words of its own {i * i} here") for i in range(5)] + [(7, "first text under seven with some words"), (7, "quite another text that shares this id")]
    rows += [(3, base), (4, base + " more"), (None, base + " other"), (5, item), (None, item + " tail"), (6, f"long {item} " + " ".join(f"own{i}" for i in range(400))), (8, None), (None, ""), (9, " "), (None, rows[0][1])]
    docs = [(d, t, "en", None if t is None else len(t)) for d, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for _, t in rows]
    kept = []
    for d, i in sorted(((float("inf") if d is None else d, i) for i, (d, _) in enumerate(rows))):
        if not sets[i] or all(5 * len(sets[i] & sets[j]) < 4 * len(sets[i] | sets[j]) for j in kept):
            kept.append(i)
    clean = [rows[i] for i in kept if not (item in (rows[i][1] or "") and 20 * 13 >= len(words(rows[i][1])))]
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [(d, len(x), x) for d, t in clean for x in [lib.encode(t or "", add_special_tokens=False).ids]]
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.drop_toxic(spark, given, str(tmp_path)).count() == len(rows)
    left = corpus_pipeline.drop_near_copies(spark, given, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted((rows[i] for i in kept), key=repr)
    assert sorted((tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=repr) == sorted(expected, key=repr)


def test_decoding_keeps_null_and_empty_lists_apart_from_their_neighbours(spark):
    """Any worker's memory gives the same ids, and lists are cut out of a block at the right places."""
    import public_tokenizers

    from lamina.llm import bpe

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["one two", None, "", "three", "one two three"] * 20)], "id long, text string").coalesce(1)
    whole, little = ({r.id: r.ids for r in bpe.encode(rows, path, room=n).collect()} for n in (400_000, 1))
    assert whole == little
    tokens = bpe.Vocabulary.load(path).tokens
    lists = spark.createDataFrame([(i, None if i % 5 == 1 else v) for i, v in whole.items()], "id long, ids array<int>").coalesce(1)
    assert {r.id: r.decoded for r in bpe.decode(lists, path).collect()} == {i: " ".join(tokens[k] for k in v) for i, v in whole.items()}


def test_a_task_leaves_no_memo_in_its_worker():
    import gc
    import weakref

    import public_tokenizers

    from lamina.llm import token_counts

    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
    gc.disable()
    try:
        for make in (lambda: bpe.WordEncoder(vocabulary), lambda: token_counts.Counter(vocabulary, frozenset())):
            made = make()
            made.encode("two words") if hasattr(made, "encode") else made.count("two words")
            assert made.memo
            memo = weakref.ref(made.memo)
            del made
            assert memo() is None
    finally:
        gc.enable()


def test_candidates_are_compared_without_pandas(spark):
    from lamina.llm import near_dups

    sets = {1: range(1, 101), 2: range(6, 101), 3: range(51, 151)}
    sigs = [(n, bytearray(near_dups.signature([near_dups._mixed(np.array(s, dtype=np.uint64))])[0].tobytes())) for n, s in sets.items()]
    nodes = spark.createDataFrame(sigs, "node long, sig binary")
    found = near_dups.pruned(spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long"), nodes, 80)
    assert [tuple(r) for r in found.collect()] == [(1, 2)]
    assert "InPandas" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("add", [lambda df, path: bpe.encode(df, path), lambda df, path: token_counts.count_tokens(df, path, n_tokens="n"), lambda df, _: toxicity.score(df, toxicity._flat(0.5))])
def test_a_text_goes_to_the_workers_once(spark, odd, add):
    path = public_tokenizers.path("word_bpe_49k.json") if add.__code__.co_names[1] == "encode" else public_tokenizers.path("byte_bpe_50k.json")
    rows = add(odd, path)
    assert "__text" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r.text for r in rows.orderBy("doc_id").collect()] == [r.text for r in odd.orderBy("doc_id").collect()]
    # a text that isn't a string is still read as one
    as_bytes = add(odd.withColumn("text", F.col("text").cast("binary")), path)
    assert sorted(map(str, as_bytes.drop("text").collect())) == sorted(map(str, rows.drop("text").collect()))


def test_pipeline_bounds_the_batches_of_its_workers(spark):
    import corpus_pipeline
    from lamina.llm import common

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    long = "word " * 1_500_000  # more than a batch holds
    rows = spark.createDataFrame([(i, "a b c " * 20_000) for i in range(100)] + [(100, long), (101, None)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get(common.BATCH_SETTING)
    try:
        for _, stage in (corpus_pipeline.STAGES[i] for i in (0, 1, 4)):
            spark.conf.unset(common.BATCH_SETTING)
            stage(spark, docs, sf)
            assert spark.conf.get(common.BATCH_SETTING) == str(common.BATCH_BYTES)

        def sizes(batches):
            for b in batches:
                yield b.slice(0, 1).select(["doc_id"]).append_column("n", [b.nbytes]).append_column("rows", [b.num_rows])

        got = rows.mapInArrow(sizes, "doc_id long, n long, rows long").collect()
        assert sum(r.rows for r in got) == 102 and sorted(r.n for r in got)[-2] <= 1.2 * common.BATCH_BYTES  # one holds the long text
        assert {r.doc_id: r.n_tokens for r in corpus_pipeline.encode(spark, rows, sf).collect()} == {**{i: 60_000 for i in range(100)}, 100: 1_500_000, 101: 0}
        for asked, kept in (("2m", "2m"), ("1gb", str(common.BATCH_BYTES)), ("4194304", "4194304")):
            spark.conf.set(common.BATCH_SETTING, asked)
            common.small_batches(spark)
            assert spark.conf.get(common.BATCH_SETTING) == kept
    finally:
        spark.conf.set(common.BATCH_SETTING, before)
