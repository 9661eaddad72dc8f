"""The operators against brute force, exact round trips and held-out labels, and on odd tables."""

import collections
import hashlib
import importlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from rhythmica.llm import bagminhash, bpe, components, ctw, flatgraph, packing, quality, sharding, toxicity, vafile, warc
from rhythmica.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, size int, slot string, label string"
ODD = [(1, None, 1, "x", None), (2, "", 1, None, "a"), (3, "one two", 2, "", "b"), (3, "one two", 2, "", "b"), (None, "lost id", 0, "s", "c"), (5, "word " * 40_000, 9, "t", "d"), (6, "  \t\n ", 0, "u", "e"), (7, "Ünï \x00 日本", 0, "v", "f")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_bpe_decodes_a_text_in_several_queries(monkeypatch):
    own = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = ["", "some words of 日本 and more, " * 9, "a", "", "x y z " * 50]
    ids = own.encode(texts)
    for at_once in (1, 7, 100, 250_000):
        monkeypatch.setattr(bpe, "TOKENS_AT_ONCE", at_once)
        assert own.decode(ids) == [t.encode() for t in texts]
    assert own.decode([]) == [] and own.decode([b""]) == [b""]


def test_bpe_merges_a_piece_once(monkeypatch):
    own = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    merge, merged = own.merge, collections.Counter()
    monkeypatch.setattr(own, "merge", lambda pieces: merged.update(pieces) or merge(pieces))
    texts = ["of heatner. heatner, heatner", "of heatner; (heatner)", " heatner  heatner\nheatner", ""]
    ids = [x for t in texts for x in own.encode([t])]
    assert own.decode(ids) == [t.encode() for t in texts]
    assert merged[b" heatner"] == 1 and set(merged.values()) == {1}


def shingles(text):
    words = (text or "").encode().lower().split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) > 4 else collections.Counter([tuple(words)] if words else [])


def test_bpe_equals_tiktoken(spark, documents, odd):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = bpe.Codec(path, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    texts = [t or "" for _, t in documents] + [r[1] or "" for r in ODD] + ["a" * 3001, "=" * 99 + "ab" * 400, "a\t  b  c \n d", "don't\x1c  we'll"]
    ids = own.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [theirs.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]
    encoded = bpe.encode(odd, path, public_tokenizers.PATTERN)
    back = bpe.decode(encoded, path, public_tokenizers.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((r[1] or "").encode() for r in ODD)
    assert bpe.encode(odd.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_tree_weighs_to_a_distribution_and_matches_brute_force():
    texts = [b"abracadabra", b"", b"banana band", b"abba"]
    depth = 3
    grams = collections.Counter()
    for t in texts:
        padded = bytes([255] * depth) + t + bytes([255])
        for i in range(depth, len(padded)):
            grams[padded[i - depth : i][::-1], padded[i]] += 1  # context: last byte first

    def counts(context, bits):
        out = [0, 0]
        for (c, b), n in grams.items():
            code = format(b, "08b")
            if c.startswith(context) and code.startswith(bits):
                out[int(code[len(bits)])] += n
        return out

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(context, bits):
        own = kt(*counts(context, bits))
        if len(context) == depth:
            return own, own, own
        longer = {c[: len(context) + 1] for c, _ in grams if c.startswith(context)}
        product = sum(weighted(c, bits)[0] for c in longer)
        return np.logaddexp(own, product) - math.log(2), own, product

    def chance(context, byte):
        total, code = 0.0, format(byte, "08b")
        for k in range(8):
            p = None
            for d in range(depth, -1, -1):
                a = counts(context[:d], code[:k])
                own = (a[int(code[k])] + 0.5) / (sum(a) + 1)
                if p is None:
                    p = own if sum(a) else None
                else:
                    _, own_kt, product = weighted(context[:d], code[:k])
                    p = (math.exp(own_kt - product) * own + p) / (math.exp(own_kt - product) + 1)
            total += math.log(0.5 if p is None else p)
        return total

    keys, n = ctw.distinct(ctw.grams(texts, depth))
    asked = np.unique(np.concatenate([keys, ctw.grams([b"cab", b"abz"], depth)]))
    seen = dict(zip(keys.tolist(), n.tolist(), strict=True))
    n = np.array([seen.get(k, 0) for k in asked.tolist()])
    sums = ctw.top_sums(asked, n, depth)
    tops = ctw.top_tables(list(zip(*(sums[x].tolist() for x in ctw.TOP_NAMES), strict=True)))
    got = ctw.Subtrees(asked, n, depth, 2).code(tops)
    want = [chance(bytes([(k >> 24) & 255, (k >> 16) & 255, (k >> 8) & 255]), k & 255) for k in asked.tolist()]
    assert np.allclose(got, want, atol=1e-9)


def test_base_score_and_held_out_gain(spark, documents):
    rows = QUERIES["op5_context_tree_weighting"](spark, SF).collect()
    train, held = collections.Counter(), {}
    tokens = {d: [*(t or "").encode().translate(ctw.LOWER).split(), None] for d, t in documents}
    for d, words in tokens.items():
        held[d] = zlib.crc32(str(d).encode()) % 10 == 0
        if not held[d]:
            train.update(words)
    total = sum(train.values())
    assert len(rows) == len(documents)
    for r in rows:
        want = sum(math.log10((train[w] + 0.1) / (total + 0.1 * (len(train) + 1))) for w in tokens[r.doc_id])
        assert r.held_out == held[r.doc_id] and r.train_tokens == total and r.n_tokens == len(tokens[r.doc_id])
        assert r.n_known == sum(train[w] > 0 for w in tokens[r.doc_id]) and abs(r.base_score - want) < 1e-6 * abs(want)
    larger = QUERIES["op5_context_tree_weighting"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in larger) > sum(r.base_score for r in larger)


def test_near_classes_are_components_of_brute_force_links(spark, documents):
    bags = {d: shingles(t) for d, t in documents}
    top = {d: d for d in bags}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids, text = sorted(bags), dict(documents)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = text[a] is not None and text[a] == text[b]
            if same or (bags[a] and bags[b] and 5 * (bags[a] & bags[b]).total() >= 4 * (bags[a] | bags[b]).total()):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    got = {r.doc_id: r.class_id for r in QUERIES["op8_bagminhash_near_dedup"](spark, SF).collect()}
    assert got == {d: root(d) for d in ids}


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    a = [b" ".join(b"w%d" % w for w in rng.integers(0, 40, 300)) for _ in range(40)]
    b = [x + b" " + x[: 20 * i] for i, x in enumerate(a)]
    text, shingle, count = bagminhash.multisets(a + b)
    times = bagminhash.signatures(text, shingle, count, 80, 160)
    errors = []
    for i in range(40):
        x, y = shingles(a[i].decode()), shingles(b[i].decode())
        errors.append((times[i] == times[40 + i]).mean() - (x & y).total() / (x | y).total())
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


def test_large_neighbourhoods_are_finished_exactly(spark, monkeypatch):
    """Blocks of four texts: chains of near copies still become one class."""
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(30):
        words = [*words]
        words[(4 * i) % 120] = f"x{i}"  # a neighbour shares 0.87, the next but one 0.75
        rows.append((i, " ".join(words)))
    got = bagminhash.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_packing_fills_and_shrinks(spark, odd):
    rng = np.random.default_rng(0)
    pieces = sorted(rng.integers(1, 4097, 500).tolist(), reverse=True)
    bins, positions, capacity = packing.pack(pieces)
    fill, room = collections.Counter(), dict(enumerate(capacity))
    for p, b, at in zip(pieces, bins, positions, strict=True):
        assert at == fill[b]
        fill[b] += p
    assert all(room[b] == min(c for c in packing.LENGTHS if c >= fill[b]) for b in fill)
    assert sum(capacity) < 1.1 * sum(pieces)
    rows = packing.pack_documents(odd).collect()
    assert sum(r.length for r in rows) == sum(len((r[1] or "").split()) + 1 for r in ODD)
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_shards_are_even_gapless_and_keep_links(spark, odd):
    rows = [(i, f"text {i // 7}") for i in range(700)] + [(i, "hot") for i in range(700, 1000)] + [(i, f"own {i}") for i in range(1000, 1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    placed = sharding.balanced_shards(docs, 24)
    got = placed.collect()
    seats = collections.defaultdict(list)
    for r in got:
        seats[r.shard].append(r.slot)
        assert r.size == len(dict(rows)[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(dict(rows)[r.doc_id].encode())
    assert all(sorted(s) == list(range(len(s))) for s in seats.values()) and len(seats) == 24
    assert max(map(len, seats.values())) - min(map(len, seats.values())) <= 1
    by_hash = placed.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(24)))
    assert sharding.cut_links(placed, "link") < 0.95 * sharding.cut_links(by_hash, "link")
    small = sharding.balanced_shards(odd, 3).collect()
    assert len(small) == len(ODD) and sorted(collections.Counter(r.shard for r in small).values()) == [2, 3, 3]
    assert sharding.balanced_shards(odd.limit(0), 3).count() == 0


def test_archives_give_pages_back(spark):
    long = "ü" * 80
    rows = [(3, "http://a.example.com/x#f", long), (1, "https://u@b.example.com:8/y?z", long), (2, None, long), (4, "not a url\r\n", ""), (5, "http://a.example.com/x", None), (None, "http://a.example.com/", long), (4, "not a url\r\n", ""), (6, "http://A.example.com/x", "<p>\r\n\r\n</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).withColumn("key", F.lit("k"))
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_and_read(pages).collect()), key=str)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        again = len(body) >= 100 and page not in (None, 1)
        want.append((page or 0, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want, key=str)
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_index_finds_all_pages_of_a_key(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "LINES", 3)
    monkeypatch.setattr(warc, "CAPTURES", 10)
    rows = [(f"com,example)/{i // 5}", i, "f", i, 1) for i in range(60)]
    index = warc.build_index(spark.createDataFrame(rows, warc.LOCATOR), f"file://{tmp_path}")
    found = warc.lookup(index, spark.createDataFrame([("com,example)/3",), ("com,example)/none",)], "key string"))
    assert sorted(r.page_id for r in found.collect()) == list(range(15, 20))


def test_quality_and_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", F.col("toxic").alias("truth"))
    held = QUERIES["op4_quadratic_quality"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9 and all(0 <= r.score <= 1 for r in held)
    rows = QUERIES["op10_toxicity_chain"](spark, sf).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.truth for r in rows]) > 0.95


def test_models_on_odd_tables(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    some = spark.createDataFrame([(1, None, 1), (3, 1, 0), (3, 0, 0), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    for labels in (none, some):
        assert all(0 <= r.score <= 1 for r in quality.score(odd, labels).collect())
        assert toxicity.score(odd, labels).count() == len(ODD)
    assert quality.score(odd.limit(0), none).count() == 0 and toxicity.score(odd.limit(0), none).count() == 0
    assert bagminhash.near_classes(odd).count() == len(ODD) and bagminhash.near_classes(odd.limit(0)).count() == 0
    assert ctw.score(odd, F.lit(True)).count() == len(ODD) and ctw.score(odd.limit(0), F.lit(True)).count() == 0


def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 16))
    x = np.vstack([base, base[:40] + 0.03 * rng.normal(size=(40, 16)), base[:1] + 0.02 * rng.normal(size=(60, 16)), base[3:5]])
    rows = [(i, v.tolist(), int(i % 2 == 9)) for i, v in enumerate(x)]
    return rows, spark.createDataFrame([*rows, (900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [1.0] * 16, None), (904, [1.0, None], 0)], "vec_id bigint, embedding array<double>, label int")


def test_flat_graph_finds_links(spark, monkeypatch):
    monkeypatch.setattr(flatgraph, "SHARD", 80)
    rows, table = vectors(spark)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in flatgraph.near_vectors(table).collect()}
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.9 * near.sum()
    assert all(got[i].component_id == i and got[i].n_links == 0 for i in range(900, 905))
    assert flatgraph.near_vectors(table.limit(0)).count() == 0


def brute_force(x, limit=flatgraph.LIMIT):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= limit
    np.fill_diagonal(near, False)
    return near.sum(1)


@pytest.mark.parametrize("attempts, comparisons", [(4, 100_000), (1, 0)])
def test_flat_graph_finds_all_links_of_a_ball_over_many_shards(spark, monkeypatch, attempts, comparisons):
    monkeypatch.setattr(flatgraph, "SHARD", 12)
    monkeypatch.setattr(flatgraph, "ATTEMPTS", attempts)
    monkeypatch.setattr(flatgraph, "COMPARISONS", comparisons, raising=False)
    monkeypatch.setattr(flatgraph, "QUERIES", 100, raising=False)
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(1, 16)) + 0.15 * rng.normal(size=(300, 16)), rng.normal(size=(60, 16))])
    want = brute_force(x)
    assert want[:300].mean() > 200
    got = {r.vec_id: r for r in flatgraph.near_vectors(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, label int")).collect()}
    assert [got[i].n_links for i in range(len(x))] == want.tolist()
    assert len({got[i].component_id for i in np.flatnonzero(want[:300])}) == 1


def test_audit_counts_queries_with_links(spark, monkeypatch):
    monkeypatch.setattr(flatgraph, "QUERIES", 300, raising=False)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(2000, 32))
    x = np.vstack([base, base[:6] + 0.01 * rng.normal(size=(6, 32))])  # six pairs in 2,006 nodes
    y = np.vstack([x, base[100] + 0.01 * rng.normal(size=(50, 32))])  # and a ball of 51, all of it found
    schema = "label string, v array<double>, node bigint, n bigint"
    for vectors, found, want in ((x, [], 0.0), (x, [0, 2000, 1, 2001, 2, 2002], 0.5), (base, [], None), (y, [100, *range(2006, 2056)], 51 / 63)):
        nodes = spark.createDataFrame([("a", v.tolist(), i, 1) for i, v in enumerate(vectors)], schema)
        true = brute_force(vectors)
        links = spark.createDataFrame([(i, int(true[i]) if i in found else 0) for i in range(len(vectors))], "node bigint, links bigint")
        got = flatgraph.audit(nodes, links, flatgraph.LIMIT, len(vectors))
        assert got == (want if want is None else pytest.approx(want))


def test_centroids_of_one_label_come_from_many_tasks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(20, 16))
    x = np.repeat(centre, 100, axis=0) + 0.05 * rng.normal(size=(2000, 16))
    nodes = spark.createDataFrame([("a", v.tolist(), i, 1) for i, v in enumerate(x)] + [("b", [1.0] * 16, 9000, 1)], "label string, v array<double>, node bigint, n bigint").repartition(8)
    asked = []
    nearest = flatgraph._nearest
    monkeypatch.setattr(flatgraph, "ENTRIES", 100)
    small = nearest(x, centre, 3)
    assert (small == np.argsort(-(x @ centre.T), axis=1, kind="stable")[:, :3]).all()
    monkeypatch.setattr(flatgraph, "_assigned", lambda tables, f=flatgraph._assigned: asked.append({k: len(v) for k, v in tables.items()}) or f(tables))
    tables = flatgraph.centroids(nodes, 50)
    assert list(tables) == ["a"] and len(tables["a"]) == 40 and len(asked) == flatgraph.STEPS
    assert np.allclose(np.linalg.norm(tables["a"], axis=1), 1)
    # tasks see slices: their sums are those of the whole
    once = {k: v.copy() for k, v in tables.items()}
    rows = list(flatgraph._assigned(once)(iter(nodes.select("label", "v").toArrow().to_batches(max_chunksize=7))))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ once["a"].T).argmax(axis=1)
    for batch in rows:
        for r in batch.to_pylist():
            assert np.allclose(r["c"], unit[near == r["shard"]].sum(axis=0))
    dealt = flatgraph.in_shards(nodes, 50, 2).collect()
    assert len(dealt) == 2001 and all(len(r.shards) == (2 if r.label == "a" else 1) for r in dealt)


def test_flat_graph_links_every_length_of_a_label(spark):
    rows = [(i, [1.0, 2.0, 3.0 + 0.01 * i], 1) for i in range(4)] + [(10, [1.0, 2.0], 1), (11, [1.0, 2.0], 1), (12, [1.0, 2.01], 1), (13, [3.0, -1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in flatgraph.near_vectors(table).collect()}
    assert got == {i: (3, 0) for i in range(4)} | {i: (2, 10) for i in (10, 11, 12)} | {13: (0, 13)}


def test_top_k_equals_brute_force(spark):
    rows, table = vectors(spark)
    ints = {i: [math.floor(256 * c) for c in v] for i, v, _ in rows} | {903: [256] * 16, 901: [0] * 16}
    want = set()
    for q in ints:
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)[:5]
            want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in vafile.top_k(table, F.col("vec_id") % 10 == 0, 5, block=7).collect()} == want
    assert vafile.top_k(table.limit(0), F.lit(True), 5).count() == 0


def test_top_k_with_very_many_copies_and_unequal_lengths(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, [0.5, -0.25, 0.75]) for i in range(400)]  # a hot vector
    rows += [(1000 + i, rng.normal(size=3).tolist()) for i in range(150)]
    rows += [(2000 + i, rng.normal(size=2 + 3 * (i % 2)).tolist()) for i in range(60)]
    rows += [(3000, []), (3000, []), (3001, [9.0]), (3001, [9.0]), (3010, [1.0, 2.0]), (3010, [-1.0, 5.0]), (None, [1.0]), (3020, None), (3030, [1.0, None])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, ids string, num int").repartition(7)
    ints = {(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if i is not None and v is not None and None not in v}
    first = {}
    for i, v in ints:
        first[i] = min(first.get(i, (9e9,) * 5), v + (0,) * (5 - len(v)))
    want = set()
    for q, x in first.items():
        if q % 10 == 0:
            best = sorted({(-sum(a * b for a, b in zip(x, v)), i) for i, v in ints if i != q})[:5]
            want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    monkeypatch.setattr(vafile, "READ", 2)
    candidates = []
    settled = vafile.settled
    monkeypatch.setattr(vafile, "settled", lambda df, purpose: candidates.append(settled(df, purpose)) or candidates[-1])
    assert {tuple(r) for r in vafile.top_k(table, F.col("vec_id") % 10 == 0, 5, block=20).collect()} == want
    scanned = sum(c.count() for c in candidates if c.columns == ["query_id", "num", "upper", "lower"])
    assert scanned < 60 * len({q for q, *_ in want})  # not copies times queries
    assert vafile.top_k(table.where("vec_id = 3000"), F.lit(True), 5).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 60), (60, 50), (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(21)} | {50: 50, 60: 50}


def test_pipeline_stages_drop_and_keep(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == list(pipeline.COLUMNS)
        assert 0 < kept.count() <= docs.count()
        docs = kept
    last = pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_judges_rows_and_keeps_all_without_a_model(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*pipeline.COLUMNS)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality.score(docs, labels)
    good = scored.where("predicted = 1").first().doc_id
    bad = scored.where("predicted = 0").first().doc_id
    texts = {r.doc_id: r.text for r in docs.where(F.col("doc_id").isin(good, bad)).collect()}
    words = " ".join(f"w{i}" for i in range(60))
    more = [(None, texts[good], None, None, None), (None, texts[bad], "en", "s", 1), (good, texts[bad], "en", "s", 1), (-9, words, "en", "s", 1), (-9, words + " end", "en", "s", 1), (None, words, "en", "s", 1), (-8, None, "en", "s", 1), (-8, "", "en", "s", 1)]
    table = docs.unionByName(spark.createDataFrame(more, docs.schema))
    verdict = {r.text: r.predicted == 1 for r in table.select("doc_id", "text").join(quality.score(table, labels).select("doc_id", "predicted"), "doc_id").where("doc_id > 0").collect() if r.text not in (texts[good], texts[bad])}
    kept = collections.Counter(map(tuple, pipeline.good_quality(spark, table, SF).select("doc_id", "text").collect()))
    assert kept[(None, texts[good])] == 1 and kept[(good, texts[good])] >= 1
    assert not kept[(None, texts[bad])] and not kept[(good, texts[bad])]
    assert {t for t, yes in verdict.items() if yes} <= {t for _, t in kept}
    spark.createDataFrame([], labels.schema).write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (pipeline.good_quality, pipeline.not_toxic):
        assert stage(spark, table, str(tmp_path)).count() == table.count()
    near = collections.Counter((r.doc_id, r.text) for r in pipeline.one_of_each(spark, spark.createDataFrame(more[3:], docs.schema), SF).collect())
    assert sum(near.values()) == 3 and {i for i, _ in near} == {-9, -8} and near[(-8, None)] == near[(-8, "")] == 1


def test_stars_of_edges():
    rng = np.random.default_rng(5)
    for nodes, edges in ((50, 20), (200, 180), (400, 390)):
        u, v = rng.integers(0, nodes, edges), rng.integers(0, nodes, edges)
        least = {i: i for i in range(nodes)}
        for _ in range(edges):
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                least[a] = least[b] = min(least[a], least[b])
        got = dict(zip(*(x.tolist() for x in components.stars(u, v)), strict=True))
        assert got == {a: b for a, b in least.items() if a != b}
    assert [len(x) for x in components.stars(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]
