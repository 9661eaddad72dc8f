"""Line-first cleaning, collocations and tokenizer alignment against plain loops, and on odd tables."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rhythmica.llm import alignment, collocations, linefirst

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, n int, phrase string, key string, words string"
SENTENCE = "the old man and the sea went down to the shore, and the old man sat. "
ODD = [
    (1, None, "en", 1, "a", None, ""),
    (2, "", "en", 2, "b", "k", None),
    (3, SENTENCE * 4, None, 3, None, "k", "w"),
    (3, SENTENCE * 4, None, 3, None, "k", "w"),
    (None, "lost id, the old man. " * 20, "en", 4, "c", "k", "w"),
    (5, "word\x0bother\rthird. " * 20_000, "de", 5, "d", "k", "w"),
    (6, " \t\n \n\n", "de", 6, "e", "k", "w"),
    (7, "Ünï \x00 日本。 x▁y <|endoftext|>  two  spaces\n" * 30, "", 7, "f", "k", "w"),
    (8, "Home | News | Sport | More | Help\n" + "A line of plain words that ends well.\n" * 2 + " ".join(f"w{i}" for i in range(60)) + ".", "en", 8, "g", "k", "w"),
    (9, "Great!! Buy!! Now!! Today!! Yes!!\n" * 30, "en", 9, "h", "k", "w"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3)


def as_table(rows):
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[2]) for r in rows])
    return con


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def plain_line_first(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_line_first_matches_a_plain_loop_and_sql(spark, odd):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = linefirst.clean_lines(odd)
    assert ordered(got.select(*columns).collect()) == ordered((r[0], *plain_line_first(r[1])) for r in ODD)
    con = as_table(ODD)
    names = [c for c in got.columns if c != "clean_text"]
    assert ordered(got.select(*names).collect()) == ordered(con.sql(f"SELECT {', '.join(names)} FROM ({linefirst.SQL})").fetchall())
    assert linefirst.clean_lines(odd.limit(0)).count() == 0


def test_line_first_removes_lines_and_rejects(odd):
    got = {r.doc_id: r for r in linefirst.clean_lines(odd).collect()}
    assert got[8].kept and got[8].n_lines == 4 and got[8].n_kept_lines == 2 and "Home" not in got[8].clean_text
    assert got[8].clean_text.split("\n")[0] == "A line of plain words that ends well."
    assert not got[9].kept and got[9].kept_words == 0 and got[9].clean_text == ""
    assert not got[1].kept and not got[2].kept and got[1].base_failed


def test_line_first_keeps_good_and_rejects_bad_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").dropDuplicates(["doc_id"])
    rows = linefirst.clean_lines(docs).where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 0.05 * n.get((0, False), 1)


def plain_collocations(rows, least, top=2000, cover=80):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").encode().lower().decode()):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {c: a for c, a in f.items() if len(c[1]) > 1 and a >= least}
    best = collections.defaultdict(list)
    for (lang, ws), a in candidates.items():
        inside = [b for (l2, o), b in candidates.items() if l2 == lang and len(o) > len(ws) and any(o[i : i + len(ws)] == ws for i in range(len(o)))]
        if any(100 * b >= cover * a for b in inside):
            continue
        cuts = [(2_000_000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        best[lang].append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return {(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, found in best.items() for i, x in enumerate(sorted(found)[:top])}


@pytest.mark.parametrize("bucket_rows", [1_000_000, 50])
def test_collocations_match_a_plain_loop(spark, odd, monkeypatch, bucket_rows):
    monkeypatch.setattr(collocations, "BUCKET_ROWS", bucket_rows)  # small buckets: many words are hot
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(60).collect()] + [r[:3] for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    got = {tuple(r) for r in collocations.collocations(docs, least=8).collect()}
    assert got == plain_collocations(rows, 8)
    assert len(got) > 50
    assert collocations.collocations(odd.limit(0)).count() == 0


def test_collocations_match_sql_on_odd_rows(odd):
    got = collocations.collocations(odd).collect()
    assert ordered(got) == ordered(as_table(ODD).sql(collocations.SQL).fetchall()) and got


def test_quicksort_counts_every_prefix():
    rng = np.random.default_rng(3)
    words = rng.integers(1, 5, (4, 3000))
    for d in range(1, 4):
        words[d:, rng.random(3000) < 0.1] = 0
    weight = rng.integers(1, 4, 3000)
    want = collections.Counter()
    for i in range(3000):
        for d in range(1, 5):
            if words[d - 1, i]:
                want[tuple(words[:d, i])] += int(weight[i])
    got = {tuple(words[:d, i]): n for i, d, n in collocations.frequent_prefixes(words, weight, 40)}
    assert got == {k: n for k, n in want.items() if n >= 40}


A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_alignment(texts):
    """Per text its measures, two tokens compared at a time."""
    a_side, b_side = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    a_side.encode_special_tokens = True
    letters = alignment._byte_levels()

    def one(text):
        if not text:
            return None
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        pieces = [b_side.id_to_piece(i) for i in b]
        a_bytes = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            return None
        links, groups, now, i, j, x, y = [], [], ([], []), 0, 0, len(a_bytes[0]), len(b_bytes[0])
        now[0].append(a[0])
        now[1].append(b[0])
        while True:
            links.append((a[i], b[j]))
            if x == y:
                groups.append(now)
                now = ([], [])
            move_a, move_b = x <= y, y <= x
            if move_a:
                i += 1
                if i == len(a):
                    break
                x += len(a_bytes[i])
                now[0].append(a[i])
            if move_b:
                j += 1
                y += len(b_bytes[j])
                now[1].append(b[j])
        written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        return len(a), len(b), len(groups), links, hashlib.sha256(written.encode()).hexdigest()

    found = [one(t) for t in texts]
    count = collections.Counter(pair for x in found if x for pair in set(x[3]))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(*x[:3], len(x[3]), sum(count[p] == best[p[0]] for p in x[3]), sum(count[p] for p in x[3]), x[4]) if x else (0,) * 6 + ("",) for x in found]


@pytest.mark.parametrize("pattern", [None, public_tokenizers.PATTERN])
def test_alignment_matches_a_plain_loop(spark, monkeypatch, pattern):
    monkeypatch.setattr(alignment, "SLICE", 20_000)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80).collect()]
    rows = [(i, t, "clash") for i, t in rows] + [(r[0], r[1], r[5]) for r in ODD] + [(900 + i, "the same short text", None) for i in range(400)]
    rows += [(2000, "a" * 3000, "x"), (2001, "don't\x1c  we'll ﬁx <s> it é", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string").repartition(4)
    got = alignment.align(docs, A_FILE, B_FILE, pattern).collect()
    assert ordered(got) == ordered((r[0], *m) for r, m in zip(rows, plain_alignment([r[1] for r in rows]), strict=True))
    assert sum(r.n_links > 0 for r in got) > 450
    empty = alignment.align(docs.limit(0), A_FILE, B_FILE, pattern)
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_quick_encoder_is_refused_where_ids_are_not_the_order_of_merges(tmp_path):
    import json

    with open(A_FILE, encoding="utf-8") as f:
        stated = json.load(f)
    stated["model"]["merges"] = stated["model"]["merges"][::-1]
    (tmp_path / "odd.json").write_text(json.dumps(stated))
    entries = alignment.Tokens(A_FILE, B_FILE).a_bytes
    assert alignment._quick_encoder(str(tmp_path / "odd.json"), public_tokenizers.PATTERN, entries) is None
    assert alignment._quick_encoder(A_FILE, public_tokenizers.PATTERN, entries) is not None


def test_edges_of_one_group_over_many_tasks_become_a_tree(spark):
    from rhythmica.llm import components
    from rhythmica.session import settled

    rng = np.random.default_rng(1)
    nodes = 2000
    edges = []
    for _ in range(32):  # in each of 32 deals the nodes meet in stars of about 250
        deal = rng.permutation(nodes)
        edges += [(int(max(x, part[0])), int(min(x, part[0]))) for part in np.array_split(deal, 8) for x in part[1:]]
    df = spark.createDataFrame(edges, "u bigint, v bigint").repartition(211)
    assert components.gathered(settled(components.contracted(df), "edges")).count() <= nodes - 1
    found = components.components(df, "u", "v").collect()
    assert len(found) == nodes and {r.component for r in found} == {0}


def test_repeated_vector_ids_give_a_row_each(spark):
    from rhythmica.llm import flatgraph

    rows = [(1, [1.0, 0.0], "a", 7), (1, [0.0, 1.0], "a", 7), (2, [1.0, 0.01], "a", 7), (1, [1.0, 0.0], "a", 7), (3, None, "a", 7), (3, [0.0, 0.0], "a", 7), (4, [1.0, None], "a", 7), (5, [1.0, 0.0], None, 7)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string, node int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in flatgraph.near_vectors(df).collect())
    assert got == [(1, 0, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (3, 0, 3), (4, 0, 4), (5, 0, 5)]
