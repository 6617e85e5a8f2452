import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.llm import code_trie, integers, mean_search, textkit, winnowing

ITEMS = "item_id long, text string, own long, level string"
VECTORS = "vec_id long, embedding array<double>, label int"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_passages(docs, items, t=10):
    windows = {}
    for item_id, text in items:
        w = words_of(text)
        size = min(t, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item_id is None else str(item_id))
    sizes = {len(g) for g in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append((doc_id, len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=repr)


def found_passages(result):
    rows = result.collect()
    return sorted(((r.doc_id, r.n_words, tuple(i for s in r.spans for i in range(s.start, s.end)), tuple(r.item_ids)) for r in rows), key=repr)


def passage_fixture():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "x_y", "don't"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([10, 11, 14, 40]))) for k in range(12)]
    items += [(20, "ALPHA beta"), (21, "one two three four five six"), (22, "q"), (23, "a b a b a b a b a b a b"), (24, "z " * 15), (25, None), (26, "  ..."), (None, items[0][1])]
    items += [(3, text(12)), (30, items[1][1]), (31, items[1][1].upper() + "!")]
    docs = []
    for k in range(60):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            w = words_of(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1)
            parts += [", ".join(w[a : a + rng.randint(1, 25)]), text(rng.randint(0, 4))]
        docs.append((k, " ".join(parts)))
    docs += [(70, None), (71, ""), (72, "\n .,"), (73, "a b " * 300), (74, "z " * 500), (5, docs[5][1]), (5, "alpha, Beta"), (None, items[2][1]), (75, "Q")]
    return docs, items


def test_passages_match_brute_force(spark, make_docs):
    docs, items = passage_fixture()
    told = spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS)
    for gram in (6, 4):
        got = found_passages(winnowing.find_passages(make_docs(docs), told, window=10, gram=gram))
        assert got == brute_passages(docs, items)


def test_passage_in_a_text_longer_than_a_chunk(spark, make_docs):
    passage = " ".join(f"p{k}" for k in range(12))
    filler = "lorem " * (textkit.CHUNK_BYTES // 6 + 1000)
    docs = [(1, filler + passage + " " + filler), (2, passage), (3, filler)]
    told = spark.createDataFrame([(9, passage, 0, "")], ITEMS)
    rows = {r.doc_id: r for r in winnowing.find_passages(make_docs(docs), told).collect()}
    at = textkit.CHUNK_BYTES // 6 + 1000
    assert [tuple(s) for s in rows[1].spans] == [(at, at + 12)] and rows[1].n_words == 2 * at + 12
    assert [tuple(s) for s in rows[2].spans] == [(0, 12)] and rows[3].spans == []


def test_passages_of_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    rows = winnowing.find_passages(make_docs([(1, "some words"), (2, None)]), none).collect()
    assert sorted((r.doc_id, r.n_words, r.spans, r.item_ids) for r in rows) == [(1, 2, [], []), (2, 0, [], [])]
    told = spark.createDataFrame([(1, "some words", 0, "")], ITEMS)
    assert winnowing.find_passages(make_docs([(1, "x")]).where("false"), told).collect() == []


def test_a_passage_of_a_third_of_all_documents_is_joined_by_places_not_pairs(spark, make_docs):
    """Copies of an item are one class, so a common passage meets it once, and lists are made once."""
    rng = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(20))
    docs = [(k, " ".join(f"r{rng.random()}" for _ in range(5)) + (" " + passage if k % 3 == 0 else "")) for k in range(300)]
    items = spark.createDataFrame([(k, passage, 0, "") for k in range(50)], ITEMS)
    rows = winnowing.find_passages(make_docs(docs), items).collect()
    hit = [r for r in rows if r.spans]
    assert len(hit) == 100 and all(len(r.item_ids) == 50 and r.spans[0].end - r.spans[0].start == 20 for r in hit)


def test_winnowing_chooses_in_every_window_and_alike():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 5, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sums = textkit.WordSums(words)
    chosen, prints = winnowing.winnow(sums, np.array([0, 150, 150, 400]), 6, 5)
    for start in [*range(0, 141), *range(150, 391)]:
        assert any(start <= c <= start + 4 for c in chosen)
    shared = textkit.WordSums(words[37:47])
    (one,), (print_,) = winnowing.winnow(shared, np.array([0, 10]), 6, 5)
    assert 37 + one in chosen and print_ == prints[chosen == 37 + one][0]


def valid(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def whole(vector):
    return [math.floor(int(x) * 256 if abs(x) > 2**60 else 256 * x) for x in vector]


def square(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def brute_codes(rows, parts, entries, rounds):
    rows = sorted(valid(rows), key=lambda r: (r[0] is None, r[0], r[1]))
    length = len(rows[0][1])
    same = [(r[0], whole(r[1]), r[2]) for r in rows if len(r[1]) == length]
    edges = [p * length // parts for p in range(parts + 1)]
    books = [[r[1][edges[p] : edges[p + 1]] for r in same[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((square(part, e), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            cut = [r[1][edges[p] : edges[p + 1]] for r in same]
            best = [nearest(p, c)[1] for c in cut]
            book = []
            for k, old in enumerate(books[p]):
                mine = [c for c, b in zip(cut, best, strict=True) if b == k]
                book.append([sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else old)
            moved.append(book)
        books = moved
    out = [(r[0], None, None, r[2]) for r in rows if len(r[1]) != length]
    for vec_id, v, label in same:
        found = [nearest(p, v[edges[p] : edges[p + 1]]) for p in range(parts)]
        out.append((vec_id, "".join(f"{k:02x}" for _, k in found), min(sum(d for d, _ in found), integers.LARGEST), label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(out, key=repr), digest


def vector_rows(length, n=150, wild=False):
    rng = random.Random(length)
    rows = [(k, [rng.choice([rng.gauss(0, 0.3), rng.randint(-2, 2) / 8]) for _ in range(length)], k % 4 if k % 5 else None) for k in range(n)]
    rows += [rows[3], rows[3], (None, rows[4][1], 1), (7, rows[8][1], 2), (n, None, 1), (n + 1, [None] * length, 1), (n + 2, [math.nan] * length, 1)]
    rows += [(n + 3, [math.inf] + [0.0] * (length - 1), 1), (n + 4, [0.0] * (length + 1), 1), (n + 5, [], None), (n + 6, [0.0] * (length - 1) + [None], 0)]
    if wild:
        rows += [(k, [rng.gauss(0, 1) * 10.0**k for _ in range(length)], 1) for k in range(1, 60, 4)]
    return rows


@pytest.mark.parametrize(("length", "wild"), [(64, False), (32, True), (20, False), (5, False)])
def test_codes_match_brute_force(spark, length, wild):
    rows = vector_rows(length, wild=wild)
    want, digest = brute_codes(rows, 16, 12, 2)
    table = spark.createDataFrame(rows, VECTORS).withColumns({"code": F.lit("mine"), "row": F.lit(3)}).repartition(3)
    vectors = code_trie.prepare(table, 256)
    books = code_trie.train(vectors, parts=16, entries=12, rounds=2, scale=256)
    coded = code_trie.encode(vectors, books)
    assert set(coded.columns) == {"vec_id", "embedding", "label", "row", "code", "error"}
    got = sorted(((r.vec_id, r.code, r.error, r.label) for r in coded.collect()), key=repr)
    assert got == want and books.sha256() == digest
    sums = {}
    for _, _, error, label in want:
        if error is not None:
            sums[label] = min(sums.get(label, 0) + error, integers.LARGEST)
    summed = code_trie.with_label_error(code_trie.encode(vectors, books, keep=["vec_id", "label"])).collect()
    assert {r.label: r.label_error for r in summed} == sums and len(summed) == len(want)


def test_codes_of_few_and_no_vectors(spark):
    table = spark.createDataFrame([(5, [1.0] * 32, 1), (2, [2.0] * 32, None)], VECTORS)
    vectors = code_trie.prepare(table, 256)
    coded = code_trie.encode(vectors, code_trie.train(vectors)).collect()
    assert {(r.vec_id, r.code, r.error) for r in coded} == {(2, "00" * 16, 0), (5, "01" * 16, 0)}
    empty = code_trie.prepare(table.where("false"), 256)
    assert code_trie.train(empty) is None and code_trie.encode(empty, None).collect() == []


def test_trie_adds_up_shared_prefixes_once(monkeypatch):
    """Same result however many sibling nodes are taken at a time, and one step per node, not per part and dimension."""
    rng = np.random.default_rng(5)
    parts, _, _ = code_trie.distinct_rows(rng.integers(-3, 3, (500, 4)))
    entries = rng.integers(-3, 3, (9, 4))
    plain = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for nodes in (1, 7, 4096):
        monkeypatch.setattr(code_trie, "NODES", nodes)
        best, distance = code_trie.walk(parts, entries)
        assert (best == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def brute_clusters(rows, k, rounds, components):
    kept = [(r[0], whole(r[1])) for r in valid(rows) if len(r[1]) == components]
    drawn = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in drawn[:k]]

    def nearest(v):
        return min((square(v, c), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        best = [nearest(v)[1] for _, v in kept]
        moved = []
        for n, old in enumerate(centroids):
            mine = [v for (_, v), b in zip(kept, best, strict=True) if b == n]
            moved.append([sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else old)
        centroids = moved
    out = []
    for vec_id, v in kept:
        d, n = nearest(v)
        out.append((vec_id, n, min(d, integers.LARGEST), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("length", "wild"), [(64, False), (16, True)])
def test_clusters_match_brute_force(spark, length, wild):
    rows = vector_rows(length, wild=wild)
    want = brute_clusters(rows, 10, 5, length)
    table = spark.createDataFrame(rows, VECTORS).withColumns({"cluster": F.lit("mine"), "row": F.lit(3)}).repartition(3)
    got = mean_search.cluster(table, k=10, rounds=5, components=length).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got), key=repr) == want
    sums = {}
    for _, c, d, _ in want:
        sums[c] = min(sums.get(c, 0) + d, integers.LARGEST)
    assert {r.cluster: r.cluster_inertia for r in got} == sums
    assert {r.inertia for r in got} == {min(sum(d for _, _, d, _ in want), integers.LARGEST)}
    assert set(got[0].asDict()) == {"vec_id", "embedding", "label", "row", *mean_search.ADDED}


def test_clusters_of_few_and_no_vectors(spark):
    table = spark.createDataFrame([(5, [1.0] * 64, 1), (2, [2.0] * 64, None), (None, [1.1] * 64, 0)], VECTORS)
    got = mean_search.cluster(table, keep=["vec_id"]).collect()
    assert len(got) == 3 and {r.cluster for r in got} == {0, 1}
    assert mean_search.cluster(table.where("vec_id is null")).select("cluster", "inertia").collect() == [(None, None)]
    assert mean_search.cluster(table.where("false")).collect() == []


def test_search_rejects_by_means_and_deviations():
    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(0, 0.3, (2000, 64)) + 100 * rng.normal(0, 1, (2000, 1))).astype(np.int64)
    centroids = x[:40]
    number, distance, compared = mean_search.nearest(x, centroids)
    plain = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert compared < 0.7 * 2000 * 40
