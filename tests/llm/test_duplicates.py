import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.llm import components, lookup, minhash, suffix_dedup
from gridpanel.llm.components import connected_components


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < k:
        return {(len(words), *words)} if words else set()
    return {(k, *words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_groups(rows, k, percent):
    """Component of each row as the set of row numbers in it."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def family_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for size in (2, 3, 9, 30):
        base = [rng.choice(words) for _ in range(120)]
        for k in range(size):
            own = list(base)
            for _ in range(k and rng.randint(1, 7)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((n, " ".join(own)))
            n += 1
    for _ in range(40):
        rows.append((n, " ".join(rng.choice(words) for _ in range(rng.randint(1, 90)))))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "One"), (n + 4, "oNE"), (n + 5, "one two"), (n + 6, "Two ONE"), (3, rows[40][1]), (None, rows[41][1]), (None, "lonely null")]
    rows += [(n + 7, "x " * 20_000), (n + 8, "x " * 30_000), rows[5], rows[5]]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"most": 3, "small": 3, "block": 4}])
@pytest.mark.parametrize("words", [2, 5])
def test_groups_match_brute_force(make_docs, words, sizes):
    rows = family_rows()
    roots, sets = brute_groups(rows, words, 80)
    ids = {}
    for (i, _), r in zip(rows, roots):
        ids.setdefault(r, []).append(i)
    named = {r: min((i for i in own if i is not None), default=None) for r, own in ids.items()}
    expected = sorted((str(i), len(s), str(named[r])) for (i, _), r, s in zip(rows, roots, sets))
    out = minhash.near_duplicates(make_docs(rows).select("doc_id", "text"), words, 80, **sizes).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == expected
    assert sum(r.kept_row for r in out) == len(ids)


def test_keep_one(make_docs):
    rows = family_rows()
    docs = make_docs(rows)
    roots, _ = brute_groups(rows, 5, 80)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert minhash.keep_one(docs.limit(0)).count() == 0


def test_links_at_the_threshold(make_docs):
    words = [f"a{i}" for i in range(101)]  # 100 two-word shingles
    four_fifths = words[:81]  # 80 of them: similarity 0.80
    less = words[:80]  # 79
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(make_docs([(2, " ".join(words)), (1, " ".join(four_fifths))]), 2, 80).collect()}
    assert out == {1: 1, 2: 1}
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(make_docs([(2, " ".join(words)), (1, " ".join(less))]), 2, 80).collect()}
    assert out == {1: 1, 2: 2}


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(2)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    lowest = minhash.minima(np.concatenate([common, a, common, b]), np.array([900, 900]))
    packed = minhash.pack_bits(lowest)
    assert abs(minhash.estimate(packed[:1], packed[1:])[0] - 0.8) < 0.2
    assert minhash.estimate(packed[:1], packed[:1])[0] == 1


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 60)] + [(70, 70), (8, 7)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_small_graphs_take_few_and_small_writes(spark, monkeypatch):
    # with many shuffle partitions that are not merged, rounds and files of a small table cost more than its rows
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    written, write = [], components.stage

    def watched(df, label, *rows):
        out = write(df, label, *rows)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(components, "stage", watched)
    edges = [(i, i + 1) for i in range(1000, 1400)] + [(7, k) for k in range(8, 400)]
    expected = {i: 1000 for i in range(1000, 1401)} | {i: 7 for i in range(7, 400)}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for parts in (1, 7):
            written.clear()
            out = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(parts)).collect()
            assert {r.node: r.component for r in out} == expected and len(out) == len(expected)
            assert (parts > 1 or len(written) <= 2) and max(written) <= max(parts, spark.sparkContext.defaultParallelism)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_components_match_one_search_whatever_the_pieces(spark, monkeypatch):
    monkeypatch.setattr(components, "PIECE", 5)
    rng = np.random.default_rng(6)
    edges = np.concatenate([rng.integers(0, 400, (260, 2)), [(k, k + 1) for k in range(500, 560)], [(9, 700 + k) for k in range(40)]])
    edges = np.concatenate([edges, edges[:50]])
    label = components.smallest_reached(800, edges[:, 0], edges[:, 1])
    nodes = np.unique(edges[edges[:, 0] != edges[:, 1]])
    spread = spark.createDataFrame(edges.tolist(), "a long, b long").repartition(9)
    out = connected_components(spread).collect()
    assert sorted((r.node, r.component) for r in out) == [(n, label[n]) for n in nodes.tolist()]


def test_the_smallest_reached_names_each_group():
    order = np.random.default_rng(7).permutation(20_000)
    label = components.smallest_reached(20_000, order[:-1], order[1:])
    assert not label.any()
    rng = np.random.default_rng(8)
    for n in range(1, 60):
        a, b = rng.integers(0, n, (2, n // 2))
        label = components.smallest_reached(n, a, b)
        assert (label[a] == label[b]).all() and (label <= np.arange(n)).all() and (label[label] == label).all()


def brute_cut(rows, length):
    first = {}
    lowest = -(1 << 63)
    for i, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            first[w] = min(first.get(w, 1 << 63), lowest if i is None else i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < (lowest if i is None else i):
                gone[p : p + length] = b"\1" * length
        spans, p = [], 0
        for m in re.finditer(rb"\x01+", bytes(gone)):
            spans.append((m.start(), m.end()))
        out.append((str(i), len(raw), tuple(spans), bytes(c for c, g in zip(raw, gone) if not g)))
    return sorted(out)


def passage_rows():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("ab cdé\n") for _ in range(n))
    passages = [text(n) for n in (45, 48, 60, 130, 400)]
    rows = [(k, text(rng.randint(0, 120)) + rng.choice(passages) + text(rng.randint(0, 90)) + rng.choice(passages)) for k in range(40)]
    rows += [(100, None), (101, ""), (102, "short"), (103, "a" * 700), (104, "b" + "a" * 300), (105, "ab" * 200), (106, "ab" * 60), (None, passages[3]), (7, passages[4]), (107, passages[4]), rows[3], rows[3]]
    rows += [(200 + k, passages[2] + passages[3][:70] + str(k)) for k in range(25)]
    return rows


@pytest.mark.parametrize("batches_per_salt", [1, 256])
@pytest.mark.parametrize("length", [50, 20])
def test_repeats_match_brute_force(make_docs, length, batches_per_salt):
    rows = passage_rows()
    out = suffix_dedup.remove_repeats(make_docs(rows), length, batches_per_salt).collect()
    got = sorted((str(r.doc_id), r.n_bytes, tuple((s["from"], s["to"]) for s in r.spans), bytes(r.kept)) for r in out)
    assert got == brute_cut(rows, length)


def test_no_repeats_without_documents(make_docs):
    assert suffix_dedup.remove_repeats(make_docs([(1, "x")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(make_docs([(1, "x")]), length=8)


def test_window_numbers_stand_for_the_bytes():
    raw = np.frombuffer(b"abcabcabcabcabcabcabcabcabcabcXabcabcabcabcabcabcabcabcabc", np.uint8)
    for length in (8, 9, 13, 20):
        numbers = suffix_dedup.window_numbers(raw, length)
        windows = [bytes(raw[p : p + length]) for p in range(len(raw) - length + 1)]
        for p, a in enumerate(windows):
            for q, b in enumerate(windows):
                assert (numbers[p] == numbers[q]) == (a == b)


def test_lookup_answers_in_order(spark):
    keys = {0: [1, 5, 9], 1: [5, 6], 2: [9]}
    batches = [lookup.request(0, g, np.zeros(len(k), np.int64), np.array(k, np.uint64), np.ones(len(k))) for g, k in keys.items()]
    asked = spark.createDataFrame([r for b in batches for r in b.to_pylist()], lookup.REQUEST)
    model = lookup.merged(asked, groups=100).collect()
    assert lookup.unpack_keys(model[0]["keys"]).tolist() == [1, 5, 6, 9]
    assert lookup.unpacked(model[0]["counts"], "<i8").tolist() == [1, 2, 1, 2]
    valued = lookup.merged(asked, groups=100).selectExpr("kind", "bucket", "keys", "counts as values")
    out = {r.group: lookup.unpacked(r["values"], "<i8").tolist() for r in lookup.answers(asked, valued, 100, {0: "<i8"}).collect()}
    assert out == {0: [1, 2, 2], 1: [2, 1], 2: [2]}


def test_each_pair_of_blocks_meets_once(spark, monkeypatch):
    # one candidate component of documents that share 7 of 8 shingles each and are not linked: almost all stay
    # outside its largest cluster, and one of their first shingles is common to all
    rows = [(k, 1, f"a b c d e f g h w{k}") for k in range(40)] + [(40, 1, "a b c d e f g h w3")]
    members = spark.createDataFrame(rows, "node long, component long, text string")
    pairs, compare = [], minhash._compare_tasks

    def watched(tasks, words, percent):
        sides = tasks.groupBy("task").agg(F.sort_array(F.collect_set(F.pmod(F.xxhash64("node"), F.lit(6)))).alias("blocks"), F.max("side").alias("side"))
        pairs.append([tuple(r.blocks) for r in sides.where("side = 1").collect()])
        return compare(tasks, words, percent)

    monkeypatch.setattr(minhash, "_compare_tasks", watched)
    links = minhash.confirmed_links(members, 2, 80, small=7, block=7).collect()
    assert {tuple(sorted((r.a, r.b))) for r in links if r.a != r.b} == {(3, 40)}
    assert pairs[-1] and len(pairs[-1]) == len(set(pairs[-1]))


def test_documents_of_one_template_do_not_meet(spark, monkeypatch):
    # 14 of 20 shingles from the template: nearly all of one candidate component is not linked, five documents are
    template = " ".join(f"t{i}" for i in range(15))
    rows = [(k, 1, template + "".join(f" w{k}_{i}" for i in range(6))) for k in range(400)]
    rows += [(400 + k, 1, f"{rows[7][2]} z{k}") for k in range(5)]
    members = spark.createDataFrame(rows, "node long, component long, text string")
    sizes, compare = [], minhash._compare_tasks

    def watched(tasks, words, percent):
        sizes.append(tasks.select("node").distinct().count())
        return compare(tasks, words, percent)

    monkeypatch.setattr(minhash, "_compare_tasks", watched)
    links = minhash.confirmed_links(members, 2, 80, small=40, block=20).select("a", "b")
    out = {r.node: r.component for r in connected_components(links).collect()}
    assert out == {7: 7} | {400 + k: 7 for k in range(5)}
    assert len(sizes) == 4 and sizes[-1] <= 6
