import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.llm import queries, quality, toxicity, trees
from gridpanel.llm.common import fold, read

TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "a b c a b c a b c"),
    (5, "same line\nother\nsame line\n\n\nsame line"),
    (5, "same line\nother\nsame line\n\n\nsame line"),
    (None, "x<y & z*#$%|>\x0bw\x0cv\r\n é ü"),
    (7, "word " * 3000),
    (8, "the cat\n \n \nthe cat\nThe cat"),
    (9, "　wide space stays inside"),
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_counts_match_brute_force(make_docs):
    rows = quality.document_stats(make_docs(TEXTS)).collect()
    got = sorted((str(r.doc_id), *[r[c] for c in quality.COUNTS]) for r in rows)
    assert got == sorted((str(i), *brute(t)) for i, t in TEXTS)


def test_counts_of_a_whole_table(spark, folder):
    docs = read(spark, folder, "documents")
    got = {r.doc_id: tuple(r[c] for c in quality.COUNTS) for r in queries.op10_quality_rules(spark, folder).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_base_rules_override_the_trees(make_docs, spark):
    stats = quality.document_stats(make_docs(TEXTS))
    labels = spark.createDataFrame([(7, 1), (4, 0), (99, 1), (8, None)], "doc_id long, quality int")
    out = {str(r.doc_id): r for r in quality.judge(stats, quality.train(stats, labels)).collect()}
    assert out["7"].base_failed and not out["7"].kept  # 100 % repeats
    assert all(not r.kept for r in out.values() if r.base_failed)
    assert out["1"].base_failed and out["2"].base_failed


def test_empty_tables(make_docs, spark):
    docs = make_docs([(1, "x")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    stats = quality.document_stats(docs)
    assert quality.judge(stats, quality.train(stats, labels)).count() == 0
    assert quality.keep_documents(docs, labels).count() == 0
    assert toxicity.score(docs, toxicity.train(docs, labels, F.lit(True))).count() == 0


def test_kept_documents_keep_their_columns(make_docs, spark):
    good = " ".join(f"w{i}" for i in range(80))
    docs = make_docs([(1, good), (2, "short"), (3, None), (1, good)])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.keep_documents(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1]


def test_trees_obey_monotonic_constraints_and_match_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] + 0.3 * rng.normal(size=600) > 0) ^ (x[:, 1] > 1)).astype(float)
    model = trees.fit(x, y, np.array([1, 0, -1]), rounds=30)
    grid = np.repeat(rng.normal(size=(20, 3)), 50, axis=0)
    for j, sign in ((0, 1), (2, -1)):
        moved = grid.copy()
        moved[:, j] = np.tile(np.linspace(-3, 3, 50), 20)
        steps = np.diff(model.raw(moved).reshape(20, 50), axis=1)
        assert (sign * steps >= -1e-12).all()

    def walk(row):
        total = model.bias
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
            total += model.value[node]
        return total

    assert np.allclose(model.raw(x[:40]), [walk(r) for r in x[:40]])
    assert ((model.probability(x) > 0.5) == y).mean() > 0.85


def test_trees_without_both_classes_are_the_base_rate():
    model = trees.fit(np.zeros((4, 2)), np.ones(4), np.zeros(2, int))
    assert np.allclose(model.probability(np.zeros((3, 2))), 5 / 6)


@pytest.fixture
def planted(make_docs, spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = [f"w{k}" for k in rng.integers(0, 400, 60)]
        if bad:
            words[10:12] = ["Nasty!", "horrid,"]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    return make_docs([*rows, (1000, None), (1001, ""), (None, "nasty horrid")]), spark.createDataFrame([*labels, (5000, 1), (7, None)], "doc_id long, toxic int")


def test_toxic_words_are_learnt_from_positives_and_unlabelled_text(planted):
    docs, labels = planted
    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 3) != 1)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = [i for i in range(600) if out[i].predicted != (i % 5 == 0)]
    assert not wrong
    assert out[1000].score == out[1001].score < 0.3 and out[None].predicted == 1


def test_held_out_labels_do_not_matter(planted):
    docs, labels = planted
    held = fold(F.col("doc_id"), 3) == 1
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.train(docs, x, ~held) for x in (labels, flipped))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_no_positives_gives_the_prior(planted):
    docs, labels = planted
    model = toxicity.train(docs, labels.where("toxic = 0"), F.lit(True))
    assert not model.weights.any() and toxicity.score(docs, model).where("predicted = 1").count() == 0


def test_toxicity_query_on_held_out_rows(spark, folder):
    out = queries.op1_toxicity(spark, folder)
    assert out.count() == read(spark, folder, "documents").count()
    assert set(out.columns) >= {"doc_id", "held_out", "score", "predicted"}
    assert out.where("score < 0 or score > 1 or (score >= 0.7) <> (predicted = 1)").count() == 0


def test_slopes_are_those_of_the_risk():
    """Against finite differences of the risk written down plainly, on both sides of the correction."""
    rng = np.random.default_rng(3)
    n_p, n_u, prior = 7, 12, 0.3
    soft = lambda v: np.log1p(np.exp(v))

    def negative(f):
        return soft(f[n_p:]).mean() - prior * soft(f[:n_p]).mean()

    def risk(f):
        return prior * soft(-f[:n_p]).mean() + negative(f)

    def slopes(of, f, h=1e-6):
        unit = np.eye(len(f)) * h
        return np.array([(of(f + u) - of(f - u)) / (2 * h) for u in unit])

    spread = rng.normal(size=n_p + n_u)
    assert negative(spread) > 0
    assert np.allclose(toxicity.risk_slopes(spread, n_p, n_u, prior), slopes(risk, spread), atol=1e-7)
    fitted = np.concatenate([np.full(n_p, 4.0), np.full(n_u, -6.0)]) + 0.1 * spread
    assert negative(fitted) < 0
    assert np.allclose(toxicity.risk_slopes(fitted, n_p, n_u, prior), slopes(lambda f: -negative(f), fitted), atol=1e-7)
