from collections import Counter

import pytest
from test_duplicates import brute_groups
from test_lines_and_mixing import brute_lines

import corpus_pipeline
from gridpanel.llm import quality
from gridpanel.llm.common import read, stage


@pytest.fixture(scope="module")
def outputs(spark, folder):
    """Input and output of every stage, each written and read again."""
    docs, out = read(spark, folder, "documents"), []
    for name, function in corpus_pipeline.STAGES:
        result = stage(function(spark, docs, folder), "test-pipeline")
        out.append((docs, result))
        docs = result
    return out


def test_stages_and_columns(outputs, spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "minhash near-dedup", "mixing", "best-fit packing"]
    columns = read(spark, folder, "documents").columns
    assert all(result.columns == columns for _, result in outputs[:-1])


def test_quality_stage(outputs, spark, folder):
    docs, kept = outputs[0]
    stats = stage(quality.document_stats(docs), "test")
    judged = quality.judge(stats, quality.train(stats, read(spark, folder, "labels")))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in judged.where("kept").collect()}
    assert 0 < kept.count() < docs.count()


def test_line_stage(outputs):
    docs, out = outputs[1]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((i, t) for i, _, _, t in brute_lines(rows, 10))


def test_near_duplicate_stage(outputs):
    docs, out = outputs[2]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    roots, _ = brute_groups(rows, 5, 80)
    first = {}
    for (i, _), r in zip(rows, roots):
        first[r] = min(i, first.get(r, i))
    assert sorted(r.doc_id for r in out.collect()) == sorted(first.values())


def test_mixing_stage(outputs):
    docs, out = outputs[3]
    words = {r.doc_id: (r.source, r.text.split()) for r in docs.collect()}
    taken, per_doc = Counter(), Counter()
    for r in out.collect():
        source, own = words[r.doc_id]
        assert r.source == source and r.n_chars == len(r.text) and not Counter(r.text.split()) - Counter(own)
        taken[source] += len(r.text.split())
        per_doc[r.doc_id] += len(r.text.split())
    assert all(n <= 3 * len(words[i][1]) for i, n in per_doc.items())
    total = sum(len(w) for _, w in words.values())
    assert abs(sum(taken.values()) - total) < 0.05 * total


def test_packing_stage(outputs):
    docs, out = outputs[4]
    assert sum(r.length for r in out.collect()) == sum(len(r.text.split()) for r in docs.collect())


def test_run_gives_the_same_rows(outputs, spark, folder):
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, outputs[-1][1].collect()))
