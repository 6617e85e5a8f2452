"""Texts longer than a chunk of the byte-array operators (2 MB), next to short ones."""

import random

import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_groups
from test_quality_and_toxicity import brute

from gridpanel.llm import minhash, mixing, quality, suffix_dedup, textkit, toxicity


@pytest.fixture
def texts():
    rng = random.Random(6)
    words = [rng.choice(("é", "A", "b#")) + str(rng.randrange(60_000)) for _ in range(400_000)]
    long = " ".join(words)
    assert len(long) > textkit.CHUNK_BYTES
    changed = " ".join(words[:200_000] + ["new"] * 3 + words[200_000:])
    return [(1, "short text\nshort text"), (2, long), (3, None), (4, changed), (5, long[:300]), (6, "short text\nshort text")]


def test_counts(make_docs, texts):
    rows = quality.document_stats(make_docs(texts)).collect()
    assert sorted((r.doc_id, *[r[c] for c in quality.COUNTS]) for r in rows) == [(i, *brute(t)) for i, t in texts]


def test_groups(make_docs, texts):
    roots, sets = brute_groups(texts, 5, 80)
    first = {}
    for (i, _), r in zip(texts, roots):
        first.setdefault(r, i)
    out = minhash.near_duplicates(make_docs(texts), 5, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == [(i, len(s), first[r]) for (i, _), s, r in zip(texts, sets, roots)]


def test_repeats(make_docs, texts):
    out = {r.doc_id: r for r in suffix_dedup.remove_repeats(make_docs(texts)).collect()}
    long, changed = (t.encode() for i, t in texts if i in (2, 4))
    # a copy with three words more: all but the strings that reach into them go
    same = next(k for k in range(len(long)) if long[k] != changed[k])
    tail = next(k for k in range(1, len(long)) if long[-k] != changed[-k]) - 1
    assert [(s["from"], s["to"]) for s in out[4].spans] == [(0, same), (len(changed) - tail, len(changed))]
    assert not out[2].spans and bytes(out[5].kept) == b"" and bytes(out[2].kept) == long


def test_scores_and_mix(make_docs, spark, texts):
    nasty = " ".join(f"{w} horrid" for w in ["nasty"] * 3)
    docs = make_docs([*texts, *[(k, f"w{k} {nasty}") for k in range(10, 30)], *[(k, f"w{k} fine") for k in range(30, 90)], (99, texts[1][1] + " nasty horrid")])
    model = toxicity.train(docs, spark.createDataFrame([(k, 1) for k in range(10, 28)] + [(k, 0) for k in range(30, 80)], "doc_id long, toxic int"), F.lit(True))
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert out[99].predicted == out[28].predicted == 1 and out[2].predicted == out[3].predicted == 0
    assert {r.doc_id: r["size"] for r in mixing.mix(docs).collect() if r.doc_id < 7} == {1: 4, 2: 400_000, 3: 0, 4: 400_003, 5: len(texts[4][1].split()), 6: 4}
