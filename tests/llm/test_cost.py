"""What a piece of work takes: memory and numbers of steps, not seconds."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridpanel.llm import context_trees, lookup, mixing, quality, suffix_dedup, textkit, topk


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_counts_of_a_large_batch_stay_in_small_arrays():
    text = "Some words, 12 of them; and one more line\n" * 60
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": [text] * 2000})
    list(textkit.powers(1))

    def work():
        for _, _, raw, at in textkit.chunks(batch):
            quality._count(raw, at)

    work()
    assert _peak(work) < 20 << 20  # arrays of 2 MB pieces took more than 100 MB


def test_flags_are_counted_in_any_range():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 127, 128, 1000):
        flags = rng.random(n) < 0.4
        at = np.sort(np.concatenate([[0, n, n], rng.integers(0, n + 1, 20)]))
        expected = np.concatenate([[0], np.cumsum(flags)])
        assert (textkit.before(flags, at) == expected[at]).all()
        assert (textkit.per_row(flags, at) == np.diff(expected[at])).all()


def test_slots_are_permuted_without_lambdas(spark, make_docs):
    docs = make_docs([(k, "some words of a text " * (k % 5), f"s{k % 3}") for k in range(30)])
    assert "aggregate(sequence" not in mixing.mix(docs)._jdf.queryExecution().optimizedPlan().toString()
    for n in (1, 2, 7, 1000):
        size, keys = F.lit(n).cast("long"), [F.col("id") % 3]
        both = mixing.permuted(spark.range(n), "new", F.col("id"), size, keys, 5).withColumn("old", mixing.permute(F.col("id"), size, keys, 5))
        assert [r.new == r.old for r in both.collect()] == [True] * n


def test_words_are_counted_between_white_space(make_docs):
    texts = [None, "", " ", "a", " a\tb\r\n c\x0bd\x0ce ", "\n\n", "\xe9\xa0x y z", "a  b"]
    got = make_docs(list(enumerate(texts))).select("doc_id", mixing.count_words(F.col("text"))).collect()
    assert [n for _, n in sorted(got)] == [0, 0, 0, 1, 5, 0, 2, 2]


def test_keys_are_counted_by_sorts():
    rng = np.random.default_rng(2)
    keys, flags = rng.integers(0, 50, 400).astype(np.uint64), rng.random(400) < 0.5
    found, counts = lookup.merge(*lookup.counted(keys, flags))
    assert found.tolist() == sorted(set(keys.tolist())) == lookup.distinct(keys).tolist()
    assert counts.tolist() == [int(flags[keys == k].sum()) for k in found]
    values = rng.random(len(found))
    assert (context_trees._values_of(keys, found, values) == values[np.searchsorted(found, keys)]).all()
    empty = np.zeros(0, np.uint64)
    assert not len(lookup.merge(*lookup.counted(empty, np.zeros(0, bool)))[0]) and not len(lookup.distinct(empty))


def test_pairs_left_after_the_bounds_are_not_copied():
    rng = np.random.default_rng(3)
    q, x = (np.floor(256 * rng.standard_normal((512, 64))) for _ in range(2))
    arguments = (np.arange(512) + 1000, np.arange(512), np.arange(512), 5)
    found = []
    assert _peak(lambda: found.append(topk.top_of_block(q, x, *arguments))) < 12 << 20  # 40 MB and more with a copy per pair
    scores = np.sort(q @ x.T, axis=1)[:, :-6:-1]
    assert (found[0].score.reshape(512, 5) == scores).all()


def test_ranges_are_refined_in_small_pieces():
    key = np.repeat(np.arange(1000), 4)
    pieces = suffix_dedup.key_pieces(key, np.full(4000, 250))
    assert len(pieces) >= 7 and all(key[a - 1] != key[a] for a, _ in pieces[1:])
    values = np.random.default_rng(4).integers(0, 90, 300).astype(np.uint64)
    assert (suffix_dedup.ranks(values) == np.unique(values, return_inverse=True)[1]).all()
    assert not len(suffix_dedup.ranks(values[:0]))
