import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridpanel.llm import line_dedup, minhash, mixing, queries
from gridpanel.llm.common import read

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def brute_lines(rows, least):
    docs = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add((i, text))
    gone = {k for k, d in docs.items() if k and len(d) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


ROWS = [
    (1, "Common\nown one\n  COMMON\t\n"),
    (2, "common\r\nÉté\nx"),
    (3, "été\ncommon"),
    (4, None),
    (5, ""),
    (6, "\n\n\n"),
    (7, "Common"),
    (7, "Common"),
    (7, "other text under the same id\ncommon"),
    (None, "common\nnull id"),
    (9, "\n".join(["common"] * 300 + ["tail"] + ["filler %d" % i for i in range(200)] + ["common"])),
    (10, " common"),
]


@pytest.mark.parametrize("least", [1, 2, 5])
def test_lines_match_brute_force(make_docs, least):
    docs = make_docs(ROWS)
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_docs=least))
    got = sorted(((r.doc_id, r._n_lines, r._n_dropped, r._kept) for r in out.collect()), key=str)
    assert got == brute_lines(ROWS, least)
    assert out.columns[: len(docs.columns)] == docs.columns


def test_first_occurrence_can_stay(make_docs):
    docs = make_docs([(3, "a\nb"), (1, "c\na\na"), (2, "a")])
    out = {r.doc_id: r.text for r in line_dedup.drop_lines(docs, min_docs=2, keep_first=True).collect()}
    assert out == {1: "c\na", 2: "", 3: "b"}


def test_bitmaps_store_only_words_with_dropped_lines(make_docs):
    text = "\n".join(["own %d" % i for i in range(200)] + ["shared"])
    rows = line_dedup.keep_bitmaps(make_docs([(1, text), (2, "shared")]), min_docs=2).collect()
    assert {r._doc: [(w.word, ~w.bits) for w in r.keep] for r in rows} == {1: [(3, 1 << 8)], 2: [(0, 1)]}


def test_drop_lines_keeps_columns_and_empty_tables(make_docs):
    docs = make_docs(ROWS)
    out = line_dedup.drop_lines(docs, min_docs=2)
    assert out.schema.simpleString() == docs.schema.simpleString() and out.count() == len(ROWS)
    assert line_dedup.drop_lines(docs.limit(0), min_docs=2).count() == 0


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(most * sizes[s]) for s in over}


def mixture(docs):
    return mixing.mix(docs, block_words=8, shard_slots=16)


@pytest.fixture
def skewed(make_docs):
    rows = []
    for k in range(150):
        source = "hot" if k % 3 else f"s{k % 21}"
        rows.append((k, " ".join(["w"] * (k * 7 % 60)) or None, source))
    rows += [(900, "tiny words", "tiny"), (901, "a b c d e f g", None), (902, "", "void"), (903, "é à x", "Ünder"), (950, "same row", "s1"), (950, "same row", "s1")]
    return make_docs(rows)


def test_targets_match_the_iterated_rule(skewed):
    got = mixture(skewed).join(skewed.select("doc_id", "source").distinct(), "doc_id").collect()
    sizes = Counter()
    for r in skewed.collect():
        sizes[r.source] += len((r.text or "").split(" ")) if r.text else 0
    expected = brute_targets({s: sizes[s] for s in sizes})
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])


def test_mix_meets_targets_and_limits(skewed):
    rows = mixture(skewed).collect()
    assert len(rows) == skewed.count()
    taken, target, size = Counter(), {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        key = (r.source_size, r.target)
        taken[key] += r.taken
        target[key] = r.target
        assert r.taken == sum((s["to"] - s["from"]) * s.times for s in r.spans or [])
    for k, t in target.items():
        assert abs(taken[k] - t) <= 8 * 2, (k, taken[k])
    again = mixture(skewed.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        out = spark.range(n).select(mixing.permute(F.col("id"), F.lit(n).cast("long"), [F.lit(3)], 5).alias("p"))
        assert sorted(r.p for r in out.collect()) == list(range(n))


def test_materialized_copies_hold_what_is_taken(skewed):
    mixed = mixture(skewed)
    out = mixing.materialize(skewed, mixed)
    assert out.columns == skewed.columns
    words = sum(len(r.text.split(" ")) for r in out.where("doc_id <> 903").collect())
    assert words == sum(r.taken for r in mixed.where("doc_id <> 903").collect())


def test_mix_of_nothing(skewed):
    assert mixture(skewed.limit(0)).count() == 0
    assert mixing.materialize(skewed.limit(0), mixture(skewed.limit(0))).count() == 0


def test_mixing_query(spark, folder):
    rows = queries.op7_mixing(spark, folder).collect()
    docs = {r.doc_id: r for r in read(spark, folder, "documents").collect()}
    assert {r.doc_id for r in rows} == set(docs) and all(r.taken <= 3 * r.size for r in rows)
    taken, target = Counter(), {}
    for r in rows:
        taken[docs[r.doc_id].source] += r.taken
        target[docs[r.doc_id].source] = r.target
    assert all(abs(taken[s] - target[s]) <= 100 for s in target)


def test_line_query_digest(spark, folder):
    docs = [(r.doc_id, r.text) for r in read(spark, folder, "documents").collect()]
    got = {r.doc_id: r.kept_sha256 for r in queries.op2_line_dedup(spark, folder).collect()}
    assert got == {i: hashlib.sha256(kept.encode()).hexdigest() for i, _, _, kept in brute_lines(docs, 10)}


HELPERS = ["_row", "_doc", "_id", "_in", "_key", "keep", "n_dropped", "_kept", "_n_lines", "size", "spans", "taken", "_time", "_words", "_chosen", "block", "index", "start", "a.b"]


def test_columns_named_like_helpers_come_back_unchanged(spark):
    """Documents whose extra columns are called what the operators call theirs."""
    rows = [(k, f"shared line\nown line {k % 4} of some words\nx", "s", *[f"{c}{k}" for c in HELPERS]) for k in range(12)] + [(3, None, None, *HELPERS)]
    names = ["doc_id", "text", "source", *HELPERS]
    docs = spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    extra = {(r[0], r[3:]) for r in rows}

    def extras(out):
        got = out.collect()
        assert out.columns == names
        return [(r[0], tuple(r[3:])) for r in got], got

    found, got = extras(line_dedup.drop_lines(docs, min_docs=10))
    assert len(found) == 13 and set(found) == extra and all("shared" not in (r.text or "") for r in got)
    marked = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_docs=10))
    assert marked.columns == [n for n in names if n not in ("_kept", "_n_lines")] + ["_n_lines", "_n_dropped", "_kept"]
    found, _ = extras(minhash.keep_one(docs, words=2, percent=80))
    assert set(found) <= extra and len(found) == len(set(found)) == 5
    plain = docs.drop("a.b")
    mixed = mixing.materialize(plain, mixing.mix(plain, block_words=4))
    assert mixed.columns == plain.columns and {(r[0], tuple(r[3:])) for r in mixed.collect()} <= {(i, e[:-1]) for i, e in extra}
