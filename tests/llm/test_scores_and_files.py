import io
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridpanel.llm import context_trees, packing, token_files, topk
from gridpanel.llm.common import fold

# --- exact top-k


def brute_top(rows, k):
    valid = [(i, v, n) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    scaled = [(i, [math.floor(256 * float(np.float32(x))) for x in v], n) for i, v, n in valid]
    out = []
    for i, v, n in scaled:
        if i % 50 == 0:
            held = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
            found = sorted((-held(sum(a * b for a, b in zip(v, w))), j, m) for j, w, m in scaled if m != n and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4, 1024])
def test_top_k_matches_brute_force(spark, block):
    rng = random.Random(1)
    rows = [(n, [rng.gauss(0, 1) for _ in range(7)]) for n in range(130)]
    rows += [(1000 + n, rows[3][1]) for n in range(20)]  # ties
    rows += [(150, [0.0] * 7), (200, None), (201, [None] + [1.0] * 6), (202, [math.nan] * 7), (203, [math.inf] * 7), (None, [1.0] * 7)]
    rows += [(250, [1.0, 2.0]), (251, [2.0, 2.0]), (300, []), (301, []), (350, [1e30] * 7), (50, rows[50][1]), (400, [1.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("own", F.lit("x")).withColumn("task", F.lit(1))
    out = topk.top_k(frame, F.col("vec_id") % 50 == 0, 5, candidate_block=block, query_block=block)
    assert sorted(tuple(r) for r in out.collect()) == brute_top(rows, 5)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(0)
    q, x = rng.normal(size=(30, 20)), rng.normal(size=(40, 20))
    for s in (1, 3, 4, 20, 50):
        bound = topk.segment_features(q, s) @ topk.segment_features(x, s).T
        assert (bound >= q @ x.T - 1e-9).all()


# --- context trees


def brute_ctw(train, texts):
    """log10 probability of each text by a direct recursion over all contexts."""
    depth = context_trees.DEPTH
    counts = Counter()

    def steps(text):
        raw = b"\xff" * depth + text.encode() + b"\xff"
        for p in range(depth, len(raw)):
            prefix = 1
            for k in range(8):
                bit = raw[p] >> (7 - k) & 1
                yield raw[p - depth : p], prefix, bit
                prefix = prefix << 1 | bit

    children = {}
    for text in train:
        for context, prefix, bit in steps(text):
            for d in range(depth + 1):
                counts[context[depth - d :], prefix, bit] += 1
                if d:
                    children.setdefault((context[depth - d + 1 :], prefix), set()).add(context[depth - d :])

    def kt(s, prefix):
        a, b = counts[s, prefix, 0], counts[s, prefix, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    known = {}

    def weighted(s, prefix):
        if (s, prefix) not in known:
            own = kt(s, prefix)
            if len(s) < depth:
                below = sum(weighted(c, prefix) for c in children.get((s, prefix), ()))
                own = np.logaddexp(own, below) - math.log(2)
            known[s, prefix] = own
        return known[s, prefix]

    def predict(context, prefix, bit):
        p = None
        for d in range(depth, -1, -1):
            s = context[depth - d :]
            seen = counts[s, prefix, 0] + counts[s, prefix, 1]
            own = (counts[s, prefix, bit] + 0.5) / (seen + 1)
            if p is None or not deeper:
                p = own
            else:
                w = math.exp(kt(s, prefix) - math.log(2) - weighted(s, prefix))
                p = w * own + (1 - w) * p
            deeper = seen > 0
        return p

    return [sum(math.log10(predict(*step)) for step in steps(t)) for t in texts]


CORPUS = ["the cat sat on the mat", "the dog sat", "a cat, a dog; THE end", "äöü the", "", None, "the cat sat on the mat", "zebra 123\nnew line", "mat " * 90]


def test_scores_match_a_direct_recursion(make_docs):
    rows = [(k, t) for k, t in enumerate(CORPUS)] + [(None, "null id"), (3, "again")]
    out = context_trees.score(make_docs(rows), fold(F.col("doc_id"), 7) != 2).collect()
    trains = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    train = [t or "" for i, t in rows if trains(i)]
    assert 0 < len(train) < len(rows)
    words = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    c = Counter(w for t in train for w in words(t))
    n, v = sum(c.values()), len(c)
    expected = []
    for (i, t), score in zip(rows, brute_ctw(train, [t or "" for _, t in rows])):
        own = words(t)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
        expected.append((str(i), len(own), sum(c[w] > 0 for w in own), n, base, score))
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out)
    for a, b in zip(got, sorted(expected)):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-5)


def test_scores_without_training_texts(make_docs):
    docs = make_docs([(1, "ab"), (2, None)])
    out = {r.doc_id: r for r in context_trees.score(docs, F.lit(False)).collect()}
    assert out[1].score == pytest.approx(24 * math.log10(0.5)) and out[2].score == pytest.approx(8 * math.log10(0.5))
    assert out[1].n_known == 0 and out[1].train_tokens == 0 and out[1].base_score == 0
    assert context_trees.score(docs.limit(0), F.lit(True)).count() == 0


def test_gamma_and_kt():
    z = np.array([0.5, 1.0, 1.5, 7.25, 16.0, 1e3, 1e9])
    assert np.allclose(context_trees.log_gamma(z), [math.lgamma(x) for x in z], rtol=1e-12, atol=1e-10)
    assert np.allclose(np.exp(context_trees.log_kt(np.array([0.0, 1, 1, 2]), np.array([0.0, 0, 1, 0]))), [1, 1 / 2, 1 / 8, 3 / 8])


def test_held_out_text_of_the_language_scores_better_than_noise(make_docs):
    rng = random.Random(3)
    words = "alpha beta gamma delta epsilon".split()
    rows = [(k, " ".join(rng.choice(words) for _ in range(60))) for k in range(60)]
    noise = [(100 + k, "".join(rng.choice("qxzjkvw ") for _ in range(300))) for k in range(3)]
    out = context_trees.score(make_docs(rows + noise), F.col("doc_id") < 50).collect()
    bits = {r.doc_id: -r.score / math.log10(2) / 300 for r in out}
    assert max(bits[k] for k in range(50, 60)) < 1 < min(bits[k] for k in range(100, 103))


# --- token files


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


PIECES = st.sampled_from(["a", " ", "  ", "\n", "\t", "the", "don't", "é", " ", "　", "42", "!?", "<|endoftext|>", "x\u0085y", "日本", "\r\n"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=4))
def test_cached_encoding_is_the_tokenizer_s(tokenizer, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    parts = [t.encode() for t in texts]
    raw, at = np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    for end in (None, 2):
        ids, counts = token_files.encoder(tokenizer).encode(raw, at, end)
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []
        assert got == [[*e, *([] if end is None else [end])] for e in expected]


def test_encoder_forgets_words_when_its_table_is_full(tokenizer, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "CACHE_WORDS", 5)
    made, plain = token_files.Encoder(tokenizer), Tokenizer.from_file(tokenizer)
    for k in range(6):
        text = " ".join(f"word{k}{j}, again" for j in range(4))
        ids, _ = made.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids and len(made.hashes) <= 5 + 8


def test_round_trip(make_docs, spark, tokenizer, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    rows = [(5, "five words are in here"), (1, None), (2, ""), (9, "a b\n\nc  d"), (None, "null id"), (5, "same id"), (7, "long " * 5000), (3, "x"), (3, "x")]
    manifest = token_files.write_tokens(make_docs(rows), tokenizer, 2, str(tmp_path))
    out = token_files.read_documents(spark, manifest, str(tmp_path)).collect()
    plain = Tokenizer.from_file(tokenizer)
    ids = lambda t: [*plain.encode(t or "", add_special_tokens=False).ids, 2]
    crc = lambda t: zlib.crc32(np.array(ids(t), "<u4").tobytes())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in out) == sorted((str(i), len(ids(t)), crc(t)) for i, t in rows)
    ordered = sorted(out, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered[:-1]]).tolist()
    assert [-1 if r.doc_id is None else r.doc_id for r in ordered] == [-1, 1, 2, 3, 3, 5, 5, 7, 9]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]
    empty = token_files.write_tokens(make_docs(rows).limit(0), tokenizer, 2, str(tmp_path))
    assert token_files.read_documents(spark, empty, str(tmp_path)).count() == 0


def test_long_texts_and_small_frames(make_docs, spark, tokenizer, tmp_path):
    """A text longer than an encoder's chunk, frames closed inside and between batches."""
    from tokenizers import Tokenizer

    rows = [(k, f"some words number {k} " * (k % 7) + "end") for k in range(200)] + [(500, "lorem ipsum, " * 400_000 + "x")]
    manifest = token_files.write_tokens(make_docs(rows), tokenizer, 2, str(tmp_path), frame_ids=100)
    frames = manifest.collect()
    assert sum(f.documents for f in frames) == len(rows) and all(f.first_doc <= f.last_doc for f in frames)
    assert sum(f.tokens < 100 for f in frames) <= len({f.file for f in frames})
    plain = Tokenizer.from_file(tokenizer)
    got = {r.doc_id: r.ids for r in token_files.read_documents(spark, manifest, str(tmp_path), with_ids=True).collect()}
    assert got == {i: [*plain.encode(t, add_special_tokens=False).ids, 2] for i, t in rows}


def test_only_frames_of_the_documents_asked_for_are_read(make_docs, spark, tokenizer, tmp_path):
    rows = [(k, f"document {k} " * 20) for k in range(300)] + [(None, "no id"), (77, "same id")]
    manifest = token_files.write_tokens(make_docs(rows), tokenizer, 2, str(tmp_path), frame_ids=500)
    whole = token_files.read_documents(spark, manifest, str(tmp_path)).collect()
    wanted = spark.createDataFrame([(5,), (77,), (None,), (5,), (9999,)], "doc_id long")
    frames = manifest.collect()
    needed = {(f.path, f.frame) for f in frames for i in (5, 77, token_files.NULL_ID) if f.first_doc <= i <= f.last_doc}
    assert len(needed) < len(frames) / 2
    for path in {f.path for f in frames}:
        with open(path, "r+b") as file:
            reader = token_files.Reader(file, (tmp_path / path).stat().st_size)
            for f in frames:
                if f.path == path and (path, f.frame) not in needed:
                    file.seek(int(reader.starts[f.frame]) + 4)
                    file.write(b"damaged!")
    got = token_files.read_documents(spark, manifest, str(tmp_path), wanted).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in whole if r.doc_id in (5, 77, None)) and len(got) == 4
    with pytest.raises(Exception, match="."):
        token_files.read_documents(spark, manifest, str(tmp_path)).collect()


def test_seek_table_has_the_public_layout():
    stream = io.BytesIO()
    writer = token_files.Writer(stream)
    frames = [([1, token_files.NULL_ID], [1, 0], [1]), ([7], [3], [5, 6, 2]), ([8], [1000], [2] * 1000)]
    frames = [tuple(np.array(x) for x in f) for f in frames]
    for f in frames:
        writer.add(*f)
    writer.close()
    raw = stream.getvalue()
    assert zstandard.ZstdDecompressor().decompressobj().decompress(raw) == token_files.frame(*frames[0])  # plain readers see frames
    number, descriptor, magic = struct.unpack("<IBI", raw[-9:])
    assert (number, descriptor, magic) == (3, 0x80, 0x8F92EAB1)
    table = raw[-9 - 12 * number - 8 :]
    assert struct.unpack("<II", table[:8]) == (0x184D2A5E, 12 * number + 9)
    at = 0
    for k, f in enumerate(frames):
        packed, size, check = struct.unpack_from("<III", table, 8 + 12 * k)
        content = zstandard.ZstdDecompressor().decompress(raw[at : at + packed])
        assert content == token_files.frame(*f) and len(content) == size and xxhash.xxh64_intdigest(content) & 0xFFFFFFFF == check
        at += packed
    assert at + 8 + 12 * number + 9 == len(raw)


def test_readers_need_only_the_frames_they_ask_for():
    stream = io.BytesIO()
    writer = token_files.Writer(stream)
    for f in [([1, token_files.NULL_ID], [1, 0], [1]), ([7], [3], [5, 6, 2]), ([8], [1000], [2] * 1000)]:
        writer.add(*(np.array(x) for x in f))
    writer.close()
    raw = stream.getvalue()
    reader = token_files.Reader(io.BytesIO(raw), len(raw))
    ids, counts, tokens = token_files.read_frame(reader.content(1))
    assert (ids.tolist(), counts.tolist(), tokens.tolist()) == ([7], [3], [5, 6, 2])
    damaged = bytearray(raw)
    damaged[reader.starts[1] + reader.entries[1][0] - 6] ^= 1
    broken = token_files.Reader(io.BytesIO(bytes(damaged)), len(damaged))
    assert len(broken.content(0)) == len(reader.content(0))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken.content(1)
    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(raw[:-1]), len(raw) - 1)


# --- packing


def brute_pack(lengths, capacities):
    """The same rule with a plain scan over open sequences (the last opened of equals first)."""
    bins = []
    for k, n in enumerate(lengths):
        fits = [b for b in bins if b["room"] >= n]
        if fits:
            least = min(b["room"] for b in fits)
            chosen = max((b for b in fits if b["room"] == least), key=lambda b: b["touched"])
        else:


            def laid_in(size):
                left = size - n
                for other in lengths[k + 1 :]:
                    left -= other if other <= left else 0
                return size - left

            size = min((c for c in capacities if c >= n), key=lambda c: (capacities[c] / laid_in(c), c))
            chosen = {"room": size, "used": 0}
            bins.append(chosen)
        chosen["room"] -= n
        chosen["used"] += n
        chosen["touched"] = k
    return sorted(b["used"] for b in bins), sorted(min((c for c in capacities if c >= b["used"]), key=lambda c: (capacities[c], c)) for b in bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_packing_matches_a_plain_scan(lengths):
    capacities = {10: 11.0, 20: 20.5, 40: 41.0}
    lengths = sorted(lengths, reverse=True)
    bins, offsets, final = packing.pack(np.array(lengths, np.int64), capacities)
    used = np.bincount(bins, lengths, len(final)).astype(int)
    assert (sorted(used.tolist()), sorted(final.tolist())) == brute_pack(lengths, capacities)
    for b in range(len(final)):
        spans = sorted((offsets[k], lengths[k]) for k in np.flatnonzero(bins == b))
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans[:-1]]).tolist()


def test_lengths_are_chosen_by_what_fills_them():
    """Pieces that fill a short length but not a long one get short sequences; small pieces make long ones worth it."""
    lengths = lambda pieces: sorted(packing.pack(np.array(pieces), packing.CAPACITIES)[2].tolist())
    assert lengths([510] * 3) == [512, 1024] and lengths([1020] * 3) == [1024, 2048]
    assert lengths([2040]) == [2048] and lengths([3000, 900, 50]) == [4096]
    assert lengths([1000] * 4 + [90] + [1] * 6) == [4096] and lengths([1000] * 3 + [600]) == [1024, 1024, 2048]


def test_documents_are_packed_whole(make_docs):
    rows = [(k, "w " * (k * 37 % 900)) for k in range(60)] + [(100, None), (101, " \n"), (102, "w " * 10_000), (None, "w w"), (4, "other text"), (6, "w " * 222), (6, "w " * 222)]
    docs = make_docs(rows)
    out = packing.pack_documents(docs, shard_tokens=5000).collect()
    total, places = Counter(), {}
    for r in out:
        total[r.doc_id] += r.length
        assert r.length <= r.capacity and r.capacity in packing.CAPACITIES
        places.setdefault((r.sequence, r.capacity), []).append((r.offset, r.length))
    words = Counter()
    for i, t in rows:
        words[i] += len((t or "").split())
    assert total == Counter({i: n for i, n in words.items() if n})
    for (_, capacity), spans in places.items():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans[:-1]]).tolist() and sum(n for _, n in spans) <= capacity
    again = packing.pack_documents(docs.repartition(5), shard_tokens=5000).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert packing.pack_documents(docs.limit(0)).count() == 0
    assert packing.pack_documents(docs, length=F.length("text")).agg(F.sum("length")).first()[0] == sum(len(t or "") for _, t in rows)


def test_the_word_table_is_small_and_sorted():
    import public_tokenizers

    coder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for first in (0, 500, 100):
        texts = [f"word{k} and w{k * 7}x" for k in range(first, first + 400)]
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
        ids, counts = coder.encode(raw, at, 2)
        want = [[*coder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    assert len(coder.hashes) > 1000 and (np.diff(coder.hashes) > 0).all()
    assert coder.begin.itemsize + coder.length.itemsize <= 8
