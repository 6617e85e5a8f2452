"""Scoring text by context-tree weighting over bytes, and by a unigram base of words.

Model: a byte is eight binary decisions; each decision (a node of the byte's
code tree) has a context tree over the DEPTH bytes before it. Every context
keeps a Krichevsky-Trofimov estimate of its decisions and is mixed with its
longer contexts, weight one half each, over all depths: P_w = (P_kt + product
of the children's P_w) / 2. With the counts of the training texts fixed, a
byte's code length is that of the mixture's eight predictions. A context never
seen in training leaves the prediction to the next shorter one. Texts start
after DEPTH bytes 0xFF and end with one; 0xFF occurs in no UTF-8 text.

Work: documents are dealt into groups of about 16 MB of text. Each group sends
its distinct byte strings (DEPTH bytes and the next one) and words, with their
training counts, to buckets: strings by the two bytes nearest to the predicted
one, so that a bucket holds whole subtrees. Counts are merged in two levels
(salted, then by bucket), the trees of a bucket are weighted, and the two
shortest depths, at most 65,280 rows whatever the input, are settled on the
driver. Every group gets the values of its strings and words back in the order
in which it asked, and sums them per document. The two passes derive the same
groups from a hash of each row, so nothing but values has to come back.

Defined results: null and empty texts have the end only; rows that repeat a
doc_id are scored one by one; without training texts every prediction is one
half and the base has no counts; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import lookup, textkit
from gridpanel.llm.common import row_id, stage, text_bytes
from gridpanel.llm.minhash import sorted_groups

DEPTH = 5
GROUP_BYTES = 16 << 20
#: So many keys of a group are sorted at a time.
SORT_KEYS = 1 << 21
STRINGS, WORDS = 0, 1
VALUES = {STRINGS: "<f4", WORDS: "<f8"}
ONE = np.uint64(1)
BYTE = np.uint64(8)


def byte_strings(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end: the DEPTH bytes before it and itself as one number; and its document."""
    rows, length = len(at) - 1, np.diff(at)
    head = at[:-1] + np.arange(rows) * (DEPTH + 1)
    padded = np.full(len(raw) + rows * (DEPTH + 1), 0xFF, np.uint8)
    padded[np.arange(len(raw)) + np.repeat((np.arange(rows) + 1) * (DEPTH + 1) - 1, length)] = raw
    strings = np.zeros(max(len(padded) - DEPTH, 0), np.uint64)
    for j in range(DEPTH + 1):
        strings = (strings << BYTE) | padded[j : len(padded) - DEPTH + j]
    document = np.repeat(np.arange(rows), length + 1)
    place = np.arange(len(document)) - np.repeat(at[:-1] + np.arange(rows), length + 1)
    return strings[head[document] + place], document


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each word, A-Z in lower case."""
    starts, ends, first = textkit.word_ranges(raw, at)
    return textkit.Hasher(raw, lower=True).ranges(starts, ends), textkit.row_of(first)


def bucket_of(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    chosen = (keys >> BYTE) & np.uint64(0xFFFF) if kind == STRINGS else keys
    return (textkit.mix(chosen + ONE) % np.uint64(buckets)).astype(np.int64)


def log_gamma(z: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for z >= 0.5, by Stirling's series above 16."""
    shift = np.zeros_like(z)
    w = z.copy()
    for _ in range(16):
        low = w < 16
        if not low.any():
            break
        shift[low] += np.log(w[low])
        w[low] += 1
    return (w - 0.5) * np.log(w) - w + 0.5 * math.log(2 * math.pi) + 1 / (12 * w) - 1 / (360 * w**3) + 1 / (1260 * w**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of that many zeros and ones."""
    table = log_gamma(np.arange(64) + 0.5)

    def half(n: np.ndarray) -> np.ndarray:
        out = table[np.minimum(n, 63).astype(np.int64)]
        large = n >= 64
        out[large] = log_gamma(n[large] + 0.5)
        return out

    return half(zeros) + half(ones) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Subtrees:
    """The context trees of a bucket's strings, from depth 2 down. Rows: eight decisions of each string."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        byte = np.repeat(keys & np.uint64(0xFF), 8)
        level = np.tile(np.arange(8, dtype=np.uint64), len(keys))
        self.prefix = (ONE << level) | (byte >> (BYTE - level))
        self.bit = ((byte >> (np.uint64(7) - level)) & ONE).astype(np.int64)
        self.near = np.repeat((keys >> BYTE) & np.uint64(0xFF), 8)
        self.count = np.repeat(counts, 8).astype(float)
        context = np.repeat(keys >> BYTE, 8)
        self.levels = []
        inner = None
        for depth in range(DEPTH, 1, -1):
            node = ((context & np.uint64((1 << 8 * depth) - 1)) << BYTE) | self.prefix
            _, head, of = np.unique(node, return_index=True, return_inverse=True)
            zeros = np.bincount(of, self.count * (1 - self.bit), len(head))
            ones = np.bincount(of, self.count * self.bit, len(head))
            kt = log_kt(zeros, ones)
            weighted = kt
            if inner is not None:
                below = np.bincount(of[inner[0]], inner[1], len(head))
                weighted = np.logaddexp(kt, below) - math.log(2)
            self.levels.append((of, zeros, ones, np.exp(kt - math.log(2) - weighted)))
            inner = (head, weighted)
        self.tops = inner

    def shorter(self) -> pd.DataFrame:
        """Per context of one byte and decision: sum of log P_w below it, zeros and ones."""
        head, weighted = self.tops
        of, zeros, ones, _ = self.levels[-1]
        frame = pd.DataFrame({"near": self.near[head].astype(np.int64), "prefix": self.prefix[head].astype(np.int64), "below": weighted, "zeros": zeros, "ones": ones})
        return frame.groupby(["near", "prefix"], as_index=False).sum()

    def log10_values(self, short: ShortContexts) -> np.ndarray:
        """log10 probability of the last byte of each string, given those before it."""
        p = None
        for of, zeros, ones, weight in self.levels:
            seen = (zeros + ones)[of]
            own = (np.where(self.bit == 1, ones[of], zeros[of]) + 0.5) / (seen + 1)
            # p is the longer context's prediction; where that was never seen, this one decides.
            p = own if p is None else np.where(known, weight[of] * own + (1 - weight[of]) * p, own)
            known = seen > 0
        for own1, weight, seen in short.of(self.near.astype(np.int64), self.prefix.astype(np.int64)):
            own = np.where(self.bit == 1, own1, 1 - own1)
            p = np.where(known, weight * own + (1 - weight) * p, own)
            known = seen > 0
        return np.add.reduceat(np.log10(p), np.arange(0, len(p), 8)) if len(p) else np.zeros(0)


class ShortContexts:
    """Contexts of one byte and of none: probability of a one, weight of the own estimate, counts. Arrays of fixed size."""

    def __init__(self, rows: pd.DataFrame):
        shape = (256, 256)
        below, zeros, ones = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        for target, name in ((below, "below"), (zeros, "zeros"), (ones, "ones")):
            target[rows["near"].to_numpy(int), rows["prefix"].to_numpy(int)] = rows[name].to_numpy(float)
        kt = log_kt(zeros, ones)
        weighted = np.logaddexp(kt, below) - math.log(2)
        self.one = ((ones + 0.5) / (zeros + ones + 1), np.exp(kt - math.log(2) - weighted), zeros + ones)
        zeros, ones, below = zeros.sum(axis=0), ones.sum(axis=0), weighted.sum(axis=0)
        kt = log_kt(zeros, ones)
        weighted = np.logaddexp(kt, below) - math.log(2)
        self.none = ((ones + 0.5) / (zeros + ones + 1), np.exp(kt - math.log(2) - weighted), zeros + ones)

    def of(self, near: np.ndarray, prefix: np.ndarray):
        yield tuple(a[near, prefix] for a in self.one)
        yield tuple(a[prefix] for a in self.none)


def _grouped(docs: DataFrame, groups: int, trains: Column) -> DataFrame:
    ids = F.col("doc_id").cast("long").alias("doc_id")
    group = F.pmod(row_id(F.col("doc_id"), F.col("text")), F.lit(groups)).alias("group")
    return docs.select(group, ids, F.col("text").cast("string").alias("text"), trains.alias("trains"))


def requests(grouped: DataFrame, buckets: int) -> DataFrame:
    """kind, bucket, group, keys, counts: each group's distinct strings and words with their training counts."""

    def reduce(held, found):
        for kind, parts in held.items():
            if parts:
                for into, new in zip(found[kind], lookup.counted(*map(np.concatenate, zip(*parts, strict=True))), strict=True):
                    into += new
                parts.clear()

    def collect(batches):
        for rows in sorted_groups(batches, "group"):
            found: dict[int, tuple[list, list]] = {STRINGS: ([], []), WORDS: ([], [])}
            held: dict[int, list] = {STRINGS: [], WORDS: []}
            for batch in rows.to_batches():
                trains = np.asarray(batch.column("trains"), bool)
                for first, end, raw, at in textkit.chunks(batch):
                    for kind, (keys, document) in ((STRINGS, byte_strings(raw, at)), (WORDS, words(raw, at))):
                        held[kind].append((keys, trains[first:end][document]))
                    if sum(len(keys) for keys, _ in held[STRINGS]) >= SORT_KEYS:
                        reduce(held, found)
            reduce(held, found)
            group = rows.column("group")[0].as_py()
            for kind, parts in found.items():
                keys, counts = lookup.merge(*parts)
                rows_out = lookup.request(kind, group, bucket_of(kind, keys, buckets), keys, counts)
                if rows_out is not None:
                    yield rows_out

    dealt = grouped.repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(collect, lookup.REQUEST)


def short_contexts(model: DataFrame) -> ShortContexts:
    """Settle the two shortest depths from all buckets' sums (at most 256 x 255 rows reach the driver)."""

    def weigh(batches):
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                yield pa.RecordBatch.from_pandas(Subtrees(lookup.unpack_keys(keys), lookup.unpacked(counts, "<i8")).shorter(), preserve_index=False)

    parts = model.where(F.col("kind") == STRINGS).select("keys", "counts").mapInArrow(weigh, "near long, prefix long, below double, zeros double, ones double")
    return ShortContexts(parts.groupBy("near", "prefix").agg(*[F.sum(c).alias(c) for c in ("below", "zeros", "ones")]).orderBy("near", "prefix").toPandas())


def with_values(model: DataFrame, short: ShortContexts) -> DataFrame:
    """kind, bucket, keys, values: log10 probability of each string, log10(count + 1) of each word."""

    def value(batches):
        for batch in batches:
            out = []
            for kind, keys, counts in zip(*(batch.column(n).to_pylist() for n in ("kind", "keys", "counts")), strict=True):
                n = lookup.unpacked(counts, "<i8")
                out.append(lookup.packed(Subtrees(lookup.unpack_keys(keys), n).log10_values(short).astype("<f4") if kind == STRINGS else np.log10(n + 1.0)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("kind", "bucket", "keys")), pa.array(out, pa.binary())], ["kind", "bucket", "keys", "values"])

    return model.select("kind", "bucket", "keys", "counts").mapInArrow(value, "kind int, bucket long, keys binary, values binary")


def _sums(grouped: DataFrame, answered: DataFrame, train_documents: int, buckets: int) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, sum of log10(count + 1), score."""
    nothing = {"doc_id": "long", "text": "string", "kind": "int", "bucket": "long", "values": "binary"}
    texts = grouped.select("group", F.lit(1).alias("part"), "doc_id", "text", *[F.lit(None).cast(nothing[c]).alias(c) for c in ("kind", "bucket", "values")])
    replies = answered.select("group", F.lit(0).alias("part"), *[F.lit(None).cast(nothing[c]).alias(c) for c in ("doc_id", "text")], "kind", "bucket", "values")

    def add(batches):
        for rows in sorted_groups(batches, "group"):
            n = int((np.asarray(rows.column("part")) == 0).sum())
            replies, documents = rows.slice(0, n), rows.slice(n)
            if not len(documents):
                continue
            blobs = {(k, b): v for k, b, v in zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "values")), strict=True)}
            lookups = {kind: _lookup(documents, kind, blobs, buckets) for kind in (STRINGS, WORDS)}
            for batch in documents.to_batches():
                sums = [[], [], [], []]
                for first, end, raw, at in textkit.chunks(batch):
                    size = end - first
                    keys, document = byte_strings(raw, at)
                    sums[3].append(np.bincount(document, _values_of(keys, *lookups[STRINGS]), size))
                    keys, document = words(raw, at)
                    v = _values_of(keys, *lookups[WORDS])
                    sums[0].append(np.bincount(document, minlength=size) + 1)
                    sums[1].append(np.bincount(document[v > 0], minlength=size) + (train_documents > 0))
                    sums[2].append(np.bincount(document, v, size) + math.log10(train_documents + 1))
                if len(batch):
                    columns = [pa.array(np.concatenate(s).astype(t)) for s, t in zip(sums, (np.int64, np.int64, float, float), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "n_known", "logs", "score"])

    dealt = replies.unionByName(texts).repartition("group").sortWithinPartitions("group", "part")
    return dealt.mapInArrow(add, "doc_id long, n_tokens long, n_known long, logs double, score double")


def _lookup(documents: pa.Table, kind: int, blobs: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The group's distinct keys, as they were asked for, and their values."""
    parts, held = [], []
    for batch in documents.to_batches():
        for _, _, raw, at in textkit.chunks(batch):
            held.append((byte_strings if kind == STRINGS else words)(raw, at)[0])
            if sum(map(len, held)) >= SORT_KEYS:
                parts.append(lookup.distinct(np.concatenate(held)))
                held = []
    keys = lookup.distinct(np.concatenate([*parts, *held])) if parts or held else np.zeros(0, np.uint64)
    return keys, lookup.fill(blobs, kind, VALUES[kind], bucket_of(kind, keys, buckets))


def _values_of(keys: np.ndarray, found: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each key: a chunk's distinct keys are few, and in order they are found near one another."""
    code, distinct = pd.factorize(keys)
    order = np.argsort(distinct)
    own = np.empty(len(distinct))
    own[order] = values[np.searchsorted(found, distinct[order])]
    return own[code]


def score(docs: DataFrame, trains: Column) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score. trains: a condition on doc_id."""
    groups = max(64, math.ceil(text_bytes(docs) / GROUP_BYTES))
    grouped = _grouped(docs, groups, trains)
    train_documents = docs.where(trains).count()
    buckets = groups  # each holds about as many distinct keys as a group, whatever the input's size
    asked = stage(requests(grouped, buckets), "ctw-requests")
    model = stage(lookup.merged(asked, groups), "ctw-model")
    valued = stage(with_values(model, short_contexts(model)), "ctw-values")
    total, known = model.where(F.col("kind") == WORDS).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    tokens, vocabulary = total + train_documents, known + (train_documents > 0)
    scored = _sums(grouped, lookup.answers(asked, valued, groups, VALUES), train_documents, buckets)
    base = F.col("logs") - F.col("n_tokens") * F.lit(math.log10(tokens + vocabulary + 1))
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
