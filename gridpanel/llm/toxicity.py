"""Toxicity by non-negative positive-unlabelled learning on word presence.

Positives are documents confirmed toxic; all other text is unlabelled. With the
class prior pi the risk is pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1)): the
negative part is estimated from unlabelled text and corrected by the positives
in it, and held at zero from below (if it falls under it, the step goes against
it). Words are hashed into a fixed number of features and weighted by how much
more often they occur in positives than in the corrected negative class, so
that a document's length does not water down the words that matter. Several
classifiers, each from its own draw of the unlabelled sample, are averaged.

The fit uses at most about ``max_positive`` positives and ``max_unlabelled``
other documents (hash-chosen; these bounds are the only ones); the scores cover
every whole text. The model is an array of fixed size.

Defined results: null and empty texts are documents without words (they get the
score of the bias); labels that are null count as unlabelled; rows that repeat
a doc_id are scored one by one; without any positive the scores are the prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import textkit

WIDTH = 1 << 18


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def probability(self, documents: np.ndarray, slots: np.ndarray, rows: int) -> np.ndarray:
        raw = np.bincount(documents, self.weights[slots], minlength=rows) + self.bias
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def _slots(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of each distinct word of each document. Signs at a word's ends are not part of it."""
    shape = raw.copy()
    shape[_MARKS[raw]] = 32
    starts, ends, first = textkit.word_ranges(shape, at)
    words = textkit.Hasher(shape, lower=True).ranges(starts, ends)
    document = textkit.row_of(first)
    key = (document.astype(np.uint64) << np.uint64(18)) | (words & np.uint64(WIDTH - 1))
    key = key[~pd.Series(key).duplicated().to_numpy()]
    return (key >> np.uint64(18)).astype(np.int64), (key & np.uint64(WIDTH - 1)).astype(np.int64)


#: ASCII bytes other than letters, digits and the apostrophe part words here.
_MARKS = np.array([b < 128 and not (chr(b).isalnum() or b == 39) for b in range(256)])


def _sample(docs: DataFrame, chosen: Column) -> DataFrame:
    """Packed distinct word features of the chosen documents."""

    def pack(batches):
        for batch in batches:
            rows = []
            for first, end, raw, at in textkit.chunks(batch):
                document, slot = _slots(raw, at)
                bounds = np.searchsorted(document, np.arange(end - first + 1))
                rows += [np.sort(slot[a:b]).astype("<i4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "slots"])

    return docs.where(chosen).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pack, "doc_id long, slots binary")


def _share(bound: int, total: int, salt: int, *columns: str) -> Column:
    """A hash-chosen share of rows with about ``bound`` of ``total`` rows; rows that agree in ``columns`` go together."""
    return F.pmod(F.xxhash64(*columns, F.lit(salt)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, bound / max(total, 1)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    may_train: Column,
    max_positive: int = 4_000,
    max_unlabelled: int = 8_000,
    members: int = 3,
) -> ToxicityModel:
    """Fit on rows where may_train (a condition on doc_id) holds.

    The prior is the share of toxic rows among the labelled training rows.
    """
    known = labels.where(may_train).where("toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).alias("toxic"))
    toxic, rated = known.agg(F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)), F.count("*")).first()
    prior = min(max((toxic + 1) / (rated + 2), 0.01), 0.5)
    if not toxic:
        return ToxicityModel(np.zeros(WIDTH), float(np.log(prior / (1 - prior))))
    # At most about max_positive ids, so this side is small whatever the input's size.
    ids = known.where("toxic").where(_share(max_positive, toxic, 1, "doc_id")).select("doc_id").distinct().orderBy("doc_id").limit(2 * max_positive)
    wanted = docs.join(F.broadcast(ids), "doc_id", "left_semi")
    positive = _unpack(_sample(wanted, F.lit(True)).orderBy("doc_id", "slots").limit(2 * max_positive).toPandas())
    total = docs.where(may_train).count()
    other = _sample(docs, may_train & _share(max_unlabelled, total, 2, "doc_id", "text")).orderBy("doc_id", "slots").limit(2 * max_unlabelled).toPandas()
    unlabelled = _unpack(other)
    fits = [_fit(positive, unlabelled, prior, seed) for seed in range(members)]
    return ToxicityModel(np.mean([w for w, _ in fits], axis=0), float(np.mean([b for _, b in fits])))


def _unpack(sample: pd.DataFrame) -> list[np.ndarray]:
    """Feature lists in a fixed order; documents with the same words count once."""
    ordered = sample.sort_values(["doc_id", "slots"])["slots"].drop_duplicates() if len(sample) else []
    return [np.frombuffer(s, "<i4") for s in ordered]


def risk_slopes(f: np.ndarray, n_p: int, n_u: int, prior: float) -> np.ndarray:
    """Slope of the non-negative risk by each row's margin; f holds n_p positive rows, then n_u unlabelled ones.

    The risk is prior * mean loss of the positives as positive, plus the negatives'
    part: mean loss of the unlabelled as negative less prior * that of the
    positives. Where that part falls below zero, the slopes lead back to zero.
    """
    p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    loss_minus = np.logaddexp(0, f)
    negative = (loss_minus[n_p:].mean() if n_u else 0.0) - prior * loss_minus[:n_p].mean()
    g = np.empty(n_p + n_u)
    if negative >= 0:
        g[:n_p] = prior * (p[:n_p] - 1) / n_p - prior * p[:n_p] / n_p
        g[n_p:] = p[n_p:] / max(n_u, 1)
    else:
        g[:n_p] = prior * p[:n_p] / n_p
        g[n_p:] = -p[n_p:] / max(n_u, 1)
    return g


def _fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int, steps: int = 150, rate: float = 0.1, ridge: float = 2e-3) -> tuple[np.ndarray, float]:
    """One classifier by full-batch gradient steps (Adam) on the non-negative risk."""
    if not positive:
        return np.zeros(WIDTH), float(np.log(prior / (1 - prior)))
    rng = np.random.default_rng(seed)
    if len(unlabelled) > 1:
        unlabelled = [unlabelled[i] for i in rng.permutation(len(unlabelled))[: max(1, len(unlabelled) * 4 // 5)]]
    n_p, n_u = len(positive), len(unlabelled)
    rows = np.repeat(np.arange(n_p + n_u), [len(s) for s in positive + unlabelled])
    slots = np.concatenate([*positive, *unlabelled, np.zeros(0, np.int32)]).astype(np.int64)
    in_p = np.bincount(slots[rows < n_p], minlength=WIDTH)
    in_u = np.bincount(slots[rows >= n_p], minlength=WIDTH)
    share_p = (in_p + 0.5) / (n_p + 1)
    share_n = np.maximum((in_u + 0.5) / (n_u + 1) - prior * share_p, 0.02 * share_p) / (1 - prior)
    scale = np.maximum(np.log(share_p / share_n), 0) * in_p / (in_p + 0.01 * n_p + 2)
    # Only words that positives hold clearly more often than chance would have it.
    expected = n_p * (in_u + 0.5) / (n_u + 1)
    used = (scale > 0.3) & (in_p - expected > 3.5 * np.sqrt(expected + 0.5))
    keep = used[slots]
    rows, slots = rows[keep], slots[keep]
    columns = np.flatnonzero(used)
    place = np.zeros(WIDTH, np.int64)
    place[columns] = np.arange(len(columns))
    slots, x = place[slots], scale[slots]
    w, bias = np.full(len(columns), 0.5), float(np.log(prior / (1 - prior)))
    moments = [np.zeros(len(columns) + 1), np.zeros(len(columns) + 1)]
    for step in range(1, steps + 1):
        f = np.bincount(rows, w[slots] * x, minlength=n_p + n_u) + bias
        g = risk_slopes(f, n_p, n_u, prior)
        gradient = np.append(np.bincount(slots, g[rows] * x, minlength=len(columns)) + ridge * prior * w, g.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    weights = np.zeros(WIDTH)
    weights[columns] = w * scale[columns]
    return weights, bias


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted for every whole text; no shuffle."""

    def judge(batches):
        for batch in batches:
            parts = [np.zeros(0)]
            for first, end, raw, at in textkit.chunks(batch):
                parts.append(model.probability(*_slots(raw, at), end - first))
            p = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(judge, "doc_id long, score double, predicted int")
