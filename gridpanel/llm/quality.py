"""Quality rules: statistics of every document, base rules, and gradient-boosted trees on top.

``document_stats`` measures whole texts in one pass without a shuffle.
``train`` fits trees on at most ``max_labelled`` labelled rows (a bound on the
fit only); ``judge`` scores every document with the flattened trees.

Defined results: null and empty texts have no words and fail the base rules;
rows that repeat a doc_id are judged one by one; labels without a document and
documents without a label are fine, as is no label at all (the trees then give
the constant base rate); extra columns of documents are kept by
``keep_documents`` and otherwise ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import textkit, trees
from gridpanel.llm.common import stage

#: Fixed values of the contract: symbols, and the two base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct", "n_long_words", "n_bare_words"]
#: Feature and the direction in which quality may move with it (0: either).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": -1,
    "mark_share": -1,
    "distinct_share": 0,
    "line_words": 0,
    "long_word_share": -1,
    "bare_word_share": -1,
}


def _count(raw: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    starts, ends, first = textkit.word_ranges(raw, at)
    rows = len(at) - 1
    doc = textkit.row_of(first)
    solid = ~textkit.SPACE.take(raw)
    points = (raw & 0xC0) != 0x80
    hashes = textkit.Hasher(raw, lower=False)
    words = hashes.ranges(starts, ends)
    salt = textkit.mix(doc.astype(np.uint64))
    letter = ((raw | 0x20) >= 97) & ((raw | 0x20) <= 122) | (raw >= 0x80)
    digit = (raw >= 48) & (raw <= 57)
    named = letter | digit
    length = ends - starts
    out = {
        "n_words": np.diff(first),
        "word_chars": textkit.per_row(solid & points, at),
        "n_symbols": textkit.per_row(_table(SYMBOLS).take(raw), at),
        "n_dup_lines": _duplicate_lines(raw, at, hashes, starts),
        "n_repeat_words": _repeats(words, doc, salt, rows),
        "n_chars": textkit.per_row(points, at),
        "n_lines": textkit.per_row(raw == 10, at) + 1,
        "n_upper": textkit.per_row((raw >= 65) & (raw <= 90), at),
        "n_digits": textkit.per_row(digit, at),
        "n_marks": textkit.per_row(solid & points & ~named, at),
        "n_distinct": np.bincount(doc[~pd.Series(words ^ salt).duplicated().to_numpy()], minlength=rows),
        "n_long_words": np.bincount(doc[length > 20], minlength=rows),
        "n_bare_words": np.bincount(doc[textkit.before(named, ends) == textkit.before(named, starts)], minlength=rows),
    }
    return out


def _table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def _repeats(words: np.ndarray, doc: np.ndarray, salt: np.ndarray, rows: int) -> np.ndarray:
    """Words inside a 3-word window that occurs at least twice in the text."""
    if len(words) < 3:
        return np.zeros(rows, np.int64)
    inside = doc[:-2] == doc[2:]
    windows = textkit.mix(words[:-2] + textkit.mix(words[1:-1] + textkit.mix(words[2:] ^ salt[2:])))[inside]
    again = np.flatnonzero(inside)[pd.Series(windows).duplicated(keep=False).to_numpy()]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[again + k] = True
    return np.bincount(doc[covered], minlength=rows)


def _duplicate_lines(raw: np.ndarray, at: np.ndarray, hashes: textkit.Hasher, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    breaks = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([at[:-1], breaks + 1]))
    own = np.concatenate([np.searchsorted(breaks, at[:-1]) + np.arange(len(at) - 1), [len(starts)]])
    doc = textkit.row_of(own)
    ends = np.empty_like(starts)
    ends[own[1:] - 1] = at[1:]
    inner = np.ones(len(starts), bool)
    inner[own[1:] - 1] = False
    ends[inner] = breaks
    has_word = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    keys = hashes.ranges(starts, ends) ^ textkit.mix(doc.astype(np.uint64))
    again = pd.Series(keys).duplicated().to_numpy() & has_word
    return np.bincount(doc[again], minlength=len(at) - 1)


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id and all counts of each text; one row per row of docs, no shuffle."""
    names = COUNTS + EXTRA

    def measure(batches):
        for batch in batches:
            parts = [_count(raw, at) for _, _, raw, at in textkit.chunks(batch)]
            columns = [pa.array(np.concatenate([p[n] for p in parts]) if parts else [], pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(measure, "doc_id long, " + ", ".join(f"{n} long" for n in names))


def with_base(stats: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("base_failed", failed)


def features(frame: pd.DataFrame) -> np.ndarray:
    c = {k: frame[k].to_numpy(float) for k in COUNTS + EXTRA}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    columns = {
        "log_words": np.log1p(c["n_words"]),
        "word_length": c["word_chars"] / words,
        "symbol_share": c["n_symbols"] / chars,
        "dup_line_share": c["n_dup_lines"] / c["n_lines"],
        "repeat_share": c["n_repeat_words"] / words,
        "upper_share": c["n_upper"] / chars,
        "digit_share": c["n_digits"] / chars,
        "mark_share": c["n_marks"] / chars,
        "distinct_share": c["n_distinct"] / words,
        "line_words": np.log1p(c["n_words"] / c["n_lines"]),
        "long_word_share": c["n_long_words"] / words,
        "bare_word_share": c["n_bare_words"] / words,
    }
    return np.stack([columns[k] for k in FEATURES], axis=1)


def _labelled(labels: DataFrame, max_labelled: int) -> DataFrame:
    """doc_id and quality of about max_labelled labelled rows at most, chosen by hash."""
    known = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    total = known.count()
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, max_labelled / max(total, 1))))


def train(stats: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> trees.FlatTrees:
    """Trees for ``labels.quality``, from a hash-chosen sample of about max_labelled labelled rows at most."""
    sample = stats.join(_labelled(labels, max_labelled), "doc_id").orderBy("doc_id", *COUNTS).limit(2 * max_labelled).toPandas()
    return trees.fit(features(sample), sample["quality"].to_numpy(float), np.array(list(FEATURES.values())))


def judge(stats: DataFrame, model: trees.FlatTrees, threshold: float = 0.5) -> DataFrame:
    """Adds quality_score and kept (false wherever a base rule fails)."""
    schema = ", ".join(f"{n} {t}" for n, t in with_base(stats).dtypes) + ", quality_score double, kept boolean"

    def score(batches):
        for batch in batches:
            frame = batch.select(COUNTS + EXTRA).to_pandas()
            p = model.probability(features(frame)) if len(frame) else np.zeros(0)
            kept = (p >= threshold) & ~np.asarray(batch.column("base_failed"), bool)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array(kept)], [*batch.schema.names, "quality_score", "kept"])

    return with_base(stats).mapInArrow(score, schema)


def keep_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = 20_000) -> DataFrame:
    """Documents the rules keep, with all their columns. Only documents of the labelled sample are measured to train; all are where their text is."""
    chosen = stage(_labelled(labels, max_labelled), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id", "left_semi")
    model = train(document_stats(texts), chosen, max_labelled)
    names = docs.columns

    def choose(batches):
        for batch in batches:
            parts = [pd.DataFrame(_count(raw, at)) for _, _, raw, at in textkit.chunks(batch)]
            if not parts:
                yield batch
                continue
            counts = pd.concat(parts)
            fails = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
            yield batch.filter(pa.array((model.probability(features(counts)) >= threshold) & ~fails.to_numpy()))

    return docs.mapInArrow(choose, docs.schema).select(*names)
