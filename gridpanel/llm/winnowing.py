"""Benchmark passages in documents, found by winnowed fingerprints.

1. Words are hashed, and so is every run of ``gram`` words. Of each ``window``
   runs in a row that make up a span of the guaranteed length, the smallest hash
   (of equal ones the last) is a fingerprint: two texts that share such a span
   choose the same run inside it.
2. A bitmap of the fingerprints of all items goes to the tasks. Its size follows
   the number of fingerprints and never passes 8 MB; when it fills up, it lets
   more through and nothing else changes.
3. Fingerprints of documents that pass it carry the words around them. They are
   joined with those of the items and extended to both sides, word by word; a
   common run of at least the guaranteed length marks its words.

Texts of items with fewer words than the guarantee are searched with their own
length as guarantee. Items with equal words are one class in the join.

Defined results: A-Z are lower-cased; null, empty and wordless texts have no
words, hit nothing and are not hit; rows that repeat a doc_id are separate
documents; rows that repeat an item_id are one item with several texts, and a
null item_id is named by the empty text; an empty table of items leaves every
document clean; an empty table of documents gives an empty result; further
columns are not looked at. Words are compared by 64-bit hashes, whole spans of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm import textkit
from gridpanel.llm.common import stage

#: Fixed value: bytes between words; the others are digits, letters and all of UTF-8 beyond ASCII.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[0x00:0x30] = SEPARATORS[0x3A:0x41] = SEPARATORS[0x5B:0x61] = SEPARATORS[0x7B:0x80] = True
SMALLEST_BITS, LARGEST_BITS = 16, 26
BUCKET = 1 << 15
FOUND = "own long, id {}, n_words long, class long, level int, fingerprint long, left array<long>, right array<long>, positions array<long>"


def winnow(sums: textkit.WordSums, first: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the chosen runs of ``gram`` words, and the hashes of these."""
    n, span = sums.words, gram + window - 1
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = textkit.row_of(first)
    heads = np.arange(n - gram + 1)
    hashes = sums.ranges(heads, heads + gram)
    starts = np.flatnonzero(owner[: n - span + 1] == owner[span - 1 :])
    least, chosen = hashes[starts], starts
    for k in range(1, window):
        other = hashes[starts + k]
        chosen = np.where(other <= least, starts + k, chosen)
        least = np.minimum(other, least)
    marked = np.zeros(n, bool)
    marked[chosen] = True
    chosen = np.flatnonzero(marked)
    return chosen, textkit.mix(hashes[chosen] + np.uint64(span))


class Bitmap:
    """Set of fingerprints by their leading bits; false hits are possible, misses are not."""

    def __init__(self, fingerprints: DataFrame):
        n = fingerprints.count()
        self.bits = min(max((64 * n).bit_length(), SMALLEST_BITS), LARGEST_BITS)
        place = F.shiftrightunsigned("fingerprint", 64 - self.bits)
        grouped = fingerprints.groupBy(F.shiftright(place, 15).alias("bucket")).agg(F.bitmap_construct_agg(F.pmod(place, F.lit(BUCKET))).alias("bits"))
        self.bytes = np.zeros(1 << (self.bits - 3), np.uint8)
        for row in grouped.collect():
            part = np.frombuffer(row["bits"], np.uint8)
            self.bytes[row["bucket"] * (BUCKET // 8) :][: len(part)] = part

    def holds(self, fingerprints: np.ndarray) -> np.ndarray:
        place = fingerprints >> np.uint64(64 - self.bits)
        return (self.bytes[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count in turn."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _surroundings(words: np.ndarray, sums: textkit.WordSums, first: np.ndarray, at: np.ndarray, prints: np.ndarray, gram: int, level: int):
    """Row, fingerprint, left and right words and positions; places of a row with the same words around are one."""
    row = np.searchsorted(first, at, "right") - 1
    low, high = np.maximum(first[row], at - (level - gram)), np.minimum(first[row + 1], at + level)
    key = textkit.mix(sums.ranges(low, high) + textkit.mix((at - low).astype(np.uint64))) ^ textkit.mix(row.astype(np.uint64))
    _, one, group, repeats = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    positions = (at - first[row])[np.argsort(group, kind="stable")]
    at, row, low, high = at[one], row[one], low[one], high[one]
    left, right = at - low, high - at
    signed = words.view(np.int64)
    return row, prints[one].view(np.int64), _lists(signed[np.repeat(at - 1, left) - _steps(left)], left), _lists(signed[np.repeat(at, right) + _steps(right)], right), _lists(positions, repeats)


def _search(gram: int, levels: list[int], limit: int, bitmap: Bitmap | None):
    """Arrow worker: a row per text, and rows for its fingerprints (of items, those of their own level)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, ids = batch.column("own"), batch.column("id")
            names = ["own", "id", "n_words", "class", "level", "fingerprint", "left", "right", "positions"]
            lists = pa.list_(pa.int64())
            for a, b, raw, at in textkit.chunks(batch):
                starts, ends, first = textkit.word_ranges(raw, at, SEPARATORS)
                words = textkit.Hasher(raw, lower=True).ranges(starts, ends)
                sums, counts, n = textkit.WordSums(words), np.diff(first), b - a
                whole = sums.ranges(first[:-1], first[1:]).view(np.int64)
                nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int64(), lists, lists, lists)]
                yield pa.RecordBatch.from_arrays([own[a:b], ids[a:b], pa.array(counts.astype(np.int64)), pa.array(whole), *nothing], names)
                for level in levels:
                    size = min(gram, level)
                    chosen, prints = winnow(sums, first, size, level - size + 1)
                    if bitmap is not None:
                        wanted = bitmap.holds(prints)
                    else:
                        wanted = np.minimum(counts, limit)[np.searchsorted(first, chosen, "right") - 1] == level
                    if not wanted.any():
                        continue
                    row, prints, left, right, positions = _surroundings(words, sums, first, chosen[wanted], prints[wanted], size, level)
                    m = len(row)
                    yield pa.RecordBatch.from_arrays(
                        [own[a:b].take(pa.array(row)), pa.nulls(m, ids.type), pa.nulls(m, pa.int64()), pa.array(whole[row]), pa.array(np.full(m, level, np.int32)), pa.array(prints), left, right, positions],
                        names,
                    )

    return work


def _run(one: Column, other: Column) -> Column:
    """How many words two lists have in common from their start."""
    same = F.zip_with(one, other, lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(same))


def find_passages(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 6) -> DataFrame:
    """doc_id, n_words, spans (start and end of maximal hit runs, in words), item_ids (sorted texts) per document.

    docs: doc_id, text. items: item_id, text. A word is hit if it lies in ``window``
    words in a row that an item has too, or in all words of a shorter item.
    """
    told = items.select(F.monotonically_increasing_id().alias("own"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    told = stage(told.mapInArrow(_search(gram, list(range(1, window + 1)), window, None), FOUND.format("string")), "winnow-items")
    wanted = told.where("level is not null").select("level", "fingerprint", "left", "right", "class").distinct()
    wanted = stage(wanted.withColumnsRenamed({"left": "item_left", "right": "item_right"}), "winnow-wanted")
    levels = sorted(row["level"] for row in wanted.select("level").distinct().collect())
    own_id = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(F.monotonically_increasing_id().alias("own"), F.col("doc_id").alias("id"), "text")
    read = stage(texts.mapInArrow(_search(gram, levels, window, Bitmap(wanted.select("fingerprint").distinct())), FOUND.format(own_id)), "winnow-documents")

    seen = read.where("level is not null").select("own", "level", "fingerprint", "left", "right", "positions")
    met = seen.join(wanted, ["level", "fingerprint"])
    met = met.withColumns({"back": _run(F.col("left"), F.col("item_left")), "on": _run(F.col("right"), F.col("item_right"))})
    met = met.where((F.col("on") >= F.least(F.lit(gram), "level")) & (F.col("back") + F.col("on") >= F.col("level")))
    met = stage(met.select("own", "class", "positions", "back", "on"), "winnow-met")

    result = read.where("level is null").select("own", F.col("id").alias("doc_id"), "n_words")
    result = result.join(_merged_spans(met), "own", "left").join(_item_lists(met, told), "own", "left")
    no_span = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return result.select("doc_id", "n_words", F.coalesce("spans", no_span).alias("spans"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def _merged_spans(met: DataFrame) -> DataFrame:
    """own, spans: runs of hit words that touch are one; a document's runs are in one task, never several documents' as one."""
    placed = met.groupBy("own", "positions").agg(F.max("back").alias("back"), F.max("on").alias("on"))
    # Runs of different items around one place touch each other, so the longest to each side covers them.
    at = placed.select("own", "back", "on", F.explode("positions").alias("at"))
    runs = at.select("own", (F.col("at") - F.col("back")).alias("start"), (F.col("at") + F.col("on")).alias("end"))
    runs = runs.groupBy("own", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("own").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int")
    island = F.sum("opens").over(Window.partitionBy("own").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    islands = runs.withColumn("opens", opens).withColumn("island", island)
    merged = islands.groupBy("own", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.groupBy("own").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _item_lists(met: DataFrame, told: DataFrame) -> DataFrame:
    """own, item_ids; the list is made once per set of classes that occurs."""
    sets = met.select("own", "class").distinct().groupBy("own").agg(F.sort_array(F.collect_set("class")).alias("classes"))
    sets = sets.withColumn("set", F.sha2(F.concat_ws(",", F.transform("classes", lambda c: c.cast("string"))), 256))
    members = told.where("level is null").select("class", "id").distinct()
    # aggregates to one list per set before it meets the classes' items
    kinds = sets.groupBy("set").agg(F.any_value("classes").alias("classes")).select("set", F.explode("classes").alias("class"))
    lists = kinds.join(members, "class").groupBy("set").agg(F.sort_array(F.collect_set("id")).alias("item_ids"))
    return sets.select("own", "set").join(lists, "set").select("own", "item_ids")
