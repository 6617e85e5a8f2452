"""Variable-capacity best-fit packing of documents into training sequences.

Sequences may have several permitted lengths, each with a cost. Documents longer
than the largest one are cut into pieces of it first. Pieces are dealt to shards
by hash (about ``shard_tokens`` each) and every shard is packed on its own, with
pieces in falling order of length: a piece goes into the open sequence that it
leaves the least room in; if none has room, a sequence is opened. Every permitted
length is tried for it: the pieces still to come are laid in on trial, the longest
that fits first, and the length with the least cost per token laid in is opened.
In the end every sequence shrinks to the cheapest length that holds its pieces.
A shard's state is bounded by the largest length, not by its pieces.

Defined results: null and empty texts, and texts without words, make no piece;
rows that repeat a doc_id are separate documents, told apart by ``row`` where
their texts differ (equal rows get pieces of their own, with the same labels); a
null doc_id is packed like any other; an empty table gives an empty result. The
same rows and parameters give the same packing.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpanel.llm.common import WORD, row_id, stage
from gridpanel.llm.minhash import sorted_groups

#: Permitted lengths and costs: the tokens themselves and a fixed share per sequence.
CAPACITIES: dict[int, float] = {512: 512 + 16.0, 1024: 1024 + 16.0, 2048: 2048 + 16.0, 4096: 4096 + 16.0}


def filled(room: int, coming: list[int], lengths: int) -> int:
    """Tokens that the pieces to come lay into this much room, the longest that fits first.

    coming: pieces by length; lengths: a bit for each length that is still to come.
    """
    left = room
    while left:
        fits = lengths & ((2 << left) - 1)
        if not fits:
            break
        n = fits.bit_length() - 1
        left -= n * min(coming[n], left // n)
        lengths = fits & ~(1 << n)
    return room - left


def pack(lengths: np.ndarray, capacities: Mapping[int, float] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece (pieces in falling order of length), and each sequence's final length."""
    sizes = sorted(capacities)
    largest = sizes[-1]
    room: list[list[int]] = [[] for _ in range(largest + 1)]  # open sequences by the room they have left
    occupied = 0  # bit r: some sequence has room r
    opened: list[int] = []
    used: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    coming = np.bincount(lengths, minlength=largest + 1).tolist()
    to_come = sum(1 << n for n, count in enumerate(coming) if count)
    for k, n in enumerate(lengths.tolist()):
        coming[n] -= 1
        if not coming[n]:
            to_come &= ~(1 << n)
        fits = occupied >> n
        if fits:
            left = n + ((fits & -fits).bit_length() - 1)
            b = room[left].pop()
            if not room[left]:
                occupied &= ~(1 << left)
        else:
            left = min((s for s in sizes if s >= n), key=lambda s: (capacities[s] / (n + filled(s - n, coming, to_come)), s))
            b = len(opened)
            opened.append(left)
            used.append(0)
        bins[k], offsets[k] = b, used[b]
        used[b] += n
        if left > n:
            room[left - n].append(b)
            occupied |= 1 << (left - n)
    final = np.array([min((s for s in sizes if s >= u), key=lambda s: (capacities[s], s)) for u in used], np.int64)
    return bins, offsets, final


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pack_documents(
    docs: DataFrame,
    length: Column | None = None,
    capacities: Mapping[int, float] = CAPACITIES,
    shard_tokens: int = 1 << 18,
) -> DataFrame:
    """One row per piece: sequence (text id), capacity, offset in it, doc_id, row, piece, start in the document, length.

    length: tokens of a document; its words if not given.
    """
    largest = max(capacities)
    length = word_count(F.col("text")) if length is None else length.cast("long")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id(F.col("doc_id"), F.col("text")).alias("row"), length.alias("_tokens")).where("_tokens > 0")
    sized = stage(sized, "piece-sizes")
    total = sized.agg(F.coalesce(F.sum("_tokens"), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_tokens))
    pieces = sized.select("doc_id", "row", "_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_tokens - 1) div {largest}"))).alias("piece"))
    start = F.col("piece") * largest
    pieces = pieces.select("doc_id", "row", "piece", start.alias("start"), F.least(F.col("_tokens") - start, F.lit(largest)).alias("length"))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(shards)))
    dealt = pieces.repartition("shard").sortWithinPartitions("shard", F.desc("length"), "doc_id", "row", "piece")

    def work(batches):
        for group in sorted_groups(batches, "shard"):
            shard = group.column("shard")[0].as_py()
            bins, offsets, final = pack(np.asarray(group.column("length")), capacities)
            names = [f"{shard:06d}-{b:08d}" for b in range(len(final))]
            columns = [pa.array(names).take(pa.array(bins)), pa.array(final[bins]), pa.array(offsets), *(group.column(n).combine_chunks() for n in ("doc_id", "row", "piece", "start", "length"))]
            yield from pa.Table.from_arrays(columns, ["sequence", "capacity", "offset", "doc_id", "row", "piece", "start", "length"]).to_batches(max_chunksize=8192)

    return dealt.mapInArrow(work, "sequence string, capacity long, offset long, doc_id long, row long, piece long, start long, length long")
