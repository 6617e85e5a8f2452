"""Removal of byte strings repeated from earlier documents, by bucket-pointer refinement.

A byte goes if a ``length``-byte string that covers it also starts in a document
with a smaller doc_id. Candidates come from minimisers: each window of
``length`` bytes is represented by the smallest hash of the 16-byte strings in
it, so equal windows share it, and neighbouring windows with the same minimum
form one range of text.

1. Batches of documents (about 8 MB) are stored, and their minimisers' keys are
   asked for: which occur in more than one document? (48 bits of a key; a chance
   hit costs work only.)
2. The ranges of shared minimisers go to buckets by minimiser, so that all
   occurrences of a window meet. A batch sends equal ranges (by hash and bytes)
   once, from its smallest document; only copies inside one batch are settled so.
3. In a bucket, the suffixes of all ranges of a minimiser are refined: bucket
   numbers of all 8-byte strings, then, in the buckets with more than one
   suffix, sorting on (own bucket, bucket of the suffix 8 later), on the refined
   numbers of the suffix 16 later, and so on until the numbers stand for
   ``length`` bytes. This is exact: a number stands for the bytes themselves.
   The smallest doc_id of each number's windows decides.
4. The removed ranges go back to their batch.

A passage of a third of all documents costs its bucket one range per batch. Beyond
BATCHES_PER_SALT batches a bucket takes part in two rounds, per salt (so many
batches at a time) and as a whole with the ranges that no round settled in full.

Defined results: null and empty texts have no bytes; a null doc_id counts as
smaller than all others; rows with equal doc_ids take nothing from one another;
texts shorter than length keep all their bytes; an empty table gives an empty
result. Kept bytes may end in part of a character.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import lookup, textkit
from gridpanel.llm.common import stage, text_bytes
from gridpanel.llm.minhash import sorted_groups

GRAM = 16
BATCH_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
#: Ranges are compared in pieces whose sorts stay in a core's cache.
PIECE_BYTES = 1 << 17
#: A passage that every batch has costs a bucket one range, some 100 bytes, for each of these.
BATCHES_PER_SALT = 1 << 13
NULL_ID = -(1 << 63)
KIND = 0
U = np.uint64


def eight_bytes(raw: np.ndarray) -> np.ndarray:
    """The 8-byte string at each position as a number."""
    x = raw.astype(U)
    for shift in (1, 2, 4):
        if len(x) <= shift:
            return np.zeros(0, U)
        x = x[:-shift] | (x[shift:] << U(8 * shift))
    return x


def ranges(raw: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: start, number of windows, minimiser, document."""
    eight = eight_bytes(raw)
    if len(eight) <= 8 or len(raw) < length:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64))
    least = textkit.mix(eight[:-8] * U(textkit.BASE) + textkit.mix(eight[8:]))
    span, have = length - GRAM + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    # Windows that reach over a document's end don't count.
    document = np.searchsorted(at, np.arange(len(least)), "right") - 1
    whole = np.arange(len(least)) + length <= at[document + 1]
    change = np.ones(len(least) + 1, bool)
    change[1:-1] = (least[1:] != least[:-1]) | (document[1:] != document[:-1]) | (whole[1:] != whole[:-1])
    edges = np.flatnonzero(change)
    start, n = edges[:-1], np.diff(edges)
    good = whole[start]
    start, n = start[good], n[good]
    return start, n, least[start], document[start]


def ranks(values: np.ndarray) -> np.ndarray:
    """For each value, how many smaller distinct ones there are."""
    order = np.argsort(values)
    new = np.zeros(len(values), bool)
    new[1:] = values[order[1:]] != values[order[:-1]]
    out = np.empty(len(values), np.int64)
    out[order] = np.cumsum(new)
    return out


def window_numbers(raw: np.ndarray, length: int) -> np.ndarray:
    """For each position, a number that is equal exactly where the next ``length`` bytes are.

    Bucket-pointer refinement; positions closer than length to the end get
    numbers without meaning.
    """
    eight = eight_bytes(raw)
    if not len(eight):
        return np.zeros(len(raw), np.int64)
    number = ranks(eight)
    have = 8
    while have < length:
        step = min(have, length - have)
        size = np.bincount(number)
        active = np.flatnonzero(size[number[:-step]] > 1)
        pair = number[active].astype(U) * U(len(size)) + number[active + step].astype(U)
        refined = ranks(pair)
        # Buckets of one suffix keep a number of their own.
        fresh = np.full(len(number), -1, np.int64)
        fresh[active] = refined
        rest = np.flatnonzero(fresh < 0)
        fresh[rest] = refined.max(initial=-1) + 1 + np.arange(len(rest))
        number = fresh[: len(number) - step]
        have += step
    return number


def take_ranges(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one after another."""
    offset = np.cumsum(size) - size
    return raw[np.arange(int(size.sum())) + np.repeat(start - offset, size)]


def key_pieces(key: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """Cuts of a table sorted by key into pieces of whole keys, about PIECE_BYTES of text each."""
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total, cuts = np.cumsum(size), [0]
    while cuts[-1] < len(key):
        goal = (total[cuts[-1] - 1] if cuts[-1] else 0) + PIECE_BYTES
        k = max(int(np.searchsorted(total, goal, "right")), cuts[-1] + 1)
        later = np.searchsorted(heads, k)
        cuts.append(int(heads[later]) if later < len(heads) else len(key))
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def equal_ranges(raw: np.ndarray, start: np.ndarray, size: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    """For each range, the index of the equal range with the smallest doc_id (itself, if it is that one)."""
    if not len(start):
        return np.zeros(0, np.int64)
    key = textkit.Hasher(raw, lower=False).ranges(start, start + size)
    order = np.lexsort((np.arange(len(key)), doc_id, key))
    head = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    first = np.empty(len(key), np.int64)
    first[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
    # Hashes agree; the bytes decide.
    same = size == size[first]
    check = np.flatnonzero(same & (first != np.arange(len(key))))
    differs = take_ranges(raw, start[check], size[check]) != take_ranges(raw, start[first[check]], size[check])
    owner = np.repeat(check, size[check])
    same[owner[differs]] = False
    return np.where(same, first, np.arange(len(key)))


def smallest_documents(raw: np.ndarray, start: np.ndarray, n: np.ndarray, key: np.ndarray, doc_id: np.ndarray, length: int) -> np.ndarray:
    """Smallest doc_id that has each window of the ranges; windows in order."""
    own = np.repeat(doc_id, n)
    _, code, count = np.unique(key, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[code] > 1)
    if not len(several):
        return own
    size = n[several] + length - 1
    text = take_ranges(raw, start[several], size)
    number = window_numbers(text, length)
    offset = np.cumsum(size) - size
    windows = np.repeat(offset - (np.cumsum(n[several]) - n[several]), n[several]) + np.arange(int(n[several].sum()))
    number = ranks(number[windows])
    least = np.full(number.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, np.repeat(doc_id[several], n[several]))
    where = np.repeat((np.cumsum(n) - n)[several] - (np.cumsum(n[several]) - n[several]), n[several]) + np.arange(len(windows))
    out = own.copy()
    out[where] = least[number]
    return out


def _batch_row(number: int, ids: list, raw: list, sizes: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([None], pa.int32()), pa.array([None], pa.int64()), pa.array([number], pa.int64()), pa.array([lookup.packed(np.concatenate(ids), 3)], pa.binary()), pa.array([lookup.packed(np.concatenate(sizes), 3)], pa.binary()), pa.array([lookup.packed(np.concatenate(raw), 3)], pa.binary())],
        ["kind", "bucket", "group", "keys", "counts", "raw"],
    )


def store_batches(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Rows of two sorts, by kind: null, a batch (ids, sizes and bytes of its documents); 0, its request."""

    def store(batches):
        task, k = TaskContext.get().partitionId(), 0
        ids, sizes, raws, keys, flags, held = [], [], [], [], [], 0

        def flush():
            asked, counts = lookup.merge(keys, flags)
            yield _batch_row((task << 32) | k, ids, raws, sizes)
            rows = lookup.request(KIND, (task << 32) | k, (asked % U(buckets)).astype(np.int64), asked, np.minimum(counts, 2))
            if rows is not None:
                yield rows.append_column("raw", pa.nulls(len(rows), pa.binary()))

        for batch in batches:
            doc_ids = np.asarray(batch.column("doc_id").fill_null(NULL_ID))
            for first, end, raw, at in textkit.chunks(batch):
                _, _, least, document = ranges(raw, at, length)
                key = textkit.mix(least) >> U(16)
                order = np.argsort(key, kind="stable")
                own = doc_ids[first + document][order]
                heads = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.zeros(0, np.int64)
                if len(heads):
                    several = np.minimum.reduceat(own, heads) != np.maximum.reduceat(own, heads)
                    keys.append(key[order][heads])
                    flags.append(1 + several.astype(np.int64))
                ids.append(doc_ids[first:end])
                sizes.append(np.diff(at))
                raws.append(raw)
                held += len(raw)
                if held >= BATCH_BYTES:
                    yield from flush()
                    ids, sizes, raws, keys, flags, held, k = [], [], [], [], [], 0, k + 1
        if ids:
            yield from flush()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(store, lookup.REQUEST + ", raw binary")


def _documents(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, sizes = lookup.unpacked(row["keys"], "<i8"), lookup.unpacked(row["counts"], "<i8")
    return ids, np.concatenate([[0], np.cumsum(sizes)]), lookup.unpacked(row["raw"], np.uint8)


def _pieces(at: np.ndarray, limit: int = textkit.CHUNK_BYTES):
    """Runs of documents of at most limit bytes (one document at least)."""
    first = 0
    while first < len(at) - 1:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, end
        first = end


RANGES = "bucket long, group long, arrays binary, raw binary"
#: Columns of a packed table of ranges: minimiser, doc_id, place of the range in its batch, number of windows.
FIELDS = np.dtype([("key", "<u8"), ("doc_id", "<i8"), ("place", "<i8"), ("n", "<i8")])


def _pack_table(table: np.ndarray) -> bytes:
    return lookup.packed(np.concatenate([table[f].view("<i8") for f in FIELDS.names]), 3)


def _unpack_table(blob: bytes) -> np.ndarray:
    flat = lookup.unpacked(blob, "<i8").reshape(len(FIELDS.names), -1)
    out = np.empty(flat.shape[1], FIELDS)
    for f, column in zip(FIELDS.names, flat, strict=True):
        out[f] = column.view(FIELDS[f])
    return out


def _removed(group: int, start: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Removed ranges of one batch, as a row of the ranges table without a bucket."""
    order = np.argsort(start, kind="stable")
    return _range_rows([None], [group], [lookup.packed(np.concatenate([start[order], size[order]]).astype("<i8"))], [None])


def _range_rows(bucket: list, group: list, arrays: list, raw: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(group, pa.int64()), pa.array(arrays, pa.binary()), pa.array(raw, pa.binary())], ["bucket", "group", "arrays", "raw"])


def shared_flags(asked: DataFrame) -> DataFrame:
    """group, bucket, flags (packed bits, in the order of the request): which keys several documents have.

    A batch asks for a key once, so a bucket holds about as many keys at any size of the input.
    """

    def work(batches):
        for rows in sorted_groups(batches, "bucket"):
            keys = [lookup.unpack_keys(k) for k in rows.column("keys").to_pylist()]
            found, totals = lookup.merge(keys, [lookup.unpacked(c, "<i8") for c in rows.column("counts").to_pylist()])
            several = totals > 1
            flags = [np.packbits(several[np.searchsorted(found, k)]).tobytes() for k in keys]
            yield pa.RecordBatch.from_arrays([*(rows.column(n).combine_chunks() for n in ("group", "bucket")), pa.array(flags, pa.binary())], ["group", "bucket", "flags"])

    dealt = asked.select("bucket", "group", "keys", "counts").repartition("bucket").sortWithinPartitions("bucket", "group")
    return dealt.mapInArrow(work, "group long, bucket long, flags binary")


def _texts(stored: DataFrame) -> DataFrame:
    """Batches, with the same columns wherever they are joined, so that one exchange serves all joins of a query."""
    return stored.where("kind is null").select("group", "keys", "counts", "raw")


def shared_ranges(stored: DataFrame, flags: DataFrame, length: int, buckets: int) -> DataFrame:
    """Ranges of shared minimisers by bucket; and, without a bucket, what a batch can settle on its own."""
    told = flags.groupBy("group").agg(F.collect_list(F.struct("bucket", "flags")).alias("told"))

    def work(batches):
        for row in (r for batch in batches for r in batch.to_pylist()):
            ids, at, raw = _documents(row)
            found = []
            for first, end in _pieces(at):
                start, n, least, document = ranges(raw[at[first] : at[end]], at[first : end + 1] - at[first], length)
                found.append((start + at[first], n, least, document + first))
            if not found:
                continue
            start, n, least, document = (np.concatenate(f) for f in zip(*found, strict=True))
            distinct, code = np.unique(textkit.mix(least) >> U(16), return_inverse=True)
            bucket = (distinct % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            shared = np.zeros(len(distinct), bool)
            for answer in row["told"] or []:
                mine = order[edges[answer["bucket"]] : edges[answer["bucket"] + 1]]
                shared[mine] = np.unpackbits(np.frombuffer(answer["flags"], np.uint8), count=len(mine))
            mine = shared[code]
            start, n, least, owner = start[mine], n[mine], least[mine], ids[document[mine]]
            yield from _settle_and_send(row["group"], raw, start, n, least, owner, length, least_bucket(least, buckets))

    return _texts(stored).join(told, "group", "left").mapInArrow(work, RANGES)


def least_bucket(least: np.ndarray, buckets: int) -> np.ndarray:
    return (textkit.mix(least ^ U(textkit.BASE)) % U(buckets)).astype(np.int64)


def _settle_and_send(group, raw, start, n, least, owner, length, bucket):
    """Equal ranges of larger documents are removed here; the others go to their buckets."""
    size = n + length - 1
    settled = []
    send = np.ones(len(start), bool)
    # Ranges of equal minimisers next to each other, so that every piece holds whole groups.
    order = np.argsort(least, kind="stable")
    start, size, n, least, owner, bucket = (x[order] for x in (start, size, n, least, owner, bucket))
    for a, b in key_pieces(least, size):
        text = take_ranges(raw, start[a:b], size[a:b])
        first = equal_ranges(text, np.cumsum(size[a:b]) - size[a:b], size[a:b], owner[a:b])
        gone = owner[a:b][first] < owner[a:b]
        send[a:b] = ~gone
        settled.append(np.flatnonzero(gone) + a)
    if settled:
        settled = np.concatenate(settled)
        if len(settled):
            yield _removed(group, start[settled], size[settled])
    start, size, n, least, owner, bucket = (x[send] for x in (start, size, n, least, owner, bucket))
    table = np.empty(len(start), FIELDS)
    table["key"], table["doc_id"], table["place"], table["n"] = least, owner, start, n
    order = np.argsort(bucket, kind="stable")
    found, heads = np.unique(bucket[order], return_index=True)
    for b, rows in zip(found.tolist(), np.split(order, heads[1:]) if len(found) else [], strict=True):
        yield _range_rows([b], [group], [_pack_table(table[rows])], [lookup.packed(take_ranges(raw, start[rows], size[rows]), 3)])


def settle(sent: DataFrame, length: int, forward: bool) -> DataFrame:
    """Per task of bucket rows: removed ranges by batch; with forward, also the ranges with a window that stays, again by bucket.

    Rows without a bucket, ranges removed before, pass through.
    """

    def work(batches):
        for rows in sorted_groups(batches, "task"):
            done = rows.filter(pc.is_null(rows.column("bucket")))
            yield from done.select(["bucket", "group", "arrays", "raw"]).to_batches()
            rows = rows.filter(pc.is_valid(rows.column("bucket")))
            if not len(rows):
                continue
            bucket = rows.column("bucket")[0].as_py()
            tables = [_unpack_table(b) for b in rows.column("arrays").to_pylist()]
            groups = np.repeat(np.asarray(rows.column("group")), [len(t) for t in tables])
            table = np.concatenate(tables)
            raw = np.concatenate([lookup.unpacked(b, np.uint8) for b in rows.column("raw").to_pylist()])
            size = table["n"] + length - 1
            start = np.cumsum(size) - size
            order = np.argsort(table["key"], kind="stable")
            open_rows, gone_rows, gone_starts, gone_sizes = [], [], [], []
            for a, b in key_pieces(table["key"][order], size[order]):
                rows_here = order[a:b]
                piece, n = table[rows_here], size[rows_here]
                text = take_ranges(raw, start[rows_here], n)
                at = np.cumsum(n) - n
                least = smallest_documents(text, at, piece["n"], piece["key"], piece["doc_id"], length)
                n = piece["n"]
                head = np.cumsum(n) - n
                gone = least < np.repeat(piece["doc_id"], n)
                # Runs of removed windows become one range each.
                hit = np.flatnonzero(gone)
                owner = np.repeat(np.arange(len(piece)), n)[hit]
                new = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[1:] != owner[:-1])]) if len(hit) else np.zeros(0, bool)
                runs = np.flatnonzero(new)
                open_rows.append(rows_here[~np.logical_and.reduceat(gone, head)])
                gone_rows.append(rows_here[owner[runs]])
                gone_starts.append(piece["place"][owner[runs]] + hit[runs] - head[owner[runs]])
                gone_sizes.append(np.diff(np.append(runs, len(hit))) + length - 1)
            if not open_rows:
                continue
            owners, begins, sizes, rest = groups[np.concatenate(gone_rows)], np.concatenate(gone_starts), np.concatenate(gone_sizes), np.concatenate(open_rows)
            order = np.argsort(owners, kind="stable")
            found, edges = np.unique(owners[order], return_index=True)
            for g, mine in zip(found.tolist(), np.split(order, edges[1:]) if len(found) else [], strict=True):
                yield _removed(g, begins[mine], sizes[mine])
            if forward:
                rest = rest[np.argsort(groups[rest], kind="stable")]
                found, edges = np.unique(groups[rest], return_index=True)
                for g, mine in zip(found.tolist(), np.split(rest, edges[1:]) if len(found) else [], strict=True):
                    yield _range_rows([bucket], [g], [_pack_table(table[mine])], [lookup.packed(take_ranges(raw, start[mine], size[mine]), 3)])

    dealt = sent.select("task", "bucket", "group", "arrays", "raw").repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(work, RANGES)


def remove(stored: DataFrame, removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (removed ranges of the text, maximal) and kept (the bytes left) of every document."""
    cuts = removed.groupBy("group").agg(F.collect_list("arrays").alias("cuts"))
    spans_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def work(batches):
        for row in (r for batch in batches for r in batch.to_pylist()):
            ids, at, raw = _documents(row)
            edge = np.zeros(len(raw) + 1, np.int32)
            for arrays in row["cuts"] or []:
                start, size = lookup.unpacked(arrays, "<i8").reshape(2, -1)
                np.add.at(edge, start, 1)
                np.subtract.at(edge, start + size, 1)
            gone = np.cumsum(edge[:-1]) > 0
            border = np.zeros(len(raw) + 1, bool)
            border[at] = True
            before = np.concatenate([[False], gone[:-1]]) if len(gone) else gone
            after = np.concatenate([gone[1:], [False]]) if len(gone) else gone
            begins = np.flatnonzero(gone & (~before | border[:-1]))
            ends = np.flatnonzero(gone & (~after | border[1:])) + 1
            per_doc = np.searchsorted(begins, at)
            base = np.repeat(at[:-1], np.diff(per_doc))
            kept = raw[~gone]
            left = np.zeros(len(raw) + 1, np.int64)
            np.cumsum(~gone, out=left[1:])
            kept_at = left[at]
            del left, edge, border, before, after
            for first, end in _pieces(at):
                k, s = kept_at[first : end + 1], per_doc[first : end + 1]
                values = pa.Array.from_buffers(pa.binary(), end - first, [None, pa.py_buffer((k - k[0]).astype(np.int32).tobytes()), pa.py_buffer(kept[k[0] : k[-1]].tobytes())])
                spans = pa.StructArray.from_arrays([pa.array((x[s[0] : s[-1]] - base[s[0] : s[-1]])) for x in (begins, ends)], ["from", "to"])
                doc_ids = pa.array(ids[first:end], pa.int64(), mask=ids[first:end] == NULL_ID)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(np.diff(at[first : end + 1])), pa.ListArray.from_arrays((s - s[0]).astype(np.int32), spans).cast(spans_type), values], ["doc_id", "n_bytes", "spans", "kept"])

    return _texts(stored).join(cuts, "group", "left").mapInArrow(work, "doc_id long, n_bytes long, spans array<struct<from: long, to: long>>, kept binary")


def remove_repeats(docs: DataFrame, length: int = 50, batches_per_salt: int = BATCHES_PER_SALT) -> DataFrame:
    """doc_id, n_bytes, spans, kept of every document of docs(doc_id, text). length: 16 bytes at least."""
    if length < GRAM:
        raise ValueError(f"length has to be {GRAM} at least")
    buckets = max(64, math.ceil(text_bytes(docs) / BUCKET_BYTES))
    stored = stage(store_batches(docs, length, buckets), "suffix-batches")
    asked = stored.where("kind is not null").drop("raw")
    groups = stored.where("kind is null").count()
    sent = shared_ranges(stored, shared_flags(asked), length, buckets)
    salts = max(1, math.ceil(groups / batches_per_salt))
    if salts > 1:
        sent = settle(_dealt(sent, "bucket", F.pmod(F.xxhash64("group"), F.lit(salts))), length, forward=True)
    return remove(stored, settle(_dealt(sent, "bucket"), length, forward=False))


def _dealt(rows: DataFrame, *keys) -> DataFrame:
    """Adds the task; rows without a bucket go anywhere."""
    return rows.withColumn("task", F.when(F.col("bucket").isNull(), F.xxhash64("group")).otherwise(F.xxhash64(*keys)))
