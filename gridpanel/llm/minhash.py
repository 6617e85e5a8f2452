"""Near-duplicate groups by b-bit MinHash, confirmed on full shingle sets.

1. Every whole text becomes a set of word shingles; of 160 minima, all go into
   32 band keys of 5, and the low 2 bits of each into a packed signature.
   Documents with equal sets are one class from here on.
2. Band buckets with several classes give candidates. Similarity is estimated
   by counting equal bit pairs of the signatures, corrected for chance
   collisions; estimates that a true link cannot fall under (more than five
   standard errors) are dropped, the others join a bucket's members into
   trees. A very large bucket is joined as a whole, without estimates.
3. The components of that graph hold every true link. Inside them, full sets
   are compared: small components in one task each, large ones in blocks
   (block by block, then a star from the best-connected member of the largest
   cluster, then what is still outside that cluster against everything).

A link of similarity 0.8 shares no band with probability 3e-6, one of 0.9 with
4e-13. No step makes all pairs of a bucket or gathers a large one in one task.

Defined results: A-Z are lower-cased; a text with fewer words than a shingle is
one shingle of all its words; null, empty and blank texts have an empty set and
are linked with nothing; rows that repeat a doc_id are separate documents and
the component is named by the smallest doc_id in it (null ids are smaller than
none: they name a component only where there is no other); an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.llm import textkit
from gridpanel.llm.common import packed, row_id, stage
from gridpanel.llm.components import connected_components, smallest_reached

BANDS, ROWS, BITS = 32, 5, 2
MINIMA = BANDS * ROWS
SPREAD = 5.3
MOST = 8192
_rng = np.random.default_rng(8)
MULTIPLIERS = (_rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * 2 + 1).astype(np.uint32)
ADDENDS = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
SIGNATURE_BYTES = MINIMA * BITS // 8
_PAIRS = np.uint64(0x5555555555555555)  # one bit of each pair of bits
_COLUMNS = 8192


def shingle_sets(raw: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all documents, grouped by document, and the counts per document."""
    starts, ends, first = textkit.word_ranges(raw, at)
    hashes = textkit.Hasher(raw, lower=True).ranges(starts, ends)
    counts = np.diff(first)
    pieces, owners = [], []
    for length in range(1, words + 1):
        if length < words:
            head = first[:-1][counts == length]
        else:
            doc = textkit.row_of(first)
            head = np.flatnonzero(doc[: len(doc) - words + 1] == doc[words - 1 :]) if len(doc) >= words else np.zeros(0, np.int64)
        chain = np.full(len(head), length, np.uint64)
        for k in range(length):
            chain = textkit.mix(chain * np.uint64(textkit.BASE) + hashes[head + k])
        pieces.append(chain)
        owners.append(np.searchsorted(first, head, "right") - 1)
    shingles, owner = np.concatenate(pieces), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    shingles, owner = shingles[order], owner[order]
    fresh = ~pd.Series(shingles ^ textkit.mix(owner.astype(np.uint64))).duplicated().to_numpy()
    return shingles[fresh], np.bincount(owner[fresh], minlength=len(at) - 1)


def minima(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(documents, MINIMA) smallest values of the hash family; empty sets keep the largest value."""
    out = np.full((len(counts), MINIMA), np.uint32(0xFFFFFFFF))
    owner = np.repeat(np.arange(len(counts)), counts)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(short), 4096):
        doc = owner[a : a + 4096]
        heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        values = MULTIPLIERS[:, None] * short[a : a + 4096][None, :] + ADDENDS[:, None]
        lowest = np.minimum.reduceat(values, heads, axis=1).T
        out[doc[heads]] = np.minimum(out[doc[heads]], lowest)
    return out


def pack_bits(lowest: np.ndarray) -> np.ndarray:
    """Low BITS bits of each minimum, packed: (documents, SIGNATURE_BYTES)."""
    bits = (lowest[:, :, None] >> np.arange(BITS, dtype=np.uint32)) & 1
    return np.packbits(bits.reshape(len(lowest), -1).astype(np.uint8), axis=1)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of packed signatures, corrected for chance collisions; 64 bits are counted at once."""
    differ = np.ascontiguousarray(one).view(np.uint64) ^ np.ascontiguousarray(many).view(np.uint64)
    unequal = np.bitwise_count((differ | (differ >> np.uint64(1))) & _PAIRS).sum(axis=-1, dtype=np.int64)
    chance = 0.5**BITS
    return (1 - unequal / MINIMA - chance) / (1 - chance)


def lowest_estimate(similarity: float) -> float:
    """Estimates of true links stay above this."""
    chance = 0.5**BITS
    p = chance + (1 - chance) * similarity
    return similarity - SPREAD * float(np.sqrt(p * (1 - p) / MINIMA)) / (1 - chance)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """node (unique), doc_id, row, n_shingles, set_a, set_b (fingerprint of the set), signature, bands. Not yet written."""

    def sign(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            for _, _, raw, at in textkit.chunks(batch):
                shingles, counts = shingle_sets(raw, at, words)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (textkit.mix(shingles), textkit.mix(shingles ^ np.uint64(textkit.BASE)))]
                bounds = np.concatenate([[0], np.cumsum(counts)])
                lowest = minima(shingles, counts)
                bands = np.zeros((len(counts), BANDS), np.uint64)
                for k in range(ROWS):
                    bands = textkit.mix(bands * np.uint64(textkit.BASE) + lowest[:, k::ROWS].astype(np.uint64) + np.uint64(1))
                for column, values in zip(columns, (counts, *[(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums], pack_bits(lowest), bands.view(np.int64)), strict=True):
                    column.append(values)
            n, a, b, packed, bands = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
            packed = pa.array([x.tobytes() for x in packed], pa.binary())
            bands = pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * BANDS, pa.array(bands.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(n.astype(np.int64)), pa.array(a), pa.array(b), packed, bands], ["doc_id", "row", "n_shingles", "set_a", "set_b", "signature", "bands"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id(F.col("doc_id"), F.col("text")).alias("row"), F.col("text").cast("string").alias("text"))
    signed = texts.mapInArrow(sign, "doc_id long, row long, n_shingles long, set_a long, set_b long, signature binary, bands array<long>")
    return signed.withColumn("node", F.monotonically_increasing_id())


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal keys from batches sorted by key; a run can go on in the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        values = np.asarray(batch.column(key))
        cuts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            piece = batch.slice(a, b - a)
            if held and held[-1].column(key)[0].as_py() != values[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(piece)
    if held:
        yield pa.Table.from_batches(held)


def candidate_edges(classes: DataFrame, similarity: float, most: int = MOST) -> DataFrame:
    """a, b: trees over the candidates of each band bucket, by estimate; an edge can repeat. classes: node, signature, bands."""
    exploded = classes.select("node", F.posexplode("bands").alias("band", "value")).select("node", F.xxhash64("band", "value").alias("bucket"))
    sizes = exploded.groupBy("bucket").agg(F.count("*").alias("members"), F.min("node").alias("least")).where("members > 1")
    shared = stage(exploded.join(sizes, "bucket"), "minhash-buckets")
    whole = shared.where(F.col("members") > most).where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    cut = lowest_estimate(similarity)

    def trees(batches):
        for rows in _bounded_runs(batches, "bucket"):
            edges = _bucket_trees(np.asarray(rows.column("bucket")), np.asarray(rows.column("node")), np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(-1, SIGNATURE_BYTES), cut)
            yield pa.RecordBatch.from_arrays([pa.array(edges[0], pa.int64()), pa.array(edges[1], pa.int64())], ["a", "b"])

    signed = shared.where(F.col("members") <= most).select("bucket", "node").join(classes.select("node", "signature"), "node")
    dealt = signed.repartition("bucket").sortWithinPartitions("bucket", "node")
    return dealt.mapInArrow(trees, "a long, b long").unionByName(whole)


def _bounded_runs(batches: Iterator[pa.RecordBatch], key: str, rows: int = 8192) -> Iterator[pa.Table]:
    """Whole runs of equal keys, several at once, about ``rows`` rows."""
    held, n = [], 0
    for group in sorted_groups(batches, key):
        held.append(group)
        n += len(group)
        if n >= rows:
            yield pa.concat_tables(held)
            held, n = [], 0
    if held:
        yield pa.concat_tables(held)


def _bucket_trees(bucket: np.ndarray, node: np.ndarray, signature: np.ndarray, cut: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node reached) of the estimated links inside each bucket; at most one per row."""
    size = np.bincount(np.searchsorted(np.unique(bucket), bucket))
    small = np.repeat(size, size) <= 24
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, 24):
        i = np.flatnonzero((bucket[:-d] == bucket[d:]) & small[:-d]) if len(bucket) > d else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[estimate(signature[i], signature[i + d]) >= cut]
        left.append(i)
        right.append(i + d)
    label = smallest_reached(len(node), np.concatenate(left), np.concatenate(right))
    heads = np.concatenate([[0], np.cumsum(size)])
    for a, b in zip(heads[:-1], heads[1:], strict=True):
        if b - a > 24:
            _grow_clusters(label, signature, int(a), int(b), cut)
    apart = label != np.arange(len(node))
    return node[apart], node[label[apart]]


def _grow_clusters(label: np.ndarray, signature: np.ndarray, a: int, b: int, cut: float) -> None:
    """Clusters of one larger bucket: breadth first, each member against what is still outside."""
    outside = np.arange(a, b)
    while len(outside):
        head, outside = outside[0], outside[1:]
        queue = [head]
        while queue and len(outside):
            near = estimate(signature[queue.pop()], signature[outside]) >= cut
            label[outside[near]] = head
            queue += outside[near].tolist()
            outside = outside[~near]


class Sets:
    """Full shingle sets of a few documents and the links between them."""

    def __init__(self, rows: pa.Table, words: int):
        rows = rows.combine_chunks()
        nodes = np.asarray(rows.column("node"))
        _, own = np.unique(nodes, return_index=True)
        own.sort()
        self.rows = own
        self.nodes = nodes[own]
        self.sets: list[np.ndarray] = []
        picked = rows.take(own).combine_chunks().to_batches()
        for batch in picked:
            for _, _, raw, at in textkit.chunks(batch):
                shingles, counts = shingle_sets(raw, at, words)
                self.sets += [np.sort(s) for s in np.split(shingles, np.cumsum(counts)[:-1])]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of all sets of left with all of right: products of 0-1 matrices, some shingles at a time."""
        out = np.zeros((len(left), len(right)), np.int64)
        sides = [np.concatenate([np.zeros(0, np.uint64), *[self.sets[i] for i in side]]) for side in (left, right)]
        shared = np.intersect1d(*[np.unique(s) for s in sides], assume_unique=True)
        # (column, row) of each shared shingle of each side, by column
        cells = []
        for side, values in zip((left, right), sides, strict=True):
            row = np.repeat(np.arange(len(side)), self.sizes[side])
            column = np.searchsorted(shared, values)
            held = column < len(shared)
            held[held] = shared[column[held]] == values[held]
            order = np.argsort(column[held], kind="stable")
            cells.append((column[held][order], row[held][order]))
        for start in range(0, len(shared), _COLUMNS):
            tables = []
            for side, (column, row) in zip((left, right), cells, strict=True):
                a, b = np.searchsorted(column, [start, start + _COLUMNS])
                table = np.zeros((len(side), min(_COLUMNS, len(shared) - start)), np.float32)  # sums below 2^24 are exact
                table[row[a:b], column[a:b] - start] = 1
                tables.append(table)
            out += (tables[0] @ tables[1].T).astype(np.int64)
        return out

    def links(self, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (of left, of right) with 100 * intersection >= percent * union, on the full sets."""
        if not len(left) or not len(right):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        common = self.common(left, right)
        linked = 100 * common >= percent * (self.sizes[left][:, None] + self.sizes[right][None, :] - common)
        i, j = np.nonzero(linked)
        apart = left[i] != right[j]
        return left[i[apart]], right[j[apart]]


def _compare_tasks(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """rows: task, side (0, 1 or 2: both), cluster, node, text. For each node that is joined with others in its
    task: a (the node), b (the first node of its group there, side 0 first) and the links it was seen to have."""

    def work(batches):
        for group in sorted_groups(batches, "task"):
            sets = Sets(group, words)
            frame = group.select(["node", "side", "cluster"]).to_pandas().drop_duplicates("node").set_index("node").loc[sets.nodes]
            side, cluster = frame["side"].to_numpy(), frame["cluster"].to_numpy()
            both = np.flatnonzero(side == 2)
            pairs = sets.links(both, both, percent) if len(both) else sets.links(np.flatnonzero(side == 0), np.flatnonzero(side == 1), percent)
            degree = np.bincount(np.concatenate(pairs), minlength=len(side)) // (2 if len(both) else 1)
            known = np.flatnonzero(cluster >= 0)
            _, first, which = np.unique(cluster[known], return_index=True, return_inverse=True)
            root = smallest_reached(len(side), np.append(pairs[0], known), np.append(pairs[1], known[first[which]]))
            told = (root != np.arange(len(root))) | (degree > 0)
            yield pa.RecordBatch.from_arrays([pa.array(sets.nodes[told]), pa.array(sets.nodes[root[told]]), pa.array(degree[told])], ["a", "b", "degree"])

    dealt = rows.select("task", "side", "cluster", "node", "text").repartition("task").sortWithinPartitions("task", "side", "node")
    return dealt.mapInArrow(work, "a long, b long, degree long")


def confirmed_links(members: DataFrame, words: int, percent: int, small: int = 256, block: int = 128) -> DataFrame:
    """a, b: links on full sets that connect each component as all its links would.

    members: node, component (of the candidates), text. Components of up to
    ``small`` documents are compared in one task.
    """
    rows = members.count()
    sizes = stage(members.groupBy("component").agg(F.count("*").alias("members")), "minhash-sizes", rows)
    sized = members.join(sizes, "component")
    alone = F.lit(-1).cast("long").alias("cluster")
    little = sized.where(F.col("members") <= small).select(F.col("component").alias("task"), F.lit(2).alias("side"), alone, "node", "text")
    links = stage(_compare_tasks(little, words, percent), "minhash-links")
    if not sizes.where(F.col("members") > small).limit(1).count():
        return links.select("a", "b")
    # Blocks of about ``block`` documents by hash, each compared in itself.
    number = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / block))
    large = stage(sized.where(F.col("members") > small).select("component", "node", "text", number.alias("block")), "minhash-large")
    texts = large.select("node", "text")
    inside = large.select(F.xxhash64("component", "block").alias("task"), F.lit(2).alias("side"), alone, "node", "text")
    inside = stage(_compare_tasks(inside, words, percent), "minhash-links")
    links = links.unionByName(inside)
    state = large.select("component", "block", "node").join(inside.withColumnRenamed("a", "node"), "node", "left")
    state = _with_largest(state.select("component", "block", "node", F.coalesce("b", "node").alias("cluster"), F.coalesce("degree", F.lit(0)).alias("degree")), rows)
    if not state.where("not inside").limit(1).count():
        return links.select("a", "b")
    # The member with most links of the largest cluster against all that are outside it.
    hubs = state.where("inside").groupBy("component").agg(F.max_by("node", F.struct("degree", -F.col("node"))).alias("hub"))
    hubs = stage(hubs, "minhash-hubs", rows)
    tasks = state.where("not inside").join(hubs, "component").select(F.xxhash64("component", "block").alias("task"), "hub", F.lit(1).alias("side"), "cluster", "node")
    centres = tasks.select("task", F.col("hub").alias("node")).distinct().select("task", F.lit(0).alias("side"), alone, "node")
    stars = tasks.select("task", "side", "cluster", "node").unionByName(centres).join(texts, "node")
    stars = stage(_compare_tasks(stars, words, percent), "minhash-links")
    links = links.unionByName(stars)
    reached = stars.join(hubs.select(F.col("hub").alias("b")), "b", "left_semi").select(F.col("a").alias("node"))
    moved = state.join(reached, "node", "left_semi").select("component", "cluster").distinct().withColumn("_moved", F.lit(True))
    state = state.join(moved, ["component", "cluster"], "left").withColumn("cluster", F.when(F.col("_moved"), F.col("top")).otherwise(F.col("cluster")))
    state = _with_largest(state.select("component", "block", "node", "cluster", "degree"), rows)
    if not state.where("not inside").limit(1).count():
        return links.select("a", "b")
    # What is still outside the largest cluster against whom it can be linked with: blocks of groups that share rare
    # shingles. Two blocks that both have such members meet once, as wholes: what lies inside the largest cluster on
    # both sides is joined already.
    groups = connected_components(_rare_edges(state, texts, words, percent))
    state = state.drop("component", "block").join(groups, "node")
    sizes = stage(state.groupBy("component").agg(F.count("*").alias("members")), "minhash-sizes", rows)
    state = state.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / block)))
    state = stage(state.withColumn("block", F.when(F.col("members") > small, F.col("block")).otherwise(0)), "minhash-state", rows)
    blocks = state.groupBy("component", F.col("block").alias("other")).agg(F.max(~F.col("inside")).alias("mutual"))
    parts = blocks.where("mutual").select("component", F.col("other").alias("part"))
    tasks = parts.join(blocks, "component").where("part <= other or not mutual")
    tasks = stage(tasks.withColumn("task", F.xxhash64("component", "part", "other")), "minhash-pairs")
    left = state.join(tasks, (state["component"] == tasks["component"]) & (state["block"] == tasks["part"])).where("mutual or not inside")
    right = state.join(tasks, (state["component"] == tasks["component"]) & (state["block"] == tasks["other"])).where("part <> other")
    rows = left.select("task", F.when(F.col("part") == F.col("other"), 2).otherwise(0).alias("side"), "cluster", "node")
    rows = rows.unionByName(right.select("task", F.lit(1).alias("side"), "cluster", "node"))
    rest = stage(_compare_tasks(rows.join(texts, "node"), words, percent), "minhash-links")
    return links.unionByName(rest).select("a", "b")


def _rare_edges(state: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """a, b: trees over what may still be linked with a document outside its component's largest cluster.

    Two sets with a similarity of percent share one of the first n - ceil(n * percent / 100) + 1 shingles of
    each, whatever the order of all shingles. Here those that few documents of the component hold come first, so
    documents made from one template, but of other words, do not meet. state: component, block, node, cluster, inside.
    """
    open_ones = state.where("not inside").select("component").distinct()
    rows = state.join(open_ones, "component", "left_semi").join(texts, "node")
    rows = stage(rows.select(F.xxhash64("component", "block").alias("task"), "component", "node", "cluster", "inside", "text"), "minhash-open")

    def count(batches):
        for group in sorted_groups(batches, "task"):
            sets = Sets(group, words).sets
            shingles, n = np.unique(np.concatenate(sets), return_counts=True)
            often = n >= max(4, len(sets) / 8)
            component = np.full(int(often.sum()), group.column("component")[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(component), pa.array(shingles[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["component", "shingle", "n"])

    common = rows.repartition("task").sortWithinPartitions("task", "node").mapInArrow(count, "component long, shingle long, n long")
    common = common.groupBy("component", "shingle").agg(F.sum("n").alias("n"))
    # At most about as many as eight documents have, since an eighth of a block's documents hold each.
    common = common.groupBy("component").agg(F.collect_list(F.struct("n", "shingle")).alias("common"))
    heads = rows.groupBy("task").agg(F.min("component").alias("component")).join(common, "component")
    nothing = F.lit(None)
    heads = heads.select("task", F.lit(0).alias("side"), "component", nothing.cast("long").alias("node"), nothing.cast("long").alias("cluster"), nothing.cast("boolean").alias("inside"), nothing.cast("string").alias("text"), "common")
    dealt = heads.unionByName(rows.withColumn("side", F.lit(1)), allowMissingColumns=True).repartition("task").sortWithinPartitions("task", "side", "node")

    def first_ones(batches):
        for group in sorted_groups(batches, "task"):
            side = np.asarray(group.column("side"))
            told = [x for held in group.column("common").to_pylist() if held for x in held]
            often = np.array([x["shingle"] for x in told], np.int64).view(np.uint64)
            n = np.array([x["n"] for x in told], np.int64)
            order = np.argsort(often)
            often, n = np.append(often[order], np.uint64(0)), np.append(n[order], 0)
            group = group.filter(pa.array(side == 1)).select(["component", "node", "cluster", "inside", "text"])
            sets = Sets(group, words)
            chosen = []
            for own in sets.sets:
                place = np.searchsorted(often[:-1], own)
                held = np.where(often[place] == own, n[place], 0)
                chosen.append(own[np.lexsort((own, held))][: len(own) + 1 - -(-percent * len(own) // 100)])
            at = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
            table = group.select(["component", "node", "cluster", "inside"]).take(pa.array(sets.rows[at]))
            yield from table.append_column("shingle", pa.array(np.concatenate(chosen).view(np.int64))).combine_chunks().to_batches()

    first = stage(dealt.mapInArrow(first_ones, "component long, node long, cluster long, inside boolean, shingle long"), "minhash-first")
    by = ["component", "shingle"]
    met = first.groupBy(*by).agg(F.min("node").alias("least"), F.min("cluster").alias("low"), F.max("cluster").alias("high"), F.max(~F.col("inside")).alias("open"))
    met = stage(met.where("open and low <> high").select(*by, "least"), "minhash-met", first.count())
    return first.join(met, by).where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))


def _with_largest(state: DataFrame, rows: int) -> DataFrame:
    """Adds top (the component's largest cluster) and inside (a member of it), written; rows: it has at most."""
    sizes = state.groupBy("component", "cluster").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("component").agg(F.max_by("cluster", F.struct("n", -F.col("cluster"))).alias("top"))
    return stage(state.join(largest, "component").withColumn("inside", F.col("cluster") == F.col("top")), "minhash-state", rows)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, most: int = MOST, small: int = 256, block: int = 128) -> DataFrame:
    """One row per document: doc_id, row (hash of id and text), n_shingles, component_id, kept_row.

    kept_row marks one document of each component, one with its smallest doc_id.
    """
    signed = stage(signatures(docs, words), "minhash-signed")
    count = signed.count()
    full = signed.where("n_shingles > 0")
    by_set = ["set_a", "set_b", "n_shingles"]
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))).alias("least")
    classes = stage(full.groupBy(*by_set).agg(F.min("node").alias("class"), least), "minhash-classes", count)
    rows = full.join(classes.select(F.col("class").alias("node")), "node")
    edges = stage(candidate_edges(rows.select("node", "signature", "bands"), percent / 100, most), "minhash-edges")
    groups = connected_components(edges)
    wanted = groups.join(signed.select("node", "doc_id", "row"), "node").select("node", "component", F.col("doc_id").alias("_doc"), F.col("row").alias("_row"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_id(F.col("doc_id"), F.col("text")).alias("row"), F.col("text").cast("string").alias("text"))
    members = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row") == F.col("_row"))).select("node", "component", "text")
    links = confirmed_links(stage(members, "minhash-members"), words, percent, small, block)
    named = classes.join(connected_components(links).withColumnRenamed("node", "class"), "class", "left")
    named = stage(named.select(*by_set, "least", F.coalesce("component", "class").alias("label")), "minhash-named", count)
    heads = stage(named.groupBy("label").agg(F.min("least").alias("head")), "minhash-heads", count)
    named = named.join(heads, "label").select(*by_set, F.col("head.doc_id").alias("_first_id"), F.col("head.node").alias("_first"))
    # Documents without shingles match no class and stand alone.
    out = signed.select("doc_id", "row", "node", *by_set).join(named, by_set, "left")
    component = F.when(F.col("_first").isNull(), F.col("doc_id")).otherwise(F.col("_first_id")).alias("component_id")
    return out.select("doc_id", "row", "n_shingles", component, F.coalesce(F.col("node") == F.col("_first"), F.lit(True)).alias("kept_row"))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One document of each near-duplicate group, with all its columns."""
    decided = near_duplicates(docs, **settings).where("kept_row").select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"))
    keyed = docs.select(packed(docs).alias("_in"), F.col("doc_id").alias("_key"), row_id(F.col("doc_id"), F.col("text")).alias("_id"))
    kept = keyed.join(decided, F.col("_key").eqNullSafe(F.col("_doc")) & (F.col("_id") == F.col("_row")), "left_semi")
    return kept.dropDuplicates(["_key", "_id"]).select(*[F.col("_in").getField(c).alias(c) for c in docs.columns])
