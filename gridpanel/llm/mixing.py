"""Mixing sources to target weights, with DataFrame functions only.

Each source's words are laid end to end (documents in an order that a hash
gives) and packed into blocks of a fixed number of words. The mix is a sequence
of slots, dealt in shards; a pseudorandom permutation of the slots gives every
shard its counts per source. That is the multinomial draw under the condition
that the totals meet the targets: a plain one misses small sources' targets by
chance and could pass the limit of repeats. A source's slots, numbered through
all shards, are mapped through one pseudorandom permutation of its block indices
per epoch, and blocks and slots are joined by index.

Running word counts use two levels, about sqrt(n) hash-dealt chunks per source,
so no task has to read a whole source. Sources themselves are a dictionary: the
table of one row per source is ordered in one task.

The same data and seed give the same mix. Defined results: null and empty texts
have size 0 and take part with 0; a null source is a source (the last one);
equal rows are separate documents; an empty table gives an empty result; a
source without words has target 0. A document's words are taken at most
``max_repeat`` times.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm.common import SPACES, WORD, packed, stage

ROUNDS = 12
SLOTS_PER_TASK = 1 << 16


def _partner(x: Column, r: Column, size: Column, keys: list[Column], seed: int) -> Column:
    return F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, *keys), size) - x, size)


def _swapped(x: Column, other: Column, r: Column, keys: list[Column], seed: int) -> Column:
    swap = F.xxhash64(F.lit(seed + 1), r, *keys, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
    return F.when(swap, other).otherwise(x)


def permute(value: Column, size: Column, keys: list[Column], seed: int) -> Column:
    """value in [0, size) through a pseudorandom permutation of that range, one for each value of keys.

    Swap-or-not shuffle: round r pairs x with (k_r - x) mod size and a hash of
    the pair says whether they change places. It works for any size.
    """

    def round_(x: Column, r: Column) -> Column:
        return _swapped(x, _partner(x, r, size, keys, seed), r, keys, seed)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), value.cast("long"), round_)


def permuted(rows: DataFrame, name: str, value: Column, size: Column, keys: list[Column], seed: int) -> DataFrame:
    """Adds ``permute(value, size, keys, seed)``: a projection for each step, which is compiled, where lambdas are interpreted.

    Stage the result before filtering or joining by it: a condition pushed through the steps doubles with each.
    """
    rows = rows.withColumn("_x", value.cast("long"))
    for k in range(1, ROUNDS + 1):
        rows = rows.withColumn("_other", _partner(F.col("_x"), F.lit(k), size, keys, seed))
        rows = rows.withColumn("_x", _swapped(F.col("_x"), F.col("_other"), F.lit(k), keys, seed))
    return rows.withColumn(name, F.col("_x")).drop("_x", "_other")


def count_words(text: Column) -> Column:
    """Number of words: what lies between two white-space characters, where it is not empty."""
    return F.coalesce(F.size(F.array_remove(F.split(text, f"[{SPACES}]"), "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """sources(source, source_size) plus index, weight and target.

    Targets share all words by weight; one that would pass max_repeat times its
    source stops there and the rest is shared again. The level at which no
    source is above is found on the sources ordered by the level they stop at.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("index", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("index") % len(weights) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("_most", F.lit(float(max_repeat)) * F.col("source_size"))
    by_stop = Window.orderBy((F.col("_most") / F.col("weight")), "index")
    total = F.sum("source_size").over(Window.partitionBy())
    before = F.coalesce(F.sum("_most").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("_level", (total - before) / left)
    reached = F.when(F.col("_level") <= F.col("_most") / F.col("weight"), F.col("_level"))
    level = F.max(reached).over(Window.partitionBy())
    return levels.withColumn("_at", level).select("source", "source_size", "index", "weight", F.least(F.col("_most"), F.coalesce(F.col("_at"), F.lit(0.0)) * F.col("weight")).alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeat: int = 3,
    block_words: int = 64,
    shard_slots: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """Per document: doc_id, _row (hash of all its columns), size, source_size, target, taken, and
    spans: array of (from, to, times), the word ranges the mix takes and how often."""
    spark = docs.sparkSession
    sized = stage(docs.select("doc_id", F.xxhash64(*docs.columns).alias("_row"), "source", count_words(F.col("text")).alias("size")), "mix-sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat)
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    sources = sources.withColumn("blocks", blocks).withColumn("slots", F.coalesce(F.round(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size"))), F.lit(0)).cast("long"))
    sources = stage(sources.withColumn("first_slot", F.sum("slots").over(Window.orderBy("index")) - F.col("slots")), "mix-sources")
    n_docs, n_slots = sized.count(), sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    placed = _placed(sized, sources, max(1, math.isqrt(n_docs)))
    last = F.greatest(F.col("start"), F.col("start") + F.col("size") - 1)
    pieces = placed.where("size > 0").select("index", "start", "size", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.floor(last / block_words))).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block_words) - F.col("start")
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.col("start")
    pieces = pieces.select("index", "start", "block", begin.alias("from"), end.alias("to"))

    takes = stage(_takes(spark.range(n_slots).withColumnRenamed("id", "slot"), sources, n_slots, shard_slots, seed), "mix-takes")
    taken = (
        pieces.join(takes, ["index", "block"])
        .groupBy("index", "start")
        .agg(F.sum((F.col("to") - F.col("from")) * F.col("times")).alias("taken"), F.sort_array(F.collect_list(F.struct("from", "to", "times"))).alias("spans"))
    )
    # Documents without words have no start of their own; they match nothing here.
    key = F.when(F.col("size") > 0, F.col("start"))
    out = placed.withColumn("start", key).join(taken, ["index", "start"], "left")
    return out.select("doc_id", "_row", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "spans")


def _placed(sized: DataFrame, sources: DataFrame, chunks: int) -> DataFrame:
    """Documents with their source's columns and start, the number of their source's words before them."""
    named = sources.select(F.col("source").alias("_source"), "index", "source_size", "target")
    dealt = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "_row"), F.lit(chunks)))
    per_chunk = dealt.groupBy("index", "chunk").agg(F.sum("size").alias("_words"))
    offsets = per_chunk.select("index", "chunk", (F.sum("_words").over(Window.partitionBy("index").orderBy("chunk")) - F.col("_words")).alias("_before"))
    inside = Window.partitionBy("index", "chunk").orderBy("doc_id", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = dealt.withColumn("_inside", F.sum("size").over(inside) - F.col("size"))
    return running.join(offsets, ["index", "chunk"]).withColumn("start", F.col("_before") + F.col("_inside")).drop("_before", "_inside", "chunk")


def _takes(slots: DataFrame, sources: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """index, block, times: how often the mix takes each block."""
    counts = shard_counts(slots, sources, n_slots, shard_slots, seed)
    in_order = Window.partitionBy("index").orderBy("shard")
    numbered = counts.withColumn("_end", F.sum("count").over(in_order)).withColumn("_begin", F.col("_end") - F.col("count"))
    # counts are few rows and slots many: spread before they are laid out
    numbered = numbered.repartition(max(1, math.ceil(n_slots / SLOTS_PER_TASK)), "index", "shard")
    each = numbered.select("index", F.explode(F.sequence(F.col("_begin"), F.col("_end") - 1)).alias("k"))
    each = each.join(sources.where("blocks > 0").select("index", "blocks"), "index")
    each = each.select("index", "blocks", F.expr("k div blocks").alias("epoch"), F.expr("k % blocks").alias("i"))
    drawn = permuted(each, "block", F.col("i"), F.col("blocks"), [F.col("index"), F.col("epoch")], seed).select("index", "block")
    return drawn.groupBy("index", "block").agg(F.count("*").alias("times"))


def shard_counts(slots: DataFrame, sources: DataFrame, n_slots: int, shard_slots: int, seed: int) -> DataFrame:
    """shard, index, count: slots of each source in each output shard, given the totals.

    A slot's permuted number falls into one source's range of first_slot; the
    ranges are found by an equi-join on equal-width cells, which they are cut into.
    """
    width = max(1, n_slots // 4096)
    placed = permuted(slots.select("slot"), "place", F.col("slot"), F.lit(max(n_slots, 1)).cast("long"), [], seed + 2)
    drawn = stage(placed, "mix-slots").select(F.expr(f"slot div {shard_slots}").alias("shard"), "place", F.expr(f"place div {width}").alias("cell"))
    end = F.col("first_slot") + F.col("slots")
    cells = sources.where("slots > 0").select("index", "first_slot", end.alias("end_slot"), F.explode(F.sequence(F.expr(f"first_slot div {width}"), F.floor((end - 1) / width))).alias("cell"))
    inside = (F.col("place") >= F.col("first_slot")) & (F.col("place") < F.col("end_slot"))
    return drawn.join(cells, "cell").where(inside).groupBy("shard", "index").count()


def materialize(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mixed documents with the columns of docs: one row for each time words of a document are taken.

    The t-th row of a document holds the ranges taken at least t times, with
    their white space; a document taken whole keeps its text as it is.
    """
    keyed = docs.select(packed(docs).alias("_in"), F.col("doc_id").alias("_doc"), F.xxhash64(*docs.columns).alias("_row"))
    keyed = keyed.dropDuplicates(["_doc", "_row"])
    spans = mixed.where("taken > 0").select(F.col("doc_id").alias("_of_doc"), F.col("_row").alias("_of_row"), "size", "spans")
    both = keyed.join(spans, F.col("_doc").eqNullSafe(F.col("_of_doc")) & (F.col("_row") == F.col("_of_row")))
    times = F.expr("explode(sequence(1, cast(array_max(transform(spans, s -> s.times)) as int)))")
    copies = both.select("_in", "size", "spans", times.alias("_time"))
    chosen = F.expr("filter(spans, s -> s.times >= _time)")
    copies = copies.withColumn("_chosen", chosen).withColumn("_words", F.expr("aggregate(_chosen, 0L, (n, s) -> n + s.to - s.from)"))
    cut = F.expr(
        f"""element_at(transform(array(regexp_extract_all(_in.text, r'[{SPACES_TEXT}]*{WORD}', 0)),
              w -> array_join(transform(_chosen, s -> array_join(slice(w, cast(s.from + 1 as int), cast(s.to - s.from as int)), '')), '')), 1)"""
    )
    changed = {"text": F.when(F.col("_words") == F.col("size"), F.col("_in.text")).otherwise(F.ltrim(cut))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)
    return copies.select(*[changed.get(c, F.col("_in").getField(c)).alias(c) for c in docs.columns])


SPACES_TEXT = "\\x20\\x09-\\x0D"
