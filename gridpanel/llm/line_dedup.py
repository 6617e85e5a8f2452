"""Line deduplication with DataFrame functions only.

Line keys are hashed and the hashes range-partitioned by (hash, document), sorted
by (hash, document, position) inside each partition; a window streams the first
occurrence of every key in every document. A key that holds a large share of all
lines is cut into document ranges, and each range sends on one partial count.
What comes back is, per document, a compressed keep bitmap over its lines: 64-bit
words, of which only those with a dropped line are stored (bit i % 64 of word
i div 64 is 1 where line i stays; a word that is not stored is all ones). Text
is never shuffled to find the lines, only to apply the bitmaps.

Defined results: a null or empty text is one empty line; keys shorter than
``min_points`` code points are never dropped; a document is a row, and equal rows
(same doc_id, same text) count as one document and get the same bitmap; rows
with a null doc_id are told apart by their text; an empty table gives an empty
result. A document whose lines are all dropped keeps an empty text. A line's key
is 96 hash bits of the line without white space at its ends and with A-Z in
lower case. Extra columns are kept by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpanel.llm.common import lowered, packed, row_id, stage

ENDS = " \t\n\x0b\x0c\r"
KEY = ["_hash", "_check"]
ROW = ["_doc", "_row"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, min_points: int = 1) -> DataFrame:
    """One row per line whose key has at least min_points code points."""
    lines = docs.select(F.col("doc_id").alias("_doc"), row_id(F.col("doc_id"), F.col("text")).alias("_row"), F.posexplode(_lines(F.col("text"))).alias("_line", "_text"))
    key = lowered(F.btrim("_text", F.lit(ENDS)))
    return lines.select(*ROW, "_line", key.alias("_key")).where(F.length("_key") >= min_points).select(F.xxhash64("_key").alias("_hash"), F.hash("_key").alias("_check"), *ROW, "_line")


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_points: int = 1, keep_first: bool = False) -> DataFrame:
    """Bitmaps of the documents that lose lines: _doc, _row, n_dropped, keep (array of word, bits).

    Keys found in at least min_docs documents lose all their lines, or all but
    the first one of the corpus (smallest doc_id, then position) with keep_first.
    """
    hashed = stage(line_hashes(docs, min_points), "line-hashes")
    ranged = hashed.repartitionByRange(*KEY, *ROW).sortWithinPartitions(*KEY, *ROW, "_line")
    in_document = F.row_number().over(Window.partitionBy(*KEY, *ROW).orderBy("_line"))
    firsts = ranged.withColumn("_n", in_document).where("_n = 1")
    aggregates = [F.count("*").alias("_docs")]
    if keep_first:
        aggregates.append(F.min(F.struct(F.col("_doc").isNull(), "_doc", "_row", "_line")).alias("_first"))
    frequent = stage(firsts.groupBy(*KEY).agg(*aggregates).where(F.col("_docs") >= min_docs), "line-keys")
    dropped = hashed.join(frequent, KEY)
    if keep_first:
        dropped = dropped.where(~(F.struct(F.col("_doc").isNull(), "_doc", "_row", "_line").eqNullSafe(F.col("_first"))))
    # Equal rows send the same line twice: the bits are or-ed, not added.
    bit = F.expr("shiftleft(1L, _line % 64)")
    words = dropped.groupBy(*ROW, F.expr("cast(_line div 64 as int)").alias("word")).agg(F.bit_or(bit).alias("_bits"))
    return words.groupBy(*ROW).agg(
        F.sum(F.bit_count("_bits").cast("long")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("_bits").alias("bits")))).alias("keep"),
    )


def _applied(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """_in (the input row), _kept (the remaining text), _n_lines and _n_dropped."""
    marked = docs.select(packed(docs).alias("_in"), row_id(F.col("doc_id"), F.col("text")).alias("_row"))
    right = bitmaps.withColumnRenamed("_row", "_row_right")
    joined = marked.join(right, F.col("_in.doc_id").eqNullSafe(F.col("_doc")) & (F.col("_row") == F.col("_row_right")), "left")
    # The lambdas' arguments bind the words and lines once per document.
    kept = F.expr(
        """element_at(transform(array(named_struct(
             'lines', split(_in.text, '\\n', -1),
             'words', transform(sequence(0, element_at(keep, -1).word), w -> coalesce(map_from_entries(keep)[w], -1L)))),
           d -> filter(d.lines, (x, i) -> i div 64 >= size(d.words) OR getbit(d.words[cast(i div 64 as int)], i % 64) = 1)), 1)"""
    )
    text = F.coalesce(F.col("_in.text"), F.lit(""))
    return joined.select(
        "_in",
        F.size(_lines(F.col("_in.text"))).cast("long").alias("_n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("_n_dropped"),
        F.when(F.col("keep").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("_kept"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Documents with all their columns, _kept (the remaining text), _n_lines and _n_dropped; columns of these names make way."""
    results = ["_n_lines", "_n_dropped", "_kept"]
    kept = [F.col("_in").getField(c).alias(c) for c in docs.columns if c not in results]
    return _applied(docs, bitmaps).select(*kept, *results)


def drop_lines(docs: DataFrame, **settings) -> DataFrame:
    """Documents with their frequent lines gone from text; n_chars follows where there is such a column."""
    applied = _applied(docs, keep_bitmaps(docs, **settings))
    changed = {"text": F.when(F.col("_n_dropped") > 0, F.col("_kept")).otherwise(F.col("_in.text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_n_dropped") > 0, F.length("_kept")).otherwise(F.col("_in.n_chars")).cast(docs.schema["n_chars"].dataType)
    return applied.select(*[changed.get(c, F.col("_in").getField(c)).alias(c) for c in docs.columns])
