"""Registered queries of the corpus operators, with production parameters, and the SQL of those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpanel.llm import code_trie, context_trees, line_dedup, mean_search, minhash, mixing, packing, quality, suffix_dedup, token_files, topk, toxicity, winnowing
from gridpanel.llm.common import fold, read, stage
from gridpanel.scratch import scratch_path


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 3) != 1)
    scored = toxicity.score(docs, model, threshold=0.7)
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    applied = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_docs=10, min_points=1))
    return applied.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


OP2_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM texts
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (key)
GROUP BY doc_id
"""


def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256)


OP3_SQL = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM valid q JOIN valid c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 5
"""


def op4_context_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    scored = context_trees.score(docs, fold(F.col("doc_id"), 7) != 2)
    return scored.withColumn("held_out", fold(F.col("doc_id"), 7) == 2)


def op5_token_files(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = read(spark, folder, "documents").select("doc_id", "text")
    store = scratch_path(spark, "tokens")
    manifest = token_files.write_tokens(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), end_id=2, folder=store)
    return token_files.read_documents(spark, manifest, store)


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read(spark, folder, "documents").select("doc_id", "text"), length=50)
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s
  FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
),
reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
heads AS (SELECT doc_id, least(doc_id, min(other)) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN heads USING (doc_id)
"""


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents").select("doc_id", "text"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    stats = stage(quality.document_stats(docs), "quality")
    judged = quality.judge(stats, quality.train(stats, labels))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality_score")


def op11_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = winnowing.find_passages(docs, read(spark, folder, "benchmark").select("item_id", "text"), window=10)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    items = [F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")]
    return found.select("doc_id", "n_words", hits.alias("n_hit"), *items, (hits > 0).alias("contaminated"))


OP11_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
item_starts AS (SELECT item_id, w, least(10, len(w)) AS t, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, t, array_to_string(w[i : i + t - 1], ' ') AS g FROM item_starts),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
doc_starts AS (SELECT doc_id, w, t, unnest(range(1, len(w) - t + 2)) AS i FROM doc_words, (SELECT DISTINCT t FROM windows)),
hits AS (
  SELECT DISTINCT d.doc_id, d.t, d.i, x.item_id
  FROM (SELECT doc_id, t, i, array_to_string(w[i : i + t - 1], ' ') AS g FROM doc_starts) d JOIN windows x USING (t, g)
),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + t)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def op12_code_trie(spark: SparkSession, folder: str) -> DataFrame:
    vectors = code_trie.prepare(read(spark, folder, "embeddings").select("vec_id", "embedding", "label"), scale=256)
    books = code_trie.train(vectors, parts=16, entries=64, rounds=2, scale=256)
    coded = stage(code_trie.encode(vectors, books, keep=["vec_id", "label"]), "codes")
    summed = code_trie.with_label_error(coded).drop("label")
    return summed.withColumn("codebooks_sha256", F.lit(books.sha256() if books else None).cast("string"))


def _op12_sql(rounds: int = 2) -> str:
    """The rounds, one after the other."""
    ctes = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (SELECT vec_id, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS x FROM kept, range(16) t(p)),
first_ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, e, x FROM parts JOIN first_ids USING (vec_id))"""
    for r in range(rounds + 1):
        ctes += f""",
near{r} AS (
  SELECT a.vec_id, a.p, any_value(a.x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := b.e)) AS n
  FROM parts a JOIN book{r} b USING (p) GROUP BY a.vec_id, a.p
)"""
        if r < rounds:
            ctes += f""",
sums{r} AS (
  SELECT p, n.e AS e, i, sum(y)::BIGINT AS s, count(*) AS c
  FROM (SELECT p, n, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM near{r}) GROUP BY ALL
),
moved{r} AS (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS x FROM sums{r} GROUP BY p, e),
book{r + 1} AS (SELECT p, e, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN moved{r} m USING (p, e))"""
    return ctes + f""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', n.e), '' ORDER BY p) AS code, sum(n.d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id
),
by_label AS (SELECT label, sum(error)::BIGINT AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label),
digest AS (
  SELECT sha256(string_agg(y, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(x)::VARCHAR AS y, generate_subscripts(x, 1) AS i FROM book{rounds})
)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id) JOIN by_label b ON kept.label IS NOT DISTINCT FROM b.label, digest
"""


def op13_mean_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return mean_search.cluster(vectors, k=40, rounds=5, components=64, scale=256, seed=2, keep=["vec_id"])


def _op13_sql(rounds: int = 5) -> str:
    """The rounds, one after the other."""
    ctes = """
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
centroids0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS x
  FROM (SELECT sha256('2:' || vec_id::VARCHAR) AS h, v FROM kept ORDER BY h LIMIT 40)
)"""
    for r in range(rounds + 1):
        ctes += f""",
near{r} AS (
  SELECT a.vec_id, any_value(a.v) AS v, min(struct_pack(d := list_sum(list_transform(list_zip(a.v, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, c := b.c)) AS n
  FROM kept a, centroids{r} b GROUP BY a.vec_id
)"""
        if r < rounds:
            ctes += f""",
sums{r} AS (SELECT n.c AS c, i, sum(y)::BIGINT AS s, count(*) AS m FROM (SELECT n, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM near{r}) GROUP BY ALL),
moved{r} AS (SELECT c, list((s - ((s % m) + m) % m) // m ORDER BY i) AS x FROM sums{r} GROUP BY c),
centroids{r + 1} AS (SELECT c, coalesce(k.x, b.x) AS x FROM centroids{r} b LEFT JOIN moved{r} k USING (c))"""
    return ctes + f""",
found AS (SELECT vec_id, n.c::INTEGER AS cluster, n.d AS distance FROM near{rounds})
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(x, ',')) AS centroid_sha256
FROM found JOIN centroids{rounds} ON c = cluster
"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_context_trees": op4_context_trees,
    "op5_token_files": op5_token_files,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_mixing": op7_mixing,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_winnowing": op11_winnowing,
    "op12_code_trie": op12_code_trie,
    "op13_mean_search": op13_mean_search,
}

SQL: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op3_exact_top_k": OP3_SQL,
    "op8_minhash_near_dedup": OP8_SQL,
    "op11_winnowing": OP11_SQL,
    "op12_code_trie": _op12_sql(),
    "op13_mean_search": _op13_sql(),
}
