"""The registered queries of this package: thin contracts over its operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sitegrade.llm import byte_bpe, centroids, decontamination, fill_in_middle, importance_resampling, jaccard_join, licenses, line_dedup, packing, sharding, token_counts, topk, url_filter
from sitegrade.llm.common import table

TOP_K, QUERY_EVERY = 20, 20
CONTEXT_TOKENS = 4096
SHARDS, SHARD_SEED = 16, 20240229
URL_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "n_item", "n_shared", "containment")


OP1_SQL = """
WITH d AS (SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, len(w) AS k, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0)),
ds AS (SELECT DISTINCT doc_id, w, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM d)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1)
SELECT doc_id, item_id, CAST(n_item AS INTEGER) AS n_item, CAST(count(*) AS INTEGER) AS n_shared, count(*) / n_item AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY doc_id, w, item_id, n_item HAVING count(*) / n_item >= 0.8 - 1e-9
"""


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    doc_id = F.when(F.col("doc") < importance_resampling.LAST_ID, F.col("doc")).alias("doc_id")
    return drawn.scored.select(doc_id, "log_weight", "perturbed", (F.col("perturbed") >= drawn.threshold).alias("keep"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0), TOP_K)


OP3_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.e, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.prefix_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), CONTEXT_TOKENS, keep_steps=False
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT_TOKENS).alias("over_limit"), "fit_chars")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shuffled_shards(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return shards.select(
        "doc_id", sharding.text_size().alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents")).drop("row", "group_key")


OP7_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t,
  list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
k AS (SELECT doc_id, w, CASE WHEN len(w) = 0 THEN chr(10) || t ELSE array_to_string(w, ' ') END AS k FROM d),
c AS (SELECT k, min(doc_id) AS class_id, count(*) AS n_copies, any_value(w) AS w FROM k GROUP BY k),
s AS (SELECT DISTINCT class_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT class_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM c WHERE len(w) > 0)),
n AS (SELECT class_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS both FROM s a JOIN s b ON a.s = b.s AND a.class_id < b.class_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.class_id = a JOIN n y ON y.class_id = b WHERE p.both >= 0.8 * (x.n + y.n - p.both) - 1e-9),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
g(node, label) AS (SELECT class_id, class_id FROM c UNION SELECT e.b, g.label FROM g JOIN e ON e.a = g.node),
m AS (SELECT node, min(label) AS group_id FROM g GROUP BY 1),
f AS (SELECT a, count(*) AS n_links FROM e GROUP BY 1)
SELECT k.doc_id, c.class_id, c.n_copies, coalesce(f.n_links, 0) AS n_links, m.group_id
FROM k JOIN c USING (k) JOIN m ON m.node = c.class_id LEFT JOIN f ON f.a = c.class_id
"""


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), F.broadcast(licenses.known_digests(spark)))  # the shipped list, 1 MB


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM split),
keyed AS (SELECT *, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY 1 HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (k) GROUP BY doc_id
"""


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    back = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), *vocabulary), *vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(fill_in_middle.rank_index(table(spark, sf_dir, "documents")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fill_in_middle.restored(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS h1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS h2,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
    WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
cut AS (SELECT doc_id, t, n, form, array_to_string(u[1:least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
  array_to_string(u[greatest(h1, h2) + 1:], '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(centroids.quantised(table(spark, sf_dir, "embeddings")))


def _op13_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds written out one after another; integer division is floored by taking the remainder off first."""
    steps = [f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c, e AS m FROM v
  ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), e LIMIT {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT i, vec_id, e, c, list_sum(list_transform(list_zip(e, m), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d FROM v, c{r}
  QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS j FROM a{r}) GROUP BY c, j),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(any_value(f), any_value(m)) AS m FROM c{r}
  LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS f FROM s{r} GROUP BY c) USING (c) GROUP BY c)""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)
"""


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_exact_top_k": op3_exact_top_k,
        "op4_token_counts": op4_token_counts,
        "op5_packing": op5_packing,
        "op6_sharding": op6_sharding,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_license_scan": op8_license_scan,
        "op9_line_dedup": op9_line_dedup,
        "op10_url_filter": op10_url_filter,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_centroid_clustering": op13_centroid_clustering,
        "pipeline": corpus_pipeline.run,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_decontamination": OP1_SQL,
        "op3_exact_top_k": OP3_SQL,
        "op7_jaccard_join": OP7_SQL,
        "op8_license_scan": licenses.oracle(),
        "op9_line_dedup": OP9_SQL,
        "op12_fill_in_middle": OP12_SQL,
        "op13_centroid_clustering": _op13_sql(),
    }
