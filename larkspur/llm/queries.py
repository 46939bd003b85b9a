"""The registered queries of the training-data operators and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, chat, clusters, decontaminate, divergence, gif, langid, license, mixing, mtree, neardup, toxicity, urlrules
from larkspur.llm.scratch import written

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.media_digest(gif.payload_media(_table(spark, sf_dir, "documents")))


def op2_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(_table(spark, sf_dir, "conversations"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.scan(_table(spark, sf_dir, "documents"), license.template_table(spark))
    return found.select("doc_id", "license_id", "matched", "n_template", "containment")


def op4_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "n_sentences", "worst_start", "worst_end")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urlrules.RULES, "verdict string, host string, path string")
    return urlrules.judge(_table(spark, sf_dir, "pages"), rules)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = mixing.quality_of(_table(spark, sf_dir, "labels"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("words"))
    docs = written(docs.join(quality, docs.doc_id == quality.q_id, "left").drop("q_id"), "mix-sizes")
    mixed = mixing.mix(docs, size_col="words", quality=F.col("quality_weight"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op8_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = mtree.build(mtree.quantised(_table(spark, sf_dir, "embeddings")))
    return mtree.top_k(forest, F.col("vec_id") % mtree.QUERY_EVERY == 0)


def op9_langid_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "lang_pred", "score")


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(clusters.quantised(_table(spark, sf_dir, "embeddings")))


def op13_skyband_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_gif_media, op2_snapshot_collapse, op3_license_scan, op4_circulant_minhash, op5_toxicity_mil, op6_url_rules, op7_source_mix, op8_mtree_topk, op9_langid_bayes, op10_bpe_tree, op11_positional_index, op12_simplex_clusters, op13_skyband_audit)
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_snapshot_collapse": _op2_sql(),
        "op3_license_scan": _op3_sql(),
        "op4_circulant_minhash": _op4_sql(),
        "op6_url_rules": _op6_sql(),
        "op7_source_mix": _op7_sql(),
        "op8_mtree_topk": _op8_sql(),
        "op11_positional_index": _op11_sql(),
        "op12_simplex_clusters": _op12_sql(),
        "op13_skyband_audit": _op13_sql(),
    }


def _op2_sql() -> str:
    return f"""
WITH steps AS (
  SELECT conv_id, turn, role, text,
         coalesce(length(role) || ':' || role, '-') || '|' || coalesce(length(text) || ':' || text, '-') || chr(1) AS step
  FROM conversations),
whole AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(step, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS body,
         string_agg('{chat.START}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{chat.END}' || chr(10), ''
                    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rendered
  FROM steps GROUP BY conv_id),
prefixes AS (
  SELECT DISTINCT string_agg(s.step, '' ORDER BY s.turn NULLS FIRST, s.role NULLS FIRST, s.text NULLS FIRST) OVER (
    PARTITION BY s.conv_id ORDER BY s.turn NULLS FIRST, s.role NULLS FIRST, s.text NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS body, s.conv_id FROM steps s),
inner_prefixes AS (
  SELECT DISTINCT p.body FROM prefixes p JOIN whole w ON p.conv_id IS NOT DISTINCT FROM w.conv_id WHERE p.body <> w.body)
SELECT min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_equal, any_value(rendered) AS rendered
FROM whole WHERE body NOT IN (SELECT body FROM inner_prefixes) GROUP BY body"""


def _op3_sql() -> str:
    rows = ",\n  ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in license.TEMPLATES)
    words = r"list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    shingled = "list_transform(range(0, greatest(len(w) - 4, 0)), lambda i: {'pos': i, 's': array_to_string(w[i + 1:i + 5], ' ')})"
    return f"""
WITH templates(license_id, text) AS (VALUES
  {rows}),
t AS (SELECT license_id, unnest({shingled}, recursive := true) FROM (SELECT license_id, {words} AS w FROM templates)),
sizes AS (SELECT license_id, count(*) AS n_all, count(DISTINCT s) AS n_template FROM t GROUP BY license_id),
shapes AS (SELECT *, CASE WHEN n_all <= 1 THEN 2 WHEN n_all <= 3 THEN 4 WHEN n_all <= 6 THEN 8 WHEN n_all <= 12 THEN 16 WHEN n_all <= 24 THEN 32 WHEN n_all <= 48 THEN 64 WHEN n_all <= 96 THEN 128 WHEN n_all <= 192 THEN 256 WHEN n_all <= 384 THEN 512 END AS w FROM sizes),
d AS (SELECT doc_id, unnest({shingled}, recursive := true) FROM (SELECT doc_id, {words} AS w FROM documents)),
hits AS (SELECT DISTINCT d.doc_id, d.pos, d.s, x.license_id, x.n_template, x.w, greatest(1, x.w // 4) AS stride
         FROM d JOIN (SELECT DISTINCT license_id, s FROM t) k ON d.s = k.s JOIN shapes x ON x.license_id = k.license_id),
windows AS (SELECT *, unnest(range(greatest(CAST(ceil((pos - w + 1) / stride) AS BIGINT), 0), pos // stride + 1)) * stride AS start FROM hits),
counted AS (SELECT doc_id, license_id, n_template, start, count(DISTINCT s) AS matched FROM windows GROUP BY ALL)
SELECT doc_id, license_id, max(matched) AS matched, n_template, max(matched) / n_template AS containment
FROM counted WHERE matched * 100 >= n_template * {license.CONTAINMENT_PERCENT} GROUP BY doc_id, license_id, n_template"""


def _op4_sql() -> str:
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_have >= {neardup.PERCENT} * (x.n + y.n - both_have)),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen),
label AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN label ON node = d.doc_id"""


def _op6_sql() -> str:
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urlrules.RULES)
    return f"""
WITH rules(v, h, p) AS (VALUES {rows}),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM (SELECT page_id, coalesce(r, '') AS r FROM rest)),
fits AS (
  SELECT page_id, host, path, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC NULLS LAST, length(p) DESC) AS place
  FROM parsed LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, '{urlrules.DEFAULT}') AS verdict FROM fits WHERE place = 1"""


def _op7_sql() -> str:
    a, b, c = mixing.WEIGHTS
    repeats = mixing.MAX_REPEATS
    return rf"""
WITH q AS (SELECT doc_id AS q_id, CASE WHEN max(quality) > 0 THEN 2.0 WHEN max(quality) = 0 THEN 0.5 END AS weight FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 1) / 4503599627370498.0) / coalesce(weight, 1.0) AS k
      FROM documents LEFT JOIN q ON q_id = doc_id),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CAST([{a}, {b}, {c}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight FROM d GROUP BY source),
r AS (SELECT *, {repeats} * source_size AS cap, {repeats} * source_size / weight AS room FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY room, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * coalesce((SELECT level FROM l WHERE level <= room ORDER BY room, level DESC LIMIT 1), 'inf'::DOUBLE)) AS target FROM l),
e AS (SELECT *, CAST(round(target) AS BIGINT) AS whole, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.source, d.size, source_size, target, epochs, whole - epochs * source_size AS budget,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target, CAST(size * epochs + greatest(0, least(size, budget - prior)) AS BIGINT) AS taken FROM p"""


def _op8_sql() -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({mtree.SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % {mtree.QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= {mtree.TOP}"""


def _op11_sql() -> str:
    words = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
    width = decontaminate.WIDTH
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {words} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), {width}) AS n, array_to_string(w[i + 1:i + {width}], ' ') AS x
            FROM (SELECT *, unnest(range(0, greatest(len(w) - {width}, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS MATERIALIZED (SELECT r, i, windows.n, item_id FROM (SELECT r, i, n, array_to_string(w[i + 1:i + n], ' ') AS x FROM places) p JOIN windows ON p.n = windows.n AND p.x = windows.x),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""


def _op12_sql() -> str:
    steps = []
    for i in range(clusters.ROUNDS + 1):
        steps.append(f"""
s{i} AS MATERIALIZED (
  SELECT r, vec_id, cluster, distance, v FROM (
    SELECT d.*, row_number() OVER (PARTITION BY r ORDER BY distance, cluster) AS place FROM (
      SELECT r, vec_id, v, k AS cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance FROM vectors, c{i}) d)
  WHERE place = 1)""")
        steps.append(f"""
m{i} AS (SELECT cluster, j, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM s{i}) GROUP BY cluster, j),
c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(x, c) AS c FROM c{i} LEFT JOIN (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM m{i} GROUP BY cluster) ON cluster = k)""")
    last = clusters.ROUNDS
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({clusters.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {clusters.WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS k, v AS c
  FROM (SELECT v, sha256('{clusters.SEED}:' || CAST(vec_id AS VARCHAR)) AS h FROM vectors ORDER BY h NULLS LAST, v LIMIT {clusters.K})),{",".join(steps[:-1])}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM s{last} JOIN c{last} ON cluster = k"""


def _op13_sql() -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x60\x7B-\x7F]+')"
    share = f"CASE WHEN v > 0 THEN CAST(1 + CAST({{n}} + {divergence.SMOOTH} AS HUGEINT) * {divergence.UNIT} // ({{total}} + {divergence.SMOOTH} * v) AS BIGINT) ELSE 0 END"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {words} AS w FROM documents),
o AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS whole FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
langs AS (SELECT d.lang, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total FROM (SELECT DISTINCT lang FROM d) d
          LEFT JOIN (SELECT lang, count(*) AS v, sum(whole) AS lang_total FROM kept GROUP BY lang) k ON k.lang = d.lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT x.lang, x.source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) x
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) t ON t.lang = x.lang AND t.source = x.source),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {share.format(n="coalesce(n, 0)", total="total")} AS p, {share.format(n="whole", total="lang_total")} AS q
  FROM g JOIN langs ON langs.lang = g.lang JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
every AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM every)
SELECT lang, source, part, item, value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= {divergence.TOP}"""
