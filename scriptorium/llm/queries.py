"""The op queries with production parameters, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..deploy import ship
from . import language_id, length_histogram, line_crf, media, minhash, mixing, packing, sharding, suffix_dedup
from .base import small_batches, staged, table
from .exact_dedup import DigestIndex, exact_dedup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        small_batches(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


SHARD_BYTES = 1 << 20


@query
def op1_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARD_BYTES).drop("_row")


ORACLE_SQL["op1_extendible_shards"] = f"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
l AS (SELECT depth, h >> (60 - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS bytes, count(*) AS docs
      FROM d, (SELECT unnest(range(0, 41))::INTEGER AS depth) GROUP BY 1, 2),
f AS (SELECT l.* FROM l LEFT JOIN l AS up ON up.depth = l.depth - 1 AND up.prefix = l.prefix >> 1
      WHERE l.bytes <= {SHARD_BYTES} AND (l.depth = 0 OR up.bytes > {SHARD_BYTES}))
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(bin(prefix + (1::BIGINT << 60)), depth) END AS shard, depth,
       bytes AS shard_bytes, docs AS shard_docs, false AS oversize
FROM d JOIN f ON d.h >> (60 - f.depth) = f.prefix
"""


#: The mixture that op2 and the pipeline rake to.
SOURCES = {"src0": 0.12} | {f"src{k}": 0.046 for k in range(1, 20)}
LANGUAGES = {"en": 0.5, "fr": 0.18, "de": 0.18, "es": 0.14}
TOPIC_SHARES = {k: 1 / mixing.TOPICS for k in range(mixing.TOPICS)}
KEEP = 0.6


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.measured(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")).drop("text")
    found = mixing.mixed(staged(docs, "measured"), (SOURCES, LANGUAGES, TOPIC_SHARES), KEEP)
    return found.select("doc_id", F.col("_tokens").alias("tokens"), F.col("_topic").alias("topic"), F.round("_probability", 6).alias("probability"), F.col("_sampled").alias("sampled"))


ORACLE_SQL["op2_mixing"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, source, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws FROM documents),
m AS (
  SELECT doc_id, CASE WHEN regexp_matches(source, '^src(\d|1\d)$') THEN source ELSE '~' END AS s,
         CASE WHEN lang IN ('en', 'fr', 'de', 'es') THEN lang ELSE '~' END AS l, CAST(len(ws) AS BIGINT) AS tokens,
         list_transform(range(0, 8), lambda k: len(list_filter(ws, lambda w: length(w) >= 5 AND (unicode(w) + unicode(right(w, 1))) % 8 = k))) AS c
  FROM words),
t AS (SELECT doc_id, s, l, tokens, CAST(list_position(c, list_max(c)) - 1 AS INTEGER) AS t FROM m),
cells AS (SELECT s, l, t, CAST(sum(tokens) AS DOUBLE) AS tok FROM t GROUP BY ALL),
share_s AS (SELECT s, sum(tok) / sum(sum(tok)) OVER () AS own, CASE s WHEN '~' THEN 1 - 0.12 - 19 * 0.046 WHEN 'src0' THEN 0.12 ELSE 0.046 END::DOUBLE AS g FROM cells WHERE tok > 0 GROUP BY 1),
share_l AS (SELECT l, sum(tok) / sum(sum(tok)) OVER () AS own, CASE l WHEN '~' THEN 0 WHEN 'en' THEN 0.5 WHEN 'fr' THEN 0.18 WHEN 'de' THEN 0.18 ELSE 0.14 END::DOUBLE AS g FROM cells WHERE tok > 0 GROUP BY 1),
wide_s AS (SELECT s, CASE WHEN coalesce(max(own) FILTER (s = '~') OVER (), 0) <= 1 - 0.12 - 19 * 0.046 THEN g WHEN s = '~' THEN own
             ELSE g * (1 - max(own) FILTER (s = '~') OVER ()) / sum(g) FILTER (s <> '~') OVER () END AS g FROM share_s),
wide_l AS (SELECT l, CASE WHEN coalesce(max(own) FILTER (l = '~') OVER (), 0) <= 0 THEN g WHEN l = '~' THEN own
             ELSE g * (1 - max(own) FILTER (l = '~') OVER ()) / sum(g) FILTER (l <> '~') OVER () END AS g FROM share_l),
goal_s AS (SELECT s, g / sum(g) OVER () AS g FROM wide_s),
goal_l AS (SELECT l, g / sum(g) OVER () AS g FROM wide_l),
goal_t AS (SELECT t, 1.0::DOUBLE / count(*) OVER () AS g FROM (SELECT DISTINCT t FROM cells WHERE tok > 0)),
fit AS (
  SELECT 0 AS i, s, l, t, tok, tok / sum(tok) OVER () AS w FROM cells
  UNION ALL
  SELECT i + 1, s, l, t, tok, w * (SELECT g FROM goal_t WHERE goal_t.t = c.t) / sum(w) OVER (PARTITION BY t) FROM (
    SELECT i, s, l, t, tok, w * (SELECT g FROM goal_l WHERE goal_l.l = b.l) / sum(w) OVER (PARTITION BY l) AS w FROM (
      SELECT i, s, l, t, tok, w * (SELECT g FROM goal_s WHERE goal_s.s = a.s) / sum(w) OVER (PARTITION BY s) AS w
      FROM fit a WHERE i < {mixing.SWEEPS}) b) c),
r AS (SELECT s, l, t, tok, w, w / tok AS ratio FROM fit WHERE i = {mixing.SWEEPS} AND tok > 0),
z AS (SELECT *, ({KEEP} * sum(tok) OVER () - (sum(tok) OVER o - tok)) / (sum(w) OVER () - (sum(w) OVER o - w)) AS scale FROM r
      WINDOW o AS (ORDER BY ratio DESC, s, l, t ROWS UNBOUNDED PRECEDING)),
c1 AS (SELECT arg_max(scale, ratio) AS scale FROM z WHERE scale * ratio <= 1),
p AS (SELECT s, l, t, least(1, greatest(0, c1.scale * ratio)) AS p FROM r, c1)
SELECT doc_id, tokens, t AS topic, round(coalesce(p, 0), 6) AS probability,
       ('0x' || substr(md5(doc_id || ':mix'), 1, 13))::BIGINT / (1::BIGINT << 52)::DOUBLE < coalesce(p, 0) AS sampled
FROM t LEFT JOIN p USING (s, l, t)
"""


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark)
    found = exact_dedup(table(spark, sf_dir, "documents"), index).drop("_row")
    index.close(delete=True)  # what the result needs of it is staged
    return found


ORACLE_SQL["op3_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, s AS text_sha256
FROM d WINDOW w AS (PARTITION BY s ORDER BY length(t) DESC, doc_id)
"""


@query
def op4_avi_mjpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_back(media.stored(table(spark, sf_dir, "documents")))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_dedup_documents(table(spark, sf_dir, "documents"), size=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL["op6_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh
  FROM w),
sets AS (SELECT min(doc_id) AS rep, list_sort(sh) AS sh FROM s WHERE len(sh) > 0 GROUP BY list_sort(sh)),
e AS (SELECT rep, len(sh) AS n, unnest(sh) AS h FROM sets),
p AS (SELECT a.rep AS x, b.rep AS y, count(*) AS common, any_value(a.n + b.n) AS total
      FROM e a JOIN e b ON a.h = b.h AND a.rep < b.rep GROUP BY 1, 2),
l AS (SELECT x, y FROM p WHERE 100 * common >= 80 * (total - common)),
g AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT rep AS node, rep AS reached FROM sets UNION SELECT r.node, g.b FROM r JOIN g ON r.reached = g.a),
c AS (SELECT node AS rep, min(reached) AS component FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id,
       s.doc_id = coalesce(c.component, s.doc_id) AS kept
FROM s LEFT JOIN sets ON len(s.sh) > 0 AND list_sort(s.sh) = sets.sh LEFT JOIN c ON c.rep = sets.rep
"""


@query
def op7_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.scored(docs, line_crf.trained_on(docs, table(spark, sf_dir, "labels")))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(language_id.crc_of(), F.lit(4)) == 2, F.lit(False)).alias("held_out")
    return language_id.identify(docs, language_id.trained_on(docs), "doc_id", held_out)


@query
def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.with_suffix_sums(length_histogram.histogram(table(spark, sf_dir, "documents")))
