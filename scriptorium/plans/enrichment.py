"""Enrichment, foreign segments, entity layers, headers, preflight and rules on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import enrich, foreign, header, language, layers, losses, notes, order, preflight, rules, spans
from .layout import _HOST, _PATH, _pages
from .registry import query, table
from .text import WORDS_SQL, heuristic_sql

_LINES = "SELECT conv_id, turn, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, unnest(string_split(text, chr(10))) AS line FROM conversations"
_SEGMENTS = ((10, 70, "lat"), (120, 200, "grc"))


def _turn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query(f"""WITH l AS ({_LINES}), j AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY conv_id, turn ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS a FROM l),
c AS (SELECT conv_id, turn, line_no, line, a AS base, unnest(list_sort(list_distinct(list_concat([a, CAST(a + length(line) AS INTEGER)], list_filter([10, 70, 120, 200], lambda x: x > a AND x < a + length(line)))))) AS start FROM j),
p AS (SELECT *, coalesce(lead(start) OVER (PARTITION BY conv_id, turn, line_no ORDER BY start), CASE WHEN length(line) = 0 THEN start END) AS stop FROM c)
SELECT conv_id, turn, CAST(line_no AS INTEGER) AS line_no, start, stop, CASE WHEN stop > start AND start >= 10 AND stop <= 70 THEN 'lat' WHEN stop > start AND start >= 120 AND stop <= 200 THEN 'grc' END AS lang,
  md5(substr(line, start - base + 1, stop - start)) AS digest FROM p WHERE stop IS NOT NULL""")
def container_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.array(*(F.struct(F.lit(a).alias("from"), F.lit(b).alias("to"), F.lit(lang).alias("lang")) for a, b, lang in _SEGMENTS))
    segments = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.inline(made))
    found = enrich.pieces(_turn_lines(spark, sf_dir), segments, ["conv_id", "turn"], "line_no", "line")
    return found.select("conv_id", "turn", "line_no", "start", "stop", "lang", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("""WITH b AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'fra' WHEN 'assistant' THEN 'lat' ELSE 'ita' END AS lang, CASE WHEN conv_id % 2 = 0 THEN 'fra' ELSE 'grc' END AS own,
  CASE turn % 4 WHEN 0 THEN 'Fig.' WHEN 1 THEN '  ' ELSE '  ' || text || ' ' END AS t, turn * 100 AS start FROM conversations)
SELECT conv_id, turn, CAST(start + CASE WHEN turn % 4 = 0 THEN 0 ELSE length(t) - length(ltrim(t, ' ' || chr(10) || chr(9))) END AS INTEGER) AS base, CASE WHEN lang IN ('fra', 'lat', 'grc') THEN lang ELSE own END AS model, md5(trim(t, ' ' || chr(10) || chr(9))) AS digest
FROM b WHERE turn % 4 > 1 AND trim(t, ' ' || chr(10) || chr(9)) <> ''""")
def tag_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    said = F.when(k == 0, F.lit("Fig.")).when(k == 1, F.lit("  ")).otherwise(F.concat(F.lit("  "), "text", F.lit(" ")))
    lang = F.when(F.col("role") == "user", "fra").when(F.col("role") == "assistant", "lat").otherwise("ita")
    made = table(spark, sf_dir, "conversations").select("conv_id", "turn", lang.alias("lang"), F.when(F.col("conv_id") % 2 == 0, "fra").otherwise("grc").alias("own"), (F.col("turn") * 100).alias("start"), said.alias("said"))
    found = enrich.requests(made, "own", "lang", "start", "said", ["fra", "lat", "grc"])
    return found.select("conv_id", "turn", "base", "model", F.md5(F.col("request").cast("binary")).alias("digest"))


@query("""WITH w AS (SELECT item_id, generate_subscripts(string_split(text, ' '), 1) AS pos, unnest(string_split(text, ' ')) AS form FROM benchmark)
SELECT item_id, CAST(pos - 1 AS INTEGER) AS pos, form, CASE WHEN pos % 2 = 0 THEN 'NOM' ELSE 'VER' END AS pos_tag, CASE WHEN pos % 3 = 0 THEN form ELSE 'x' || form END AS treated, length(form) = 1 AND NOT regexp_matches(form, '[\\p{L}\\p{N}]') AS is_sign FROM w""")
def service_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a service that spells the tag's key both ways, read back."""
    words = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", " ").alias("w"))
    made = F.transform("w", lambda f, i: F.struct(f.alias("form"), F.when(i % 2 == 1, "NOM").alias("POS"), F.when(i % 2 == 0, "VER").alias("tag"), F.when((i + 1) % 3 != 0, F.concat(F.lit("x"), f)).alias("treated")))
    answer = F.replace(F.to_json(made), F.lit('"tag":'), F.lit('"pos":'))
    found = words.select("item_id", F.posexplode(enrich.answered(answer)).alias("pos", "t"))
    return found.select("item_id", "pos", "t.form", F.col("t.pos").alias("pos_tag"), "t.treated", "t.is_sign")


_BLOCKS = """b AS (SELECT user_id, CASE event_type WHEN 'error' THEN 'refused' WHEN 'signup' THEN 'unsent' ELSE 'ok' END AS status, event_id % 30 AS tokens, CASE WHEN event_id % 11 = 0 THEN event_id % 9 ELSE 0 END AS off FROM events),
f AS (SELECT user_id, coalesce(bool_or(status = 'ok' AND tokens > 0 AND off / tokens::DOUBLE > 0.2), false) AS unanchored, bool_or(status = 'refused') AS refused, bool_or(status = 'unsent') AS unsent, CAST(coalesce(sum(tokens) FILTER (status = 'ok'), 0) AS BIGINT) AS tokens FROM b GROUP BY 1),
o AS (SELECT user_id, unanchored, refused AND NOT unanchored AS refused, unsent AND NOT unanchored AS unsent, CASE WHEN unanchored THEN 0 ELSE tokens END AS tokens FROM f),
s AS (SELECT *, CASE WHEN tokens > 0 THEN 'enriched' WHEN unanchored OR refused OR unsent THEN 'failed' ELSE 'skipped' END AS state FROM o)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", "refused").when(F.col("event_type") == "signup", "unsent").otherwise("ok")
    blocks = e.select("user_id", status.alias("status"), (F.col("event_id") % 30).alias("tokens"), F.when(F.col("event_id") % 11 == 0, F.col("event_id") % 9).otherwise(0).alias("off"))
    return enrich.outcomes(blocks, ["user_id"], "status", "tokens", "off")


@query(f"WITH {_BLOCKS} SELECT * FROM s")
def enrichment_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers are the users, blocks their events."""
    return _outcomes(spark, sf_dir)


@query(f"""WITH {_BLOCKS} SELECT count(*) AS containers_found, count(*) FILTER (state = 'enriched') AS containers_enriched, count(*) FILTER (state = 'skipped') AS containers_skipped,
count(*) FILTER (unanchored OR refused OR unsent) AS containers_failed, CAST(0 AS BIGINT) AS containers_broken, count(*) FILTER (refused) AS containers_refused, count(*) FILTER (unanchored) AS containers_unanchored, count(*) FILTER (unsent) AS containers_unsent,
CAST(sum(tokens) AS BIGINT) AS tokens_total, CAST(0 AS BIGINT) AS sentences_total, false AS server_unavailable FROM s""")
def enrichment_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.statistics(_outcomes(spark, sf_dir))


@query(f"""WITH l AS ({_LINES}), j AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY conv_id, turn ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM l),
w AS (SELECT conv_id, turn, k AS word, k * 30 AS start, k * 30 + 30 AS stop FROM conversations, (SELECT unnest(range(0, 2000)) AS k) WHERE k * 30 < length(replace(text, chr(10), ''))),
m AS (SELECT w.conv_id, w.turn, word, line_no, greatest(start, a) AS x, least(stop, a + length(line)) AS y, a FROM w JOIN j ON w.conv_id = j.conv_id AND w.turn = j.turn AND start < a + length(line) AND stop > a),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, word ORDER BY a) - 1 AS k, count(*) OVER (PARTITION BY conv_id, turn, word) AS n FROM m)
SELECT conv_id, turn, CAST(word AS INTEGER) AS word, CAST(line_no AS INTEGER) AS line_no, CAST(k AS INTEGER) AS fragment, CASE WHEN n = 1 THEN NULL WHEN k = 0 THEN 'I' WHEN k = n - 1 THEN 'F' ELSE 'M' END AS part, CAST(x AS INTEGER) AS a, CAST(y AS INTEGER) AS b FROM r""")
def word_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of 30 letters as words over the lines of a turn."""
    from ..operators.offsets import joined

    lines = joined(_turn_lines(spark, sf_dir), ["conv_id", "turn"], "line_no", "line", "")
    size = F.length(F.replace("text", F.lit("\n"), F.lit("")))
    words = table(spark, sf_dir, "conversations").select("conv_id", "turn", size.alias("n")).filter("n > 0").select("conv_id", "turn", F.explode(F.expr("sequence(0, int((n - 1) div 30))")).alias("word"))
    words = words.withColumn("start", F.col("word") * 30).withColumn("stop", F.col("start") + 30)
    return enrich.word_parts(words, lines, ["conv_id", "turn"], "word", "line_no")


@query(f"""WITH {heuristic_sql(_LINES, 'conv_id, turn, line_no', 'line')},
s AS (SELECT *, {WORDS_SQL.format('txt')} AS words, CASE WHEN conv_id % 3 = 0 THEN 'fr' ELSE 'en' END AS own FROM best)
SELECT conv_id, turn, CAST(line_no AS INTEGER) AS line_no, lang, CAST(words AS INTEGER) AS words FROM s WHERE lang IS NOT NULL AND lang <> own AND words >= 3 AND score > 0""")
def foreign_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a turn in another language than the turn's."""
    lines = _turn_lines(spark, sf_dir).select("*", language.heuristic(F.col("line")).alias("h"), text.word_count(F.col("line")).alias("words"), F.when(F.col("conv_id") % 3 == 0, "fr").otherwise("en").alias("own"))
    each = lines.select("conv_id", "turn", "line_no", "own", "words", F.col("h.lang").alias("lang"), F.col("h.score").alias("score"))
    return foreign.accepted(each, "own", "lang", "words", "lang", "score", "score").select("conv_id", "turn", "line_no", "lang", "words")


@query(f"""WITH {heuristic_sql('SELECT conv_id, turn, text FROM conversations', 'conv_id, turn', 'text')},
c AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN 'es' ELSE lang END AS detected, (turn % 10) / 10.0::DOUBLE AS conf, lang AS hl, score, {WORDS_SQL.format('txt')} AS words FROM best),
v AS (SELECT conv_id, detected, sum(words) AS n FROM c WHERE detected IS NOT NULL GROUP BY 1, 2),
t AS (SELECT conv_id, sum(words) AS total FROM c GROUP BY 1),
b AS (SELECT conv_id, arg_max(detected, (n, detected)) AS prior, max(n) AS n FROM v GROUP BY 1),
q AS (SELECT c.*, CASE WHEN b.n / t.total::DOUBLE >= 0.35 THEN b.prior END AS prior, CASE WHEN detected = hl THEN score ELSE 0 END AS ds FROM c JOIN t USING (conv_id) LEFT JOIN b USING (conv_id)),
x AS (SELECT *, coalesce(prior, 'fr') AS p, CASE WHEN prior IS NULL THEN 2 ELSE 1 END AS enough FROM q)
SELECT conv_id, turn, prior, CASE WHEN detected IS NULL THEN 'fr' WHEN detected = p AND p = 'fr' THEN detected WHEN detected = p THEN CASE WHEN hl = 'fr' AND score >= 2 THEN 'fr' ELSE detected END
  WHEN hl = p AND score >= enough THEN p WHEN prior IS NOT NULL AND ds < 1 AND conf < 0.9 THEN p WHEN hl IS NOT NULL AND score >= enough THEN hl WHEN conf >= 0.35 THEN detected ELSE p END AS decided FROM x""")
def two_pass_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", language.heuristic(F.col("text")).alias("heuristic"), text.word_count(F.col("text")).alias("words"))
    c = c.withColumn("detected", F.when(F.col("turn") % 5 == 4, "es").otherwise(F.col("heuristic.lang"))).withColumn("confidence", (F.col("turn") % 10) / 10.0)
    return foreign.two_pass(c, "conv_id", "fr").select("conv_id", "turn", "prior", "decided")


@query("""WITH w AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS word FROM documents WHERE lang IS NOT NULL) WHERE word <> '' GROUP BY 1, 2),
g AS (SELECT lang, n, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3))) AS gram FROM w),
c AS (SELECT lang, gram, sum(n) AS n FROM g GROUP BY 1, 2),
r AS (SELECT *, n / sum(n) OVER (PARTITION BY lang) AS share, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS k FROM c)
SELECT lang, gram, round(sqrt(share), 9) AS weight FROM r WHERE k <= 400""")
def language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("lang is not null")
    return foreign.profiles(docs, "text", "lang").withColumn("weight", F.round("weight", 9))


@query()
def statistical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each turn by the documents' profiles."""
    docs = table(spark, sf_dir, "documents").filter("lang is not null")
    return foreign.detected(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], "text", foreign.profiles(docs, "text", "lang"))


@query("""WITH c AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'und' WHEN 1 THEN 'lat' ELSE 'fra' END AS lang, turn % 3 > 0 AS tagged FROM conversations),
l AS (SELECT conv_id, turn, generate_subscripts(string_split(text, chr(10)), 1) AS k, unnest(string_split(text, chr(10))) AS line FROM conversations),
r AS (SELECT *, CASE WHEN k % 2 = 1 THEN 'x' || line ELSE '  ' END AS reading FROM l),
o AS (SELECT conv_id, turn, string_agg(line, ' ' ORDER BY k) AS t FROM r WHERE trim(line) <> '' GROUP BY 1, 2),
g AS (SELECT conv_id, turn, string_agg(reading, ' ' ORDER BY k) AS t FROM r WHERE trim(reading) <> '' GROUP BY 1, 2)
SELECT conv_id, turn, lang, source, model, md5(t) AS digest FROM (
  SELECT conv_id, turn, lang, 'orig' AS source, CASE WHEN lang = 'fra' THEN 'tagger' ELSE 'general' END AS model, t FROM c JOIN o USING (conv_id, turn) WHERE tagged AND lang <> 'und'
  UNION ALL SELECT conv_id, turn, lang, 'reg', 'general', t FROM c JOIN g USING (conv_id, turn) WHERE tagged AND lang = 'fra'
  UNION ALL SELECT conv_id, turn, lang, 'raw', 'general', trim(t) FROM c JOIN o USING (conv_id, turn) WHERE NOT tagged AND lang <> 'und') WHERE length(trim(t)) >= 10""")
def entity_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    k = F.col("conv_id") % 4
    containers = turns.select("conv_id", "turn", F.when(k == 0, "und").when(k == 1, "lat").otherwise("fra").alias("lang"), (F.col("turn") % 3 > 0).alias("has_tokens"))
    lines = _turn_lines(spark, sf_dir).withColumn("reading", F.when(F.col("line_no") % 2 == 0, F.concat(F.lit("x"), "line")).otherwise("  "))
    found = layers.dispatched(layers.blocks(containers, lines, ["conv_id", "turn"], "line_no", "line", "reading"), {("orig", "fra"): "tagger"}, "general")
    return found.select("conv_id", "turn", "lang", "source", "model", F.md5(F.col("text").cast("binary")).alias("digest"))


_WORDS = "SELECT item_id, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos, unnest(string_split(text, ' ')) AS word FROM benchmark"


@query(f"""WITH w AS ({_WORDS}), o AS (SELECT *, coalesce(sum(length(word) + 1) OVER (PARTITION BY item_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM w),
m AS (SELECT item_id, unnest([1, 1, 2, 2]) AS mention, unnest([0, 3, 5, 900]) AS pos FROM benchmark)
SELECT m.item_id, mention, CAST(min(a) AS INTEGER) AS start, CAST(max(a + length(word)) AS INTEGER) AS stop FROM m JOIN o ON m.item_id = o.item_id AND m.pos = o.pos GROUP BY 1, 2""")
def backfilled_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    made = F.array(*(F.struct(F.lit(m).alias("mention"), F.lit(p).alias("pos")) for m, p in ((1, 0), (1, 3), (2, 5), (2, 900))))
    mentions = items.select("item_id", F.lit(0).alias("line"), F.inline(made))
    readings = spans.word_offsets(items, ["item_id"], "text").withColumn("line", F.lit(0))
    found = layers.backfilled(mentions, readings, ["item_id"], "line")
    return found.select("item_id", "mention", F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"))


@query("""WITH e AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'M.DC.LIX' WHEN 1 THEN 'vers 1650' WHEN 2 THEN 'jadis' ELSE 'en 1700' END AS said, CASE WHEN c_nationkey % 2 = 0 THEN 'high' ELSE 'medium' END AS cert, c_custkey % 5 = 0 AS place FROM customer)
SELECT c_custkey, CASE WHEN place THEN NULL ELSE CASE c_custkey % 4 WHEN 0 THEN '1659' WHEN 1 THEN '1650' WHEN 3 THEN '1700' END END AS when_, CASE WHEN NOT place AND c_custkey % 4 = 1 THEN 'low' ELSE cert END AS cert FROM e""")
def entity_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    said = F.when(k == 0, "M.DC.LIX").when(k == 1, "vers 1650").when(k == 2, "jadis").otherwise("en 1700")
    kind = F.when(F.col("c_custkey") % 5 == 0, "place").otherwise("date")
    made = table(spark, sf_dir, "customer").select("c_custkey", said.alias("said"), kind.alias("kind"), F.when(F.col("c_nationkey") % 2 == 0, "high").otherwise("medium").alias("cert"))
    return layers.dated(made, "kind", "said", "cert").select("c_custkey", F.col("when").alias("when_"), "cert")


@query("SELECT o_orderpriority, count(*) AS entities FROM (SELECT DISTINCT o_orderpriority, o_custkey FROM orders) GROUP BY 1")
def entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.summary(table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey").distinct(), "o_orderpriority")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '[unknown]' WHEN c_custkey % 3 = 1 THEN c_name ELSE c_mktsegment END AS title,
  CASE c_custkey % 4 WHEN 0 THEN 'fra,lat' WHEN 1 THEN 'und' WHEN 2 THEN '' ELSE 'grc' END AS languages, CASE WHEN c_nationkey % 2 = 0 THEN (1600 + c_nationkey)::VARCHAR END AS when_, CASE WHEN c_nationkey % 2 = 1 THEN '159' || '0' END AS not_before,
  CASE WHEN c_nationkey % 3 = 0 THEN 2 ELSE 0 END AS idnos FROM customer""")
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k, n = table(spark, sf_dir, "customer"), F.col("c_custkey"), F.col("c_nationkey")
    books = c.select(
        "c_custkey",
        F.when(k % 3 == 1, F.col("c_name")).when(k % 3 == 2, F.lit("short")).alias("title"),
        F.when(k % 3 == 2, F.col("c_mktsegment")).otherwise(F.lit(" ")).alias("long"),
        F.when(k % 4 == 0, "français|latin|fra").when(k % 4 == 1, "basque").when(k % 4 == 3, "grec").alias("languages"),
        F.when(n % 2 == 0, (n + 1600).cast("string")).otherwise("159").alias("date"),
        F.when(n % 3 == 0, " a |b|").alias("manifests"),
        F.lit("").alias("place"),
    )
    found = header.fields(books, "title", "long", "languages", "date", "manifests", "place")
    return found.select("c_custkey", F.col("h_title").alias("title"), F.array_join("h_languages", ",").alias("languages"), F.col("h_date.when").alias("when_"), F.col("h_date.not_before").alias("not_before"), F.size("h_idnos").alias("idnos"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'PERS' || c_custkey WHEN 1 THEN 'pers_cb' || c_custkey WHEN 2 THEN 'pers_ark-' ELSE 'pers_ark--12148-x-y' END AS person_id,
  CASE c_custkey % 3 WHEN 0 THEN 'https://gallica.bnf.fr/iiif/ark:/12148/b' || c_custkey WHEN 1 THEN 'https://other.example' END AS base FROM customer""")
def header_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person ids and image bases, some of them from addresses."""
    key = F.col("c_custkey").cast("string")
    k, m = F.col("c_custkey") % 4, F.col("c_custkey") % 3
    code = F.when(k == 0, F.concat(F.lit(" PERS"), key)).when(k == 1, F.concat(F.lit("ark:/12148/cb"), key, F.lit("/"))).when(k == 2, "ark:").otherwise("ark:/12148/x:y")
    manifest = F.when(m == 0, F.concat(F.lit("https://gallica.bnf.fr/iiif/ark:/12148/b"), key, F.lit("/manifest.json"))).otherwise("https://api.example.org/x/manifest")
    return table(spark, sf_dir, "customer").select("c_custkey", header.safe_person_id(code).alias("person_id"), header.image_config(manifest, F.when(m == 1, F.lit("https://other.example"))).alias("base"))


@query("""WITH v AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS words, count(*) FILTER (event_type = 'error') AS tokens FROM events GROUP BY 1)
SELECT user_id, unit, quantity, quantity || ' ' || unit AS text FROM (SELECT user_id, unnest(['words', 'tokens']) AS unit, unnest([words, tokens]) AS quantity FROM v) WHERE quantity > 0""")
def extent_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda k: F.count(F.when(F.col("event_type") == k, 1))
    v = table(spark, sf_dir, "events").groupBy("user_id").agg(count("click").alias("words"), count("error").alias("tokens"))
    return header.extent(v, ["user_id"], "words", "tokens")


@query("SELECT user_id, event_type, words, CAST(row_number() OVER (PARTITION BY user_id ORDER BY words DESC, event_type) AS INTEGER) AS place FROM (SELECT user_id, event_type, count(*) AS words FROM events GROUP BY 1, 2)")
def languages_by_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header.by_volume(table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("words")), ["user_id"], "event_type", "words")


@query("""WITH c AS (SELECT c_custkey, unnest(['author', 'author', 'printer']) AS role, unnest([0, 1, 0]) AS place, unnest([c_nationkey::VARCHAR, 'ark:/1/x' || c_custkey, '99']) AS code FROM customer)
SELECT c_custkey, role, CAST(place AS INTEGER) AS place, CASE WHEN starts_with(code, 'ark:') THEN 'pers_x' || c_custkey ELSE code END AS person_id, coalesce(n_name, code) AS name FROM c LEFT JOIN nation ON code = n_nationkey::VARCHAR""")
def contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.col("c_nationkey").cast("string"), F.lit("| ark:/1/x"), F.col("c_custkey").cast("string")).alias("authors"), F.lit("99|").alias("printers"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    return header.contributors(rows, "c_custkey", {"authors": "author", "printers": "printer"}, nations, "code", "n_name").select("c_custkey", "role", "place", "person_id", "name")


@query(f"""WITH p AS (SELECT {_HOST} AS host, coalesce(try_cast(nullif(regexp_extract({_PATH}, '(\\d+)', 1), '') AS INTEGER), 999999) AS num FROM pages),
v AS (SELECT DISTINCT host FROM p UNION SELECT n_name FROM nation)
SELECT host AS subject, 'no catalogue row' AS what, CAST(1 AS BIGINT) AS n FROM v WHERE host NOT IN (SELECT host FROM p WHERE num % 2 = 0)
UNION ALL SELECT host, 'pages without a number', count(*) FROM p WHERE num = 999999 GROUP BY 1
UNION ALL SELECT host, 'numbers claimed twice', count(*) FROM (SELECT host, num FROM p WHERE num <> 999999 GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1
UNION ALL SELECT host, 'no pages', 1 FROM v WHERE host NOT IN (SELECT host FROM p)""")
def preflight_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes are the hosts of the pages, and the nations, which have none; hosts with an even page number are in the catalogue."""
    p = _pages(spark, sf_dir)
    volumes = p.select("host").union(table(spark, sf_dir, "nation").select(F.col("n_name"))).distinct()
    from ..functions.labels import page_number

    known = p.filter(page_number(F.col("stem")) % 2 == 0).select(F.col("host").alias("bdd"))
    return preflight.attention(volumes, p, known, "host", "stem", "bdd")


@query("""WITH e AS (SELECT l_orderkey AS doc, l_linenumber AS ord, l_partkey % 7 AS k, l_suppkey % 3 AS m, l_partkey, (l_linenumber - 1) // 2 AS parent FROM lineitem),
t AS (SELECT *, CASE k WHEN 0 THEN 'choice' WHEN 1 THEN 'orig' WHEN 2 THEN 'reg' WHEN 3 THEN 'figure' WHEN 4 THEN 'zone' WHEN 5 THEN 'blink' ELSE 'idno' END AS tag FROM e),
c AS (SELECT doc, parent AS ord, count(*) FILTER (tag = 'orig') AS o, count(*) FILTER (tag = 'reg') AS r FROM t GROUP BY 1, 2)
SELECT 'one-orig-one-reg' AS rule, doc, ord FROM t LEFT JOIN c USING (doc, ord) WHERE tag = 'choice' AND (coalesce(o, 0) <> 1 OR coalesce(r, 0) <> 1)
UNION ALL SELECT 'no-hyphen-left', doc, ord FROM t WHERE tag = 'reg' AND m = 1
UNION ALL SELECT 'figure-is-placed', doc, ord FROM t WHERE tag = 'figure' AND m <> 0
UNION ALL SELECT 'graphic-has-id', doc, ord FROM t WHERE tag = 'zone' AND m = 1
UNION ALL SELECT 'automatic-is-graded', doc, ord FROM t WHERE m = 2
UNION ALL SELECT 'one-manifest-each', doc, ord FROM t WHERE tag = 'idno' AND m = 0
UNION ALL SELECT 'known-elements', doc, ord FROM t WHERE tag = 'blink'""")
def corpus_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as elements; a doc's and a line's numbers repeat in the table's copies."""
    e = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("ord"), F.expr("int((l_linenumber - 1) div 2)").alias("parent_ord"), (F.col("l_partkey") % 7).alias("k"), (F.col("l_suppkey") % 3).alias("m"))
    names = F.array(*map(F.lit, ("choice", "orig", "reg", "figure", "zone", "blink", "idno")))
    attrs = (
        F.when((F.col("k") == 3) & (F.col("m") == 0), F.create_map(F.lit("corresp"), F.lit("#z")))
        .when(F.col("m") == 2, F.create_map(F.lit("resp"), F.lit(rules.AGENT)))
        .when((F.col("k") == 4) & (F.col("m") == 1), F.create_map(F.lit("type"), F.lit("GraphicZone")))
        .when((F.col("k") == 4) & (F.col("m") == 0), F.create_map(F.lit("type"), F.lit("GraphicZone"), F.lit("id"), F.lit("z")))
        .when((F.col("k") == 6) & (F.col("m") == 0), F.create_map(F.lit("type"), F.lit("iiif")))
        .otherwise(F.expr("map()"))
    )
    made = e.select("doc", "ord", "parent_ord", F.get(names, F.col("k").cast("int")).alias("tag"), attrs.alias("attrs"), F.when(F.col("k") == 2, F.when(F.col("m") == 1, "mot¬").otherwise("mot")).when(F.col("k") == 6, "a|b").otherwise("").alias("text"))
    return rules.broken(made)


@query("""WITH l AS (SELECT *, l_extendedprice > 30000 OR l_discount < 0.02 AS odd FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, odd ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM l)
SELECT l_orderkey, l_linenumber, odd FROM r WHERE k <= 2 OR l_returnflag = 'R'""")
def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").withColumn("odd", (F.col("l_extendedprice") > 30000) | (F.col("l_discount") < 0.02))  # noqa: E741
    kept = order.thinned(l, ["l_orderkey"], "odd", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], F.col("l_returnflag") == "R")
    return kept.select("l_orderkey", "l_linenumber", "odd")


@query("""SELECT user_id, arg_min(event_id, (value, event_id)) FILTER (event_type <> 'error') AS nested, any_value(CASE WHEN user_id % 2 = 0 THEN 'own' END) AS own,
  coalesce(any_value(CASE WHEN user_id % 2 = 0 THEN 'own' END), (arg_min(event_id, (value, event_id)) FILTER (event_type <> 'error'))::VARCHAR) AS first_text FROM events GROUP BY 1""")
def zone_first_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    zones = e.select("user_id").distinct().withColumn("own", F.when(F.col("user_id") % 2 == 0, "own"))
    lines = e.filter("event_type <> 'error'").select("user_id", F.struct("value", "event_id").alias("top"), F.col("event_id").cast("string").alias("text"))
    found = notes.first_text(zones, lines, ["user_id"], "own", "top", "text")
    return found.select("user_id", F.col("nested").cast("long").alias("nested"), "own", "first_text")


@query("SELECT event_type AS code, user_id, event_id FROM events WHERE user_id = 7 AND starts_with(event_type, 'c') UNION ALL SELECT event_type, user_id, event_id FROM events WHERE user_id = 8 AND event_type = 'error'")
def incident_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("code"), "user_id", "event_id", F.when(F.col("event_type") == "error", "refused").otherwise("other").alias("why"), F.lit(3).alias("block"))
    own = {"document_column": "user_id"}
    some = losses.select_incidents(e, document=7, code="c", block=3, **own)
    return some.unionByName(losses.select_incidents(e, document=8, why="refused", **own)).unionByName(losses.select_incidents(e, block=2, **own)).select("code", "user_id", "event_id")
