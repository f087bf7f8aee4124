"""Text, language and token queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import kernels, text
from ..operators import language, order, sentences, spans
from .registry import query, table


def _score(r: language.Rules, low: str) -> str:
    words = ", ".join(f"'{w}'" for w in r.words)
    weight = 3.0 if len(r.letters) > 1 else 0.1
    return (
        f"len(regexp_extract_all({low}, '[{r.letters}]')) * {weight}::DOUBLE + len(list_filter([{words}], lambda w: list_contains(regexp_split_to_array({low}, '[^\\p{{L}}]+'), w)))"
        f" + len(regexp_extract_all({low}, '{'|'.join(r.endings)}')) * 1.5::DOUBLE"
    )


def heuristic_sql(source: str, keep: str, column: str) -> str:
    """CTEs up to `best`: keep, lang, score of each row of source."""
    scores = ", ".join(f"{_score(r, 'low')} AS s{k}" for k, r in enumerate(language.RULES))
    best = "greatest(" + ", ".join(f"s{k}" for k in range(len(language.RULES))) + ")"
    names = " ".join(f"WHEN s{k} = {best} THEN '{r.lang}'" for k, r in enumerate(language.RULES))
    return (
        f"src AS ({source}), low AS (SELECT {keep}, {column} AS txt, lower({column}) AS low FROM src), scored AS (SELECT {keep}, txt, {scores} FROM low), "
        f"best AS (SELECT {keep}, txt, CASE WHEN {best} < {language.LEAST} THEN NULL {names} END AS lang, round({best}, 1) AS score FROM scored)"
    )


WORDS_SQL = "len(list_filter(regexp_split_to_array({0}, '[ \\t-\\r]+'), lambda w: w <> ''))"
LINES = "SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents"


@query(f"WITH {heuristic_sql('SELECT doc_id, text FROM documents', 'doc_id', 'text')} SELECT doc_id, lang, score FROM best")
def lang_heuristic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", language.heuristic(F.col("text")).alias("h"))
    return found.select("doc_id", "h.lang", "h.score")


@query(f"""WITH {heuristic_sql(LINES, 'doc_id, line_no', 'line')},
v AS (SELECT coalesce(lang, 'und') AS lang, CAST(sum({WORDS_SQL.format('txt')}) AS BIGINT) AS words FROM best GROUP BY 1)
SELECT lang, words, greatest(1, CAST(round_even(100.0::DOUBLE * words / sum(words) OVER (), 0) AS INTEGER)) AS share FROM v WHERE words > 0""")
def lang_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order.split_lines(table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("corpus", F.lit(0))
    return language.usage(language.line_volumes(lines, ["corpus"], "line"), ["corpus"]).drop("corpus")


@query(f"""WITH {heuristic_sql(LINES, 'doc_id, line_no', 'line')},
v AS (SELECT doc_id, coalesce(lang, 'und') AS lang, CAST(sum({WORDS_SQL.format('txt')}) AS BIGINT) AS words FROM best GROUP BY 1, 2)
SELECT doc_id, lang, words, greatest(1, CAST(round_even(100.0::DOUBLE * words / sum(words) OVER (PARTITION BY doc_id), 0) AS INTEGER)) AS share FROM v WHERE words > 0""")
def lang_usage_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order.split_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return language.usage(language.line_volumes(lines, ["doc_id"], "line"), ["doc_id"])


@query(f"""WITH {heuristic_sql('SELECT conv_id, turn, role, text FROM conversations', 'conv_id, turn, role', 'text')},
c AS (SELECT conv_id, turn, role, coalesce(lang, 'und') AS lang, CAST({WORDS_SQL.format('txt')} AS BIGINT) AS words FROM best),
foreign_ AS (SELECT conv_id, turn, lang, words // 3 AS words FROM c WHERE role = 'assistant' AND words >= 3),
own AS (SELECT c.conv_id, c.lang, greatest(0, c.words - coalesce(f.words, 0)) AS words FROM c LEFT JOIN foreign_ f USING (conv_id, turn)
        UNION ALL SELECT conv_id, 'xx-' || lang, words FROM foreign_)
SELECT conv_id, lang, CAST(sum(words) AS BIGINT) AS words FROM own GROUP BY 1, 2 HAVING sum(words) > 0""")
def language_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("cont"), "role", F.coalesce(language.heuristic(F.col("text"))["lang"], F.lit("und")).alias("lang"), text.word_count(F.col("text")).cast("long").alias("words"))
    foreign = turns.filter((F.col("role") == "assistant") & (F.col("words") >= 3)).select("conv_id", "cont", F.concat(F.lit("xx-"), "lang").alias("lang"), F.expr("words div 3").alias("words"))
    return language.language_volume(turns.drop("role"), foreign, ["conv_id"])


@query(f"""WITH {heuristic_sql('SELECT doc_id, lang AS detected, source, text FROM documents', 'doc_id, detected, source', 'text')},
x AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'en' END AS prior, (doc_id % 10) / 10.0::DOUBLE AS conf FROM best),
y AS (SELECT *, coalesce(prior, 'fr') AS p, CASE WHEN prior IS NULL THEN 2 ELSE 1 END AS enough, CASE WHEN detected = lang THEN score ELSE 0 END AS ds FROM x)
SELECT doc_id, CASE WHEN detected = p AND p = 'fr' THEN detected WHEN detected = p THEN CASE WHEN lang = 'fr' AND score >= 2 THEN 'fr' ELSE detected END
  WHEN lang = p AND score >= enough THEN p WHEN prior IS NOT NULL AND ds < 1 AND conf < 0.9 THEN p WHEN lang IS NOT NULL AND score >= enough THEN lang
  WHEN conf >= 0.35 THEN detected ELSE p END AS decided FROM y""")
def lang_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", language.heuristic(F.col("text")).alias("h"))
    prior = F.when(F.col("doc_id") % 3 != 0, F.lit("en"))
    own = F.when(F.col("lang") == F.col("h.lang"), F.col("h.score")).otherwise(0)
    return d.select("doc_id", language.decision(F.col("lang"), (F.col("doc_id") % 10) / 10.0, prior, F.lit("fr"), F.col("h.lang"), F.col("h.score"), own).alias("decided"))


@query("""SELECT source, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM (
  SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents)
WHERE before <= 5000 GROUP BY 1""")
def doc_prior_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", F.length("text").alias("size"))
    return order.prefix_sample(d, ["source"], ["doc_id"], "size", 5000).groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("chars"))


@query(f"SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(length(line) AS INTEGER) AS chars, CAST({WORDS_SQL.format('line')} AS INTEGER) AS words FROM ({LINES})")
def line_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order.split_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return lines.select("doc_id", "line_no", F.length("line").alias("chars"), text.word_count(F.col("line")).alias("words"))


@query("""WITH w AS (SELECT item_id, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos, unnest(string_split(text, ' ')) AS word FROM benchmark),
o AS (SELECT *, coalesce(sum(length(word) + 1) OVER (PARTITION BY item_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM w),
t AS (SELECT *, a + length(word) AS b FROM o),
s AS (SELECT item_id, k AS span, k * 40 AS x, least((k + 1) * 40, length(text)) AS y FROM benchmark, (SELECT unnest(range(0, 400)) AS k) WHERE k * 40 < length(text))
SELECT t.item_id, CAST(pos AS INTEGER) AS pos, string_agg(span || ':' || greatest(a, x) || '-' || least(b, y), ',' ORDER BY span) AS pieces
FROM t JOIN s ON t.item_id = s.item_id AND a < y AND b > x GROUP BY 1, 2""")
def token_span_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    parts = items.filter(F.length("text") > 0).select("item_id", F.length("text").alias("n"), F.explode(F.expr("sequence(0, int((length(text) - 1) div 40))")).alias("span"))
    slices = parts.select("item_id", "span", (F.col("span") * 40).alias("span_start"), F.least((F.col("span") + 1) * 40, F.col("n")).alias("span_stop"))
    found = spans.aligned(spans.word_offsets(items, ["item_id"], "text"), slices, ["item_id"])
    text_of = F.transform("pieces", lambda p: F.concat(p["span"].cast("string"), F.lit(":"), p["a"].cast("string"), F.lit("-"), p["b"].cast("string")))
    return found.select("item_id", "pos", F.concat_ws(",", text_of).alias("pieces"))


@query(f"""WITH n AS (SELECT doc_id, CAST({WORDS_SQL.format('text')} AS INTEGER) AS n_words FROM documents)
SELECT doc_id, n_words, CAST(first AS INTEGER) AS first, CAST(least(first + 240, n_words) AS INTEGER) AS last
FROM (SELECT doc_id, n_words, unnest(range(0, greatest(0, CAST(ceil((n_words - 240) / 210.0::DOUBLE) AS BIGINT)) * 210 + 1, 210)) AS first FROM n)""")
def word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.word_windows(table(spark, sf_dir, "documents"), ["doc_id"], text.word_count(F.col("text")))


_TOKENS = "regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]+|[^\\s\\p{{L}}\\p{{N}}]')"
_ABBREVIATIONS = ", ".join(f"'{a}'" for a in sentences.ABBREVIATIONS)
_SEGMENTED = f"""WITH t AS (SELECT conv_id, turn, unnest({_TOKENS.format('text')}) AS form, generate_subscripts({_TOKENS.format('text')}, 1) AS ord FROM conversations),
n AS (SELECT *, lag(form) OVER w AS before, first_value(CASE WHEN regexp_matches(form, '[\\p{{L}}\\p{{N}}]') THEN form END IGNORE NULLS) OVER (PARTITION BY conv_id, turn ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS coming
      FROM t WINDOW w AS (PARTITION BY conv_id, turn ORDER BY ord)),
e AS (SELECT *, CAST(((form IN ('.', '?', '!') AND NOT coalesce(regexp_matches(before, '^\\p{{L}}$') OR lower(before) IN ({_ABBREVIATIONS}), false)) OR form = ':')
      AND coalesce(regexp_matches(coming, '^\\p{{Lu}}'), false) AS INTEGER) AS ends FROM n),
s AS (SELECT *, coalesce(sum(ends) OVER (PARTITION BY conv_id, turn ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS sent FROM e)"""


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(text.tokens(F.col("text"))).alias("tok_ord", "form"))


@query(_SEGMENTED + " SELECT conv_id, turn, CAST(sent AS BIGINT) AS sent_ord, count(*) AS tokens, arg_min(form, ord) AS first_form FROM s GROUP BY 1, 2, 3")
def sentence_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentences.segmented(_tokens(spark, sf_dir), ["conv_id", "turn"])
    return found.groupBy("conv_id", "turn", "sent_ord").agg(F.count("*").alias("tokens"), F.min_by("form", "tok_ord").alias("first_form"))


@query(f"""WITH t AS (SELECT conv_id, turn, {_TOKENS.format('text')} AS f FROM conversations),
c AS (SELECT conv_id, turn, len(f) AS n, f[len(f)] AS last_form FROM t),
g AS (SELECT *, coalesce(n > 0 AND last_form NOT IN ('.', '?', '!') AND lead(n) OVER (PARTITION BY conv_id ORDER BY turn) > 0, false) AS continues FROM c)
SELECT conv_id, turn, continues, coalesce(lag(continues) OVER (PARTITION BY conv_id ORDER BY turn), false) AS continued FROM g""")
def sentence_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.tokens(F.col("text")).alias("f"))
    ends = forms.select("conv_id", "turn", F.size("f").alias("n_tokens"), F.try_element_at("f", F.lit(-1)).alias("last_form"))
    return sentences.chained(ends, ["conv_id"], "turn").select("conv_id", "turn", "continues", "continued")


@query(_SEGMENTED + """, p AS (SELECT conv_id, turn, sent, ord // 12 AS line, min(ord) AS first_tok, count(*) AS n FROM s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, sent ORDER BY first_tok) - 1 AS k, count(*) OVER (PARTITION BY conv_id, turn, sent) AS m FROM p)
SELECT conv_id, turn, CAST(sent AS BIGINT) AS sent_ord, CAST(k AS INTEGER) AS fragment, CASE WHEN m = 1 THEN NULL WHEN k = 0 THEN 'I' WHEN k = m - 1 THEN 'F' ELSE 'M' END AS part, n AS n_tokens FROM r""")
def sentence_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = sentences.segmented(_tokens(spark, sf_dir), ["conv_id", "turn"]).withColumn("line", F.expr("int((tok_ord + 1) div 12)"))
    return sentences.fragments(tokens, ["conv_id", "turn"]).select("conv_id", "turn", "sent_ord", "fragment", "part", "n_tokens")


@query("""WITH w AS (SELECT item_id, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos, unnest(string_split(text, ' ')) AS word FROM benchmark),
x AS (SELECT *, (pos % 10) / 10.0::DOUBLE AS conf, lower(trim(word)) AS bare FROM w)
SELECT item_id, CAST(pos AS INTEGER) AS pos, CASE WHEN length(trim(word)) < 2 THEN 'too_short' WHEN regexp_matches(word, '[,;:!?]') THEN 'punctuation' WHEN length(bare) < 3 THEN 'too_short_plain'
  WHEN regexp_matches(word, '[0-9]') THEN 'digits' WHEN length(word) >= 7 AND upper(word) = word AND conf < 0.7 THEN 'capitals' WHEN bare = 'the and' THEN 'title' WHEN bare IN ('the', 'and') THEN 'title_word' END AS reason FROM x""")
def span_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spans.word_offsets(table(spark, sf_dir, "benchmark"), ["item_id"], "text")
    return words.select("item_id", "pos", spans.span_reason(F.col("word"), (F.col("pos") % 10) / 10.0, F.lit("person"), F.lit("The And")).alias("reason"))


@query("""SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace(replace(replace(replace(translate(regexp_replace(translate(text, '|¦', ''), '(\\p{L})[¬-]\\s*\\n\\s*(\\p{L})', '\\1\\2', 'g'), '¬', ''),
  'ſ', 's'), 'æ', 'ae'), 'œ', 'oe'), 'Æ', 'AE'), 'Œ', 'OE'), 'ß', 'ss'), 'ë', 'e'), 'ï', 'i'), 'ü', 'u'),
  '(\\p{L})uu(\\p{L})', '\\1uv\\2', 'g'), '(^|[^\\p{L}])i([aeiou])', '\\1j\\2', 'g'), '(^|[^\\p{L}])I([aeiou])', '\\1J\\2', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: w <> '')) AS INTEGER) AS words,
  md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace(replace(replace(replace(translate(regexp_replace(translate(text, '|¦', ''), '(\\p{L})[¬-]\\s*\\n\\s*(\\p{L})', '\\1\\2', 'g'), '¬', ''),
  'ſ', 's'), 'æ', 'ae'), 'œ', 'oe'), 'Æ', 'AE'), 'Œ', 'OE'), 'ß', 'ss'), 'ë', 'e'), 'ï', 'i'), 'ü', 'u'),
  '(\\p{L})uu(\\p{L})', '\\1uv\\2', 'g'), '(^|[^\\p{L}])i([aeiou])', '\\1j\\2', 'g'), '(^|[^\\p{L}])I([aeiou])', '\\1J\\2', 'g'), '\\s+', ' ', 'g'))) AS digest FROM documents""")
def historical_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = text.cleaned(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.word_count(clean).alias("words"), F.md5(clean.cast("binary")).alias("digest"))


@query(f"""WITH p AS (SELECT doc_id, text, lead(text) OVER (PARTITION BY source ORDER BY doc_id) AS reading FROM documents)
SELECT doc_id, {WORDS_SQL.format('reading')} > {WORDS_SQL.format('text')} * 1.5 + 2 AS outgrown FROM p WHERE reading IS NOT NULL""")
def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the words of a document and of the next one of its source: counts are shuffled, never texts."""
    counted = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("text").isNotNull(), text.word_count(F.col("text"))).alias("words"))
    after = F.lead("words").over(Window.partitionBy("source").orderBy("doc_id"))
    pairs = counted.select("doc_id", "words", after.alias("reading_words")).filter("reading_words is not null")
    return pairs.select("doc_id", text.outgrown_by(F.col("words"), F.col("reading_words")).alias("outgrown"))


@query("SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, len(regexp_extract_all(line, '\\p{L}')) >= 3 AS sendable, md5(regexp_replace(line, '^\\s*\\S+\\s*', '')) AS rest FROM (" + LINES + ")")
def sendable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order.split_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return lines.select("doc_id", "line_no", text.sendable(F.col("line")).alias("sendable"), F.md5(text.drop_carried_word(F.col("line")).cast("binary")).alias("rest"))


@query()
def reading_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each line to the one at its place in the document before of the source, with its band."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    pairs = order.with_previous(texts, "source", "doc_id", "text", "reading")
    cut = pairs.select("doc_id", F.split("text", "\n").alias("a"), F.split("reading", "\n").alias("b"))
    lines = cut.select("doc_id", F.posexplode(F.arrays_zip("a", "b")).alias("line_no", "l")).select("doc_id", "line_no", *(F.coalesce(f"l.{c}", F.lit("")).alias(c) for c in "ab"))
    both = (F.col("a") != "") & (F.col("b") != "")  # beside an empty line the other isn't needed
    lines = lines.select("doc_id", "line_no", *(F.when(both, F.col(c)).otherwise("").alias(c) for c in "ab"))
    scored = lines.repartition("doc_id", "line_no").select("doc_id", "line_no", F.round(kernels.ratio("a", "b"), 6).alias("similarity"))
    return scored.withColumn("cert", text.band(F.col("similarity"), [(0.95, "high"), (0.8, "medium"), (0.0, "low")]))


@query()
def dehyphenate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into lines of 40 letters, every cut inside a word marked, made whole again."""
    cut = F.split(F.regexp_replace("text", r"([^\n]{39})(?=\p{L})", "$1¬\n"), "\n")
    whole = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).select("doc_id", kernels.rejoin(cut, F.transform(cut, lambda _: F.lit("Main"))).alias("lines"))
    return whole.select("doc_id", F.posexplode("lines").alias("line_ord", "l")).select("doc_id", "line_ord", "l.joined", "l.carried")


@query()
def token_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where capitalized token forms lie in their text."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text", F.transform(text.tokens(F.col("text")), lambda t: F.upper(t)).alias("forms"))
    found = items.select("item_id", kernels.anchor_tokens("text", "forms").alias("a"))
    return found.select("item_id", F.col("a.astray").alias("astray"), F.explode("a.spans").alias("s")).select("item_id", "astray", "s.start", "s.stop")
