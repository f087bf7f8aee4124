"""Offsets, readings and accounting on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import entities, losses, offsets, order, readings, spans
from .registry import query, table

_LINES = "SELECT conv_id, turn, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM conversations"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


@query(f"""WITH l AS ({_LINES}), j AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY conv_id, turn ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l),
s AS (SELECT DISTINCT conv_id, turn, unnest([10, 120]) AS a, unnest([70, 200]) AS b, unnest(['lat', 'grc']) AS lang FROM l)
SELECT conv_id, turn, CAST(line_no AS INTEGER) AS line_no, CAST(greatest(s.a, start) - start AS INTEGER) AS a, CAST(least(s.b, start + length(line)) - start AS INTEGER) AS b, lang
FROM j JOIN s USING (conv_id, turn) WHERE s.a < start + length(line) AND s.b > start""")
def segments_on_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = offsets.joined(_lines(spark, sf_dir), ["conv_id", "turn"], "line_no", "line")
    both = F.array(*(F.struct(F.lit(a).alias("from"), F.lit(b).alias("to"), F.lit(lang).alias("lang")) for a, b, lang in ((10, 70, "lat"), (120, 200, "grc"))))
    segments = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.inline(both))
    return offsets.on_lines(segments, lines, ["conv_id", "turn"], "line_no")


@query()
def spliced_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping segments of each turn trimmed to whole words."""
    made = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(lang).alias("lang")) for a, b, lang in ((3, 30, "lat"), (20, 50, "grc"), (25, 28, "ita"))))
    found = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(offsets.spliced("text", made)).alias("s"))
    return found.select("conv_id", "turn", "s.start", "s.stop", "s.lang")


@query()
def clean_with_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain form of each turn, and whether its map leads back to the input."""
    found = table(spark, sf_dir, "conversations").select("conv_id", "turn", offsets.cleaned_map("text").alias("c"))
    return found.select("conv_id", "turn", F.md5(F.col("c.text").cast("binary")).alias("digest"), F.size("c.origin").alias("n"), F.array_max("c.origin").alias("last"))


@query("""SELECT conv_id, turn, replace(replace(regexp_replace(array_to_string(regexp_extract_all(text, '[\\p{L}\\p{N}]+|[,.]'), ' '), ' ([,.])', '\\1', 'g'), '  ', ' '), chr(10), ' ') AS flat FROM conversations""")
def flat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}]+|[,.])"), 1)
    tokens = F.transform(forms, lambda f: F.struct(f.alias("form"), F.when(f.isin(",", "."), "left").alias("joins")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", offsets.flat_text(tokens).alias("flat"))


@query("""WITH r AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
l AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY k) AS n FROM r WHERE event_type = 'view'),
g AS (SELECT user_id, event_id AS reading_id, row_number() OVER (PARTITION BY user_id ORDER BY k) AS n FROM r WHERE event_type = 'click')
SELECT l.user_id, l.event_id, g.reading_id FROM l JOIN g USING (user_id, n)""")
def readings_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.struct("ts", "event_id").alias("at"))
    lines = e.filter("event_type = 'view'").select("user_id", "event_id", "at")
    other = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("reading_id"), F.col("at").alias("reading_at"))
    return readings.by_position(lines, other, ["user_id"], "at", "reading_at").select("user_id", "event_id", "reading_id")


@query()
def graded_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against a reading that changes a letter, grows or stays."""
    lines = _lines(spark, sf_dir).filter(F.length("line") > 0)
    k = F.col("line_no") % 4
    reading = F.when(k == 0, F.col("line")).when(k == 1, F.replace("line", F.lit("en"), F.lit("an"))).when(k == 2, F.concat_ws(" ", "line", "line", "line"))
    return readings.graded(lines.withColumn("reading", reading).withColumn("carried", k == 1), "line", "reading", "carried").select("conv_id", "turn", "line_no", "status", "cert", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("""WITH w AS (SELECT item_id, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos, unnest(string_split(text, ' ')) AS word FROM benchmark),
o AS (SELECT *, coalesce(sum(length(word) + 1) OVER (PARTITION BY item_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM w),
s AS (SELECT item_id, unnest([0, 1, 2]) AS span_id, unnest([3, 30, 60]) AS x, unnest([12, 31, 90]) AS y FROM benchmark)
SELECT o.item_id, span_id, string_agg(word, ' ' ORDER BY pos) AS forms, CAST(min(a) AS BIGINT) AS first, CAST(max(a + length(word)) AS BIGINT) AS last
FROM o JOIN s ON o.item_id = s.item_id AND a < y AND a + length(word) > x GROUP BY 1, 2""")
def span_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    made = F.array(*(F.struct(F.lit(k).alias("span_id"), F.lit(a).alias("span_start"), F.lit(b).alias("span_stop")) for k, (a, b) in enumerate(((3, 12), (30, 31), (60, 90)))))
    found = spans.span_words(items.select("item_id", F.inline(made)), spans.word_offsets(items, ["item_id"], "text"), ["item_id"])
    return found.select("item_id", "span_id", F.concat_ws(" ", "forms").alias("forms"), F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
SELECT l_orderkey, min(l_linenumber) AS first, max(l_linenumber) AS last, count(*) AS n FROM r GROUP BY l_orderkey, l_linenumber - k""")
def adjacent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.adjacent_runs(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct(), ["l_orderkey"], "l_linenumber")


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY seen) AS kinds FROM (SELECT user_id, event_type, min(event_id) AS seen FROM events GROUP BY 1, 2) GROUP BY 1")
def tagsets_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.first_seen(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id").select("user_id", F.array_join("values", ",").alias("kinds"))


@query("SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS mentions FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def mention_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderkey").cast("string").alias("mention"))
    found = entities.mention_links(o, "o_custkey", "mention", "o_orderkey", F.col("o_orderstatus") != "P")
    return found.select("o_custkey", F.array_join("mentions", ",").alias("mentions"))


@query("""WITH d AS (SELECT user_id, count(CASE WHEN event_type = 'error' AND user_id % 4 > 0 THEN 1 END) AS a, count(CASE WHEN event_type = 'view' AND user_id % 4 > 0 THEN 1 END) AS b, count(*) AS total FROM events GROUP BY 1)
SELECT user_id, code, count FROM (SELECT user_id, unnest(['REFUSED', 'UNSENT', 'LOST']) AS code, unnest([a, b, CASE WHEN a + b = 0 THEN total END]) AS count FROM d) WHERE count > 0""")
def loss_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = F.col("user_id") % 4 > 0
    d = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.when((F.col("event_type") == "error") & some, 1)).alias("a"), F.count(F.when((F.col("event_type") == "view") & some, 1)).alias("b"), F.count("*").alias("total"))
    return losses.by_cause(d, "user_id", {"a": "REFUSED", "b": "UNSENT"}, "total", "LOST")


@query("SELECT user_id % 3 AS block, CAST(sum(CASE WHEN event_type <> 'click' THEN floor(value)::BIGINT ELSE 0 END) AS BIGINT) AS precise, CAST(sum(CASE WHEN event_type = 'click' THEN floor(value)::BIGINT ELSE 0 END) AS BIGINT) AS document_only FROM events GROUP BY 1")
def located_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("block"), F.when(F.col("event_type") != "click", F.col("event_id")).alias("page"), F.floor("value").alias("count"))
    return losses.located(e, "block", "page", "count")


@query("""WITH m AS (SELECT *, coalesce(CAST(role IS DISTINCT FROM lag(role) OVER w OR row_number() OVER w = 1 AS INTEGER), 1) AS s FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT *, sum(s) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM m)
SELECT conv_id, CAST(island AS BIGINT) AS island, any_value(role) AS role, count(*) AS turns FROM r GROUP BY 1, 2""")
def language_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order.islands(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], ["role"])
    return runs.groupBy("conv_id", "island").agg(F.any_value("role").alias("role"), F.count("*").alias("turns"))
