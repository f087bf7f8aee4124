"""Layout, order, catalogue, entity, loss and validation queries on the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings
from ..functions import dates, labels, text
from ..operators import catalogue, entities, losses, notes, order, spans, validate
from .registry import query, table

NS = entities.NAMESPACE
_HOST = "regexp_extract(url, '^https?://([^/]+)/', 1)"
_PATH = "regexp_extract(url, '^https?://[^/]+/(.*)$', 1)"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", F.expr(_HOST).alias("host"), F.expr(_PATH).alias("stem"))


@query("""SELECT p_partkey, CASE WHEN m = '' THEN 'none' ELSE m END AS main, CASE WHEN s = '' THEN 'none' ELSE s END AS subtype, CASE WHEN n = '' THEN 'none' ELSE n END AS n FROM (
  SELECT p_partkey, regexp_extract(p_brand, '^(\\w+):?(\\w+)?#?(\\d?)?', 1) AS m, regexp_extract(p_brand, '^(\\w+):?(\\w+)?#?(\\d?)?', 2) AS s, regexp_extract(p_brand, '^(\\w+):?(\\w+)?#?(\\d?)?', 3) AS n FROM part)""")
def label_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", labels.label_parts(F.col("p_brand")).alias("l")).select("p_partkey", "l.main", "l.subtype", "l.n")


@query(f"""WITH p AS (SELECT page_id, url, {_HOST} AS host, coalesce(try_cast(nullif(regexp_extract({_PATH}, '(\\d+)', 1), '') AS INTEGER), 999999) AS num FROM pages)
SELECT page_id, host, num, CAST(row_number() OVER (PARTITION BY host ORDER BY num, url) AS INTEGER) AS page_ord FROM p""")
def page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.page_order(_pages(spark, sf_dir), ["host"], "stem", "url", "page_id").select("page_id", "host", "num", "page_ord")


@query(f"SELECT {_HOST} AS host, coalesce(try_cast(nullif(regexp_extract({_PATH}, '(\\d+)', 1), '') AS INTEGER), 999999) AS num, count(*) AS pages FROM pages GROUP BY 1, 2 HAVING count(*) > 1")
def page_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.page_collisions(_pages(spark, sf_dir), ["host"], "stem")


@query("SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS INTEGER) AS occurrence FROM events")
def dup_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.occurrence(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "occurrence")


@query(f"""WITH h AS (SELECT c_custkey, sha1(unhex('{NS.hex}') || encode(c_mktsegment || chr(31) || c_name)) AS h FROM customer)
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(h, 17, 1))::INTEGER % 4 + 1 AS BIGINT), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", entities.entity_id(F.col("c_mktsegment"), F.col("c_name")).alias("id"))


@query("""WITH m AS (SELECT *, coalesce(CAST(event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 AS INTEGER), 1) AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM m)
SELECT user_id, CAST(island AS BIGINT) AS island, any_value(event_type) AS event_type, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event FROM r GROUP BY 1, 2""")
def containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = order.islands(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_type"])
    return runs.groupBy("user_id", "island").agg(F.any_value("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


@query("SELECT event_id, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS next_same FROM events")
def next_same_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.next_same_kind(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["ts", "event_id"], "event_id").select("event_id", "next_same")


@query("SELECT user_id, CAST(day AS INTEGER) AS day FROM (SELECT user_id, day(ts) AS day, event_type FROM events) GROUP BY ALL HAVING bool_or(event_type = 'signup') AND NOT bool_or(starts_with(event_type, 'err'))")
def front_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.containers import front_pages as fronts

    days = table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").alias("day"), "event_type")
    return fronts(days, ["user_id", "day"], "event_type", "signup", "err")


@query("SELECT event_id, count(CASE WHEN event_type <> 'click' THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS after_lines FROM events QUALIFY event_type = 'click'")
def figure_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = order.lines_before(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "click")
    return placed.filter("event_type = 'click'").select("event_id", "after_lines")


@query("SELECT user_id, count(CASE WHEN event_type NOT IN ('error', 'view') THEN 1 END) AS extent, count(*) AS all_lines FROM events GROUP BY 1")
def text_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.when(~F.col("event_type").isin("error", "view"), 1)).alias("extent"), F.count("*").alias("all_lines"))


@query("""WITH n AS (SELECT user_id, event_id, value AS top, value + 2 AS foot FROM events WHERE event_type = 'error'),
l AS (SELECT user_id, event_id AS line_id, value AS top, value + 1 AS foot FROM events WHERE event_type = 'view'),
j AS (SELECT n.user_id, n.event_id AS note_id, n.top, l.line_id, l.top AS line_top FROM n JOIN l ON n.user_id = l.user_id AND l.top < n.foot AND l.foot > n.top),
a AS (SELECT user_id, note_id, arg_min(line_id, (line_top, line_id)) AS anchor, string_agg(line_id, ',' ORDER BY line_top, line_id) AS targets FROM j GROUP BY 1, 2),
k AS (SELECT n.user_id, n.event_id AS note_id, n.top, anchor, targets FROM n LEFT JOIN a ON n.event_id = a.note_id)
SELECT user_id, note_id, anchor, targets, CASE WHEN anchor IS NOT NULL AND count(*) OVER (PARTITION BY user_id, anchor) > 1 THEN CAST(row_number() OVER (PARTITION BY user_id, anchor ORDER BY top, note_id) AS INTEGER) END AS n FROM k""")
def note_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = lambda k, name, size: e.filter(F.col("event_type") == k).select("user_id", F.col("event_id").alias(name), F.col("value").alias("top"), (F.col("value") + size).alias("foot"))
    found = notes.note_links(kind("error", "note_id", 2), kind("view", "line_id", 1), ["user_id"])
    return found.select("user_id", "note_id", "anchor", F.when(F.col("targets").isNotNull(), F.concat_ws(",", F.transform("targets", lambda t: t.cast("string")))).alias("targets"), "n")


@query("SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) AS ulx, CAST(floor(l_extendedprice / 100) AS INTEGER) AS uly, CAST(floor(l_quantity + l_tax * 1000) AS INTEGER) AS lrx, CAST(floor(l_extendedprice / 100 + l_discount * 1000) AS INTEGER) AS lry FROM lineitem")
def zone_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = labels.corners(F.col("l_quantity"), F.col("l_extendedprice") / 100, F.col("l_tax") * 1000, F.col("l_discount") * 1000)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", "b.*")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 > 0 THEN 'https://images.example.org/' || c_nationkey || '/f' || (c_custkey % 7) || '/' || c_custkey || ',' || c_nationkey || ',100,200/full/0/native.jpg' END AS url,
  CASE WHEN c_custkey % 3 > 0 THEN c_custkey || ',' || c_nationkey || ' 7,9' END AS points FROM customer""")
def crop_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    s = lambda name: F.col(name).cast("string")
    base = F.concat(F.lit("https://images.example.org/"), s("c_nationkey"))
    raw = F.concat_ws(" ", s("c_custkey"), s("c_nationkey"), F.lit("7.5"), F.when(F.col("c_custkey") % 3 > 0, F.lit("9.2")))
    return c.select("c_custkey", labels.crop_url(base, (F.col("c_custkey") % 7).cast("int"), s("c_custkey"), s("c_nationkey"), F.lit("100"), F.lit("200")).alias("url"), labels.points(raw).alias("points"))


@query("""WITH b AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_discount DESC, l_orderkey, l_linenumber, l_extendedprice, l_quantity) = 1)
SELECT l_partkey, l_suppkey, l_discount, l_orderkey, l_linenumber FROM b""")
def span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_discount", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return spans.best_per_key(rows, ["l_partkey", "l_suppkey"], "l_discount", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]).drop("l_extendedprice", "l_quantity")


@query()
def overlap_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as spans of a user's timeline, the most valuable chosen first."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.expr("int(event_id div 20)").alias("start"), F.expr("int(event_id div 20) + 1 + int(value / 10)").alias("stop"), F.col("value").alias("confidence"))
    return spans.without_overlaps(e, ["user_id"], ["event_id"])


def _model_sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Mentions of two models: an order's lines by supplier of even and odd number, with small sets of words."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    out = []
    for k in (0, 1):
        words = F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: ((F.col("l_partkey") + i) % 7).cast("string"))))
        own = l.filter(F.col("l_suppkey") % 2 == k).withColumn("ord", F.expr("int(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice))"))
        out.append(own.select("l_orderkey", "ord", F.col("l_returnflag").alias("type"), F.col("l_discount").alias("confidence"), F.lit("ab"[k]).alias("model"), words.alias("words")))
    return out


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 2 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord,
  list_distinct([(l_partkey + i) % 7 FOR i IN range(0, 4)]) AS words FROM lineitem)
SELECT x.l_orderkey, CAST(x.ord AS INTEGER) AS a, CAST(y.ord AS INTEGER) AS b, CAST(len(list_intersect(x.words, y.words)) AS INTEGER) AS common,
  round(len(list_intersect(x.words, y.words)) / len(list_distinct(list_concat(x.words, y.words)))::DOUBLE, 6) AS jaccard
FROM l x JOIN l y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey % 2 = 0 AND y.l_suppkey % 2 = 1 WHERE len(list_intersect(x.words, y.words)) > 0""")
def merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _model_sides(spark, sf_dir)
    return spans.overlap_candidates(a.select("l_orderkey", F.col("ord").alias("a"), "words"), b.select("l_orderkey", F.col("ord").alias("b"), "words"), ["l_orderkey"])


@query()
def model_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.merged_models(*_model_sides(spark, sf_dir), ["l_orderkey"])


@query("SELECT o_orderpriority, o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS canonical, count(*) AS mentions, max(o_totalprice) AS confidence FROM orders GROUP BY 1, 2")
def entity_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.grouped(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_custkey"], "o_orderkey", "o_totalprice", ["o_orderkey"])


@query("SELECT o_custkey, count(*) AS mentions, round(max(o_totalprice) / 500000, 6) AS confidence FROM orders GROUP BY 1 HAVING count(*) > 1 OR round(max(o_totalprice) / 500000, 6) >= 0.55")
def entity_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("mentions"), F.round(F.max("o_totalprice") / 500000, 6).alias("confidence"))
    return entities.pruned(groups)


@query("SELECT o_orderkey, o_custkey || '-m' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS mention_id FROM orders")
def mention_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.mention_ids(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey").select("o_orderkey", "mention_id")


def _part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_type", "p_name").agg(F.min("p_partkey").alias("ord"), F.count("*").alias("mentions"))


@query("""WITH n AS (SELECT p_type, p_name, min(p_partkey) AS ord FROM part GROUP BY 1, 2)
SELECT x.p_type, x.p_name AS a, x.ord AS ord_a, y.p_name AS b, y.ord AS ord_b FROM n x JOIN n y ON x.p_type = y.p_type AND x.ord < y.ord
WHERE length(x.p_name) >= 4 AND length(y.p_name) >= 4 AND 2 * least(length(x.p_name), length(y.p_name)) >= 0.78 * (length(x.p_name) + length(y.p_name))""")
def fuzzy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.fuzzy_candidates(_part_names(spark, sf_dir), ["p_type"], "p_name", "ord")


@query()
def fuzzy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.fuzzy_merged(_part_names(spark, sf_dir), ["p_type"], "p_name", "ord", "mentions").select("p_type", "p_name", "mentions", "representative")


@query("""WITH p AS (SELECT DISTINCT p_name FROM part), c AS (SELECT r_regionkey AS person_id, r_name, ['ring', 'widget', 'blue bolt', 'small', 'gear'][r_regionkey + 1] AS surname FROM region),
h AS (SELECT p_name, person_id FROM p JOIN c ON len(list_filter(string_split(lower(surname), ' '), lambda w: NOT list_contains(string_split(lower(p_name), ' '), w))) = 0 OR lower(p_name) = lower(r_name))
SELECT p_partkey, (SELECT min(person_id) FROM h WHERE h.p_name = part.p_name) AS person_id FROM part""")
def person_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    surnames = F.array(*(F.lit(s) for s in ("ring", "widget", "blue bolt", "small", "gear")))
    people = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("person_id"), F.col("r_regionkey").alias("cat_ord"), F.col("r_name").alias("full"), F.element_at(surnames, F.col("r_regionkey") + 1).alias("surname"))
    return entities.linked(table(spark, sf_dir, "part").select("p_partkey", "p_name"), people, "p_name").select("p_partkey", "person_id")


@query("""WITH p AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Customer#' || lpad(s_suppkey::VARCHAR, 8, '0') ELSE 'Customer#' || lpad(s_suppkey::VARCHAR, 9, '0') END AS prefix FROM supplier)
SELECT s_suppkey, prefix, count(c_name) AS matches, arg_min(c_custkey, (c_name <> prefix, c_custkey)) AS c_custkey FROM p LEFT JOIN customer ON starts_with(c_name, prefix) GROUP BY 1, 2""")
def catalogue_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    prefixes = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Customer#"), F.when(F.col("s_suppkey") % 2 == 0, F.lpad(key, 8, "0")).otherwise(F.lpad(key, 9, "0"))).alias("prefix"))
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return catalogue.prefix_match(prefixes, "prefix", names, "c_name", "c_custkey").select("s_suppkey", "prefix", "matches", "c_custkey")


@query("""WITH r AS (SELECT p_partkey, string_split(lower(p_type) || '|' || p_name || '|aut', '|') AS codes FROM part)
SELECT p_partkey, array_to_string(list_transform(codes, lambda c: CASE c WHEN 'aut' THEN 'author' WHEN 'promo' THEN 'printer' ELSE lower(c) END), ';') AS roles FROM r""")
def multi_value_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.concat_ws("|", F.lower("p_type"), "p_name", F.lit("aut"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(catalogue.roles(cell, {"aut": "author", "promo": "printer"}), ";").alias("roles"))


@query("""WITH c AS (SELECT c_custkey, unnest(string_split(c_nationkey || '|99|' || (c_nationkey + 1) % 30, '|')) AS code, generate_subscripts(string_split(c_nationkey || '|99|' || (c_nationkey + 1) % 30, '|'), 1) AS pos FROM customer)
SELECT c_custkey, string_agg(coalesce(n_name, code), ';' ORDER BY pos) AS names FROM c LEFT JOIN nation ON code = n_nationkey::VARCHAR GROUP BY 1""")
def person_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws("|", n.cast("string"), F.lit("99"), ((n + 1) % 30).cast("string")).alias("cell"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"), "n_name")
    return catalogue.listed(rows, "c_custkey", "cell", nations, "code", "n_name").select("c_custkey", F.array_join("names", ";").alias("names"))


@query("""WITH o AS (SELECT o_orderkey, o_orderkey % 8 AS k, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m, strftime(o_orderdate, '%d') AS d FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN y || '-' || m || '-' || d WHEN 1 THEN y || '-' || m WHEN 2 THEN y WHEN 4 THEN y || '-' || m || '-' || d WHEN 6 THEN '-00' || substr(y, 3) || '-' || m || '-' || d WHEN 7 THEN '-000' || substr(y, 4) || '-' || m || '-' || d END AS when_,
  CASE k WHEN 3 THEN substr(y, 1, 3) || '0' WHEN 5 THEN '-' || substr(y, 1, 3) || '9' END AS not_before, CASE k WHEN 3 THEN substr(y, 1, 3) || '9' WHEN 5 THEN '-' || substr(y, 1, 3) || '0' END AS not_after,
  CASE WHEN k IN (3, 4, 5) THEN 'low' END AS cert FROM o""")
def date_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 8
    year = F.date_format(d, "yyyy")
    cell = (
        F.when(k == 0, F.date_format(d, "yyyy/MM/dd")).when(k == 1, F.date_format(d, "yyyyMM")).when(k == 2, year).when(k == 3, F.substring(year, 1, 3))
        .when(k == 4, F.concat(F.lit("ca. "), F.date_format(d, "yyyyMMdd"))).when(k == 5, F.concat(F.lit("-"), F.substring(year, 1, 3)))
        .when(k == 6, F.concat(F.lit("-"), F.substring(year, 3, 2), F.date_format(d, "MMdd"))).otherwise(F.concat(F.lit("-"), F.substring(year, 4, 1), F.date_format(d, "MMdd")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.date_attributes(cell).alias("a")).select("o_orderkey", F.col("a.when").alias("when_"), "a.not_before", "a.not_after", "a.cert")


@query("SELECT l_orderkey, l_linenumber, l_discount, CASE WHEN l_discount >= 0.08 THEN 'high' WHEN l_discount >= 0.04 THEN 'medium' WHEN l_discount >= 0.02 THEN 'low' END AS cert FROM lineitem")
def cert_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", text.band(F.col("l_discount"), [(0.08, "high"), (0.04, "medium"), (0.02, "low")]).alias("cert"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def unfigured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part is none of the small ones."""
    small = table(spark, sf_dir, "part").filter("p_size < 25").select(F.col("p_partkey").alias("l_partkey"))
    return validate.without_figure(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), small, ["l_partkey"]).select("l_orderkey", "l_linenumber")


@query("""WITH r AS (SELECT page_id, '#p' || (page_id * 7 % 400) || ' #p' || page_id || ' /x' AS cell FROM pages), e AS (SELECT page_id, unnest(string_split(cell, ' ')) AS t FROM r)
SELECT 0 AS corpus, substr(t, 2) AS target, count(*) AS refs FROM e WHERE starts_with(t, '#') AND substr(t, 2) NOT IN (SELECT 'p' || page_id FROM pages) GROUP BY 1, 2""")
def dangling_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").withColumn("corpus", F.lit(0))
    cells = p.select("corpus", F.format_string("#p%d #p%d /x", F.col("page_id") * 7 % 400, F.col("page_id")).alias("cell"))
    ids = p.select("corpus", F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"))
    return validate.dangling(cells, ["corpus"], "cell", ids, "id").groupBy("corpus", "target").agg(F.count("*").alias("refs"))


@query("SELECT l_orderkey, l_partkey % 50 AS id, count(*) - 1 AS repeats FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_xml_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.duplicate_ids(table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 50).alias("id")), ["l_orderkey"], "id")


@query("""WITH z AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || ',' || p_partkey WHEN 1 THEN p_size || ' ' || p_partkey WHEN 2 THEN '0,1 0,2 0,' || p_size ELSE '0,1 0,' || p_size END AS points FROM part)
SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'malformed' ELSE 'all_zero' END AS problem FROM z WHERE p_partkey % 4 IN (1, 2)""")
def points_wellformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size, key = F.col("p_partkey") % 4, F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    value = F.when(k == 0, F.concat_ws(",", size, key)).when(k == 1, F.concat_ws(" ", size, key)).when(k == 2, F.concat(F.lit("0,1 0,2 0,"), size)).otherwise(F.concat(F.lit("0,1 0,"), size))
    return validate.bad_points(table(spark, sf_dir, "part").select("p_partkey", value.alias("points")), "points").select("p_partkey", "problem")


@query(f"""WITH w AS (SELECT page_id, {_HOST} AS doc, {_PATH} AS message FROM pages),
s AS (SELECT *, regexp_replace(message, '\\d+', 'N', 'g') AS shape, regexp_extract_all(message, '\\d+') AS nums FROM w),
n AS (SELECT shape, unnest(nums) AS v, generate_subscripts(nums, 1) AS k FROM s),
t AS (SELECT shape, string_agg(total, ',' ORDER BY k) AS totals FROM (SELECT shape, k, sum(v::BIGINT) AS total FROM n GROUP BY 1, 2) GROUP BY 1)
SELECT s.shape, count(*) AS occurrences, count(DISTINCT doc) AS documents, arg_min(doc || ': ' || message, page_id) AS example, any_value(totals) AS totals FROM s LEFT JOIN t USING (shape) GROUP BY 1""")
def warning_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _pages(spark, sf_dir).select("page_id", "host", F.concat_ws(": ", "host", "stem").alias("message"))
    found = losses.warning_digest(w, "host", "message", "page_id")
    return found.withColumn("totals", F.when(F.col("totals").isNotNull(), F.array_join(F.transform("totals", lambda t: t.cast("string")), ",")))


@query("""SELECT user_id % 3 AS block, CAST(sum(CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS BIGINT) ELSE 0 END) AS BIGINT) AS lost,
  CAST(sum(CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) ELSE 0 END) AS BIGINT) AS repaired, count(*) AS entries FROM events GROUP BY 1""")
def loss_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("block"), "event_type", F.floor("value").alias("count"))
    return losses.by_block(e, "block", "event_type", "count", ["view"])


@query("SELECT event_type, min(event_id) AS first_seen, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS lost FROM events WHERE user_id % 3 = 1 AND event_type <> 'view' AND floor(value) > 0 GROUP BY 1")
def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.floor("value").alias("count"))
    return losses.gate(e, "event_type", "count", "event_id", (F.col("user_id") % 3 == 1) & (F.col("event_type") != "view"))


@query("""WITH d AS (SELECT user_id, count(CASE WHEN event_type = 'error' THEN 1 END) AS lost, count(CASE WHEN event_type <> 'view' THEN 1 END) AS total FROM events GROUP BY 1)
SELECT user_id, lost, total, round(100.0::DOUBLE * lost / total, 4) AS percent FROM d WHERE total > 0 AND 100.0::DOUBLE * lost / total > 25""")
def page_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.when(F.col("event_type") == "error", 1)).alias("lost"), F.count(F.when(F.col("event_type") != "view", 1)).alias("total"))
    return losses.page_loss(d, "lost", "total", 25)


@query("SELECT user_id, round(quantile_cont(value / (event_id % 5 + 1), 0.5) * 10, 6) AS eta_s FROM events GROUP BY 1")
def eta_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("pages", F.col("event_id") % 5 + 1)
    return losses.eta(e, "user_id", "value", "pages", F.lit(10)).withColumn("eta_s", F.round("eta_s", 6))


@query("SELECT p_partkey, p_name FROM part WHERE (p_name GLOB '*bolt' OR p_name GLOB 'red ?i*') AND NOT p_name GLOB 'blue*' AND p_partkey NOT IN (SELECT s_suppkey FROM supplier)")
def select_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    done = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p_partkey"))
    return catalogue.selected(parts, "p_name", ["*bolt", "red ?i*"], ["blue*"]).join(done, "p_partkey", "left_anti")


@query("""WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS b, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::VARCHAR END AS c FROM orders)
SELECT o_orderkey, coalesce(a, nullif(b, ''), c, 'x') AS value, CASE WHEN a IS NOT NULL THEN 'flag' WHEN nullif(b, '') IS NOT NULL THEN 'env' WHEN c IS NOT NULL THEN 'file' ELSE 'default' END AS origin FROM l""")
def settings_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    env = F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.col("o_orderpriority"))
    found = settings.resolve_columns(F.when(k % 4 == 0, F.col("o_orderstatus")), env, F.when(k % 2 == 0, F.col("o_custkey").cast("string")), F.lit("x"))
    return o.select("o_orderkey", found.alias("s")).select("o_orderkey", "s.*")


@query("""SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN 'I' || count(CASE WHEN event_id % 10 <> 0 THEN 1 END) OVER (PARTITION BY user_id ORDER BY event_id) END AS incident,
  CASE WHEN event_id % 10 <> 0 THEN 'K' || json_extract_string(props, '$.k') ELSE 'unreadable' END AS code FROM events""")
def incident_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(F.col("props")).alias("value"))
    parsed = e.withColumn("r", F.from_json("value", "k string, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    good = F.col("r._bad").isNull() & F.col("r.k").isNotNull()
    number = F.sum(good.cast("int")).over(Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return parsed.select("event_id", F.when(good, F.concat(F.lit("I"), number.cast("string"))).alias("incident"), F.when(good, F.concat(F.lit("K"), F.col("r.k"))).otherwise("unreadable").alias("code"))


@query("SELECT DISTINCT p_type AS label FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'OTHER') UNION SELECT 'DefaultLine'")
def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "part").select(F.col("p_type").alias("label")).distinct()
    known = spark.createDataFrame([("ECONOMY",), ("SMALL",), ("OTHER",)], "label string")
    return seen.intersect(known).union(spark.createDataFrame([("DefaultLine",)], "label string")).distinct()


@query("""SELECT count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS ok, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS skipped, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS failed,
  count(CASE WHEN o_orderstatus NOT IN ('O', 'P', 'F') THEN 1 END) AS untried, count(*) AS found FROM orders""")
def selection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.create_map(*(F.lit(x) for x in ("O", "ok", "P", "skipped", "F", "failed")))
    return losses.selection_counts(table(spark, sf_dir, "orders").select(F.coalesce(F.try_element_at(state, "o_orderstatus"), F.lit("untried")).alias("status")), "status")


@query("SELECT c_custkey, list_sort(list_distinct([c_nationkey % 5, c_custkey % 4, 3]))::VARCHAR AS persons FROM customer")
def role_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 5).cast("string").alias("a"), F.concat_ws("|", (F.col("c_custkey") % 4).cast("string"), F.lit("3")).alias("b"))
    return catalogue.persons_of(cells, "c_custkey", ["a", "b"]).select("c_custkey", F.concat(F.lit("["), F.array_join("persons", ", "), F.lit("]")).alias("persons"))


@query("""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '1659' WHEN 1 THEN '1724' WHEN 3 THEN (1700 + c_nationkey)::VARCHAR WHEN 5 THEN (1600 + c_nationkey)::VARCHAR END AS when_,
CASE c_custkey % 7 WHEN 5 THEN 'low' END AS cert FROM customer""")
def text_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 7
    year = lambda century: (F.col("c_nationkey") + century).cast("string")
    said = (
        F.when(k == 0, F.lit("M.DC.LIX")).when(k == 1, F.lit("l'an MDCCXXIV,")).when(k == 2, F.lit("MDCLIIII")).when(k == 3, F.concat(F.lit("(en "), year(1700), F.lit(".)")))
        .when(k == 4, F.lit("le 23 juin 1652")).when(k == 5, F.concat(F.lit("vers "), year(1600))).otherwise(F.lit("anno 59"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", dates.text_date(said).alias("d")).select("c_custkey", F.col("d.when").alias("when_"), "d.cert")
