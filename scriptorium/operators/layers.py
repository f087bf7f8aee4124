"""Entity layers: blocks of original, modernized and raw text, models, and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import text_date
from . import entities, spans

SHORTEST = 10
CERTS = ["low", "medium", "high"]


def _joined(lines: DataFrame, key: list[str], order: str, text: str) -> DataFrame:
    """Texts that aren't blank, in order, by blanks."""
    some = lines.filter(F.trim(F.coalesce(text, F.lit(""))) != "")
    return some.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda s: s[text]), " ").alias("text"))


def blocks(containers: DataFrame, lines: DataFrame, key: list[str], order: str, text: str, reading: str, modern: str = "fra") -> DataFrame:
    """key, lang, source, text.  containers: key, lang, has_tokens; lines: key, order, text,
    reading.  Tokenized containers give their original text, those in the modernized
    language their readings too, others their raw text; und gives none."""
    known = containers.filter(F.col("lang") != "und")
    tagged = known.filter("has_tokens")
    origin = tagged.join(_joined(lines, key, order, text), key).select(*key, "lang", F.lit("orig").alias("source"), "text")
    read = lines.select(*key, order, F.col(reading).alias("text"))
    regular = tagged.filter(F.col("lang") == modern).join(_joined(read, key, order, "text"), key).select(*key, "lang", F.lit("reg").alias("source"), "text")
    raw = known.filter("not has_tokens").join(_joined(lines, key, order, text), key).select(*key, "lang", F.lit("raw").alias("source"), F.trim("text").alias("text"))
    return origin.unionByName(regular).unionByName(raw)


def dispatched(blocks_: DataFrame, models: dict[tuple[str, str], str], otherwise: str) -> DataFrame:
    """Blocks with the model for their source and language; short ones go to none."""
    chosen = F.lit(otherwise)
    for (source, lang), model in models.items():
        chosen = F.when((F.col("source") == source) & (F.col("lang") == lang), F.lit(model)).otherwise(chosen)
    return blocks_.filter(F.length(F.trim("text")) >= SHORTEST).withColumn("model", chosen)


def typed(spans_: DataFrame, label: str, types: DataFrame) -> DataFrame:
    """Spans with the type of their model's label; labels without one go.  types: label, type."""
    return spans_.join(F.broadcast(types), label)


def aligned_layers(found: DataFrame, words: DataFrame, readings: DataFrame, key: list[str]) -> DataFrame:
    """Words of each span by its source: those it overlaps in the original, those at the
    same places for a reading, none for raw text.  found: span_id, span_start,
    span_stop, source; words, readings: pos, word, start, stop."""
    of = lambda s: found.filter(F.col("source") == s).drop("source")
    origin = spans.span_words(of("orig"), words, key).select(*key, "span_id", "positions")
    regular = spans.through_readings(spans.span_words(of("reg"), readings, key), words, key).select(*key, "span_id", "positions")
    raw = of("raw").select(*key, "span_id", F.expr("cast(array() as array<int>)").alias("positions"))
    return origin.unionByName(regular).unionByName(raw)


def backfilled(mentions: DataFrame, readings: DataFrame, key: list[str], line: str) -> DataFrame:
    """For mentions that have words of the original alone, their range in the reading of
    each of their lines: from the first to the last word at the same places.
    mentions: mention, line, pos; readings: key, line, pos, start, stop."""
    met = mentions.join(readings.select(*key, line, "pos", "start", "stop"), [*key, line, "pos"])
    return met.groupBy(*key, "mention", line).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def weaker(a: Column, b: Column) -> Column:
    """The weaker of two certainties, the one that is there if the other isn't."""
    ranks = F.array(*map(F.lit, CERTS))
    rank = lambda c: F.when(c.isNull(), F.lit(len(CERTS) + 1)).otherwise(F.array_position(ranks, c))
    return F.when(rank(a) <= rank(b), a).otherwise(b)


def dated(mentions: DataFrame, kind: str, text: str, cert: str, dates: tuple[str, ...] = ("date",)) -> DataFrame:
    """when, and the weaker of the model's and the reader's certainty, for dates."""
    is_date, read = F.col(kind).isin(*dates), text_date(F.col(text))
    return mentions.withColumn("when", F.when(is_date, read["when"])).withColumn(cert, F.when(is_date, weaker(F.col(cert), read["cert"])).otherwise(F.col(cert)))


def resolved(mentions: DataFrame, catalogue: DataFrame, floor: float = 0.55, threshold: float = 0.78) -> DataFrame:
    """Entities of mentions that passed the filters: grouped by type and plain name, names
    mended, similar ones merged, lone unsure ones dropped, persons linked.
    mentions: ord, type, text, plain, confidence; catalogue as for `entities.linked`."""
    groups = entities.grouped(mentions, ["type", "plain"], "text", "confidence", ["ord"])
    first = mentions.groupBy("type", "plain").agg(F.min("ord").alias("ord"))
    named = groups.join(first, ["type", "plain"]).withColumn("canonical", entities.unrepeated(F.col("canonical"))).withColumn("entity_id", entities.entity_id(F.col("type"), F.col("plain")))
    merged = entities.fuzzy_merged(named, ["type"], "canonical", "ord", "mentions", threshold)
    one = merged.groupBy("type", "representative").agg(F.sum("mentions").alias("mentions"), F.max("confidence").alias("confidence"), F.min_by("entity_id", F.struct(-F.col("mentions"), "ord")).alias("entity_id"))
    kept = entities.pruned(one, floor)
    linked = entities.linked(kept.filter("type = 'person'").withColumnRenamed("representative", "name"), catalogue, "name")
    others = kept.filter("type <> 'person'").withColumnRenamed("representative", "name").withColumn("person_id", F.lit(None).cast(dict(linked.dtypes)["person_id"]))
    return linked.unionByName(others)


def pipeline(left: DataFrame, right: DataFrame, words: DataFrame, key: list[str]) -> DataFrame:
    """The mentions that two models' spans make: merged by words, filtered by tags, then
    without overlaps.  Tags come first, as they may drop the surer reading.
    left, right: as for `spans.merged_models`; words: key, pos (text of the position), start,
    stop, tag, lemma.  A mention none of whose words is there is none."""
    merged = spans.merged_models(left, right, key).withColumnRenamed("ord", "mention")
    each = merged.select(*key, "mention", F.explode("words").alias("pos")).join(words, [*key, "pos"])
    tags = each.groupBy(*key, "mention").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("start", "tag"))), lambda s: s["tag"]).alias("tags"),
        F.transform(F.array_sort(F.collect_list(F.struct("start", "lemma"))), lambda s: s["lemma"]).alias("lemmas"),
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
    )
    judged = merged.join(tags, [*key, "mention"]).withColumn("reason", spans.pos_reason(F.col("tags"), F.col("lemmas"), F.col("type") == "person"))
    return spans.without_overlaps(judged.filter("reason is null").drop("reason", "tags", "lemmas"), key, ["mention"])


def summary(entities_: DataFrame, kind: str) -> DataFrame:
    """Entities by type, the most frequent type first."""
    return entities_.groupBy(kind).agg(F.count("*").alias("entities")).orderBy(F.desc("entities"), kind)
