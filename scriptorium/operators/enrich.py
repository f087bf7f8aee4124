"""Token annotation around a service: pieces of text by language, requests, answers, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .offsets import joined

#: Own list: abbreviations that are nothing to tag when they stand alone.
LONE = "Cap.", "Cf.", "Col.", "Fig.", "Fol.", "Ibid.", "Lib.", "Mr.", "Pag.", "Tom.", "Vol."
#: Signs that hang on the word before or after them.
JOIN_LEFT, JOIN_RIGHT = (",", ".", ")", "]", "…"), ("(", "[", "«")
LEAST, MISALIGNED = 5, 0.2


def pieces(lines: DataFrame, foreign: DataFrame, key: list[str], order: str, text: str) -> DataFrame:
    """The lines of each container cut at the ends of its foreign segments (from, to in
    the text joined by blanks, without overlaps).  start, stop in that text, lang null
    for the container's own."""
    segments = foreign.groupBy(*key).agg(F.collect_list(F.struct("from", "to", "lang")).alias("_segments"))
    placed = joined(lines, key, order, text).join(segments, key, "left").withColumn("_segments", F.coalesce("_segments", F.expr("array()")))
    ends = F.flatten(F.transform("_segments", lambda s: F.array(s["from"], s["to"])))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array("start", "stop"), F.filter(ends, lambda x: (x > F.col("start")) & (x < F.col("stop"))))))
    each = placed.withColumn("_cuts", cuts).select(*key, order, text, "_segments", F.col("start").alias("_line"), "_cuts", F.posexplode(F.slice("_cuts", 1, F.greatest(F.lit(1), F.size("_cuts") - 1))).alias("piece", "start"))
    stop = F.coalesce(F.get("_cuts", F.col("piece") + 1), F.col("start"))
    each = each.withColumn("stop", stop)
    covering = F.filter("_segments", lambda s: (s["from"] <= F.col("start")) & (s["to"] >= F.col("stop")) & (F.col("stop") > F.col("start")))
    return each.select(*key, order, "piece", "start", "stop", F.get(covering, F.lit(0))["lang"].alias("lang"), F.substring(text, F.col("start") - F.col("_line") + 1, F.col("stop") - F.col("start")).alias("text"))


def eligible(containers: DataFrame, tag: str, lang: str, text: str, tags: list[str], models: list[str]) -> DataFrame:
    """Containers that are tagged: of these elements, in a language with a model, not too short."""
    return containers.filter(F.col(tag).isin(tags) & F.col(lang).isin(models) & (F.length(F.trim(text)) >= LEAST))


def requests(blocks: DataFrame, primary: str, lang: str, start: str, text: str, models: list[str], lone: tuple[str, ...] = LONE) -> DataFrame:
    """What is sent of each language block: its text without blanks around it, where that
    begins, and the model and language, the primary ones if the block's has no model.
    Blank blocks and lone abbreviations aren't sent."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    ahead = F.length(text) - F.length(F.regexp_replace(text, r"^\s+", ""))
    known = F.when(F.col(lang).isin(models), F.col(lang)).otherwise(F.col(primary))
    out = blocks.withColumn("request", bare).withColumn("base", (F.col(start) + ahead).cast("int")).withColumn("model", known)
    return out.filter((F.col("request") != "") & ~F.col("request").isin(*lone))


def answered(annotation: Column) -> Column:
    """Tokens of a service's JSON: the tag under either spelling of its key, the treated
    form or the form, and whether the token is one sign."""
    part = lambda t, k: F.try_element_at(t, F.lit(k))
    return F.transform(
        F.from_json(annotation, "array<map<string, string>>"),
        lambda t: F.struct(
            F.coalesce(part(t, "form"), F.lit("")).alias("form"),
            F.coalesce(part(t, "lemma"), F.lit("")).alias("lemma"),
            F.coalesce(F.nullif(part(t, "POS"), F.lit("")), part(t, "pos"), F.lit("")).alias("pos"),
            F.coalesce(part(t, "morph"), F.lit("")).alias("morph"),
            F.coalesce(part(t, "treated"), part(t, "form"), F.lit("")).alias("treated"),
            F.coalesce((F.length(part(t, "form")) == 1) & ~part(t, "form").rlike(r"[\p{L}\p{N}]"), F.lit(False)).alias("is_sign"),
        ),
    )


def sign_join(form: Column) -> Column:
    return F.when(form.isin(*JOIN_LEFT), "left").when(form.isin(*JOIN_RIGHT), "right")


def outcomes(blocks: DataFrame, key: list[str], status: str, tokens: str, misaligned: str, limit: float = MISALIGNED) -> DataFrame:
    """One row a container: tokens kept, whether a block was refused or not sent, and the
    state.  A block of which more than limit could not be anchored leaves its whole
    container unenriched, and that alone is counted."""
    ok = F.col(status) == "ok"
    off = F.bool_or(ok & (F.col(tokens) > 0) & (F.col(misaligned) / F.col(tokens) > limit))
    seen = lambda s: F.coalesce(F.bool_or(F.col(status) == s), F.lit(False))
    folded = blocks.groupBy(*key).agg(
        F.coalesce(off, F.lit(False)).alias("unanchored"), seen("refused").alias("refused"), seen("unsent").alias("unsent"), F.coalesce(F.sum(F.when(ok, F.col(tokens))), F.lit(0)).cast("long").alias("tokens")
    )
    plain = ~F.col("unanchored")
    out = folded.withColumn("refused", plain & F.col("refused")).withColumn("unsent", plain & F.col("unsent")).withColumn("tokens", F.when(plain, F.col("tokens")).otherwise(F.lit(0).cast("long")))
    lost = F.col("unanchored") | F.col("refused") | F.col("unsent")
    return out.withColumn("state", F.when(F.col("tokens") > 0, "enriched").when(lost, "failed").otherwise("skipped"))


def statistics(outcomes_: DataFrame, sentences: str | None = None, broken: Column | None = None, reachable: bool = True) -> DataFrame:
    """The eleven figures of a document's enrichment; every count but tokens and
    sentences is one of containers."""
    count = lambda c: F.count(F.when(c, 1))
    gone = F.lit(False) if broken is None else broken
    return outcomes_.agg(
        F.count("*").alias("containers_found"),
        count(F.col("state") == "enriched").alias("containers_enriched"),
        count(F.col("state") == "skipped").alias("containers_skipped"),
        count(F.col("unanchored") | F.col("refused") | F.col("unsent") | gone).alias("containers_failed"),
        count(gone).alias("containers_broken"),
        count(F.col("refused")).alias("containers_refused"),
        count(F.col("unanchored")).alias("containers_unanchored"),
        count(F.col("unsent")).alias("containers_unsent"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens_total"),
        (F.coalesce(F.sum(sentences), F.lit(0)) if sentences else F.lit(0)).cast("long").alias("sentences_total"),
        F.lit(not reachable).alias("server_unavailable"),
    )


def word_parts(words: DataFrame, lines: DataFrame, key: list[str], word: str, line: str) -> DataFrame:
    """Words over several lines in parts: a row for each line that a word (start, stop)
    overlaps, part I, M or F, null for a whole word."""
    own = lines.select(*key, line, F.col("start").alias("_a"), F.col("stop").alias("_b"))
    met = words.join(own, key).filter((F.col("start") < F.col("_b")) & (F.col("stop") > F.col("_a")))
    w = Window.partitionBy(*key, word)
    k, n = F.row_number().over(w.orderBy("_a")) - 1, F.count("*").over(w)
    part = F.when(n == 1, F.lit(None)).when(k == 0, "I").when(k == n - 1, "F").otherwise("M")
    return met.select(*key, word, line, k.alias("fragment"), part.alias("part"), F.greatest("start", "_a").alias("a"), F.least("stop", "_b").alias("b"))
