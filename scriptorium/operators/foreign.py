"""Languages inside a container: runs of words, foreign segments, and the two passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .language import decision
from .order import islands

SEGMENT_WORDS, PRIOR = 3, 0.35
SIZE = 3


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def trigrams(word: Column) -> Column:
    """Of a word with a blank on either side; words are short, whole texts would take the
    square of their length."""
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(padded, i, F.lit(SIZE)))


def profiles(labelled: DataFrame, text: str, lang: str, most: int = 400) -> DataFrame:
    """lang, gram, weight: the most frequent trigrams of each language with the square
    root of their share, so that a sum of products compares two distributions.  Different
    words are counted first, and taken apart once each."""
    words = labelled.select(F.col(lang).alias("lang"), F.explode(words_of(F.col(text))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    counted = words.select("lang", "n", F.explode(trigrams(F.col("word"))).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang")
    ranked = counted.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), "gram")))
    return ranked.filter(F.col("rank") <= most).select("lang", "gram", F.sqrt("share").alias("weight"))


def detected(rows: DataFrame, key: list[str], text: str, profiles_: DataFrame, distance: float = 0.25) -> DataFrame:
    """lang and confidence of each row: the profile that its trigrams agree with most,
    and that one's part of all agreement; no lang where the second is nearer than
    distance.  The profiles, a few hundred rows a language, are broadcast."""
    words = rows.select(*key, F.explode(words_of(F.col(text))).alias("word")).groupBy(*key, "word").agg(F.count("*").alias("n"))
    own = words.select(*key, "n", F.explode(trigrams(F.col("word"))).alias("gram")).groupBy(*key, "gram").agg(F.sum("n").alias("n"))
    agreed = own.join(F.broadcast(profiles_), "gram").groupBy(*key, "lang").agg(F.sum(F.sqrt("n") * F.col("weight")).alias("agreement"))
    ranked = agreed.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct((-F.col("agreement")).alias("a"), "lang"))).alias("_r"), F.sum("agreement").alias("_all"))
    best, second = -F.get("_r", F.lit(0))["a"], F.coalesce(-F.get("_r", F.lit(1))["a"], F.lit(0.0))
    sure = (best - second) / best >= distance
    found = ranked.select(*key, F.when(sure, F.get("_r", F.lit(0))["lang"]).alias("lang"), F.round(best / F.col("_all"), 6).alias("confidence"))
    return rows.select(*key).join(found, key, "left")


def prior(containers: DataFrame, document: str, lang: str, words: str, floor: float = PRIOR) -> DataFrame:
    """The language with most words of a document, if that is floor of all of them."""
    volumes = containers.filter(F.col(lang).isNotNull()).groupBy(document, lang).agg(F.sum(words).alias("n"))
    best = volumes.groupBy(document).agg(F.max_by(lang, F.struct("n", lang)).alias("prior"), F.max("n").alias("n"))
    total = containers.groupBy(document).agg(F.sum(words).alias("total"))
    return total.join(best, document, "left").select(document, F.when(F.col("n") / F.col("total") >= floor, F.col("prior")).alias("prior"))


def two_pass(containers: DataFrame, document: str, default: str) -> DataFrame:
    """containers: document, detected, confidence, words, heuristic (struct lang, score).
    First a prior for each document, then the decision for each container."""
    known = containers.join(prior(containers, document, "detected", "words"), document, "left")
    own = F.when(F.col("detected") == F.col("heuristic.lang"), F.col("heuristic.score")).otherwise(0)
    return known.withColumn("decided", decision(F.col("detected"), F.col("confidence"), F.col("prior"), F.lit(default), F.col("heuristic.lang"), F.col("heuristic.score"), own))


def runs(words: DataFrame, key: list[str], order: str, lang: str) -> DataFrame:
    """Runs of neighbouring words (start, stop) of one language, words without one
    belonging to the run before."""
    w = Window.partitionBy(*key).orderBy(order)
    filled = words.withColumn("_lang", F.last(lang, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    each = islands(filled, key, [order], ["_lang"])
    return each.groupBy(*key, "island").agg(F.first("_lang").alias("lang"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("words"))


def accepted(segments: DataFrame, primary: str, lang: str, words: str, rule_lang: str, rule_score: str, own_score: str, least: int = SEGMENT_WORDS) -> DataFrame:
    """Segments that are foreign: of another language than the primary one, long enough,
    with a sign of their language, and not of the primary one by the rules."""
    is_primary = F.coalesce((F.col(rule_lang) == F.col(primary)) & (F.col(rule_score) >= 2), F.lit(False))
    return segments.filter(F.col(lang).isNotNull() & (F.col(lang) != F.col(primary)) & (F.col(words) >= least) & ~is_primary & (F.col(own_score) > 0))


def mapped(segments: DataFrame, origin: str, start: str = "start", stop: str = "stop") -> DataFrame:
    """Offsets in a cleaned text as offsets in the input, by the cleaned letters' places."""
    n = F.size(origin)
    a = F.greatest(F.lit(0), F.least(F.col(start), n))
    b = F.greatest(a, F.least(F.col(stop), n))
    placed = segments.withColumn("_a", a).withColumn("_b", b).filter((F.col("_a") < n) & (F.col("_b") > F.col("_a")))
    return placed.withColumn(start, F.get(origin, F.col("_a"))).withColumn(stop, F.get(origin, F.col("_b") - 1) + 1).drop("_a", "_b")


def counts(containers: DataFrame, segments: DataFrame, lang: str) -> DataFrame:
    """How often each language is a container's or a segment's, the most frequent first."""
    both = containers.select(F.col(lang).alias("lang")).unionByName(segments.select(F.col(lang).alias("lang")))
    return both.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
