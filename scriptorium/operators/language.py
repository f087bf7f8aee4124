"""Language by rules, decisions over several signals, and shares of usage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import word_count


@dataclass(frozen=True)
class Rules:
    """letters count 3 each, words 1 each that occurs, endings 1.5 each."""

    lang: str
    letters: str
    words: tuple[str, ...]
    endings: tuple[str, ...]  # none of which can begin inside another


#: Own rules, in the order that breaks ties.
RULES = (
    Rules("fr", "éèêçàù", ("le", "la", "les", "des", "du", "dans", "que", "est", "une", "et"), ("eux", "eau", "ment", "ier")),
    Rules("de", "äöüß", ("der", "die", "das", "und", "ist", "nicht", "mit", "ein", "zu", "auf"), ("ung", "lich", "sch", "keit")),
    Rules("es", "ñóíá", ("el", "los", "las", "por", "con", "una", "del", "no", "se", "su"), ("ción", "ado", "mente", "ar")),
    Rules("en", "w", ("the", "and", "of", "to", "is", "that", "for", "was", "with", "are"), ("tion", "ing", "ed", "ly")),
)
LEAST = 2.0


def times(text: Column, part: str) -> Column:
    """How often part stands in the text, by what its removal shortens; a scan of
    bytes, where counting by a pattern builds an array of all matches."""
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def rule_score(text: Column, rules: Rules) -> Column:
    """A language's points; w is too common for three points, so one letter alone counts a tenth."""
    low = F.lower(text)
    weight = 3.0 if len(rules.letters) > 1 else 0.1
    words = F.size(F.array_intersect(F.split(low, r"[^\p{L}]+"), F.array(*map(F.lit, rules.words))))
    return (F.length(low) - F.length(F.translate(low, rules.letters, ""))) * weight + words + sum((times(low, e) for e in rules.endings), F.lit(0.0)) * 1.5


def heuristic(text: Column, rules: tuple[Rules, ...] = RULES) -> Column:
    """struct(lang, score): the best language, null below LEAST points."""
    scored = F.array(*(F.struct(rule_score(text, r).alias("score"), F.lit(-k).alias("rank"), F.lit(r.lang).alias("lang")) for k, r in enumerate(rules)))
    best = F.array_max(scored)
    return F.struct(F.when(best["score"] >= LEAST, best["lang"]).alias("lang"), F.round(best["score"], 1).alias("score"))


def decision(detected: Column, confidence: Column, prior: Column, default: Column, heuristic_lang: Column, heuristic_score: Column, detected_score: Column) -> Column:
    """The language of a container from a detector, the document's prior and the
    rules: agreement first, then the rules against a lone detector, then a sure one."""
    p = F.coalesce(prior, default)
    enough = F.when(prior.isNotNull(), 1).otherwise(2)
    return (
        F.when(detected.isNull(), default)
        .when((detected == p) & (p == default), detected)
        .when(detected == p, F.when((heuristic_lang == default) & (heuristic_score >= 2), default).otherwise(detected))
        .when((heuristic_lang == p) & (heuristic_score >= enough), p)
        .when(prior.isNotNull() & (detected_score < 1) & (confidence < 0.9), p)
        .when(heuristic_lang.isNotNull() & (heuristic_score >= enough), heuristic_lang)
        .when(confidence >= 0.35, detected)
        .otherwise(p)
    )


def language_volume(containers: DataFrame, foreign: DataFrame, key: list[str]) -> DataFrame:
    """Words by language: a container's words less those of its foreign spans, which
    count for their own.  containers: key, cont, lang, words; foreign: key, cont, lang, words."""
    inside = foreign.groupBy(*key, "cont").agg(F.sum("words").alias("_foreign"))
    own = containers.join(inside, [*key, "cont"], "left").select(*key, "lang", F.greatest(F.lit(0), F.col("words") - F.coalesce("_foreign", F.lit(0))).alias("words"))
    return own.unionByName(foreign.select(*key, "lang", "words")).groupBy(*key, "lang").agg(F.sum("words").alias("words")).filter("words > 0")


def usage(volumes: DataFrame, key: list[str]) -> DataFrame:
    """share: percent of a key's words, halves to even, 1 at least for a language that occurs."""
    share = F.bround(100.0 * F.col("words") / F.sum("words").over(Window.partitionBy(*key))).cast("int")
    return volumes.withColumn("share", F.greatest(F.lit(1), share))


def line_volumes(lines: DataFrame, key: list[str], text: str) -> DataFrame:
    """Words by the rules' language of each line; lines without one are und."""
    found = lines.select(*key, F.coalesce(heuristic(F.col(text))["lang"], F.lit("und")).alias("lang"), word_count(F.col(text)).cast("long").alias("words"))
    return found.groupBy(*key, "lang").agg(F.sum("words").alias("words")).filter("words > 0")
