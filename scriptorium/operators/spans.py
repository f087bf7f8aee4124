"""Spans over text: alignment, windows, dedup, filters and greedy resolution."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from ..functions import kernels

MERGED = StructType().add("type", StringType()).add("confidence", DoubleType()).add("model", StringType()).add("words", ArrayType(StringType()))


def word_offsets(rows: DataFrame, key: list[str], text: str) -> DataFrame:
    """key, pos from 0, word, start, stop (code points) of words between single blanks."""
    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    words = rows.select(*key, F.posexplode(F.split(F.col(text), " ")).alias("pos", "word"))
    start = F.coalesce(F.sum(F.length("word") + 1).over(w), F.lit(0))
    return words.withColumn("start", start).withColumn("stop", F.col("start") + F.length("word"))


def aligned(tokens: DataFrame, spans: DataFrame, key: list[str]) -> DataFrame:
    """The pieces of each token by the spans it overlaps: a range join in a container.
    tokens: pos, start, stop; spans: span, span_start, span_stop."""
    joined = tokens.join(spans, key).filter((F.col("start") < F.col("span_stop")) & (F.col("stop") > F.col("span_start")))
    piece = F.struct("span", F.greatest("start", "span_start").alias("a"), F.least("stop", "span_stop").alias("b"))
    return joined.groupBy(*key, "pos").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))


def word_windows(rows: DataFrame, key: list[str], words: Column, most: int = 240, overlap: int = 30) -> DataFrame:
    """Windows of `most` words, each `overlap` words into the one before; the last
    reaches the end.  first is inclusive, last exclusive."""
    step = max(1, most - overlap)
    counted = rows.select(*key, words.alias("n_words"))
    last = F.greatest(F.lit(0), F.ceil((F.col("n_words") - most) / step).cast("int") * step)
    out = counted.select(*key, "n_words", F.explode(F.sequence(F.lit(0), last, F.lit(step))).alias("first"))
    return out.withColumn("last", F.least(F.col("first") + most, F.col("n_words")))


def best_per_key(rows: DataFrame, key: list[str], score: str, order: list[str]) -> DataFrame:
    """The row of the highest score for each key, the first on a tie; partial
    aggregation keeps a hot key cheap."""
    rest = [c for c in rows.columns if c not in key]
    rank = F.struct(-F.col(score), *order)
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("_best")).select(*key, *[F.col(f"_best.{c}") for c in rest])


def span_reason(text: Column, confidence: Column, kind: Column, title: Column) -> Column:
    """Why a span is no entity, null if it may be one; the first rule that holds."""
    bare = F.lower(F.trim(text))
    return (
        F.when(F.length(F.trim(text)) < 2, "too_short")
        .when(text.rlike(r"[,;:!?]"), "punctuation")
        .when(F.length(bare) < 3, "too_short_plain")
        .when(text.rlike(r"\d"), "digits")
        .when((F.length(text) >= 7) & ~text.contains(" ") & (F.upper(text) == text) & (confidence < 0.7), "capitals")
        .when(bare == F.lower(title), "title")
        .when(F.array_contains(F.split(F.lower(title), " "), bare) & (kind != "date"), "title_word")
    )


def pos_reason(pos: Column, lemmas: Column, person: Column) -> Column:
    """Why aligned words are no entity, by their tags: arrays in word order."""
    names = F.filter(pos, lambda p: p.isin("NOMpro", "PROPN", "NP"))
    unknown = F.filter(pos, lambda p: p.isNull() | p.isin("X", "UNK"))
    known = F.filter(pos, lambda p: p.isNotNull() & ~p.isin("X", "UNK"))
    never = F.forall(known, lambda p: p.rlike("^(VER|ADV|PRE|PRO|CON|DET|VERB|ADP|PRON|CCONJ|SCONJ)"))
    return (
        F.when((F.size(lemmas) > 0) & F.forall(lemmas, lambda x: F.coalesce(x.startswith("@"), F.lit(False))), "markers")
        .when((F.size(known) > 0) & never, "not_a_noun")
        .when(person & (F.size(names) == 0) & (F.size(unknown) == 0), "no_name")
        .when((F.size(pos) == 1) & F.get(pos, F.lit(0)).rlike("^ADJ"), "adjective")
    )


def without_overlaps(spans: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The spans (start, stop, confidence) of each container that a greedy choice by
    confidence accepts; order breaks ties.  A row a container goes to the kernel."""
    rest = [c for c in spans.columns if c not in key and c not in order]
    gathered = spans.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias("_s"))
    kept = gathered.select(*key, F.transform(kernels.chosen("_s.start", "_s.stop", "_s.confidence"), lambda i: F.get("_s", i)).alias("_s"))
    return kept.select(*key, F.inline("_s")).select(*spans.columns)


def overlap_candidates(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Common and Jaccard of word sets of two models' mentions of a container.
    left: a, words; right: b, words."""
    joined = left.withColumnRenamed("words", "words_a").join(right.withColumnRenamed("words", "words_b"), key)
    common = F.size(F.array_intersect("words_a", "words_b"))
    return joined.select(*key, "a", "b", common.alias("common"), F.round(common / F.size(F.array_union("words_a", "words_b")), 6).alias("jaccard")).filter("common > 0")


@F.pandas_udf(ArrayType(MERGED))
def _agreed(left: pd.Series, right: pd.Series) -> pd.Series:
    def side(rows: object) -> list[dict]:
        return [{"type": r["type"], "confidence": r["confidence"], "model": r["model"], "words": frozenset(r["words"])} for r in ([] if rows is None else rows)]

    return pd.Series([[m | {"words": sorted(m["words"])} for m in kernels.agreed(side(a), side(b))] for a, b in zip(left, right, strict=True)])


def merged_models(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """key, ord, type, confidence, model, words: both models' mentions of a container
    made one list.  Each side has ord, type, confidence, model, words.  A row a
    container goes to the kernel, so many small ones share a batch."""

    def gathered(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("ord", "type", "confidence", "model", "words"))).alias(name))

    both = gathered(left, "_a").join(gathered(right, "_b"), key, "full")
    return both.select(*key, F.posexplode(_agreed("_a", "_b")).alias("ord", "_m")).select(*key, "ord", "_m.type", "_m.confidence", "_m.model", "_m.words")


def dehyphenated(lines: DataFrame, key: list[str]) -> DataFrame:
    """lines: line_ord, kind, text.  joined and carried for each line, by document."""
    rest = [c for c in lines.columns if c not in (*key, "line_ord")]
    gathered = lines.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("line_ord", *rest))).alias("_l"))
    both = gathered.select(*key, F.arrays_zip("_l", kernels.rejoin("_l.text", "_l.kind").alias("_j")).alias("_z"))
    return both.select(*key, F.explode("_z").alias("_z")).select(*[f"_z._l.{c}" if c not in key else c for c in lines.columns], "_z._j.joined", "_z._j.carried")


def span_words(spans: DataFrame, words: DataFrame, key: list[str]) -> DataFrame:
    """The words that each span (span_id, span_start, span_stop) overlaps, in order:
    positions, forms and the range that they make together."""
    met = spans.join(words, key).filter((F.col("start") < F.col("span_stop")) & (F.col("stop") > F.col("span_start")))
    return met.groupBy(*key, "span_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda s: s["pos"]).alias("positions"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda s: s["word"]).alias("forms"),
        F.min("start").alias("first"),
        F.max("stop").alias("last"),
    )


def through_readings(found: DataFrame, words: DataFrame, key: list[str]) -> DataFrame:
    """Words of a reading by their place for words of the original: positions that
    the original lacks fall away, and the range is taken anew."""
    each = found.select(*key, "span_id", F.explode("positions").alias("pos")).join(words, [*key, "pos"])
    return each.groupBy(*key, "span_id").agg(F.array_sort(F.collect_list("pos")).alias("positions"), F.min("start").alias("first"), F.max("stop").alias("last"))
