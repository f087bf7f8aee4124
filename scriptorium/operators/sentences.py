"""Sentences: breaks, chains over containers, and fragments over lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Own list of abbreviations that end with a full stop inside a sentence.
ABBREVIATIONS = ("cf", "etc", "fol", "no", "op", "vol", "st", "mr", "dr")
TERMINAL = ".", "?", "!"


def is_sign(form: Column) -> Column:
    return ~form.rlike(r"[\p{L}\p{N}]")


def segmented(tokens: DataFrame, key: list[str], order: str = "tok_ord", form: str = "form") -> DataFrame:
    """sent_ord from 1: a sentence ends after . ? ! unless a single letter or an
    abbreviation stands before, or after a colon, if the next word is capitalized."""
    w = Window.partitionBy(*key).orderBy(order)
    f = F.col(form)
    before = F.lag(form).over(w)
    coming = F.first(F.when(~is_sign(f), f), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    short = before.rlike(r"^\p{L}$") | F.lower(before).isin(*ABBREVIATIONS)
    ends = (f.isin(*TERMINAL) & ~F.coalesce(short, F.lit(False)) | (f == ":")) & F.coalesce(coming.rlike(r"^\p{Lu}"), F.lit(False))
    marked = tokens.withColumn("_ends", ends.cast("int"))
    return marked.withColumn("sent_ord", F.coalesce(F.sum("_ends").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).drop("_ends")


def chained(containers: DataFrame, group: list[str], order: str) -> DataFrame:
    """containers: last_form, n_tokens.  continues: the last sentence goes on in the
    next container, both having tokens; continued: the first one came over."""
    w = Window.partitionBy(*group).orderBy(order)
    goes = (F.col("n_tokens") > 0) & ~F.col("last_form").isin(*TERMINAL) & F.coalesce(F.lead("n_tokens").over(w) > 0, F.lit(False))
    out = containers.withColumn("continues", F.coalesce(goes, F.lit(False)))
    return out.withColumn("continued", F.coalesce(F.lag("continues").over(w), F.lit(False)))


def fragments(tokens: DataFrame, key: list[str], order: str = "tok_ord") -> DataFrame:
    """tokens: sent_ord, line.  A row for each line of a sentence: part is I, M or F,
    null for a whole one, with the numbers before and after."""
    pieces = tokens.groupBy(*key, "sent_ord", "line").agg(F.min(order).alias("first_tok"), F.count("*").alias("n_tokens"))
    w = Window.partitionBy(*key, "sent_ord").orderBy("first_tok")
    k, n = F.row_number().over(w) - 1, F.count("*").over(Window.partitionBy(*key, "sent_ord"))
    part = F.when(n == 1, F.lit(None)).when(k == 0, "I").when(k == n - 1, "F").otherwise("M")
    return pieces.select("*", k.alias("fragment"), part.alias("part"), F.when(k > 0, k - 1).alias("prev"), F.when(k < n - 1, k + 1).alias("next"))
