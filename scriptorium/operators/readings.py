"""Modernized readings of lines: what is sent, how answers come back and are graded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.text import band, drop_carried_word, outgrown, sendable

BANDS = [(0.95, "high"), (0.8, "medium")]


def sent(lines: DataFrame, text: str) -> DataFrame:
    """Lines worth sending; the others stay as they are."""
    return lines.filter(sendable(F.col(text)))


def with_readings(lines: DataFrame, readings: DataFrame, key: list[str]) -> DataFrame:
    return lines.join(readings, key, "left")


def by_position(lines: DataFrame, readings: DataFrame, group: list[str], order: str, reading_order: str) -> DataFrame:
    """One for one in order, as far as the shorter side goes."""
    number = lambda o: F.row_number().over(Window.partitionBy(*group).orderBy(o))
    return lines.withColumn("_k", number(order)).join(readings.withColumn("_k", number(reading_order)), [*group, "_k"]).drop("_k")


def graded(lines: DataFrame, sent_text: str, reading: str, carried: str) -> DataFrame:
    """text, cert and status: unchanged against what was sent, diverged where it has
    outgrown the line or is below the last band, else graded by similarity; the word
    that a line carried over is dropped."""
    before, after = F.col(sent_text), F.col(reading)
    known = F.when(after.isNull(), "missing").when(after == before, "unchanged").when(outgrown(before, after), "diverged")
    first = lines.withColumn("status", known)
    open_ = F.col("status").isNull()  # only these need the matcher
    scored = first.withColumn("similarity", kernels.ratio(F.when(open_, before), F.when(open_, after)))
    near = F.when(F.col("similarity") < BANDS[-1][0], "diverged").otherwise("graded")
    scored = scored.withColumn("status", F.coalesce("status", near))
    is_graded = F.col("status") == "graded"
    shown = F.when(F.col(carried), drop_carried_word(after)).otherwise(after)
    return scored.withColumn("text", F.when(is_graded, shown)).withColumn("cert", F.when(is_graded, band(F.col("similarity"), BANDS)))
