"""Margin notes and the lines they face: an interval join inside a surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CALLS = r"^\s*([*†‡])"


def facing(notes: DataFrame, lines: DataFrame, surface: list[str]) -> DataFrame:
    """Every line that a note overlaps: line top above the note's foot and line foot
    below its top.  notes: note_id, top, foot; lines: line_id, top, foot."""
    l = lines.select(*surface, "line_id", F.col("top").alias("line_top"), F.col("foot").alias("line_foot"), *([F.col("text").alias("line_text")] if "text" in lines.columns else []))  # noqa: E741
    return notes.join(l, surface).filter((F.col("line_top") < F.col("foot")) & (F.col("line_foot") > F.col("top")))


def note_links(notes: DataFrame, lines: DataFrame, surface: list[str]) -> DataFrame:
    """Adds anchor (the topmost facing line, or the topmost that has the note's call
    mark), targets in order, and n among notes of one anchor, null for a lone one."""
    found = facing(notes, lines, surface)
    order = [F.col("line_top"), F.col("line_id")]
    if "text" in notes.columns and "line_text" in found.columns:
        call = F.regexp_extract("text", CALLS, 1)
        order = [F.when((call != "") & F.contains("line_text", call), 0).otherwise(1), *order]
    anchored = found.groupBy(*surface, "note_id").agg(
        F.min_by("line_id", F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)])).alias("anchor"),
        F.transform(F.array_sort(F.collect_list(F.struct("line_top", "line_id"))), lambda s: s["line_id"]).alias("targets"),
    )
    linked = notes.join(anchored, [*surface, "note_id"], "left")
    same = Window.partitionBy(*surface, "anchor")
    number = F.row_number().over(same.orderBy("top", "note_id"))
    return linked.withColumn("n", F.when(F.col("anchor").isNotNull() & (F.count("*").over(same) > 1), number))


def first_text(zones: DataFrame, lines: DataFrame, key: list[str], own: str, top: str, text: str) -> DataFrame:
    """zones with nested, the text of their topmost line, and first_text: their own text,
    or else that."""
    nested = lines.groupBy(*key).agg(F.min_by(text, top).alias("nested"))
    return zones.join(nested, key, "left").withColumn("first_text", F.coalesce(own, "nested"))
