"""Reading order, occurrence numbers and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import page_number

Keys = list[str]


def page_order(pages: DataFrame, volume: Keys, stem: str, path: str, *ties: str) -> DataFrame:
    """num and page_ord: by the first number of the stem, then by path, then by `ties` where paths repeat."""
    numbered = pages.withColumn("num", page_number(F.col(stem)))
    return numbered.withColumn("page_ord", F.row_number().over(Window.partitionBy(*volume).orderBy("num", path, *ties)))


def page_collisions(pages: DataFrame, volume: Keys, stem: str) -> DataFrame:
    """Numbers that several pages of a volume have."""
    return pages.groupBy(*volume, page_number(F.col(stem)).alias("num")).agg(F.count("*").alias("pages")).filter("pages > 1")


def occurrence(rows: DataFrame, keys: Keys, order: Keys, name: str = "occurrence") -> DataFrame:
    """0 for the first row of a key, then 1, 2, ..."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def with_previous(rows: DataFrame, group: str, key: str, value: str, name: str, stretch: int = 1000) -> DataFrame:
    """Rows with the value (never null) of the row before in their group, by a whole-numbered
    key; the first of a group has none and is left out.  Rows are dealt by stretches of keys,
    and only the ends of stretches by group, so a large group doesn't fill one task."""
    near = Window.partitionBy(group, "_stretch").orderBy(key, value)
    dealt = rows.withColumn("_stretch", F.expr(f"`{key}` div {stretch}"))
    placed = dealt.withColumns({name: F.lag(value).over(near), "_after": F.lead(value).over(near)})
    ends = placed.filter(F.col(name).isNull() | F.col("_after").isNull())
    met = ends.withColumn("_met", F.lag(value).over(Window.partitionBy(group).orderBy(key, value)))
    heads = met.filter(F.col(name).isNull() & F.col("_met").isNotNull()).withColumn(name, F.col("_met")).drop("_met")
    return placed.filter(F.col(name).isNotNull()).unionByName(heads).drop("_stretch", "_after")


def next_same_kind(rows: DataFrame, group: Keys, kind: str, order: Keys, value: str, name: str = "next_same") -> DataFrame:
    return rows.withColumn(name, F.lead(value).over(Window.partitionBy(*group, kind).orderBy(*order)))


def lines_before(rows: DataFrame, group: Keys, order: Keys, is_line: Column, name: str = "after_lines") -> DataFrame:
    """How many lines come before each row."""
    frame = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.count(F.when(is_line, 1)).over(frame))


def islands(rows: DataFrame, group: Keys, order: Keys, same: Keys, name: str = "island") -> DataFrame:
    """Numbers the runs of neighbours that are equal in `same`, from 1."""
    w = Window.partitionBy(*group).orderBy(*order)
    first = F.row_number().over(w) == 1
    changes = F.lit(False)
    for c in same:
        changes = changes | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    starts = rows.withColumn("_starts", (first | changes).cast("int"))
    return starts.withColumn(name, F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_starts")


def split_lines(documents: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no from 1, line."""
    return documents.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def thinned(rows: DataFrame, group: Keys, odd: str, order: Keys, always: Column, most: int = 2) -> DataFrame:
    """Of each group the first few plain rows and the first few odd ones, and what is
    always kept, as for a small copy of a corpus."""
    place = F.row_number().over(Window.partitionBy(*group, odd).orderBy(*order))
    return rows.withColumn("_place", place).filter((F.col("_place") <= most) | always).drop("_place")


def prefix_sample(rows: DataFrame, group: Keys, order: Keys, size: str, most: int) -> DataFrame:
    """Rows until the sizes of those before exceed `most`."""
    frame = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum(size).over(frame), F.lit(0))).filter(F.col("_before") <= most).drop("_before")
