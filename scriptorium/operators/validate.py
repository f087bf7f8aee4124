"""Constraint queries over elements(doc, ord, parent_ord, tag, attrs, text) and the like."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTS = r"^-?\d+,-?\d+( -?\d+,-?\d+)*$"
NCNAME = r"^[\p{L}_][\p{L}\p{N}._-]*$"


def duplicate_ids(elements: DataFrame, key: list[str], id_: str) -> DataFrame:
    """Ids that occur more than once, and how many times too often."""
    return elements.filter(F.col(id_).isNotNull()).groupBy(*key, id_).agg((F.count("*") - 1).alias("repeats")).filter("repeats > 0")


def dangling(pointers: DataFrame, key: list[str], cell: str, ids: DataFrame, id_: str) -> DataFrame:
    """Local pointers '#a #b' to ids that don't exist."""
    each = pointers.select(*key, F.explode(F.split(F.trim(cell), r"\s+")).alias("pointer")).filter(F.col("pointer").startswith("#"))
    each = each.withColumn("target", F.expr("substring(pointer, 2)"))
    known = ids.select(*key, F.col(id_).alias("target")).distinct()
    return each.join(known, [*key, "target"], "left_anti").select(*key, "target")


def bad_points(zones: DataFrame, points: str) -> DataFrame:
    """problem: not pairs of whole numbers, or more than two pairs that all begin with 0."""
    value = F.col(points)
    pairs = F.split(value, " ")
    flat = (F.size(pairs) > 2) & F.forall(pairs, lambda p: F.substring_index(p, ",", 1) == "0")
    return zones.withColumn("problem", F.when(~value.rlike(POINTS), "malformed").when(flat, "all_zero")).filter(F.col("problem").isNotNull())


def without_figure(zones: DataFrame, figures: DataFrame, key: list[str]) -> DataFrame:
    return zones.join(figures, key, "left_anti")


def bad_ids(elements: DataFrame, id_: str) -> DataFrame:
    return elements.filter(~F.col(id_).rlike(NCNAME))


def misplaced(elements: DataFrame, allowed: DataFrame) -> DataFrame:
    """Elements whose parent isn't allowed: allowed has parent, tag."""
    parents = elements.select("doc", F.col("ord").alias("parent_ord"), F.col("tag").alias("parent"))
    placed = elements.join(parents, ["doc", "parent_ord"])
    return placed.join(F.broadcast(allowed), ["parent", "tag"], "left_anti")


def violations(rules: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """rule, severity, count over queries that each return offending rows."""
    rows = [df.agg(F.count("*").alias("count")).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "count") for rule, severity, df in rules]
    return reduce(DataFrame.unionByName, rows).filter("count > 0")


def closed_values(column: Column, values: list[str]) -> Column:
    return ~column.isin(*values)
