"""Catalogues, image maps and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import blank_as_null


def csv(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    """All cells as text, trimmed, blank and nan as null; zeros in front stay.
    file_ord is the place in the file."""
    rows = spark.read.option("header", "true").option("sep", separator).option("multiLine", "true").option("inferSchema", "false").csv(path)
    named = rows.toDF(*[c if c else f"_c{k}" for k, c in enumerate(rows.columns)])
    return named.select(*[blank_as_null(F.col(f"`{c}`")).alias(c) for c in named.columns], F.monotonically_increasing_id().alias("file_ord"))


def persons(spark: SparkSession, path: str, key: str = "BDD") -> DataFrame:
    """The last row of a key wins; a file without the key is refused."""
    rows = csv(spark, path)
    if key not in rows.columns:
        raise ValueError(f"{path} has no column {key}")
    rest = [c for c in rows.columns if c != key]
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), "file_ord").alias("_r")).select(key, "_r.*")


def image_map(spark: SparkSession, path: str) -> DataFrame:
    """url, file and place of a map without a header: first and third column."""
    rows = spark.read.option("header", "false").option("inferSchema", "false").csv(path)
    if len(rows.columns) < 3:
        raise ValueError(f"{path} has fewer than three columns")
    return rows.select(F.trim("_c0").alias("url"), F.trim("_c2").alias("file"), F.monotonically_increasing_id().alias("file_ord"))


def map_fit(image_map_: DataFrame, pages: DataFrame, page: str, sample: int = 100) -> DataFrame:
    """Share of the map's first rows whose file is a page; over 0.3 is accepted."""
    head = image_map_.select(F.regexp_replace("file", r"\.xml$", "").alias("_f"), "file_ord").orderBy("file_ord").limit(sample)
    known = pages.select(F.regexp_replace(page, r"\.xml$", "").alias("_f")).distinct().withColumn("_hit", F.lit(1))
    return head.join(known, "_f", "left").agg(F.coalesce(F.avg(F.coalesce("_hit", F.lit(0))), F.lit(0.0)).alias("rate")).withColumn("accepted", F.col("rate") > 0.3)


INCIDENT = "code string, document string, step string, locator string, kind string, count string, total string, detail string"


def incidents(spark: SparkSession, path: str) -> DataFrame:
    """A run's JSON lines; a bad one becomes an `unreadable` row, good ones are
    numbered I1, I2, ... in order."""
    return read_incidents(spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), "value"))


def read_incidents(lines: DataFrame) -> DataFrame:
    """lines: ord, value."""
    parsed = lines.filter(F.trim("value") != "").select("ord", "value", F.from_json("value", INCIDENT + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    good = parsed["r"].isNotNull() & parsed["r._bad"].isNull()
    # the lines of one run, which one process wrote, are numbered together
    number = F.sum(good.cast("int")).over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fields = [f.split()[0] for f in INCIDENT.split(", ")]
    return parsed.select(
        "ord",
        F.when(good, F.concat(F.lit("I"), number.cast("string"))).alias("incident"),
        F.when(good, F.col("r.code")).otherwise("unreadable").alias("code"),
        *[F.when(good, F.col(f"r.{f}")).alias(f) for f in fields[1:-1]],
        F.when(good, F.col("r.detail")).otherwise(F.col("value")).alias("detail"),
    )
