"""What a run would meet: checks of volumes, catalogue and images before it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import NO_NUMBER, page_number
from ..sources.catalogues import map_fit

FLOOR, LARGEST = 0.3, 10 << 20


def verdict(volumes: int, writable: bool, unusable: int, attention: int) -> int:
    """3: nothing could be done; 1: something deserves a look; 0: neither."""
    if unusable or not volumes or not writable:
        return 3
    return 1 if attention else 0


def _noted(rows: DataFrame, subject: str, what: str, count: str | None = None) -> DataFrame:
    return rows.select(F.col(subject).cast("string").alias("subject"), F.lit(what).alias("what"), (F.col(count) if count else F.lit(1)).cast("long").alias("n"))


def attention(volumes: DataFrame, pages: DataFrame, catalogue: DataFrame, volume: str, stem: str, catalogue_key: str) -> DataFrame:
    """subject, what, n: volumes without a page or a row of the catalogue, pages without a
    number, numbers that several pages claim."""
    numbered = pages.withColumn("_num", page_number(F.col(stem)))
    unnumbered = numbered.filter(F.col("_num") == NO_NUMBER).groupBy(volume).agg(F.count("*").alias("n"))
    shared = numbered.filter(F.col("_num") != NO_NUMBER).groupBy(volume, "_num").agg(F.count("*").alias("n")).filter("n > 1").groupBy(volume).agg(F.count("*").alias("n"))
    empty = volumes.join(pages.select(volume).distinct(), volume, "left_anti")
    unmatched = volumes.join(catalogue.select(F.col(catalogue_key).alias(volume)).distinct(), volume, "left_anti")
    found = [_noted(unmatched, volume, "no catalogue row"), _noted(unnumbered, volume, "pages without a number", "n"), _noted(shared, volume, "numbers claimed twice", "n"), _noted(empty, volume, "no pages")]
    return reduce(DataFrame.unionByName, found)


def refused_map(candidates: list[tuple[str, int, DataFrame | None]], pages: DataFrame, page: str) -> str | None:
    """Why none of a volume's image maps (name, bytes, rows or None where they aren't
    three columns) would be taken; None if one would be, or if there is none."""
    rates, large = [], []
    for name, size, rows in candidates:
        if size > LARGEST:
            large.append(name)
        elif rows is not None:
            fit = map_fit(rows, pages, page).first()
            if fit["accepted"]:
                return None
            rates.append(fit["rate"])
    if not candidates:
        return None
    if rates:
        return f"the best map matches {max(rates):.0%} of the file names, which must be over {FLOOR:.0%}"
    return f"{large[0]} is larger than {LARGEST >> 20} MB" if large else "no map has three columns"


def chosen_map(candidates: list[tuple[str, int, DataFrame | None]], pages: DataFrame, page: str) -> str | None:
    """The first map that fits: those named after the image protocol first, then by name."""
    for name, size, rows in sorted(candidates, key=lambda c: ("iiif" not in c[0].lower(), c[0])):
        if size <= LARGEST and rows is not None and map_fit(rows, pages, page).first()["accepted"]:
            return name
    return None


def distinct_surfaces(pages: DataFrame, volume: str, page_id: str) -> DataFrame:
    """pages, or an error where two of a volume have one id."""
    clashes = pages.groupBy(volume, page_id).agg(F.count("*").alias("_n")).filter("_n > 1")
    bad = clashes.limit(5).collect()  # the first few, for the message
    if bad:
        raise ValueError("pages with one id: " + ", ".join(f"{r[volume]}/{r[page_id]}" for r in bad))
    return pages
