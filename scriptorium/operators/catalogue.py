"""Catalogue lookups: prefix joins, lists of persons, image maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefix_match(prefixes: DataFrame, prefix: str, rows: DataFrame, name: str, order: str) -> DataFrame:
    """Each prefix with the row whose name begins with it: an equal one first, then in
    file order; matches counts them, 0 without one.  An equi-join for each length of
    prefix, instead of a comparison of all with all."""
    lengths = prefixes.select(F.length(prefix).alias("_length")).distinct()
    heads = rows.join(F.broadcast(lengths), F.length(name) >= F.col("_length")).withColumn("_head", F.expr(f"substring({name}, 1, _length)"))
    found = prefixes.join(heads, (F.col(prefix) == F.col("_head")) & (F.length(prefix) == F.col("_length")), "left")
    keys = prefixes.columns
    rest = [c for c in rows.columns]
    rank = F.struct((F.col(name) != F.col(prefix)).alias("other"), F.col(order).alias("ord"))
    return found.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"), F.count(name).alias("matches")).select(*keys, "matches", *[F.col(f"_row.{c}") for c in rest])


def listed(rows: DataFrame, key: str, cell: str, persons: DataFrame, code: str, name: str, separator: str = r"\|") -> DataFrame:
    """The persons of a cell 'a|b' in order, their names where known, else the code."""
    parts = rows.select(key, F.posexplode(F.split(F.col(cell), separator)).alias("pos", "_code")).withColumn("_code", F.trim("_code")).filter("_code <> ''")
    named = parts.join(persons.select(F.col(code).alias("_code"), F.col(name).alias("_name")), "_code", "left")
    return named.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("_name", "_code").alias("name")))), lambda s: s["name"]).alias("names"))


def roles(cell: Column, names: dict[str, str], separator: str = r"\|") -> Column:
    """Codes of a cell by their names, others in small letters."""
    table = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.transform(F.filter(F.split(cell, separator), lambda c: F.trim(c) != ""), lambda c: F.coalesce(F.try_element_at(table, F.trim(c)), F.lower(F.trim(c))))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_last")).select(key, *[F.col(f"_last.{c}") for c in rest])


def manifest_of(manifests: Column, index: Column) -> Column:
    """The only manifest always; of several the volume's, none if that isn't known."""
    return F.when(F.size(manifests) == 1, F.get(manifests, F.lit(0))).when(index.isNotNull() & (index >= 0), F.get(manifests, index))


def image_of(pages: DataFrame, page: str, images: DataFrame, file: str, url: str) -> DataFrame:
    """The image of a page by its id, or by it without .xml."""
    by_file = images.select(F.regexp_replace(file, r"\.xml$", "").alias("_file"), F.col(url).alias("image"))
    return pages.withColumn("_file", F.regexp_replace(page, r"\.xml$", "")).join(by_file, "_file", "left").drop("_file")


def without_row(volumes: DataFrame, key: str, catalogue: DataFrame, catalogue_key: str) -> DataFrame:
    return volumes.join(catalogue, volumes[key] == catalogue[catalogue_key], "left_anti")


def selected(volumes: DataFrame, name: str, include: list[str], exclude: list[str], done: DataFrame | None = None, limit: int | None = None, order: str | None = None) -> DataFrame:
    """Volumes by globs on their name, less the excluded and those done, in order."""

    def like(globs: list[str]) -> Column:
        out = F.lit(False)
        for g in globs:
            pattern = "".join(".*" if c == "*" else "." if c == "?" else f"\\{c}" if not c.isalnum() and c not in " _" else c for c in g)
            out = out | F.col(name).rlike(f"^{pattern}$")
        return out

    out = volumes.filter(like(include)) if include else volumes
    out = out.filter(~like(exclude)) if exclude else out
    out = out.join(done, name, "left_anti") if done is not None else out
    return out.orderBy(order or name).limit(limit) if limit is not None else out


def persons_of(rows: DataFrame, key: str, cells: list[str], separator: str = r"\|") -> DataFrame:
    """The sorted set of all persons that any of the cells names."""
    arrays = [F.transform(F.split(F.coalesce(F.col(c), F.lit("")), separator), lambda x: F.trim(x)) for c in cells]
    return rows.select(key, F.array_sort(F.filter(F.array_distinct(F.concat(*arrays)), lambda x: x != "")).alias("persons"))
