"""Operator 1: shards by extendible hashing.

A document's 60-bit hash of doc_id and text is read from its highest bit.  A
bucket is a prefix of it; a bucket over the byte limit is split on one bit more,
and only such a bucket, until each shard fits.  The directory is found from sums
by prefix, a few bits of depth at a time: each round aggregates, map-side first,
the documents of the buckets that are still too large.  Nothing but sums by
prefix is moved, and the directory stays a table that is joined by prefix.

Rows of one doc_id and text have one hash that no bit can split; such a bucket
over the limit is kept in overflow pages of as many rows as fit, numbered inside
blocks of rows, so no task holds a whole group.  A single row over the limit has
a page of its own and `oversize` is set.

Null text counts as empty, null doc_id as the empty string.  An empty table gives
no shard; other columns are ignored, but `write_shards` keeps them.  The pages of an
overflowing bucket hold equal rows, so which of them lie on which page, and the
blocks in the pages' names, may differ with the input's file splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import blank_as_empty, staged, with_rows

BITS = 60
STEP = 6  # bits of depth beyond the mean that one round looks at
PAGE_ROWS = 16  # bits of the row number inside a block of rows


def prefix(depth: int | str, hash_: str = "h") -> Column:
    return F.expr(f"shiftright({hash_}, {BITS} - ({depth}))")


def keyed(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """_row (the caller's numbers, if given), doc_id, n_bytes, h."""
    text = blank_as_empty()
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    return docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("_row"),
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS // 4), 16, 10).cast("long").alias("h"),
    )


def directory(rows: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Buckets of depth low to high over rows whose prefix of low - 1 bits is over
    the limit: the shards (depth, prefix, bytes, docs), and the prefixes of high
    bits that don't fit yet."""
    fine = rows.groupBy(prefix(high).alias("p")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
    up = fine.select(F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "p", "bytes", "docs")
    levels = staged(up.groupBy("depth", F.expr(f"shiftright(p, {high} - depth)").alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")), "levels")
    over = levels.filter((F.col("bytes") > limit) & (F.col("depth") < high)).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    fit = levels.filter(F.col("bytes") <= limit).withColumn("parent", F.shiftright("prefix", 1))
    shards = fit.filter(F.col("depth") == low).drop("parent").unionByName(fit.filter(F.col("depth") > low).join(over, ["depth", "parent"], "left_semi").drop("parent"))
    return shards, levels.filter((F.col("bytes") > limit) & (F.col("depth") == high)).select(F.col("prefix").alias("p"))


def assigned(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """rows of a shard.  The directory has an entry for each prefix of the shards' least
    depth, with the shards below it, of which there are few, as a shard is split only
    where it is too large; so it grows with the shards and not with their depth."""
    least = shards.agg(F.coalesce(F.min("depth"), F.lit(0))).first()[0]
    entries = shards.groupBy(F.expr(f"shiftright(prefix, depth - {least})").alias("p")).agg(F.collect_list(F.struct("depth", "prefix", "bytes", "docs")).alias("below"))
    met = rows.withColumn("p", prefix(least)).join(entries.hint("merge"), "p").drop("p")
    own = F.expr(f"get(filter(below, s -> shiftright(h, int({BITS} - s.depth)) = s.prefix), 0)")
    return met.withColumn("own", own).filter("own is not null").select(*rows.columns, "own.*")


def shard(docs: DataFrame, limit: int, row: Column | None = None) -> DataFrame:
    """_row (numbered here, or the caller's row), doc_id, n_bytes, shard (bits of the prefix, with the page after a dot
    in a bucket that can't be split), depth, shard_bytes, shard_docs, oversize."""
    rows = staged(keyed(docs, row), "hashed")
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + STEP)
    out = None
    while True:
        shards, open_ = directory(rows, low, high, limit)
        shards, open_ = staged(shards, "directory"), staged(open_, "open")
        found = assigned(rows, shards)
        out = found if out is None else out.unionByName(found)
        if not open_.limit(1).count():
            break
        rows = staged(rows.withColumn("p", prefix(high)).join(open_, "p", "left_semi").drop("p"), "hashed")
        if high == BITS:
            out = out.unionByName(paged(rows, limit), allowMissingColumns=True)
            break
        low, high = high + 1, min(BITS, high + STEP)
    if "page" not in out.columns:
        out = out.withColumn("page", F.lit(None).cast("string"))
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return out.select(
        "_row",
        "doc_id",
        "n_bytes",
        F.concat(bits, F.coalesce(F.concat(F.lit("."), "page"), F.lit(""))).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.col("bytes").alias("shard_bytes"),
        F.col("docs").alias("shard_docs"),
        (F.col("bytes") > limit).alias("oversize"),
    )


def paged(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of equal hash, and so of equal size, in pages inside blocks of row numbers."""
    block = F.shiftright("_row", PAGE_ROWS)
    fits = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
    number = F.row_number().over(Window.partitionBy("h", block).orderBy("_row")) - 1
    held = F.count("*").over(Window.partitionBy("h", block))
    page = F.floor(number / fits)
    docs = F.least(fits, held - page * fits)
    return rows.select(
        "_row",
        "doc_id",
        "n_bytes",
        "h",
        F.lit(BITS).alias("depth"),
        F.col("h").alias("prefix"),
        (docs * F.col("n_bytes")).alias("bytes"),
        docs.cast("long").alias("docs"),
        F.concat_ws(".", block.cast("string"), page.cast("string")).alias("page"),
    )


def free_name(wanted: str, columns: list[str]) -> str:
    while wanted in columns:
        wanted = f"_{wanted}"
    return wanted


def write_shards(docs: DataFrame, path: str, limit: int, files: int) -> DataFrame:
    """Writes docs partitioned by shard (under a name that docs doesn't have) and
    returns the assignment.  Rows are numbered once, in a staged copy, so that the
    assignment holds however the input's files are split; fewer or more rows written
    than read are an error."""
    row, name = free_name("_row", docs.columns), free_name("shard", docs.columns)
    rows = with_rows(docs, "documents", row=row)
    found = staged(shard(rows, limit, F.col(row)), "sharded")
    wide = rows.join(found.select(F.col("_row").alias(row), F.col("shard").alias(name)), row)
    wide.repartition(files, name).sortWithinPartitions(name).drop(row).write.partitionBy(name).parquet(path)
    read, written = rows.count(), docs.sparkSession.read.parquet(path).count() if rows.limit(1).count() else 0
    if read != written:
        raise RuntimeError(f"{read} rows were read and {written} written")
    return found
