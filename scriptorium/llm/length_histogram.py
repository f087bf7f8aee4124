"""Operator 10: exact histogram of encoded lengths, with suffix sums.

Each task counts the encoded lengths of its documents, the counts are summed by
length, and running sums over the histogram answer totals, quantiles and
truncated totals for every context limit without another pass over the texts.
The sums run in two levels, so no task ever holds the whole histogram: inside a
block of lengths, and over the blocks' totals.

Null and empty texts have length 0.  Rows are counted one by one, so repeated
documents count each time; other columns are ignored.  An empty table gives an
empty histogram, and answers of 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import staged
from .tokens import blocks, tokenizer, tokenizer_path

BLOCK = 1024


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """length, n_docs."""
    path = path or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for s in blocks([len(t) for t in texts], 4_000_000):
                found.update(tokenizer(path).lengths(texts[s]).tolist())
        yield pa.RecordBatch.from_pydict({"length": pa.array(list(found), pa.int64()), "n_docs": pa.array(list(found.values()), pa.int64())})

    counted = docs.select("text").mapInArrow(count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def with_suffix_sums(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length that occurs: docs_from and tokens_from (of documents at
    least so long), docs_upto and tokens_upto (at most so long), total_docs,
    total_tokens, and truncated_tokens, what is left when each document is cut
    to this length."""
    hist = staged(hist.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("length") / block).alias("block")), "lengths")
    over = Window.orderBy("block")  # a row a block of lengths: bounded by the longest text
    totals = (
        hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
        .select(
            "block",
            F.sum("d").over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("block_docs"),
            F.sum("t").over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("block_tokens"),
            F.sum("d").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total_docs"),
            F.sum("t").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total_tokens"),
        )
    )
    after = Window.partitionBy("block").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    later = lambda c: F.coalesce(F.sum(c).over(after), F.lit(0))
    sums = hist.select("*", later("n_docs").alias("later_docs"), later("n_tokens").alias("later_tokens")).join(totals, "block")
    upto = lambda kind: F.col(f"block_{kind}") - F.col(f"later_{kind}")
    return sums.select(
        "length",
        "n_docs",
        upto("docs").alias("docs_upto"),
        upto("tokens").alias("tokens_upto"),
        (F.col("total_docs") - upto("docs") + F.col("n_docs")).alias("docs_from"),
        (F.col("total_tokens") - upto("tokens") + F.col("n_tokens")).alias("tokens_from"),
        (upto("tokens") + F.col("length") * (F.col("total_docs") - upto("docs"))).alias("truncated_tokens"),
        "total_docs",
        "total_tokens",
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: limit, truncated_tokens for any limit, whether that length occurs or not."""
    return sums.filter(F.col("length") <= limit).agg(
        F.lit(limit).alias("limit"),
        F.coalesce(F.max_by(F.col("tokens_upto") + limit * (F.col("total_docs") - F.col("docs_upto")), "length"), F.lit(None)).alias("known"),
    ).crossJoin(  # two single rows
        sums.agg(F.coalesce(F.max("total_docs"), F.lit(0)).alias("docs"))
    ).select("limit", F.coalesce("known", F.col("docs") * limit).alias("truncated_tokens"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """One row: the least length that at least the share q of documents doesn't exceed."""
    return sums.filter(F.col("docs_upto") >= F.col("total_docs") * F.lit(q)).agg(F.min("length").alias("length"))
