"""Loss accounting: every count carries its denominator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import digest_shape


def by_block(losses: DataFrame, block: str, code: str, count: str, repaired: list[str]) -> DataFrame:
    """What was lost by block; repaired codes count apart."""
    mended = F.col(code).isin(*repaired) if repaired else F.lit(False)
    return losses.groupBy(block).agg(
        F.coalesce(F.sum(F.when(~mended, F.col(count))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.when(mended, F.col(count))), F.lit(0)).alias("repaired"),
        F.count("*").alias("entries"),
    )


def gate(losses: DataFrame, code: str, count: str, order: str, counted: Column) -> DataFrame:
    """The codes that trip the gate, in the order first seen."""
    return losses.filter(counted & (F.col(count) > 0)).groupBy(code).agg(F.min(order).alias("first_seen"), F.sum(count).alias("lost"))


def page_loss(documents: DataFrame, lost: str, total: str, limit: float) -> DataFrame:
    """Documents of which more than limit percent of the pages are lost; none without pages."""
    share = 100.0 * F.col(lost) / F.col(total)
    return documents.filter((F.col(total) > 0) & (share > limit)).withColumn("percent", F.round(share, 4))


def warning_digest(warnings: DataFrame, document: str, message: str, order: str) -> DataFrame:
    """Warnings by shape: occurrences, documents, the first example, and for each
    place of a number the sum of the numbers that stood there (18 digits at most)."""
    shaped = warnings.select(document, order, F.col(message).alias("message"), digest_shape(F.col(message), F.col(document)).alias("shape"))
    head = shaped.groupBy("shape").agg(F.count("*").alias("occurrences"), F.countDistinct(document).alias("documents"), F.min_by("message", order).alias("example"))
    numbers = F.regexp_extract_all(F.when(F.col("message").startswith(F.concat(F.col(document), F.lit(": "))), F.substring("message", F.length(document) + 3, F.length("message"))).otherwise(F.col("message")), F.lit(r"(\d+)"), 1)
    each = shaped.select("shape", F.posexplode(numbers).alias("place", "number"))
    sums = each.groupBy("shape", "place").agg(F.sum(F.when(F.length("number") <= 18, F.col("number").cast("long"))).alias("total"))
    return head.join(sums.groupBy("shape").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda s: s["total"]).alias("totals")), "shape", "left")


def eta(steps: DataFrame, document: str, seconds: str, pages: str, remaining: Column) -> DataFrame:
    """Median seconds a page by document times what remains."""
    return steps.groupBy(document).agg((F.percentile(F.col(seconds) / F.col(pages), 0.5) * remaining).alias("eta_s"))


def selection_counts(documents: DataFrame, status: str) -> DataFrame:
    states = "ok", "skipped", "failed", "untried"
    return documents.agg(*[F.count(F.when(F.col(status) == s, 1)).alias(s) for s in states], F.count("*").alias("found"))


def exit_code(interrupted: bool, ok: int, failed: int, untried: int, tripped: bool, usage: bool = False, misconfigured: bool = False) -> int:
    """A wrong call (2) and wrong settings (3) are known before any document is begun."""
    if usage or misconfigured:
        return 2 if usage else 3
    if interrupted:
        return 130
    if failed:
        return 4 if not ok and not untried else 1
    return 5 if tripped else 0


INCIDENTS = 3  # the block of a run's report whose entries are incidents


def select_incidents(incidents: DataFrame, document: object = None, code: str | None = None, block: int | None = None, why: str | None = None, document_column: str = "document") -> DataFrame:
    """By document, by the beginning of the code and by cause; blocks other than that of
    the incidents have none."""
    out = incidents if document is None else incidents.filter(F.col(document_column) == document)
    out = out if code is None else out.filter(F.col("code").startswith(code))
    out = out if why is None else out.filter(F.col("why") == why)
    return out if block in (None, INCIDENTS) else out.filter(F.lit(False))


def phases_lost(losses: DataFrame, code: str, document: str, lost: str = "PHASE_LOST") -> DataFrame:
    """Documents of which a whole phase is lost."""
    return losses.agg(F.countDistinct(F.when(F.col(code) == lost, F.col(document))).alias("documents"))


def located(losses: DataFrame, block: str, page: str, count: str) -> DataFrame:
    """What is lost at a known page, and what only in a document."""
    on_page = F.col(page).isNotNull()
    return losses.groupBy(block).agg(F.coalesce(F.sum(F.when(on_page, F.col(count))), F.lit(0)).alias("precise"), F.coalesce(F.sum(F.when(~on_page, F.col(count))), F.lit(0)).alias("document_only"))


def by_cause(documents: DataFrame, document: str, causes: dict[str, str], total: str, otherwise: str) -> DataFrame:
    """code and count: the counters of a document by the codes they stand for, or the
    total under `otherwise` if none is set."""
    known = sum((F.coalesce(F.col(c), F.lit(0)) for c in causes), F.lit(0))
    rows = documents.select(document, F.explode(F.array(*(F.struct(F.lit(code).alias("code"), F.col(c).cast("long").alias("count")) for c, code in causes.items()), F.struct(F.lit(otherwise).alias("code"), F.when(known == 0, F.col(total)).cast("long").alias("count")))).alias("l"))
    return rows.select(document, "l.code", "l.count").filter("count > 0")
