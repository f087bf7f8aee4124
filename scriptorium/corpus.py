"""A corpus from files to relations, and its run record; the library's front door."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.labels import corners, label_parts, line_type, ncname, page_number, points, untyped
from .functions.text import word_count
from .operators import catalogue, containers, language, losses, notes, order
from .operators.entities import cut_off
from .sources import alto, catalogues, sinks


@dataclass
class Corpus:
    """Relations of all volumes under a folder; each is lazy until used."""

    spark: SparkSession
    root: str
    books: str | None = None

    @cached_property
    def parsed(self) -> DataFrame:
        """The pages as parsed, read once and kept (`cut_off`) for all relations."""
        return cut_off(alto.pages(self.spark, self.root))

    def pages(self) -> DataFrame:
        return order.page_order(self.parsed, ["doc"], "stem", "path").withColumn("page_id", ncname(F.col("stem")))

    def collisions(self) -> DataFrame:
        """Page numbers that a volume has twice."""
        return order.page_collisions(self.pages(), ["doc"], "stem").filter(F.col("num") < 999_999)

    def zones(self) -> DataFrame:
        z = alto.zones(self.pages()).withColumn("l", label_parts(F.coalesce("label", F.lit("")))).withColumn("b", corners(F.col("x"), F.col("y"), F.col("w"), F.col("h")))
        placed = z.select("doc", "stem", "path", page_number(F.col("stem")).alias("num"), "zone_ord", "zone_id", untyped(F.col("l.main"), "TextBlock").alias("type"), "l.subtype", "l.n", "b.*", points(F.col("points")).alias("points"))
        return order.occurrence(placed, ["doc", "path", "zone_id"], ["zone_ord"], "dup")

    def lines(self) -> DataFrame:
        each = alto.lines(self.parsed).join(self.pages().select("doc", "path", "page_ord"), ["doc", "path"])
        typed = each.withColumn("zone_type", untyped(label_parts(F.coalesce("zone_label", F.lit("")))["main"], "TextBlock"))
        typed = typed.withColumn("line_type", line_type(untyped(label_parts(F.coalesce("line_label", F.lit("")))["main"], "TextLine")))
        w = Window.partitionBy("doc").orderBy("page_ord", "zone_ord", "line_ord")
        return typed.withColumn("n", F.col("line_ord")).withColumn("line_ord", F.row_number().over(w))

    def containers(self) -> DataFrame:
        lines = self.lines()
        return containers.containers(lines, containers.front_pages(lines, ["doc", "page_ord"], "zone_type"))

    def notes(self) -> DataFrame:
        lines = self.lines().select("doc", "path", "zone_type", F.col("line_id"), F.col("y").alias("top"), (F.col("y") + F.col("h")).alias("foot"), "text")
        beside = lines.filter(F.col("zone_type") == containers.MARGIN).withColumnRenamed("line_id", "note_id")
        return notes.note_links(beside, lines.filter(F.col("zone_type").startswith("Main")), ["doc", "path"])

    def usage(self) -> DataFrame:
        """Words by language and their share, without the apparatus."""
        text = self.lines().filter(~F.col("zone_type").isin(containers.APPARATUS))
        return language.usage(language.line_volumes(text, ["doc"], "text"), ["doc"])

    def extent(self) -> DataFrame:
        text = self.lines().filter(~F.col("zone_type").isin(containers.APPARATUS))
        return text.groupBy("doc").agg(F.sum(word_count(F.col("text"))).alias("words"), F.countDistinct("path").alias("pages"))

    def losses(self) -> DataFrame:
        """Pages that can't be read, against all pages of the volume."""
        return self.pages().groupBy("doc").agg(F.count(F.when(F.col("error").isNotNull(), 1)).alias("lost"), F.count("*").alias("total"))

    def failing(self, limit: float) -> DataFrame:
        return losses.page_loss(self.losses(), "lost", "total", limit)

    def matched(self) -> DataFrame:
        """Volumes with their row of the catalogue."""
        if not self.books:
            raise ValueError("the corpus has no catalogue")
        rows = catalogues.csv(self.spark, self.books)
        return catalogue.prefix_match(self.pages().select(F.regexp_extract("doc", r"^([A-Za-z]+?\d+)", 1).alias("doc_key")).distinct(), "doc_key", rows, "BDD", "file_ord")

    def tei(self) -> DataFrame:
        return sinks.tei(self.containers().withColumn("title", F.col("doc")))

    def register(self) -> None:
        for name in ("pages", "zones", "lines", "containers", "usage"):
            getattr(self, name)().createOrReplaceTempView(f"corpus_{name}")


def manifest(argv: list[str], settings: dict, documents: dict[str, str], exit_code: int) -> str:
    return json.dumps({"argv": argv, "settings": settings, "documents": documents, "exit_code": exit_code}, ensure_ascii=False, sort_keys=True)


def failed(manifests: DataFrame) -> DataFrame:
    """Documents that failed in the latest run.  manifests: run, value."""
    latest = manifests.agg(F.max_by("value", "run").alias("value"))
    each = latest.select(F.explode(F.from_json(F.get_json_object("value", "$.documents"), "map<string,string>")).alias("document", "status"))
    return each.filter("status = 'failed'").select("document")


def kept_runs(names: list[str], current: str, keep: int = 10) -> list[str]:
    """The last runs by name, and the current one; the others may go."""
    return sorted({*sorted(names)[-keep:], current} & {*names, current})
