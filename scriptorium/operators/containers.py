"""Containers: runs of lines of one zone that make a block of the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import islands

APPARATUS = ["NumberingZone", "RunningTitleZone", "QuireMarksZone", "StampZone", "DigitizationArtefactZone"]
GRAPHIC, TITLE, MARGIN = ["GraphicZone", "DropCapitalZone"], "TitlePageZone", "MarginTextZone"


def front_pages(zones: DataFrame, page: list[str], kind: str, title: str = TITLE, main: str = "Main") -> DataFrame:
    """Pages with a title zone and no main one."""
    return (
        zones.groupBy(*page)
        .agg(F.coalesce(F.bool_or(F.col(kind) == title), F.lit(False)).alias("_title"), F.coalesce(F.bool_or(F.col(kind).startswith(main)), F.lit(False)).alias("_main"))
        .filter("_title and not _main")
        .select(*page)
    )


def containers(lines: DataFrame, fronts: DataFrame) -> DataFrame:
    """lines: doc, page_ord, line_ord, zone_id, zone_type, line_type.  Adds kind,
    cont_ord, page_break, div_ord and emphasis.

    kind is fw in the apparatus, note in the margin, figure in a graphic zone,
    titlePart on a front page's title zone, head for heading lines of main zones and
    ab for the rest.  Figures and title parts are one container for each zone,
    others end where kind, zone or page changes."""
    marked = lines.join(fronts.withColumn("is_front", F.lit(True)), ["doc", "page_ord"], "left")
    zone, line = F.col("zone_type"), F.col("line_type")
    front = F.coalesce("is_front", F.lit(False))
    kind = (
        F.when(zone.isin(APPARATUS), "fw").when(zone == MARGIN, "note").when(zone.isin(GRAPHIC), "figure")
        .when((zone == TITLE) & front, "titlePart").when(zone.startswith("Main") & line.startswith("HeadingLine") & ~front, "head").otherwise("ab")
    )
    out = islands(marked.withColumn("is_front", front).withColumn("kind", kind), ["doc"], ["line_ord"], ["page_ord", "kind", "zone_id"], "run")
    w = Window.partitionBy("doc").orderBy("line_ord")
    keyed = F.col("kind").isin("figure", "titlePart")
    first = F.min("run").over(Window.partitionBy("doc", "page_ord", "kind", "zone_id"))
    out = out.withColumn("cont_ord", F.when(keyed, first).otherwise(F.col("run")))
    opens = (F.col("kind") == "head") & ~F.lag("kind").over(w).eqNullSafe("head")
    out = out.withColumn("page_break", F.coalesce(F.col("page_ord") != F.lag("page_ord").over(w), F.lit(True))).withColumn("_opens", opens.cast("int"))
    out = out.withColumn("div_ord", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    emphatic = line.startswith("DropCapitalLine") | line.startswith("HeadingLine")
    return out.withColumn("emphasis", F.coalesce(emphatic, F.lit(False))).drop("_opens", "run")
