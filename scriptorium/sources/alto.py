"""Page-layout XML (ALTO 4) as relations.

Files are listed and read by Spark, one row a page; the parse is a kernel, as the
order of words and spaces inside a line is lost by XML-to-struct readers.  A file
that doesn't parse is mended once (bare ampersands, control characters) and says
so; one that still doesn't yields its error as a value.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = "struct<line_ord: int, id: string, tag: string, text: string, baseline: string, points: string, x: double, y: double, w: double, h: double>"
ZONE = f"struct<zone_ord: int, id: string, tag: string, points: string, x: double, y: double, w: double, h: double, lines: array<{LINE}>>"
PAGE = f"doc string, stem string, path string, width int, height int, error string, warning string, labels map<string,string>, zones array<{ZONE}>"


def _name(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _all(e: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    return (x for x in e.iter() if _name(x) == name)


def _children(e: ElementTree.Element, *names: str) -> list[ElementTree.Element]:
    return [x for x in e if _name(x) in names]


def _number(value: str | None) -> float | None:
    try:
        return float(value) if value is not None else None
    except ValueError:
        return None


def _box(e: ElementTree.Element) -> dict:
    return {k: _number(e.get(a)) for k, a in zip("xywh", ("HPOS", "VPOS", "WIDTH", "HEIGHT"), strict=True)}


def parse_xml(content: bytes) -> tuple[ElementTree.Element, str | None]:
    try:
        return ElementTree.fromstring(content), None
    except ElementTree.ParseError as error:
        text = content.decode("utf-8", "replace")
        mended = re.sub(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);)", "&amp;", text)
        mended = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", mended)
        return ElementTree.fromstring(mended.encode()), f"mended: {error}"


def line_text(line: ElementTree.Element) -> str:
    """Words and spaces in their order; if that is blank, the first word anywhere."""
    out = "".join(e.get("CONTENT", "") if _name(e) == "String" else " " for e in _children(line, "String", "SP")).strip()
    return out or next((e.get("CONTENT", "") for e in _all(line, "String")), "")


def read_page(content: bytes) -> dict:
    root, warning = parse_xml(content)
    page = next(_all(root, "Page"), None)
    labels = {t.get("ID"): t.get("LABEL") for t in _all(root, "OtherTag") if t.get("ID") and t.get("LABEL")}
    zones = []
    blocks = [b for space in _all(root, "PrintSpace") for b in _children(space, "TextBlock")]
    lines_of: dict[str | None, list[ElementTree.Element]] = {}
    for b in blocks:  # blocks of one id share their lines
        lines_of.setdefault(b.get("ID"), []).extend(_children(b, "TextLine"))
    outline = lambda e: next((p.get("POINTS") for p in _all(e, "Polygon")), None)
    for k, b in enumerate(blocks):
        lines = [{"line_ord": n, "id": t.get("ID"), "tag": t.get("TAGREFS"), "text": line_text(t), "baseline": t.get("BASELINE"), "points": outline(t), **_box(t)} for n, t in enumerate(lines_of[b.get("ID")], 1)]
        zones.append({"zone_ord": k, "id": b.get("ID"), "tag": b.get("TAGREFS"), "points": outline(b), **_box(b), "lines": lines})
    size = lambda a: int(n) if page is not None and (n := _number(page.get(a))) is not None else None
    return {"width": size("WIDTH"), "height": size("HEIGHT"), "error": None, "warning": warning, "labels": labels, "zones": zones}


def unpacked(path: str, content: bytes) -> Iterator[tuple[str, str, bytes]]:
    """doc, file and content of a file, or of each page in an archive."""
    if path.lower().endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            doc = path.rsplit("/", 1)[-1][:-4]
            for member in sorted(archive.namelist()):
                if member.endswith(".xml") and "__MACOSX" not in member and not member.rsplit("/", 1)[-1].startswith("."):
                    yield doc, member, archive.read(member)
    else:
        parts = path.rsplit("/", 2)
        yield parts[-2] if len(parts) > 2 else "", path, content


def pages(spark: SparkSession, root: str) -> DataFrame:
    """One row a page of every volume (a folder or archive) under root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{xml,zip}").load(root).select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    members = list(unpacked(path, content))
                except zipfile.BadZipFile as error:
                    rows.append({"doc": path.rsplit("/", 1)[-1][:-4], "stem": None, "path": path, "width": None, "height": None, "error": str(error), "warning": None, "labels": {}, "zones": []})
                    continue
                for doc, file, data in members:
                    head = {"doc": doc, "stem": file.rsplit("/", 1)[-1].removesuffix(".xml"), "path": file}
                    try:
                        rows.append(head | read_page(data))
                    except ElementTree.ParseError as error:
                        rows.append(head | {"width": None, "height": None, "error": str(error), "warning": None, "labels": {}, "zones": []})
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGE.split(", ")][:7] + ["labels", "zones"])

    return files.mapInPandas(parse, PAGE)


def zones(pages_: DataFrame) -> DataFrame:
    """doc, stem, path, zone_ord, zone_id, label, points, x, y, w, h."""
    z = pages_.select("doc", "stem", "path", "labels", F.explode("zones").alias("z"))
    return z.select("doc", "stem", "path", "z.zone_ord", F.col("z.id").alias("zone_id"), F.try_element_at("labels", "z.tag").alias("label"), "z.points", "z.x", "z.y", "z.w", "z.h")


def lines(pages_: DataFrame) -> DataFrame:
    """doc, stem, path, zone_ord, zone_id, zone_label, line_ord, line_id, line_label, text, box."""
    z = pages_.select("doc", "stem", "path", "labels", F.explode("zones").alias("z"))
    each = z.select("doc", "stem", "path", "labels", "z.zone_ord", F.col("z.id").alias("zone_id"), F.try_element_at("labels", "z.tag").alias("zone_label"), F.explode("z.lines").alias("l"))
    return each.select("doc", "stem", "path", "zone_ord", "zone_id", "zone_label", "l.line_ord", F.col("l.id").alias("line_id"), F.try_element_at("labels", "l.tag").alias("line_label"), "l.text", "l.baseline", "l.points", "l.x", "l.y", "l.w", "l.h")
