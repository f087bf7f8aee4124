"""The corpus's own constraints on TEI, each one filter over elements(doc, ord, parent_ord,
tag, attrs, text), and reports of another validator."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .validate import bad_points

#: The elements of the closed inventory (fixed values).
INVENTORY = """TEI ab addName altIdentifier appInfo application author authority availability bibl birth body
c catDesc category change choice classDecl country creation date death div edition editionStmt editorialDecl
education encodingDesc event extent faith figure fileDesc foreign forename front fw genName graphic head hi idno
interpretation item keywords label langUsage language lb licence line link linkGrp list listBibl listEvent
listObject listOrg listPerson listPlace material measure msDesc msIdentifier name nameLink normalization note
object objectDesc objectIdentifier objectName occupation org orgName orig p particDesc path pb pc persName person
physDesc place placeName profileDesc ptr pubPlace publicationStmt publisher reg repository resp respStmt
revisionDesc roleName rs s segmentation settingDesc settlement sourceDesc sourceDoc standOff surface surname
taxonomy teiHeader term text textClass title titlePage titlePart titleStmt w zone""".split()
AGENT, PLACEHOLDER = "#ner-auto", "0000-0000-0000-0000"


def _attr(name: str):
    return F.try_element_at("attrs", F.lit(name))


def _tag(elements: DataFrame, *tags: str) -> DataFrame:
    return elements.filter(F.col("tag").isin(*tags))


def _children(elements: DataFrame, parent: str, *tags: str) -> DataFrame:
    """Elements of tag `parent` with the number of children of each of the tags."""
    counts = elements.groupBy("doc", F.col("parent_ord").alias("ord")).agg(*[F.count(F.when(F.col("tag") == t, 1)).alias(f"n_{t}") for t in tags])
    return _tag(elements, parent).join(counts, ["doc", "ord"], "left").fillna(0, [f"n_{t}" for t in tags])


Rule = Callable[[DataFrame], DataFrame]
RULES: dict[str, Rule] = {
    "languages-or-prose": lambda e: _children(e, "langUsage", "language", "p", "ab").filter("n_language > 0 and n_p + n_ab > 0"),
    "language-measured": lambda e: _tag(e, "language").filter(_attr("usage").isNotNull() & ((F.coalesce(F.trim(_attr("ident")), F.lit("")) == "") | ~F.coalesce(_attr("n"), F.lit("")).rlike("^[0-9]+ (words|containers)$"))),
    "one-orig-one-reg": lambda e: _children(e, "choice", "orig", "reg").filter("n_orig <> 1 or n_reg <> 1"),
    "no-hyphen-left": lambda e: _tag(e, "reg").filter(F.contains("text", F.lit("¬"))),
    "automatic-is-graded": lambda e: e.filter((_attr("resp") == AGENT) & _attr("cert").isNull()),
    "graphic-has-id": lambda e: _tag(e, "zone").filter((_attr("type") == "GraphicZone") & _attr("id").isNull()),
    "figure-is-placed": lambda e: _tag(e, "figure").filter(_attr("corresp").isNull()),
    "one-manifest-each": lambda e: _tag(e, "idno").filter((_attr("type") == "iiif") & F.contains("text", F.lit("|"))),
    "no-placeholder": lambda e: _tag(e, "ptr", "idno").filter(F.coalesce(F.contains(_attr("target"), F.lit(PLACEHOLDER)), F.lit(False)) | F.contains("text", F.lit(PLACEHOLDER))),
    "known-elements": lambda e: e.filter(~F.col("tag").isin(INVENTORY)),
    "points-well-formed": lambda e: bad_points(e.filter(_attr("points").isNotNull()).withColumn("_points", _attr("points")), "_points"),
}


def broken(elements: DataFrame, rules: dict[str, Rule] = RULES) -> DataFrame:
    """rule, doc, ord of every element that breaks a rule."""
    return reduce(DataFrame.unionByName, [rule(elements).select(F.lit(name).alias("rule"), "doc", "ord") for name, rule in rules.items()])


def report_rows(text: str | None) -> list[tuple[str, str, str]]:
    """message, location and severity of a validator's report, in order; one that can't be
    read is a finding itself, none at all has no findings."""
    if text is None:
        return []
    try:
        tree = ElementTree.fromstring(text.encode())
    except ElementTree.ParseError as error:
        return [(f"the report can't be read: {error}", "", "fatal")]
    out = []
    for e in tree.iter():
        if e.tag.rpartition("}")[2] in ("failed-assert", "successful-report"):
            out.append((" ".join("".join(e.itertext()).split()), e.get("location", ""), e.get("role") or "fatal"))
    return out


def reports(documents: DataFrame, key: str, xml: str) -> DataFrame:
    """A row for each finding of a report in Schematron's language."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(doc, k, *r) for doc, text in zip(batch[key], batch[xml], strict=True) for k, r in enumerate(report_rows(text))]
            yield pd.DataFrame(rows, columns=["doc", "ord", "message", "location", "severity"])

    return documents.select(key, xml).mapInPandas(read, "doc string, ord int, message string, location string, severity string")
