"""Sinks: TEI documents, entity tables, incidents."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rendered(rows: pd.DataFrame) -> str:
    head = rows.iloc[0]
    out = ['<?xml version="1.0" encoding="UTF-8"?>', '<TEI xmlns="http://www.tei-c.org/ns/1.0">']
    out.append(f"<teiHeader><fileDesc><titleStmt><title>{escape(str(head['title'] or head['doc']))}</title></titleStmt><publicationStmt><p/></publicationStmt><sourceDesc><p/></sourceDesc></fileDesc></teiHeader>")
    out.append("<text><body>")
    now = None
    for r in rows.itertuples():
        if r.cont_ord != now:
            if now is not None:
                out.append(f"</{kind}>")
            kind, now = r.kind, r.cont_ord
            if r.page_break:
                out.append(f'<pb n="{r.page_ord}"/>')
            out.append(f"<{kind} corresp={quoteattr('#' + str(r.zone_id))}>")
        out.append(f"<lb/>{escape(r.text or '')}")
    if now is not None:
        out.append(f"</{kind}>")
    out += ["</body></text>", "</TEI>"]
    return "\n".join(out)


def tei(lines: DataFrame) -> DataFrame:
    """doc, xml: the text of each volume from doc, title, cont_ord, kind, zone_id,
    page_ord, page_break, line_ord, text."""

    def render(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line_ord")
        return pd.DataFrame([{"doc": rows["doc"].iloc[0], "xml": _rendered(rows)}])

    return lines.groupBy("doc").applyInPandas(render, "doc string, xml string")


def write_files(documents: DataFrame, name: str, content: str, folder: str) -> DataFrame:
    """A file for each row, written beside its place and then renamed; folder is one
    that all executors share.  Returns name and bytes."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch[name], batch[content], strict=True):
                data = text.encode()
                with tempfile.NamedTemporaryFile(dir=folder, delete=False, prefix=f".{key}-") as f:
                    f.write(data)
                os.replace(f.name, os.path.join(folder, f"{key}.xml"))
                rows.append((key, len(data)))
            yield pd.DataFrame(rows, columns=["name", "bytes"])

    return documents.select(name, content).mapInPandas(write, "name string, bytes long")


def write_entities(entities: DataFrame, path: str) -> None:
    """A folder for each document and type, most mentioned first, by semicolons."""
    ordered = entities.repartition("doc", "type").sortWithinPartitions("doc", "type", F.desc("mentions"), "entity_id")
    ordered.write.partitionBy("doc", "type").option("sep", ";").option("header", "true").mode("overwrite").csv(path)


def append_incidents(incidents: DataFrame, path: str) -> None:
    incidents.write.mode("append").json(path)
