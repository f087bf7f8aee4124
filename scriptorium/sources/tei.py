"""TEI documents as one relation of elements, for constraint queries."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

ELEMENTS = "doc string, ord int, parent_ord int, tag string, attrs map<string,string>, text string"


def walked(root: ElementTree.Element) -> Iterator[tuple[int, int | None, str, dict, str]]:
    local = lambda name: name.rpartition("}")[2]
    stack: list[tuple[ElementTree.Element, int | None]] = [(root, None)]
    k = 0
    while stack:
        e, parent = stack.pop()
        yield k, parent, local(e.tag), {local(a): v for a, v in e.attrib.items()}, e.text or ""
        stack += [(c, k) for c in reversed(e)]
        k += 1


def elements(documents: DataFrame, key: str = "doc", xml: str = "xml") -> DataFrame:
    """A row for each element in document order; a text that doesn't parse is one row
    of tag `unreadable`."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch[key], batch[xml], strict=True):
                try:
                    rows += [(doc, *e) for e in walked(ElementTree.fromstring(text.encode()))]
                except ElementTree.ParseError as error:
                    rows.append((doc, 0, None, "unreadable", {}, str(error)))
            out = pd.DataFrame(rows, columns=["doc", "ord", "parent_ord", "tag", "attrs", "text"])
            yield out.astype({"parent_ord": "Int32", "ord": "int32"})

    return documents.select(key, xml).mapInPandas(read, ELEMENTS)
