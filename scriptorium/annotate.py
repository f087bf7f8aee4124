"""Services and models behind one seam: taggers, modernizers, entity models.

An annotator is made once in each Python worker and gets lists of texts; what it
fails on comes back as rows with a status, so nothing is lost without a count.
After `patience` failed requests in a row a partition sends no more of them.
"""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType


class Annotator(Protocol):
    def annotate(self, texts: list[str]) -> list[str]:
        """A JSON text for each text; raises OSError or ValueError if the request fails."""


class Nothing:
    """Leaves all texts as they are."""

    def annotate(self, texts: list[str]) -> list[str]:
        return ["[]" for _ in texts]


class RuleTagger:
    """A stand-in for tests: words with a tag by their shape."""

    def annotate(self, texts: list[str]) -> list[str]:
        tag = lambda w: "PONC" if not w[0].isalnum() else "NUM" if w[0].isdigit() else "NOMpro" if w[0].isupper() else "NOMcom"
        return [json.dumps([{"form": w, "lemma": w.lower(), "pos": tag(w)} for w in re.findall(r"\w+|[^\w\s]", t)], ensure_ascii=False) for t in texts]


class Http:
    """POSTs {"texts": [...]} and reads the list under `field`."""

    def __init__(self, url: str, field: str = "translations", timeout: float = 60):
        self.url, self.field, self.timeout = url, field, timeout

    def annotate(self, texts: list[str]) -> list[str]:
        request = urllib.request.Request(self.url, json.dumps({"texts": texts}).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            found = json.load(reply)[self.field]
        if len(found) != len(texts):
            raise ValueError("the service returned another number of texts")
        return [x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in found]


def annotated(rows: DataFrame, text: str, make: Callable[[], Annotator], batch: int = 256, patience: int = 3, out: str = "annotation") -> DataFrame:
    """rows with `out` and status: ok, refused (the request failed), unsent (after
    too many failures) or skipped (blank text).  A success resets the count."""
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        annotator, failures = make(), 0
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                part = whole.slice(start, batch)
                texts = part.column(at).to_pylist()
                ask = [k for k, t in enumerate(texts) if t and t.strip()]
                found: list[str | None] = [None] * len(texts)
                status = ["skipped"] * len(texts)
                state = "unsent"
                if ask and failures < patience:
                    try:
                        for k, x in zip(ask, annotator.annotate([texts[k] for k in ask]), strict=True):
                            found[k] = x
                        state, failures = "ok", 0
                    except (OSError, ValueError):
                        state, failures = "refused", failures + 1
                for k in ask:
                    status[k] = state
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(status, pa.string())], [*part.schema.names, out, "status"])

    return rows.mapInArrow(run, StructType(list(rows.schema.fields)).add(out, StringType()).add("status", StringType()))
