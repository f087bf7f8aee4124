"""Operator 5: removal of repeated 200-byte strings by merged sorted suffixes.

Every window of 200 bytes belongs to the least (by hash) of its 100-byte grams;
the windows of one gram at one place make a cell, the text from the first
window's start to the last one's end.  Equal windows have equal grams at equal
offsets, so windows repeat only between cells of one gram, and a cell whose gram
occurs once in the corpus is ruled out by a count.  Of the others:

1. Each cell gives the suffix that begins at its gram and ends with the cell; what
   stands before the gram goes along.  Each task sorts its different cells by their
   suffixes, front-codes them and deals the runs out by gram, so a hot passage costs a
   task's run one string, not one a document.
2. A loser tree merges the runs of a part, never comparing known prefixes again, and
   gives the common prefix of each suffix with the one before.
3. A window with k bytes before its gram repeats where two cells, or two places of one
   cell, share k bytes before the gram and the rest after it.  Cells that share m bytes
   of their suffixes stand together between common prefixes below m; so do, in the
   order of what stands before, read backwards, those that share k bytes there.  So
   for each k the two orders give each cell a class, and classes of more than one
   place repeat.  All verdicts come from common prefixes of real bytes.

A gram with more than `hot` different cells would fill a task, so its windows are
counted by their 128-bit digests instead, map-side first.

Equal texts are taken once, with their number: each of 200 bytes or more is
removed whole where there are several.  Verdicts go back by cell, and each
distinct text is cut once.

Null text counts as empty.  Texts below 200 bytes stay.  Repeated rows are equal
texts.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blank_as_empty, deleted, partitions, release, salted_join, scratch, staged
from .lcp_merge import front_coded, merged, shared
from .minhash import VALUES, Powers, mixed
from .tokens import blocks

BLOCK = 500_000  # bytes of text that are searched at once
PLACE = np.uint64((1 << 20) - 1)
_powers = Powers()


def hashes(data: np.ndarray, sums: np.ndarray, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Of data[first : first + size], by sums of the weighted values."""
    _, down = _powers.upto(len(data) + 1)
    return mixed((sums[first + size] - sums[first]) * down[first] + np.uint64(size) if isinstance(size, int) else (sums[first + size] - sums[first]) * down[first] + size.astype(np.uint64))


def weighted(data: np.ndarray) -> np.ndarray:
    up, _ = _powers.upto(len(data) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[data] * up[: len(data)])])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of width values, by running minima of blocks from both sides."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def cells(texts: list[bytes], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """text number, start, windows, bytes before the gram, gram hash, cell hash of every
    cell of the texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    nothing = np.zeros(0, np.int64)
    if len(data) < window:
        return nothing, nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    found = []
    sums = weighted(data)
    grams = hashes(data, sums, np.arange(len(data) - gram + 1), gram)
    ends = np.cumsum(sizes)
    for at in range(0, len(data) - window + 1, BLOCK):  # places are numbered anew in each block
        part = grams[at : at + BLOCK + window - gram]
        least = sliding_least((part & ~PLACE) | np.arange(len(part), dtype=np.uint64), window - gram + 1)
        found.append((least & PLACE).astype(np.int64) + at)
    anchor = np.concatenate(found)
    start = np.arange(len(anchor))
    owner = np.searchsorted(ends, start, side="right")
    inside = start + window <= ends[owner]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]]) & inside
    first = np.flatnonzero(new)
    total = np.concatenate([[0], np.cumsum(inside)])
    following = np.concatenate([first[1:], [len(start)]])
    windows = total[following] - total[first]
    owner = owner[first]
    return owner, first - (ends - sizes)[owner], windows, anchor[first] - first, grams[anchor[first]], hashes(data, sums, first, windows + window - 1)


def searched(batch: pa.RecordBatch, at: int, window: int, gram: int) -> Iterator[tuple[int, list[bytes], tuple[np.ndarray, ...]]]:
    texts = [t.encode() for t in batch.column(at).to_pylist()]
    for s in blocks([len(t) for t in texts], 4 * BLOCK):
        yield s.start, texts[s], cells(texts[s], window, gram)


def signed64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def counted_cells(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """gram, cell, n: summed in each batch first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, (_, _, _, _, grams, names) in searched(batch, 0, window, gram):
                pairs = np.stack([grams, names], axis=1).view([("g", np.uint64), ("c", np.uint64)]).ravel()
                different, n = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays([signed64(different["g"].copy()), signed64(different["c"].copy()), pa.array(n, pa.int64())], ["gram", "cell", "n"])

    return texts.select("text").mapInArrow(count, "gram long, cell long, n long").groupBy("gram", "cell").agg(F.sum("n").alias("n"))


def placed_cells(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """key, start, windows, before, gram, cell of every cell."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, _, (owner, first, windows, before, grams, names) in searched(batch, 1, window, gram):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner + start)), pa.array(first, pa.int32()), pa.array(windows, pa.int32()), pa.array(before, pa.int32()), signed64(grams), signed64(names)],
                    ["key", "start", "windows", "before", "gram", "cell"],
                )

    return texts.select("key", "text").mapInArrow(place, "key binary, start int, windows int, before int, gram long, cell long")


class Cell(NamedTuple):
    """What is sorted by its first member: the suffix from the gram, the bytes before it
    read backwards, and the two hashes that name the cell."""

    suffix: bytes
    before: bytes
    gram: int
    name: int


_cell_head = struct.Struct("<qqI")


def dealt(found: Counter[Cell], parts: int) -> pa.RecordBatch:
    by_part = defaultdict(list)
    for c in sorted(found):
        by_part[(c.gram & 0xFFFFFFFF) % parts].append(c)
    runs = [front_coded([c.suffix for c in own], [found[c] for c in own]) for own in by_part.values()]
    heads = [b"".join(_cell_head.pack(c.gram, c.name, len(c.before)) + c.before for c in own) for own in by_part.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(by_part), pa.int64()), pa.array(runs, pa.binary()), pa.array(heads, pa.binary())], ["part", "run", "cells"])


def sorted_runs(marked: DataFrame, window: int, parts: int, run_bytes: int = 24 << 20) -> DataFrame:
    """marked: text, marks (start, windows, before, gram, cell).  part, run, cells: a
    task's different cells, about run_bytes at a time, sorted by suffix and front-coded,
    and in that order what stands before the grams, by part."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[Cell] = Counter()
        size = 0
        for batch in batches:
            for text, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode()
                for m in marks:
                    at = m["start"] + m["before"]
                    c = Cell(raw[at : m["start"] + m["windows"] + window - 1], raw[m["start"] : at][::-1], m["gram"], m["cell"])
                    size += 0 if c in found else len(c.suffix) + len(c.before)
                    found[c] += 1
                if size > run_bytes:
                    yield dealt(found, parts)
                    found, size = Counter(), 0
        yield dealt(found, parts)

    return marked.select("text", "marks").mapInArrow(sort, "part long, run binary, cells binary")


def heads_of(cells_: bytes) -> Iterator[tuple[int, int, bytes]]:
    at = 0
    while at < len(cells_):
        gram, name, n = _cell_head.unpack_from(cells_, at)
        at += _cell_head.size + n
        yield gram, name, cells_[at - n : at]


def repeated_windows(common: np.ndarray, after: np.ndarray, befores: list[bytes], counts: np.ndarray, window: int, gram: int) -> np.ndarray:
    """A row for each number k of bytes before the gram, from 0, a column for each cell:
    whether that window occurs twice.  common: the cells' common prefixes with the cell
    before in the order of their suffixes; after: the suffixes' sizes."""
    n = len(counts)
    order = sorted(range(n), key=befores.__getitem__)
    shares = np.array([0] + [shared(befores[a], befores[b]) for a, b in pairwise(order)], np.int64)
    before = np.fromiter(map(len, befores), np.int64, n)
    out = np.zeros((window - gram + 1, n), bool)
    left = np.empty(n, np.int64)
    for k in range(window - gram + 1):
        here = np.flatnonzero((before >= k) & (after >= window - k))
        if not len(here):
            continue
        left[order] = np.cumsum(shares < k)
        right = np.cumsum(common < window - k)
        _, which = np.unique(left[here] * (n + 2) + right[here], return_inverse=True)
        out[k, here] = np.bincount(which, counts[here])[which] > 1
    return out


def spans_of(again: np.ndarray, before: np.ndarray, window: int) -> dict[int, list[tuple[int, int]]]:
    """Spans of covered bytes in each cell that has a repeated window."""
    padded = np.zeros((again.shape[0] + 2, again.shape[1]), np.int8)
    padded[1:-1] = again
    steps = np.diff(padded, axis=0).T
    cell, first = np.nonzero(steps == 1)
    _, last = np.nonzero(steps == -1)  # the numbers k from first to last - 1, so starts from before - last + 1
    out: dict[int, list[tuple[int, int]]] = {}
    for c, a, b in zip(cell.tolist(), (before[cell] - last + 1).tolist(), (before[cell] - first + window).tolist(), strict=True):
        out.setdefault(c, []).append((a, b))
    return out


SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def judged(runs: DataFrame, window: int, gram: int) -> DataFrame:
    """gram, cell, spans: by merging the runs of each part."""

    def judge(part: pa.Table) -> pa.Table:
        heads = [heads_of(c) for c in part["cells"].to_pylist()]
        common, after, counts, befores, names = [], [], [], [], []
        for run, known, string, n in merged(part["run"].to_pylist()):
            g, name, before = next(heads[run])
            common.append(known)
            after.append(len(string))
            counts.append(n)
            befores.append(before)
            names.append((g, name))
        again = repeated_windows(np.array(common), np.array(after), befores, np.array(counts), window, gram)
        found = {names[c]: spans for c, spans in spans_of(again, np.fromiter(map(len, befores), np.int64, len(befores)), window).items()}  # a cell of several runs once
        return pa.table({"gram": pa.array([g for g, _ in found], pa.int64()), "cell": pa.array([c for _, c in found], pa.int64()), "spans": pa.array([[{"a": a, "b": b} for a, b in v] for v in found.values()], SPANS)})

    return runs.groupBy("part").applyInArrow(judge, "gram long, cell long, spans array<struct<a:int,b:int>>")


def judged_hot(marked: DataFrame, window: int) -> DataFrame:
    """The same for cells of hot grams, by counts of their windows' digests.  marked: key, text, marks."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode()
                for m in marks:
                    starts = range(m["start"], m["start"] + m["windows"])
                    found = [hashlib.blake2b(raw[a : a + window], digest_size=16).digest() for a in starts]
                    n = len(found)
                    yield pa.RecordBatch.from_arrays([pa.array([m["gram"]] * n, pa.int64()), pa.array([m["cell"]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(found, pa.binary())], ["gram", "cell", "at", "digest"])

    each = marked.select("text", "marks").mapInArrow(digests, "gram long, cell long, at int, digest binary").groupBy("gram", "cell", "at", "digest").agg(F.count("*").alias("n"))
    each = staged(each, "hot-windows")
    often = each.groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 1").select("digest")
    span = F.struct(F.col("at").alias("a"), (F.col("at") + window).alias("b"))
    return each.join(often, "digest", "left_semi").groupBy("gram", "cell").agg(F.collect_list(span).alias("spans"))


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs of them, and what is kept."""
    kept, at, removed, runs, end = [], 0, 0, 0, -1
    for a, b in sorted(spans):
        if a > end:
            runs += 1
            kept.append(text[at:a])
            at = a
        if b > at:
            removed += b - max(at, a)
            at = b
        end = max(end, b)
    kept.append(text[at:])
    return removed, runs, b"".join(kept)


def distinct_texts(docs: DataFrame, buckets: int) -> tuple[DataFrame, str, str]:
    """key, text, copies, bucketed by key, so that later joins leave texts where they
    are; and the table's name and path."""
    spark = docs.sparkSession
    name, path = f"texts_{uuid.uuid4().hex}", scratch(spark, "texts")
    keyed = docs.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    keyed.repartition(buckets, "key").write.option("path", path).bucketBy(buckets, "key").saveAsTable(name)
    return spark.table(name), name, path


def remove_repeats(documents: DataFrame, window: int = 200, part_bytes: int = 16 << 20, buckets: int | None = None, hot: int = 100_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row."""
    spark = documents.sparkSession
    gram = window // 2
    text = blank_as_empty()
    row = F.monotonically_increasing_id().alias("row")  # only deals rows of one text out
    keyed = documents.select("doc_id", F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16).alias("key"), text.alias("text"), row)
    texts, name, path = distinct_texts(keyed.select("key", "text"), buckets or partitions(spark))
    release(spark)
    long = texts.filter(F.octet_length("text") >= window)
    counted = staged(counted_cells(long, window, gram), "cells")
    grams = staged(counted.groupBy("gram").agg(F.sum("n").alias("times"), F.count("*").alias("different")).filter("times > 1").select("gram", (F.col("different") > hot).alias("is_hot")), "grams")
    suspects = staged(counted.join(grams, "gram").select("gram", "cell", "n", "is_hot"), "suspects")
    release(spark)
    placed = staged(salted_join(placed_cells(long, window, gram), suspects, ["gram", "cell"], "n", "key").drop("n"), "placed")
    release(spark)
    n_bytes, n_hot = placed.agg(F.coalesce(F.sum(F.when(~F.col("is_hot"), F.col("windows") + window)), F.lit(0)), F.count(F.when(F.col("is_hot"), 1))).first()

    def marks(of: DataFrame) -> DataFrame:
        return long.join(of.groupBy("key").agg(F.collect_list(F.struct("start", "windows", "before", "gram", "cell")).alias("marks")), "key")

    runs = staged(sorted_runs(marks(placed.filter("not is_hot")), window, max(1, -(-n_bytes // part_bytes))), "runs")
    release(spark)
    verdicts = judged(runs, window, gram)
    verdicts = verdicts.unionByName(judged_hot(marks(placed.filter("is_hot")), window)) if n_hot else verdicts
    verdicts = staged(verdicts.join(suspects.select("gram", "cell", "n"), ["gram", "cell"]), "verdicts")
    release(spark)
    spans = salted_join(placed, verdicts, ["gram", "cell"], "n", "key").select("key", F.explode(F.transform("spans", lambda s: F.struct((F.col("start") + s["a"]).alias("a"), (F.col("start") + s["b"]).alias("b")))).alias("span"))
    spans = staged(spans.groupBy("key").agg(F.collect_list("span").alias("spans")), "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, copies, spans = (c.to_pylist() for c in batch.columns)
            out = []
            for t, n, found in zip(texts, copies, spans, strict=True):
                raw = t.encode()
                whole = n > 1 and len(raw) >= window
                removed, runs, kept = cut(raw, [(0, len(raw))] if whole else [(s["a"], s["b"]) for s in found or []])
                out.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["key", "copies", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    done = texts.join(spans, "key", "left").select("key", "text", "copies", "spans").mapInArrow(remove, "key binary, copies long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    done = staged(done, "cut")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    deleted(spark, path)
    release(spark)
    return salted_join(keyed.select("doc_id", "key", "row"), done, "key", "copies", "row").drop("key", "row", "copies")
