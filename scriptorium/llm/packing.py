"""Operator 7: lexical retrieval packing.

Documents are encoded, dealt to shards of about shard_tokens ids by a hash of
their row, and each shard is packed with an inverted index of its own: postings
of BM25 weights by token id, with document frequencies counted over the whole
corpus (at most one count for each id of the vocabulary).  A seed asks with all of
its terms, and its window is filled with its unused neighbours, best first; the
last of them is cut to fill the rest, and what is left of it seeds the next window.
Rows that share no term with the seed come, in order, only after all that do.  Only
the last window of a shard is padded.

Null text counts as empty: a document of the closing id alone.  Rows are packed
one by one, repeated ones too, and null doc_ids stay null.  Very long documents
first yield whole windows, then take part with their rest.  Ties in score go to
the earlier row.  An empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import staged
from .tokens import blocks, tokenizer, tokenizer_key, tokenizer_path
from .worker import lean, trimmed

FIRST = 32  # neighbours that are sorted at once; the others when these don't fill the window
FREQUENT = 8  # terms of more than one document in so many have their weights in a row by document
K1, B = 1.2, 0.75


def distinct(ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids and how often each occurs; place: scratch space by id."""
    place[ids] = np.arange(len(ids))
    terms = ids[place[ids] == np.arange(len(ids))]
    place[terms] = np.arange(len(terms))
    return terms, np.bincount(place[ids], minlength=len(terms))


def encoded(docs: DataFrame, path: str, vocabulary: int, closing: int) -> DataFrame:
    """_row, doc_id, n, ids (little-endian, 16 bits) for each document; and for
    each task the number of its documents by term."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, place, frequency = tokenizer(path), np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
        for batch in batches:
            rows, names, texts = batch.column(0), batch.column(1), [t or "" for t in batch.column(2).to_pylist()]
            for s in blocks([len(t) for t in texts], 4_000_000):
                flat, counts = words.encode(texts[s])
                out = []
                for part in np.split(flat, np.cumsum(counts)[:-1]):
                    ids = np.append(part, np.uint16(closing))
                    place[ids] = np.arange(len(ids))
                    frequency[ids[place[ids] == np.arange(len(ids))]] += 1
                    out.append(ids.astype("<u2").tobytes())
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(s.start, n), names.slice(s.start, n), pa.array(counts + 1), pa.array(out, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                    ["_row", "doc_id", "n", "ids", "term", "docs"],
                )
        terms = np.flatnonzero(frequency)
        n = len(terms)
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(terms, pa.int32()), pa.array(frequency[terms])], ["_row", "doc_id", "n", "ids", "term", "docs"])

    kept = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long"), "text")
    return staged(kept.mapInArrow(lean(encode, tokenizer_key(path)), "_row long, doc_id long, n long, ids binary, term int, docs long"), "encoded")


class Packer:
    """Packs the documents of one shard."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, average: float, window: int):
        self.texts, self.window = texts, window
        self.pieces: list[tuple[int, int, int, int, int]] = []  # document, start, length, sequence, offset
        self.sequence = 0
        place = np.zeros(len(idf), np.int64)
        self.start = [len(t) - len(t) % window for t in texts]
        for k, t in enumerate(texts):
            for at in range(0, self.start[k], window):
                self.pieces.append((k, at, window, self.sequence, 0))
                self.sequence += 1
        self.unused = np.array([len(t) > s for t, s in zip(texts, self.start, strict=True)], bool)
        every, owners, weights = [], [], []
        self.queries: list[np.ndarray] = []
        for k, t in enumerate(texts):
            if not self.unused[k]:
                self.queries.append(t[:0])
                continue
            terms, counts = distinct(t, place)
            weight = idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(t) / average))
            self.queries.append(terms)
            every.append(terms)
            owners.append(np.full(len(terms), k, np.int32))
            weights.append(weight.astype(np.float32))
        if every:
            terms = np.concatenate(every)
            order = np.argsort(terms, kind="stable")
            self.owner, self.weight = np.concatenate(owners)[order], np.concatenate(weights)[order]
            documents = np.bincount(terms, minlength=len(idf))
            self.first = np.concatenate([[0], np.cumsum(documents)])
            frequent = np.flatnonzero(documents * FREQUENT > len(texts))
            self.row = np.full(len(idf), -1)
            self.row[frequent] = np.arange(len(frequent))
            self.dense = np.zeros((len(frequent), len(texts)), np.float32)
            for k, term in enumerate(frequent.tolist()):
                a, b = self.first[term], self.first[term + 1]
                self.dense[k, self.owner[a:b]] = self.weight[a:b]

    def neighbours(self, seed: int) -> Iterator[int]:
        """The unused documents that share a term with the seed, by BM25, then by row."""
        terms = self.queries[seed]
        rows = self.row[terms]
        scores = np.zeros(len(self.texts), np.float32)
        for k in rows[rows >= 0].tolist():
            scores += self.dense[k]
        for term in terms[rows < 0].tolist():
            a, b = self.first[term], self.first[term + 1]
            scores[self.owner[a:b]] += self.weight[a:b]
        scores[~self.unused] = 0
        scores[seed] = 0
        found = np.flatnonzero(scores > 0)
        least = np.partition(scores[found], -FIRST)[-FIRST] if len(found) > FIRST else 0
        for some in (found[scores[found] >= least], found[scores[found] < least]):
            yield from some[np.lexsort((some, -scores[some]))].tolist()

    def pack(self) -> list[tuple[int, int, int, int, int]]:
        waiting = iter(np.flatnonzero(self.unused).tolist())
        left = {k: len(t) - s for k, (t, s) in enumerate(zip(self.texts, self.start, strict=True))}
        seed = next(waiting, None)
        while seed is not None:
            space = self.window

            def place(k: int) -> None:
                nonlocal space
                n = min(left[k], space)
                self.pieces.append((k, self.start[k], n, self.sequence, self.window - space))
                self.start[k] += n
                left[k] -= n
                space -= n
                self.unused[k] = left[k] > 0

            place(seed)
            cut = seed if left[seed] else None
            for k in self.neighbours(seed) if space else ():
                place(k)
                if not space:
                    cut = k if left[k] else None
                    break
            while space:
                k = next((k for k in waiting if self.unused[k]), None)
                if k is None:
                    break
                place(k)
                cut = k if left[k] else None
            self.sequence += 1
            seed = cut if cut is not None and left[cut] else next((k for k in waiting if self.unused[k]), None)
        return self.pieces


def pack(docs: DataFrame, path: str | None = None, window: int = 2048, closing: int = 1, vocabulary: int = 49_408, shard_tokens: int = 2_000_000, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset; with_ids: also the ids, as 16-bit little-endian bytes."""
    tokens = encoded(docs, path or tokenizer_path(), vocabulary, closing)
    texts = tokens.filter(F.col("_row").isNotNull()).select("_row", "doc_id", "n", "ids")
    n_docs, total = texts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = tokens.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("docs").alias("docs")).toPandas()  # a row an id at most
    frequency = np.zeros(vocabulary)
    frequency[counts["term"].to_numpy(np.int64)] = counts["docs"]
    shared = docs.sparkSession.sparkContext.broadcast((np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5)).astype(np.float32), total / max(1, n_docs)))  # a float an id
    shards = max(1, -(-int(total) // shard_tokens))

    def packed(shard: pa.Table) -> pa.Table:
        trimmed()  # what the shard before it left
        shard = shard.sort_by("_row")
        idf, average = shared.value
        ids = [np.frombuffer(b, "<u2") for b in shard["ids"].to_pylist()]
        names, n = shard["doc_id"].to_pylist(), shard["n"].to_pylist()
        pieces = Packer(ids, idf, average, window).pack()
        own = [ids[k][a : a + m] for k, a, m, _, _ in pieces]
        base = shard["shard"][0].as_py() << 32
        columns = {
            "doc_id": pa.array([names[p[0]] for p in pieces], pa.int64()),
            "start": pa.array([p[1] for p in pieces], pa.int64()),
            "length": pa.array([p[2] for p in pieces], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64()),
            "doc_tokens": pa.array([n[p[0]] for p in pieces], pa.int64()),
            "sequence_id": pa.array([base + p[3] for p in pieces], pa.int64()),
            "offset": pa.array([p[4] for p in pieces], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([x.tobytes() for x in own], pa.binary())
        return pa.table(columns)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return texts.withColumn("shard", F.pmod(F.xxhash64("_row"), F.lit(shards))).groupBy("shard").applyInArrow(packed, schema)
