"""Operator 2: mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell of source, language and topic; the cell weights are
raked until each marginal meets its target, and documents are sampled with the
cells' calibrated probabilities, scaled so that a share `keep` of all tokens is
expected.  Values without a target of their own share what the targets leave, or
their own share of the tokens if that is more (the targets are then scaled to what
it leaves), as one value, so the number of cells is bounded by the targets and the
cells fit the driver whatever the corpus.

A topic is any column; without one a document gets the lexical bucket that most
of its longer words fall into.  Null source, language or topic counts as without
a target; null text has no tokens.  A marginal's targets are scaled to the values
that occur.  Rows with the same doc_id get the same draw, a null doc_id counts as
the empty string.  An empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .tokens import blocks
from .worker import lean

REST = "\x00rest"
TOPICS = 8
LONG_WORD = 5
SWEEPS = 40
TOLERANCE = 1e-3  # of a marginal's share; beyond it raking warns
DIMENSIONS = "source", "lang", "topic"


def topic_of(word: str) -> int:
    """The lexical bucket of a word by its ends, -1 for a short one."""
    return (ord(word[0]) + ord(word[-1])) % TOPICS if len(word) >= LONG_WORD else -1


def measured(docs: DataFrame, text: str = "text", tokens: str = "_tokens", topic: str = "_topic") -> DataFrame:
    """docs with the number of words (between ASCII white space) and the lexical
    topic: the bucket with most longer words, the lowest on a tie, or 0."""
    names = docs.columns
    at = names.index(text)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "")
            counts, topics = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for s in blocks(pc.binary_length(texts).to_pylist(), 4_000_000):
                split = pc.split_pattern_regex(texts.slice(s.start, s.stop - s.start), "[ \\t-\\r]+")
                coded = split.flatten().dictionary_encode()
                words = coded.dictionary.to_pylist()
                number = coded.indices.to_numpy()
                owner = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
                real = np.array([w != "" for w in words], bool)[number]
                bucket = np.array([topic_of(w) for w in words], np.int64)[number]
                counts.append(np.bincount(owner[real], minlength=len(split)))
                long = bucket >= 0
                topics.append(np.bincount(owner[long] * TOPICS + bucket[long], minlength=len(split) * TOPICS).reshape(-1, TOPICS).argmax(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(counts), pa.int64()), pa.array(np.concatenate(topics), pa.int32())], [*names, tokens, topic])

    return docs.mapInArrow(lean(measure), StructType(list(docs.schema.fields)).add(tokens, LongType()).add(topic, IntegerType()))


def known(column: Column, targets: dict) -> Column:
    """The value as text, or REST if it has no target."""
    value = column.cast("string")
    return F.when(value.isin([str(k) for k in targets]), value).otherwise(F.lit(REST))


def rake(cells: list[tuple], targets: tuple[dict, ...], sweeps: int = SWEEPS) -> np.ndarray:
    """cells: (value for each dimension ..., tokens).  The raked share of each cell."""
    weights = np.array([c[-1] for c in cells], float)
    if not weights.sum():
        return weights
    weights /= max(weights.sum(), 1e-300)
    groups, goals = [], []
    for d, wanted in enumerate(targets):
        wanted = {str(k): v for k, v in wanted.items()}
        values = sorted({c[d] for c in cells if c[-1]})
        left = max(0.0, 1 - sum(wanted.values()))
        own = sum(w for c, w in zip(cells, weights, strict=True) if c[d] not in wanted)
        given = sum(wanted.get(v, 0.0) for v in values)
        scale = (1 - own) / given if own > left and given else 1.0
        goal = np.array([wanted[v] * scale if v in wanted else max(left, own) for v in values])
        place = {v: k for k, v in enumerate(values)}
        groups.append(np.array([place.get(c[d], 0) for c in cells], np.int64))
        goals.append(goal / max(goal.sum(), 1e-300))
    for _ in range(sweeps):
        for group, goal in zip(groups, goals, strict=True):
            now = np.bincount(group, weights, len(goal))
            weights *= np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)[group]
    off = max(float(np.abs(np.bincount(group, weights, len(goal)) - goal).max()) for group, goal in zip(groups, goals, strict=True))
    if off > TOLERANCE:
        warnings.warn(f"a marginal is off its target by {off:.2g} after {sweeps} sweeps: the targets can't all be met by the cells that occur", stacklevel=2)
    return weights


def probabilities(tokens: np.ndarray, raked: np.ndarray, keep: float) -> np.ndarray:
    """min(1, c * raked / share), with c such that a share keep of tokens is expected,
    or all that has weight if that is less."""
    if not len(tokens):
        return np.zeros(0)
    ratio = np.divide(raked, tokens, out=np.zeros_like(raked), where=tokens > 0)
    order = np.argsort(-ratio, kind="stable")
    full = np.cumsum(tokens[order]) - tokens[order]  # tokens of the cells before, kept whole
    rest = np.cumsum(raked[order][::-1])[::-1]  # weight of this cell and those after
    scale = np.divide(keep * tokens.sum() - full, rest, out=np.zeros_like(rest), where=rest > 0)
    capped = scale * ratio[order] > 1
    first = int(np.argmin(capped)) if not capped.all() else len(capped)
    out = np.ones(len(tokens))
    out[order[first:]] = np.clip(scale[first], 0, None) * ratio[order[first:]] if first < len(capped) else 1
    out[ratio == 0] = 0
    return np.minimum(out, 1)


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) by doc_id and seed, the same in any engine with MD5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mixed(docs: DataFrame, targets: tuple[dict, dict, dict], keep: float, source: str = "source", lang: str = "lang", topic: str = "_topic", tokens: str = "_tokens", seed: str = "mix") -> DataFrame:
    """docs (measured) with _probability and _sampled."""
    spark = docs.sparkSession
    size = int(np.prod([len(t) + 1 for t in targets]))
    if size > 1_000_000:
        raise ValueError(f"the targets make {size} cells")
    keys = [known(F.col(c), t).alias(f"_cell{k}") for k, (c, t) in enumerate(zip((source, lang, topic), targets, strict=True))]
    names = [f"_cell{k}" for k in range(3)]
    cells = sorted(tuple(r) for r in docs.select(*keys, tokens).groupBy(*names).agg(F.sum(tokens)).collect())  # size rows at most
    sums = np.array([c[-1] for c in cells], float)
    chances = probabilities(sums, rake(cells, targets), keep)
    columns = [pa.array([c[k] for c in cells], pa.string()) for k in range(3)]
    table = spark.createDataFrame(pa.table([*columns, pa.array(chances, pa.float64())], [*names, "_probability"]))  # rows would take Python workers of their own, which stay
    out = docs.select("*", *keys).join(F.broadcast(table), names, "left")
    return out.withColumn("_sampled", draw(F.col("doc_id"), seed) < F.col("_probability")).drop(*names)
