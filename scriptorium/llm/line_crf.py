"""Operator 8: document quality by a linear-chain conditional random field over lines.

Each line is described by shares of character classes, repeated words and lines
and its length, with the same of the lines before and after.  The field labels
every line good or bad; a document's quality is the mean of its lines' marginals
from forward-backward, weighted by their bytes, then calibrated.  Only the text
enters a score.

It is fitted on at most `sample` labelled documents of at most `most_lines` lines in
all, drawn in the order of a hash of doc_id; a document's label holds for all its lines
in training.  Of rows that share a doc_id one text (the least by hash) and the lower
label count.

Null text counts as empty: one empty line, which gets a score too.  Repeated rows
get equal scores.  Without labelled rows of both kinds the score is 0.5.  An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import blank_as_empty
from .minhash import SPACE, VALUES, Powers, mixed
from .tokens import blocks

OTHER, UPPER, LOWER, BEYOND, DIGIT, BLANK, MARK, SIGN = range(8)
CLASSES = np.full(256, OTHER)
CLASSES[65:91], CLASSES[97:123], CLASSES[128:], CLASSES[48:58] = UPPER, LOWER, BEYOND, DIGIT
CLASSES[SPACE] = BLANK
CLASSES[[ord(c) for c in ".,;:!?'\"()-"]] = MARK
CLASSES[[ord(c) for c in "#$%&*+/<=>@[]\\^_`{|}~"]] = SIGN
FEATURES = 12
_powers = Powers()


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features for each line of all texts, the lines' bytes, and how
    many lines each text has."""
    raw = [t.encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    stops = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], stops[:-1] + 1])
    doc_ends = np.cumsum([len(r) for r in raw])
    doc = np.searchsorted(doc_ends, starts, side="right")
    n = len(stops)
    size = stops - starts
    line = np.repeat(np.arange(n), size + 1)
    kinds = np.bincount(line * 8 + CLASSES[data], minlength=n * 8).reshape(n, 8).astype(float)
    kinds[:, BLANK] -= 1  # the line feed
    up, down = _powers.upto(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[data] * up[: len(data)])])
    word = ~SPACE[data]
    edges = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    name = (sums[last] - sums[first]) * down[first]
    of = line[first] if len(first) else first
    words = np.bincount(of, minlength=n).astype(float)
    same = np.zeros(len(first), bool)
    same[1:] = (name[1:] == name[:-1]) & (of[1:] == of[:-1])
    repeats = np.bincount(of, same, minlength=n)
    lines = mixed((sums[stops] - sums[starts]) * down[starts]) + mixed(doc.astype(np.uint64))
    _, earliest = np.unique(lines, return_index=True)
    again = np.ones(n)
    again[earliest] = 0
    letters = kinds[:, UPPER] + kinds[:, LOWER] + kinds[:, BEYOND]
    bytes_ = np.maximum(1, size)
    share = lambda k, by, times=1.0: np.minimum(1, times * k / np.maximum(1, by))
    own = np.stack(
        [
            np.ones(n), np.log1p(size) / 8, share(kinds[:, UPPER], letters), share(kinds[:, BEYOND], bytes_, 2), share(kinds[:, DIGIT], bytes_, 4),
            share(kinds[:, BLANK], bytes_, 2), share(kinds[:, MARK], bytes_, 5), share(kinds[:, SIGN], bytes_, 10), share(bytes_, 12 * np.maximum(1, words)),
            share(repeats, words, 2), again * (size > 0), (size == 0).astype(float),
        ],
        axis=1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    follows = doc[1:] == doc[:-1]
    before[1:][follows] = own[:-1][follows]
    after[:-1][follows] = own[1:][follows]
    return np.concatenate([own, before, after], axis=1), bytes_, np.bincount(doc, minlength=len(texts))


def marginals(scores: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """scores: of each line's being good, texts in a row; counts: lines of each
    text; pairs: log potentials [label, next label].  The probability that each
    line is good, and the sums of pair probabilities.  All texts go forward and
    back side by side, the longest first."""
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    total = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(total)]  # texts with more than t lines
    local = np.stack([np.zeros(len(scores)), np.clip(scores, -30, 30)], axis=1)
    local = np.exp(local - local.max(axis=1, keepdims=True))
    step = np.exp(pairs - pairs.max())
    ahead, behind = np.empty((len(scores), 2)), np.empty((len(scores), 2))
    for t in range(total):
        at = starts[: active[t]] + t
        a = local[at] if not t else (ahead[at - 1] @ step) * local[at]
        ahead[at] = a / a.sum(axis=1, keepdims=True)
    sums = np.zeros((2, 2))
    for t in range(total - 1, -1, -1):
        more = active[t + 1] if t + 1 < total else 0
        at = starts[: active[t]] + t
        b = np.ones((len(at), 2))
        if more:
            coming = local[at[:more] + 1] * behind[at[:more] + 1]
            b[:more] = coming @ step.T
            both = ahead[at[:more]][:, :, None] * step * coming[:, None, :]
            sums += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        behind[at] = b / b.sum(axis=1, keepdims=True)
    joint = ahead * behind
    return joint[:, 1] / joint.sum(axis=1), sums


@dataclass
class Model:
    weights: np.ndarray
    pairs: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    known: bool = True

    def raw(self, texts: list[str]) -> np.ndarray:
        """The length-weighted mean of the lines' marginals, in log odds."""
        x, size, counts = features(texts)
        good, _ = marginals(x @ self.weights, counts, self.pairs)
        return log_odds(good, size, counts)

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.raw(texts) + self.offset))) if self.known else np.full(len(texts), 0.5)


def log_odds(good: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    first = np.cumsum(counts) - counts
    mean = np.add.reduceat(good * size, first) / np.add.reduceat(size, first)
    mean = np.clip(mean, 1e-3, 1 - 1e-3)
    return np.log(mean / (1 - mean))


def climbed(x: np.ndarray, counts: np.ndarray, truth: np.ndarray, rounds: int, rate: float, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and pair potentials by Adam on the mean log-likelihood of line labels."""
    weights, pairs, seen = np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros((2, 2))
    within = np.ones(len(truth), bool)
    within[np.cumsum(counts) - 1] = False
    at = np.flatnonzero(within)
    np.add.at(seen, (truth[at], truth[at + 1]), 1)
    first, second = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    scale = 1 / len(truth)
    for k in range(1, rounds + 1):
        good, expected = marginals(x @ weights, counts, pairs)
        gradient = np.concatenate([x.T @ (truth - good) * scale - ridge * weights, ((seen - expected) * scale - ridge * pairs).ravel()])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        move = rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
        weights, pairs = weights + move[:-4], pairs + move[-4:].reshape(2, 2)
    return weights, pairs


def fit(x: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray, passes: int = 3, rounds: int = 100, rate: float = 0.15, ridge: float = 1e-4) -> Model:
    """First each line has its document's label; then lines of bad documents that
    score as good ones count as good, but for the worst.  Last, a calibration of
    two numbers."""
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(3 * FEATURES), np.zeros((2, 2)), known=False)
    of = np.repeat(labels, counts).astype(np.int64)
    truth, starts = of, np.cumsum(counts) - counts
    for k in range(passes):
        weights, pairs = climbed(x, counts, truth, rounds, rate, ridge)
        if k < passes - 1:
            scores = x @ weights
            worst = scores == np.repeat(np.minimum.reduceat(scores, starts), counts)
            typical = np.quantile(scores[of == 1], 0.05)
            truth = np.where((of == 1) | (scores > typical) & ~worst, 1, 0)
    good, _ = marginals(x @ weights, counts, pairs)
    odds = log_odds(good, size, counts)
    design, line = np.stack([odds, np.ones(len(odds))], axis=1), np.array([1.0, 0.0])
    for _ in range(25):  # Newton
        p = 1 / (1 + np.exp(-np.clip(design @ line, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        line = line + np.linalg.solve(hessian, design.T @ (labels - p) - 1e-2 * (line - np.array([1.0, 0.0])))
    return Model(weights, pairs, float(line[0]), float(line[1]))


def crc_of(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def held_out() -> Column:
    return F.coalesce(F.pmod(crc_of(), F.lit(5)) == 0, F.lit(False))


def trained_on(docs: DataFrame, labels: DataFrame, sample: int = 3000, most_lines: int = 200_000) -> Model:
    """From labelled documents that aren't held out; a document that would go beyond
    most_lines is passed over, so what the driver holds is bounded."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    drawn = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # one row of a doc_id: by sums in each task first, so that repeated rows stay where they are
    one = docs.select("doc_id", blank_as_empty().alias("text")).join(F.broadcast(drawn), "doc_id").withColumn("_size", F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    places = one.groupBy("doc_id", "_label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("_size").alias("lines"))).alias("_one")).select("doc_id", "_label", "_one.*").collect()  # sample rows at most
    chosen, lines = [], 0
    for r in sorted(places, key=lambda r: (r["hash"], r["doc_id"])):
        if lines + r["lines"] <= most_lines:
            chosen.append((r["doc_id"], r["hash"]))
            lines += r["lines"]
    if not chosen:
        return Model(np.zeros(3 * FEATURES), np.zeros((2, 2)), known=False)
    taken = F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long, _hash long"))
    texts = one.join(taken, ["doc_id"]).filter(F.xxhash64("text") == F.col("_hash"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, size, counts = features(batch.column(0).to_pylist())
            ends = np.cumsum(counts)
            rows = [(x[e - n : e].astype(np.float32).tobytes(), size[e - n : e].astype(np.int64).tobytes()) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), batch.column(2)], ["label", "x", "size", "doc_id"])

    described = texts.select("text", "_label", "doc_id").mapInArrow(describe, "label int, x binary, size binary, doc_id long")
    found = described.groupBy("doc_id").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.first("size").alias("size")).collect()  # equal texts are one; most_lines rows of features
    found.sort(key=lambda r: (r["label"], bytes(r["x"]), r["doc_id"]))
    sizes = [np.frombuffer(r["size"], np.int64) for r in found]
    x = np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, 3 * FEATURES) for r in found]).astype(float)
    return fit(x, np.concatenate(sizes), np.array([len(s) for s in sizes]), np.array([r["label"] for r in found]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = [model.scores(texts[s]) for s in blocks([len(t) for t in texts], 1_000_000)]
            all_scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(all_scores, pa.float64()), pa.array((all_scores >= 0.3).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), blank_as_empty().alias("text"))
    return wanted.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
