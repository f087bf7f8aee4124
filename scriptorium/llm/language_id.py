"""Operator 9: language by known words, backing off to shorter character n-grams.

Training counts words and character n-grams by language in each task, sums them, and
keeps of each language the most frequent, `items` of all languages together, so the
model's size is bounded whatever the corpus.  It is fitted on a sample of labelled
rows: about docs_per_language of each language, all of a rarer one, so no language
is left out.  A known word scores the log of its relative frequency in each
language.  An unseen word is scored by its n-grams of the greatest length of which
any is known, each step down at a cost; a document by the sum over its words.

A word is a run of letters (Unicode category L).  Null text, and text without a
letter, is `und` with score 0.  Repeated rows get the same answer each; ties between
languages go to the first in alphabetical order.  Without any labelled row every text
is `und`.  Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .base import staged
from .tokens import blocks
from .worker import kept, lean

#: Word characters that are neither letters nor decimal digits, such as ½ and ①; as part
#: of the pattern they would make it many times slower.
NUMBERS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
BLANKED = dict.fromkeys(map(ord, NUMBERS), " ")
LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 5
MOST_LANGUAGES = 10_000  # a value a row is no language; their table is broadcast, so that texts stay where they are
UNDETERMINED = "und"


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, in small letters."""
    if not text.isascii() and not NUMBERS.isdisjoint(text):
        text = text.translate(BLANKED)
    return LETTERS.findall(text.lower())


def crc_of(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def train(labelled: DataFrame, docs_per_language: int = 1500, items: int = 300_000) -> dict:
    """labelled: text, lang, and _draw, a number from 0 to 2**32 - 1 by which about
    docs_per_language rows of each language are drawn; the bounds hold for the fit alone."""
    labelled = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = staged(labelled.groupBy("lang").agg(F.count("*").alias("_docs")), "lang-sizes")
    if sizes.count() > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    share = F.least(F.lit(1.0), docs_per_language / F.col("_docs"))
    drawn = labelled.join(F.broadcast(sizes), "lang").filter(F.col("_draw") < F.floor(F.lit(2.0**32) * share))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter[str]] = defaultdict(Counter)
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found[lang].update(words_of(text))
        rows: list[tuple[str, int, str, int]] = []
        for lang, own in found.items():
            by_length: Counter[tuple[int, str]] = Counter()
            for word, k in own.items():
                for size in range(1, LONGEST + 1):
                    for g in grams(word, size):
                        by_length[size, g] += k
            rows += [(lang, 0, w, k) for w, k in own.items()]
            rows += [(lang, size, g, k) for (size, g), k in by_length.items()]
        for at in range(0, len(rows), 100_000):
            part = rows[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.int64()))], ["lang", "size", "item", "n"])

    counted = staged(drawn.select("text", "lang").mapInArrow(lean(count), "lang string, size int, item string, n long").groupBy("lang", "size", "item").agg(F.sum("n").alias("n")), "lang-counts")
    totals = counted.groupBy("lang", "size").agg(F.sum("n").alias("total")).collect()  # six rows a language
    names = sorted({r["lang"] for r in totals})
    sums = {(r["lang"], r["size"]): r["total"] for r in totals}
    own = max(100, items // max(1, len(names)))  # of a language: two fifths for words, as they are asked first
    best = Window.partitionBy("lang", F.col("size") == 0).orderBy(F.desc("n"), "size", "item")
    most = counted.select("*", F.row_number().over(best).alias("rank")).filter(F.col("rank") <= F.when(F.col("size") == 0, own * 2 // 5).otherwise(own - own * 2 // 5))
    items_ = most.select("lang", "size", "item", "n").collect()  # items rows, or 100 a language
    place = {lang: k for k, lang in enumerate(names)}
    return {
        "languages": names,
        "sums": sums,
        "items": "\n".join(r["item"] for r in items_),  # letters and <>: one text is far smaller than its parts
        "lang": np.array([place[r["lang"]] for r in items_], np.int32),
        "size": np.array([r["size"] for r in items_], np.int8),
        "n": np.array([r["n"] for r in items_], np.int64),
    }


class Scorer:
    """Scores texts by a model.  Arrow splits and numbers their tokens between blanks, so
    that each different token is taken apart once; at most max_tokens are remembered."""

    STEP = 0.4  # the cost in log units of each shorter n-gram length, as in stupid backoff
    FLOOR = 0.5  # the count that an item has in a language without it

    def __init__(self, model: dict, max_tokens: int = 300_000):
        self.languages, self.max_tokens = model["languages"], max_tokens
        items = model["items"].split("\n") if len(model["n"]) else []
        self.tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        for size, item in zip(model["size"].tolist(), items, strict=True):
            self.tables[size].setdefault(item, len(self.tables[size]))
        self.logs = []
        for size, known in enumerate(self.tables):
            floor = [np.log(self.FLOOR / max(1, model["sums"].get((lang, size), 1))) for lang in self.languages]
            self.logs.append(np.tile(np.array(floor, np.float32), (len(known), 1)))
        for lang, size, item, n in zip(model["lang"].tolist(), model["size"].tolist(), items, model["n"].tolist(), strict=True):
            self.logs[size][self.tables[size][item], lang] = np.log(n / model["sums"][self.languages[lang], size])
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.languages)))
        self.words = np.zeros(0, np.int64)
        self.taken_apart: dict[str, np.ndarray] = {}  # words, of which many tokens differ only in signs around them

    def word(self, word: str) -> np.ndarray:
        at = self.tables[0].get(word)
        if at is not None:
            return self.logs[0][at]
        for size in range(LONGEST, 0, -1):
            known = [k for k in map(self.tables[size].get, grams(word, size)) if k is not None]
            if known:
                return self.logs[size][known].mean(axis=0) - np.float32(self.STEP * np.log(10) * (LONGEST + 1 - size))
        return np.zeros(len(self.languages), np.float32)

    def learn(self, tokens: list[str]) -> None:
        """The sums of the words of new tokens, and how many words each has."""
        found = [words_of(t) for t in tokens]
        rows = np.zeros((len(tokens), len(self.languages)))
        for k, words in enumerate(found):
            for w in words:
                row = self.taken_apart.get(w)
                if row is None:
                    row = self.taken_apart[w] = self.word(w)
                rows[k] += row
        self.rows = np.concatenate([self.rows, rows])
        self.words = np.concatenate([self.words, np.array([len(w) for w in found], np.int64)])
        self.index.update(zip(tokens, range(len(self.index), len(self.index) + len(tokens)), strict=True))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sum of each text's words by language, and how many words it has."""
        split = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
        coded = split.flatten().dictionary_encode()
        tokens, sizes = coded.dictionary.to_pylist(), np.diff(split.offsets.to_numpy()).astype(np.int64)
        if self.index and len(self.index) + len(tokens) > self.max_tokens:
            self.forget()
        self.learn([t for t in tokens if t not in self.index])
        at = np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))[coded.indices.to_numpy()] if tokens else np.zeros(0, np.int64)
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            sums[some] = np.add.reduceat(self.rows[at], starts, axis=0)
            counts[some] = np.add.reduceat(self.words[at], starts)
        return sums, counts

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        sums, counts = self.scores(texts)
        mean = sums / np.maximum(1, counts)[:, None]
        best = mean.argmax(axis=1)
        weight = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(counts, 20)[:, None])
        sure = weight.max(axis=1) / weight.sum(axis=1)
        return [self.languages[b] if n else UNDETERMINED for b, n in zip(best, counts, strict=True)], [float(s) if n else 0.0 for s, n in zip(sure, counts, strict=True)]


def scorer_of(key: str, model: Broadcast) -> Scorer:
    """One for each Python worker, which keeps it from task to task."""
    return kept(key, lambda: Scorer(model.value))


def identify(docs: DataFrame, model: dict, *columns: Column | str, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns of each document, or all of them, with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # `items` of `train` at most
    wanted = docs.select(*columns, F.col("text").alias("_text")) if columns else docs
    at, width = (len(columns), len(columns)) if columns else (docs.columns.index("text"), len(docs.columns))
    key = f"scorer {uuid.uuid4().hex}"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(key, shared)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            langs: list[str] = []
            scores: list[float] = []
            for s in blocks([len(t) for t in texts], 1_000_000):
                a, b = scorer.predict(texts[s])
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names[:width], *names])

    schema = StructType(wanted.schema.fields[:width]).add(names[0], StringType()).add(names[1], DoubleType())
    return wanted.mapInArrow(lean(predict, key), schema)


def trained_on(docs: DataFrame, held_out: int = 2) -> dict:
    """A model of the documents whose crc32(doc_id as text) mod 4 is not held_out;
    the sample is drawn by other bits of a hash of doc_id."""
    usable = docs.filter(F.coalesce(F.pmod(crc_of(), F.lit(4)) != held_out, F.lit(False)))
    return train(usable.select("text", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(2**32)).alias("_draw")))
