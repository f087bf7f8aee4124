"""Text made of spans and back: joined texts, offset maps, segments on lines."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ..functions.text import PLAIN, SOFT
from .order import islands

SEGMENT = StructType().add("start", IntegerType()).add("stop", IntegerType()).add("lang", StringType())
CLEANED = StructType().add("text", StringType()).add("origin", ArrayType(IntegerType()))


def joined(lines: DataFrame, key: list[str], order: str, text: str, separator: str = " ") -> DataFrame:
    """Where each line begins and ends in its container's lines joined by one separator."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(text) + len(separator)).over(w), F.lit(0)).cast("int")
    return lines.withColumn("start", start).withColumn("stop", (F.col("start") + F.length(text)).cast("int"))


def on_lines(segments: DataFrame, lines: DataFrame, key: list[str], order: str) -> DataFrame:
    """The part of each segment (from, to in the joined text) on each line, in the
    line's own offsets.  lines come from `joined`."""
    met = lines.select(*key, order, "start", "stop").join(segments, key).filter((F.col("from") < F.col("stop")) & (F.col("to") > F.col("start")))
    return met.select(*key, order, (F.greatest("from", "start") - F.col("start")).cast("int").alias("a"), (F.least("to", "stop") - F.col("start")).cast("int").alias("b"), "lang")


def spliced_segments(text: str, segments: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Segments in order inside the text; one that overlaps the one before begins at
    its next whole word, or goes if none is left."""
    out, end = [], 0
    for a, b, lang in sorted(segments):
        a, b = max(0, a), min(b, len(text))
        if a < end:
            a = end
            while a < b and not text[a - 1].isspace():
                a += 1
        if a < b:
            out.append((a, b, lang))
            end = b
    return out


@F.pandas_udf(ArrayType(SEGMENT))
def spliced(text: pd.Series, segments: pd.Series) -> pd.Series:
    return pd.Series([[{"start": a, "stop": b, "lang": g} for a, b, g in spliced_segments(t or "", [(s["a"], s["b"], s["lang"]) for s in ([] if found is None else found)])] for t, found in zip(text, segments, strict=True)])


def separators(spans: DataFrame, key: list[str], order: str, line: str) -> DataFrame:
    """gap: one blank before a span whose line isn't that of the span before."""
    w = Window.partitionBy(*key).orderBy(order)
    return spans.withColumn("gap", F.when(F.lag(line).over(w) != F.col(line), F.lit(" ")).otherwise(F.lit("")))


def flat_text(tokens: Column) -> Column:
    """Words and signs as text.  tokens: array of struct(form, joins), joins being
    left for a sign that follows its word, right for one that the next word follows."""
    step = lambda s, t: F.struct(
        F.concat(s["text"], F.when((s["text"] == "") | s["tight"] | (t["joins"] == "left"), F.lit("")).otherwise(F.lit(" ")), t["form"]).alias("text"),
        F.coalesce(t["joins"] == "right", F.lit(False)).alias("tight"),
    )
    plain = F.transform(tokens, lambda t: F.struct(t["form"].alias("form"), F.coalesce(t["joins"], F.lit("")).alias("joins")))
    return F.aggregate(plain, F.struct(F.lit("").alias("text"), F.lit(False).alias("tight")), step, lambda s: s["text"])


def dehyphenated_spans(spans: Column) -> Column:
    """struct(text, cuts) of an array of texts: a mark at a span's end goes with the
    blanks around it, joining the words; cuts are the offsets where that was done."""
    step = lambda s, t: F.struct(
        F.when(s["broken"], F.concat(F.regexp_replace(s["text"], rf"[{SOFT}-]\s*$", ""), F.ltrim(t))).otherwise(F.concat(s["text"], t)).alias("text"),
        F.when(s["broken"], F.concat(s["cuts"], F.array(F.length(F.regexp_replace(s["text"], rf"[{SOFT}-]\s*$", ""))))).otherwise(s["cuts"]).alias("cuts"),
        t.rlike(rf"[{SOFT}-]\s*$").alias("broken"),
    )
    return F.aggregate(spans, F.struct(F.lit("").alias("text"), F.array().cast("array<int>").alias("cuts"), F.lit(False).alias("broken")), step, lambda s: F.struct(s["text"].alias("text"), s["cuts"].alias("cuts")))


def cleaned_with_origin(text: str) -> tuple[str, list[int]]:
    """The plain form of an old text in composed letters, and for each of its letters
    the place in the composed input that it came from."""
    s = unicodedata.normalize("NFC", text)
    out: list[str] = []
    origin: list[int] = []
    i, n = 0, len(s)
    while i < n:
        c = s[i]
        if c in "|¦":
            i += 1
            continue
        if c in (SOFT, "-"):
            j = i + 1
            while j < n and s[j].isspace():
                j += 1
            if j > i + 1 and j < n and out and out[-1].isalpha() and s[j].isalpha() or c == SOFT and j == i + 1 and j < n and s[j].isalpha():
                i = j
                continue
            if c == SOFT:
                i += 1
                continue
        if c.isspace():
            if out and out[-1] != " ":
                out.append(" ")
                origin.append(i)
            i += 1
            continue
        inner = bool(out) and out[-1].isalpha()
        if c in PLAIN:
            new = PLAIN[c]
        elif c == "u" and inner and s[i : i + 2] == "uu" and i + 2 < n and s[i + 2].isalpha():
            out += ["u", "v"]
            origin += [i, i + 1]
            i += 2
            continue
        elif c in "iI" and not inner and i + 1 < n and s[i + 1] in "aeiou":
            new = "j" if c == "i" else "J"
        else:
            new = c
        out += list(new)
        origin += [i] * len(new)
        i += 1
    if out and out[-1] == " ":
        out.pop()
        origin.pop()
    return "".join(out), origin


@F.pandas_udf(CLEANED)
def cleaned_map(text: pd.Series) -> pd.DataFrame:
    found = [cleaned_with_origin(t or "") for t in text]
    return pd.DataFrame({"text": [t for t, _ in found], "origin": [o for _, o in found]})


def language_blocks(spans: DataFrame, key: list[str], order: str, lang: str, text: str) -> DataFrame:
    """Runs of spans in one language, with their text and offsets."""
    runs = islands(joined(spans, key, order, text, ""), key, [order], [lang])
    return runs.groupBy(*key, "island", lang).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda s: s[text]), "").alias("block"))


def adjacent_runs(words: DataFrame, key: list[str], position: str) -> DataFrame:
    """A mention's words split where a word is missing between them."""
    w = Window.partitionBy(*key).orderBy(position)
    group = F.col(position) - F.row_number().over(w)
    return words.withColumn("_g", group).groupBy(*key, "_g").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("n")).drop("_g")
