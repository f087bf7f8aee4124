"""Entities: grouping of mentions, fuzzy merge, pruning, links and ids."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.labels import uuid5

NAMESPACE = uuid.UUID("5a1c9f3e-7f0b-4c52-9d0e-2b8c6f4a1d37")


def grouped(mentions: DataFrame, key: list[str], canonical: str, confidence: str, order: list[str]) -> DataFrame:
    """canonical of the surest mention, the first on a tie; mentions; confidence."""
    return mentions.groupBy(*key).agg(
        F.min_by(canonical, F.struct(-F.col(confidence), *order)).alias("canonical"),
        F.count("*").alias("mentions"),
        F.max(confidence).alias("confidence"),
    )


def entity_id(kind: Column, plain: Column) -> Column:
    return uuid5(NAMESPACE, F.concat_ws("\x1f", kind, plain))


def pruned(entities: DataFrame, floor: float = 0.55) -> DataFrame:
    """Without those that a single unsure mention makes."""
    return entities.filter((F.col("mentions") > 1) | (F.col("confidence") >= floor))


def unrepeated(name: Column) -> Column:
    """'a b a b' is 'a b'."""
    return F.regexp_replace(name, r"(?i)^(.+?)(?: \1)+$", "$1")


def fuzzy_candidates(names: DataFrame, key: list[str], name: str, order: str, threshold: float = 0.78, least: int = 4) -> DataFrame:
    """Pairs of a key whose lengths alone don't rule out the ratio: twice the
    shorter is at least threshold of the sum.
    The earlier of a pair is a."""
    n = F.length(name)
    long = names.filter(n >= least).select(*key, F.col(name).alias("name"), F.col(order).alias("ord"))
    # lengths within the bound lie in neighbouring bands, so the join is by band, not all against all
    ratio = (2 - threshold) / threshold
    band = F.floor(F.log(F.length("name")) / F.log(F.lit(ratio)))
    a = long.select(*key, F.col("name").alias("a"), F.col("ord").alias("ord_a"), F.explode(F.array(band - 1, band, band + 1)).alias("band"))
    b = long.select(*key, F.col("name").alias("b"), F.col("ord").alias("ord_b"), band.alias("band"))
    bound = 2 * F.least(F.length("a"), F.length("b")) >= threshold * (F.length("a") + F.length("b"))
    return a.join(b, [*key, "band"]).filter((F.col("ord_a") < F.col("ord_b")) & bound).drop("band")


def fuzzy_pairs(names: DataFrame, key: list[str], name: str, order: str, threshold: float = 0.78) -> DataFrame:
    """Candidates whose similarity reaches the threshold."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            score = [kernels.similarity(a, b) for a, b in zip(rows["a"], rows["b"], strict=True)]
            yield rows.assign(ratio=score)[[s >= threshold for s in score]]

    found = fuzzy_candidates(names, key, name, order, threshold)
    return found.mapInPandas(near, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", ratio double")


def cut_off(df: DataFrame) -> DataFrame:
    """A checkpoint in the session's folder; where none is set, as in tests, kept in memory."""
    return df.checkpoint() if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df.persist()


def fuzzy_merged(names: DataFrame, key: list[str], name: str, order: str, mentions: str, threshold: float = 0.78, rounds: int = 100) -> DataFrame:
    """representative of each name: of its component, the most mentioned, the first on
    a tie.  Smallest labels with pointer jumping, until none changes; an error if so
    many rounds don't do."""
    pairs = fuzzy_pairs(names, key, name, order, threshold).select(*key, "ord_a", "ord_b")
    pairs = cut_off(pairs)
    both = pairs.unionByName(pairs.select(*key, F.col("ord_b").alias("ord_a"), F.col("ord_a").alias("ord_b")))
    labels = names.select(*key, F.col(order).alias("ord"), F.col(order).alias("label"))
    for _ in range(rounds):
        near = both.join(labels, [both[k] == labels[k] for k in key] + [both["ord_b"] == labels["ord"]]).select(*[both[k] for k in key], both["ord_a"].alias("ord"), "label")
        lower = near.groupBy(*key, "ord").agg(F.min("label").alias("near"))
        joined = cut_off(labels.join(lower, [*key, "ord"], "left").select(*key, "ord", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("label")))
        up = joined.select(*key, F.col("ord").alias("label"), F.col("label").alias("above"))
        jumped = cut_off(joined.join(up, [*key, "label"]).select(*key, "ord", "was", F.least("label", "above").alias("label")))
        labels = jumped.select(*key, "ord", "label")
        if not jumped.filter("was <> label").limit(1).count():
            break
    else:
        raise RuntimeError(f"names still change components after {rounds} rounds")
    named = names.join(labels.withColumnRenamed("ord", order), [*key, order])
    best = Window.partitionBy(*key, "label").orderBy(F.desc(mentions), order)
    return named.withColumn("representative", F.first(name).over(best)).drop("label")


def linked(names: DataFrame, catalogue: DataFrame, name: str) -> DataFrame:
    """person_id: the first in catalogue order whose full name equals, or all of
    whose surname words occur.  catalogue: person_id, cat_ord, full, surname.  By
    words, so no name meets the whole catalogue."""
    words = names.select(name, F.explode(F.array_distinct(F.split(F.lower(F.col(name)), " "))).alias("word")).distinct()
    sur = catalogue.withColumn("parts", F.array_distinct(F.split(F.lower("surname"), " "))).withColumn("size", F.size("parts"))
    hit = words.join(sur.select("person_id", "cat_ord", "size", F.explode("parts").alias("word")), "word").groupBy(name, "person_id", "cat_ord", "size").agg(F.count("*").alias("k")).filter("k = size")
    full = names.select(name).distinct().join(catalogue.select("person_id", "cat_ord", F.lower("full").alias("_full")), F.lower(F.col(name)) == F.col("_full")).select(name, "person_id", "cat_ord")
    first = hit.select(name, "person_id", "cat_ord").unionByName(full).groupBy(name).agg(F.min_by("person_id", "cat_ord").alias("person_id"))
    return names.join(first, name, "left")


def mention_ids(mentions: DataFrame, entity: str, order: str) -> DataFrame:
    """<entity>-m<k>, k from 1 in document order."""
    k = F.row_number().over(Window.partitionBy(entity).orderBy(order))
    return mentions.withColumn("mention_id", F.concat(F.col(entity).cast("string"), F.lit("-m"), k.cast("string")))


def mention_links(mentions: DataFrame, entity: str, mention: str, order: str, first_fragment: Column) -> DataFrame:
    """The mentions of each entity in order, without fragments that go on."""
    links = F.transform(F.array_sort(F.collect_list(F.struct(order, mention))), lambda s: s[mention])
    return mentions.filter(first_fragment).groupBy(entity).agg(links.alias("mentions"))


def first_seen(rows: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """Distinct values of a key in the order first seen, as for tagsets used."""
    each = rows.groupBy(*key, value).agg(F.min(order).alias("_at"))
    return each.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", value))), lambda s: s[value]).alias("values"))
