"""Operator 6: near-dedup by b-bit MinHash.

Each document's set of word shingles gives BANDS * ROWS minima.  Bands of full
minima make buckets; the low BITS of each minimum, packed into longs, estimate
similarity by bit counts, corrected for chance collisions; pairs whose estimate
is near the threshold or over it are confirmed on the full sets.  Documents with
equal sets are one candidate.  A bucket emits no more than a star of pairs to
its smallest member, and components are built from the confirmed ones.  Buckets
that still hold several components draw another hub; of what is then open, members outside their family's largest component are compared with
all of it, in blocks.

At the threshold 0.8 a pair misses all 40 bands of 6 rows with probability 5e-6;
the margin of the estimate is over 5 standard deviations.

Members of a large bucket, component or family are dealt to several tasks wherever
they meet its row.

Null text counts as empty; documents without words are linked with nothing and
are their own component.  Repeated rows are copies of each other.  Components
are named by their smallest doc_id that isn't null.  An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import blank_as_empty, release, salted_join, scratch, spread_join, staged, temporary, with_rows
from .components import components
from .tokens import blocks
from .worker import lean

BANDS, ROWS, BITS = 40, 6, 4
MINIMA = BANDS * ROWS
MARGIN = 0.15
_draw = np.random.default_rng(20240607)
FACTORS = _draw.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
VALUES = _draw.integers(1, 1 << 63, 256, np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BAND_FACTORS = _draw.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: xor-shifts and odd factors."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b)])) for b in (BASE, inverse))
        return self.up[:n], self.down[:n]


_powers = Powers()


def shingle_sets(texts: list[str], size: int = 4) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct word shingles; with fewer
    words than size, of the whole sequence."""
    raw = [t.encode() for t in texts]
    data = LOWER[np.frombuffer(b" ".join([*raw, b""]), np.uint8)]
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in texts]
    up, down = _powers.upto(len(data) + 1)
    word = ~SPACE[data]
    edges = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[data] * up[:-1])])
    hashes = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    bounds = np.searchsorted(first, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]))
    found = []
    n = len(hashes) - size + 1
    shingles = hashes[: max(n, 0)].copy()
    for k in range(1, size):
        shingles = mixed(shingles) + hashes[k : k + max(n, 0)]
    shingles = mixed(shingles)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            found.append(np.unique(shingles[a : b - size + 1]))
        elif b > a:
            h = hashes[a : a + 1].copy()
            for k in range(a + 1, b):
                h = mixed(h) + hashes[k : k + 1]
            found.append(mixed(h + np.uint64(b - a)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(MINIMA, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[at : at + 1024, None] * FACTORS).min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, after mixing, 64 // BITS to a long."""
    low = (mixed(least) & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def signed(docs: DataFrame, size: int) -> DataFrame:
    """docs: _row, doc_id, text.  Adds n, set_key, bands, bits; drops the text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            sizes, keys, bands, bits = [], [], [], []
            for s in blocks([len(t) for t in texts], 500_000):
                for shingles in shingle_sets(texts[s], size):
                    sizes.append(len(shingles))
                    keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    if len(shingles):
                        least = minima(shingles)
                        bands.append(mixed((mixed(least).reshape(BANDS, ROWS) * BAND_FACTORS).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64))
                        bits.append(packed(least).view(np.int64))
                    else:
                        bands.append(np.zeros(0, np.int64))
                        bits.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                ["_row", "doc_id", "n", "set_key", "bands", "bits"],
            )

    return docs.mapInArrow(lean(sign), "_row long, doc_id long, n long, set_key binary, bands array<long>, bits array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed low bits: equal minima less those equal by chance."""
    lanes = sum(1 << k for k in range(0, 64, BITS))
    mask = F.lit(lanes - (1 << 64) if lanes >= 1 << 63 else lanes)

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for k in (1, 2):  # a lane's lowest bit gets the disjunction of its four
            d = d.bitwiseOR(F.shiftrightunsigned(d, k))
        return F.bit_count(d.bitwiseAND(mask))

    off = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    return ((1 - off / MINIMA) - chance) / (1 - chance)


def sets_of(docs: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """_row, shingles: the full sets of the rows, as sorted 64-bit hashes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s in blocks([len(t) for t in texts], 500_000):
                own = [x.tobytes() for x in shingle_sets(texts[s], size)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, len(own)), pa.array(own, pa.binary())], ["_row", "shingles"])

    return docs.join(rows, "_row", "left_semi").select("_row", "text").mapInArrow(lean(read), "_row long, shingles binary")


def confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs: a, b, without repeats.  Those that the estimate doesn't rule out and
    for which 100 * intersection >= percent * union."""
    sides = [reps.select(F.col("_row").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab"]
    likely = pairs.join(sides[0], "a").join(sides[1], "b")
    likely = likely.filter((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (estimate(F.col("bits_a"), F.col("bits_b")) >= percent / 100 - MARGIN))
    likely = staged(likely.select("a", "b"), "likely")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            links = []
            for i in range(len(a)):
                p, q = np.frombuffer(x[i], np.uint64), np.frombuffer(y[i], np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    links.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in links], pa.int64()), pa.array([b[i] for i in links], pa.int64())], ["a", "b"])

    left, right = (sets.select(F.col("_row").alias(s), F.col("shingles").alias(f"shingles_{s}")) for s in "ab")
    with_sets = likely.join(left, "a").join(right, "b").select("a", "b", "shingles_a", "shingles_b")
    return staged(with_sets.mapInArrow(lean(compare), "a long, b long"), "linked")


def still_open(members: DataFrame, links: DataFrame) -> DataFrame:
    """members: key, rep.  Those of keys whose members lie in several components,
    with component and the key's largest one.  One round of labels does: a part of a
    component counts as one of its own."""
    labels = components(links, rounds=1)
    labelled = staged(members.join(labels, members["rep"] == labels["node"], "left").select("key", "rep", F.coalesce("component", "rep").alias("component")), "labelled")
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("size"))
    several = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component", F.struct("size", "component")).alias("largest")).filter("parts > 1").select("key", "largest")
    return staged(spread_join(labelled, several, "key", "rep"), "open")


def hub_pairs(members: DataFrame, seed: int) -> DataFrame:
    """One drawn member of each key with those of other components."""
    drawn = members.groupBy("key").agg(F.min_by(F.struct("rep", "component"), F.xxhash64("rep", "key", F.lit(seed))).alias("hub"))
    met = spread_join(members, drawn, "key", "rep").filter(F.col("component") != F.col("hub.component"))
    return met.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b."""
    owner_b = np.repeat(np.arange(len(b)), [len(x) for x in b])
    all_b = np.concatenate(b)
    order = np.argsort(all_b, kind="stable")
    all_b, owner_b = all_b[order], owner_b[order]
    owner_a, all_a = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.concatenate(a)
    low, high = np.searchsorted(all_b, all_a, "left"), np.searchsorted(all_b, all_a, "right")
    times = high - low
    ends = np.cumsum(times)
    at = np.arange(ends[-1]) + np.repeat(low - (ends - times), times)
    return np.bincount(np.repeat(owner_a, times) * len(b) + owner_b[at], minlength=len(a) * len(b)).reshape(len(a), len(b))


def block_links(few: list[dict], others: list[dict], percent: int) -> list[tuple[int, int]]:
    """For each set of few a linked one of each other component among others."""
    sides = [[np.frombuffer(m["shingles"], np.uint64) for m in side] for side in (few, others)]
    sizes = np.array([len(x) for x in sides[1]])
    of = np.array([m["component"] for m in others])
    out = []
    chunks = blocks([len(x) for x in sides[0]], 8192)
    for chunk in chunks:
        shared = common(sides[0][chunk], sides[1])
        for k, both in enumerate(shared, chunk.start):
            near = 100 * both >= percent * (len(sides[0][k]) + sizes - both)
            hits = np.flatnonzero(near & (of != few[k]["component"]))
            _, first = np.unique(of[hits], return_index=True)
            out += [(min(few[k]["rep"], others[j]["rep"]), max(few[k]["rep"], others[j]["rep"])) for j in hits[first].tolist()]
    return out


def rest_of_links(opened: DataFrame, sets: DataFrame, percent: int, block_bytes: int = 512 << 10) -> DataFrame:
    """What hubs left apart, exactly.  Members that buckets connect are a family; its
    members outside its largest component meet all of it, in blocks of sets that
    are dealt out one by one, so neither a task nor a row grows with the family."""
    least = opened.groupBy("key").agg(F.min("component").alias("a"))  # linked members stand for one
    families = components(spread_join(opened.select("key", "rep", F.col("component").alias("b")), least, "key", "rep").filter("a <> b").select("a", "b").distinct())
    members = spread_join(opened.select("rep", "component").distinct(), families.select(F.col("node").alias("component"), F.col("component").alias("family")), "component", "rep")
    members = members.join(sets.select(F.col("_row").alias("rep"), "shingles"), "rep")
    members = staged(members, "family-members")
    parts = members.groupBy("family", "component").agg(F.count("*").alias("size"), F.sum(F.octet_length("shingles") + 64).alias("bytes"))
    totals = staged(parts.groupBy("family").agg(F.max_by("component", F.struct("size", "component")).alias("largest"), F.ceil(F.sum("bytes") / block_bytes).alias("blocks")), "families")
    placed = spread_join(members, totals, "family", "rep").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    gathered = F.collect_list(F.struct("rep", "component", "shingles"))
    everyone = placed.groupBy("family", "block").agg(gathered.alias("others"))
    few = placed.filter("component <> largest").groupBy("family", "block", "blocks").agg(gathered.alias("few"))
    met = few.select("family", "few", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")).join(everyone, ["family", "block"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                links = block_links(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), percent)
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    return staged(met.select("few", "others").mapInArrow(lean(compare), "a long, b long"), "rest-linked")


HUB_ROUNDS = 1  # what it leaves is compared in blocks


def members_of(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """_row, doc_id, n_shingles, component (null without words) of each row of docs."""
    spark = docs.sparkSession
    docs = docs.select("_row", F.col("doc_id").cast("long").alias("doc_id"), blank_as_empty().alias("text"))
    all_signed = staged(signed(docs, size), "signed")
    classes = staged(all_signed.filter("n > 0").groupBy("set_key").agg(F.min("_row").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = staged(all_signed.join(classes.select(F.col("rep").alias("_row")), "_row", "left_semi"), "reps")
    keys = reps.select(F.col("_row").alias("rep"), F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    shared = staged(salted_join(keys, staged(hubs, "hubs"), "key", "members", "rep").select("key", "rep", "hub"), "buckets")  # buckets of two and more
    release(spark)
    sets = staged(sets_of(docs, shared.select(F.col("rep").alias("_row")).distinct(), size), "sets")
    release(spark)
    tested = staged(shared.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "stars")
    links = confirmed(tested, reps, sets, percent)
    opened = still_open(shared.select("key", "rep"), links)
    for seed in range(HUB_ROUNDS):  # linear in the buckets' members; nearly all that is linked comes together here
        pairs = staged(hub_pairs(opened, seed).join(tested, ["a", "b"], "left_anti"), "hub-pairs")
        if not pairs.limit(1).count():
            break
        tested, links = tested.unionByName(pairs), links.unionByName(confirmed(pairs, reps, sets, percent))
        opened = still_open(opened.select("key", "rep"), links)
        release(spark)
    if opened.limit(1).count():
        links = links.unionByName(rest_of_links(opened, sets, percent))
        release(spark)
    labels = components(links)
    of = staged(classes.join(labels, classes["rep"] == labels["node"], "left").select("set_key", "copies", F.coalesce("component", "rep").alias("component")), "class-components")
    rows = all_signed.select("_row", "doc_id", F.col("n").alias("n_shingles"), "set_key")
    with_words = salted_join(rows.filter("n_shingles > 0"), of, "set_key", "copies", "_row").drop("set_key", "copies")
    return with_words.unionByName(rows.filter("n_shingles = 0").drop("set_key").withColumn("component", F.lit(None).cast("long")))


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """_row, doc_id, n_shingles, component_id, kept for each row of docs, which has
    _row (unique), doc_id and text.  kept by doc_id; first: by row, so that of a
    component one row is first."""
    spark = docs.sparkSession
    path = scratch(spark, "members")
    with temporary(spark):
        members_of(docs, size, percent).write.parquet(path)
    release(spark)
    named = spark.read.parquet(path)
    heads = named.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("head"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("best"), F.count("*").alias("size"))
    heads = staged(heads.select("component", "head", F.col("best._row").alias("head_row"), "size"), "heads")
    alone = named.filter(F.col("component").isNull()).select("*", F.lit(None).cast("long").alias("head"), F.lit(None).cast("long").alias("head_row"))
    out = salted_join(named.filter(F.col("component").isNotNull()), heads, "component", "size", "_row").drop("size").unionByName(alone)
    component_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("head"))
    return out.select(
        "_row",
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(False)).alias("kept"),
        F.coalesce(F.col("_row") == F.col("head_row"), F.lit(True)).alias("first"),
    )


def near_dedup_documents(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    return near_dedup(with_rows(documents, "documents", "doc_id", "text"), size, percent)
