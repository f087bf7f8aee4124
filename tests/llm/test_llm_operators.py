"""Each operator against a brute-force version on a small table that holds nulls,
empty and long texts, ties, repeated rows and columns with clashing names; and on
an empty one."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scriptorium.llm import avi, language_id, length_histogram, line_crf, media, minhash, mixing, packing, queries, sharding, suffix_dedup, tokens
from scriptorium.llm.base import salted_join, staged, with_rows
from scriptorium.llm.exact_dedup import DigestIndex, exact_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, key string, n int, _tokens int, shard int, digest string"
VOCABULARY = [f"{a}{b}" for a in ("tha", "ion", "ser", "mol", "ket", "vri") for b in ("en", "or", "us", "it", "alé", "ß")]


def made_up():
    r = random.Random(7)
    prose = lambda n: " ".join(r.choices(VOCABULARY, k=n))
    texts = [prose(n) for n in (1, 2, 3, 4, 5, 30, 60, 90, 200, 400)]
    texts += [texts[5] + " " + texts[5], texts[6].upper(), texts[6].replace(" ", "\t\n"), texts[7] + " zusatz", "", " \n\t", None, None, "…!!! 123", "a" * 900, texts[8], texts[8]]
    passage = prose(60)
    texts += [prose(20) + " " + passage + " " + prose(k) for k in (5, 9, 0)]
    base = prose(100).split()
    for k in range(12):
        words = list(base)
        for i in r.sample(range(100), k // 2):
            words[i] = r.choice(VOCABULARY)
        texts.append(" ".join(words))
    texts.append("\n".join(prose(12) for _ in range(800)))  # long
    rows = [(k, t, r.choice(["en", "fr", None]), r.choice(["src0", "src0", "src1", None]), len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, texts[7], "en", None, 3), (None, None, None, None, None)]
    return [(*x, "x", "y", 1, 2, 3, "z") for x in rows]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(made_up(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def listed(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_exact_dedup(spark, docs, empty):
    found = exact_dedup(docs, DigestIndex(spark)).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    groups = defaultdict(list)
    digest = lambda t: hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", t).encode()).hexdigest()
    for i, t in rows:
        groups[digest(t)].append((-len(t), i is None, i or 0))
    assert len(found) == len(rows)
    for r in found:
        best = min(groups[r["text_sha256"]])
        assert r["group_size"] == len(groups[r["text_sha256"]]) and r["keep_id"] == (None if best[1] else best[2])
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert kept == Counter(dict.fromkeys(groups, 1))
    assert exact_dedup(empty, DigestIndex(spark)).count() == 0


def test_digest_index_keeps_batches(spark, docs):
    index = DigestIndex(spark, buckets=3)
    first = exact_dedup(docs.filter("doc_id < 12"), index).filter("kept").count()
    size = index.read().count()
    again = exact_dedup(docs.filter("doc_id < 12"), index)
    assert first == size and again.filter("kept").count() == 0 and index.read().count() == size
    other = DigestIndex(spark, index.path, 3)  # the same files, as by a later session
    new = exact_dedup(docs, other).filter("kept").count()
    assert other.read().count() == size + new
    assert other.read().count() == other.read().select("digest").distinct().count() > size


def test_a_repeated_batch_keeps_the_same_texts(spark, docs):
    index = DigestIndex(spark, buckets=3)
    exact_dedup(docs.filter("doc_id < 12"), index, batch="monday").count()
    first = sorted(r["text_sha256"] for r in exact_dedup(docs, index, batch="tuesday").filter("kept").collect())
    again = exact_dedup(docs.repartition(5), index, batch="tuesday").filter("kept").collect()  # as after a failure, with other row numbers
    assert first and sorted(r["text_sha256"] for r in again) == first
    assert exact_dedup(docs, index, batch="wednesday").filter("kept").count() == 0


def test_a_compacted_index_holds_the_same(spark, docs):
    index = DigestIndex(spark, buckets=2)
    for k in range(3):
        exact_dedup(docs.filter(f"doc_id % 3 = {k}"), index).count()
    before = sorted(map(tuple, index.read().collect()))
    index.compact()
    assert sorted(map(tuple, index.read().collect())) == before
    assert len(index.read().inputFiles()) <= 2
    assert sorted(map(tuple, DigestIndex(spark, index.path, 2).read().collect())) == before
    index.close(delete=True)


def test_salted_join_is_a_join(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id") % 400).alias("k"), "id")
    sizes = staged(rows.groupBy("k").agg(F.count("*").alias("n")), "sizes")
    found = salted_join(rows, sizes, "k", "n", "id")
    assert sorted(map(tuple, found.select("id", "k", "n").collect())) == sorted(map(tuple, rows.join(sizes, "k").select("id", "k", "n").collect()))


def test_written_shards_hold_every_row(spark, docs, tmp_path):
    path = str(tmp_path / "in")
    with_rows(docs, "numbered", "doc_id", "text", "shard").repartition(7).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "8k"):  # other file splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = spark.read.parquet(path)
            found = sharding.write_shards(read, str(tmp_path / size), 4000, 3)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
            written = spark.read.parquet(str(tmp_path / size))
            assert sorted(map(repr, written.select(*read.columns).collect())) == sorted(map(repr, read.collect()))
            sizes = {r["_shard"]: r["n"] for r in written.groupBy("_shard").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n")).collect()}
            assert sizes == {r["shard"]: r["n"] for r in found.groupBy("shard").agg(F.max("shard_bytes").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_shards(docs, empty):
    limit = 4000
    found = sharding.shard(docs, limit).collect()
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
    assert len(found) == docs.count()
    for rows in by.values():
        total = sum(r["n_bytes"] for r in rows)
        assert {(r["shard_bytes"], r["shard_docs"]) for r in rows} == {(total, len(rows))}
        assert total <= limit or (len(rows) == 1 and rows[0]["oversize"])
    plain = [s for s in by if "." not in s]
    for a, b in itertools.permutations(plain, 2):
        assert not b.startswith(a)  # a prefix code
    for s in plain:  # a bucket's parent didn't fit
        if s:
            parent = sum(r["n_bytes"] for t, rows in by.items() if t.startswith(s[:-1]) for r in rows)
            assert parent > limit
    assert sharding.shard(empty, limit).count() == 0


def test_shards_of_one_hash(spark):
    same = spark.createDataFrame([(1, "x" * 300)] * 50, "doc_id long, text string")
    found = sharding.shard(same, 1000).collect()
    pages = Counter(r["shard"] for r in found)
    assert len(found) == 50 and max(pages.values()) <= 3 and all("." in s for s in pages)


def test_mixing(docs, empty):
    targets = {"src0": 0.5, "src1": 0.3}, {"en": 0.5, "fr": 0.4}, {k: 1 / 8 for k in range(8)}
    measured = mixing.measured(docs.select("doc_id", "source", "lang", "text"))
    for r in measured.collect():
        words = [w for w in re.split("[ \t-\r]+", r["text"] or "") if w]
        votes = [sum(len(w) >= 5 and (ord(w[0]) + ord(w[-1])) % 8 == k for w in words) for k in range(8)]
        assert (r["_tokens"], r["_topic"]) == (len(words), votes.index(max(votes)))
    out = mixing.mixed(measured, targets, 0.5).collect()
    assert len(out) == docs.count()
    expected = sum(r["_tokens"] * r["_probability"] for r in out)
    assert abs(expected - 0.5 * sum(r["_tokens"] for r in out)) < 1
    same = defaultdict(set)
    for r in out:
        same[r["doc_id"], r["source"], r["lang"], r["_topic"]].add(r["_sampled"])
    assert all(len(v) == 1 for v in same.values())
    assert mixing.mixed(mixing.measured(empty.select("doc_id", "source", "lang", "text")), targets, 0.5).count() == 0


def test_media(docs, empty):
    stored = media.stored(docs)
    rows = {r["doc_id"]: r for r in docs.collect()}
    for r in media.read_back(stored).collect():
        payload = media.padded((rows[r["doc_id"]]["text"] or "").encode()) if r["doc_id"] is not None else None
        if payload is not None:
            assert (r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    for r in stored.filter("doc_id = 9").collect():
        assert hashlib.sha256(r["media"]).hexdigest() == media.read_back(stored).filter("doc_id = 9").first()["media_sha256"]
        assert avi.decode([r["media"]])[0][0] == media.padded(rows[9]["text"].encode())
    clips = media.clips(stored.filter("doc_id is not null")).collect()
    ends = {}
    for c in sorted(clips, key=lambda c: (c["doc_id"], c["start_s"])):
        assert c["start_s"] == pytest.approx(ends.get(c["doc_id"], 0) if c["clip"] else 0) or c["doc_id"] == 6  # which occurs three times
        ends[c["doc_id"]] = c["end_s"]
    assert media.read_back(media.stored(empty)).count() == 0


@pytest.mark.parametrize("window, hot", [(200, 100_000), (24, 100_000), (24, 2)])
def test_suffix_dedup(docs, empty, window, hot):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    times = Counter(t[s : s + window] for _, t in rows for s in range(len(t) - window + 1))
    expected = []
    for i, t in rows:
        covered = np.zeros(len(t), bool)
        for s in range(len(t) - window + 1):
            if times[t[s : s + window]] > 1:
                covered[s : s + window] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~covered])
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        expected.append((i, len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    found = listed(suffix_dedup.remove_repeats(docs, window, part_bytes=3000, hot=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == sorted(expected, key=repr)
    assert suffix_dedup.remove_repeats(empty, window).count() == 0


def brute_components(rows, size, percent):
    def shingles(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x20\x09-\x0d]+", low)
        if len(words) < size:
            return frozenset([tuple(words)]) if words else frozenset()
        return frozenset(zip(*(words[k:] for k in range(size)), strict=False))

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(k)
    out = []
    for group in members.values():
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        out += [(rows[k][0], len(sets[k]), min(ids) if ids else None, bool(ids) and rows[k][0] == min(ids)) for k in group]
    return sorted(out, key=repr), len(members)


@pytest.mark.parametrize("size", [4, 5])
def test_minhash(docs, empty, size):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected, groups = brute_components(rows, size, 80)
    found = minhash.near_dedup_documents(docs, size, 80)
    assert listed(found, "doc_id", "n_shingles", "component_id", "kept") == expected
    assert found.filter("first").count() == groups
    assert minhash.near_dedup_documents(empty, size, 80).count() == 0


def test_minhash_of_outliers_in_a_large_family(spark):
    """Copies of one text with many or few changes: what hubs miss, blocks find."""
    r = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for i in r.sample(range(120), r.choice([0, 1, 2, 3, 5, 7])):
            words[i] = f"v{k}x{i}"
        rows.append((k, " ".join(words)))
    expected, _ = brute_components(rows, 4, 80)
    found = minhash.near_dedup_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80)
    assert listed(found, "doc_id", "n_shingles", "component_id", "kept") == expected


def test_packing(docs, empty):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    whole = tokens.WordTokenizer(tokens.tokenizer_path()).whole
    ids = Counter((i, tuple([*whole.encode(t, add_special_tokens=False).ids, 1])) for i, t in rows)
    found = packing.pack(docs, with_ids=True, shard_tokens=4000).collect()
    sequences, pieces = defaultdict(int), defaultdict(list)
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        own = np.frombuffer(r["ids"], "<u2")
        assert r["length"] == len(own) > 0 and r["ids_crc32"] == zlib.crc32(own.astype("<u4").tobytes()) and r["offset"] == sequences[r["sequence_id"]]
        sequences[r["sequence_id"]] += r["length"]
        pieces[r["doc_id"]].append((r["start"], own, r["doc_tokens"]))
    assert max(sequences.values()) <= 2048
    by_id = Counter(i for (i, _), n in ids.items() for _ in range(n))
    for (i, own), _ in ids.items():
        if by_id[i] == 1:
            assert np.concatenate([x for _, x, _ in sorted(pieces[i], key=lambda p: p[0])]).tolist() == list(own) and {p[2] for p in pieces[i]} == {len(own)}
    assert sum(sequences.values()) == sum(len(k[1]) * n for k, n in ids.items())
    assert packing.pack(empty).count() == 0


def test_length_histogram(docs, empty):
    whole = tokens.WordTokenizer(tokens.tokenizer_path()).whole
    lengths = [len(whole.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()]
    sums = length_histogram.with_suffix_sums(length_histogram.histogram(docs), block=16).cache()
    for r in sums.collect():
        n = r["length"]
        assert (r["n_docs"], r["docs_upto"], r["tokens_upto"]) == (lengths.count(n), sum(x <= n for x in lengths), sum(x for x in lengths if x <= n))
        assert (r["docs_from"], r["tokens_from"]) == (sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths) and r["total_tokens"] == sum(lengths)
    for limit in (0, 1, 7, 50, 10**6):
        assert length_histogram.truncated_total(sums, limit).first()["truncated_tokens"] == sum(min(x, limit) for x in lengths)
    assert length_histogram.quantile(sums, 0.5).first()["length"] == sorted(lengths)[(len(lengths) - 1) // 2]
    none = length_histogram.with_suffix_sums(length_histogram.histogram(empty))
    assert none.count() == 0 and length_histogram.truncated_total(none, 5).first()["truncated_tokens"] == 0


def test_language_edges(docs, empty):
    model = language_id.trained_on(docs)
    found = language_id.identify(docs, model, "doc_id", "text").collect()
    assert len(found) == docs.count()
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    nothing = language_id.trained_on(empty)
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def test_language_needs_letters_and_leaves_no_language_out(spark):
    rows = [(k, f"the house number {k} and the garden", "en") for k in range(400)] + [(1000 + k, "ein haus und ein garten", "de") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_draw", F.pmod(F.xxhash64("doc_id"), F.lit(2**32)))
    model = language_id.train(docs, docs_per_language=20)
    assert model["languages"] == ["de", "en"]
    asked = spark.createDataFrame([(0, "½ ²"), (1, "①② 12"), (2, "日本"), (3, "_ ͡ ⅷ"), (4, "ein garten"), (5, "x½the")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(asked, model).collect()}
    assert [found[k] for k in range(6)] == ["und", "und", found[2], "und", "de", "en"] and found[2] != "und"
    scorer = language_id.Scorer(model)
    texts = [" ".join(w for w in t.split()) for t in ("the\u2003house\tand das garten", "", "ΟΔΟΣ the", "number")]
    together = scorer.scores(texts)
    for k, t in enumerate(texts):  # a text's scores don't hang on those beside it, and are the sums of its words
        words = language_id.words_of(t)
        assert together[1][k] == len(words) and np.allclose(together[0][k], sum((scorer.word(w).astype(float) for w in words), np.zeros(2)))


def test_quality_is_fitted_alike_when_doc_ids_repeat(spark):
    rows = [(k, f"{'good plain text of a page' if k % 2 else '$$$ 99 %% ## 1234'} {k}\n" * (1 + k % 4)) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    once = line_crf.trained_on(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    twice = line_crf.trained_on(spark.createDataFrame(rows + rows, "doc_id long, text string").repartition(5), labels.union(labels))
    assert once.known and np.allclose(once.weights, twice.weights) and once.slope == pytest.approx(twice.slope)
    bounded = line_crf.trained_on(spark.createDataFrame(rows, "doc_id long, text string"), labels, most_lines=3)
    assert len(bounded.weights) == len(once.weights)


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, 0, 0), (3, None, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    model = line_crf.trained_on(docs, labels)
    assert not model.known and {r["score"] for r in line_crf.scored(docs, model).collect()} == {0.5}
    known = line_crf.trained_on(docs, labels.union(spark.createDataFrame([(k, k % 2, 0) for k in range(4, 30)], labels.schema)))
    found = line_crf.scored(docs, known).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert line_crf.scored(empty, known).count() == 0


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    lang = queries.QUERIES["op9_language_id"](spark, data).filter("held_out").join(documents, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    quality = queries.QUERIES["op8_line_crf"](spark, data).filter("held_out").join(labels, "doc_id").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert lang > 0.98 and quality > 0.93


def test_pipeline_stages(spark, docs, empty):
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now.count()
        out = stage(spark, now, "")
        if k == len(corpus_pipeline.STAGES) - 1:
            assert "sequence_id" in out.columns
            assert sum(r["length"] for r in out.collect()) == sum(len(tokens.WordTokenizer(tokens.tokenizer_path()).whole.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in now.collect())
            break
        assert out.columns == docs.columns and out.schema == docs.schema
        rows = out.collect()
        assert Counter(rows) <= Counter(now.collect()), name
        if name == "language_id":
            assert all(any(c.isalpha() for c in r["text"]) for r in rows)
            assert len(rows) == sum(any(c.isalpha() for c in r["text"] or "") for r in now.collect())
        if name == "exact_dedup":
            assert len(rows) == len({re.sub("[\x20\x09-\x0d]", "", r["text"]) for r in now.collect()}) < before
        if name == "minhash_near_dedup":
            assert len(rows) == brute_components([(r["doc_id"], r["text"]) for r in now.collect()], 5, 80)[1] < before
        now = spark.createDataFrame(rows, docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_rows_are_numbered_once(docs):
    rows = with_rows(docs.drop("_row"), "rows")
    assert rows.select("_row").distinct().count() == docs.count()
