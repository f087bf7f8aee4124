"""Queries that must read all of their input, against brute force on small tables."""

import random
import re
from collections import defaultdict
from itertools import zip_longest

import pytest

from scriptorium.functions import kernels
from scriptorium.operators import entities, order
from scriptorium.plans import all as plans


def test_model_merge_reads_every_order(spark, tmp_path):
    lines = [(o, n, (o * 13 + n * 5) % 40, (o + n * n) % 9, 100.0 * n, n / 100, "ANR"[(o + n) % 3]) for o in range(1, 12) for n in range(1, 6)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    sides = defaultdict(lambda: ([], []))
    for o, _, part, supplier, _, confidence, flag in lines:
        sides[o][supplier % 2].append({"type": flag, "confidence": confidence, "model": "ab"[supplier % 2], "words": frozenset(str((part + i) % 7) for i in range(4))})
    expected = [(o, k, m["type"], m["confidence"], m["model"], sorted(m["words"])) for o, (a, b) in sides.items() for k, m in enumerate(kernels.agreed(a, b))]
    found = [(r["l_orderkey"], r["ord"], r["type"], r["confidence"], r["model"], r["words"]) for r in plans.QUERIES["model_merge"](spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(expected) and {r[0] for r in found} == set(range(1, 12))


def test_reading_similarity_compares_every_line(spark, tmp_path):
    texts = {1: "le roy\nde france\nest mort", 2: "le roy\nde frence\nvive le roy\nfin", 4: None, 5: "seul"}
    spark.createDataFrame([(k, t, "s") for k, t in texts.items()] + [(3, "autre", "z")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for a, b in ((2, 1), (4, 2), (5, 4)):
        lines = zip_longest((texts[a] or "").split("\n"), (texts[b] or "").split("\n"), fillvalue="")
        expected += [(a, k, round(kernels.similarity(x, y), 6)) for k, (x, y) in enumerate(lines)]
    found = plans.QUERIES["reading_similarity"](spark, str(tmp_path)).select("doc_id", "line_no", "similarity").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_fuzzy_merge_follows_long_chains(spark):
    letters = "abcdefghijklmnopqrstuvwxyz0123456789βγδζθκλμνξπρστφχψω"
    chain = [letters[k : k + 9] for k in range(40)]  # neighbours have 8 of 9 letters in common, others 7 at most
    order = random.Random(5).sample(range(40), 40)
    for ords in (range(40), order):
        names = spark.createDataFrame([("PER", n, o, 1) for n, o in zip(chain, ords, strict=True)], "type string, name string, ord int, mentions int")
        found = entities.fuzzy_merged(names, ["type"], "name", "ord", "mentions").collect()
        assert len(found) == 40 and {r["representative"] for r in found} == {chain[list(ords).index(0)]}
    with pytest.raises(RuntimeError, match="rounds"):
        entities.fuzzy_merged(names, ["type"], "name", "ord", "mentions", rounds=1)


def test_dehyphenate_reads_documents(spark, tmp_path):
    texts = {1: "abcdefghij" * 9 + " fin", 2: "un\ndeux", 3: "mot " * 30}
    spark.createDataFrame([*texts.items(), (4, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = plans.QUERIES["dehyphenate"](spark, str(tmp_path)).collect()
    expected = []
    for k, t in texts.items():
        lines = re.sub(r"([^\n]{39})(?=[^\W\d_])", "\\1¬\n", t).split("\n")
        joined, carried = kernels.rejoined(lines, ["Main"] * len(lines))
        expected += [(k, i, j, i in carried) for i, j in enumerate(joined)]
    assert sorted(map(tuple, found)) == sorted(expected) and any(r["carried"] for r in found)


def test_page_order_of_repeated_urls(spark, tmp_path):
    urls = ["http://a/f2", "http://a/f1", "http://a/f2", "http://a/f1", "http://b/x", "http://a/f2"]
    pages = [(9 - k, u, "") for k, u in enumerate(urls)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    found = plans.QUERIES["page_order"](spark, str(tmp_path)).select("page_id", "page_ord").collect()
    assert sorted(map(tuple, found)) == [(4, 3), (5, 1), (6, 1), (7, 4), (8, 2), (9, 5)]


def test_previous_rows_over_stretches(spark):
    rng = random.Random(4)
    keys = [None, *rng.sample(range(-40, 90), 60), *range(200, 203)]
    rows = [("abc"[k % 3] if k is not None and k % 11 else None, k, f"t{k}") for k in keys]
    groups = defaultdict(list)
    for g, k, t in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        groups[g].append((g, k, t))
    expected = [(*row, before[2]) for own in groups.values() for before, row in zip(own, own[1:], strict=False)]
    table = spark.createDataFrame(rng.sample(rows, len(rows)), "g string, k long, t string")
    for stretch in (1, 7, 1000):
        found = order.with_previous(table, "g", "k", "t", "before", stretch).collect()
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
