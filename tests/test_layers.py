"""Operators of entity layers, headers, preflight, rules and foreign runs that no query covers."""

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import wording
from scriptorium.operators import foreign, header, layers, preflight, rules


def rows(df):
    return sorted(tuple(r) for r in df.collect())


SIDE = "c int, ord int, type string, confidence double, model string, words array<string>"
WORDS = "c int, pos string, start int, stop int, tag string, lemma string"


def test_pipeline_filters_by_tags_before_overlaps(spark):
    words = [("0", 0, 5, "NOMpro", "Paris"), ("1", 6, 9, "VERcjg", "aller"), ("2", 10, 14, "NOMpro", "Rome"), ("3", 15, 18, "NOMcom", "roi")]
    tokens = spark.createDataFrame([(1, *w) for w in words], WORDS)
    left = spark.createDataFrame([(1, 0, "place", 0.5, "a", ["0"]), (1, 1, "place", 0.9, "a", ["1"]), (1, 2, "person", 0.95, "a", ["3"])], SIDE)
    right = spark.createDataFrame([(1, 0, "place", 0.7, "b", ["2", "3"])], SIDE)
    found = layers.pipeline(left, right, tokens, ["c"])
    # the verb and the person without a name go; the surer "person" no longer hides "2 3"
    assert rows(found.select("words", "type", "start", "stop")) == [(["0"], "place", 0, 5), (["2", "3"], "place", 10, 18)]
    none = layers.pipeline(left.limit(0), right.limit(0), tokens, ["c"])
    assert none.count() == 0


def test_pipeline_keeps_the_surer_of_two_overlapping(spark):
    tokens = spark.createDataFrame([(1, str(k), 3 * k, 3 * k + 2, "NOMpro", "x") for k in range(6)], WORDS)
    left = spark.createDataFrame([(1, 0, "place", 0.4, "a", ["0", "1", "2", "3"]), (2, 0, "place", 0.4, "a", ["0"])], SIDE)
    right = spark.createDataFrame([(1, 0, "person", 0.8, "b", ["3", "4", "5"])], SIDE)
    found = rows(layers.pipeline(left, right, tokens, ["c"]).select("c", "words"))
    assert found == [(1, ["3", "4", "5"])]  # container 2 has no words, so no mention


def test_resolved_entities(spark):
    mentions = spark.createDataFrame(
        [(0, "person", "Guillaume Bude", "guillaume bude", 0.9), (1, "person", "Guillaume Bude", "guillaume bude", 0.8), (2, "person", "Guillaume Budé", "guillaume budé", 0.7), (3, "place", "Lyon", "lyon", 0.4), (4, "place", "Paris", "paris", 0.9)],
        "ord int, type string, text string, plain string, confidence double",
    )
    people = spark.createDataFrame([("P1", 0, "Guillaume Bude", "Bude")], "person_id string, cat_ord int, full string, surname string")
    found = rows(layers.resolved(mentions, people).select("type", "name", "mentions", "person_id"))
    assert found == [("person", "Guillaume Bude", 3, "P1"), ("place", "Paris", 1, None)]  # one unsure Lyon goes
    assert layers.resolved(mentions.limit(0), people).count() == 0


def test_aligned_layers(spark):
    found = spark.createDataFrame([(1, "a", 0, 4, "orig"), (1, "b", 3, 9, "reg"), (1, "c", 0, 2, "raw")], "c int, span_id string, span_start int, span_stop int, source string")
    words = spark.createDataFrame([(1, 0, "le", 0, 2), (1, 1, "roy", 3, 6), (1, 2, "vint", 7, 11)], "c int, pos int, word string, start int, stop int")
    readings = spark.createDataFrame([(1, 1, "roi", 3, 6), (1, 2, "vint", 7, 11), (1, 9, "là", 12, 14)], words.schema)
    assert rows(layers.aligned_layers(found, words, readings, ["c"])) == [(1, "a", [0, 1]), (1, "b", [1, 2]), (1, "c", [])]


def test_header_parts(spark):
    people = spark.createDataFrame([("p", "1650", " "), ("q", "sans date", None)], "code string, born string, died string")
    found = rows(header.lifetimes(people, "code", "born", "died").select("code", "event", "cell"))
    assert found == [("p", "birth", "1650"), ("q", "birth", "sans date")]
    assert header.lifetimes(people, "code", "born", "died").filter("code = 'p'").first()["when"] == "1650"
    skeleton = spark.createDataFrame([("d", "title", "place"), ("e", "other", None)], "doc string, title string, place string")
    given = spark.createDataFrame([("d", None, "Lyon", 1)], "doc string, title string, place string, more int")
    assert [tuple(r) for r in header.overridden(skeleton, given, "doc").orderBy("doc").collect()] == [("d", "title", "Lyon"), ("e", "other", None)]


def test_preflight_maps_and_surfaces(spark):
    pages = spark.createDataFrame([("v", "f1"), ("v", "f2"), ("w", "f1")], "volume string, page string")
    good = spark.createDataFrame([("u1", "f1.xml", 0), ("u2", "f2.xml", 1)], "url string, file string, file_ord long")
    bad = spark.createDataFrame([("u1", "x.xml", 0)], good.schema)
    assert preflight.refused_map([], pages, "page") is None
    assert preflight.refused_map([("a.csv", 9, bad), ("b.csv", 9, good)], pages, "page") is None
    assert "0%" in preflight.refused_map([("a.csv", 9, bad)], pages, "page")
    assert "10 MB" in preflight.refused_map([("a.csv", 11 << 20, None)], pages, "page")
    assert preflight.refused_map([("a.csv", 9, None)], pages, "page") == "no map has three columns"
    assert preflight.chosen_map([("a.csv", 9, good), ("z_iiif.csv", 9, good), ("b_iiif.csv", 9, bad)], pages, "page") == "z_iiif.csv"
    assert preflight.chosen_map([("a.csv", 9, bad)], pages, "page") is None
    assert preflight.distinct_surfaces(pages, "volume", "page").count() == 3
    with pytest.raises(ValueError, match="v/f1"):
        preflight.distinct_surfaces(pages.union(pages.filter("volume = 'v' and page = 'f1'")), "volume", "page")


def test_validator_reports(spark):
    svrl = """<s:o xmlns:s="http://purl.oclc.org/dsdl/svrl"><s:failed-assert location="/a" role="nonfatal"><s:text>two
    words</s:text></s:failed-assert><s:fired-rule/><s:successful-report location="/b"><s:text>x</s:text></s:successful-report></s:o>"""
    found = rules.reports(spark.createDataFrame([("d", svrl), ("e", "<o/>"), ("n", None), ("x", "<broken")], "doc string, xml string"), "doc", "xml")
    assert rows(found)[:2] == [("d", 0, "two words", "/a", "nonfatal"), ("d", 1, "x", "/b", "fatal")]
    assert [r[:2] + r[4:] for r in rows(found)[2:]] == [("x", 0, "fatal")]  # what can't be read is a finding


def test_foreign_runs_and_places(spark):
    langs = [None, "fra", "fra", None, "lat", "lat", "fra"]
    words = spark.createDataFrame([(1, k, 5 * k, 5 * k + 4, lang) for k, lang in enumerate(langs)], "c int, pos int, start int, stop int, lang string")
    found = rows(foreign.runs(words, ["c"], "pos", "lang").select("start", "stop", "lang", "words"))
    assert found == [(0, 4, None, 1), (5, 19, "fra", 3), (20, 29, "lat", 2), (30, 34, "fra", 1)]
    segments = spark.createDataFrame([(0, 2, [3, 5, 9]), (2, 9, [3, 5, 9]), (3, 4, [3, 5, 9]), (1, 1, [3, 5, 9]), (-2, 1, [3, 5, 9]), (0, 1, [])], "start int, stop int, origin array<int>")
    assert rows(foreign.mapped(segments, "origin").select("start", "stop")) == [(3, 4), (3, 6), (9, 10)]


def test_wording():
    assert wording.counted(2, 1300, "lines") == "2 of 1 300 lines" or wording.grouped(1300) in wording.counted(2, 1300, "lines")
    with pytest.raises(ValueError):
        wording.counted(3, 2, "lines")
    with pytest.raises(ValueError):
        wording.counted(3, None, "lines")
    with pytest.raises(ValueError):
        wording.phase("lost")
    assert wording.phase("off", reason="no service") == "off (no service)"
    assert wording.phase("done", 0, 0, "entities") == "no entity to enrich (0 found)"
    assert wording.phase("done", 0, 7) == "nothing lost (0 of 7)"
    assert wording.phase("lost", 1, 3, reason="timeout").startswith("LOST · 1 of 3 lines")
    assert [wording.duration(s) for s in (0, 61, 17491)] == ["0s", "1m 01s", "4h 51m 31s"]
    assert wording.clip("ab\tcdef", 4) == "ab …" and wording.clip("abcdef", 3, left=True) == "…ef" and wording.clip("日本", 3) == "日…"
    for room in range(1, 30):
        assert wording.columns(wording.short_path("/a/long/folder/x.xml", room)) <= room
        assert wording.columns(wording.pad("left side", "right", room)) <= max(room, 5)
    assert wording.short_path("/a/long/folder/x.xml", 12).endswith("/x.xml")
