import uuid
from difflib import SequenceMatcher

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium import settings
from scriptorium.functions import dates, kernels, labels, text
from scriptorium.operators import losses


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "label, parts",
    [("MainZone:column#1", ("MainZone", "column", "1")), ("MainZone", ("MainZone", "none", "none")), ("Main#12", ("Main", "none", "1")), ("", ("none", "none", "none"))],
)
def test_label_parts(spark, label, parts):
    assert tuple(one(spark, labels.label_parts(F.col("l")), l=label)) == parts


@pytest.mark.parametrize(
    "cell, when, before, after, cert",
    [
        ("1659/03/12", "1659-03-12", None, None, None), ("165903", "1659-03", None, None, None), ("1659", "1659", None, None, None), ("159", None, "1590", "1599", "low"),
        ("-159", None, "-1599", "-1590", "low"), ("0000", None, None, None, None), ("ca. 1659", "1659", None, None, "low"), ("1659/13/01", None, None, None, None),
        ("-0440715", "-0044-07-15", None, None, None), ("-430320", "-0043-03-20", None, None, None), ("-43/03/20", "-0043-03-20", None, None, None), ("-70101", "-0007-01-01", None, None, None), ("?", None, None, None, None), ("12345", None, None, None, None),
    ],
)
def test_date_cells(spark, cell, when, before, after, cert):
    r = one(spark, dates.date_attributes(F.col("c")), c=cell)
    assert (r["when"], r["not_before"], r["not_after"], r["cert"]) == (when, before, after, cert)


@pytest.mark.parametrize("said, year", [("M.DC.LIX", 1659), ("MDCLIIII", None), ("MIL", None), ("mdclix", None), ("MDCCXXIV", 1724), ("CC", None), ("l'an 1660,", 1660), ("anno 59", None), ("vers 1650", 1650), ("(env. 1650)", 1650), ("le 23 juin 1652", None), (None, None)])
def test_years_in_text(spark, said, year):
    assert one(spark, dates.text_year(F.col("t")), t=said) == year


def test_estimates_in_text_are_unsure(spark):
    for said in ("vers 1650", "environ 1650", "env. 1650", "ca. 1650", "circa 1650", "? 1650", "vers MDCL"):
        assert tuple(one(spark, dates.text_date(F.col("t")), t=said)) == ("1650", "low")
    assert tuple(one(spark, dates.text_date(F.col("t")), t="en 1659.")) == ("1659", None)


def test_uuid5_is_the_standard_one(spark):
    space = uuid.UUID("12345678-1234-5678-1234-567812345678")
    for name in ("", "abc", "éß☃", "x" * 300):
        assert one(spark, labels.uuid5(space, F.col("n")), n=name) == str(uuid.uuid5(space, name))


def test_layout_columns(spark):
    assert one(spark, labels.points(F.col("p")), p="1.9 2 3 4") == "1,2 3,4"
    assert one(spark, labels.points(F.col("p")), p="1 2 3") is None
    assert one(spark, labels.ncname(F.col("s")), s="1a") == "f1a"
    assert one(spark, labels.volume_index(F.col("v")), v="t2") == 1
    assert one(spark, labels.volume_index(F.col("v")), v="a") == 0
    assert one(spark, labels.volume_index(F.col("v")), v="t") is None
    assert one(spark, labels.blank_as_null(F.col("c")), c=" nan ") is None
    assert one(spark, labels.blank_as_null(F.col("c")), c=" 007 ") == "007"


def test_hyphens(spark):
    assert one(spark, text.ends_with_hyphen(F.col("t")), t="mot¬ ") is True
    assert one(spark, text.strip_trailing_hyphen(F.col("t")), t="mot--") == "mot-"
    assert one(spark, text.joins_words(F.col("a"), F.col("b")), a="mé", b="1") is False
    assert one(spark, text.cleaned(F.col("t")), t="iour uuide  ſi|re mot¬\n entier") == "jour uuide sire motentier"


def test_chains_of_broken_words():
    assert kernels.rejoined(["aaa bb¬", "cc¬", "dd ee"], ["m"] * 3) == (["aaa bbccdd", "bbccdd", "bbccdd ee"], {1, 2})
    assert kernels.rejoined(["aaa bb¬", "cc dd¬", "ee"], ["m"] * 3) == (["aaa bbcc", "bbcc ddee", "ddee"], {1, 2})
    assert kernels.rejoined(["aa¬", "note", "bb c"], ["m", "n", "m"]) == (["aabb", "note", "aabb c"], {2})
    assert kernels.rejoined(["aa¬", "", "bb"], ["m"] * 3) == (["aa¬", "", "bb"], set())
    assert kernels.rejoined(["aa¬", "bb¬", "", "c¬", "d"], ["m"] * 5) == (["aa¬", "bb¬", "", "cd", "cd"], {4})
    assert kernels.rejoined(["a b-", "c-"], ["m"] * 2) == (["a b-", "c-"], set())
    assert kernels.rejoined([], []) == ([], set())


@given(st.text(max_size=30), st.text(max_size=30))
def test_similarity_is_the_ratio_of_plain_texts(a, b):
    x, y = kernels.plain(a), kernels.plain(b)
    assert kernels.similarity(a, b) == (SequenceMatcher(None, x, y, autojunk=False).ratio() if x and y else 0.0)


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 6), st.integers(0, 5)), max_size=15))
def test_greedy_choice(spans):
    rows = [(a, a + n, float(c)) for a, n, c in spans]
    kept, accepted = kernels.disjoint(rows), []
    for k in sorted(range(len(rows)), key=lambda k: -rows[k][2]):
        if all(rows[k][1] <= rows[j][0] or rows[j][1] <= rows[k][0] for j in accepted):
            accepted.append(k)
    assert kept == accepted


def test_two_models_agree():
    a = [{"type": "PER", "confidence": 0.6, "model": "a", "words": {1, 2}}, {"type": "LOC", "confidence": 0.9, "model": "a", "words": {5}}]
    b = [{"type": "PER", "confidence": 0.95, "model": "b", "words": {1, 2, 3}}, {"type": "ORG", "confidence": 0.5, "model": "b", "words": {5}}, {"type": "PER", "confidence": 0.5, "model": "b", "words": {9}}]
    out = kernels.agreed(a, b)
    assert [(m["type"], m["confidence"], m["model"], set(m["words"])) for m in out] == [("PER", 1.0, "both", {1, 2}), ("LOC", 0.9, "a", {5}), ("ORG", 0.5, "b", {5}), ("PER", 0.5, "b", {9})]


def test_anchoring_counts_what_it_guesses():
    assert kernels.anchored("Le Roy dit", ["le", "Roy", "dit"]) == ([(0, 2), (3, 6), (7, 10)], 0)
    assert kernels.anchored("abc", ["zz", "c"]) == ([(0, 2), (2, 3)], 1)


def test_settings_layers():
    s = settings.Setting("run.workers", 4, settings.at_least(1))
    assert settings.resolve(s, None, "0", "2") == settings.Resolved(2, "file", ("env",))
    assert settings.resolve(s, "3", "2", None).origin == "flag"
    with pytest.raises(ValueError):
        settings.resolve(s, "0", None, None)
    with pytest.raises(KeyError, match="run.workers"):
        settings.read_file("[run]\nworkrs = 1\n", {"run.workers"})
    assert settings.phases(["a", "b", "c"], "a,b", ["+c", "-a"]) == ["b", "c"]
    with pytest.raises(ValueError):
        settings.phases(["a", "b"], None, ["+a", "-a"])


def test_exit_codes():
    assert losses.exit_code(True, 1, 0, 0, False) == 130
    assert losses.exit_code(False, 0, 2, 0, False) == 4
    assert losses.exit_code(False, 1, 2, 0, True) == 1
    assert losses.exit_code(False, 1, 0, 0, True) == 5
    assert losses.exit_code(False, 1, 0, 0, False) == 0


def test_counts_need_denominators(spark):
    assert one(spark, text.counted(F.col("a"), F.col("b")), a=2, b=3) == "2 of 3"
    with pytest.raises(Exception, match="denominator"):
        one(spark, text.counted(F.col("a"), F.col("b")), a=4, b=3)
