"""Catalogue dates and years in printed text, as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that make a date an estimate, and those that only introduce one (fixed values).
ESTIMATES = "ca", "circa", "vers", "env", "environ"
INTRODUCERS = r"l\s*['’]\s*an", "en", "le", "la", "anno", "aetatis", *ESTIMATES
UNSURE = rf"(?i)\?|\b({'|'.join(ESTIMATES)})\b"
#: Values of the Roman numerals (fixed).
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def _numeral(one: str, five: str, ten: str) -> str:
    """One decimal place of a canonical numeral: 9, 4 or the rest."""
    return f"({one}{ten}|{one}{five}|{five}?{one}{{0,3}})"


CANONICAL = "^M{0,3}" + "".join(map(_numeral, "CXI", "DLV", "MCX")) + "$"


def is_uncertain(cell: Column) -> Column:
    return F.coalesce(cell.rlike(UNSURE), F.lit(False))


def date_attributes(cell: Column) -> Column:
    """struct(when, not_before, not_after, cert) of a cell, by its number of digits:
    8 and 6 are dates, 4 a year, 1 to 3 the years they begin.  After a leading minus
    5 to 8 digits are a date whose last four are month and day.  Impossible dates and
    the year 0 give nulls; doubt gives cert low, as does a cut year."""
    digits = F.regexp_replace(F.coalesce(cell, F.lit("")), r"\D", "")
    n = F.length(digits)
    before = F.coalesce(F.regexp_replace(F.trim(cell), "^[? ]+", "").startswith("-"), F.lit(False))
    dated = n.isin(6, 8) | (before & n.between(5, 8))
    with_day = before | (n == 8)
    tail = F.when(with_day, 4).otherwise(2)
    month = F.substring(digits, n - tail + 1, F.lit(2))
    day = F.when(with_day, F.substring(digits, n - 1, F.lit(2)))
    sign = F.when(before, F.lit("-")).otherwise(F.lit(""))
    possible = month.try_cast("int").between(1, 12) & (day.isNull() | day.try_cast("int").between(1, 31))
    full = F.concat(sign, F.lpad(F.substring(digits, F.lit(1), n - tail), 4, "0"), F.lit("-"), F.concat_ws("-", month, day))
    value = digits.try_cast("int")
    span = F.pow(F.lit(10), 4 - n).cast("int")
    padded = lambda v: F.concat(sign, F.lpad(v.cast("string"), 4, "0"))
    low, high = value * span, value * span + span - 1
    cut = n.between(1, 3) & (value > 0)
    when = F.when(dated, F.when(possible, full)).when((n == 4) & (value > 0), padded(value))
    return F.struct(
        when.alias("when"),
        F.when(cut & ~dated, F.when(before, padded(high)).otherwise(padded(low))).alias("not_before"),
        F.when(cut & ~dated, F.when(before, padded(low)).otherwise(padded(high))).alias("not_after"),
        F.when(when.isNotNull() & is_uncertain(cell), F.lit("low")).when(cut & ~dated, F.lit("low")).alias("cert"),
    )


def normalize_date(cell: Column) -> Column:
    return F.coalesce(date_attributes(cell)["when"], F.lit(""))


def roman_year(text: Column) -> Column:
    """A canonical capital numeral from 1000 to 2100, separators dropped, else null."""
    bare = F.regexp_replace(text, r"[.\s]", "")
    values = F.transform(F.split(bare, ""), lambda c: F.create_map(*(F.lit(x) for kv in ROMAN.items() for x in kv))[c])
    total = F.aggregate(
        F.reverse(values),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("most")),
        lambda s, v: F.struct(F.when(v < s["most"], s["sum"] - v).otherwise(s["sum"] + v).alias("sum"), F.greatest(s["most"], v).alias("most")),
        lambda s: s["sum"],
    )
    return F.when(bare.rlike(CANONICAL) & (bare != ""), F.when(total.between(1000, 2100), total))


def text_date(text: Column) -> Column:
    """struct(when, cert) of a passage that is a year and nothing else but words that
    introduce it: a canonical numeral or four digits, which are then read as a cell."""
    bare = F.trim(F.regexp_replace(text, r"""^[.,;:()\[\]«»?"'\s]+|[.,;:()\[\]«»?"'\s]+$""", ""))
    bare = F.trim(F.regexp_replace(bare, rf"(?i)^[?\s]*({'|'.join(INTRODUCERS)})\b[\s.]*", ""))
    numeral, cell = roman_year(bare), date_attributes(text)
    digits = bare.rlike(r"^-?\d{4}$")
    return F.struct(
        F.when(numeral.isNotNull(), F.lpad(numeral.cast("string"), 4, "0")).when(digits, cell["when"]).alias("when"),
        F.when(numeral.isNotNull(), F.when(is_uncertain(text), F.lit("low"))).when(digits, cell["cert"]).alias("cert"),
    )


def text_year(text: Column) -> Column:
    """The year that a passage names, as a number."""
    return text_date(text)["when"].try_cast("int")
