"""What a document's header says: fields of the catalogue, extent, languages, persons, images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_attributes
from ..functions.labels import language_ident

#: The address of a manifest from which images can be addressed (a fixed format).
MANIFEST = r"^(https://gallica\.bnf\.fr/iiif/ark:/\d+/[a-z0-9]+)/manifest\.json"


def cells(cell: Column, separator: str = r"\|") -> Column:
    """The values of a cell, trimmed, without blank ones."""
    return F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), separator), lambda c: F.trim(c)), lambda c: c != "")


def fields(books: DataFrame, title: str, long_title: str, languages: str, date: str, manifests: str, place: str, missing: str = "[unknown]") -> DataFrame:
    """books with the header's fields: title (the long one first, else the short, else a
    placeholder), languages by identifier, the date's attributes, a list of manifests and
    the place."""
    value = lambda c: F.nullif(F.trim(c), F.lit(""))
    return books.withColumns(
        {
            "h_title": F.coalesce(value(long_title), value(title), F.lit(missing)),
            "h_languages": F.array_distinct(F.transform(cells(F.col(languages)), language_ident)),
            "h_date": date_attributes(F.col(date)),
            "h_idnos": cells(F.col(manifests)),
            "h_place": F.coalesce(value(place), F.lit(missing)),
        }
    )


def overridden(skeleton: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """Each field as given where it is, as in the skeleton where it isn't."""
    names = [c for c in skeleton.columns if c != key]
    other = given.select(key, *[F.col(c).alias(f"_{c}") for c in names if c in given.columns])
    return skeleton.join(other, key, "left").select(key, *[F.coalesce(f"_{c}", c).alias(c) if c in given.columns else F.col(c) for c in names])


def image_base(manifest: Column) -> Column:
    """The base of image addresses by a manifest's, null for other servers."""
    return F.nullif(F.regexp_extract(F.trim(manifest), MANIFEST, 1), F.lit(""))


def image_config(manifest: Column, configured: Column) -> Column:
    """What the manifest gives wins over what was set."""
    return F.coalesce(image_base(manifest), configured)


def safe_person_id(code: Column) -> Column:
    """An ark isn't an id: its last part is, or all of it with other signs as hyphens."""
    bare = F.trim(code)
    tail = F.substring_index(F.regexp_replace(bare, "/+$", ""), "/", -1)
    fallback = F.regexp_replace(bare, r"[^A-Za-z0-9._\-]", "-")
    return F.when(bare.startswith("ark:"), F.concat(F.lit("pers_"), F.when((tail == "") | tail.contains(":"), fallback).otherwise(tail))).otherwise(bare)


def extent(volumes: DataFrame, key: list[str], words: str, tokens: str) -> DataFrame:
    """unit and quantity for each measure that there is; made anew, it is the same."""
    each = F.array(*(F.struct(F.lit(unit).alias("unit"), F.col(c).cast("long").alias("quantity")) for unit, c in (("words", words), ("tokens", tokens))))
    return volumes.select(*key, F.inline(each)).filter("quantity > 0").withColumn("text", F.format_string("%d %s", "quantity", "unit"))


def by_volume(volumes: DataFrame, key: list[str], lang: str, words: str) -> DataFrame:
    """place of each language of a key, the largest first."""
    return volumes.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(words), lang)))


def lifetimes(persons: DataFrame, key: str, born: str, died: str) -> DataFrame:
    """person, event, date attributes and the cell for each known birth and death; a cell
    that is no date keeps its text."""
    events = F.array(*(F.struct(F.lit(e).alias("event"), F.col(c).alias("cell"), date_attributes(F.col(c)).alias("date")) for e, c in (("birth", born), ("death", died))))
    return persons.select(key, F.inline(events)).filter("trim(cell) <> ''").select(key, "event", "cell", "date.*")


def contributors(rows: DataFrame, key: str, roles: dict[str, str], persons: DataFrame, code: str, name: str) -> DataFrame:
    """A row for each person of each role of a document, in the cells' order, with an id
    and the name where it is known."""
    each = F.array(*(F.struct(F.lit(role).alias("role"), cells(F.col(c)).alias("codes")) for c, role in roles.items()))
    listed = rows.select(key, F.inline(each)).select(key, "role", F.posexplode("codes").alias("place", "code"))
    known = persons.select(F.col(code).alias("code"), F.col(name).alias("name"))
    return listed.join(known, "code", "left").select(key, "role", "place", "code", safe_person_id(F.col("code")).alias("person_id"), F.coalesce("name", "code").alias("name"))
