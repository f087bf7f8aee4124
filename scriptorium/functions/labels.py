"""Layout labels, geometry and identifiers as native columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: main type, subtype and one digit, as in MainZone:column#1 (a fixed format).
LABEL = r"^(\w+):?(\w+)?#?(\d?)?"
NO_NUMBER = 999_999


def _group(value: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(value, pattern, k)


def label_parts(label: Column) -> Column:
    """struct(main, subtype, n), 'none' for what is missing."""
    part = lambda k: F.coalesce(F.nullif(_group(label, LABEL, k), F.lit("")), F.lit("none"))
    return F.struct(part(1).alias("main"), part(2).alias("subtype"), part(3).alias("n"))


def line_type(label: Column) -> Column:
    return F.when(label == "default", F.lit("DefaultLine")).otherwise(label)


def untyped(main: Column, element: str) -> Column:
    """The type of an element whose label can't be resolved is its own name."""
    return F.coalesce(F.nullif(main, F.lit("none")), F.lit(element))


def page_number(stem: Column) -> Column:
    """The first run of digits, NO_NUMBER without one, which sorts last."""
    return F.coalesce(F.regexp_extract(stem, r"(\d+)", 1).try_cast("int"), F.lit(NO_NUMBER))


def surface_number(stem: Column) -> Column:
    return F.coalesce(F.regexp_extract(stem, r"^f?(\d+)", 1).try_cast("int"), F.lit(0))


def ncname(stem: Column) -> Column:
    """A leading digit isn't allowed in an id."""
    return F.when(stem.rlike(r"^\d"), F.concat(F.lit("f"), stem)).otherwise(stem)


def corners(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Upper left and lower right of a box, as whole numbers."""
    whole = lambda c: F.floor(c).cast("int")
    return F.struct(whole(x).alias("ulx"), whole(y).alias("uly"), whole(x + w).alias("lrx"), whole(y + h).alias("lry"))


def points(text: Column) -> Column:
    """'x y x y' as 'x,y x,y'; null unless the numbers come in pairs."""
    numbers = F.regexp_extract_all(text, F.lit(r"(-?\d+(?:\.\d+)?)"), 1)
    whole = F.transform(numbers, lambda v: F.floor(v.cast("double")).cast("string"))
    pairs = F.transform(F.sequence(F.lit(0), F.size(whole) - 2, F.lit(2)), lambda i: F.concat(F.get(whole, i), F.lit(","), F.get(whole, i + 1)))
    return F.when((F.size(whole) > 0) & (F.size(whole) % 2 == 0), F.concat_ws(" ", pairs))


def crop_url(base: Column, view: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """An image region by a IIIF URL, where the base and a view other than 0 are known."""
    return F.when(base.isNotNull() & (view > 0) & w.isNotNull(), F.format_string("%s/f%d/%s,%s,%s,%s/full/0/native.jpg", base, view, x, y, w, h))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """RFC 4122 name-based id, by SHA-1 in the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*(F.lit(c) for c in "89ab")), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def document_id(name: Column) -> Column:
    """struct(internal, volume) of a directory name: letters and digits, then the
    volume after an underscore or a single letter."""
    pattern = r"^([A-Za-z]+\d+)(?:_?([a-z]\d*))?"
    return F.struct(F.nullif(_group(name, pattern, 1), F.lit("")).alias("internal"), F.nullif(_group(name, pattern, 2), F.lit("")).alias("volume"))


def canonical_id(internal: Column, volume: Column) -> Column:
    """No underscore before a single letter."""
    return F.when(volume.isNull(), internal).when(F.length(volume) == 1, F.concat(internal, volume)).otherwise(F.concat(internal, F.lit("_"), volume))


def volume_index(volume: Column) -> Column:
    """a is 0, t2 and v2 are 1; a bare t or v has none."""
    number = F.regexp_extract(volume, r"^[tv](\d+)$", 1).try_cast("int")
    return F.when(volume.rlike(r"^[tv]\d+$"), number - 1).when(volume.rlike("^[a-su-uw-z]$"), F.ascii(volume) - 97)


def blank_as_null(value: Column) -> Column:
    """Catalogue cells: trimmed; blank and literal nan are null."""
    trimmed = F.trim(value)
    return F.when((trimmed == "") | (F.lower(trimmed) == "nan"), F.lit(None)).otherwise(trimmed)


#: Catalogue names of languages and their identifiers (fixed values of ISO 639-3).
LANGUAGES = {"français": "fra", "latin": "lat", "grec": "grc", "italien": "ita", "espagnol": "spa", "allemand": "deu", "anglais": "eng", "néerlandais": "nld"}


def language_ident(name: Column) -> Column:
    """A catalogue's name of a language, or an identifier as it stands; else und."""
    low = F.lower(F.trim(name))
    table = F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))
    return F.coalesce(F.try_element_at(table, low), F.when(low.isin(*LANGUAGES.values()), low), F.lit("und"))


def version_prefix(version: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(version, r"^\d+(?:\.\d+)*", 0), F.lit("")), F.lit("0"))


def locator(kind: Column, document: Column, page: Column, path: Column) -> Column:
    """What a loss points to: a document, a page of it, or a file."""
    return F.when(kind == "DOC", document).when(kind == "PAGE", F.concat_ws("/", document, page)).when(kind == "FILE", path)
