"""Normalization and parsing of registry text, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F



def _unaccented() -> tuple[str, str, dict[str, str]]:
    """Letters that compatibility decomposition turns into plain ones, and what into; marks; letters that become several."""
    single, several, marks = {}, {}, []
    for c in map(chr, range(0x80, 0x30000)):
        if unicodedata.combining(c):
            marks.append(c)
        bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if bare != c and bare.isascii() and bare.isalnum():
            (single if len(bare) == 1 else several)[c] = bare
    return "".join(single) + "".join(marks), "".join(single.values()), several


#: Built from Python's Unicode tables: `translate` drops what of the first has no counterpart in the second, the marks.
ACCENTED, PLAIN, SEVERAL = _unaccented()


def unaccented(text: Column) -> Column:
    """Text decomposed, without its marks."""
    seldom = text.rlike("[" + "".join(SEVERAL) + "]")
    spelt = text
    for c, plain in SEVERAL.items():
        spelt = F.replace(spelt, F.lit(c), F.lit(plain))
    return F.translate(F.when(seldom, spelt).otherwise(text), ACCENTED, PLAIN)


def fold(text: Column) -> Column:
    """Upper case without accents; everything but letters and digits is one space."""
    return F.trim(F.regexp_replace(F.upper(unaccented(text)), "[^A-Z0-9]+", " "))


def name_key(text: Column) -> Column:
    """A key for exact comparison of names, in lower case."""
    return F.lower(fold(text))


def replace_words(text: Column, words: Mapping[str, str]) -> Column:
    """Whole words exchanged, one after the other in the mapping's order."""
    for word, other in words.items():
        text = F.regexp_replace(text, rf"\b{word}\b", other)
    return text


def replace_parts(text: Column, parts: Mapping[str, str]) -> Column:
    """Strings exchanged wherever they stand, inside words too, in the mapping's order."""
    for part, other in parts.items():
        text = F.replace(text, F.lit(part), F.lit(other))
    return text


def split_letters_digits(text: Column) -> Column:
    """A space between a letter and a digit that touch."""
    return F.regexp_replace(F.regexp_replace(text, "(?<=[A-Za-z])(?=[0-9])", " "), "(?<=[0-9])(?=[A-Za-z])", " ")


def name_core(folded: Column, generic: Iterable[str], place: Column | None = None) -> Column:
    """A folded name without generic words and without its place's words; the whole name if nothing is left."""
    dropped = F.array(*[F.lit(w) for w in generic])
    if place is not None:
        dropped = F.concat(dropped, F.coalesce(F.split(fold(place), " "), F.array().cast("array<string>")))
    kept = F.filter(F.split(folded, " "), lambda w: ~F.array_contains(dropped, w))
    return F.when(F.size(kept) > 0, F.array_join(kept, " ")).otherwise(folded)


def missing_to_null(text: Column, tokens: Iterable[str] = ("", "-", "n/a", "nan", "none", "null")) -> Column:
    """Trimmed text; null where it is one of the tokens, in whatever case."""
    trimmed = F.trim(text)
    return F.when(~F.lower(trimmed).isin(*tokens), trimmed)


def node_id(raw: Column, keep_empty: bool = False) -> Column:
    """A node id as a string without the .0 of a number read as a float."""
    bare = F.regexp_replace(F.trim(raw.cast("string")), r"\.0$", "")
    return bare if keep_empty else F.when(bare != "", bare)


def padded_code(raw: Column, width: int) -> Column:
    """A numeric code with its leading zeros; null if it isn't one."""
    bare = F.trim(raw.cast("string"))
    return F.when(bare.rlike(rf"^\d{{1,{width}}}$"), F.lpad(bare, width, "0"))


def civic(address: Column) -> dict[str, Column]:
    """street, number and exponent of an address that ends in a house number; years and ranges give no number."""
    pattern = r"^(.*?)[ ,]+(\d{1,4})(?:[ /]*([A-Z]{1,2}))?$"
    folded = F.upper(F.trim(address))
    number = F.regexp_extract(folded, pattern, 2)
    year = number.try_cast("int").between(1800, 2100)
    ranged = folded.rlike(r"\d+ *- *\d+$")
    found = (number != "") & ~F.coalesce(year, F.lit(False)) & ~ranged
    return {
        "street": F.when(found, fold(F.regexp_extract(folded, pattern, 1))),
        "number": F.when(found, F.regexp_replace(number, "^0+(?=.)", "")),
        "exponent": F.when(found, F.regexp_extract(folded, pattern, 3)),
    }


def house_number(raw: Column) -> Column:
    """Without leading zeros; the mark for "no number" is empty."""
    bare = F.upper(F.trim(raw.cast("string")))
    return F.when(bare.isin("SNC", "S.N.C.", "SN"), "").otherwise(F.regexp_replace(F.regexp_replace(bare, "[^0-9A-Z]", ""), "^0+(?=.)", ""))


def speed_kmh(raw: Column) -> Column:
    """The lowest of a tag's numeric speeds, in km/h; null if it has none."""
    each = F.split(F.regexp_replace(raw, r"[\[\]'\" ]", ""), "[;,]")
    value = lambda x: F.regexp_extract(x, r"^(\d+(?:\.\d+)?)(?:mph|km/h|kmh)?$", 1).try_cast("double") * F.when(x.endswith("mph"), 1.609344).otherwise(1.0)
    return F.array_min(F.filter(F.transform(each, value), lambda x: x.isNotNull()))


def first_class(raw: Column) -> Column:
    """The first of the road classes that a tag lists."""
    return F.when(F.trim(raw) != "", F.lower(F.trim(F.split_part(F.regexp_replace(raw, r"[\[\]']", ""), F.lit(","), F.lit(1)))))


def address(*parts: Column) -> Column:
    """The parts that are there, joined by spaces; null if none is."""
    joined = F.concat_ws(" ", *[F.when(F.trim(p) != "", F.trim(p)) for p in parts])
    return F.when(joined != "", joined)


def ordered_distinct(values: Column) -> Column:
    """The non-empty values of an array, each where it first stands."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (F.trim(x) != "")))
