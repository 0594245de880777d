"""Field extraction from parsed MARC records (``schemas.MARC``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Record column, MARC tag, subfield code, indicators.
FIELDS = (
    ("title", "245", "a", None, None),
    ("title_additional", "245", "b", None, None),
    ("title_author", "245", "c", None, None),
    ("type_of_material", "502", "b", None, None),
    ("university", "502", "c", None, None),
    ("author_person_name", "100", "a", None, None),
    ("author_person_role", "100", "e", None, None),
    ("author_person_id", "100", "0", None, None),
    ("author_institution_id", "110", "0", None, None),
    ("author_institution_name", "110", "a", None, None),
    ("publication_year", "264", "c", None, None),
    ("issn", "022", "a", None, None),
    ("country", "044", "c", None, None),
    ("language", "041", "a", None, None),
    ("keywords", "650", "a", None, None),
    ("ddc", "082", "a", None, None),
    ("urn", "856", "u", None, None),
    ("url_resolving_system", "856", "u", "4", "0"),
    ("url_dnb_archive", "856", "u", " ", "0"),
    ("url_publisher", "856", "u", "4", " "),
)


def _first(entries: Column, name: str, value: str) -> Column:
    """The first of the structs ``entries`` whose field ``name`` is ``value``."""
    return F.get(entries, F.array_position(entries[name], value).cast("int") - 1)


def marc_control(tag: str, fields: Column | None = None) -> Column:
    """Text of the first control field with ``tag``; an empty one is NULL."""
    source = F.col("controlfield") if fields is None else fields
    return F.nullif(_first(source, "_tag", tag)["_VALUE"], F.lit(""))


def marc_subfield(tag: str, code: str, ind1: str | None = None, ind2: str | None = None,
                  fields: Column | None = None) -> Column:
    """First subfield ``code`` of the first field ``tag``.

    Indicators narrow the fields only if both are given. If the first field lacks the subfield
    the result is NULL; later fields are not searched.
    """
    source = F.col("datafield") if fields is None else fields

    if ind1 is None or ind2 is None:
        first = _first(source, "_tag", tag)
    else:
        hit = lambda f: (f["_tag"] == tag) & (f["_ind1"] == ind1) & (f["_ind2"] == ind2)
        first = F.get(F.filter(source, hit), F.lit(0))
    return _first(first["subfield"], "_code", code)["_VALUE"]


def marc_year() -> Column:
    """Characters 8-11 of control field 008 if they are all digits."""
    chars = F.substring(marc_control("008"), 8, 4)
    return F.when(chars.rlike("^[0-9]+$"), chars)


def marc_flatten(df: DataFrame) -> DataFrame:
    """Parsed MARC records to the metadata columns of the record table, in one projection."""
    values = [marc_subfield(tag, code, i1, i2).alias(name) for name, tag, code, i1, i2 in FIELDS]
    return df.select(marc_control("001").alias("idn"), marc_year().alias("year"), *values)
