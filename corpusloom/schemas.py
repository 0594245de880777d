"""Explicit schemas; nothing in the library infers types."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the record table.
_V1 = """
id INT, idn STRING, title STRING, title_additional STRING, title_author STRING,
author_person_id STRING, author_person_name STRING, author_person_role STRING,
author_institution_id STRING, author_institution_name STRING, publication_year STRING,
issn STRING, keywords STRING, country STRING, language STRING, ddc STRING,
type_of_material STRING, university STRING, year STRING, urn STRING, path STRING,
file_size INT, content_type STRING, file_extension STRING, num_pages INT,
url_dnb_archive STRING, url_resolving_system STRING, url_publisher STRING
"""
_V2_EXTRA = """
selection INT, converted_file STRING, drive_file_id STRING, conversion_lock DATE,
abstract_num INT, summary_num INT, abstract_pos DOUBLE, summary_pos INT
"""

#: record table as first loaded
RECORD_V1 = " ".join(_V1.split())
#: record table with conversion and text-scan results
RECORD_V2 = " ".join(f"{_V1}, {_V2_EXTRA}".split())

MARC = (
    "controlfield ARRAY<STRUCT<_tag: STRING, _VALUE: STRING>>, "
    "datafield ARRAY<STRUCT<_tag: STRING, _ind1: STRING, _ind2: STRING, "
    "subfield: ARRAY<STRUCT<_code: STRING, _VALUE: STRING>>>>"
)

LINK_COLUMNS = ("doc_idn", "gnd_idn", "gnd_label")

TAXONOMY = "MAP<STRING, STRUCT<name: STRING, sub: MAP<STRING, STRUCT<name: STRING>>>>"


def strings(names) -> T.StructType:
    """A schema of nullable STRING columns."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
