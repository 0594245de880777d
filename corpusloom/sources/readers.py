"""Readers. Schemas are explicit; ids stay strings (leading zeros, trailing ``X``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schemas import LINK_COLUMNS, MARC, TAXONOMY
from corpusloom.sources.lines import file_heads, quoted_records, text_blocks


def marc_xml_scan(spark: SparkSession, path: str, row_tag: str = "record") -> DataFrame:
    """MARC-XML files -> one parsed record per row (``schemas.MARC``); ``marc_xml_rejects`` has the others."""
    records = marc_xml_records(spark, path, row_tag)
    return marc_xml_parse(records.select(F.col("xml").alias("_xml")), "_xml")


def marc_xml_rejects(spark: SparkSession, path: str, row_tag: str = "record") -> DataFrame:
    """(reason, xml) of the records that ``marc_xml_scan`` leaves out."""
    parsed = marc_xml_records(spark, path, row_tag).withColumn("_marc", _parsed(F.col("xml")))
    return parsed.withColumn("reason", _reject_reason(F.col("xml"), F.col("_marc"))).where("reason IS NOT NULL").select("reason", "xml")


def marc_xml_records(spark: SparkSession, path: str, row_tag: str = "record") -> DataFrame:
    """The text of every record of the files in the column ``xml``, without name space prefixes.

    The files are read as text with the end of the record tag as line separator, so one huge catalogue
    file still splits over many tasks (Spark's XML source would read it in one). Blanks and prefixes in tags are
    allowed, comments are cut out. Text between records that holds no field is no record; a piece that does, but has no
    end tag or half a comment, stays as it is and will not parse.
    """
    tag = rf"(?:[\w.-]+:)?{row_tag}"
    chunk = F.concat("value", F.lit(f"{row_tag}>"))
    chunk = F.when(chunk.contains("<!--"), F.regexp_replace(chunk, r"(?s)<!--.*?-->", "")).otherwise(chunk)

    def body(piece: Column) -> Column:
        # a piece starts with the end tag of the record before it, and the next piece with its own
        inner = F.regexp_replace(piece, rf"(?s)^/{tag}\s*>", "")
        inner = F.regexp_replace(inner, rf"(?s)^.*<{tag}(?:\s[^>]*)?>", "")
        return F.regexp_replace(inner, r"<(/?)[\w.-]++:", "<$1")

    # the generator holds the text, so that it is cut out once for the test and the result
    pieces = spark.read.text(path, lineSep=f"{row_tag}>").select(F.explode(F.transform(F.split(chunk, rf"<(?=/{tag}\s*>)"), body)).alias("_body"))
    return (
        pieces.where(F.col("_body").rlike(r"<(?:leader|controlfield|datafield|subfield)[\s>]"))
        .select(F.concat(F.lit("<record>"), F.regexp_replace("_body", rf"{row_tag}>$", ""), F.lit("</record>")).alias("xml"))
    )


#: text and attribute values that XML and JSON write alike; a value has more than blanks
_VALUE = r'[ ]*+[^ <>&"\\\p{C}][^<>&"\\\p{C}]*+'
_ATTRIBUTE = r'[^<>&"\\\p{C}]++'
_GAP = r"[ \t\r\n]*+"
_SUBFIELD = rf'<subfield code="{_ATTRIBUTE}">{_VALUE}</subfield>{_GAP}'
#: records in the usual form: control fields, then data fields
_USUAL = (
    rf'^<record>{_GAP}(?:<leader>{_VALUE}</leader>{_GAP})?((?:<controlfield tag="{_ATTRIBUTE}">{_VALUE}</controlfield>{_GAP})++)'
    rf'((?:<datafield tag="{_ATTRIBUTE}" ind1="{_ATTRIBUTE}" ind2="{_ATTRIBUTE}">{_GAP}(?:{_SUBFIELD})++</datafield>{_GAP})++)</record>$'
)
#: tags of such a record without gaps, and what stands in their place in JSON; longer ones first
_JSON = (
    ('</subfield></datafield><datafield tag="', '"}]},{"_tag":"'), ('</subfield></datafield></record>', '"}]}]}'),
    ('</subfield><subfield code="', '"},{"_code":"'), ('"><subfield code="', '","subfield":[{"_code":"'),
    ('</controlfield><controlfield tag="', '"},{"_tag":"'), ('</controlfield><datafield tag="', '"}],"datafield":[{"_tag":"'),
    ('" ind1="', '","_ind1":"'), ('" ind2="', '","_ind2":"'), ('">', '","_VALUE":"'),
)


def _parsed(xml: Column) -> Column:
    """A record as a struct of ``MARC`` and ``_corrupt``, its text if it is malformed. Surrounding blanks are kept: an
    indicator of one blank is a value.

    A record in the usual form (control fields, then data fields, attributes in the usual order, nothing escaped) is
    rewritten as JSON, which is parsed several times faster; any other one goes through the XML parser.
    """
    schema = f"{MARC}, _corrupt STRING"
    text = F.when(xml.rlike(r">[ \t\r\n]++<"), F.regexp_replace(xml, r">[ \t\r\n]++<", "><")).otherwise(xml)
    text = F.concat(F.lit('{"controlfield":[{"_tag":"'), _behind(text, '<controlfield tag="'))
    for tag, json in _JSON:
        text = F.replace(text, F.lit(tag), F.lit(json))
    usual = F.from_json(text, schema, {"mode": "FAILFAST"})
    parsed = F.from_xml(xml, schema, {"ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_corrupt"})
    return F.when(xml.rlike(_USUAL), usual).otherwise(parsed)


def _behind(text: Column, mark: str) -> Column:
    """``text`` behind the first ``mark``."""
    return F.substr(text, F.instr(text, mark) + F.lit(len(mark)))


def _reject_reason(xml: Column, parsed: Column) -> Column:
    """Why a record is left out; NULL if it is not."""
    return F.when(xml.contains("<!--") | xml.contains("-->"), "comment over several records").when(parsed["_corrupt"].isNotNull(), "malformed")


def marc_xml_parse(df: DataFrame, xml: str) -> DataFrame:
    """MARC records held as XML text in a column -> parsed records, other columns kept; malformed ones drop out."""
    # one element per record: the generator holds the parsed struct, so that it is parsed once for the test and all columns
    rows = df.withColumn("_marc", F.explode(F.array(_parsed(F.col(xml)))))
    sound = rows.where(_reject_reason(F.col(xml), F.col("_marc")).isNull())
    return sound.select("*", "_marc.*").drop("_marc", "_corrupt", xml)


def record_table_scan(spark: SparkSession, path: str, columns=None, fmt: str = "parquet") -> DataFrame:
    """Record table from files; only ``columns`` are read."""
    df = spark.read.format(fmt).load(path)
    return df if columns is None else df.select(*columns)


def record_table_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
                      partitions: int, columns=None, **options: str) -> DataFrame:
    """Record table from a database, in parallel ranges of a numeric column. Credentials go in ``options``."""
    df = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, lowerBound=str(lower),
                 upperBound=str(upper), numPartitions=str(partitions), **options)
        .load()
    )
    return df if columns is None else df.select(*columns)


def link_csv_scan(spark: SparkSession, path: str, columns=LINK_COLUMNS) -> DataFrame:
    """CSV of links with a header, every column a string; quotes inside quotes are doubled.

    Values may hold line breaks, and a file of any size still splits over tasks (``quoted_records``), which takes a quote to
    stand only around values. A header other than ``columns`` fails the query; blank lines are no records.
    """
    records = quoted_records(spark, path).where(F.trim(F.col("record")) != "")
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    row = F.from_csv("record", ddl, {"escape": '"', "mode": "FAILFAST"})
    named = F.regexp_replace(F.array_join(F.array(*[F.coalesce(row[c], F.lit("")) for c in columns]), ","), "^\ufeff", "")
    wrong = F.raise_error(F.concat(F.lit(f"header is not {','.join(columns)}: "), F.col("record"))).cast("boolean")
    data = F.when(~F.col("header"), True).when(named == ",".join(columns), False).otherwise(wrong)
    return records.where(data).select(row.alias("_row")).select("_row.*")


def taxonomy_scan(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Nested taxonomy JSON -> (main, main_name, sub_key, lo, hi, sub_name).

    One object per file, or one per line with ``lines``. ``lo`` and ``hi`` are the bounds of a range
    key, equal for a single code, NULL for keys that are no numbers.
    """
    text = spark.read.text(path, wholetext=not lines)
    mains = text.select(F.explode(F.from_json("value", TAXONOMY, {"mode": "FAILFAST"})).alias("main", "node"))
    rows = mains.select("main", F.col("node.name").alias("main_name"), F.explode_outer("node.sub").alias("sub_key", "sub"))
    lo = F.split_part("sub_key", F.lit("-"), F.lit(1)).try_cast("int")
    hi = F.substring_index("sub_key", "-", -1).try_cast("int")
    return rows.select("main", "main_name", "sub_key", lo.alias("lo"), hi.alias("hi"), F.col("sub.name").alias("sub_name"))


def class_names(flat: DataFrame) -> DataFrame:
    """(code, name) of the one-character main classes of a flattened taxonomy."""
    return flat.where(F.length("main") == 1).groupBy(F.col("main").alias("code")).agg(F.min("main_name").alias("name"))


def text_corpus_scan(spark: SparkSession, directory: str, glob: str = "*.mmd", block_bytes: int = 64 << 20) -> DataFrame:
    """Text files of a folder -> (path, file, offset, content); files above ``block_bytes`` come in blocks of whole lines."""
    return text_blocks(spark, directory, glob, block_bytes).select("path", F.substring_index("path", "/", -1).alias("file"), "offset", "content")


def binary_doc_scan(spark: SparkSession, directory: str, head: int = 5, glob: str = "*", whole_bytes: int = 8 << 20) -> DataFrame:
    """(path, file, file_size, head) of binary files of any size; ``head`` is their first bytes as Latin-1 text."""
    heads = file_heads(spark, directory, head, glob, whole_bytes)
    return heads.select("path", F.substring_index("path", "/", -1).alias("file"), "file_size", F.decode("head", "ISO-8859-1").alias("head"))


def failure_list_scan(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """JSON array(s) of failed ids -> one string column; broken JSON fails, as an empty list would send all ids back to work."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "ARRAY<STRING>", {"mode": "FAILFAST"})).alias(key)).distinct()
