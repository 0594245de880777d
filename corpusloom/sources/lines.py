"""Text files of any size: lines with their place, records with line breaks in quotes, blocks of bounded size.

A large file is read in pieces (``spark.sql.files.maxPartitionBytes``). What a line means can depend on everything before
it, so each piece is folded to one row, the rows of a file are combined from its start, and a second
pass over the lines uses the result. No file is ever in one task or one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import pin


def placed_lines(spark: SparkSession, path: str, glob: str = "*", larger_than: int = -1) -> DataFrame:
    """(path, file_size, piece, mid, value) of all lines; ``piece`` is where the piece of the file starts, ``mid`` rises within it.

    Files of up to ``larger_than`` bytes are left out before they are read. Only a line feed ends a line.
    """
    lines = spark.read.text(path, lineSep="\n", pathGlobFilter=glob, recursiveFileLookup=True)
    return lines.where(F.col("_metadata.file_size") > larger_than).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("piece"), F.monotonically_increasing_id().alias("mid"), "value")


def _windows():
    """(from the start of the piece to before the line, to the line; over the pieces before)."""
    lines = Window.partitionBy("path", "piece").orderBy("mid")
    pieces = Window.partitionBy("path").orderBy("piece")
    begin = Window.unboundedPreceding
    return lines.rowsBetween(begin, -1), lines.rowsBetween(begin, 0), pieces.rowsBetween(begin, -1)


def quoted_records(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, header, record): records of CSV files whose quoted values may hold line breaks; ``header`` marks the first of a file.

    A line starts a record if an even number of quotes stands before it in the file, so only lines with an odd number matter:
    the first of them opens a record of several lines, the next ends it, and so on. A piece is folded to the parity of its
    quotes, which combined from the start of the file tells how each piece begins. Records of several lines
    are spans of odd lines, cut at pieces; only their lines are brought together, all others stay where they are read. Stored once (``pin``).
    """
    _, _, earlier = _windows()
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = pin(placed_lines(spark, path, glob).select("path", "piece", "mid", "value", (quotes % 2 == 1).alias("odd")))

    pieces = lines.groupBy("path", "piece").agg(
        (F.count_if("odd") % 2).alias("parity"), F.min("mid").alias("first"), F.max("mid").alias("last"))
    whole_file = Window.partitionBy("path").orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pieces = pieces.withColumn("begins", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).withColumn("head", F.first("first").over(whole_file))
    pieces = pin(pieces)

    # in a piece odd lines open and end records in turn; ``begins`` tells which comes first
    in_piece = Window.partitionBy("path", "piece").orderBy("mid")
    odd = lines.where("odd").select("path", "piece", "mid").join(pieces.drop("parity", "first"), ["path", "piece"])
    odd = odd.withColumn("opens", (F.row_number().over(in_piece) - 1 + F.col("begins")) % 2 == 0)
    spans = odd.withColumn("end", F.coalesce(F.lead("mid").over(in_piece), F.col("last"))).where("opens")
    spans = pin(spans.select("path", "piece", F.col("mid").alias("start"), "end", F.col("mid").alias("record")))
    # a piece that begins inside quotes goes on with the record that was opened last, up to its first odd line
    last_opened = pieces.join(spans.groupBy("path", "piece").agg(F.max("record").alias("opened")), ["path", "piece"], "left")
    last_opened = last_opened.join(odd.groupBy("path", "piece").agg(F.min("mid").alias("ends")), ["path", "piece"], "left")
    going_on = last_opened.withColumn("record", F.last("opened", ignorenulls=True).over(earlier)).where("begins = 1").select(
        "path", "piece", F.col("first").alias("start"), F.coalesce("ends", "last").alias("end"), "record")
    inside = pin(spans.unionByName(going_on).select("record", F.explode(F.sequence("start", "end")).alias("mid")))

    heads = pieces.select("head").distinct()
    several = not inside.isEmpty()
    found = lines.join(inside.select("mid"), "mid", "left_anti") if several else lines
    one = found.select("path", "mid", F.col("value").alias("record")).join(heads, F.col("mid") == F.col("head"), "left").select(
        "path", F.col("head").isNotNull().alias("header"), "record")
    parts = F.array_sort(F.collect_list(F.struct("piece", "mid", "value")))
    more = lines.join(inside, "mid").groupBy("path", "record").agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("text"))
    more = more.join(heads, F.col("record") == F.col("head"), "left").select("path", F.col("head").isNotNull().alias("header"), F.col("text").alias("record"))
    records = one.unionByName(more) if several else one
    text = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return records.withColumn("record", text)


def text_blocks(spark: SparkSession, directory: str, glob: str = "*", block_bytes: int = 64 << 20) -> DataFrame:
    """(path, file_size, offset, content): text files in blocks of whole lines; ``offset`` is the block's first byte in the file.

    A file of up to ``block_bytes`` is one block and is read as it is. A larger one is cut behind the line that fills a
    block; only a single longer line makes a larger block. Blocks of large files are stored once (``pin``).
    """
    whole = spark.read.text(directory, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    small = whole.where(F.col("_metadata.file_size") <= block_bytes).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_size"), F.lit(0).cast("long").alias("offset"), F.col("value").alias("content"))
    if whole.where(F.col("_metadata.file_size") > block_bytes).isEmpty():
        return small  # no second listing of the folder
    before, _, earlier = _windows()
    lines = placed_lines(spark, directory, glob, block_bytes).withColumn("n", F.octet_length("value") + 1)
    lines = lines.withColumn("within", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rows = F.array_sort(F.collect_list(F.struct("mid", "value")))
    blocks = pin(
        lines.groupBy("path", "file_size", "piece", F.floor(F.col("within") / block_bytes))
        .agg(F.min("within").alias("within"), F.sum("n").alias("n"), F.array_join(F.transform(rows, lambda x: x["value"]), "\n").alias("content"))
        .select("path", "file_size", "piece", "within", "n", "content"))
    pieces = blocks.groupBy("path", "piece").agg(F.sum("n").alias("total")).select(
        "path", "piece", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("shift"))
    placed = blocks.join(pieces, ["path", "piece"]).withColumn("offset", F.col("shift") + F.col("within"))
    # the last line of a file may lack its line feed
    ended = F.col("offset") + F.col("n") <= F.col("file_size")
    large = placed.select("path", "file_size", "offset", F.when(ended, F.concat("content", F.lit("\n"))).otherwise(F.col("content")).alias("content"))
    return small.unionByName(large)


def file_heads(spark: SparkSession, directory: str, head: int, glob: str = "*", whole_bytes: int = 8 << 20) -> DataFrame:
    """(path, file_size, head): size and first ``head`` bytes of files of any size.

    Files of up to ``whole_bytes`` are loaded; of larger ones the lines of the first piece stream by, and those that hold
    the first bytes are kept. Sizes come from the listing.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(directory)
    small = files.where(F.col("length") <= whole_bytes).select("path", F.col("length").alias("file_size"), F.substring("content", 1, head).alias("head"))
    if files.where(F.col("_metadata.file_size") > whole_bytes).isEmpty():
        return small  # no second listing of the folder
    before, _, _ = _windows()
    lines = placed_lines(spark, directory, glob, whole_bytes).where("piece = 0").withColumn("value", F.col("value").cast("binary"))
    first = lines.select("path", "file_size", "piece", "mid", F.octet_length("value").alias("n"), F.substring("value", 1, head).alias("value"))
    first = first.withColumn("start", F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0))).where(F.col("start") < head)
    parts = F.array_sort(F.collect_list(F.struct("mid", F.concat(F.hex("value"), F.lit("0A")).alias("bytes"))))
    joined = F.unhex(F.array_join(F.transform(parts, lambda x: x["bytes"]), ""))
    large = first.groupBy("path", "file_size").agg(joined.alias("head"))
    # the last line of a file may lack its line feed
    large = large.withColumn("head", F.substring("head", F.lit(1), F.least(F.lit(head), F.col("file_size")).cast("int")))
    return small.unionByName(large)
