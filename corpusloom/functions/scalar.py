"""Scalar column expressions on record metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket bounds and labels of the token report, bins of the year report.
TOKEN_BOUNDS = (50_000, 80_000, 100_000, 128_000)
TOKEN_LABELS = ("<50k", "50-80k", "80-100k", "100-128k", ">128k")
YEAR_BOUNDS = (2000, 2010, 2015, 2020, 2024)
YEAR_LABELS = ("<2000", "2000-2010", "2010-2015", "2015-2020", "2020-2024")


def stratum_key(code: Column) -> Column:
    """First character of a classification code."""
    return F.substring(code, 1, 1)


def safe_int(value: Column) -> Column:
    """Whole number or NULL; never an error, also under ANSI mode."""
    return F.when(value.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(value).try_cast("int"))


def digits_int(value: Column) -> Column:
    """Unsigned digit string to INT, everything else NULL."""
    return F.when(value.rlike("^[0-9]+$"), value.try_cast("int"))


def _last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def file_name_from_url(idn: Column, url: Column) -> Column:
    """``idn`` plus the extension of the URL's last segment, ``.pdf`` if it has none."""
    ext = F.regexp_extract(_last_segment(url), r"^\.*[^.].*(\.[^.]*)$", 1)
    return F.concat(idn, F.when(ext == "", ".pdf").otherwise(ext))


def url_tail(url: Column) -> Column:
    """Percent-decoded last URL segment; ``+`` stays, a bad escape leaves the segment as it is."""
    tail = _last_segment(url)
    return F.coalesce(F.try_url_decode(F.replace(tail, F.lit("+"), F.lit("%2B"))), tail)


def probe_status(status: Column, content_type: Column, length: Column, url: Column, error: Column) -> Column:
    """Classify a fetch response -> struct(status, size, filename)."""
    pdf = F.coalesce(F.contains(content_type, F.lit("application/pdf")), F.lit(False))
    found = (status == 200) & pdf & error.isNull()
    label = (
        F.when(error.isNotNull(), F.concat(F.lit("Error: "), error))
        .when(found, "Online")
        .when(status == 200, "Online (Not PDF)")
        .otherwise(F.concat(F.lit("Offline (Status: "), status.cast("string"), F.lit(")")))
    )
    return F.struct(
        label.alias("status"),
        F.when(found, F.coalesce(length, F.lit(0))).otherwise(0).cast("bigint").alias("size"),
        F.when(found, url_tail(url)).otherwise("").alias("filename"),
    )


def sanitize_name(name: Column) -> Column:
    """Every character that is no letter, digit, ``-`` or ``_`` becomes ``_``."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def half_open_bucket(value: Column, bounds, labels) -> Column:
    """Label of the half-open bucket ``value`` falls in.

    With one label more than bounds the last one takes everything from the last bound on;
    otherwise those values (and NULL) have no bucket.
    """
    out = None
    for bound, label in zip(bounds, labels):
        out = F.when(value < bound, label) if out is None else out.when(value < bound, label)
    if len(labels) > len(bounds):
        out = out.when(value >= bounds[-1], labels[-1])
    return out


def token_bucket(tokens: Column, bounds=TOKEN_BOUNDS, labels=TOKEN_LABELS) -> Column:
    """Token-length bucket; the last one includes its bound."""
    return half_open_bucket(tokens, bounds, labels)


def year_bin(year: Column, bounds=YEAR_BOUNDS, labels=YEAR_LABELS) -> Column:
    """Publication-year bin; years from the last bound on belong to none."""
    return half_open_bucket(year, bounds, labels)


def ordinal(label: Column, labels) -> Column:
    """1-based rank of ``label`` in ``labels``, for a custom sort order."""
    out = F.when(label == labels[0], 1)
    for k, name in enumerate(labels[1:], start=2):
        out = out.when(label == name, k)
    return out


def rounded_ratio(num: Column, den: Column, digits: int = 2, scale: int = 1) -> Column:
    """``scale * num / den`` rounded half up to ``digits`` places, exact integer arithmetic; NULL for den 0.

    ``num`` and ``den`` are non-negative whole numbers.
    """
    n, d = num.cast("decimal(28,0)"), F.nullif(den.cast("bigint"), F.lit(0).cast("bigint")).cast("decimal(28,0)")
    factor = scale * 10**digits
    twice = n * F.lit(2 * factor).cast("decimal(10,0)") + d
    return F.call_function("div", twice, d * F.lit(2).cast("decimal(1,0)")) / F.lit(float(10**digits))


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """Share of ``num`` in ``den`` in percent, rounded half up; NULL for an empty whole."""
    return rounded_ratio(num, den, digits, scale=100)


def micros(df, ts: str) -> Column:
    """Microseconds since the epoch of a timestamp column with or without time zone."""
    if df.schema[ts].dataType.simpleString() == "timestamp":
        return F.unix_micros(ts)
    span = F.col(ts) - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    seconds = (F.extract(F.lit("DAY"), span) * 24 + F.extract(F.lit("HOUR"), span)) * 3600 + F.extract(
        F.lit("MINUTE"), span
    ) * 60
    return seconds.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")
