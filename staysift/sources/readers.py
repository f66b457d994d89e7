"""Scans: messy CSVs, the joined Parquet table, run metrics, previews.

CSV files are read as text columns with the header row and no schema
inference; canonicalisation and casting happen in explicit projections. Column
pruning is a ``select`` right after the scan, which Spark pushes into the CSV
and Parquet readers.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from staysift.operators.schema import (
    GAZETTEER_KEEP_KEYS,
    JOINED_COLUMNS,
    LISTING_CLEANING_COLUMNS,
    LISTING_HEADER_ALIASES,
    header_key,
    keep_columns_by_key,
    null_missing_tokens,
    rename_aliases,
    require_columns,
    strip_headers,
)

REPLACEMENT_CHAR = "\ufffd"
FALLBACK_ENCODING = "ISO-8859-1"


def csv_reader(spark: SparkSession, encoding: str, multi_line: bool, malformed: str = "keep") -> DataFrameReader:
    """The CSV dialect of all sources: header row, doubled quotes, no type inference."""
    return (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("inferSchema", False)
        .option("mode", "FAILFAST" if malformed == "fail" else "PERMISSIVE")
    )


def _csv(spark: SparkSession, path: str, encoding: str, multi_line: bool, malformed: str = "keep") -> DataFrame:
    if malformed not in ("keep", "fail"):
        raise ValueError("malformed must be 'keep' or 'fail'")
    return csv_reader(spark, encoding, multi_line, malformed).csv(path)


def has_decode_errors(df: DataFrame) -> bool:
    """True when any value holds U+FFFD (Spark's marker for undecodable bytes).
    Stops at the first hit; a clean file is scanned once."""
    if not df.columns:
        return False
    row_text = F.concat_ws("\u0001", *[F.col(f"`{c}`") for c in df.columns])
    return df.where(F.instr(row_text, REPLACEMENT_CHAR) > 0).limit(1).count() > 0


def _utf8_or_latin1(name: str) -> str:
    try:
        return name.encode("latin-1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return name


def redecode_utf8(df: DataFrame) -> DataFrame:
    """Per value: the UTF-8 reading of its bytes when they are valid UTF-8, else
    the ISO-8859-1 text as read. Applied to a frame read as ISO-8859-1 (a
    lossless byte-to-char mapping); headers are re-decoded the same way."""
    cols = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        as_utf8 = F.try_validate_utf8(F.encode(c, FALLBACK_ENCODING).cast("string"))
        cols.append(F.coalesce(as_utf8, c).alias(_utf8_or_latin1(name)))
    return df.select(*cols)


def read_text_csv(
    spark: SparkSession,
    path: str,
    encoding: str | None = None,
    multi_line: bool = False,
    fallback: str = "value",
    malformed: str = "keep",
) -> DataFrame:
    """CSV with every column as text.

    With ``encoding=None`` the file is UTF-8 where it decodes and ISO-8859-1
    where it does not:

    * ``fallback="value"`` (default, one pass): read as ISO-8859-1, which maps
      bytes 1:1 and parses identically (delimiters and quotes are ASCII, never
      part of a UTF-8 multi-byte sequence), then re-decode each value as UTF-8
      where its bytes are valid UTF-8;
    * ``fallback="file"``: read as UTF-8 and, if any value failed to decode,
      re-read the whole input as ISO-8859-1 (two passes over a clean input).

    ``multi_line=True`` keeps quoted fields with line breaks whole; it makes each
    file a single split, so large inputs should come as many files. A row with too
    few or too many fields is padded or cut (``malformed="keep"``) or an error
    (``malformed="fail"``); ``checked_csv.land_csv`` sets such rows apart and counts them.
    """
    if encoding is not None:
        return _csv(spark, path, encoding, multi_line, malformed)
    if fallback == "value":
        return redecode_utf8(_csv(spark, path, FALLBACK_ENCODING, multi_line, malformed))
    df = _csv(spark, path, "UTF-8", multi_line, malformed)
    if has_decode_errors(df):
        df = _csv(spark, path, FALLBACK_ENCODING, multi_line, malformed)
    return df


def read_listings_csv(
    spark: SparkSession,
    path: str,
    encoding: str | None = None,
    columns: str = "cleaning",
    limit: int | None = None,
    multi_line: bool = True,
    malformed: str = "keep",
) -> DataFrame:
    """Listings CSV: optional pruning to the cleaning columns, missing tokens
    to NULL (except the country code: ``NA`` is Namibia), optional first-N.

    Listings hold free text, so quoted line breaks are read as part of their value by
    default. Each file is then one split: deliver a large input as many files, or pass
    ``multi_line=False`` for one known to have no line breaks inside values."""
    df = listing_columns(read_text_csv(spark, path, encoding, multi_line, malformed=malformed), columns)
    return df.limit(limit) if limit is not None else df


def listing_columns(df: DataFrame, columns: str = "cleaning") -> DataFrame:
    """Listings as read: pruned (``columns="cleaning"``), headers stripped, missing tokens NULL."""
    if columns == "cleaning":
        df = keep_columns_by_key(df, LISTING_CLEANING_COLUMNS, LISTING_HEADER_ALIASES)
    df = strip_headers(df)
    return null_missing_tokens(df, exclude=[c for c in df.columns if header_key(c) == "countycode"])


def read_gazetteer_csv(
    spark: SparkSession,
    path: str,
    encoding: str = "UTF-8",
    columns: str = "cleaning",
    limit: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Gazetteer CSV; ``columns='cleaning'`` keeps Country, City, Population."""
    df = gazetteer_columns(read_text_csv(spark, path, encoding, multi_line), columns)
    return df.limit(limit) if limit is not None else df


def gazetteer_columns(df: DataFrame, columns: str = "cleaning") -> DataFrame:
    """The gazetteer as read: pruned (``columns="cleaning"``), missing tokens NULL."""
    if columns == "cleaning":
        df = keep_columns_by_key(df, GAZETTEER_KEEP_KEYS)
    return null_missing_tokens(strip_headers(df), exclude=["Country"])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_text_csv(spark, path, "UTF-8")


def read_joined(spark: SparkSession, path: str) -> DataFrame:
    """Joined Parquet table: alias columns renamed, required columns checked."""
    df = rename_aliases(spark.read.parquet(path))
    require_columns(df, JOINED_COLUMNS, "joined table")
    return df


def find_table_file(spark: SparkSession, root: str, stem: str, suffix: str = ".parquet") -> str:
    """Locate the table ``<stem>*<suffix>`` under ``root`` (recursively), as a
    single file or a Spark-written directory of part files: the exact name wins,
    else the first match in sorted order. The listing runs through Spark's file
    index (any Hadoop file system); only the distinct table paths reach the
    driver."""
    import re

    pattern = rf"^(.*?/{re.escape(stem)}[^/]*{re.escape(suffix)})(/|$)"
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(F.regexp_extract("path", pattern, 1).alias("table"))
        .where(F.col("table") != "")
        .distinct()
    )
    tables = sorted(r.table for r in listing.collect())
    if not tables:
        raise FileNotFoundError(f"no {stem}*{suffix} under {root}")
    exact = [t for t in tables if t.rstrip("/").rsplit("/", 1)[-1] == f"{stem}{suffix}"]
    return exact[0] if exact else tables[0]


def read_datasets(
    spark: SparkSession,
    catalog: Mapping[str, str],
    names: Iterable[str],
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Resolve datasets by (case-insensitive) name in a catalogue of paths; an
    error lists every name that is missing."""
    lowered = {k.lower(): v for k, v in catalog.items()}
    wanted = list(names)
    missing = [n for n in wanted if n.lower() not in lowered]
    if missing:
        raise FileNotFoundError(f"datasets not in catalogue: {missing}; known: {sorted(catalog)}")
    out = {}
    for n in wanted:
        p = lowered[n.lower()]
        out[n] = read_text_csv(spark, p) if fmt == "csv" else spark.read.format(fmt).load(p)
    return out


def peek(spark: SparkSession, path: str, n: int = 5, encoding: str | None = None) -> DataFrame:
    """First ``n`` rows of a CSV."""
    return read_text_csv(spark, path, encoding, multi_line=True).limit(n)


def head_lines(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First ``n`` raw lines of a text file."""
    return spark.read.text(path).limit(n)


def read_run_metrics(spark: SparkSession, pattern: str) -> DataFrame:
    """All runs' metrics JSON files, with the run folder as ``run``."""
    df = spark.read.option("multiLine", True).json(pattern)
    return df.withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))


def read_expanded_source(spark: SparkSession, path: str) -> DataFrame:
    """All listing columns, ISO-8859-1, stripped headers (expanded analysis)."""
    return strip_headers(read_text_csv(spark, path, FALLBACK_ENCODING, multi_line=True))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate several loads by column name; a column missing from one
    source is NULL there. An empty list is an error (nothing to infer from)."""
    if not frames:
        raise ValueError("no sources to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
