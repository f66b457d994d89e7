"""CSV landing with rejected rows kept apart.

A row with more or fewer fields than the header is neither cut nor padded: it goes to a
dead-letter table with its file, the reason and its raw text. One scan of the CSV parses every
row and writes both kinds, so that later steps read columns of a Parquet table and never
parse the text again. The share of rejected rows is counted and a job fails beyond a limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from staysift.sources.readers import FALLBACK_ENCODING, csv_reader, redecode_utf8

RAW = "__raw"  # holds a record's text where it does not fit the header
REJECTED_SCHEMA = "file string, reason string, fields int, expected int, raw string"


class RejectedRowsError(RuntimeError):
    """More rows were rejected than the caller allows."""


@dataclass
class LandedCsv:
    kept: DataFrame  # the header's columns, as text
    rejected: DataFrame  # columns of REJECTED_SCHEMA
    rows: int
    rejected_rows: int
    path: str


def _reasons(raw: str, width: int) -> list:
    """Columns ``reason``, ``fields`` and ``expected`` of a rejected record."""
    bare = F.regexp_replace(raw, r'"(?:[^"]|"")*"', "")  # without its quoted parts
    fields = (F.regexp_count(bare, F.lit(",")) + 1).cast("int")
    reason = (
        F.when(F.instr(bare, '"') > 0, "unclosed quote")
        .when(fields > width, "too many fields")
        .when(fields < width, "too few fields")
        .otherwise("unreadable")
    )
    return [reason.alias("reason"), fields.alias("fields"), F.lit(width).cast("int").alias("expected")]


def land_csv(
    spark: SparkSession,
    path: str,
    landing: str,
    encoding: str | None = None,
    multi_line: bool = True,
    max_rejected_share: float = 0.01,
    limit: int | None = None,
) -> LandedCsv:
    """Parse a CSV once into ``landing`` (a folder): rows that fit the header, as text columns,
    and rejected rows. More than ``max_rejected_share`` of the rows rejected is an error, after
    both are written, that counts the reasons and says where the rows are.

    ``encoding=None`` reads each value as UTF-8 where its bytes are valid UTF-8 and as
    ISO-8859-1 elsewhere. ``limit`` lands the first rows only. A file with a header alone
    gives no rows; a folder without files is an error of the scan.
    """
    charset = encoding or FALLBACK_ENCODING
    names = csv_reader(spark, charset, multi_line).csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in [*names, RAW]])
    scan = csv_reader(spark, charset, multi_line).option("columnNameOfCorruptRecord", RAW).schema(schema).csv(path)
    scan = scan.withColumn("__file", F.col("_metadata.file_path"))
    if limit is not None:
        scan = scan.limit(limit)
    if encoding is None:
        scan = redecode_utf8(scan)
    names = [c for c in scan.columns if c not in (RAW, "__file")]
    plain = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]  # any header is a valid name this way
    landed = scan.select(*plain, RAW, "__file", F.col(RAW).isNotNull().alias("__rejected"))
    landed.write.partitionBy("__rejected").parquet(landing)
    back = spark.read.schema(landed.schema).parquet(landing)
    bad = back.where("__rejected")
    rejected = bad.select(F.col("__file").alias("file"), *_reasons(RAW, len(names)), F.col(RAW).alias("raw"))
    kept = back.where("NOT __rejected").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
    rows, n_bad = back.count(), bad.count()
    if n_bad > max_rejected_share * rows:
        reasons = {r["reason"]: r["n"] for r in rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
        raise RejectedRowsError(
            f"{n_bad} of {rows} rows of {path} do not fit its {len(names)} columns, more than the share of "
            f"{max_rejected_share} that is allowed: {reasons}; they are in {landing}/__rejected=true"
        )
    return LandedCsv(kept, rejected, rows, n_bad, landing)
