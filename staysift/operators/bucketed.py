"""A lookup table that is written once, bucketed by its keys, and joined many times.

Every later left join shuffles the left side alone: the lookup is read in its buckets, as
they were written. Keys that hold much of the left side skip that shuffle: the lookup is unique
per key, so the rows of a bounded number of hot keys are a bounded broadcast.

NULL keys join like values. An equality that treats NULLs as equal cannot use buckets, so the
lookup is bucketed by key texts that are never NULL.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staysift.operators.heavy_hitters import is_one_of

MAX_HOT_KEYS = 100  # keys joined by broadcast; the others take the shuffle


def key_text(column: str) -> Column:
    """A key as text that is never NULL: values after a mark, NULL as the empty text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


@dataclass
class BucketedLookup:
    """A written lookup: where it is, its keys, attributes, rows and buckets."""

    path: str
    keys: list[str]
    attrs: list[str]
    rows: int
    buckets: int
    schema: str

    @property
    def key_columns(self) -> list[str]:
        return [f"__k{i}" for i in range(len(self.keys))]

    def table(self, spark: SparkSession) -> DataFrame:
        """The lookup as a table of this session, with its buckets known to the planner."""
        name = "lookup_" + uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex
        if not spark.catalog.tableExists(name):
            by = ", ".join(self.key_columns)
            spark.sql(
                f"CREATE TABLE {name} ({self.schema}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/rows'"
            )
        return spark.table(name)

    def save(self, spark: SparkSession) -> None:
        text = json.dumps(self.__dict__)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/facts")


def write_lookup(df: DataFrame, keys: Sequence[str], attrs: Sequence[str], path: str, buckets: int | None = None) -> BucketedLookup:
    """Write ``df`` (unique per key tuple, NULL equal to NULL) as a lookup under ``path``.
    ``buckets`` defaults to the session's shuffle partitions."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = [key_text(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    rows = df.select(*texts, *attrs)
    name = "lookup_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
    by = [f"__k{i}" for i in range(len(keys))]
    # one task per bucket writes one file
    rows.repartition(n, *by).write.format("parquet").bucketBy(n, *by).sortBy(*by).option("path", f"{path}/rows").saveAsTable(name)
    facts = spark.table(name).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct(*by)).alias("keys")
    ).first()
    if facts["n"] != facts["keys"]:
        raise ValueError(f"the lookup has {facts['n']} rows for {facts['keys']} keys; it must be unique per key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    lookup = BucketedLookup(path, list(keys), list(attrs), facts["n"], n, schema)
    lookup.save(spark)
    return lookup


def open_lookup(spark: SparkSession, path: str) -> BucketedLookup:
    """A lookup written by an earlier session."""
    return BucketedLookup(**json.loads(spark.read.text(f"{path}/facts").first()["value"]))


def bucketed_left_join(left: DataFrame, lookup: BucketedLookup, hot: Sequence[tuple] = ()) -> DataFrame:
    """``left`` with the lookup's attributes (NULL where its keys have no row). The rows of
    ``left`` and their number do not change. ``hot`` names frequent keys: they are joined by
    broadcast of at most ``MAX_HOT_KEYS`` lookup rows."""
    spark = left.sparkSession
    by = lookup.key_columns
    keyed = left.withColumns({c: key_text(k) for c, k in zip(by, lookup.keys, strict=True)})
    right = lookup.table(spark)
    chosen = [*left.columns, *lookup.attrs]
    if not hot:
        return keyed.join(right.hint("merge"), by, "left").select(*chosen)
    texts = [tuple("" if v is None else f"={v}" for v in k) for k in list(hot)[:MAX_HOT_KEYS]]
    frequent = is_one_of(by, texts)
    few = F.broadcast(right.where(frequent))  # unique per key: at most one row for each hot key
    return (
        keyed.where(~frequent).join(right.hint("merge"), by, "left").select(*chosen)
        .unionByName(keyed.where(frequent).join(few, by, "left").select(*chosen))
    )
