"""Incremental clean + enrich of listing files as they land.

The batch chunk loop of the source project becomes a Structured Streaming
query: new files in ``input_dir`` are read with an explicit schema, cleaned by
the same row-local column expressions as the batch job, enriched with the
de-duplicated gazetteer, and appended to Parquet. ``trigger(availableNow=True)``
processes what is there and stops; a processing-time trigger keeps it running.

* A lookup whose counted size allows a broadcast is joined inside the streaming plan:
  stateless, and a restart from the checkpoint resumes exactly.
* A larger one is written once, bucketed by its keys (``operators.bucketed``), and joined batch by
  batch (:func:`enrich_stream_large`). No action ever runs on the stream itself. Frequent keys
  are a small summary that is carried from batch to batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from staysift.functions.text import to_number
from staysift.operators.bucketed import MAX_HOT_KEYS, BucketedLookup, bucketed_left_join, write_lookup
from staysift.operators.enrich import JOIN_BROADCAST_MAX_ROWS, clean_listings, null_safe_left_join
from staysift.operators.heavy_hitters import KeySummary, summarise_keys
from staysift.operators.schema import finalize_joined
from staysift.session import delete_path, path_exists, scratch_path, written

KEYS = ["country_iso2", "city_join_key"]
ATTRS = ["city_population"]


def _listing_stream(spark, input_dir: str, schema: StructType, fmt: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a landed file is often one split: its texts are dealt over all cores before they are parsed
    return reader.load(input_dir).repartition(spark.sparkContext.defaultParallelism)


def population_lookup(gazetteer_clean: DataFrame) -> DataFrame:
    """The gazetteer's part that listings are enriched with: the keys and ``city_population``."""
    return gazetteer_clean.select(*KEYS, to_number("Population").alias("city_population"))


def enrich_stream(
    spark: SparkSession,
    input_dir: str,
    schema: StructType,
    gazetteer_clean: DataFrame | None,
    country_dim: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    interval: str = "30 seconds",
    broadcast_max_rows: int = JOIN_BROADCAST_MAX_ROWS,
    lookup: BucketedLookup | None = None,
):
    """Start the streaming clean-and-enrich query; returns the StreamingQuery. Without
    ``available_now`` a micro-batch starts every ``interval``. A gazetteer of more than
    ``broadcast_max_rows`` rows, or a ``lookup`` written before (then no gazetteer is needed),
    is joined by :func:`enrich_stream_large`."""
    if lookup is None:
        # the static side of a stream-static join is re-evaluated every micro-batch: write it once
        right = written(population_lookup(gazetteer_clean), "gazetteer")
        rows = right.count()
        if rows > broadcast_max_rows:
            lookup = write_lookup(right, KEYS, ATTRS, scratch_path(spark, f"lookup-{uuid.uuid4().hex}"))
    if lookup is not None:
        return enrich_stream_large(
            spark, input_dir, schema, lookup, country_dim, output_dir, checkpoint_dir, fmt,
            available_now, max_files_per_trigger, interval,
        )
    cleaned = clean_listings(_listing_stream(spark, input_dir, schema, fmt, max_files_per_trigger), country_dim)
    joined = finalize_joined(null_safe_left_join(cleaned, right, KEYS, ATTRS, right_rows=rows, broadcast_max_rows=broadcast_max_rows))
    writer = (
        joined.writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    return _started(writer, available_now, interval)


def _started(writer, available_now: bool, interval: str):
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


class HotKeyState:
    """The summary of frequent keys, as of the end of each micro-batch, beside the checkpoint.
    A batch that is repeated after a failure starts from the same summary as before."""

    def __init__(self, spark: SparkSession, checkpoint_dir: str, capacity: int):
        self.spark, self.base, self.capacity = spark, f"{checkpoint_dir.rstrip('/')}/hot-keys", capacity

    def before(self, batch_id: int) -> KeySummary:
        path = f"{self.base}/{batch_id - 1}"
        if batch_id == 0 or not path_exists(self.spark, f"{path}/_SUCCESS"):
            return KeySummary(self.capacity)
        return KeySummary.from_json(self.spark.read.text(path).first()["value"])

    def after(self, batch_id: int, summary: KeySummary) -> None:
        one = self.spark.createDataFrame([(summary.to_json(),)], "value string").coalesce(1)
        one.write.mode("overwrite").text(f"{self.base}/{batch_id}")
        delete_path(self.spark, f"{self.base}/{batch_id - 2}")  # a repeated batch needs the last one only


def enrich_stream_large(
    spark: SparkSession,
    input_dir: str,
    schema: StructType,
    lookup: BucketedLookup,
    country_dim: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    interval: str = "30 seconds",
    hot_share: float = 0.01,
    capacity: int = 1000,
):
    """The same query for a lookup that is too large to broadcast.

    Each micro-batch is cleaned and written once; its keys are added to the running summary;
    keys that may hold ``hot_share`` of all rows so far (at most ``MAX_HOT_KEYS``, the commonest)
    are joined by a broadcast of their lookup rows, all others by a merge join that shuffles the
    batch only. A batch writes its own folder ``batch_id=N`` and replaces it when it is
    repeated, so each listing is in the output once; readers get ``batch_id`` as a column more."""
    state = HotKeyState(spark, checkpoint_dir, capacity)
    listings = clean_listings(_listing_stream(spark, input_dir, schema, fmt, max_files_per_trigger), country_dim)

    def enrich(batch: DataFrame, batch_id: int) -> None:
        cleaned = written(batch, f"stream-batch-{batch_id}")
        summary = state.before(batch_id).merge(summarise_keys(cleaned, KEYS, capacity))
        joined = finalize_joined(bucketed_left_join(cleaned, lookup, summary.above(hot_share)[:MAX_HOT_KEYS]))
        joined.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch_id={batch_id}")
        state.after(batch_id, summary)
        for folder in {f.rsplit("/", 1)[0] for f in cleaned.inputFiles()}:
            delete_path(spark, folder)

    writer = listings.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint_dir)
    return _started(writer, available_now, interval)


def read_enriched(spark: SparkSession, output_dir: str) -> DataFrame:
    """The enriched listings of either query, without the batch they came in."""
    out = spark.read.parquet(output_dir)
    return out.drop("batch_id")
