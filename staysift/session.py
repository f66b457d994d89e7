"""Spark session helpers shared by jobs, tests and the bench.

Cluster jobs get their session from the platform; the helpers here only fill in
settings that are unset, so an operator's choice always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. AQE re-plans joins and
# aggregations at runtime (coalescing small shuffle partitions, converting a
# sort-merge join to a broadcast join once the real size is known, splitting
# skewed partitions).
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of DataFrames that went out of scope are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "staysift",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with this package's defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control of it on
    a cluster. Local runs pass ``local[N]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder and
    is used as is. Only a local session without the setting, as in tests, gets a
    fresh folder under the temp directory.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "before running jobs that cut lineage"
            )
        current = tempfile.mkdtemp(prefix="staysift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def materialize(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where a plan is reused by several jobs (fitting a feature pipeline,
    cross-validation); a lost executor then re-reads the checkpoint instead of
    replaying the whole upstream lineage. Never a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df):
    """Deal the rows over all cores when the input comes in fewer splits.

    A gzip file, a multi-line CSV file or a Parquet file of one row group is a single
    split, and the text expressions that follow would run in one task. Only a plan
    without an exchange is looked at (asking it for its partitions runs nothing);
    streams and anything with enough splits are returned as they are. Rows do not change.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def tasks_of(df, rows: int, max_rows: int, *keys: str):
    """``df`` of ``rows`` rows dealt over as many partitions as keep each at ``max_rows`` or
    fewer on average (by ``keys``, if given), where that is more than the cores; else ``df``. A
    plan without an exchange that has so many partitions already stays as it is."""
    n = -(-rows // max_rows)
    if n <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    if not keys and "Exchange" not in df._jdf.queryExecution().executedPlan().toString() and df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n, *keys)


def written(df, tag: str, **options):
    """Write ``df`` as Parquet (with the writer's ``options``) under the shared checkpoint folder and
    read it back: cuts the lineage like a checkpoint, but keeps columns prunable and filters pushable."""
    path = scratch_path(df.sparkSession, f"{tag}-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20  # of one Arrow batch on its way to a Python worker


def bounded_batches(df, max_bytes: int = BATCH_BYTES):
    """``df``, with Arrow batches of its session cut by bytes as well as by rows: ten thousand
    long texts in one batch would fill a worker. A smaller limit of the session stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int((conf.get(key, None) or str(max_bytes + 1)).rstrip("b")) > max_bytes:
        conf.set(key, str(max_bytes))
    return df


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through the file system that its path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
