"""Session settings the engine relies on."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings that change results or plan shape; safe to set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "fleetlens") -> SparkSession:
    """Session for tests and benches; on a cluster the submit command decides these."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names it on a cluster.  Only a local session that
    has none (tests) gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.environ.get("FLEETLENS_SCRATCH")
        if not base:
            base = tempfile.mkdtemp(prefix="fleetlens-")
            os.environ["FLEETLENS_SCRATCH"] = base
    return f"{base.rstrip('/')}/fleetlens/{label}-{uuid.uuid4().hex}"


_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scopes", default=())


def materialize(df, label: str, outer: bool = False, **options):
    """Cut lineage by writing to the shared folder and reading back.

    Survives executor loss: the rows live in the shared store, not in blocks.
    Inside a ``scratch`` block the table goes with the block, or with the block
    around it if ``outer``.  ``options`` go to the Parquet writer.
    """
    path = shared_dir(df.sparkSession, label)
    scopes = _SCOPES.get()[: -1 if outer else None]
    if scopes:
        scopes[-1].append(path)
    return land(df, path, **options)


def land(df, path: str, **options):
    """Write a new table under ``path`` and read it back."""
    with _swept(df.sparkSession):
        df.write.mode("errorifexists").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _swept(spark: SparkSession):
    """Writes in the block delete their shuffle files when they are done, not when the driver happens to collect its garbage.

    Not for other actions: what Python fetches piece by piece may still need them.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """A block whose materialised tables are deleted at its end.

    The block gets a function like ``materialize`` for the result, which stays:
    what leaves the block may read no other table of it.
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield lambda df, label: materialize(df, label, outer=True)
    finally:
        _SCOPES.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        # Spark lets go of a plan's broadcasts and shuffle files when the driver collects its garbage, which a driver at rest may not do for long
        gc.collect()
        spark._jvm.System.gc()
