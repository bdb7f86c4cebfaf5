"""S3: payload files as a stream, each processed once and then archived."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlens.operators.loaders import LOAD_ORDER, load_tables
from fleetlens.sources.payloads import parse_payloads, validate_payloads
from fleetlens.sources.store import TableStore


def payload_stream(spark: SparkSession, path: str, archive: str | None = None, files: int | None = None) -> DataFrame:
    """Parsed documents as they arrive, ``files`` at most per micro-batch; finished ones move to ``archive`` if given."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
    )
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    raw = reader.load(path).select("value", F.col("_metadata.file_path").alias("file_path"))
    return parse_payloads(raw)


def stream_payloads(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    handle: Callable[[DataFrame, DataFrame, int], None],
    archive: str | None = None,
    available_now: bool = True,
    files: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``handle(valid, rejected, batch_id)`` sees every micro-batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        handle(*validate_payloads(batch), batch_id)

    writer = payload_stream(spark, path, archive, files).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def table_sink(
    store: TableStore, as_of, rejected_path: str | None = None, tables: tuple[str, ...] = LOAD_ORDER, source: str = "payloads"
):
    """Handler that loads valid documents and keeps the rejected ones with their reason.

    A repeated micro-batch of ``source`` changes nothing.  ``as_of`` may be a
    function that a long stream asks for the time of each batch.
    """

    def handle(valid: DataFrame, rejected: DataFrame, batch_id: int) -> None:
        load_tables(valid, store, as_of() if callable(as_of) else as_of, tables, (source, batch_id))
        if rejected_path:
            rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")

    return handle
