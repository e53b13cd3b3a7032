"""Streams of resources: parsing, pseudonymising, routing, upserts, incremental pulls."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cohortloom.functions.deid import hmac_sha256
from cohortloom.operators.deident import pseudonymise_resources
from cohortloom.sources import files
from cohortloom.sources.resources import bundle_entries, parse_resources
from cohortloom.streaming.state import BUCKETS, upsert_writer


def stream_bundle_files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Raw bundle text as it arrives in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path, wholetext=True)


def stream_bundle_topics(spark: SparkSession, servers: str, topics: str) -> DataFrame:
    """Raw bundles from a message broker, where its connector is installed."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topics)
        .option("startingOffsets", "earliest")
        .load()
        .select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    )


def stream_resources(bundles: DataFrame, resource_type: str, text: str = "value") -> DataFrame:
    """Typed resources of a bundle stream."""
    return parse_resources(bundle_entries(bundles, text), resource_type)


def stream_pseudonymise(resources: DataFrame, key: bytes) -> DataFrame:
    return pseudonymise_resources(resources, key)


def route_topics(
    messages: DataFrame, key: bytes, old: str = "fhir.", new: str = "fhir.pseudonymized."
) -> DataFrame:
    """Output topic from the input topic, message key hashed."""
    return messages.withColumns(
        {
            "topic": F.regexp_replace("topic", "^\\Q" + old + "\\E", new),
            "key": hmac_sha256("key", key),
        }
    )


def upsert_latest(
    stream: DataFrame, root: str, checkpoint: str, key: Sequence[str], order: Sequence[str], *, writer: str = "stream", buckets: int = BUCKETS
) -> StreamingQuery:
    """Start the upsert of everything available into a state table and return the query.

    ``writer`` names the stream: a new checkpoint counts its batches anew, and needs a new name
    unless it repeats the same batches.
    """
    return _available(stream, checkpoint, "append").foreachBatch(upsert_writer(root, key, order, writer=writer, buckets=buckets)).start()


def _available(stream: DataFrame, checkpoint: str, mode: str) -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def routed_writer(root: str) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: each batch in a folder of its own, in it one for each topic.

    All topics go in one write; a batch that runs again replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("topic").parquet(f"{root.rstrip('/')}/batch={batch_id:012d}")

    return write


def route_stream(messages: DataFrame, root: str, checkpoint: str, key: bytes, old: str = "fhir.", new: str = "fhir.pseudonymized.") -> StreamingQuery:
    """Start routing everything available by topic, message keys hashed, and return the query."""
    return _available(route_topics(messages, key, old, new), checkpoint, "append").foreachBatch(routed_writer(root)).start()


def read_routed(spark: SparkSession, root: str, schema: str, topic: str | None = None) -> DataFrame:
    """Messages of one topic, or all, out of the batches that were written to the end.

    ``schema`` declares the columns of the messages without their topic.
    """
    root = root.rstrip("/")
    whole = [n for n in files.list_names(spark, root) if n.startswith("batch=") and files.exists(spark, f"{root}/{n}/_SUCCESS")]
    if not whole:
        return spark.createDataFrame([], f"{schema}, topic string")
    found = spark.read.schema(f"{schema}, topic string, batch bigint").option("basePath", root).parquet(*[f"{root}/{n}" for n in whole])
    return (found if topic is None else found.where(F.col("topic") == topic)).drop("batch")


def poll_increment(stream: DataFrame, target: str, checkpoint: str):
    """Append what is new since the last run and stop; the checkpoint keeps the position."""
    return (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_dq_counts(
    uncoded: DataFrame, by: Sequence[str | Column], time: str | None = None, width: str = "1 day", late: str = "1 day"
) -> DataFrame:
    """Running counts of uncoded texts, for update or complete mode.

    With ``time`` they are counts per ``window`` of ``width``; rows that come more than ``late`` after
    the newest time seen are left out, and windows that old leave the state.
    """
    if time is None:
        return uncoded.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))
    timed = uncoded.withWatermark(time, late).groupBy(F.window(time, width).alias("_window"), *by)
    counted = timed.agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.col("_window.start").alias("window_start"), *[c for c in counted.columns if c != "_window"])


def keep_counts(counts: DataFrame, root: str, checkpoint: str, key: Sequence[str], *, writer: str = "stream", buckets: int = BUCKETS) -> StreamingQuery:
    """Start keeping running counts (update mode) in a state table and return the query.

    Counts of a key only grow, so the greatest is the newest, whatever order batches are read in.
    """
    return _available(counts, checkpoint, "update").foreachBatch(upsert_writer(root, key, ["count"], writer=writer, buckets=buckets)).start()
