"""State tables: the newest row of each key, kept up to date by micro-batches.

Keys are hashed into a fixed number of buckets. A batch rewrites the buckets it touches into a
version of its own; a manifest, one small file for each version, then says which version holds each
bucket, and which batch of which writer came last. Readers follow the newest manifest, so they see
a batch as a whole or not at all, and the state is one set of buckets however many batches ran. A
batch that runs again is recognised; files that a lost writer left without a manifest are written
anew by the next attempt. One writer at a time: a second one meets its manifest and fails.

    <root>/data/version=<n>/bucket=<b>/   rows of the bucket
    <root>/manifests/<n>.json             buckets, key, order, last batch of each writer
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.ordering import top_per_key
from cohortloom.sources import files

BUCKETS = 64


def latest_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_per_key(df, key, [F.col(o).desc_nulls_last() for o in order])


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The newest manifest of a state table, None before the first batch."""
    names = [n for n in files.list_names(spark, f"{root.rstrip('/')}/manifests") if n.endswith(".json") and not n.startswith("_")]
    return json.loads(files.read_small(spark, f"{root.rstrip('/')}/manifests/{names[-1]}")) if names else None


def _read(spark: SparkSession, root: str, told: dict, buckets: Sequence[int]) -> DataFrame | None:
    data = f"{root.rstrip('/')}/data"
    held = told["buckets"]
    paths = [f"{data}/version={held[str(b)]:012d}/bucket={b}" for b in buckets if str(b) in held]
    if not paths:
        return None
    schema = _schema(told)
    return spark.read.schema(schema).parquet(*paths)


def _schema(told: dict):
    from pyspark.sql.types import StructType

    return StructType.fromJson(told["schema"])


def current_state(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of every key. A state table without a batch is an error."""
    told = manifest(spark, root)
    if told is None:
        raise FileNotFoundError(f"no batch has been written to {root}")
    state = _read(spark, root, told, [int(b) for b in told["buckets"]])
    return spark.createDataFrame([], _schema(told)) if state is None else state


def upsert_batch(
    batch: DataFrame, batch_id: int, root: str, key: Sequence[str], order: Sequence[str], *, writer: str = "stream", buckets: int = BUCKETS
) -> bool:
    """Put a batch into the state table; False where the table holds this batch of ``writer`` already.

    Of rows with one key the newest by ``order`` stays, over the batch and what the table has. The
    number of buckets is fixed by the first batch. Only touched buckets are read and written.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    key, order = list(key), list(order)
    told = manifest(spark, root)
    if told is None:
        told = {"version": -1, "n": buckets, "key": key, "order": order, "buckets": {}, "batches": {}, "schema": json.loads(batch.schema.json())}
    if told["key"] != key or told["order"] != order:
        raise ValueError(f"{root} is kept by {told['key']} and {told['order']}")
    if told["batches"].get(writer, -1) >= batch_id:
        return False
    version = told["version"] + 1
    newest = latest_rows(batch, key, order).withColumn("bucket", _bucket(key, told["n"]))
    newest.write.mode("overwrite").parquet(f"{root}/incoming")
    newest = spark.read.schema(newest.schema).parquet(f"{root}/incoming")
    touched = sorted(r[0] for r in newest.select("bucket").distinct().collect())  # at most one row a bucket
    if touched:
        rows = newest
        if (before := _read(spark, root, told, touched)) is not None:
            both = newest.drop("bucket").unionByName(before, allowMissingColumns=True)
            rows = latest_rows(both, key, order).withColumn("bucket", _bucket(key, told["n"]))
        written = f"{root}/data/version={version:012d}"
        rows.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(written)
        told["schema"] = json.loads(rows.drop("bucket").schema.json())
    told |= {"version": version, "batches": told["batches"] | {writer: batch_id}, "buckets": told["buckets"] | {str(b): version for b in touched}}
    files.write_small(spark, f"{root}/manifests/{version:012d}.json", json.dumps(told))
    return True


def upsert_writer(root: str, key: Sequence[str], order: Sequence[str], *, writer: str = "stream", buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, root, key, order, writer=writer, buckets=buckets)

    return write


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete buckets and manifests that none of the last ``keep`` manifests needs; how many buckets
    went. Readers of older versions must have ended."""
    root = root.rstrip("/")
    names = [n for n in files.list_names(spark, f"{root}/manifests") if n.endswith(".json") and not n.startswith("_")]
    kept = [json.loads(files.read_small(spark, f"{root}/manifests/{n}")) for n in names[-keep:]]
    needed = {(v, int(b)) for m in kept for b, v in m["buckets"].items()}
    gone = 0
    for name in files.list_names(spark, f"{root}/data"):
        version = int(name.partition("=")[2])
        held = [n for n in files.list_names(spark, f"{root}/data/{name}") if n.startswith("bucket=")]
        unused = [n for n in held if (version, int(n.partition("=")[2])) not in needed]
        if kept and version <= kept[-1]["version"]:
            for n in unused:
                files.delete(spark, f"{root}/data/{name}/{n}")
            gone += len(unused)
    for n in names[:-keep]:
        files.delete(spark, f"{root}/manifests/{n}")
    return gone
