"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.session import materialise

#: Words are runs of anything but ASCII blanks.
WORD = "[^\\x20\\x09-\\x0D]+"

#: Texts of one Python step together take at most about so many bytes (one longer text goes alone).
STEP_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The files outlive executors and cut the lineage; Hadoop deletes them when the application ends.
    """
    return materialise(df, f"llm-{label}")


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """``df`` with ``before_<column>``: the sum over all rows before it in ``order``, for each of ``sums``.

    Rows are dealt by ranges of the order; sums inside a range follow those of earlier ranges, of
    which there is one small row each.
    """
    kept = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = kept.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_range", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_shift_{c}") for c in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = {f"before_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_shift_{c}") for c in sums}
    return kept.join(shifts, "_range").withColumns(own).select(*df.columns, *own)


def crc_mod(key: str, n: int) -> Column:
    """Remainder of the CRC-32 of a key's text."""
    return F.crc32(F.col(key).cast("string")) % n


def steps(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of each piece take at most ``STEP_BYTES``."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(text)))
        for i, n in enumerate(sizes.to_pylist()):
            n = n or 0
            if i > start and held + n > STEP_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; NULL counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
