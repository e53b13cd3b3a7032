"""Line and record numbers of text files, without reading a file in one task.

A file is read in splits, as always; the rows of a split are told by the block it starts at and keep
their order. Lines are counted for each split, the counts of the splits before it (one small row a
split) give its first number, and the place inside the split does the rest.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ["_file", "_split"]


def _read(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    # A task may read several splits, each from its start to its end: numbers rise without gaps in it.
    meta = {"_file": F.col("_metadata.file_path"), "_split": F.col("_metadata.file_block_start")}
    return spark.read.text(path).select("value", *[c.alias(n) for n, c in meta.items()], F.monotonically_increasing_id().alias("_at"))


def _before():
    return Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file``, ``line`` (from 1 in each file) and ``value`` of every line, blank ones too.

    Lines end with a line feed, a carriage return or both.
    """
    lines = _read(spark, path)
    splits = lines.groupBy(*_SPLIT).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    shift = F.coalesce(F.sum("_n").over(_before()), F.lit(0)) - F.col("_first") + 1
    placed = lines.join(splits.select(*_SPLIT, shift.alias("_shift")), _SPLIT)
    return placed.select(F.col("_file").alias("file"), (F.col("_at") + F.col("_shift")).alias("line"), "value")


def numbered_records(spark: SparkSession, path: str | Sequence[str], quote: str = '"') -> DataFrame:
    """``file``, ``record`` (from 1 in each file) and ``value`` of every record of delimited text.

    A line break between quotes belongs to the record and comes out as a line feed. Blank lines
    between records are no records. Whether a line starts inside quotes follows from the number of
    quotes before it: those of its split by a running sum, those of earlier splits by their sums. A
    file whose quotes don't close makes the job fail.
    """
    counted = _read(spark, path).withColumn("_quotes", F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit(""))))
    inside = Window.partitionBy(*_SPLIT).orderBy("_at")
    earlier = F.coalesce(F.sum("_quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = counted.withColumns({"_odd": earlier % 2, "_blank": F.trim("value") == ""})
    # A line starts a record if the quotes before it are even, those of earlier splits included.
    splits = lines.groupBy(*_SPLIT).agg(
        F.sum("_quotes").alias("_all"),
        *[F.count_if((F.col("_odd") == odd) & ~F.col("_blank")).alias(f"_starts{odd}") for odd in (0, 1)],
    )
    splits = splits.withColumn("_turned", F.coalesce(F.sum("_all").over(_before()), F.lit(0)) % 2)
    splits = splits.withColumn("_starts", F.when(F.col("_turned") == 0, F.col("_starts0")).otherwise(F.col("_starts1")))
    splits = splits.select(
        *_SPLIT,
        "_turned",
        F.coalesce(F.sum("_starts").over(_before()), F.lit(0)).alias("_shift"),
        (F.sum("_all").over(Window.partitionBy("_file")) % 2 == 1).alias("_open"),
    )
    placed = lines.join(splits, _SPLIT)
    between = F.col("_odd") == F.col("_turned")
    upto = F.sum((between & ~F.col("_blank")).cast("bigint")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    closed = F.when(F.col("_open"), F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("_file"))).cast("bigint")).otherwise(upto + F.col("_shift"))
    kept = placed.select("_file", closed.alias("record"), F.struct("_split", "_at", "value").alias("_line"), (between & F.col("_blank")).alias("_drop"))
    parts = kept.where(~F.col("_drop")).groupBy("_file", "record").agg(F.sort_array(F.collect_list("_line")).alias("_lines"))
    return parts.select(F.col("_file").alias("file"), "record", F.array_join("_lines.value", "\n").alias("value"))


def read_numbered_csv(spark: SparkSession, path: str, sep: str = ";", row: str = "row_number") -> DataFrame:
    """A delimited file with a header as text columns, and ``row``, the number of the data row from 1.

    Quotes are doubled inside quoted fields. An empty field is NULL.
    """
    names = next(csv.reader([spark.read.text(path).first()["value"]], delimiter=sep))
    schema = ", ".join(f"`{n.strip().replace('`', '``')}` string" for n in names)
    fields = F.from_csv("value", F.lit(schema), {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    records = numbered_records(spark, path).where("record > 1")
    return records.select((F.col("record") - 1).alias(row), fields.alias("_f")).select(row, "_f.*")
