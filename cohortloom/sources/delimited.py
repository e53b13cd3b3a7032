"""Delimited text: tables, code lists, code books, drug exports."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortloom.operators.linkage import column_bind
from cohortloom.sources import files
from cohortloom.sources.lines import numbered_lines, read_numbered_csv


def read_csv_table(
    spark: SparkSession,
    path: str | Sequence[str],
    types: str,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Delimited input with a header row and declared types (DDL text)."""
    return (
        spark.read.schema(types)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .csv(path)
    )


def read_code_list(spark: SparkSession, path: str, col: str = "icd_code") -> DataFrame:
    """Distinct, trimmed codes of a one-column list."""
    codes = spark.read.option("header", True).schema(f"`{col}` string").csv(path)
    return codes.select(F.trim(col).alias(col)).where(F.col(col) != "").distinct()


def code_book(lines: DataFrame, code_idx: int = 6, title_idx: int = 8, min_fields: int = 9) -> DataFrame:
    """Code and title out of raw ``;`` lines; lines with too few fields are headings."""
    parts = F.split("value", ";")
    return (
        lines.select(parts.alias("_p"))
        .where(F.size("_p") >= min_fields)
        .select(F.col("_p")[code_idx].alias("code"), F.col("_p")[title_idx].alias("title"))
    )


def read_fixed_code_file(
    spark: SparkSession, path: str, code_idx: int = 6, title_idx: int = 8
) -> DataFrame:
    return code_book(spark.read.text(path), code_idx, title_idx)


def raw_field(line: Column | str, index: int, sep: str = ";") -> Column:
    """Field of a physical line, quotes taken literally; NULL when the line is too short."""
    c = F.col(line) if isinstance(line, str) else line
    return F.get(F.split(c, "\\Q" + sep + "\\E"), F.lit(index))


def read_raw_column(spark: SparkSession, path: str, name: str, sep: str = ";", row: str | None = None) -> DataFrame:
    """One column of a file whose quoting is broken, split on the separator alone.

    ``short_line`` marks rows without that field, blank lines among them. Only the header line of
    each file goes, not rows that happen to equal it. With ``row`` the rows of each file are
    numbered from 1 in a column of that name.
    """
    header = spark.read.text(path).first()["value"]
    index = [h.strip().strip('"') for h in header.split(sep)].index(name)
    lines = numbered_lines(spark, path).where("line > 1")
    field = raw_field("value", index, sep)
    number = [] if row is None else [(F.col("line") - 1).alias(row)]
    return lines.select(*number, field.alias(name), field.isNull().alias("short_line"))


def add_raw_column(spark: SparkSession, original: str, other: str, name: str, sep: str = ";") -> DataFrame:
    """A table with one more column, taken row by row from a file whose quoting is broken.

    Both files must have as many rows: a row without partner makes the job fail. Rows carry their
    number as ``row_number``.
    """
    added = read_raw_column(spark, other, name, sep, row="row_number").drop("short_line")
    return column_bind(read_numbered_csv(spark, original, sep).drop(name), added, "row_number", [name])


def _names(header: str, sep: str, trim: bool) -> tuple[str, ...]:
    """Column names of a header line: empty ones by position, repeated ones with their position."""
    names = next(csv.reader([header], delimiter=sep), [])
    names = [n.strip() if trim else n for n in names]
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    return tuple(f"{n}{i}" if names.count(n) > 1 else n for i, n in enumerate(names))


def csv_files_by_header(
    spark: SparkSession, paths: Iterable[str], sep: str = ";", *, trim: bool = False
) -> dict[tuple[str, ...], DataFrame]:
    """Text tables with a header, one scan for each distinct header: its names to the rows of all
    files that have it, with the given path of each row as ``_path``.

    Headers are read as data, the first line of each file; then each scan has the list of its files
    and their columns as a schema. ``paths`` may name files or folders of files, thousands of them;
    what is kept for a file on the driver is its name.
    """
    of_header: dict[tuple[str, ...], list[tuple[str, str, str]]] = {}
    for path in paths:
        for file, address in files.data_files(spark, path):
            of_header.setdefault(_names(files.first_line(spark, file), sep, trim), []).append((file, address, path))
    out = {}
    for names, found in of_header.items():
        schema = StructType([StructField(n, StringType()) for n in names])
        rows = spark.read.schema(schema).option("header", True).option("sep", sep).csv([file for file, _, _ in found])
        owner = spark.createDataFrame([x[1:] for x in found], "_file string, _path string")
        placed = rows.select(*[F.col(f"`{n}`") for n in names], files.address().alias("_file"))
        out[names] = placed.join(owner, "_file").drop("_file")
    return out


def _united(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_csv_files(spark: SparkSession, paths: Iterable[str], sep: str = ";") -> DataFrame:
    """Several exports with differing columns, all text, matched by column name; one scan for each
    distinct header."""
    return _united(csv_files_by_header(spark, paths, sep).values()).drop("_path")


def csv_names(spark: SparkSession, directory: str) -> list[str]:
    """Names of the CSV files and folders of a directory, by the file system that holds it."""
    return [n for n in files.list_names(spark, directory) if n.lower().endswith(".csv")]


def _whole_counts(df: DataFrame) -> DataFrame:
    counts = {c: F.col(c).try_cast("double").cast("bigint") for c in df.columns if c == "count" or c.endswith("_count")}
    return df.withColumns(counts) if counts else df


def read_merged_rows(spark: SparkSession, directory: str, names: Iterable[str] | None = None, sep: str = ";") -> DataFrame:
    """All merged tables of a directory as one: ``table`` (the file's name), then every column of
    any of them, NULL where a table lacks it, every count column as a whole number."""
    root = directory.rstrip("/")
    wanted = csv_names(spark, root) if names is None else list(names)
    rows = _united(csv_files_by_header(spark, [f"{root}/{n}" for n in wanted], sep).values())
    others = [c for c in rows.columns if c != "_path"]
    return _whole_counts(rows.select(F.element_at(F.split("_path", "/"), -1).alias("table"), *others))


def read_merged(
    spark: SparkSession, directory: str, names: Iterable[str] | None = None, sep: str = ";"
) -> dict[str, DataFrame]:
    """Merged tables of a directory (all of its CSV files, or ``names``) keyed by file name, every
    count column as a whole number.

    Each opens only its own file; all of them at once in one scan are ``read_merged_rows``.
    """
    root = directory.rstrip("/")
    wanted = csv_names(spark, root) if names is None else list(names)
    return {n: _whole_counts(_united(csv_files_by_header(spark, [f"{root}/{n}"], sep).values()).drop("_path")) for n in wanted}
