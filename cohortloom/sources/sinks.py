"""Result tables: paths, CSV and Parquet writers, data dictionaries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StudyLayout:
    """Where a study's tables go; identified and de-identified results never share a folder."""

    results: str
    study: str

    def csv(self, suffix: str, deidentified: bool = False) -> str:
        return f"{self._base(deidentified)}/df_{suffix}.csv"

    def parquet(self, suffix: str, deidentified: bool = False) -> str:
        return f"{self._base(deidentified)}/parquet/df_{suffix}.parquet"

    def mrn_lookup(self) -> str:
        return f"{self.results.rstrip('/')}/{self.study}_patient_mrn_lookup"

    def _base(self, deidentified: bool) -> str:
        base = f"{self.results.rstrip('/')}/{self.study}"
        return f"{base}/deidentified" if deidentified else base


def joined_arrays(df: DataFrame, sep: str = "|") -> DataFrame:
    """Array columns as joined text, struct columns as NULL, for delimited sinks."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "array":
            out.append(F.array_join(F.col(field.name).cast("array<string>"), sep).alias(field.name))
        elif kind == "struct":
            out.append(F.lit(None).cast("string").alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def write_csv(
    df: DataFrame, path: str, sep: str = ";", header: bool = True, *, single_file: bool = False
) -> None:
    """Overwrite a CSV table. ``single_file`` is for summaries that are small by construction."""
    out = joined_arrays(df)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def write_quoted_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    (
        joined_arrays(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("quoteAll", True)
        .option("escape", "\\")
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def data_dictionary(spark: SparkSession, tables: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Table, column and description as rows."""
    rows = [(t, c, d) for t, columns in tables.items() for c, d in columns.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, description string")


def describe_columns(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """Carry descriptions as column comments, so that Parquet tables keep them."""
    for name, text in descriptions.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df
