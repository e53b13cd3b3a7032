"""Health-record resources from bundles, lines of JSON, or a columnar lake."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.views import KIND_COLUMN, observation_kind
from cohortloom.schemas import RESOURCE_TYPES, ddl, schema_of


def bundle_entries(bundles: DataFrame, text: Column | str = "value") -> DataFrame:
    """One row per bundle entry: its resource type and its JSON text."""
    c = F.col(text) if isinstance(text, str) else text
    entries = F.from_json(c, "entry array<struct<resource:string>>")["entry"]
    others = [x for x in bundles.columns if x != text]
    return (
        bundles.select(*others, F.explode(entries).alias("_entry"))
        .select(*others, F.col("_entry.resource").alias("resource"))
        .withColumn("resource_type", F.get_json_object("resource", "$.resourceType"))
    )


def bundle_rejects(bundles: DataFrame, text: Column | str = "value") -> DataFrame:
    """Bundles that can't be read as such (cut off, not JSON, no entries), with all of their columns."""
    c = F.col(text) if isinstance(text, str) else text
    return bundles.where(F.from_json(c, "entry array<struct<resource:string>>")["entry"].isNull())


def parse_resources(entries: DataFrame, resource_type: str) -> DataFrame:
    """Typed resources of one type out of ``bundle_entries``."""
    return (
        entries.where(F.col("resource_type") == resource_type)
        .select(F.from_json("resource", ddl(resource_type)).alias("_r"))
        .select("_r.*")
    )


def read_bundles(
    spark: SparkSession,
    path: str,
    types: Iterable[str] = RESOURCE_TYPES,
    *,
    one_per_line: bool = False,
) -> dict[str, DataFrame]:
    """A directory of bundle files as one DataFrame per resource type.

    For many types or views land the entries once with ``land_bundles``: each type parses the text
    of all bundles anew here.
    """
    entries = bundle_entries(spark.read.text(path, wholetext=not one_per_line))
    return {t: parse_resources(entries, t) for t in types}


def landed_rows(bundles: DataFrame, text: str = "value", passed: Observation | None = None) -> DataFrame:
    """Entries and rejects out of one parse: ``status`` (entry or rejected), ``resource_type`` and
    ``resource`` of entries, the ``bundle`` of rejects.

    A bundle that can't be read as such is rejected; one whose list of entries is empty gives no row.
    ``passed`` observes how many bundles went by and how many were rejected.
    """
    parsed = bundles.select(F.col(text).alias("bundle"), F.from_json(text, "entry array<struct<resource:string>>")["entry"].alias("entry"))
    if passed is not None:
        parsed = parsed.observe(passed, F.count(F.lit(1)).alias("bundles"), F.count_if(F.col("entry").isNull()).alias("rejected"))
    whole = F.transform("entry", lambda e: F.struct(F.lit("entry").alias("status"), e["resource"].alias("resource"), F.lit(None).cast("string").alias("bundle")))
    reject = F.array(F.struct(F.lit("rejected").alias("status"), F.lit(None).cast("string").alias("resource"), F.col("bundle")))
    rows = parsed.select(F.inline(F.when(F.col("entry").isNull(), reject).otherwise(whole)))
    return rows.select("status", F.get_json_object("resource", "$.resourceType").alias("resource_type"), "resource", "bundle")


def land_bundles(
    spark: SparkSession, path: str, lake: str, types: Iterable[str] = RESOURCE_TYPES, *, one_per_line: bool = False
) -> DataFrame:
    """Bundles into a lake: their text is read and parsed once, entries and rejects are written
    together, by status and type, and counted as they pass; then entries are typed.

    Returns how many bundles were read and how many rejected; ``landed_rejects`` gives the rejects.
    """
    root = lake.rstrip("/")
    passed = Observation("bundles")
    bundles = spark.read.text(path, wholetext=not one_per_line)
    landed_rows(bundles, passed=passed).write.mode("overwrite").partitionBy("status", "resource_type").parquet(f"{root}/_landed")
    entries = landed_entries(spark, root)
    for t in types:
        write_lake(parse_resources(entries, t), root, t, mode="overwrite")
    return spark.createDataFrame([(passed.get["bundles"], passed.get["rejected"])], "bundles bigint, rejected bigint")


_LANDED = "status string, resource_type string, resource string, bundle string"


def landed_entries(spark: SparkSession, lake: str) -> DataFrame:
    """``resource_type`` and ``resource`` of the entries that ``land_bundles`` has stored."""
    rows = spark.read.schema(_LANDED).parquet(f"{lake.rstrip('/')}/_landed")
    return rows.where(F.col("status") == "entry").select("resource_type", "resource")


def landed_rejects(spark: SparkSession, lake: str) -> DataFrame:
    """Texts of the bundles that ``land_bundles`` could not read."""
    rows = spark.read.schema(_LANDED).parquet(f"{lake.rstrip('/')}/_landed")
    return rows.where(F.col("status") == "rejected").select(F.col("bundle").alias("value"))


def read_lake(spark: SparkSession, path: str, resource_type: str, fmt: str = "parquet") -> DataFrame:
    """One columnar table per resource type; ``fmt="delta"`` where that format is installed."""
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{resource_type}")


def write_lake(
    df: DataFrame, path: str, resource_type: str, fmt: str = "parquet", mode: str = "append"
) -> None:
    """Store resources of one type where ``read_lake`` finds them.

    Observations are partitioned by kind: a study reads each of some fifteen kinds separately, and
    so reads every stored byte about once instead of fifteen times. No shuffle is needed.
    """
    target = f"{path.rstrip('/')}/{resource_type}"
    if resource_type == "Observation":
        kinds = df.withColumn(KIND_COLUMN, observation_kind())
        kinds.write.format(fmt).mode(mode).partitionBy(KIND_COLUMN).save(target)
    else:
        df.write.format(fmt).mode(mode).save(target)


def read_ndjson(spark: SparkSession, path: str, resource_type: str) -> DataFrame:
    """A resource-per-line export."""
    return spark.read.schema(schema_of(resource_type)).json(path)


def server_page_filter(df: DataFrame, cohort: DataFrame, reference: Column) -> DataFrame:
    """Resources whose subject belongs to the cohort, in place of paged server searches."""
    keys = cohort.toDF("_key")
    return df.withColumn("_key", reference).join(keys, "_key", "left_semi").drop("_key")
