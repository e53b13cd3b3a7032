"""File readers and writers (group A): the given tables, written to the shared folder and read back."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from checks import shape as H
from checks import views as VQ
from checks.registry import query
from checks.texts import results
from cohortloom.operators import letters as LT
from cohortloom.operators import views as V
from cohortloom.session import delete_on_exit, materialise, new_shared_path
from cohortloom.sources import delimited as DL
from cohortloom.sources import lines as LN
from cohortloom.sources import resources as RS
from cohortloom.sources import sinks as SK


def folder(t, label: str) -> str:
    path = new_shared_path(t.spark, label)
    delete_on_exit(t.spark, path)
    return path


@contextmanager
def small_splits(spark, size: str = "2k", tasks: int = 400):
    """Files are read in splits of ``size``, as large ones are in splits of many megabytes.

    About ``tasks`` tasks share the splits, however many there are.
    """
    wanted = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.maxPartitionNum": str(tasks)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@query("lake_conditions", VQ.CONDITION_SQL)
def lake_conditions(t):
    path = folder(t, "lake")
    RS.write_lake(H.condition(t), path, "Condition")
    return V.conditions(RS.read_lake(t.spark, path, "Condition"))


@query("ndjson_conditions", VQ.CONDITION_SQL)
def ndjson_conditions(t):
    path = folder(t, "ndjson")
    H.condition(t).write.json(path)
    return V.conditions(RS.read_ndjson(t.spark, path, "Condition"))


@query("landed_bundles", "SELECT count(*) AS bundles, count(*) FILTER (o_orderkey % 5 = 0) AS rejected FROM orders")
def landed_bundles(t):
    source, lake = folder(t, "bundles"), folder(t, "lake")
    whole = '\'{"entry":[{"resource":{"resourceType":"Patient","id":"x"}}]}\''
    t.orders.selectExpr(f"CASE WHEN o_orderkey % 5 = 0 THEN substring({whole}, 1, 20) ELSE {whole} END AS value").write.text(source)
    return RS.land_bundles(t.spark, source, lake, ["Patient"], one_per_line=True)


@query("csv_table", "SELECT o_orderkey, o_orderpriority, cast(o_orderdate as date)::varchar AS day FROM orders")
def csv_table(t):
    path = folder(t, "csv")
    SK.write_csv(t.orders.selectExpr("o_orderkey", "o_orderpriority", "cast(cast(o_orderdate as date) as string) AS day"), path)
    return DL.read_csv_table(t.spark, path, "o_orderkey bigint, o_orderpriority string, day string")


@query("quoted_csv", "SELECT cast(p_partkey as varchar) AS p_partkey, p_name FROM part")
def quoted_csv(t):
    path = folder(t, "quoted")
    SK.write_quoted_csv(t.part.select("p_partkey", "p_name"), path)
    return t.spark.read.option("header", True).option("sep", ";").csv(path)


@query("code_list", "SELECT DISTINCT trim(p_brand) AS icd_code FROM part")
def code_list(t):
    path = folder(t, "codes")
    t.part.select(F.concat(F.lit(" "), "p_brand").alias("icd_code")).write.option("header", True).csv(path)
    return DL.read_code_list(t.spark, path)


@query("parquet_table", "SELECT c_custkey, c_name FROM customer")
def parquet_table(t):
    path = folder(t, "parquet")
    SK.write_parquet(t.customer.select("c_custkey", "c_name"), path)
    return t.spark.read.parquet(path)


@query(
    "numbered_lines",
    """SELECT file, row_number() OVER (PARTITION BY file ORDER BY o_orderkey) AS line, value FROM
       (SELECT o_orderkey, concat('f', o_orderkey // 500) AS file, concat(o_orderkey, ' ', o_custkey) AS value FROM orders)""",
)
def numbered_lines(t):
    """Orders in files of about 500 numbers each, in order; read in splits of two kilobytes."""
    path = folder(t, "lines")
    rows = t.orders.selectExpr("o_orderkey", "concat('f', floor(o_orderkey / 500)) AS file", "concat(o_orderkey, ' ', o_custkey) AS value")
    rows.repartition(4, "file").sortWithinPartitions("file", "o_orderkey").select("file", "value").write.partitionBy("file").text(path)
    with small_splits(t.spark):
        found = LN.numbered_lines(t.spark, path)
        return materialise(found.withColumn("file", F.regexp_extract("file", "file=(f[0-9]+)", 1)), "numbered")


@query(
    "add_raw_column",
    """SELECT cast(n AS varchar) AS row_number, cast(s_suppkey AS varchar) AS key, concat('say "', s_name, '";', chr(10), 'twice') AS name, concat('"', s_name, '!') AS phone FROM
       (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier)""",
)
def add_raw_column(t):
    """A table with quoted line breaks and separators beside a file with stray quotes."""
    first, second = folder(t, "table"), folder(t, "raw")
    ordered = t.supplier.repartition(1).sortWithinPartitions("s_suppkey")
    name = F.concat(F.lit('say "'), "s_name", F.lit('";\ntwice'))
    table = ordered.select(F.col("s_suppkey").alias("key"), name.alias("name"), F.lit("old").alias("phone"))
    table.write.option("header", True).option("sep", ";").option("escape", '"').csv(first)
    raw = ordered.selectExpr("concat(s_suppkey, ';', '\"', s_name, '!;z') AS `key;phone;more`")
    raw.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(second)
    with small_splits(t.spark):
        return materialise(DL.add_raw_column(t.spark, first, second, "phone").withColumn("row_number", F.col("row_number").cast("string")), "bound")


# A row that equals the header stays; the header line itself goes.
@query("raw_column", "SELECT s_name AS b, false AS short_line FROM supplier UNION ALL SELECT 'b', false FROM supplier WHERE s_suppkey % 2 = 0")
def raw_column(t):
    path = folder(t, "raw")
    rows = t.supplier.selectExpr("concat('1;', s_name, ';\"x') AS `a;b;c`")
    same = t.supplier.where("s_suppkey % 2 = 0").selectExpr("'a;b;c' AS `a;b;c`")
    rows.unionByName(same).write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    return DL.read_raw_column(t.spark, path, "b")


@query(
    "united_csv_files",
    """SELECT cast(n_nationkey as varchar) AS key, n_name AS name, NULL::varchar AS region FROM nation
       UNION ALL SELECT cast(r_regionkey as varchar), NULL, r_name FROM region""",
)
def united_csv_files(t):
    first, second = folder(t, "first"), folder(t, "second")
    SK.write_csv(t.nation.selectExpr("n_nationkey AS key", "n_name AS name"), first)
    SK.write_csv(t.region.selectExpr("r_name AS region", "r_regionkey AS key"), second)
    return DL.union_csv_files(t.spark, [first, second])


@query(
    "merged_tables",
    'SELECT \'a.csv\' AS file, event_type AS label, count(*) AS "count" FROM events GROUP BY 2 UNION ALL SELECT \'b.csv\', o_orderpriority, count(*) FROM orders GROUP BY 2',
)
def merged_tables(t):
    root = folder(t, "merged")
    for name, df, col in (("a.csv", t.events, "event_type"), ("b.csv", t.orders, "o_orderpriority")):
        counted = df.groupBy(F.col(col).alias("label")).count()
        SK.write_csv(counted.withColumn("count", F.col("count").cast("double")), f"{root}/{name}")
    tables = DL.read_merged(t.spark, root)
    first, second = (df.select(F.lit(n).alias("file"), "label", "count") for n, df in sorted(tables.items()))
    return first.unionByName(second)


@query(
    "merged_rows",
    """SELECT 'clerks.csv' AS "table", o_orderstatus AS label, count(*) AS "count", NULL::bigint AS priority_count FROM orders GROUP BY 2
       UNION ALL SELECT concat('site', o_custkey % 5, '.csv'), o_orderpriority, NULL, count(*) FROM orders GROUP BY 1, 2""",
)
def merged_rows(t):
    """Six tables under two headers, in one scan each."""
    root = folder(t, "merged")
    SK.write_csv(t.orders.groupBy(F.col("o_orderstatus").alias("label")).count(), f"{root}/clerks.csv")
    for i in range(5):
        own = t.orders.where(F.col("o_custkey") % 5 == i).groupBy(F.col("o_orderpriority").alias("label"))
        SK.write_csv(own.agg(F.count(F.lit(1)).cast("double").alias("priority_count")), f"{root}/site{i}.csv")
    return DL.read_merged_rows(t.spark, root).select("table", "label", "count", "priority_count")


@query("rebuilt_findings", "SELECT concat('letter-', event_id) AS source_file, event_type AS gene FROM events WHERE event_id % 5 <> 0 UNION ALL SELECT concat('letter-', event_id), repeat('G', 51) FROM events WHERE event_id % 5 = 0")
def rebuilt_findings(t):
    path = folder(t, "findings")
    results(t).drop("event_id").write.json(path)
    return LT.rebuild_tables(t.spark, path)["genes"].select("source_file", "gene")
