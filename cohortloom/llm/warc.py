"""WARC archives with revisit records: written, resolved and read by Spark."""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import steps
from cohortloom.operators.skew import spread_join
from cohortloom.session import new_shared_path

#: Payloads of fewer bytes are never revisits: a header would take more.
LEAST = 100
#: Records of one archive file at most.
RECORDS = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "1970-01-01T00:00:00Z"
_END = "\r\n\r\n"


def resolved(headers: DataFrame, least: int = LEAST) -> DataFrame:
    """``headers`` (``id``, ``digest``, ``bytes``) with ``original``: the record a revisit refers to.

    Headers alone are shuffled by payload digest; the least id of each digest is the response, the
    others revisit it. A digest of very many records is counted before the shuffle and its join is
    split. Payloads below ``least`` bytes and the responses themselves have NULL. Records of equal
    ids are all responses; a NULL id revisits what has an id, else it is a response.
    """
    first = headers.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min("id").alias("first"))
    joined = spread_join(headers, first, ["digest"], "left")
    own = (F.col("bytes") >= least) & ~F.col("first").eqNullSafe(F.col("id"))
    return joined.withColumn("original", F.when(own, F.col("first"))).drop("first")


def _named(id_: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """``value``: each page (``id``, ``url``, ``payload``, ``digest``, ``bytes``, ``original``) as the
    text of a WARC record. A revisit has headers only."""
    revisit = F.col("original").isNotNull()
    line = F.lit("\r\n")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\\r\\n]+", " ")
    parts = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _named(F.col("id"))),
        F.lit(f"WARC-Date: {WARC_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _named(F.col("original")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return pages.select(F.concat(F.concat_ws("\r\n", *parts), line, line, block).alias("value"))


def captured(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Headers and payload of each page; a NULL payload is empty."""
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("string").alias("name"), F.col(key).alias("id"), F.col(url).cast("string").alias("url"), text.alias("payload"))
    return rows.withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "bytes": F.octet_length("payload").cast("bigint")})


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    """Write every page as a record of gzipped WARC files; equal payloads only once.

    The record texts keep their payload bytes (UTF-8) and end as the format asks for, so the text
    writer's commit makes the files whole or not at all when executors are lost.
    """
    rows = captured(pages, **columns)
    headers = resolved(rows.select("id", "digest", "bytes")).distinct()
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.tag") == F.col("b.tag")) & (F.col("a.digest") == F.col("b.digest"))
    tag = F.xxhash64("id", "digest")
    full = rows.withColumn("tag", tag).alias("a").join(headers.withColumn("tag", tag).alias("b"), same).select("a.id", "url", "payload", "a.digest", "a.bytes", "original")
    records(full).write.option("lineSep", _END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


_HEAD = re.compile(rb"WARC/1\.[01]\r\n(?:[^\r\n]+\r\n)+\r\n")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive."""
    at = 0
    while at < len(data):
        head = _HEAD.match(data, at)
        if head is None:
            raise ValueError(f"no WARC record at byte {at}")
        lines = head[0].decode("utf-8").split("\r\n")[1:-2]
        fields = {n.lower(): v for n, _, v in (x.partition(": ") for x in lines)}
        end = head.end() + int(fields["content-length"])
        if len(data) < end or data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut")
        yield fields, data[head.end() : end]
        at = end + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``name``, ``record_type``, ``digest``, ``refers_to``, ``url`` and ``payload`` of each record.

    A revisit has no payload (NULL). Each file is read by one task, as a whole; a file that isn't
    well-formed fails. Digests of responses are computed from the payload read.
    """
    names = ["name", "record_type", "digest", "refers_to", "url", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "content"):
            for content in batch.column("content"):
                rows, size = [], 0
                for fields, block in parse(gzip.decompress(content.as_py())):
                    kind = fields["warc-type"]
                    ids = [fields.get(n, "")[len("<urn:record:") : -1] for n in ("warc-record-id", "warc-refers-to")]
                    body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    rows.append((ids[0], kind, fields["warc-payload-digest"].partition(":")[2], ids[1] or None, fields.get("warc-target-uri"), body))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    kinds = [pa.string()] * 5 + [pa.binary()]
    schema = "name string, record_type string, digest string, refers_to string, url string, payload binary"
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(run, schema)
    return found.withColumn("digest", F.when(F.col("payload").isNotNull(), F.sha2("payload", 256)).otherwise(F.col("digest")))


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the pages as deduplicated archives, read them back: ``key``, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to`` of every record.

    The length of a revisit's payload is that of the response it refers to. NULL payloads are empty;
    repeated rows have a record each; a NULL key has an empty record name and is read back as NULL.
    Other columns are ignored.
    """
    spark = pages.sparkSession
    path = new_shared_path(spark, "llm-warc")
    write_archives(pages, path, key=key, url=url, payload=payload)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    read = read_archives(spark, path).select("name", "record_type", "digest", "refers_to", F.octet_length("payload").cast("bigint").alias("own"))
    sizes = read.filter("own is not null").groupBy("digest").agg(F.min("own").alias("of_response"))
    kind = pages.schema[key].dataType
    joined = spread_join(read, sizes, ["digest"], "left")
    return joined.select(
        F.when(F.col("name") != "", F.col("name")).cast(kind).alias(key),
        F.coalesce("own", "of_response").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
