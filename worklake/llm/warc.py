"""WARC archives with revisit resolution.

``write_archive`` turns pages into WARC/1.1 records. Headers alone (page id,
digest, length) are shuffled by payload digest; the smallest page id of equal
payloads keeps the payload as a ``response`` record, the others become
``revisit`` records that name it. ``read_archive`` parses the files by their
content lengths, checks every digest and ``resolve`` joins revisits to the
responses they name.

Defined results: a null payload is the empty payload; payloads below
``min_payload`` bytes are always responses; rows with the same page id and
payload are alike (all of them responses if that id is the smallest); a null
page id is never the original of others unless all ids of the payload are
null, and comes back as null; an empty table gives no rows. Other columns of
the input are ignored.
"""

from __future__ import annotations

import gzip
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklake.llm.common import folder, stage, text_or_empty

#: Archive files hold at most about this many bytes, so that one fits a task.
FILE_BYTES = 128 << 20
MAX_RECORDS = 20_000
#: Bounds of the payload sizes that share files; larger ones are the last group.
SIZES = (64 << 10, 1 << 20, 16 << 20)

CRLF = "\r\n"
RECORD_SCHEMA = ("page_id long, record_type string, url string, payload_bytes long, "
                 "payload_digest string, refers_to long")
PAYLOAD_SCHEMA = RECORD_SCHEMA + ", payload string"


def headers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html") -> DataFrame:
    payload = text_or_empty(payload_col)
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"))


def revisits(heads: DataFrame, min_payload: int = 100) -> DataFrame:
    """(page_id, payload_digest, refers_to, refers_url) of the records that repeat an earlier payload."""
    keys = heads.where(F.col("payload_bytes") >= min_payload).select("page_id", "url", "payload_digest")
    first = (keys.groupBy("payload_digest")
             .agg(F.min("page_id").alias("refers_to"), F.min_by("url", "page_id").alias("refers_url"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 AND refers_to IS NOT NULL").drop("n"))
    return (keys.drop("url").join(first, "payload_digest")
            .where("page_id IS NULL OR page_id > refers_to").distinct())


def record_text(min_payload: int):
    """The WARC record of a row as text, without the closing blank lines."""
    header = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    optional = lambda name, value: F.coalesce(header(name, value), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF), F.lit("Content-Type: text/html; charset=utf-8" + CRLF),
                    header("Content-Length", F.col("payload_bytes").cast("string")), F.lit(CRLF))
    one_line = lambda url: F.regexp_replace(url, "[\r\n]+", "%0A")
    is_copy = F.col("is_revisit")
    block = F.when(is_copy, http).otherwise(F.concat(http, F.col("payload")))
    record_id = lambda i, d: F.concat(F.lit("<urn:page:"), i, F.lit(":"), F.substring(d, 1, 16), F.lit(">"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        header("WARC-Type", F.when(is_copy, "revisit").otherwise("response")),
        header("WARC-Record-ID", record_id(page, F.col("payload_digest"))),
        header("WARC-Target-URI", one_line(F.col("url"))),
        header("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        optional("WARC-Page-ID", F.col("page_id").cast("string")),
        optional("WARC-Refers-To-Page", F.when(is_copy, F.col("refers_to").cast("string"))),
        optional("WARC-Refers-To", F.when(is_copy, record_id(F.col("refers_to").cast("string"), F.col("payload_digest")))),
        optional("WARC-Refers-To-Target-URI", F.when(is_copy, one_line(F.col("refers_url")))),
        F.when(is_copy, header("WARC-Profile", F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block)


def write_archive(spark: SparkSession, pages: DataFrame, path: str, min_payload: int = 100,
                  id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> str:
    """Write the deduplicated archive; a record's closing blank lines are the line separator."""
    heads = headers(pages, id_col, url_col, payload_col)
    # Kept as a table, its size is known: Spark then moves payloads only if it is large.
    copies = stage(revisits(heads, min_payload), "revisits").select(
        F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"), "refers_to", "refers_url")
    rows = heads.join(copies, F.col("page_id").eqNullSafe(F.col("r_id"))
                      & (F.col("payload_digest") == F.col("r_digest")), "left")
    rows = rows.withColumn("is_revisit", F.col("refers_to").isNotNull())
    # Records of like size go to files of their own: a large page shares none with small ones.
    size = F.lit(len(SIZES))
    for k in range(len(SIZES) - 1, -1, -1):
        size = F.when(F.col("payload_bytes") <= SIZES[k], F.lit(k)).otherwise(size)
    for k, most in sorted(heads.groupBy(size.alias("size")).agg(F.max("payload_bytes")).collect()):
        (rows.where(size == k).select(record_text(min_payload).alias("value")).write
         .option("lineSep", CRLF + CRLF).option("compression", "gzip")
         .option("maxRecordsPerFile", max(1, min(MAX_RECORDS, FILE_BYTES // (most + 1024)))).text(f"{path}/size={k}"))
    return path


def parse_records(data):
    """Yield (headers, block) of the WARC records in a bytes-like object, by their lengths."""
    view, at, end = memoryview(data), 0, len(data)
    raw = bytes(view)
    while at < end:
        stop = raw.index(b"\r\n\r\n", at)
        lines = raw[at:stop].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = raw[stop + 4:stop + 4 + size]
        if len(block) != size:
            raise ValueError(f"record at byte {at} is cut off")
        yield head, block
        at = stop + 4 + size + 4


def _parse_files(batches, with_payload: bool):
    import pyarrow as pa

    names = [f.split()[0] for f in (PAYLOAD_SCHEMA if with_payload else RECORD_SCHEMA).split(", ")]
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
    number = lambda x: None if x is None else int(x)
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for head, block in parse_records(gzip.decompress(content.as_buffer())):
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                http, _, payload = block.partition(b"\r\n\r\n")
                kind = head["warc-type"]
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {head['warc-record-id']} doesn't match its digest")
                row = {"page_id": number(head.get("warc-page-id")), "record_type": kind,
                       "url": head["warc-target-uri"], "payload_digest": digest,
                       "payload_bytes": len(payload) if kind == "response" else None,
                       "refers_to": number(head.get("warc-refers-to-page"))}
                if with_payload:
                    row["payload"] = payload.decode("utf-8") if kind == "response" else None
                rows.append(row)
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)


def _any_file(spark: SparkSession, path: str) -> bool:
    """Whether the archive has a folder; one without records has none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def read_archive(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archive's files."""
    if not _any_file(spark, path):
        return spark.createDataFrame([], PAYLOAD_SCHEMA if with_payload else RECORD_SCHEMA)
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(lambda b: _parse_files(b, with_payload),
                            PAYLOAD_SCHEMA if with_payload else RECORD_SCHEMA)


def resolve(records: DataFrame) -> DataFrame:
    """Give revisit records the length of the response they name."""
    own = (records.where("record_type = 'response'")
           .select(F.col("page_id").alias("o_id"), F.col("payload_digest").alias("o_digest"),
                   F.col("payload_bytes").alias("o_bytes")).distinct())
    joined = records.join(own, (F.col("refers_to") == F.col("o_id"))
                          & (F.col("payload_digest") == F.col("o_digest")), "left")
    return joined.select("page_id", F.coalesce("payload_bytes", "o_bytes").alias("payload_bytes"),
                         "payload_digest", "record_type", "refers_to")


def archive_round_trip(spark: SparkSession, pages: DataFrame, min_payload: int = 100) -> DataFrame:
    path = write_archive(spark, pages, folder(spark, "warc"), min_payload)
    # Headers alone are kept: the files are parsed and hashed once.
    return resolve(stage(read_archive(spark, path), "records"))
