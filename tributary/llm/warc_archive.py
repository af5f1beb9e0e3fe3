"""Content-addressed WARC archive: payloads once by digest, exact record headers beside them.

An archive is a folder with two Parquet tables. ``payloads`` holds each distinct payload
once under its SHA-256. ``records`` holds the header block of every record byte for byte,
with the digest of its payload. Joining the two gives the original records back.

Everything is built-in functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators.aggregates import collapse
from tributary.sources.scratch import scratch_dir

#: Payloads shorter than this are never written as revisits.
MIN_SHARED_BYTES = 100
CRLF = "\r\n"
#: The capture time of pages that come without one.
UNKNOWN_DATE = "1970-01-01T00:00:00Z"


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date_col: str | None = None,
    min_shared_bytes: int = MIN_SHARED_BYTES,
) -> None:
    """Write a WARC record per row of ``pages`` into ``folder``.

    The payload is the text in UTF-8; null is empty. Among rows with equal payloads of at
    least ``min_shared_bytes``, those with the smallest id are responses and the others
    revisits of it, rows without an id included (where no row has one, all are responses).
    Line breaks in an URL are percent-encoded; a null URL leaves its header out. Repeated
    rows are repeated records. Other columns are not read. An empty table gives an empty
    archive.

    The payloads pass one exchange, reduced to one row per digest map-side. The choice of
    the response groups digests and ids only, and the rows of a frequent payload can be
    split where they meet it.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        (F.col(date_col).cast("string") if date_col else F.lit(UNKNOWN_DATE)).alias("date"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    payloads = rows.groupBy("digest").agg(F.any_value("payload").alias("payload"))
    payloads.write.parquet(f"{folder}/payloads")

    sized = rows.select("id", "url", "date", "digest", F.octet_length("payload").alias("size"))
    first = collapse(sized.where(F.col("size") >= min_shared_bytes), "digest", first=F.min("id"))
    typed = sized.join(first, "digest", "left").withColumn(
        "refers", F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    )
    typed.select("digest", _header().alias("header")).write.parquet(f"{folder}/records")


def _header() -> Column:
    """The header block of a record, with the blank line that ends it."""

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    def record_id(page: Column) -> Column:
        digest = F.md5(F.concat_ws("-", F.lit("record"), page.cast("string"), F.col("digest")))
        parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    is_revisit = F.col("refers").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    text = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.coalesce(F.col("id").cast("string"), F.lit("")))),
        line("WARC-Date", F.coalesce(F.col("date"), F.lit(UNKNOWN_DATE))),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(is_revisit, record_id(F.col("refers").cast("string")))),
        line("X-Page-ID", F.col("id").cast("string")),
        line("X-Refers-To-Page-ID", F.col("refers").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(is_revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
        F.lit(CRLF),
    )
    return F.encode(text, "UTF-8")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of an archive: its header fields, its payload and its bytes.

    ``record`` is the original WARC record (a revisit has an empty block), ``payload`` the
    full payload, for revisits too. A payload that is missing, or whose SHA-256 is not
    the digest it is stored under, fails the read.
    """
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    records = spark.read.schema("digest string, header binary").parquet(f"{folder}/records")
    sound = F.col("payload").isNotNull() & (F.sha2("payload", 256) == F.col("digest"))
    # The check runs once per stored payload, before the join repeats it.
    checked = payloads.select(
        "digest", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest"))).alias("payload")
    )
    text = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        found = F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    joined = records.join(checked, "digest", "left")
    payload = F.coalesce(F.col("payload"), F.raise_error(F.lit("payload is missing")).cast("binary"))
    is_response = field("WARC-Type") == "response"
    return joined.select(
        field("X-Page-ID").cast("long").alias("page_id"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Target-URI").alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("payload_digest"),
        field("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        payload.alias("payload"),
        F.concat("header", F.when(is_response, payload).otherwise(F.encode(F.lit(""), "UTF-8")), F.encode(F.lit(CRLF * 2), "UTF-8")).alias("record"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as an archive, read it back, and describe each record."""
    folder = scratch_dir(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    records = read_archive(spark, folder)
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
), t AS (
  SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL
            AND page_id IS DISTINCT FROM first_id AS is_revisit FROM f
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN is_revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN is_revisit THEN first_id END AS refers_to
FROM t
"""
