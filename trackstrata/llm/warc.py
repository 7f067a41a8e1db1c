"""Content-addressed WARC archive.

Every row becomes a WARC record. Payload bytes are stored once per SHA-256 digest, exact record headers are
stored apart, and records are put together again by a join on the digest. Of records with one payload of at least
``least`` bytes, the one with the smallest id is a ``response`` and the others are ``revisit`` records that refer to it;
smaller payloads always stay responses. On reading, every stored payload's digest is computed again and every header's
length is compared; a difference raises. On writing, equal digests of different bytes would raise as well.

Null payloads are empty. Rows that share the smallest id of their payload are all responses; null ids come last, and where all ids are
null every record is a response. Line breaks in URLs become blanks. Extra columns are not archived.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackstrata.session import new_folder

from .common import BLOCK_BYTES

VERSION, BREAK = "WARC/1.1", "\r\n"
#: fixed value: the profile of records that only name an equal payload
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 100


def _compressed(rows: DataFrame) -> DataFrame:
    """``payload`` as a gzip member of its own, as WARC files hold their records: a third of the bytes to move and store."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("payload")
            members = []
            for payload in batch.column(at):
                packer = zlib.compressobj(wbits=31)
                members.append(packer.compress(payload.as_buffer()) + packer.flush())
            yield batch.set_column(at, "payload", pa.array(members, pa.binary()))

    return rows.mapInArrow(run, rows.schema)


def _payloads(stored: DataFrame, with_payload: bool) -> DataFrame:
    schema = "digest string, payload_bytes bigint" + (", payload binary" if with_payload else "")

    def table(digests: list[str], sizes: list[int], payloads: list[bytes]) -> pa.RecordBatch:
        columns = [pa.array(digests, pa.string()), pa.array(sizes, pa.int64())]
        if with_payload:
            columns.append(pa.array(payloads, pa.binary()))
        return pa.RecordBatch.from_arrays(columns, ["digest", "payload_bytes", "payload"][: len(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, payloads = [], [], []
            for digest, member in zip(batch.column(0).to_pylist(), batch.column(1)):
                payload = zlib.decompress(member.as_buffer(), wbits=31)
                if hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload does not fit its digest {digest}")
                digests.append(digest)
                sizes.append(len(payload))
                if with_payload:
                    payloads.append(payload)
                    if sum(sizes) > BLOCK_BYTES:
                        yield table(digests, sizes, payloads)
                        digests, sizes, payloads = [], [], []
            yield table(digests, sizes, payloads)

    return stored.select("digest", "payload").mapInArrow(run, schema)


def _encoded(value: Column | str) -> Column:
    """Any id as text that stands in a header line; ``url_decode`` gives it back."""
    return F.coalesce(F.url_encode(value), F.lit(""))


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_BYTES, date: str | None = None) -> None:
    """Writes ``folder/payloads`` (digest, payload) and ``folder/headers`` (digest, header). ``date`` (UTC, ``yyyy-MM-ddTHH:mm:ssZ``)
    is the records' date, now by default. Record ids are unique also for pages of equal or null ids."""
    date = date or f"{datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%SZ}"
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("string").alias("id"), F.col(key).alias("number"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    digested = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    light = digested.withColumn("second", F.xxhash64("payload")).drop("payload").withColumn("record", F.hex(F.monotonically_increasing_id()))
    # one short row a digest; hot payloads are summed up before the shuffle
    known = light.groupBy("digest").agg(F.min("number").alias("first"), F.min("second").alias("low"), F.max("second").alias("high"), F.min("size").alias("small"), F.max("size").alias("large"))
    checked = known.select(
        "digest",
        F.when((F.col("low") == F.col("high")) & (F.col("small") == F.col("large")), F.col("first"))
        .otherwise(F.raise_error(F.lit("two payloads have one digest")).cast(pages.schema[key].dataType))
        .alias("first"),
    )
    revisit = (F.col("size") >= least) & (F.col("number").isNull() | (F.col("number") != F.col("first"))) & F.col("first").isNotNull()
    kind = F.when(revisit, "revisit").otherwise("response")
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), _encoded("id"), F.lit(":"), F.col("record"), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\\r\\n]+", " ")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), _encoded(F.col("first").cast("string")), F.lit(">"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("size").cast("string")),
        F.concat(F.lit("Content-Length: "), F.when(revisit, "0").otherwise(F.col("size").cast("string"))),
    ]
    headers = light.join(checked, "digest").select("digest", F.concat_ws(BREAK, *lines).alias("header"))
    headers.write.parquet(f"{folder}/headers")
    # the bytes of a digest come from the rows of its smallest id; copies among those are dropped before the shuffle
    owner = checked.select("digest", "first")
    packed = _compressed(digested.select("digest", "number", "payload"))
    holders = packed.join(owner, (packed["digest"] == owner["digest"]) & packed["number"].eqNullSafe(owner["first"]), "left_semi")
    holders.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.parquet(f"{folder}/payloads")


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, from the stored header text: ``digest, header, record_type, id, url, refers_to, size``."""

    def field(name: str, value: str = "([^\\r\\n]*)") -> F.Column:
        found = F.regexp_extract("header", f"(?:^|\\r\\n){name}: {value}", 1)
        return F.when(found != "", found)

    headers = spark.read.parquet(f"{folder}/headers")
    return headers.select(
        "digest",
        "header",
        field("WARC-Type").alias("record_type"),
        F.url_decode(field("WARC-Record-ID", "<urn:page:([^:>]*):[^>]*>")).alias("id"),
        field("WARC-Target-URI").alias("url"),
        F.url_decode(field("WARC-Refers-To", "<urn:page:([^>]*)>")).alias("refers_to"),
        field("X-Payload-Length").cast("bigint").alias("size"),
    )


def read_payloads(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """``digest, payload_bytes`` and ``payload``, with every payload unpacked and its digest computed again."""
    return _payloads(spark.read.parquet(f"{folder}/payloads"), with_payload)


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records with their payload (or only its length as ``payload_bytes``), by a join on the digest. A header whose payload is
    missing or of another length raises."""
    joined = read_headers(spark, folder).join(read_payloads(spark, folder, with_payload), "digest", "left")
    wrong = F.raise_error(F.concat(F.lit("no payload of this length for "), "digest")).cast("bigint")
    right = F.when(F.col("payload_bytes") == F.col("size"), F.col("payload_bytes")).otherwise(wrong)
    return joined.withColumn("payload_bytes", right).drop("size")


def export_warc(spark: SparkSession, folder: str, target: str, records_per_file: int = 100_000) -> None:
    """Plain WARC files: header, empty line, the payload of responses, two line breaks after each record."""
    records = read_archive(spark, folder)
    block = F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise("")
    text = F.concat("header", F.lit(BREAK * 2), block).alias("value")
    records.select(text).write.option("lineSep", BREAK * 2).option("maxRecordsPerFile", records_per_file).text(target)


def archived(pages: DataFrame, **columns) -> DataFrame:
    """Writes the pages to a new archive in the shared folder and reads the records back (without payload)."""
    folder = new_folder(pages.sparkSession)
    write_archive(pages, folder, **columns)
    return read_archive(pages.sparkSession, folder, with_payload=False)
