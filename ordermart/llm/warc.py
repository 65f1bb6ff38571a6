"""Content-addressed web archive.

An archive is a folder of two tables.  ``payloads`` holds the bytes of each
distinct payload once, under its SHA-256; ``records`` holds the exact header
bytes of every WARC/1.1 record (WARC fields, blank line, HTTP header) and the
digest of its payload.  A join on the digest reconstructs every record byte by
byte: a ``response`` is header, payload and two line ends; a ``revisit`` (whose
payload another record has) ends after its header, and its full payload is
still found by the digest.

Digests are verified: when writing, equal SHA-256 must mean equal length and
equal SHA-1, else the job fails; when reading, SHA-256, SHA-1 and the lengths in
the headers are computed anew from the stored bytes.  Of a digest shared by a
third of all records only (digest, largest record) is aggregated, map-side
first; of equal payloads each task sends at most one.

``export`` writes the records as standard .warc.gz files, one gzip member a
record.

Defined results: a null payload is empty; a null url leaves its field out; line
ends in urls are percent-encoded; a null page id counts as the smallest and
stays null; rows that repeat the id and url of a response are responses, too;
an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordermart.llm.common import open_folder
from ordermart.session import scratch_path

# Fixed values of the formats.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def base32(hex40: Column) -> Column:
    """Base32 of 40 hexadecimal digits (160 bits): 4 characters for each 5
    digits."""
    chars = []
    for i in range(8):
        bits = F.conv(F.substring(hex40, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1
            chars.append(F.lit(BASE32).substr(at, F.lit(1)))
    return F.concat(*chars)


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", revisit_from: int = 0, date: str = DATE) -> None:
    """Write an archive below ``folder``.  Of records with equal payloads of at
    least ``revisit_from`` bytes, that with the largest id is a response and
    the others revisit it; smaller payloads are responses all."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                          payload.alias("payload"))
    source = source.withColumn("sha256", F.sha2("payload", 256))
    light = source.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"),
                          F.octet_length("payload").cast("long").alias("size"))
    same = F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", "url")
    firsts = light.groupBy("sha256").agg(
        F.max(same).alias("first"), F.min("sha1").alias("sha1"), F.max("sha1").alias("sha1_max"),
        F.min("size").alias("size"), F.max("size").alias("size_max"))
    clash = (F.col("sha1") != F.col("sha1_max")) | (F.col("size") != F.col("size_max"))
    checked = firsts.select(
        "sha256", "first", base32(F.col("sha1")).alias("sha1"),
        F.when(clash, F.raise_error(F.lit("two payloads share a SHA-256"))).otherwise(F.col("size")).alias("size"))
    checked.write.parquet(f"{folder}/digests")
    digests = spark.read.schema(checked.schema).parquet(f"{folder}/digests")

    # Equal digests are equal bytes, so any record's copy will do; copies meet
    # map-side first.
    (source.select("sha256", "payload").dropDuplicates(["sha256"])
     .write.parquet(f"{folder}/payloads"))

    first_id, first_url = F.col("first.page_id"), F.col("first.url")
    is_first = F.col("page_id").eqNullSafe(first_id) & F.col("url").eqNullSafe(first_url)
    kind = F.when(is_first | (F.col("size") < revisit_from), "response").otherwise("revisit")
    digest = F.concat(F.lit("sha1:"), F.col("sha1"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(END))
    revisit = F.col("kind") == "revisit"
    length = F.octet_length("http") + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    safe_url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", F.col("kind")),
        _field("WARC-Record-ID", _uuid(F.col("page_id"), F.col("url"), F.col("sha256"))),
        _field("WARC-Target-URI", safe_url), _field("WARC-Date", F.lit(date)),
        _field("WARC-Payload-Digest", digest),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _uuid(first_id, first_url, F.col("sha256")))),
        _field("X-Page-ID", F.col("page_id")), _field("X-Refers-To-Page-ID", F.when(revisit, first_id)),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", length), F.lit("\r\n"), F.col("http"))
    (light.select("page_id", "url", "sha256")
     .join(digests, "sha256").withColumn("kind", kind).withColumn("http", http)
     .select(header.cast("binary").alias("header"), "sha256").write.parquet(f"{folder}/records"))


def _value(name: str) -> Column:
    """A field of the WARC header, null if it is not there."""
    found = F.regexp_extract("text", rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.col("text").rlike(rf"\n{name}: "), found)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_digest, header, payload_bytes,
    payload) of every record, reconstructed by joining headers and payloads.
    Stored bytes are measured and digested where they are read; the job fails if
    that differs from the record's header.  Who does not ask for ``payload``
    spares its way through the join."""
    payloads = spark.read.schema("sha256 string, payload binary").parquet(f"{folder}/payloads").select(
        "sha256", "payload", F.octet_length("payload").cast("long").alias("size"),
        base32(F.sha1("payload")).alias("digest"), (F.sha2("payload", 256) == F.col("sha256")).alias("intact"))
    records = spark.read.schema("header binary, sha256 string").parquet(f"{folder}/records")
    parsed = (records.withColumn("text", F.col("header").cast("string"))
              .select("sha256", "header", F.octet_length("header").alias("header_size"),
                      _value("X-Page-ID").cast("long").alias("page_id"), _value("WARC-Type").alias("record_type"),
                      _value("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
                      F.regexp_replace(_value("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
                      _value("Content-Length").cast("long").alias("length"),
                      F.octet_length(F.substring_index("text", END, 1)).alias("fields")))
    body = F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("size"))
    whole = (F.col("intact") & (F.col("digest") == F.col("payload_digest"))
             & (F.col("length") == F.col("header_size") - F.col("fields") - 4 + body))
    joined = parsed.join(payloads, "sha256", "left")
    good = F.coalesce(whole, F.lit(False))
    damage = F.raise_error(F.concat(F.lit("damaged record or payload "), "sha256"))
    return joined.select("page_id", "record_type", "refers_to", "payload_digest", "header",
                         F.when(good, F.col("size")).otherwise(damage.cast("long")).alias("payload_bytes"),
                         F.when(good, F.col("payload")).otherwise(damage.cast("binary")).alias("payload"))


def record_bytes() -> Column:
    """The exact record, from the columns of ``read_archive``."""
    body = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return F.concat("header", body, F.lit(END).cast("binary"))


def export(records: DataFrame, folder: str) -> DataFrame:
    """Write records (of ``read_archive``) as .warc.gz files, one a
    partition; returns (file, n_records).  Files get their final name when
    complete."""
    rows = records.select(record_bytes().alias("record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        sink, n = None, 0
        fs, base = open_folder(folder)
        for batch in batches:
            for record in batch.column("record").to_pylist():
                if sink is None:
                    fs.create_dir(base, recursive=True)
                    sink = fs.open_output_stream(f"{base}/_writing-{name}", compression=None)
                sink.write(gzip.compress(record, mtime=0))
                n += 1
        if sink is not None:
            sink.close()
            fs.move(f"{base}/_writing-{name}", f"{base}/{name}")
            yield pa.record_batch({"file": [name], "n_records": pa.array([n], pa.int64())})

    return rows.mapInArrow(run, "file string, n_records long")


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "archive")
