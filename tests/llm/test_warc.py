import base64
import glob
import gzip
import hashlib

import pytest

from ordermart.llm import warc

SCHEMA = "page_id long, url string, html string, sha256 string, size string, payload string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def edge_rows():
    same = "<html>same</html>"
    return [(1, "http://a/1", same), (2, "http://a/2", same), (3, "u\r\nX-Page-ID: 9", same), (4, None, None),
            (5, "http://é/ü", ""), (6, "six", "é" * 300_000), (None, "none", "only here"), (None, "none", same),
            (7, "seven", "twice"), (7, "seven", "twice"), (8, "eight", "twice"), (9, "a", "b"), (9, "b", "b")]


def archived(spark, pages, **options):
    folder = warc.archive_folder(spark)
    warc.write_archive(pages, folder, **options)
    return folder, warc.read_archive(spark, folder)


def expected(rows, least=0):
    payloads = [(r[2] or "").encode() for r in rows]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    best = {}
    for r, p in zip(rows, payloads):
        best[p] = max(best.get(p, order(r)), order(r))
    out = []
    for r, p in zip(rows, payloads):
        response = len(p) < least or order(r) == best[p]
        out.append((r[0], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "response" if response else "revisit", None if response else best[p][1]))
    return sorted(out, key=str)


def seen(records):
    rows = records.collect()
    assert all(r.payload_bytes == len(r.payload) for r in rows)
    return sorted(((r.page_id, len(r.payload), r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_given_pages_with_copies(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    copies = pages.where("page_id % 3 = 0").selectExpr("page_id + 1000 page_id", "url", "html")
    pages = pages.unionByName(copies)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    folder, records = archived(spark, pages)
    assert seen(records) == expected(rows)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({r[2] for r in rows})


@pytest.mark.parametrize("least", [0, 10])
def test_edge_pages(spark, least):
    _, records = archived(spark, frame(spark, edge_rows()), revisit_from=least)
    assert seen(records) == expected(edge_rows(), least)
    empty = archived(spark, frame(spark, []))[1]
    assert empty.count() == 0


def test_records_are_exact_warc(spark, tmp_path):
    folder, records = archived(spark, frame(spark, edge_rows()))
    files = warc.export(records.repartition(3), f"file://{tmp_path}/out").collect()
    assert sum(f.n_records for f in files) == len(edge_rows())
    found = []
    for path in glob.glob(f"{tmp_path}/out/*.warc.gz"):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            body, data = rest[:n], rest[n + 4:]
            assert head.startswith(b"WARC/1.1\r\n") and rest[n:n + 4] == b"\r\n\r\n"
            http, _, payload = body.partition(b"\r\n\r\n")
            digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if fields["WARC-Type"] == "response":
                assert fields["WARC-Payload-Digest"] == digest
                assert f"Content-Length: {len(payload)}".encode() in http
            else:
                assert payload == b"" and fields["WARC-Profile"] == warc.PROFILE
            found.append(fields)
    responses = {f["WARC-Record-ID"]: f["WARC-Payload-Digest"] for f in found if f["WARC-Type"] == "response"}
    for f in found:
        if f["WARC-Type"] == "revisit":
            assert responses[f["WARC-Refers-To"]] == f["WARC-Payload-Digest"]


def test_damage_is_found(spark):
    folder, _ = archived(spark, frame(spark, edge_rows()))
    broken = warc.archive_folder(spark)
    payloads = spark.read.parquet(f"{folder}/payloads")
    payloads.selectExpr("sha256", "if(length(payload) > 9, unhex('00'), payload) payload").write.parquet(f"{broken}/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{broken}/records")
    with pytest.raises(Exception, match="damaged record or payload"):
        warc.read_archive(spark, broken).collect()
    with pytest.raises(Exception, match="damaged record or payload"):
        warc.read_archive(spark, broken).select("page_id", "payload_bytes").collect()


def test_base32(spark):
    rows = [(hashlib.sha1(bytes([i])).hexdigest(), base64.b32encode(hashlib.sha1(bytes([i])).digest()).decode())
            for i in range(256)]
    df = spark.createDataFrame(rows, "h string, b string")
    from pyspark.sql import functions as F
    assert df.where(warc.base32(F.col("h")) != F.col("b")).count() == 0
