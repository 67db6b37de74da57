import io
import zipfile

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rosterlake.llm import archives
from rosterlake.session import scratch_dir
from rosterlake.sources.stores import open_store

SCHEMA = "page_id long, url string, html string"


def rewrite(spark, rows, **options):
    pages = spark.createDataFrame(rows, SCHEMA)
    packages = archives.write_packages(spark, pages, scratch_dir(spark, "archives"), **options)
    return packages, archives.read_packages(packages)


def test_round_trip_and_revisits(spark):
    rows = [
        (3, "http://a/é?x=1", "<p>same</p>"), (1, None, "<p>same</p>"), (2, "http://b", ""), (4, "http://c", None),
        (5, "u\r\nX-Evil: 1", "<p>é\r\n\r\nWARC/1.1</p>"), (None, "n", "<p>same</p>"), (None, "n", "alone"),
        (6, "v", "x" * 300_000), (6, "v", "x" * 300_000),
    ]
    packages, back = rewrite(spark, rows)
    assert packages.agg({"records": "sum"}).first()[0] == len(rows)
    got = back.collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r for r in got if r.page_id is not None}
    assert (texts[1].record_type, texts[1].payload.decode()) == ("response", "<p>same</p>")
    assert (texts[3].record_type, texts[3].refers_to, texts[3].payload) == ("revisit", 1, None)
    assert texts[3].payload_digest == texts[1].payload_digest == archives.digest(b"<p>same</p>") and texts[3].payload_bytes == 11
    assert (texts[2].payload_bytes, texts[2].record_type) == (0, "response")
    assert (texts[4].record_type, texts[4].refers_to) == ("revisit", 2)
    assert texts[5].payload.decode() == rows[4][2] and texts[5].url == "u%0D%0AX-Evil:%201"
    assert sorted((r.record_type, r.refers_to) for r in got if r.page_id is None) == [("response", None), ("revisit", 1)]
    assert [r.record_type for r in got if r.page_id == 6] == ["response", "response"]


def test_small_payloads_are_all_responses(spark):
    _, back = rewrite(spark, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxxx"), (4, "d", "xxxx")], least_bytes=3)
    assert sorted((r.page_id, r.record_type) for r in back.collect()) == [
        (1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_packages_roll_over(spark):
    import os
    packages, back = rewrite(spark, [(i, "u", os.urandom(4000).hex()) for i in range(60)], package_bytes=20_000)
    assert packages.count() > 5 and back.count() == 60


def test_few_packages_are_read_by_many_tasks(spark):
    """One package of 60 records in ranges of five: twelve tasks, none of which reads another's records."""
    packages, _ = rewrite(spark, [(i, "u", f"page {i}") for i in range(60)])
    assert packages.count() < 8
    back = archives.read_packages(packages, range_records=5)
    n = packages.agg(F.sum(F.ceil(F.col("records") / 5))).first()[0]
    assert back.rdd.getNumPartitions() == n >= 12
    by_task = back.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(by_task) > 6 and max(r["count"] for r in by_task) <= 15 and sum(r["count"] for r in by_task) == 60
    assert sorted(r.page_id for r in back.collect()) == list(range(60))


def test_awkward_pages(spark):
    """Nulls everywhere, empty and very long pages, repeated rows, and extra columns under names that records use."""
    rows = [(None, None, None), (1, None, ""), (1, "u", "x" * 3_000_000), (1, "u", "x" * 3_000_000), (2, "v", "é" * 10)]
    pages = spark.createDataFrame(rows, SCHEMA)
    extra = pages.select("*", *(F.lit("theirs").alias(c) for c in ("key", "first", "n", "revisit", "path", "records", "payload", "_salt")))
    wanted = sorted(map(str, rewrite(spark, rows)[1].collect()))
    packages = archives.write_packages(spark, extra, scratch_dir(spark, "archives"))
    assert sorted(map(str, archives.read_packages(packages).collect())) == wanted and len(wanted) == len(rows)


def test_query_leaves_no_archives(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "rosterlake"
    before = set(base.glob("archives-*"))
    assert archives.op5_warc_packages(spark, "/root/testdata/sf0.001").count() == 50
    assert set(base.glob("archives-*")) == before


def test_stores_by_the_names_spark_uses():
    assert open_store("file:/tmp/a%20b")[1] == open_store("/tmp/a b")[1] == open_store("file:///tmp/a%20b")[1] == "/tmp/a b"
    files, path = open_store("s3a://bucket/some/key")
    assert (files.type_name, path) == ("s3", "bucket/some/key")


def test_empty_table(spark):
    packages, back = rewrite(spark, [])
    assert packages.count() == 0 and back.count() == 0


@pytest.mark.parametrize("comment", [b"", b"PK" * 500])
def test_directories_of_other_writers(comment):
    """Members in any order, a comment, a wide header, a compressed neighbour."""
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as z:
        z.writestr("other.txt", "x" * 1000, zipfile.ZIP_DEFLATED)
        with z.open("archive/é.warc", "w", force_zip64=True) as member:
            member.write(b"0123456789")
        z.comment = comment
    reader = archives.PackageReader(io.BytesIO(sink.getvalue()), len(sink.getvalue()))
    assert list(reader.members) == ["other.txt", "archive/é.warc"]
    assert reader.read("archive/é.warc", 3, 4) == b"3456" and reader.read("archive/é.warc") == b"0123456789"
    with pytest.raises(ValueError, match="compressed"):
        reader.read("other.txt")


def test_zip64_directory(monkeypatch):
    """With so low limits the standard writer puts every place and size into wide fields."""
    for name in ("ZIP64_LIMIT", "ZIP_FILECOUNT_LIMIT"):
        monkeypatch.setattr(zipfile, name, 1)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w") as z:
        for i in range(5):
            with z.open(f"m{i}", "w", force_zip64=True) as member:
                member.write(bytes([65 + i]) * 50)
    assert b"PK\x06\x06" in sink.getvalue()
    reader = archives.PackageReader(io.BytesIO(sink.getvalue()), len(sink.getvalue()))
    assert [reader.read(f"m{i}") for i in range(5)] == [bytes([65 + i]) * 50 for i in range(5)]
