"""Exact rows of the feed and run log scans, and of the landing write."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioflow.operators import records
from folioflow.sources import feeds, landing, run_log

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom">
  <title>results</title>
  <entry>
    <id>http://papers.example.org/abs/2401.00001v2</id>
    <title>
      A &amp; B
    </title>
    <summary>  One.  </summary>
    <published>2024-01-02T03:04:05Z</published>
    <author><name> Ada </name></author>
    <author><name>Bob</name></author>
    <category term="cs.AI" scheme="x"/><category term="cs.LG"/>
    <link href="http://p/pdf" rel="related" type="application/pdf"/>
    <link href="http://p/abs" rel="alternate"/><link href="http://p/second" rel="alternate"/>
  </entry>
  <entry>
    <id>http://papers.example.org/abs/math/0309136v1</id><title>T</title><published>2024-01-02T03:04:05.25Z</published>
    <link href="http://p/only" rel="related"/>
  </entry>
  <entry><id>http://papers.example.org/abs/</id><title/><published>2024-01-02T03:04:05Z</published></entry>
  <entry><id>x</id><title>bad date</title><published>2024-01-02</published></entry>
  <entry><id>y</id><title>offset</title><published>2024-01-02T03:04:05+00:00</published></entry>
  <entry><id>z</id><title>padded date</title><published> 2024-01-02T03:04:05Z</published></entry>
</feed>
"""


@pytest.fixture()
def entries(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    return feeds.read_feed(spark, str(tmp_path))


def test_feed_scan(entries):
    assert entries.count() == 6


def test_entries_to_papers(entries):
    rows = {r.id: r for r in records.entries_to_papers(entries).collect()}
    assert set(rows) == {"2401.00001v2", "0309136v1", ""}
    one = rows["2401.00001v2"]
    assert (one.title, one.abstract, one.source) == ("A & B", "One.", "arxiv")
    assert (one.authors, one.categories, one.url) == (["Ada", "Bob"], ["cs.AI", "cs.LG"], "http://p/abs")
    assert one.published_date == datetime(2024, 1, 2, 3, 4, 5)
    two, three = rows["0309136v1"], rows[""]
    assert (two.url, two.authors, two.categories, two.abstract) == ("", [], [], "")
    assert two.published_date.microsecond == 250_000
    assert (three.title, three.url) == ("", "")


LOG = """{"timestamp":"2024-01-02T03:04:05Z","level":"INFO","message":"m","service":"s","trace_id":"t","metadata":{"event":"metrics","attempt":2,"deep":{"a":[1]}}}
{"timestamp":"2024-01-02T03:04:06Z","level":"ERROR","message":"m","service":"s","duration_ms":5,"data_count":7,"error":{"type":"API_ERROR","message":"x","code":"E1"}}
this is not json
"""


def test_run_log(spark, tmp_path):
    (tmp_path / "log.json").write_text(LOG)
    lines = run_log.read_run_log(spark, str(tmp_path)).cache()
    assert [r.corrupt_line for r in lines.where("corrupt_line is not null").collect()] == ["this is not json"]
    events = run_log.log_events(lines).orderBy("ts").collect()
    assert [(r.event, r.attempt, r.error_code, r.duration_ms, r.data_count) for r in events] == [
        ("metrics", 2, None, None, None), (None, 1, "E1", 5, 7)]
    assert '"a":[1]' in lines.orderBy("timestamp").where("metadata is not null").first().metadata


def test_landing_write_and_stats(spark, tmp_path):
    papers = spark.createDataFrame(
        [(str(i), "s1" if i % 3 else "s2", "x" * 200, datetime(2024, 1, 2)) for i in range(60)],
        "id string, source string, title string, collected_at timestamp")
    path = str(tmp_path / "raw-data")
    landing.write_landing(papers, path)
    back = records.normalize_records(landing.read_landing(spark, path))
    assert sorted((r.paper_id, r.source) for r in back.collect()) == sorted(
        (r.id, r.source) for r in papers.collect())
    stats = {r.source: r for r in landing.upload_stats(papers.drop("collected_at"), path).collect()}
    assert stats["s1"].papers == 40 and stats["s2"].papers == 20
    assert stats["s1"].original_bytes == sum(
        len(f'{{"id":"{i}","source":"s1","title":"{"x" * 200}"}}') + 1 for i in range(60) if i % 3)
    assert 0 < stats["s1"].compression_ratio < 1


def test_write_if_absent(spark, tmp_path):
    path = str(tmp_path / "once")
    for n in (3, 5):
        landing.write_if_absent(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3


def test_files_not_loaded_yet(spark):
    from folioflow.operators.joins import not_loaded

    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file_path string")
    left = not_loaded(files, files.where(F.col("file_path") != "b"))
    assert [r.file_path for r in left.collect()] == ["b"]


def test_malformed_feed_is_an_error_of_its_file(spark, tmp_path):
    good = "<feed><entry><id>1</id></entry><entry><id>2</id></entry></feed>"
    (tmp_path / "good.xml").write_text(good)
    (tmp_path / "bad.xml").write_text("<feed><entry><id>3</id></entry><entry><id>4</entry><entry><id>5</id></entry></feed>")
    assert sorted(r.id for r in feeds.read_feed(spark, str(tmp_path)).collect()) == ["1", "2"]
    row, = feeds.feed_errors(spark, str(tmp_path)).collect()
    assert row.file_path.endswith("/bad.xml") and row.file_error.startswith("failed to parse XML response: ")
