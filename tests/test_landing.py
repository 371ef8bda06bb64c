"""Exact rows of the landing scan and of normalization."""

import gzip
import io
import json

import pytest
from pyspark.sql import functions as F

from folioflow.operators import records
from folioflow.sources import feeds, landing
from folioflow.sources.stored_files import LIMIT_SETTING
from folioflow.streaming import alarms
from folioflow.streaming import landing as stream

A, B = '{"paper_id":"a"}', '{"id":"b"}'
OK = (None, None)


def outcomes(text):
    return [(json.loads(r) if r else None, e, f) for _, r, e, f in landing.records_of_text(text)]


def test_keys():
    text = f'{A}\n{{"paper_id":1,"id":"z"}}\n{{"paper_id":"","id":7}}'
    assert [k for k, *_ in landing.records_of_text(text)] == ["a", "z", None]


@pytest.mark.parametrize("text, expected", [
    (f"[{A}, {B}]", [({"paper_id": "a"}, *OK), ({"id": "b"}, *OK)]),
    ("[]", []),
    ("null", []),
    ("[null]", [(None, "data_conversion", None)]),
    ('[{"x":1}]', [({"x": 1}, "data_conversion", None)]),
    (f"{A}\r\n\r{B}\n", [({"paper_id": "a"}, *OK), ({"id": "b"}, *OK)]),
    (f"{A} junk\n{B}", [(None, "json_parsing", None), ({"id": "b"}, *OK)]),
    (f"   \n{B}", [(None, "json_parsing", None), ({"id": "b"}, *OK)]),
    ('{"paper_id":NaN}\n' + B, [(None, "json_parsing", None), ({"id": "b"}, *OK)]),
    ('{"id":"b","n":1e999}\n' + A, [(None, "json_parsing", None), ({"paper_id": "a"}, *OK)]),
    ('{"id":"x","id":"b"}', [({"id": "b"}, *OK)]),
    ("", [(None, None, landing.NO_VALID_PAPERS)]),
    ("not json", [(None, "json_parsing", None), (None, None, landing.NO_VALID_PAPERS)]),
    (f"[{A}, 1]", [(None, "json_parsing", None), (None, None, landing.NO_VALID_PAPERS)]),
    (f"[\n{A}\n,1]", [(None, "json_parsing", None), ({"paper_id": "a"}, *OK), (None, "json_parsing", None)]),
    ('{"papers":[' + A + "," + B + '],"source":"s"}', [({"paper_id": "a"}, *OK), ({"id": "b"}, *OK)]),
    ('{"papers":[],"count":0}', []),
    ('{"papers":[1,' + A + "]}", [(None, "data_conversion", None), ({"paper_id": "a"}, *OK)]),
    ('{"id":"\\ud800x"}', [({"id": "�x"}, *OK)]),
])
def test_records_of_text(text, expected):
    assert outcomes(text) == expected


def write(path, data: bytes):
    path.write_bytes(data)


@pytest.fixture()
def folder(tmp_path):
    body = "\n".join([A, B, "broken", '{"paper_id":"c","title":"T"}']).encode()
    write(tmp_path / "good.gz", gzip.compress(body))
    write(tmp_path / "other.gzip", gzip.compress(b'[{"paper_id":"d"}]'))
    write(tmp_path / "plain.json", b'{"paper_id":"e"}')
    write(tmp_path / "corrupt.gz", b"\x1f\x8bnot gzip at all")
    write(tmp_path / "cut.gz", gzip.compress(body)[:-12])
    write(tmp_path / "empty.gz", gzip.compress(b"[]"))
    return tmp_path


def test_suffix_rule_and_isolation(spark, folder):
    rows = landing.read_landing(spark, str(folder), glob="*").select(
        F.element_at(F.split("file_path", "/"), -1).alias("f"), "record_no", "record", "record_error", "file_error"
    ).collect()
    good = sorted((r.f, r.record_no, json.loads(r.record)) for r in rows if r.record)
    assert good == [
        ("good.gz", 0, {"paper_id": "a"}), ("good.gz", 1, {"id": "b"}),
        ("good.gz", 3, {"paper_id": "c", "title": "T"}),
        ("other.gzip", 0, {"paper_id": "d"}), ("plain.json", 0, {"paper_id": "e"}),
    ]
    assert sorted(r.f for r in rows if r.file_error) == ["corrupt.gz", "cut.gz"]
    assert [(r.f, r.record_no) for r in rows if r.record_error] == [("good.gz", 2)]


def test_landing_glob_takes_gz_only(spark, folder):
    names = landing.read_landing(spark, str(folder)).select(F.element_at(F.split("file_path", "/"), -1)).distinct()
    assert sorted(r[0] for r in names.collect()) == ["corrupt.gz", "cut.gz", "good.gz"]


def test_large_array_in_batch_and_stream(spark, tmp_path):
    """One array of more than 32 MB gives all its papers, as a scan and as a stream."""
    source = tmp_path / "in"
    source.mkdir()
    papers = [{"paper_id": str(i), "title": "long title " * 120} for i in range(26_000)]
    body = json.dumps(papers, indent=1).encode()
    assert len(body) > 32 * 1024 * 1024
    write(source / "array.gz", gzip.compress(body, 1))
    count = lambda df: (df.where("record_key is not null").select("record_key").distinct().count(), df.where("record_error is not null or file_error is not null").count())
    assert count(landing.read_landing(spark, str(source))) == (26_000, 0)
    alarms.run_to_table(stream.landing_stream(spark, str(source)), str(tmp_path / "out"), str(tmp_path / "state"))
    assert count(spark.read.parquet(str(tmp_path / "out"))) == (26_000, 0)


@pytest.mark.parametrize("text, elements", [
    ("[]", []), (" [ ] ", []), ("[1]", [1]), ('[{"a": [1, "]"]}, null ,2.5]', [{"a": [1, "]"]}, None, 2.5]), ("[12,34]", [12, 34]),
    ("[1,]", None), ("[1 2]", None), ("[1", None), ("[", None), ("[1] x", None), ("", None), ('{"a":1}', None), ("[NaN]", None),
])
@pytest.mark.parametrize("piece", [1, 3, 1000])
def test_array_elements(text, elements, piece):
    scan = lambda: list(landing._array_elements(io.StringIO(text), piece))
    if elements is None:
        with pytest.raises(ValueError):
            scan()
    else:
        assert scan() == elements


def test_landing_write_keeps_digits_and_bounds_files(spark, tmp_path):
    df = spark.sql("""SELECT 's' AS source, timestamp'2024-01-20 00:00:00' AS collected_at, CAST(id AS string) AS id,
      CASE WHEN id = 0 THEN timestamp'2024-01-02 12:34:56.123456' ELSE timestamp'2024-01-02 12:34:50' END AS at FROM range(0, 10, 1, 1)""")
    landing.write_landing(df, str(tmp_path / "out"), max_records=4)
    rows = landing.read_landing(spark, str(tmp_path / "out"))
    times = {json.loads(r.record)["at"] for r in rows.collect()}
    assert times == {"2024-01-02T12:34:56.123456Z", "2024-01-02T12:34:50Z"}
    assert rows.select("file_path").distinct().count() == 3


def normalized(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "record string")
    return [r.asDict() for r in records.normalize_records(df).collect()]


@pytest.mark.parametrize("text, key, source, authors", [
    ('{"paper_id":"a","id":"b","source":"s","authors":["x","y"]}', "a", "s", ["x", "y"]),
    ('{"paper_id":12,"id":"b"}', "b", "unknown", []),
    ('{"paper_id":"","id":"b","source":""}', "b", "", []),
    ('{"paper_id":"","id":7,"source":7}', None, "unknown", []),
    ('{"id":"b","authors":"x"}', "b", "unknown", []),
    ('{"id":"b","authors":["x",1,null,{"n":1},"y"],"source":null}', "b", "unknown", ["x", "y"]),
    ('{"id":"b","authors":[]}', "b", "unknown", []),
    ('{"id":" "}', " ", "unknown", []),
])
def test_normalize(spark, text, key, source, authors):
    row, = normalized(spark, text)
    assert (row["paper_id"], row["source"], row["authors"]) == (key, source, authors)


def test_normalize_blanks_wrong_types(spark):
    row, = normalized(spark, '{"id":"b","title":1,"abstract":["a"],"published_date":true,"categories":{"a":1},"raw_xml":2}')
    assert (row["title"], row["abstract"], row["published_date"], row["categories"], row["raw_xml"]) == (
        "", "", "", [], None)


def test_wide_characters_survive(spark):
    row, = normalized(spark, json.dumps({"id": "b", "title": "é中\U0001f600\\\"\n"}))
    assert row["title"] == "é中\U0001f600\\\"\n"


@pytest.fixture()
def small_limit(spark):
    before = spark.conf.get(LIMIT_SETTING)
    spark.conf.set(LIMIT_SETTING, "1000")
    yield
    spark.conf.set(LIMIT_SETTING, before)


def large_folder(tmp_path):
    lines = [json.dumps({"id": f"p{i}", "title": "é" * (i % 50)}) for i in range(2000)]
    many = "\n".join(lines).encode()
    write(tmp_path / "small.gz", gzip.compress(A.encode()))
    write(tmp_path / "lines.gz", gzip.compress(many))
    write(tmp_path / "an array%20é.gzip", gzip.compress(("[" + ",".join(lines) + "]").encode()))
    write(tmp_path / "plain.json", many)
    write(tmp_path / "cut.gz", gzip.compress(many, 0)[:-5000])
    return tmp_path


def test_files_above_the_limit_of_a_value(spark, tmp_path, small_limit):
    """Read by their path as a stream: the same records, and a broken one is one error row that stops nothing."""
    rows = landing.read_landing(spark, str(large_folder(tmp_path)), glob="*").select(
        F.element_at(F.split("file_path", "/"), -1).alias("f"), "record_no", "record_key", "file_error").collect()
    keys = lambda f: [r.record_key for r in sorted(rows, key=lambda r: r.record_no) if r.f == f]
    every = [f"p{i}" for i in range(2000)]
    assert keys("small.gz") == ["a"] and keys("lines.gz") == keys("plain.json") == every
    assert [k for r in {r.f for r in rows} if r.startswith("an") for k in keys(r)] == every
    assert [(r.f, r.record_key) for r in rows if r.file_error] == [("cut.gz", None)]
    assert len(rows) == 1 + 3 * 2000 + 1


def test_large_files_in_the_stream(spark, tmp_path, small_limit):
    folder = tmp_path / "in"
    folder.mkdir()
    large_folder(folder)
    store = stream.Store(spark, str(tmp_path / "store"))
    stream.process_landing(spark, str(folder), store, str(tmp_path / "state"), factory=None).awaitTermination()
    assert store.papers.read().count() == 2001
    result = store.batch_results.read().first()
    assert (result.status, result.file_errors, result.unique_count) == ("partial_success", 1, 2001)
    out = str(tmp_path / "out")
    alarms.run_to_table(stream.landing_stream(spark, str(folder)), out, str(tmp_path / "state2"))
    assert spark.read.parquet(out).where("record_key is not null").count() == 2001


def test_large_feeds(spark, tmp_path, small_limit):
    entries = "".join(f"<entry><id>{i}</id><title>t</title></entry>" for i in range(200))
    (tmp_path / "good.xml").write_text(f"<feed>{entries}</feed>")
    (tmp_path / "bad.xml").write_text(f"<feed>{entries}<entry></feed>")
    (tmp_path / "short.xml").write_text("<feed><entry><id>short</id></entry></feed>")
    assert feeds.read_feed(spark, str(tmp_path)).count() == 201
    row, = feeds.feed_errors(spark, str(tmp_path)).collect()
    assert row.file_path.endswith("/bad.xml") and row.file_error.startswith("failed to parse XML response: ")


def test_range_of_collection_days(spark, tmp_path):
    papers = spark.range(40).selectExpr("cast(id as string) as id", "'s' as source", "timestamp '2024-01-01 12:00:00' + make_interval(0, 0, 0, cast(id div 10 as int)) as collected_at")
    path = tmp_path / "raw-data"
    landing.write_landing(papers, str(path))
    read = lambda **days: sorted(int(r.record_key) for r in landing.read_landing(spark, str(path), **days).collect())
    assert read(date_from="2024-01-02", date_to="2024-01-03") == list(range(10, 30))
    assert read(date_to="2024-01-01") == list(range(10)) and read(date_from="2024-01-04") == list(range(30, 40))
    assert read(date_from="2025-01-01") == [] and read() == list(range(40))
    (path / "collect_date=2024-01-01" / "collect_source=s" / "bad.gz").write_bytes(b"nothing")
    assert landing.read_landing(spark, str(path), date_from="2024-01-02").where("file_error is not null").count() == 0
