"""Landing streams: batches, repeats, and the tables they leave."""

import gzip
import json

import sys

import pytest
from plan_metrics import bytes_moved, files_read
from pyspark import cloudpickle
from pyspark.sql import functions as F

from folioflow import schemas
from folioflow.operators import joins
from folioflow.operators.embed import letter_counts
from folioflow.session import scratch_dir
from folioflow.sources import landing
from folioflow.streaming import landing as stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers do not see this file


def put(folder, name, papers):
    (folder / name).write_bytes(gzip.compress("\n".join(json.dumps(p) for p in papers).encode()))


@pytest.fixture()
def world(spark, tmp_path):
    source = tmp_path / "raw-data"
    source.mkdir()
    return source, stream.Store(spark, scratch_dir(spark, "store")), scratch_dir(spark, "state")


def run(spark, source, store, state, **kw):
    stream.process_landing(spark, str(source), store, state, **kw).awaitTermination()


def test_two_batches_and_their_tables(spark, world):
    source, store, state = world
    put(source, "a.gz", [{"id": "1", "title": "abc"}, {"id": "2", "title": "  "}, {"id": "1", "title": "copy"}, {"x": 1}])
    (source / "broken.gz").write_bytes(b"nothing")
    run(spark, source, store, state)
    put(source, "b.gz", [{"id": "1", "title": "new"}, {"id": "3"}])
    run(spark, source, store, state)

    papers = {r.paper_id: r for r in store.papers.read().collect()}
    assert {k: r.title for k, r in papers.items()} == {"1": "new", "2": "  ", "3": ""}
    first, second = stream.trace_of_batch("landing", 0), stream.trace_of_batch("landing", 1)
    assert papers["2"].trace_id == first and papers["1"].trace_id == second

    results = {r.trace_id: r for r in store.batch_results.read().collect()}
    one, two = results[first], results[second]
    assert (one.status, one.original_count, one.unique_count, one.duplicate_count) == ("partial_success", 3, 2, 1)
    assert one.record_errors == 1 and one.file_errors == 1 and one.error_message.startswith("failed to download/decompress")
    assert (two.status, two.unique_count, two.error_message) == ("success", 2, None)
    assert (two.total_items, two.batch_count, two.success_batches, two.failed_batches) == (2, 1, 1, 0)

    runs = {r.trace_id: r for r in store.vector_results.read().collect()}
    assert (runs[first].status, runs[first].total_papers, runs[first].failed_embeddings) == ("partial_success", 2, 1)
    assert (runs[second].status, runs[second].total_papers, runs[second].vectors_stored) == ("completed", 1, 1)
    letters = [(r.stage, r.paper_id) for r in store.dead_letters.read().collect()]
    assert letters == [("embedding_generation", "2")]
    vectors = {r.paper_id: r for r in store.vectors.read().collect()}
    assert set(vectors) == {"1"} and vectors["1"].source_text.content == "new"
    assert vectors["1"].embedding_metadata.dimension == 26


def test_repeated_batch_gives_the_same_rows(spark, world):
    source, store, _ = world
    put(source, "a.gz", [{"id": "1", "title": "abc"}])
    trace = stream.trace_of_batch("landing", 0)
    for _ in range(2):
        stream.take_in(store, landing.read_landing(spark, str(source)), trace)
        stream.vectorize(store, trace, letter_counts, "letter-counts", attempt="first")
    assert store.papers.read().count() == store.vectors.read().count() == store.vector_results.read().count() == 1


def some_fail():
    encode = letter_counts()

    def run(texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot encode")
        return encode(texts)

    return run


def test_run_again_after_failures(spark, world):
    source, store, state = world
    put(source, "a.gz", [{"id": str(i), "title": "bad" if i % 2 else "good"} for i in range(4)])
    run(spark, source, store, state, factory=some_fail)
    trace = stream.trace_of_batch("landing", 0)
    assert store.vectors.read().count() == 2 and store.dead_letters.read().count() == 2
    stream.revectorize(store, trace, letter_counts, "letter-counts", attempt="again")
    assert store.vectors.read().count() == 4
    rows = {r.attempt: r for r in store.vector_results.read().collect()}
    assert (rows["batch 0"].status, rows["batch 0"].vectors_stored) == ("partial_success", 2)
    assert (rows["again"].status, rows["again"].total_papers, rows["again"].vectors_stored) == ("completed", 2, 2)
    assert rows["again"].throughput_per_second > 0
    todo = joins.retry_set(store.papers.read(), store.vectors.read(), store.dead_letters.read(), stored_at=F.col("processing_info.created_at"))
    assert todo.count() == 0
    stream.vectorize(store, trace, letter_counts, "letter-counts-2")
    assert {r[0] for r in store.vectors.read().select("embedding_metadata.model_version").collect()} == {"letter-counts-2"}


def test_stop_before_the_result_is_written(spark, world, monkeypatch):
    """A first attempt stores some vectors and stops; the retry stores all and says so."""
    source, store, _ = world
    put(source, "a.gz", [{"id": "1", "title": "good"}, {"id": "2", "title": "bad"}])
    stream.take_in(store, landing.read_landing(spark, str(source)), "t")
    with monkeypatch.context() as m:
        m.setattr(stream.jobs, "dead_letters", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stream.vectorize(store, "t", some_fail, "m", attempt="a")
    assert store.vectors.read().count() == 1 and store.vector_results.read().count() == 0
    stream.vectorize(store, "t", letter_counts, "m", attempt="a")
    assert store.vectors.read().count() == 2 and store.vector_results.read().first().vectors_stored == 2


@pytest.mark.parametrize("name", ["x[1].gz", "y{z}.gz", "s*r.gz", "p%20.gz", "a b.gz"])
def test_file_names_are_only_names(spark, world, name):
    source, store, state = world
    put(source, name, [{"id": "odd"}])
    put(source, "x1.gz", [{"id": "plain"}])
    run(spark, source, store, state, factory=None)
    keys = lambda df, c: sorted(r[0] for r in df.select(c).collect())
    assert keys(store.papers.read(), "paper_id") == keys(landing.read_landing(spark, str(source)), "record_key") == ["odd", "plain"]


def test_all_files_bad(spark, world):
    source, store, state = world
    (source / "broken.gz").write_bytes(b"nothing")
    run(spark, source, store, state, factory=None)
    row = store.batch_results.read().first()
    assert (row.status, row.processed_count, row.file_errors) == ("failed", 0, 1)


def test_many_small_batches(spark, world):
    source, store, state = world
    for i in range(3):
        put(source, f"{i}.gz", [{"id": str(i)}, {"id": "same", "title": str(i)}])
    run(spark, source, store, state, factory=None, max_files=1)
    assert store.papers.read().count() == 4
    assert store.batch_results.read().count() == 3


def test_a_batch_costs_what_it_brings(spark, world):
    """The tenth batch reads and writes no more than the second, and a compaction changes no row."""
    source, store, _ = world
    moved = []
    for i in range(10):
        folder = source / str(i)
        folder.mkdir()
        put(folder, "a.gz", [{"id": f"{i}-{k}", "title": f"title {i} {k}"} for k in range(50)] + [{"id": "same", "title": str(i)}])
        with bytes_moved(spark) as out:
            stream.take_in(store, landing.read_landing(spark, str(folder)), f"t{i}")
            stream.vectorize(store, f"t{i}", letter_counts, "letter-counts", attempt="first")
        moved.append(out)
    assert moved[1]["read"] > 0 and moved[1]["written"] > 0
    assert moved[9]["read"] <= 1.05 * moved[1]["read"] and moved[9]["written"] <= 1.05 * moved[1]["written"]

    def content():
        tables = (store.papers, store.papers_by_trace, store.vectors, store.vector_results, store.batch_results)
        return [sorted(map(repr, t.read().collect())) for t in tables]

    before = content()
    assert [len(rows) for rows in before] == [501, 510, 501, 10, 10]
    store.compact()
    assert content() == before
    assert store.papers_of("t9").count() == 51 and store.papers_of("t3").count() == 50 and store.papers_of("none").count() == 0
    stream.vectorize(store, "t3", letter_counts, "second", attempt="again")  # by the index: the put is folded
    assert store.vectors.read().where("embedding_metadata.model_version = 'second'").count() == 50


def test_the_index_opens_the_buckets_of_a_trace(spark, world):
    _, _, _ = world
    store = stream.Store(spark, scratch_dir(spark, "store"), buckets=32)
    papers = spark.range(2000).selectExpr("cast(id as string) as id", "concat('t', id div 4) as trace_id", "concat('title ', id) as title")
    rows = papers.selectExpr("id as paper_id", "trace_id", "title").select(
        *[F.col(f.name) if f.name in ("paper_id", "trace_id", "title") else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PAPER])
    store.papers.upsert(rows)
    store.papers_by_trace.upsert(rows.select("trace_id", "paper_id"))
    store.compact()
    found = store.papers_of("t7")
    assert sorted(r.paper_id for r in found.collect()) == ["28", "29", "30", "31"]
    assert files_read(found) <= 1 + 4 < 32


def test_a_rule_of_the_papers_table(spark, world):
    """Batches of 25 with a paper that the table refuses are not stored, and the result, the index and the dead letters say so."""
    source, _, state = world
    store = stream.Store(spark, scratch_dir(spark, "store"), paper_rule=F.when(F.length("title") > 100, "title is too long"))
    put(source, "a.gz", [{"id": f"p{i}", "title": "x" * 200 if i == 30 else f"title {i}"} for i in range(60)])
    run(spark, source, store, state)
    result = store.batch_results.read().first()
    stored = store.papers.read().count()
    assert (result.total_items, result.success_items, result.failed_items) == (60, stored, 60 - stored) and result.failed_items in (10, 25)
    assert (result.batch_count, result.success_batches, result.failed_batches) == (3, 2, 1)
    assert (result.status, result.processed_count, result.error_message) == ("partial_success", stored, f"{60 - stored} items failed to upsert")
    letters = store.dead_letters.read().collect()
    assert len(letters) == 60 - stored and {(r.stage, r.reason) for r in letters} == {("batch_upsert", "title is too long")}
    assert store.papers_by_trace.read().count() == stored == store.vectors.read().count()
    put(source, "b.gz", [{"x": 1}])
    run(spark, source, store, state)
    empty = next(r for r in store.batch_results.read().collect() if r.total_items == 0)
    assert (empty.status, empty.batch_count) == ("failed", 0) and empty.file_errors == 1
