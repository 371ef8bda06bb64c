"""Queries that write whole files write many of bounded size."""

from pathlib import Path

import oracle
import pytest

from folioflow.plans import landing_queries

QUERIES = {"s1_feed_errors": landing_queries.s1_errors, "s2_bad_files": landing_queries.s2_bad_files,
           "s3_array_files": landing_queries.s3_array, "s4_envelope_files": landing_queries.s4_envelope}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_many_files_give_the_same_rows(spark, monkeypatch, tmp_path, name):
    whole = sorted(map(tuple, QUERIES[name](spark, oracle.SF_DIR).collect()))
    paths = []

    def scratch(_, folder):
        paths.append(str(tmp_path / folder))
        return paths[-1]

    monkeypatch.setattr(landing_queries, "scratch_dir", scratch)
    monkeypatch.setattr(landing_queries, "FILE_BYTES", 5_000, raising=False)
    assert sorted(map(tuple, QUERIES[name](spark, oracle.SF_DIR).collect())) == whole
    assert len([f for f in Path(paths[0]).rglob("part-*") if f.is_file()]) > 3
