"""The audit of filters, against a brute-force run of every order."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import fixtures as fx
import numpy as np
import pytest

from folioflow.llm import filter_audit


def fails(docs):
    """part and failed filters of every (doc_id, text, source), by the letter of the definition."""
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    for d, t, s in docs:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0D]+", t)
        own = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
               "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > first[t]}
        yield d, s or "", {f for f, bad in own.items() if bad}


def brute_force(docs, labels):
    good, toxic = ({d for d, *own in labels if own[i] == 1 and d is not None} for i in (0, 1))
    rows = list(fails(docs))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for step, f in enumerate(order, 1):
            for part in {p for _, p, _ in rows}:
                out[part, "".join(order), step] = Counter()
        for d, part, failed in rows:
            hit = next((i for i, f in enumerate(order, 1) if f in failed), 9)
            for step, f in enumerate(order, 1):
                c = out[part, "".join(order), step]
                c["kept"] += hit > step
                c["redundant"] += f in failed and hit < step
                c["unique_fails"] += failed == {f}
                if hit == step:
                    c["removed"] += 1
                    c["good_lost"] += d in good
                    c["toxic_lost"] += d in toxic
                    shapley[part, f] += 1
    for (part, order, step), c in out.items():
        c["shapley"] = shapley[part, order[step - 1]]
    return out


def check(docs, labels, **more):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = filter_audit.audit(docs, labels, **more).collect()
    wanted = brute_force([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()])
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows} == {k: tuple(c[n] for n in names) for k, c in wanted.items()}
    assert len(rows) == len(wanted)


@pytest.fixture
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (5, 1, None), (12, 1, 1), (None, 1, 1), (999, 1, 1), (200, 1, 0), (201, 0, 1)]
    return spark.createDataFrame([(*r, "odd", "odd") for r in rows], "doc_id bigint, quality int, toxic int, fails string, text string")


def test_odd_documents(spark, labels):
    extra = [(200, "AB " * 60, "en", "a"), (201, "a b $ " * 40, "en", "b"), (202, fx.prose(5, 60) + " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDE", "en", ""), (203, "A" * 20, "en", "a"),
             (204, "Word word WORD " * 20, "en", "a"), (205, "\U0001f600" * 95 + "ABCDE", None, "a"), (206, "x y " * 50, None, "b")]
    docs = fx.documents(spark, extra).withColumnRenamed("n", "n_words").withColumnRenamed("hash", "fails")
    check(docs, labels)


def test_small_shards_and_words_in_many_of_them(spark, labels, monkeypatch):
    rows = [(300 + i, "the same words " * 20 + fx.prose(i % 7, 30), "en", f"s{i % 3}") for i in range(60)]
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 2000)
    check(fx.documents(spark, rows), labels)


def test_empty_tables(spark, labels):
    assert filter_audit.audit(fx.empty(spark), labels).collect() == []
    check(fx.documents(spark), labels.limit(0))


def test_packed_integers():
    for values in ([], [0], [5, 4, 4, 2**31 - 1, 0, 7]):
        assert filter_audit.unpack_ints(filter_audit.pack_ints(np.array(values, np.int64))).tolist() == values


def test_matrix(spark):
    """Rows of the matrix hold the counts of words under the ids of one dictionary."""
    docs = fx.documents(spark)
    found, ids = defaultdict(Counter), {}
    for r in filter_audit.document_term_matrix(docs).collect():
        for i, d in enumerate(r["doc_ids"]):
            for k in range(r["indptr"][i], r["indptr"][i + 1]):
                found[d][r["columns"][k]] += r["counts"][k]
    wanted = defaultdict(Counter)
    for d, t in fx.pairs(docs):
        wanted[d].update(re.findall("[^\x20\x09-\x0D]+", t or ""))
    for d, words in wanted.items():
        assert sorted(words.values()) == sorted(found[d].values()), d
        for w, n in words.items():
            if list(words.values()).count(n) == 1:
                column = next(c for c, m in found[d].items() if m == n)
                assert ids.setdefault(w, column) == column
    assert len(set(ids.values())) == len(ids)
