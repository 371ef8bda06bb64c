"""The suffix tree whose contexts grow with the texts, against a brute-force one."""

import math
import pathlib
import random
import re
import zlib
from collections import Counter, defaultdict

import fixtures as fx
import pytest

from folioflow.llm import context_tree, suffix_tree

END = -1


def symbols(text):
    return list(" ".join(re.findall("[^\x20\x09-\x0D]+", (text or "").translate(fx.LOWER))).encode()) + [END]


def brute_force(pairs):
    """The score of each text, and the length of the longest kept context."""
    streams = [(d, symbols(t)) for d, t in pairs]
    learnt = [s for d, s in streams if zlib.crc32(str(d).encode()) % 7 != 2]
    possible = 256 - 26 - 6 + 2  # bytes but A-Z and spaces, one space, the end
    seen, n = Counter(y for s in learnt for y in s), sum(map(len, learnt))
    p = {(): defaultdict(lambda: 0.5 / (n + 0.5 * possible), {y: (c + 0.5) / (n + 0.5 * possible) for y, c in seen.items()})}
    best = [[p[()]] * len(s) for _, s in streams]
    open_, depth, deepest = [[True] * len(s) for _, s in streams], 0, 0
    while any(map(any, open_)):
        depth += 1
        context = lambda s, i: tuple(s[j] if j >= 0 else END for j in range(max(i - depth, -1), i))
        counts, suffix = defaultdict(Counter), {}
        for (d, s), b, o in zip(streams, best, open_, strict=True):
            for i, y in enumerate(s):
                if o[i]:
                    suffix[context(s, i)] = b[i]
                    if zlib.crc32(str(d).encode()) % 7 != 2:
                        counts[context(s, i)][y] += 1
        kept = {}
        for c, own in counts.items():
            total, q = sum(own.values()), suffix[c]
            if total >= suffix_tree.LEAST_SEEN and sum(k * math.log(k / total / q[y]) for y, k in own.items()) >= suffix_tree.DIVERGENCE:
                kept[c] = {y: (own[y] + suffix_tree.SMOOTHING * q[y]) / (total + suffix_tree.SMOOTHING) for y in range(-1, 256)}
        for (_, s), b, o in zip(streams, best, open_, strict=True):
            for i in range(len(s)):
                if o[i]:
                    b[i] = kept.get(context(s, i), b[i])
                    o[i] = depth < 3 or context(s, i) in kept
        deepest = depth if kept else deepest
    return [sum(math.log10(q[y]) for q, y in zip(b, s, strict=True)) for (_, s), b in zip(streams, best, strict=True)], deepest


def documents(spark):
    r = random.Random(5)
    deep = ["x" * 2, "x" * 9]  # the longer a run has been, the more often it ends
    scripts = "".join(chr(c) for c in [*range(0xC0, 0x250), *range(0x400, 0x460), *range(0x5D0, 0x5EB), *range(0x4E00, 0x4E40)])
    rows = [(i, " ".join(r.choice(deep) for _ in range(200))) for i in range(20)]
    rows += [(100 + i, " ".join("".join(r.choice(scripts) for _ in range(4)) for _ in range(60))) for i in range(20)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (None, "x" * 300), (204, "Ab  c"), (204, "Ab  c")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_contexts_as_long_as_the_texts_bear_out(spark):
    docs = documents(spark)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, deepest = brute_force(pairs)
    assert deepest > suffix_tree.DEPTH + 3 and len({b for _, t in pairs for b in symbols(t)}) > suffix_tree.SYMBOLS
    found = sorted(((r["doc_id"] is None, r["doc_id"], r["score"]) for r in context_tree.lm_scores(docs).collect()), key=lambda x: (x[0], x[1] or 0, x[2]))
    want = sorted(((d is None, d, s) for (d, _), s in zip(pairs, want, strict=True)), key=lambda x: (x[0], x[1] or 0, x[2]))
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert [x[2] for x in found] == pytest.approx([x[2] for x in want], rel=1e-4)


def test_packs_and_shards_do_not_matter(spark):
    docs = documents(spark)
    one, other = (sorted(map(repr, ((r["doc_id"], round(r["score"], 6)) for r in context_tree.lm_scores(docs, size).collect()))) for size in (1 << 24, 200))
    assert one == other


def test_empty_table(spark):
    assert context_tree.lm_scores(fx.empty(spark)).collect() == []


def test_the_query_scores_with_this_tree(spark, tmp_path):
    from folioflow.llm.queries import op7

    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op7(spark, str(tmp_path)).collect()
    bounded = {r["doc_id"]: r["score"] for r in suffix_tree.lm_scores(documents(spark)).collect()}
    assert sum(r["score"] for r in rows if r["doc_id"] in range(20)) > 0.9 * sum(bounded[d] for d in range(20))


def test_what_is_stored_at_once(spark, monkeypatch):
    """Rows, keys and answers of a round together take a few bytes for each byte of text."""
    r = random.Random(7)
    words = ["".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    docs = spark.createDataFrame([(i, " ".join(r.choice(words) for _ in range(400))) for i in range(800)], "doc_id bigint, text string")
    size, paths, most = sum(len(x["text"]) for x in docs.collect()), [], [0]
    new, old = context_tree.scratch_dir, context_tree.remove

    def remove(spark, path):
        most[0] = max(most[0], sum(f.stat().st_size for p in paths for f in pathlib.Path(p).rglob("*.parquet") if f.exists()))
        old(spark, path)

    monkeypatch.setattr(context_tree, "scratch_dir", lambda spark, name: paths.append(new(spark, name)) or paths[-1])
    monkeypatch.setattr(context_tree, "remove", remove)
    assert context_tree.lm_scores(docs).count() == 800
    assert 0 < most[0] < 8 * size
    print("stored", most[0] / size)


def test_contexts_of_more_than_a_word_of_symbols(spark):
    """Contexts of more than 8 symbols, which are hashed and not held whole."""
    r, rows = random.Random(11), []
    for i in range(40):  # a run seldom ends after an odd number of symbols, so each symbol more tells something
        runs = []
        for _ in range(500):
            n = 1
            while n < 16 and r.random() > (0.04, 0.5)[n % 2 == 0]:
                n += 1
            runs.append("x" * n)
        rows.append((i, " ".join(runs)))
    want, deepest = brute_force(rows)
    assert deepest > 9
    found = {x["doc_id"]: x["score"] for x in context_tree.lm_scores(spark.createDataFrame(rows, "doc_id bigint, text string"), 400).collect()}
    assert [found[i] for i, _ in rows] == pytest.approx(want, rel=1e-4)


def test_texts_are_written_once(spark, monkeypatch):
    """A round writes which places are open, not the texts again."""
    paths, texts, new = [], [], context_tree.scratch_dir
    old = context_tree.remove

    def remove(spark, path):
        texts.append([p for p in paths if any(x["symbols"] is not None for x in context_tree._stored(spark, p, context_tree.ROWS_DDL, "slice").select("symbols").collect())] if pathlib.Path(path).exists() else [])
        old(spark, path)

    monkeypatch.setattr(context_tree, "scratch_dir", lambda spark, name: paths.append(new(spark, name)) or paths[-1])
    monkeypatch.setattr(context_tree, "remove", remove)
    monkeypatch.setattr(context_tree, "_stored", stored_if_there(context_tree._stored))
    assert context_tree.lm_scores(documents(spark)).count() == len(documents(spark).collect())
    assert len(paths) > 3 and {p for x in texts for p in x} == {paths[0]}


def stored_if_there(stored):
    def read(spark, path, ddl, kind):
        return stored(spark, path, ddl, kind) if pathlib.Path(path).exists() else spark.createDataFrame([], ddl)

    return read


def test_numbers_are_found_in_a_table():
    import numpy as np

    r = np.random.default_rng(3)
    for n in (0, 1, 5, 20_000):
        numbers = np.unique(np.append(r.integers(0, 1 << 63, n, dtype=np.uint64), np.arange(min(n, 3), dtype=np.uint64)))
        hit, value = context_tree.Table(numbers, np.arange(len(numbers), dtype=np.int32)).find(asked := np.concatenate([numbers, numbers + np.uint64(1), np.arange(4, dtype=np.uint64)]))
        assert np.array_equal(hit, np.isin(asked, numbers)) and np.array_equal(numbers[value[hit]], asked[hit])
