"""The registered queries over whole tables: against SQL, or against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import fixtures as fx
import oracle
import pytest

from folioflow.llm import licenses, secret_scan
from folioflow.llm.queries import ORACLES, QUERIES


def result(spark, name):
    rows = QUERIES[name](spark, oracle.SF_DIR).collect()
    found = {r["doc_id"]: r.asDict() for r in rows}
    assert len(found) == len(rows) == fx.table(spark, "documents").count()
    return found


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    oracle.compare(QUERIES[name](spark, oracle.SF_DIR), oracle.connect(), ORACLES[name])


def places(words, phrase):
    p = phrase.split(" ")
    return [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]


def check_licenses(docs, found):
    for doc, text in docs:
        words = fx.lower_words(text)
        at = {label: places(words, phrase) for phrase, label in licenses.BASE}
        every = [i for x in at.values() for i in x]
        r = found[doc]
        assert (r["n_words"], r["n_base"]) == (len(words), len(every)), doc
        assert (r["first_word"], r["last_word"]) == ((min(every), max(every)) if every else (None, None))
        assert r["base_labels"] == ",".join(sorted(label for label, x in at.items() if x))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))


def test_license_scan(spark):
    check_licenses(fx.pairs(fx.table(spark, "documents")), result(spark, "op1_license_scan"))


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.IGNORECASE | re.ASCII):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 8)
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def check_secrets(docs, found):
    for doc, text in docs:
        spans = base_spans(text)
        joined = ",".join(f"{['assign', 'access', 'hex'][k]}:{s}:{e}" for s, k, e in spans)
        r = found[doc]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in spans) for i in range(3)], doc
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r["spans"].split(","))


def test_secret_scan(spark):
    check_secrets(fx.pairs(fx.table(spark, "documents")), result(spark, "op2_secret_scan"))
    assert secret_scan.KINDS[:3] == ["assign", "access", "hex"]


def test_language_id(spark):
    found = result(spark, "op3_language_id")
    labels = {r["doc_id"]: r["lang"] for r in fx.table(spark, "documents").select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in found.items())
    out = [d for d, r in found.items() if r["held_out"]]
    assert sum(found[d]["lang_pred"] == labels[d] for d in out) / len(out) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def links_of(sets):
    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    links = {}
    for d, s in sets.items():
        both = Counter(x for g in s for x in where[g])
        links[d] = {x for x, n in both.items() if x != d and n >= 0.8 * (len(s) + len(sets[x]) - n) - 1e-9}
    return links


def components(links):
    root = {}
    for d in sorted(links):
        todo = [d]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = root[d] if d in root else d
                todo += links[x]
    return root


def test_jaccard_join(spark):
    found = result(spark, "op4_chosen_path_join")
    links = links_of({d: fx.shingle_set(t) for d, t in fx.pairs(fx.table(spark, "documents"))})
    root = components(links)
    assert all((r["n_links"], r["class_id"]) == (len(links[d]), root[d]) for d, r in found.items())


def test_suffix_tree_scores(spark):
    found = result(spark, "op7_suffix_tree_scores")
    tokens = {d: [*re.findall("[^\x20\x09-\x0D]+", (t or "").translate(fx.LOWER)), None] for d, t in fx.pairs(fx.table(spark, "documents"))}
    c = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in ws)
    total, different = sum(c.values()), len(c)
    for d, ws in tokens.items():
        r = found[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (total + different + 1)) for w in ws))
        assert r["score"] < 0


def repeats(docs, length=50):
    """Expected (n_bytes, n_removed, n_spans, kept) of each row, rows with equal ids seen together."""
    seen, out = set(), []
    for key in sorted({d for d, _ in docs if d is not None}) + [None]:
        new = set()
        for text in [t for d, t in docs if d == key]:
            b = (text or "").encode()
            gone = bytearray(len(b))
            for p in range(len(b) - length + 1):
                if b[p : p + length] in seen:
                    gone[p : p + length] = b"\1" * length
                else:
                    new.add(b[p : p + length])
            spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
            kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
            out.append((key, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        seen |= new
    return out


def check_repeats(docs, rows):
    assert sorted(map(tuple, rows), key=repr) == sorted(repeats(docs), key=repr)


def test_repeated_passages(spark):
    check_repeats(fx.pairs(fx.table(spark, "documents")), QUERIES["op9_suffix_runs"](spark, oracle.SF_DIR).collect())
