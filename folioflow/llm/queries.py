"""The registered queries of the operators, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import (
    chosen_path, containment, context_tree, cuckoo, curve_packing, filter_audit, importance, language, licenses, mixing, secret_scan, suffix_runs, warc,
)
from folioflow.session import configure, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.secret_spans(table(spark, sf_dir, "documents")))


WARC_SQL = r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
  CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""


@query("op5_warc_archive", WARC_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_dir(spark, "warc")
    warc.write_archive(pages, path)
    return warc.archived_pages(spark, path)


MIX_SQL = """
WITH RECURSIVE
d AS (SELECT doc_id, coalesce(source, '') AS source, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) - 1 AS n FROM documents),
g AS (SELECT source, CAST(floor(1000 * sqrt(count(*))) AS HUGEINT) AS weight, (count(*) + 15) // 16 AS blocks FROM d GROUP BY source),
w AS (SELECT source, greatest(weight, ((SELECT sum(weight) FROM g) + 9999) // 10000) AS weight, blocks FROM g),
l AS (SELECT list(weight ORDER BY source) AS a, list(source ORDER BY source) AS names, list(blocks ORDER BY source) AS blocks, sum(weight) AS q FROM w),
p AS (SELECT *, [list_sum(a[1:i]) FOR i IN range(1, len(a) + 1)] AS c, greatest(1000, (q + list_min(a) - 1) // list_min(a)) AS stretch,
  coalesce(list_reverse_sort([(blocks[i] * q + a[i] - 1) // a[i] FOR i IN range(1, len(a) + 1)])[2], 0) AS slots FROM l),
sim(t, done, pick) AS (
  SELECT CAST(-1 AS HUGEINT), [CAST(0 AS HUGEINT) FOR x IN a], CAST(0 AS BIGINT) FROM p
  UNION ALL
  SELECT t, [done[i] + CASE WHEN i = pick THEN 1 ELSE 0 END FOR i IN range(1, len(done) + 1)], pick FROM (
    SELECT t + 1 AS t, done, list_min([
      {'early': CASE WHEN done[i] * q // a[i] > t + 1 THEN 1 ELSE 0 END, 'deadline': ((done[i] + 1) * q + a[i] - 1) // a[i], 'i': i}
      FOR i IN range(1, len(a) + 1)
      IF done[i] < c[i] * (((t + 1) // stretch + 1) * stretch) // q - CASE WHEN i = 1 THEN 0 ELSE c[i - 1] * (((t + 1) // stretch + 1) * stretch) // q END]).i AS pick
    FROM sim, p WHERE t + 1 < slots)),
taken AS (SELECT names[pick] AS source, CAST(t AS BIGINT) AS slot, CAST(done[pick] - 1 AS BIGINT) AS block FROM sim, p WHERE t >= 0),
b AS (SELECT d.doc_id, d.source, d.n // 16 AS block, CAST(d.n // 16 * q // weight AS BIGINT) AS release,
  CAST(((d.n // 16 + 1) * q + weight - 1) // weight AS BIGINT) AS deadline, CAST(d.n % 16 AS INTEGER) AS seq
  FROM d JOIN w ON d.source = w.source, (SELECT sum(weight) AS q FROM w))
SELECT b.doc_id, b.source, b.block, release, deadline, coalesce(slot, deadline - 1) AS slot, seq
FROM b LEFT JOIN taken ON b.source = taken.source AND b.block = taken.block
"""


@query("op6_pfair_mix", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


CONTAINMENT_SQL = r"""
WITH lowered AS (
  SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS own, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL SELECT 'i', item_id, coalesce(text, ''), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT side, id, md5(own) AS own, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
g AS (SELECT DISTINCT side, id, own, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(2, len(w) - 3))]) AS g FROM w WHERE len(w) > 0),
n AS (SELECT id, own, count(*) AS n_item FROM g WHERE side = 'i' GROUP BY id, own),
held AS (SELECT d.id AS doc_id, i.id AS item_id, n.n_item, count(*) AS n_found, count(*) / n.n_item AS containment
  FROM g d JOIN g i ON d.g = i.g AND d.side = 'd' AND i.side = 'i' JOIN n ON n.id = i.id AND n.own = i.own
  GROUP BY d.id, d.own, i.id, i.own, n.n_item HAVING count(*) / n.n_item >= 0.8)
SELECT doc_id, item_id, n_item, n_found, containment FROM held
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY containment DESC, n_found DESC) = 1
"""


@query("op8_benchmark_containment", CONTAINMENT_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
k AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""


@query("op10_cuckoo_dedup", DEDUP_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.exact_dedup(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op7_suffix_tree_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.lm_scores(table(spark, sf_dir, "documents"))


@query("op4_chosen_path_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_join(table(spark, sf_dir, "documents"))


@query("op9_suffix_runs")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_runs.repeated_passages(table(spark, sf_dir, "documents"))


@query("op11_curve_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = curve_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
m AS (SELECT doc_id, part, CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS fails FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
cells AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, CAST(1 << (ascii(substr(filter_order, CAST(s AS BIGINT), 1)) - 65) AS INTEGER) AS bit,
    CAST(coalesce(list_sum([1 << (ascii(substr(filter_order, i, 1)) - 65) FOR i IN range(1, s)]), 0) AS INTEGER) AS before
  FROM orders, range(1, 6) r(s)),
every AS (SELECT *, fails & bit <> 0 AS failing, fails & before <> 0 AS gone FROM cells, steps),
sums AS (SELECT part, filter_order, step, bit,
    CAST(coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (failing AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (failing AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (fails = bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (failing AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (failing AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM every GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM sums
"""


@query("op12_filter_audit", AUDIT_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


RESAMPLE_SQL = r"""
WITH crc AS (SELECT list(list_reduce(list_concat([CAST(i AS UBIGINT)], [CAST(k AS UBIGINT) FOR k IN range(8)]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
texts AS (
  SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
  UNION ALL SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
numbered AS (SELECT *, row_number() OVER () AS row FROM texts),
words AS (SELECT side, row, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM numbered),
counted AS (SELECT side, row, word, count(*) AS n FROM words GROUP BY ALL),
hashed AS (SELECT word, xor(CAST(4294967295 AS UBIGINT), list_reduce(
      list_concat([CAST(4294967295 AS UBIGINT)], [CAST(('0x' || substr(x, 2 * i + 1, 2)) AS UBIGINT) FOR i IN range(length(x) // 2)]),
      lambda c, b: xor(t[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8))) % 10000 AS bucket
  FROM (SELECT DISTINCT word, hex(encode(word)) AS x FROM counted), crc),
buckets AS (SELECT bucket, CAST(coalesce(sum(n) FILTER (side = 'd'), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (side = 'b'), 0) AS DOUBLE) AS t
  FROM counted JOIN hashed USING (word) GROUP BY bucket),
every AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM buckets),
gains AS (SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain FROM buckets, every),
weights AS (SELECT row, sum(n) AS n_features, sum(n * gain) AS total FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
scores AS (SELECT id AS doc_id, row, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(floor(total / n_features), 0) AS BIGINT) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS gumbel
  FROM numbered LEFT JOIN weights USING (row) WHERE side = 'd'),
able AS (SELECT row, row_number() OVER (ORDER BY weight + gumbel DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, weight + gumbel AS score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scores LEFT JOIN able USING (row)
"""


@query("op13_importance_resample", RESAMPLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
