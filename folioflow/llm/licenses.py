"""License scan by diagonal voting.

Every rolling run of three words of a text is hashed and met with the positions of such
runs in the templates. A meeting at text position p and template position t votes for the
diagonal p - t. Votes are counted per diagonal, neighbouring diagonals (words put in or
left out) are merged to spans, and a span is verified by the part of the template's runs
that it holds word for word. Where a template begins again, a new span begins, so copies
that follow each other closely are verified one by one.

Three short phrases are the base; their places are diagonals on which every run of the
phrase votes. The method adds the labels of longer notices, also when they are changed a
little.

The templates are a fixed list. Their hashes are constants of the plan: runs that are in
no template are dropped where they arise, and only the others are joined with the
template positions, by their words and not by the hash alone.

Cases: a null text counts as empty and has no words. Rows are told apart by id and text,
so equal rows give equal results. Texts shorter than three words have no votes. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm.word_arrays import gram_hash, gram_text, lower_words, starts
from folioflow.session import materialize

RUN = 3
#: Part of a template's runs that a span must hold.
COVERED = 0.6
#: Words that may be put in or left out between merged diagonals.
DRIFT = 8

# Fixed phrases of the base, with their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Notices of public licenses, lower-case words. Fixed.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "apache-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution noncommercial", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution sharealike", "cc-by-sa"),
    ("this work is licensed under cc by nc", "cc-by-nc"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under the gnu general public license either version 3 or later", "gpl-3"),
    ("licensed under the gnu general public license either version 2 or later", "gpl-2"),
    ("gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gpl-3"),
    ("gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "gpl-2"),
    ("distributed under the boost software license version 1 0", "bsl-1"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "epl-2"),
]
# Headings of license texts. Fixed.
HEADINGS = [
    ("gnu general public license version 3 29 june 2007", "gpl-3"),
    ("gnu general public license version 2 june 1991", "gpl-2"),
    ("apache license version 2 0 january 2004", "apache-2"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("the mit license mit", "mit"),
    ("bsd 3 clause license", "bsd"),
    ("bsd 2 clause license", "bsd"),
    ("creative commons attribution 4 0 international", "cc-by"),
    ("creative commons attribution noncommercial 4 0 international", "cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international", "cc-by-sa"),
]
# Identifiers of the lines that begin with `SPDX-License-Identifier:`, as words. Fixed.
IDENTIFIERS = [
    ("mit", "mit"), ("apache 2 0", "apache-2"), ("gpl 3 0", "gpl-3"), ("gpl 2 0", "gpl-2"), ("lgpl 3 0", "lgpl"), ("lgpl 2 1", "lgpl"), ("agpl 3 0", "agpl"),
    ("bsd 3 clause", "bsd"), ("bsd 2 clause", "bsd"), ("mpl 2 0", "mpl-2"), ("isc", "isc"), ("unlicense", "unlicense"), ("cc by 4 0", "cc-by"), ("cc by nc 4 0", "cc-by-nc"),
    ("cc by sa 4 0", "cc-by-sa"), ("bsl 1 0", "bsl-1"), ("epl 2 0", "epl-2"),
]
NOTICES += HEADINGS + [(f"spdx license identifier {words}", label) for words, label in IDENTIFIERS]

# Words that tell a label's notices from those of its siblings: a span has to hold a run with one of them. Fixed.
TELLING = {
    "gpl-3": ["3"], "gpl-2": ["2"], "lgpl": ["lesser", "lgpl"], "agpl": ["affero", "agpl"], "cc-by-nc": ["noncommercial", "nc"], "cc-by-sa": ["sharealike", "sa"],
    "mpl-2": ["mozilla", "mpl"], "bsl-1": ["boost", "bsl"], "epl-2": ["eclipse", "epl"],
}


def template_runs(spark: SparkSession) -> DataFrame:
    """template, label, base, runs (how many), tpos, telling, hash, run (its words)."""
    every = [(text, label, True) for text, label in BASE] + [(text, label, False) for text, label in NOTICES]
    rows = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(t).alias("text"), F.lit(lab).alias("label"), F.lit(b).alias("base"), F.lit(" ".join(TELLING.get(lab, []))).alias("tell")) for i, (t, lab, b) in enumerate(every)))
    words = spark.range(1).select(F.explode(rows).alias("t")).select("t.*").withColumn("words", lower_words(F.col("text")))
    runs = words.withColumn("runs", F.size("words") - (RUN - 1)).withColumn("tpos", F.explode(starts(F.col("words"), RUN)))
    telling = (F.col("tell") == "") | F.arrays_overlap(F.split("tell", " "), F.slice("words", F.col("tpos") + 1, RUN))
    return runs.select("template", "label", "base", "runs", "tpos", telling.alias("telling"), gram_hash(F.col("words"), F.col("tpos"), RUN).alias("hash"), gram_text(F.col("words"), F.col("tpos"), RUN).alias("run"))


def voting_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash, n_words, hits (pos, run): the runs of words that are in a template."""
    spark = docs.sparkSession
    known = [r["hash"] for r in template_runs(spark).select("hash").distinct().collect()]  # some hundred, from the fixed list
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), lower_words(text).alias("words"))
    places = F.filter(starts(F.col("words"), RUN), lambda i: gram_hash(F.col("words"), i, RUN).isin(known))
    return rows.select("doc_id", "text_hash", F.size("words").cast("bigint").alias("n_words"),
                       F.transform(places, lambda i: F.struct(i.alias("pos"), gram_text(F.col("words"), i, RUN).alias("run"))).alias("hits"))


def diagonals(runs: DataFrame) -> DataFrame:
    """Votes: doc_id, text_hash, template, label, base, runs, diagonal, votes, first and last position."""
    templates = F.broadcast(template_runs(runs.sparkSession).drop("hash"))  # the fixed list
    hits = runs.filter(F.size("hits") > 0).select("doc_id", "text_hash", "hits").dropDuplicates(["doc_id", "text_hash"])
    votes = hits.select("doc_id", "text_hash", F.inline("hits")).join(templates, "run").withColumn("diagonal", F.col("pos") - F.col("tpos"))
    return votes.groupBy("doc_id", "text_hash", "template", "label", "base", "runs", "diagonal").agg(
        F.count("*").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("tpos").alias("held"), F.max("telling").alias("telling"))


def _verified(diags: DataFrame, *span: str) -> DataFrame:
    merged = diags.groupBy(*span).agg(
        F.min("first").alias("first_word"), (F.max("last") + RUN - 1).alias("last_word"), F.max("telling").alias("telling"),
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"))
    return merged.withColumn("covered", F.col("held") / F.col("runs")).filter(
        F.col("telling") & (F.col("covered") >= COVERED) & (F.col("last_word") - F.col("first_word") < 2 * (F.col("runs") + RUN + DRIFT)))


def license_spans(diags: DataFrame) -> DataFrame:
    """Spans of the templates: doc_id, text_hash, label, base, first_word, last_word (of the span), covered (0 to 1)."""
    key = ["doc_id", "text_hash", "template"]
    order = Window.partitionBy(*key).orderBy("first", "diagonal")
    far = (F.col("first") - F.lag("last").over(order) > DRIFT + RUN) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > DRIFT)
    again = far | (F.col("first") - F.col("diagonal") <= F.lag(F.col("last") - F.col("diagonal")).over(order))
    marked = diags.filter("not base").withColumn("span", F.sum(F.when(far, 1).otherwise(0)).over(order)).withColumn("pass", F.sum(F.when(again, 1).otherwise(0)).over(order))
    passes = _verified(marked, *key, "label", "base", "runs", "span", "pass")
    # an edited copy with stray runs among its own is held by the whole span only
    whole = _verified(marked, *key, "label", "base", "runs", "span")
    found = Window.partitionBy(*key, "span")
    whole = whole.withColumn("pass", F.lit(None).cast("bigint")).unionByName(passes).withColumn("passes", F.count("pass").over(found)).filter("pass is not null or passes = 0")
    # of templates that meet in a word of the text, the one that is held best
    best = F.max("covered").over(Window.partitionBy("doc_id", "text_hash", "word"))
    near = whole.withColumn("word", F.explode(F.sequence("first_word", "last_word"))).withColumn("best", best).groupBy(
        *key, "label", "base", "first_word", "last_word", "covered").agg(F.max("best").alias("best")).filter("covered = best")
    exact = diags.filter("base and votes = runs").select(
        *key, "label", "base", F.col("diagonal").alias("first_word"), (F.col("diagonal") + F.col("runs") + RUN - 2).alias("last_word"), F.lit(1.0).alias("covered"))
    return exact.unionByName(near.select(*exact.columns))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    runs = materialize(voting_runs(docs, id_col, text_col), "license-runs")
    base = F.col("base")
    found = license_spans(diagonals(runs)).groupBy("doc_id", "text_hash").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first_word"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("covered").alias("score"))
    rows = runs.select("doc_id", "text_hash", "n_words")
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_hash"] == found["text_hash"]), "left")
    return joined.select(
        rows["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
