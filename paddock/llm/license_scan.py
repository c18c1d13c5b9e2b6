"""License texts in documents, by diagonal voting.

Every pair of consecutive words of a document is hashed and joined to the pairs of the templates. A hit votes for a
diagonal: the position in the document less that in the template. A template that stands unchanged in a document gives
all its votes to one diagonal; inserted or lost words move the votes to neighbouring diagonals, which are merged. A
merged span that has enough of the template's pairs is a finding. Hits are verified by their words, so
a full diagonal of a phrase is exactly a place where its words stand consecutively.

Only DataFrame functions are used. The templates are a small table of fixed size, the only one that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from paddock.llm.common import text_or_empty

# Phrases whose places are counted, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Sentences from public license texts, as words, with their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license you may obtain a copy of the license at", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "gpl"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution", "cc"),
)
NEIGHBOURS = 4  # diagonals at most this far apart are merged
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_rows(phrases=PHRASES, templates=TEMPLATES) -> list[tuple]:
    """(template, label, is_phrase, size, at, first word, second word) of every pair of words of every template."""
    rows = []
    for number, (text, label, phrase) in enumerate([(*p, True) for p in phrases] + [(*t, False) for t in templates]):
        words = text.split()
        if not 2 <= len(words) <= 64:
            raise ValueError("a template has from 2 to 64 words")
        rows += [(number, label, phrase, len(words), at, a, b) for at, (a, b) in enumerate(zip(words, words[1:]))]
    return rows


def _table(spark: SparkSession, phrases, templates) -> DataFrame:
    rows = spark.createDataFrame(
        template_rows(phrases, templates),
        "template int, label string, phrase boolean, size int, item_at int, w1 string, w2 string")
    return F.broadcast(rows.withColumn("hash", F.xxhash64("w1", "w2")))


def license_spans(
    docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, coverage: float = 0.6,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Findings of every whole text.

    One row per input row, repeated rows included: the id, n_words, n_base (places where the words of a phrase stand
    consecutively), first_word and last_word (their smallest and largest start, from 0), base_labels, labels (of phrases
    and of templates with at least `coverage` of their pairs; distinct, sorted, comma-joined), score (the largest
    coverage, 0 without a finding) and spans (label, first_word, end_word, coverage of each finding, by place). Words are
    runs of digits, letters and characters beyond ASCII, A-Z in lower case. A null text has no words.
    """
    words = F.filter(F.split(F.translate(text_or_empty(text_column), UPPER, LOWER), SEPARATORS), lambda w: w != "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("id"), words.alias("words"))
    # A last pair without a hash stands for the document itself, so that documents without hits stay. Each pair brings its own
    # words: a row that carried the document's words would cost their number for every pair.
    pairs = F.expr("""concat(transform(words, (w, i) -> named_struct('hash', xxhash64(w, get(words, i + 1)), 'a', w, 'b', get(words, i + 1))),
        array(named_struct('hash', CAST(NULL AS BIGINT), 'a', CAST(NULL AS STRING), 'b', CAST(NULL AS STRING))))""")
    rows = rows.select("row", "id", F.size("words").cast("long").alias("n_words"), pairs.alias("pairs"))
    rows = rows.select("row", "id", "n_words", F.posexplode("pairs").alias("at", "pair"))
    rows = rows.select("row", "id", "n_words", "at", "pair.hash", "pair.a", "pair.b")
    hits = rows.join(_table(docs.sparkSession, phrases, templates), "hash", "left").where("hash IS NULL OR (w1 = a AND w2 = b)")
    hits = hits.select("row", "id", "n_words", "template", "label", "phrase", "size", "item_at", "at",
                       (F.col("at") - F.col("item_at")).alias("diagonal")).repartition("row")
    diagonals = hits.groupBy("row", "id", "n_words", "template", "label", "phrase", "size", "diagonal").agg(
        F.expr("bit_or(shiftleft(1L, item_at))").alias("found"), F.min("at").alias("low"), F.max("at").alias("high"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    near = F.col("diagonal") - F.lag("diagonal").over(order) <= F.when(F.col("phrase"), 0).otherwise(NEIGHBOURS)
    diagonals = diagonals.withColumn("starts", F.when(near, 0).otherwise(1))
    diagonals = diagonals.withColumn("span", F.sum("starts").over(order))
    spans = diagonals.groupBy("row", "id", "n_words", "template", "label", "phrase", "size", "span").agg(
        (F.expr("bit_count(bit_or(found))") / (F.col("size") - 1)).alias("coverage"),
        F.min("low").cast("long").alias("first_word"), (F.max("high") + 2).cast("long").alias("end_word"))
    place = F.col("phrase") & (F.col("coverage") == 1)
    good = place | (~F.col("phrase") & (F.col("coverage") >= coverage))
    span = F.when(good, F.struct("first_word", "end_word", "label", "coverage"))
    found = spans.groupBy("row", "id", "n_words").agg(
        F.count(F.when(place, 1)).alias("n_base"), F.min(F.when(place, F.col("first_word"))).alias("first_word"),
        F.max(F.when(place, F.col("first_word"))).alias("last_word"),
        F.array_sort(F.collect_set(F.when(place, F.col("label")))).alias("base"),
        F.array_sort(F.collect_set(F.when(good, F.col("label")))).alias("all"),
        F.coalesce(F.max(F.when(good, F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(span)).alias("spans"))
    return found.select(
        F.col("id").alias(id_column), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join("all", ",").alias("labels"), "score", "spans")


def oracle(phrases=PHRASES, templates=TEMPLATES, coverage: float = 0.6) -> str:
    """The same in SQL, for `doc_id` and `text` of `documents` (without spans)."""
    values = ", ".join(f"({n}, '{label}', {str(p).lower()}, {size}, {at}, '{a}', '{b}')"
                       for n, label, p, size, at, a, b in template_rows(phrases, templates))
    return f"""WITH t(template, label, phrase, size, item_at, w1, w2) AS (VALUES {values}),
d AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS}'), lambda w: w <> '') AS words
  FROM documents),
w AS (SELECT row, unnest(words) AS w1, generate_subscripts(words, 1) - 1 AS pos FROM d),
p AS (SELECT a.row, a.pos, a.w1, b.w1 AS w2 FROM w a JOIN w b ON a.row = b.row AND b.pos = a.pos + 1),
g AS (
  SELECT row, template, label, phrase, size, pos - item_at AS diagonal, bit_or(1::BIGINT << item_at) AS found,
    min(pos) AS low, max(pos) AS high
  FROM p JOIN t USING (w1, w2) GROUP BY ALL),
n AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal)
      <= CASE WHEN phrase THEN 0 ELSE {NEIGHBOURS} END THEN 0 ELSE 1 END AS starts
  FROM g),
m AS (SELECT *, sum(starts) OVER (PARTITION BY row, template ORDER BY diagonal) AS span FROM n),
s AS (
  SELECT row, label, phrase, bit_count(bit_or(found)) / (size - 1) AS coverage, min(low) AS first_word
  FROM m GROUP BY row, template, label, phrase, size, span),
f AS (
  SELECT *, phrase AND coverage = 1 AS place, (phrase AND coverage = 1) OR (NOT phrase AND coverage >= {coverage}) AS good
  FROM s)
SELECT d.doc_id, CAST(len(any_value(d.words)) AS BIGINT) AS n_words, count(*) FILTER (WHERE place) AS n_base,
  CAST(min(first_word) FILTER (WHERE place) AS BIGINT) AS first_word,
  CAST(max(first_word) FILTER (WHERE place) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE place), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE good), '') AS labels,
  CAST(coalesce(max(coverage) FILTER (WHERE good), 0) AS DOUBLE) AS score
FROM d LEFT JOIN f ON d.row = f.row GROUP BY d.row, d.doc_id"""
