"""License scan by diagonal voting, in DataFrame operations only.

Every run of three words of a text is joined by its hash to the places where it stands in the license templates, and the
words are compared. A hit votes for its diagonal, the word number in the text less that in the template: all words of
one copy of a template stand on one diagonal, and a copy with words added or left out on a few neighbouring ones. Votes
are added up by diagonal, diagonals at most NEIGHBOUR apart are merged, and a merged span is a find when it holds at
least COVERAGE of the template's runs within a length near the template's own.

The base phrases are templates too: a base place is a diagonal on which every run of the phrase voted.

The templates are opening lines and whole texts, a list of a few thousand runs at most, which bounds the broadcast; a
caller may name others, of any length. Votes of a diagonal are bitmaps, one row for each SLOT runs of the template. What a text gives is a function of the
text alone; hits are gathered by hashes of the row and attached again, so a text without hits costs no shuffle but one
short row.

Defined cases: null and empty texts have no words and no labels; equal rows get equal results, one each; a null doc_id
stays null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passageloom.llm.license_texts import WHOLE_TEXTS
from passageloom.operators.staging import stage

RUN_WORDS = 3
NEIGHBOUR = 2
COVERAGE = 0.6
SLOT = 32

# The base phrases with their labels, and the opening words of public license notices.
BASE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
NOTICES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License", "apache-2"),
    ("licensed under the GNU General Public License, version 3", "gpl-3"),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "gpl-3"),
    ("licensed under the GNU General Public License, version 2", "gpl-2"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("licensed under the GNU Affero General Public License, version 3", "agpl-3"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("licensed under the Creative Commons Attribution NonCommercial 4.0 International License", "cc-by-nc"),
    ("licensed under the Creative Commons Attribution ShareAlike 4.0 International License", "cc-by-sa"),
    ("licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("licensed under CC BY 4.0", "cc-by"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
]
ALL_NOTICES = [*NOTICES, *WHOLE_TEXTS]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


Templates = list[tuple[str, str]]


def template_runs(notices: Templates) -> list[tuple[int, str, bool, int, int, int, str, str, str]]:
    """template, label, base, its words, its runs, place of the run, the run's words."""
    rows = []
    for number, (phrase, label) in enumerate([*BASE_PHRASES, *notices]):
        found = [w for w in re.split(SEPARATORS, phrase.lower()) if w]
        runs = len(found) - RUN_WORDS + 1
        rows += [(number, label, number < len(BASE_PHRASES), len(found), runs, j, *found[j : j + RUN_WORDS]) for j in range(runs)]
    return rows


def template_table(spark: SparkSession, notices: Templates) -> DataFrame:
    schema = "template int, label string, base boolean, t_words int, t_runs int, j int, t0 string, t1 string, t2 string"
    place = {"slot": F.expr(f"j div {SLOT}"), "bit": F.expr(f"shiftleft(1L, j % {SLOT})")}
    return spark.createDataFrame(template_runs(notices), schema).withColumns({"h": F.xxhash64("t0", "t1", "t2"), **place})


def license_hits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: Templates = ALL_NOTICES) -> DataFrame:
    """k1, k2 (hashes of the row), the template's columns, i and j of every run that stands in a template."""
    tokens = docs.select(F.xxhash64(doc_id, text).alias("k1"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("k2"), words(F.col(text)).alias("w"))
    n = F.greatest(F.size("w"), F.lit(1))
    runs = F.arrays_zip(F.col("w").alias("w0"), F.slice("w", 2, n).alias("w1"), F.slice("w", 3, n).alias("w2"))
    # The outer kind: for the plain kind the optimizer would split the text once more to filter empty arrays.
    every = tokens.select("k1", "k2", F.posexplode_outer(runs).alias("i", "run")).select("k1", "k2", "i", "run.w0", "run.w1", "run.w2")
    templates = template_table(docs.sparkSession, notices)
    same = (F.xxhash64("w0", "w1", "w2") == F.col("h")) & (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))
    return every.where("w2 IS NOT NULL").join(F.broadcast(templates), same).drop("w0", "w1", "w2", "t0", "t1", "t2", "h")


def license_spans(hits: DataFrame) -> DataFrame:
    """k1, k2, label, base, first and last word, coverage of every base place and every verified span."""
    key = ["k1", "k2", "template", "label", "base", "t_words", "t_runs"]
    by_diagonal = hits.groupBy(*key, (F.col("i") - F.col("j")).alias("d"), "slot").agg(
        F.min("i").alias("first"), F.max("i").alias("last"), F.bit_or("bit").alias("runs")
    )
    # Both kinds are read from the votes, which are few; the texts are taken apart once for them.
    by_diagonal = stage(by_diagonal, "diagonals")
    ends = [F.min("first").alias("first"), F.max("last").alias("last")]
    votes = F.sum(F.bit_count("runs")).alias("votes")
    exact = by_diagonal.where("base").groupBy(*key, "d").agg(*ends, votes).where("votes = t_runs")
    exact = exact.select("k1", "k2", "label", "base", "first", "last", F.lit(1.0).alias("coverage"))
    # The slots of one diagonal are ties in this order, and no distance apart.
    along = Window.partitionBy(*key).orderBy("d")
    apart = F.coalesce((F.col("d") - F.lag("d").over(along) > NEIGHBOUR).cast("int"), F.lit(0))
    merged = (
        by_diagonal.where("NOT base")
        .withColumn("apart", apart)
        .withColumn("group", F.sum("apart").over(along))
        .groupBy(*key, "group", "slot")
        .agg(*ends, F.bit_or("runs").alias("runs"))
        .groupBy(*key, "group")
        .agg(*ends, votes)
        .withColumn("coverage", F.col("votes") / F.col("t_runs"))
        .where((F.col("coverage") >= COVERAGE) & (2 * (F.col("last") - F.col("first") + RUN_WORDS) <= 3 * F.col("t_words")))
    )
    # Related licenses share wording: of spans that overlap, those with the most runs stay.
    row = Window.partitionBy("k1", "k2")
    until = F.max("last").over(row.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    place = F.sum("new").over(row.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0))
    spans = (
        merged.withColumn("new", F.coalesce((F.col("first") >= until + RUN_WORDS).cast("int"), F.lit(0)))
        .withColumn("place", place)
        .withColumn("most", F.max("votes").over(Window.partitionBy("k1", "k2", "place")))
        .where("votes = most")
    )
    return exact.unionByName(spans.select("k1", "k2", "label", "base", "first", "last", "coverage"))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: Templates = ALL_NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``score`` is the largest share of a template's runs that stands in the text, of those that were found. ``notices`` are
    (text, label) templates beside the base phrases.
    """
    found = license_spans(license_hits(docs, doc_id, text, notices))
    base = F.when(F.col("base"), F.col("label"))
    by_row = found.groupBy("k1", "k2").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.size(words(F.col(text))).cast("long").alias("n_words"),
        F.xxhash64(doc_id, text).alias("k1"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("k2"),
    )
    return rows.join(by_row, ["k1", "k2"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _values() -> str:
    def quoted(x) -> str:
        return f"'{x}'" if isinstance(x, str) else str(x)

    return ", ".join(f"({', '.join(map(quoted, row))})" for row in template_runs(ALL_NOTICES))


OP3_SQL = rf"""
WITH templates(template, label, base, t_words, t_runs, j, t0, t1, t2) AS (VALUES {_values()}),
doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS}'), lambda w: w <> '') AS w
  FROM documents
), runs AS (
  SELECT doc_id, i - 1 AS i, w[i] AS t0, w[i + 1] AS t1, w[i + 2] AS t2
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc_words)
), by_diagonal AS (
  SELECT doc_id, template, label, base, t_words, t_runs, i - j AS d, j // {SLOT} AS slot, min(i) AS first, max(i) AS last, bit_or(CAST(1 AS BIGINT) << (j % {SLOT})) AS runs
  FROM runs JOIN templates USING (t0, t1, t2) GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, template ORDER BY d) > {NEIGHBOUR} THEN 1 ELSE 0 END AS apart
  FROM by_diagonal WHERE NOT base
), islands AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY d) AS island FROM marked
), slots AS (
  SELECT doc_id, template, label, base, t_words, t_runs, island, min(first) AS first, max(last) AS last, bit_count(bit_or(runs)) AS votes
  FROM islands GROUP BY doc_id, template, label, base, t_words, t_runs, island, slot
), merged AS (
  SELECT doc_id, label, base, t_words, min(first) AS first, max(last) AS last, sum(votes) AS votes, sum(votes) / t_runs AS coverage
  FROM slots GROUP BY doc_id, template, label, base, t_words, t_runs, island
), spans AS (
  SELECT *, max(last) OVER (PARTITION BY doc_id ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until
  FROM merged WHERE coverage >= {COVERAGE} AND 2 * (last - first + {RUN_WORDS}) <= 3 * t_words
), places AS (
  SELECT *, sum(CASE WHEN first >= until + {RUN_WORDS} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY first, last ROWS UNBOUNDED PRECEDING) AS place
  FROM spans
), best AS (
  SELECT *, max(votes) OVER (PARTITION BY doc_id, place) AS most FROM places
), found AS (
  SELECT doc_id, label, base, min(first) AS first, CAST(1.0 AS DOUBLE) AS coverage FROM by_diagonal WHERE base
  GROUP BY doc_id, template, label, base, t_runs, d HAVING sum(bit_count(runs)) = t_runs
  UNION ALL
  SELECT doc_id, label, base, first, coverage FROM best WHERE votes = most
), by_row AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
  FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, CAST(0.0 AS DOUBLE)) AS score
FROM doc_words LEFT JOIN by_row USING (doc_id)
"""
