"""License scan by diagonal voting.

Templates and documents are cut into rolling runs of three words. Spark joins every run of every document to the
places of the same run in the templates; each meeting votes for a diagonal, the document place minus the template
place. A phrase stands where one diagonal has all votes of its template. For longer templates neighbouring
diagonals are merged, which allows for a few words put in or left out, and a span counts when enough of the
template is covered by a stretch of about the template's length.

Runs meet by hash and are then compared as text, so a vote is never due to a collision.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentia.llm.common import ascii_lower

RUN = 3  # words; the shortest phrase has as many
# The same words as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ finds once A-Z are lower case.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # counts where its words stand consecutively


# Base phrases and the usual wording of license notices.
TEMPLATES = (
    Template("mit", "the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template("apache-2", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    Template("gpl-3", "licensed under the GNU General Public License, version 3"),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation",
    ),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
)


@dataclass(frozen=True)
class ScanSettings:
    neighbour: int = 4  # diagonals at most so far apart are merged
    coverage: float = 0.6  # of a template's runs
    stretch: float = 1.5  # the span's words at most, times the template's


def _runs(words: Column) -> Column:
    starts = F.when(F.size(words) >= RUN, F.sequence(F.lit(0), F.size(words) - RUN)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(RUN)]))


def _template_runs(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.label).alias("label"), F.lit(t.phrase).alias("phrase"), F.lit(t.text).alias("text")) for i, t in enumerate(templates)])
    listed = spark.range(1).select(F.explode(rows).alias("t")).select("t.*")
    listed = listed.withColumn("words", F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0)))
    runs = listed.select("template", "label", "phrase", (F.size("words") - RUN + 1).alias("runs"), F.posexplode(_runs(F.col("words"))).alias("at", "template_run"))
    return runs.withColumn("run_hash", F.xxhash64("template_run"))


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    settings: ScanSettings = ScanSettings(),
) -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places of the phrases, overlapping ones included; ``first_word`` and ``last_word`` are their
    smallest and largest start, null without a place. ``labels`` adds those of verified spans; labels are distinct,
    sorted and joined by commas, the empty text if there are none. ``score`` is the best coverage of a verified span
    or phrase, 0 without. Null and empty texts have no words; texts of any length are scanned whole; rows that repeat key
    and text each get their row; an empty table gives an empty result. Columns other than key and text are not read, whatever their names.
    """
    words = docs.select(
        F.col(key).alias("_key"),
        F.xxhash64(F.col(text)).alias("_text"),
        F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)).alias("_words"),
    )
    # The null at the end of each list stands for the document itself, so that one pass serves votes and counts.
    listed = F.concat(_runs(F.col("_words")), F.array(F.lit(None).cast("string")))
    runs = words.select("_key", "_text", F.size("_words").cast("bigint").alias("n_words"), F.posexplode(listed).alias("place", "run"))
    known = F.broadcast(_template_runs(docs.sparkSession, templates))  # a few hundred rows, given by the settings
    same = (F.xxhash64(F.lower("run")) == F.col("run_hash")) & (ascii_lower(F.col("run")) == F.col("template_run"))
    votes = runs.join(known, same, "left").where(F.col("run").isNull() | F.col("template").isNotNull())
    votes = votes.repartition("_key", "_text")

    document = ["_key", "_text", "n_words"]
    template = ["template", "label", "phrase", "runs"]
    diagonals = votes.groupBy(*document, *template, (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"),
        F.collect_set("at").alias("covered"),
        F.min("place").alias("low"),
        F.max("place").alias("high"),
    )
    in_order = Window.partitionBy(*document, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(in_order)
    # A phrase's diagonals stay apart; its votes must all lie on one.
    new = F.when(F.col("phrase") | gap.isNull() | (gap > settings.neighbour), 1).otherwise(0)
    merged = diagonals.withColumn("_new", new).withColumn("span", F.sum("_new").over(in_order))
    spans = merged.groupBy(*document, *template, "span").agg(
        F.sum("votes").alias("votes"),
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("covered"),
        F.min("diagonal").alias("start"),
        (F.max("high") - F.min("low") + RUN).alias("length"),
    )
    share = F.col("covered") / F.col("runs")
    whole = F.col("phrase") & (F.col("covered") == F.col("runs"))
    fits = (share >= settings.coverage) & (F.col("length") <= settings.stretch * (F.col("runs") + RUN - 1))
    found = whole | (~F.col("phrase") & fits)
    result = spans.groupBy(*document).agg(
        F.max(F.when(F.col("template").isNull(), F.col("votes"))).alias("_rows"),
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(whole, F.col("start"))).cast("bigint").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(whole, F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(found, F.col("label"))))).alias("labels"),
        F.coalesce(F.max(F.when(found, share)), F.lit(0.0)).alias("score"),
    )
    result = result.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rows"))))
    return result.select(F.col("_key").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
