"""License scans by diagonal voting, DataFrame functions only (operator 11).

Every run of k words of every text, as a hash, meets the places of equal runs in templates (a join); a hit is checked word
by word. Place in the text less place in the template is the hit's diagonal: a passage that follows a template puts all its
hits on one, a word put in or left out moves the rest to a neighbour. Hits are counted by (text, template, diagonal), the
neighbouring diagonals of incomplete ones are merged, and a merged span stands if the template's words that it holds, and
its own length, fit the template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barque.llm.sqlwords import NO_LETTER, lower_az, split_words

K = 3
#: Least share of a span (words of the template in it, by the longer of both), and how far diagonals may lie apart.
SHARE, APART = 0.8, 3
#: Runs of all templates that a broadcast takes; more of them are joined by shuffles.
BROADCAST_RUNS = 100_000
_MARK = 0x6D61726B  # stands before each text's runs


@dataclass(frozen=True)
class Template:
    """A phrase of words in lower case, and the label that it speaks for. base: only the whole phrase counts."""

    label: str
    words: str
    base: bool = False


#: The phrases that the base columns count.
BASE = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)
#: Common license notices.
NOTICES = (
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    Template("apache-2", "licensed under the apache license version 2 0"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("reserved", "all rights reserved"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE + NOTICES
SPANS = "array<struct<start:int,end:int,label:string,share:double>>"


def _run_hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def template_runs(spark, templates: tuple[Template, ...], k: int) -> DataFrame:
    """template, label, base, size, place and run of every run of k words, its hash h; and one row for the marks."""
    if short := [t.words for t in templates if len(t.words.split()) < k]:
        raise ValueError(f"templates of fewer than {k} words: {short}")
    rows = [(i, t.label, t.base, len(t.words.split()), p, t.words.split()[p : p + k]) for i, t in enumerate(templates) for p in range(len(t.words.split()) - k + 1)]
    runs = spark.createDataFrame(rows, "template int, label string, base boolean, size int, place int, run array<string>")
    hashes = _run_hash([F.xxhash64(F.get("run", F.lit(j))) for j in range(k)])
    mark = spark.sql(f"SELECT -1 AS template, CAST(NULL AS string) AS label, false AS base, 1 AS size, 0 AS place, CAST(NULL AS array<string>) AS run, CAST({_MARK} AS bigint) AS h")
    return runs.withColumn("h", hashes).unionByName(mark)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, base_starts (array of word places, sorted), base_labels, labels, score and spans of every row.

    Words are runs of ASCII letters (A-Z in lower case), digits and characters beyond ASCII. spans: start and end in words,
    label, and the template's words in it as a share of the longer of both. score: the largest share, 1 for a base phrase, 0 without a span. A null
    or empty text has no words; a null id stays null; repeated rows give repeated rows; a word that stands many times makes
    as many hits; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), split_words(lower_az(text), NO_LETTER).alias("words"))
    rows = rows.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    run = F.transform("hashes", lambda h, i: _run_hash([h, *(F.get("hashes", i + j) for j in range(1, k))]))
    name = ["doc_id", "k1", "k2"]
    runs = rows.select(*name, "words", F.posexplode(F.concat(F.array(F.lit(_MARK).cast("long")), run)).alias("at", "h"))

    of_templates = template_runs(spark, templates, k)
    if sum(len(t.words.split()) for t in templates) <= BROADCAST_RUNS:
        of_templates = F.broadcast(of_templates)
    mark = F.col("template") == -1
    same = (mark & (F.col("at") == 0)) | (~mark & (F.col("at") > 0) & (F.slice("words", F.greatest("at", F.lit(1)), F.lit(k)) == F.col("run")))
    hits = runs.join(of_templates, "h").filter(same).select(*name, "template", "label", "base", "size", "place", F.when(mark, F.size("words")).otherwise(F.col("at") - 1 - F.col("place")).alias("diagonal"))

    # one row for each diagonal; marks count the repeated rows
    votes = hits.groupBy(*name, "template", "label", "base", "size", "diagonal").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("place")).alias("places"))
    whole = F.size("places") == F.col("size") - k + 1
    counted = ~mark & (~F.col("base") | whole)  # of a base phrase nothing less than all counts
    votes = votes.withColumn("whole", whole).filter(mark | counted)
    # neighbours among what is incomplete: a diagonal begins a new span where the last one lies too far back
    down = Window.partitionBy(*name, "template", "whole").orderBy("diagonal")
    first = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(down) > APART, F.lit(True)) | F.col("whole") | mark
    votes = votes.withColumn("first", first.cast("int")).withColumn("span", F.sum("first").over(down))
    covered = F.size(F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("places")), lambda p: F.sequence(p, p + k - 1)))))
    spans = votes.groupBy(*name, "template", "label", "base", "size", "whole", "span").agg(
        F.max("n").alias("n"),
        F.min("diagonal").alias("diagonal"),
        F.min(F.col("diagonal") + F.get("places", F.lit(0))).cast("int").alias("start"),
        F.max(F.col("diagonal") + F.element_at("places", -1) + k).cast("int").alias("end"),
        covered.alias("covered"),
    )
    share = F.col("covered") / F.greatest("size", F.col("end") - F.col("start"))
    spans = spans.withColumn("share", share).filter(mark | (F.col("share") >= SHARE))

    is_base = ~mark & F.col("base")
    found = F.struct("start", "end", "label", "share")
    out = spans.groupBy(*name).agg(
        F.max(F.when(mark, F.col("n"))).alias("n_rows"),
        F.max(F.when(mark, F.col("diagonal"))).cast("long").alias("n_words"),
        F.array_sort(F.collect_list(F.when(is_base, F.col("start")))).alias("base_starts"),
        F.array_sort(F.collect_set(F.when(is_base, F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.coalesce(F.max(F.when(~mark, F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(~mark, found))).alias("spans"),
    )
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows")))
    return out.select("doc_id", "n_words", "base_starts", "base_labels", "labels", "score", "spans", again.alias("again")).drop("again")


def op11_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    starts = F.col("base_starts")
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
