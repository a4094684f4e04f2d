"""License scan by diagonal voting, in DataFrame functions alone.

Texts are lower-cased (A-Z) and cut into words of digits, letters and characters
beyond ASCII. Every rolling window of `GRAM` words (of two for phrases of two)
is hashed and joined to the positions of the templates; the words themselves are
compared in the join. A hit votes for the diagonal (place in the text minus place
in the template). Votes are summed by document, template and diagonal; diagonals
at most `DRIFT` apart whose hits are near each other are merged, as a word put in
or left out moves the rest to the next one. A merged span is a match if at least
`COVER` of the template's windows are hit and it is not much longer than the template.

The table of windows is a constant of this module (a few hundred rows) and is
broadcast. A document is one row of the scan, and every document sends one more
row that always joins, so a document without a hit keeps its place with one pass
over the texts. Hits of a document meet by document and template only after they
are reduced to diagonals, and nothing else is shuffled.

Null and empty texts have no words, hits or labels and score 0. Rows are told
apart by key and text hash; repeated rows come back as often as they were there.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GRAM = 3
DRIFT = 3
NEAR_WORDS = 12
COVER = 0.7
LONGER = 1.5

# Base phrases and their labels.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Opening or grant sentences of published licenses, and their labels.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("this work is licensed under a creative commons attribution", "cc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("no rights reserved this work is dedicated to the public domain", "public-domain"),
]

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN, _KRA = "K", "ĸ"  # the one letter beyond ASCII whose lower case is in ASCII, and one without
_DOC = -1


def words_of(text: Column) -> Column:
    """The words of a text. Lower case beyond A-Z moves no word's limits and equals no template's word."""
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit(_KRA)))
    return F.array_remove(F.split(lowered, _BREAKS), "")


def template_windows(spark: SparkSession, templates: list[tuple[str, str]], phrases: int) -> DataFrame:
    """gram (hash of two words), w1, w2, w3 (null for two words), template, pos; and the row every document joins."""
    rows: list[tuple] = [("", None, None, _DOC, 0)]
    for number, (text, _) in enumerate(templates):
        words = text.split(" ")
        size = min(GRAM, len(words))
        if number < phrases and len(words) > GRAM:
            raise ValueError(f"a base phrase has at most {GRAM} words")
        for pos in range(len(words) - size + 1):
            rows.append((words[pos], words[pos + 1], words[pos + 2] if size > 2 else None, number, pos))
    table = spark.createDataFrame(rows, "w1 string, w2 string, w3 string, template int, pos int")
    return table.withColumn("gram", F.xxhash64("w1", "w2"))


def license_hits(docs: DataFrame, key: str, text: str, windows: DataFrame) -> DataFrame:
    """doc_id, mark, n_words, template, pos, at: every window of a text that a template has, and one row for the text."""
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"),
        F.concat(words_of(F.col(text)), F.array(F.lit(""))).alias("words"),
    )
    each = rows.select("doc_id", "mark", "words", F.posexplode("words").alias("at", "word"))
    second, third = F.get("words", F.col("at") + 1), F.get("words", F.col("at") + 2)
    each = each.select(
        "doc_id", "mark", "at", "word", second.alias("second"), third.alias("third"),
        (F.size("words") - 1).alias("n_words"), F.xxhash64("word", second).alias("gram"),
    )
    matched = (
        (each["gram"] == windows["gram"])
        & (each["word"] == windows["w1"])
        & (each["second"].eqNullSafe(windows["w2"]))
        & (windows["w3"].isNull() | (each["third"] == windows["w3"]))
    )
    return each.join(F.broadcast(windows), matched).select("doc_id", "mark", "n_words", "template", "pos", "at")


def scan_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    templates: list[tuple[str, str]] | None = None, phrases: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every row.

    spans holds label, first and last word and cover of every match of a template.
    """
    base = PHRASES if phrases is None else phrases
    every = base + (TEMPLATES if templates is None else templates)
    spark = docs.sparkSession
    sizes = [max(1, len(t.split(" ")) - GRAM + 1) for t, _ in every]
    label = F.element_at(F.array(*[F.lit(x) for _, x in every]), F.col("template") + 1)
    windows = F.element_at(F.array(*map(F.lit, sizes)), F.col("template") + 1)
    row = ["doc_id", "mark"]
    votes = (
        license_hits(docs, key, text, template_windows(spark, every, len(base)))
        .groupBy(*row, "template", (F.col("at") - F.col("pos")).alias("diagonal"))
        .agg(
            F.count_distinct("pos").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high"),
            F.count(F.lit(1)).alias("rows"), F.max("n_words").alias("n_words"),
        )
    )
    along = W.partitionBy(*row, "template").orderBy("diagonal")
    apart = (
        (F.col("template") < len(base))
        | (F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT)
        | (F.col("low") - F.lag("high").over(along) > NEAR_WORDS)
        | (F.lag("low").over(along) - F.col("high") > NEAR_WORDS)
    )
    merged = (
        votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(along))
        .groupBy(*row, "template", "span")
        .agg(
            F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.max("rows").alias("rows"), F.max("n_words").alias("n_words"),
        )
    )
    cover = F.least(F.col("votes") / windows, F.lit(1.0))
    fits = (cover >= COVER) & (F.col("high") - F.col("low") + 1 <= windows * LONGER)
    is_doc, is_base = F.col("template") == _DOC, F.col("template").between(0, len(base) - 1)
    is_match = (F.col("template") >= len(base)) & fits
    last = F.least(F.col("high") + GRAM, F.col("n_words")) - 1
    out = merged.groupBy(*row).agg(
        F.max(F.when(is_doc, F.col("rows"))).alias("_rows"),
        F.max("n_words").cast("bigint").alias("n_words"),
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("low"))).cast("bigint").alias("first_word"),
        F.max(F.when(is_base, F.col("low"))).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, label))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base | is_match, label))), ",").alias("labels"),
        F.coalesce(F.max(F.when(is_base, 1.0).when(F.col("template") >= len(base), cover)), F.lit(0.0)).alias("score"),
        F.array_sort(
            F.collect_list(
                F.when(is_match, F.struct(F.col("low").alias("first"), last.alias("last"), label.alias("label"), cover.alias("cover")))
            )
        ).alias("spans"),
    )
    return out.withColumn("_rows", F.explode(F.sequence(F.lit(1).cast("bigint"), "_rows"))).drop("_rows", "mark")
