"""License scans: phrases, and an exact set-similarity join of text blocks with license notices.

Blocks are lines, and windows of ``WINDOW`` words every ``WINDOW // 2`` words. A
notice is found in a block that contains at least its threshold's share of the
notice's distinct words. The join is exact and never compares all pairs:

- words are ordered by how many documents have them, rarest first; only the
  notices' words are counted, so the order is a list of bounded length;
- a block that reaches the threshold has a word in the notice's prefix, its
  rarest words; blocks and prefixes are joined on that word;
- length filter: a block with fewer of the notices' words than needed is out;
- positional filter: so is one whose first common word leaves too few words
  behind it, in the block or in the notice;
- the pairs that are left are counted out.

Built-in functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import UPPER, stored

WINDOW = 200
# What separates words.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases to be found and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
LINE, PASSAGE = "line", "passage"


@dataclass(frozen=True)
class Notice:
    label: str
    scope: str
    threshold: float
    text: str

    @property
    def words(self) -> list[str]:
        return sorted({w for w in "".join(c if c.isalnum() else " " for c in self.text.lower()).split()})

    @property
    def need(self) -> int:
        return math.ceil(self.threshold * len(self.words) - 1e-9)


# Public license notices. A line must have all words, a passage four fifths.
NOTICES = (
    Notice("all-rights-reserved", LINE, 1.0, "all rights reserved"),
    Notice("apache-2.0", LINE, 1.0, "licensed under the apache license version 2 0"),
    Notice("bsd", LINE, 1.0, "licensed under the bsd license"),
    Notice("cc-by-nc", LINE, 1.0, "licensed under cc by nc"),
    Notice("cc-by-nd", LINE, 1.0, "licensed under cc by nd"),
    Notice("cc-by-sa", LINE, 1.0, "licensed under cc by sa"),
    Notice("cc0", LINE, 1.0, "cc0 public domain dedication"),
    Notice("gpl-2.0", LINE, 1.0, "licensed under the gnu general public license version 2"),
    Notice("gpl-3.0", LINE, 1.0, "licensed under the gnu general public license version 3"),
    Notice("lgpl", LINE, 1.0, "gnu lesser general public license"),
    Notice("agpl", LINE, 1.0, "gnu affero general public license"),
    Notice("mit", LINE, 1.0, "released under the mit license"),
    Notice("mpl-2.0", LINE, 1.0, "mozilla public license version 2 0"),
    Notice(
        "mit",
        PASSAGE,
        0.8,
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    Notice(
        "apache-2.0",
        PASSAGE,
        0.8,
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at. Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    Notice(
        "bsd",
        PASSAGE,
        0.8,
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice",
    ),
    Notice(
        "gpl",
        PASSAGE,
        0.8,
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    Notice(
        "isc",
        PASSAGE,
        0.8,
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    Notice(
        "cc-by",
        PASSAGE,
        0.8,
        "This work is licensed under a Creative Commons Attribution International License. You are free to share, copy and redistribute the "
        "material in any medium or format, and adapt, remix, transform, and build upon the material, as long as you give appropriate credit.",
    ),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATOR), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def phrase_places(words: Column) -> Column:
    """Start and label of every place of a phrase."""

    def starts(phrase: str, label: str) -> Column:
        first, *rest = phrase.split()

        def here(i: Column) -> Column:
            hit = F.get(words, i) == first
            for k, word in enumerate(rest, 1):
                hit = hit & (F.get(words, i + k) == word)
            return F.coalesce(hit, F.lit(False))

        places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), here)
        return F.transform(places, lambda i: F.struct(i.alias("place"), F.lit(label).alias("label")))

    return F.concat(*[starts(p, label) for p, label in PHRASES.items()])


def word_order(words: DataFrame, notices: tuple[Notice, ...]) -> list[str]:
    """The notices' words by the number of rows (``words``: arrays) that have them, rarest first; ties by the word."""
    vocabulary = sorted({w for n in notices for w in n.words})
    counted = words.select(F.explode(F.array_intersect(strings(vocabulary), F.col("words"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    df = {r.word: r.n for r in counted.collect()}  # the notices' words at most
    return sorted(vocabulary, key=lambda w: (df.get(w, 0), w))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score`` of every row.

    Phrases are found where their words follow each other; labels are distinct,
    sorted and joined by commas, an empty text without any. ``score`` is 1 with a
    phrase, else the largest share of a notice that is found, else 0. A null text
    counts as empty. Rows with a repeated or null key are scanned each. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), value.alias("text")).withColumn("lower", F.lower("text")).withColumn("words", words_of(F.col("lower")))
    order = word_order(rows, notices)
    rank = {w: k for k, w in enumerate(order)}
    ranked = [sorted(n.words, key=rank.__getitem__) for n in notices]
    prefixes = [(w, number, place) for number, (n, words) in enumerate(zip(notices, ranked, strict=True)) for place, w in enumerate(words[: len(words) - n.need + 1])]
    prefix_words = sorted({w for w, _, _ in prefixes}, key=rank.__getitem__)

    has = lambda w: F.array_contains("words", w)
    phrase_possible = F.lit(False)
    for phrase in PHRASES:
        both = F.lit(True)
        for w in phrase.split():
            both = both & has(w)
        phrase_possible = phrase_possible | both
    # a column of its own: inside a function over the words it would be split anew for each word
    rows = rows.withColumn("phrase", phrase_possible).withColumn("ascii", F.when(F.col("phrase"), words_of(ascii_lower(F.col("text")))))
    places = F.when(F.col("phrase"), phrase_places(F.col("ascii"))).otherwise(F.array().cast("array<struct<place:int,label:string>>"))
    known = lambda words: F.array_intersect(strings(order), words)  # noqa: E731  in the global order
    block = lambda scope: lambda words: F.struct(F.lit(scope).alias("scope"), known(words).alias("known"))
    lines = F.transform(F.split("lower", "\n"), lambda line: block(LINE)(words_of(line)))
    begins = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(WINDOW // 2))
    windows = F.transform(begins, lambda i: block(PASSAGE)(F.slice("words", i + 1, WINDOW)))
    possible = F.arrays_overlap("words", strings(prefix_words))
    scanned = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.size("words").cast("long").alias("n_words"),
        places.alias("places"),
        F.when(possible, F.filter(F.concat(lines, windows), lambda b: F.arrays_overlap(b.known, strings(prefix_words)))).alias("blocks"),
    )
    digest = stored(scanned, "licenses")

    table = spark.createDataFrame([(n.scope, w, number, place, n.label, n.need, ranked[number]) for w, number, place in prefixes for n in [notices[number]]], "scope string, word string, notice int, place int, label string, need int, notice_words array<string>")
    blocks = digest.filter("blocks IS NOT NULL").select("row", F.posexplode("blocks").alias("number", "b")).select("row", "number", "b.scope", "b.known")
    probes = blocks.select("row", "number", "scope", "known", F.explode(F.array_intersect("known", strings(prefix_words))).alias("word"))
    pairs = (
        probes.join(table, ["scope", "word"])
        .filter(F.size("known") >= F.col("need"))
        .groupBy("row", "number", "notice")
        # the first common word in the global order
        .agg(F.min("place").alias("place"), *[F.first(c).alias(c) for c in ("known", "label", "need", "notice_words")])
        .filter(F.size("notice_words") - F.col("place") >= F.col("need"))
        .filter(F.size("known") - F.array_position("known", F.element_at("notice_words", F.col("place") + 1)) + 1 >= F.col("need"))
    )
    shared = F.size(F.array_intersect("known", "notice_words"))
    found = pairs.withColumn("shared", shared).filter("shared >= need").groupBy("row").agg(F.collect_set("label").alias("more"), F.max(F.col("shared") / F.size("notice_words")).alias("share"))

    base = F.col("places.label")
    return digest.join(found, "row", "left").select(
        F.col("id").alias(key),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.place").cast("long").alias("first_word"),
        F.array_max("places.place").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def scan_sql() -> str:
    """The same for DuckDB, over ``documents``."""
    quoted = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
    separator = SEPARATOR.replace("'", "''")
    split = lambda text: f"list_filter(regexp_split_to_array({text}, '{separator}'), lambda x: x <> '')"

    def place(phrase: str, label: str) -> str:
        test = " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        return f"list_transform(list_filter(range(len(ws)), lambda i: {test}), lambda i: {{'place': i, 'label': '{label}'}})"

    phrases = " || ".join(place(p, label) for p, label in PHRASES.items())
    notices = ", ".join(f"('{n.scope}', '{n.label}', {n.need}, {quoted(n.words)})" for n in NOTICES)
    return f"""
        WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT id, doc_id, {split(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} AS ws, {split("lower(text)")} AS low, string_split(lower(text), chr(10)) AS lines FROM d),
        p AS (SELECT id, doc_id, low, lines, len(ws) AS n_words, {phrases} AS places FROM w),
        notices(scope, label, need, words) AS (VALUES {notices}),
        blocks AS (
            SELECT id, '{LINE}' AS scope, {split("line")} AS block FROM (SELECT id, unnest(lines) AS line FROM p)
            UNION ALL
            SELECT id, '{PASSAGE}', low[i + 1 : i + {WINDOW}] FROM (SELECT id, low, unnest(range(0, greatest(len(low), 1), {WINDOW // 2})) AS i FROM p)
        ),
        shares AS (
            SELECT id, label, need, len(words) AS size, len(list_intersect(words, block)) AS shared
            FROM blocks JOIN notices USING (scope) WHERE list_has_any(block, words)
        ),
        found AS (SELECT id, list(DISTINCT label) AS more, max(shared / size) AS share FROM shares WHERE shared >= need GROUP BY id)
        SELECT doc_id, n_words, len(places) AS n_base,
               list_min(list_transform(places, lambda x: x.place)) AS first_word,
               list_max(list_transform(places, lambda x: x.place)) AS last_word,
               array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label))), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label) || coalesce(more, []))), ',') AS labels,
               CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
        FROM p LEFT JOIN found USING (id)
    """
