"""Licence scan: Dice coefficient over word bigrams between units of text and templates.

Only DataFrame expressions touch rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import written

# Public licence notices and the opening passages of licence texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# How whole licence files begin, looked for as passages only.
OPENINGS = (
    (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION",
    ),
    (
        "GPL-3.0",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. "
        "<https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, "
        "but changing it is not allowed.",
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
)

THRESHOLD = 0.7


def template_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def markers(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every match holds at least one.

    A match shares at least `threshold / (2 - threshold)` of a template's bigrams. For
    each template words are added, long ones first, until its bigrams without any of them
    are fewer than that.
    """
    chosen: set[str] = set()
    for _, text in templates:
        bigrams = [b.split() for b in template_bigrams(text)]
        need = threshold / (2 - threshold) * len(bigrams)
        words = sorted({w for b in bigrams for w in b}, key=lambda w: (len(w), w), reverse=True)
        while sum(not chosen & set(b) for b in bigrams) >= need:
            chosen.add(next(w for w in words if w not in chosen))
    return sorted(chosen)


def words_of(text: Column) -> Column:
    """Words of normalised text: A to Z in lower case, everything but ASCII letters and digits a gap.

    Lower case comes last, when only ASCII is left, which the JVM does byte by byte.
    """
    clean = F.lower(F.regexp_replace(text, r"[^A-Za-z0-9]+", " "))
    return F.array_remove(F.split(clean, " "), "")


def bigrams_of(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    pairs = F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def _candidates(docs: DataFrame, templates, threshold: float) -> DataFrame:
    """`doc_id`, `text` and `hits` of the texts that may name a licence, each text split once.

    `hits` are the places (`at`) and bigrams that some template has too. A match of a unit
    or a passage holds a marker word, and `threshold / (2 - threshold)` of a template's
    bigrams at least; few texts have as many of any template.
    """
    words = docs.select("doc_id", "text", words_of(F.col("text")).alias("w")).where(
        F.arrays_overlap("w", F.array(*map(F.lit, markers(templates, threshold))))
    )
    pairs = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    lists = [template_bigrams(text) for _, text in templates]
    known = sorted({b for bigrams in lists for b in bigrams})
    found = F.transform(pairs, lambda b, n: F.when(b.isin(known), F.struct(n.alias("at"), b.alias("bigram"))))
    hits = words.select("doc_id", "text", F.filter(found, lambda x: x.isNotNull()).alias("hits"))
    least = threshold / (2 - threshold)
    table = F.array(*(F.array(*map(F.lit, bigrams)) for bigrams in lists))
    named = hits.withColumn("own", F.array_distinct("hits.bigram")).where(F.size("own") > 0)
    enough = F.exists(table, lambda t: F.size(F.array_intersect("own", t)) >= least * F.size(t))
    return written(named.where(enough).select("doc_id", "text", "hits"), "licences")


def _passages(texts: DataFrame, templates, threshold: float) -> DataFrame:
    """Passages anywhere in a text that name a licence: `doc_id`, `licence`, `unit`, `dice`.

    A passage is as many words as the template has; line breaks do not count. Where as
    many bigrams repeat as in the template, the share of the template's bigrams found in
    it is their Dice coefficient. Hits of a text are grouped by two neighbouring blocks
    of the template's length, so a group stays small and every passage lies in one.
    """
    spark = texts.sparkSession
    rows = [
        (n, licence, bigram, len(template_bigrams(text)), len(template_words(text)) - 1)
        for n, (licence, text) in enumerate(templates) for bigram in template_bigrams(text)
    ]
    wanted = spark.createDataFrame(rows, "t int, licence string, bigram string, size int, span int")
    hits = texts.select("doc_id", F.xxhash64("text").alias("unit"), F.inline("hits")).join(F.broadcast(wanted), "bigram")
    block = F.floor(F.col("at") / F.col("span"))
    groups = (
        hits.withColumn("block", F.explode(F.array(block, block - 1)))
        .groupBy("doc_id", "unit", "t", "licence", "size", "span", "block")
        .agg(F.collect_set(F.struct("at", "bigram")).alias("h"))
        .where(F.size(F.array_distinct("h.bigram")) >= threshold * F.col("size"))
    )
    held = F.transform("h", lambda x: F.size(F.array_distinct(F.transform(
        F.filter("h", lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + F.col("span"))), lambda y: y["bigram"]
    ))))
    return groups.select("doc_id", "licence", "unit", (F.array_max(held) / F.col("size")).alias("dice")).where(
        F.col("dice") >= threshold
    )


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, openings=OPENINGS) -> DataFrame:
    """Licences that a document names: `doc_id`, `licence`, `dice` and `n_units`.

    A text's units are its lines and the whole text. A unit names the licence of a template if the Dice
    coefficient of their distinct word bigrams is at least `threshold`; only templates
    whose size can reach it are compared. One row for each id and licence, with the best
    coefficient and the number of different units that name it. A licence that no unit
    names may be named by a passage, at any word of the text (`_passages`), as of a wrapped
    licence file, a header or a notice inside a line; its best coefficient and the number
    of different texts with one are given then. Null and empty texts
    name none; repeated rows and rows that share an id are one document; a null id is an
    id of its own; other columns are not read; an empty table gives an empty result.

    Each text is split into words once; the few that have enough bigrams of any template
    (`_candidates`) are written, and only these are looked into by line and passage.
    """
    table = F.array(
        *(
            F.struct(
                F.lit(name).alias("licence"), F.lit(len(template_bigrams(text))).alias("size"),
                F.array(*map(F.lit, template_bigrams(text))).alias("bigrams"),
            )
            for name, text in templates
        )
    )
    texts = _candidates(docs, (*templates, *openings), threshold)
    marked = F.array(*map(F.lit, markers(templates, threshold)))
    lines = F.array_distinct(F.concat(F.split("text", "\n"), F.array("text")))
    split_ = texts.select("doc_id", F.explode(lines).alias("unit"))
    split_ = split_.select("doc_id", F.xxhash64("unit").alias("unit"), words_of(F.col("unit")).alias("w"))
    units = (
        split_.where(F.arrays_overlap("w", marked))
        .select("doc_id", "unit", bigrams_of(F.col("w")).alias("b"))
        .where(F.size("b") > 0)
    )
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    fitting = F.filter(table, lambda t: (t["size"] >= low * F.size("b")) & (t["size"] <= high * F.size("b")))
    compared = F.transform(
        fitting,
        lambda t: F.struct(
            t["licence"].alias("licence"),
            (2.0 * F.size(F.array_intersect("b", t["bigrams"])) / (F.size("b") + t["size"])).alias("dice"),
        ),
    )
    found = units.select("doc_id", "unit", F.explode(F.filter(compared, lambda c: c["dice"] >= threshold)).alias("m"))
    named = found.select("doc_id", F.col("m.licence").alias("licence"), "unit", F.col("m.dice").alias("dice"))
    passages = _passages(texts, (*templates, *openings), threshold)
    both = named.withColumn("own", F.lit(True)).unionByName(passages.withColumn("own", F.lit(False)))
    own = F.when(F.col("own"), F.col("dice"))
    return (
        both.groupBy("doc_id", "licence", "unit", "own").agg(F.max("dice").alias("dice"))
        .groupBy("doc_id", "licence")
        .agg(
            F.round(F.coalesce(F.max(own), F.max("dice")), 6).alias("dice"),
            F.when(F.count(own) > 0, F.count(own)).otherwise(F.count(F.lit(1))).alias("n_units"),
        )
    )


def oracle(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The scan of lines and whole texts as SQL, without passages and the word test before it."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rows = ", ".join(
        f"({quoted(name)}, [{', '.join(map(quoted, template_bigrams(text)))}])" for name, text in templates
    )
    return f"""
    WITH t(licence, bigrams) AS (VALUES {rows}),
    u AS (
        SELECT DISTINCT doc_id, unit
        FROM (SELECT doc_id, unnest(list_concat(string_split(text, chr(10)), [text])) AS unit FROM documents WHERE text IS NOT NULL)
    ), w AS (
        SELECT doc_id, unit, string_split(trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM u
    ), b AS (
        SELECT doc_id, unit, list_distinct(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) AS b
        FROM w WHERE len(w) > 1
    ), m AS (
        SELECT doc_id, licence, unit, max(2.0 * len(list_intersect(b, bigrams)) / (len(b) + len(bigrams))) AS dice
        FROM b, t
        WHERE len(bigrams) BETWEEN {threshold / (2 - threshold)} * len(b) AND {(2 - threshold) / threshold} * len(b)
        GROUP BY doc_id, licence, unit
    )
    SELECT doc_id, licence, round(max(dice), 6) AS dice, count(*) AS n_units
    FROM m WHERE dice >= {threshold} GROUP BY doc_id, licence
    """
