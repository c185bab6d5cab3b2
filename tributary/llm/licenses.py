"""License notices in documents: MinHash bands over overlapping windows find templates, exact containment decides.

A text's words are cut into windows, at each level of length: windows of twice 8, 16, 32, ... words, one every
8, 16, 32, ... words, so a passage of up to that many words lies whole in one of them. A window is held
against the templates of its level, those with more than half as many words. A notice in a window then has
Jaccard similarity 0.16 or more with it, so of ``BANDS`` bands of one minimum each it shares one with probability
1 - (1 - 0.16) ** 64 = 0.99999 or more. What shares a band is verified: the template's shingles that the window
holds, word for word, by all of the template's shingles.

Sibling templates share most of their shingles, so a notice of one holds much of the other. A match is dropped where
a template of another license has greater containment in the same window or one beside it, which a notice may reach into, and
explains it: all that the window holds of the former is in the latter.

A window that holds no shingle of any template has containment 0; it is left out before signatures are made.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WIDTH, BANDS = 3, 64
CONTAINED = 0.8
SHORTEST = 8

# Phrases of public license texts, with their SPDX identifiers.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
     " that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
     " later version"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def held(value: Column) -> Column:
    """The value, made once: a generator's output is never copied into the expressions that use it."""
    return F.explode(F.array(value))


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits, lower case; null as empty."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def _each(words_: Column, shingle) -> Column:
    last = F.size(words_) - WIDTH
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: shingle([words_[i + k] for k in range(WIDTH)]))


def hashes(words_: Column) -> Column:
    return _each(words_, lambda parts: F.xxhash64(*parts))


def spelled(words_: Column) -> Column:
    return F.array_distinct(_each(words_, lambda parts: F.concat_ws(" ", *parts)))


def signature(hashes_: Column) -> Column:
    """BANDS minima, each under a hash function of its own."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.array_min(F.transform(hashes_, lambda h: F.xxhash64(h, j)))
    )


def _templates(spark: SparkSession, templates) -> DataFrame:
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    frame = spark.createDataFrame(rows, "template int, license string, text string").withColumn("words", words(F.col("text")))
    level = F.greatest(F.lit(SHORTEST), F.pow(2.0, F.ceil(F.log2(F.size("words"))))).cast("int")
    return frame.filter(F.size("words") >= WIDTH).select("template", "license", "words", level.alias("level"))


def license_windows(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Verified matches: doc_id, license, template, level, window (its number), containment of 0.8 or more.

    ``templates``: (license, phrase) pairs of three words or more, shorter ones are never found. Their number is the
    caller's, not the documents'; they are all that is broadcast. Null and empty texts match nothing; rows are
    searched one by one, equal ones with equal results; an empty table gives no rows.
    """
    spark = docs.sparkSession
    known = _templates(spark, templates)
    wanted = [(r.level, r.h) for r in known.select("level", hashes(F.col("words")).alias("h")).collect()]
    levels, shingles = sorted({level for level, _ in wanted}), sorted({h for _, hs in wanted for h in hs})
    cut = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), held(words(F.col("text"))).alias("words"))
    cut = cut.filter(F.size("words") >= WIDTH)
    found = F.transform(hashes(F.col("words")), lambda h, i: F.when(h.isin(shingles), i))
    hit = cut.select("doc_id", "row", "words", held(F.filter(found, lambda i: i.isNotNull())).alias("hits")).filter(F.size("hits") > 0)
    # the windows of a level that cover a hit: the one that begins at or before it, and the one before that
    spots = F.array_distinct(F.flatten(F.array(*(
        F.transform(F.flatten(F.transform("hits", lambda i: F.array(F.floor(i / level), F.greatest(F.floor(i / level) - 1, F.lit(0))))),
                    lambda k: F.struct(F.lit(level).alias("level"), k.cast("int").alias("window")))
        for level in levels
    ))))
    windows = hit.select("doc_id", "row", "words", F.explode(spots).alias("w")).select(
        "doc_id", "row", "w.level", "w.window",
        held(F.slice("words", F.col("w.level") * F.col("w.window") + 1, F.col("w.level") * 2)).alias("words"),
    )
    hashed = windows.select("doc_id", "row", "level", "window", "words", held(hashes(F.col("words"))).alias("hashes"))
    signed = hashed.select("doc_id", "row", "level", "window", "words", F.posexplode(signature(F.col("hashes"))).alias("band", "value"))
    bands = known.select(
        "template", "license", F.col("level").alias("l"), F.col("words").alias("phrase"),
        F.posexplode(signature(hashes(F.col("words")))).alias("b", "v"),
    )
    met = signed.join(F.broadcast(bands), (F.col("level") == F.col("l")) & (F.col("band") == F.col("b")) & (F.col("value") == F.col("v")))
    pairs = met.select("doc_id", "row", "license", "template", "level", "window", "words", "phrase").distinct()
    found = pairs.withColumn("wanted", spelled(F.col("phrase"))).withColumn(
        "holds", F.array_intersect(spelled(F.col("words")), F.col("wanted"))
    ).withColumn("containment", F.size("holds") / F.size("wanted")).filter(F.col("containment") >= CONTAINED)
    return _unexplained(found).select("doc_id", "license", "template", "level", "window", "containment")


def _unexplained(found: DataFrame) -> DataFrame:
    """The matches without those that a sibling template explains. What meets are the matches of three windows of a row and
    level, no more than three times the templates."""
    match = F.struct("license", "template", "containment", "holds", "wanted", F.col("beside").alias("beside"))
    near = found.withColumn("beside", F.explode(F.array(F.lit(0), F.lit(-1), F.lit(1)))).groupBy(
        "doc_id", "row", "level", (F.col("window") + F.col("beside")).alias("window")
    ).agg(F.collect_list(match).alias("matches"))

    def explains(own: Column, other: Column) -> Column:
        return (other["license"] != own["license"]) & (other["containment"] > own["containment"]) & (
            F.size(F.array_except(own["holds"], other["wanted"])) == 0
        )

    kept = F.filter("matches", lambda own: (own["beside"] == 0) & ~F.exists("matches", lambda other: explains(own, other)))
    return near.select("doc_id", "level", "window", F.explode(kept).alias("m")).select("doc_id", "level", "window", "m.*")


def licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per doc_id and license found: doc_id, license, containment (the greatest), first_word (where the
    first window with a match begins)."""
    return license_windows(docs, templates).groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min(F.col("level") * F.col("window")).cast("long").alias("first_word")
    )
