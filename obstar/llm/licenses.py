"""License scans with MinHash bands over overlapping text windows.

A text is cut into words (letters and digits, lower case) and shingles of five words. Its
shingles are covered by overlapping windows: for templates of up to M shingles, windows
of 2 M shingles start at every M-th, so each stretch of M lies whole in one. M goes by
powers of two up to `LONGEST`; longer templates are cut into overlapping stretches.

Each window has `BANDS` MinHash bands of one row; a window and a template stretch that
agree in a band are a candidate. A stretch that is in the window whole has a Jaccard
similarity of at least 1/4 with it, so it is missed with probability (3/4)^BANDS, about
one in a million; one of which four fifths are there, about 4 in 100,000. Candidates are
verified by exact containment: of a template's distinct shingles, at least `CONTAINED`
must be in the windows of the document.

A band can only agree with a template's if the template's least shingle under that band's
hash is in the window. So windows without any of the templates' least shingles are not
worked out: the result is that of working out all of them. The least shingles are a
literal set in the scan while there are at most `LITERALS`; with more templates all
windows go through the bands.

Only built-in functions run: one scan, and a join of the candidates' bands.

Defined results: a null or blank text, or one of fewer than five words, has no shingles; a
template of fewer than five words has none either and is found where its words are all
of a text (one shingle, one found); templates without a word are not looked for; texts count whole; repeated rows
are scanned each, the largest containment counts; a null doc_id is a value like any
other; empty tables, of documents or templates, give an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.llm.common import let, prepare
from obstar.llm.license_texts import TEXTS, WORDINGS
from obstar.session import materialize

SHINGLE, BANDS, LONGEST, CONTAINED, LITERALS = 5, 48, 32, 0.8, 50_000

# Notices by which works state their license.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files, to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
    "sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a "
    "copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
    "of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
    "License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
    "fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


#: What the registered query looks for.
TEMPLATES = NOTICES | TEXTS | WORDINGS


def notices(spark: SparkSession) -> DataFrame:
    """Notices, whole texts and other wordings of common licenses."""
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def shingles(text: Column) -> Column:
    """The hashes of a text's shingles, in order."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", -1)

    def hashed(words: Column) -> Column:
        return F.when(F.size(words) < SHINGLE, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.size(words) - SHINGLE),
                lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]),
            )
        )

    return let(F.array_remove(found, ""), hashed)


def ranked(band: int):
    """A shingle's hash in a band."""
    return lambda h: F.xxhash64(h, F.lit(band))


def bands(window: Column) -> Column:
    """The least hash of a window in each band."""
    return F.array(*[F.array_min(F.transform(window, ranked(k))) for k in range(BANDS)])


def least_shingles(window: Column) -> Column:
    """The shingle of the least hash in each band."""

    def with_rank(band: int):
        return lambda h: F.struct(ranked(band)(h).alias("r"), h.alias("h"))

    return F.array(*[F.array_min(F.transform(window, with_rank(k)))["h"] for k in range(BANDS)])


def size_class(n: Column) -> Column:
    """The power of two, up to LONGEST, that n shingles are looked for by."""
    found = F.lit(LONGEST)
    size = LONGEST // 2
    while size:
        found = F.when(n <= size, size).otherwise(found)
        size //= 2
    return found


def stretches(templates: DataFrame) -> DataFrame:
    """(license, m, stretch, whole): each template's stretches and its distinct shingles."""
    held = templates.select("license", shingles(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.when(
        F.size("all") > LONGEST,
        F.array_union(
            F.sequence(F.lit(1), F.size("all") - LONGEST + 1, F.lit(LONGEST // 2)),
            F.array(F.size("all") - LONGEST + 1),
        ),
    ).otherwise(F.array(F.lit(1)))
    cut = held.select(
        "license", F.array_distinct("all").alias("whole"), "all", F.explode(starts).alias("start")
    )
    own = cut.select("license", "whole", F.slice("all", F.col("start"), LONGEST).alias("stretch"))
    return own.select("license", size_class(F.size("stretch")).alias("m"), "stretch", "whole")


def windows(all_shingles: Column, sizes: list[int], least: list[int] | None) -> Column:
    """Windows (m, start, window) of the given sizes, those that a band can agree in."""

    def of_size(held: Column, hits: Column, m: int) -> Column:
        # a shingle at i is in the windows that start at the last two multiples of m
        first = F.transform(hits, lambda i: i - i % m)
        starts = F.filter(
            F.array_distinct(F.concat(first, F.transform(first, lambda i: i - m))), lambda i: i >= 0
        )
        return F.transform(
            starts,
            lambda s: F.struct(
                F.lit(m).alias("m"), s.alias("start"), F.slice(held, s + 1, F.lit(2 * m)).alias("window")
            ),
        )

    def found(held: Column) -> Column:
        marked = F.transform(
            held, lambda h, i: i if least is None else F.when(h.isin(least), i)
        )
        return let(
            F.array_compact(marked), lambda hits: F.concat(*[of_size(held, hits, m) for m in sizes])
        )

    return let(all_shingles, found)


def short_texts(df: DataFrame, name: str) -> DataFrame:
    """(name, words) of the texts of fewer words than a shingle has."""
    found = F.split(F.lower(F.coalesce("text", F.lit(""))), "[^\\p{L}\\p{N}]+", -1)
    held = df.select(name, F.array_remove(found, "").alias("words"))
    return held.where(F.size("words").between(1, SHINGLE - 1)).select(name, F.array_join("words", " ").alias("words"))


def whole_texts(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, license, found, shingles) of texts that are a template of fewer than a shingle's words."""
    met = short_texts(documents, "doc_id").join(short_texts(templates, "license"), "words")
    one = F.lit(1).cast("long")
    return met.select("doc_id", "license", one.alias("shingles"), one.alias("found")).distinct()


def scan(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, license, found, shingles, containment) of the licenses that documents state."""
    spark = prepare(documents.sparkSession)
    cut = materialize(stretches(templates), "templates", spark)
    least = cut.select(F.explode(least_shingles(F.col("stretch"))).alias("h")).distinct()
    sizes = sorted(r["m"] for r in cut.select("m").distinct().collect())
    few = least.limit(LITERALS + 1).collect()
    known = [r["h"] for r in few] if len(few) <= LITERALS else None
    # a template set without shingles finds nothing
    sizes, known = (sizes, known) if sizes else ([1], [])

    looked = documents.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.explode_outer(windows(shingles(F.col("text")), sizes, known)).alias("w"),
    ).where(F.col("w").isNotNull())
    marked = materialize(
        looked.select("doc_id", "text_hash", "w.m", "w.start", "w.window").withColumn(
            "bands", bands(F.col("window"))
        ),
        "windows",
        spark,
    )
    asked = cut.select("license", "m", "whole", F.posexplode(bands(F.col("stretch"))).alias("band", "v"))
    given = marked.select("doc_id", "text_hash", "m", "start", F.posexplode("bands").alias("band", "v"))
    met = given.join(asked.select("license", "m", "band", "v"), ["m", "band", "v"])
    candidates = met.select("doc_id", "text_hash", "m", "start", "license").distinct()

    place = ["doc_id", "text_hash", "m", "start"]
    same = None
    for c in place:
        equal = marked[c].eqNullSafe(candidates[c])
        same = equal if same is None else same & equal
    wholes = cut.select("license", "whole").distinct()
    seen = (
        candidates.join(marked, same)
        .select(candidates["doc_id"], candidates["text_hash"], "license", "window")
        .join(wholes, "license")
        .select("doc_id", "text_hash", "license", "whole", F.array_intersect("whole", "window").alias("part"))
    )
    contained = (
        seen.groupBy("doc_id", "text_hash", "license")
        .agg(
            F.max(F.size("whole")).cast("long").alias("shingles"),
            F.size(F.array_distinct(F.flatten(F.collect_set("part")))).cast("long").alias("found"),
        )
        .groupBy("doc_id", "license")
        .agg(F.max("found").alias("found"), F.max("shingles").alias("shingles"))
    )
    if not short_texts(templates, "license").isEmpty():
        contained = contained.unionByName(whole_texts(documents, templates))
    share = F.col("found") / F.col("shingles")
    return contained.where(share >= CONTAINED).select(
        "doc_id", "license", "found", "shingles", F.round(share, 4).alias("containment")
    )
