"""License scan: MinHash over overlapping text windows retrieves templates, shingles verify them.

Built from DataFrame functions alone.

1. A text is a row of shingles of five words. Cover words, chosen so that every shingle of every
   template has one of them, tell which texts can share a shingle with a template at all; no other
   text can match.
2. Windows of WINDOW shingles, one beginning every STEP, are MinHashed by one permutation: the hash
   of a shingle picks one of BINS bins and each bin keeps its least hash. A bin is a band of one
   row. A shingle that a window shares with a template is hidden only if another one in the window
   has the same bin and a smaller hash, so a template of m shingles that is wholly in the window is
   missed with a chance of at most ((WINDOW - 1) / (2 * BINS)) ** m: under 0.0002 for m = 1.
3. Templates that share a bin's value with a window of a text are verified: a share of at least
   `containment` of the template's shingles must occur in the text, exactly.

Defined cases: null texts and texts under five words have no license; a template needs five words;
rows repeated or with a null doc_id are scanned each and their equal findings are given once; an
empty table or no templates give an empty result; columns besides id and text are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.scratch import written

SHINGLE = 5
WINDOW = 16
STEP = 8
BINS = 1 << 16
CONTAINMENT = 0.8
MOST_COVER_WORDS = 200
# Words that most English texts have; they tell little about a text.
COMMON = frozenset("a an and any are as at be by can do for from has have if in is it may not of on or s that the this to was with you".split())
WORD = r"[\p{L}\p{N}]+"

# Notices by which texts state their license.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def template_shingles(template: str) -> list[str]:
    """Shingles of a template, as the words joined by blanks."""
    words = re.findall(r"[^\W_]+", template.lower())
    if len(words) < SHINGLE:
        raise ValueError(f"a template needs {SHINGLE} words: {template!r}")
    return [" ".join(words[k : k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)]


def cover_words(shingles: set[str]) -> list[str]:
    """Words of which every shingle has one: long and uncommon ones that cover most, again and again."""
    left, chosen = set(shingles), []
    while left:
        count: dict[str, int] = {}
        for shingle in left:
            for word in set(shingle.split(" ")):
                count[word] = count.get(word, 0) + 1
        # Long words are rarer in texts, so they are worth more than their count.
        word = max(count, key=lambda w: (w not in COMMON, count[w] * len(w) ** 2, w))
        chosen.append(word)
        left = {s for s in left if word not in s.split(" ")}
    return sorted(chosen)


def shingled(docs: DataFrame, cover: list[str]) -> DataFrame:
    """row, doc_id and shingle hashes of the texts that have a cover word."""
    low = F.lower(F.col("text"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), low.alias("text")).where("text is not null")
    if len(cover) <= MOST_COVER_WORDS:
        known = known.where(F.col("text").rlike(r"(?<![\p{L}\p{N}])(?:" + "|".join(cover) + r")(?![\p{L}\p{N}])"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    hashes = F.transform(
        F.sequence(F.lit(1), F.size("words") - (SHINGLE - 1)),
        lambda i: F.xxhash64(F.array_join(F.slice("words", i, SHINGLE), " ")),
    )
    return (
        known.select("doc_id", words.alias("words"))
        .where(F.size("words") >= SHINGLE)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", hashes.alias("hashes"))
    )


def window_values(hashes: str):
    """The least hash of every bin of every window, distinct over the text."""
    starts = F.sequence(F.lit(0), F.ceil(F.greatest(F.size(hashes) - WINDOW, F.lit(0)) / STEP).cast("int"))
    own_bin = lambda h: F.pmod(h, F.lit(BINS))

    def least(window):
        return F.filter(window, lambda h: ~F.exists(window, lambda g: (own_bin(g) == own_bin(h)) & (g < h)))

    return F.array_distinct(F.flatten(F.transform(starts, lambda s: least(F.slice(hashes, s * STEP + 1, WINDOW)))))


def licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, containment and the first word (from 1) of a shared shingle, for every text and template found in it."""
    spark = docs.sparkSession
    shingles = {name: sorted(set(template_shingles(t))) for name, t in templates.items()}
    # As many rows as there are templates, which the caller holds in memory.
    known = spark.createDataFrame(list(shingles.items()), "license string, shingles array<string>").select(
        "license", F.transform("shingles", lambda s: F.xxhash64(s)).alias("wanted")
    )
    cover = cover_words({s for own in shingles.values() for s in own})
    texts = written(shingled(docs, cover), "shingled")
    index = known.select("license", F.explode("wanted").alias("value"))
    retrieved = (
        texts.select("row", F.explode(window_values("hashes")).alias("value"))
        .join(index, "value")
        .select("row", "license")
        .distinct()
    )
    shared = F.array_intersect("wanted", "hashes")
    first = F.array_min(F.transform("shared", lambda h: F.array_position("hashes", h)))
    return (
        retrieved.join(known, "license")
        .join(texts, "row")
        .withColumn("shared", shared)
        .select(
            "doc_id",
            "license",
            F.round(F.size("shared") / F.size(F.array_distinct("wanted")), 6).alias("containment"),
            first.cast("long").alias("first_word"),
        )
        .where(F.col("containment") >= containment)
        .distinct()
    )
