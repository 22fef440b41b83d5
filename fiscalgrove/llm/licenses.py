"""License notices in texts.

Texts and templates are cut into overlapping windows of two shingles of five words. MinHash bands of one row each
retrieve templates: a window's key in a band is the least of its shingles' hashes under the band's permutation. Two windows
that share j of all their shingles agree in at least one of b bands with probability 1 - (1 - j)^b: with 8 bands
0.996 where they share one of two (a template of a single shingle, which two windows of the text hold: 0.99998 for both), and
surely where they are equal, as they are wherever two neighbouring shingles of a longer template stand. Retrieved
places are verified exactly: the share of the template's distinct shingles that occur in the words around the place.

All of it is built-in functions. Texts are looked at where they lie; only found places are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import let

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 8
#: windows of all templates, times bands: so many keys are sent to the tasks at most
MAX_KEYS = 200_000

# fixed values: customary notices of common licenses
NOTICES = {
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-grant": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-grant": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl-grant": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES.items()), "license string, notice string")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingles(words: Column) -> Column:
    """All runs of five words, as text. Fewer words make none."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.array_join(F.slice(words, i, F.lit(SHINGLE)), " "))
    return F.when(F.size(words) < SHINGLE, F.array().cast("array<string>")).otherwise(runs)


def _hashes(words: Column) -> Column:
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE))))
    return F.when(F.size(words) < SHINGLE, F.array().cast("array<bigint>")).otherwise(runs)


def _permuted(band: int, c: Column) -> Column:
    """The band's permutation of 64-bit numbers."""
    return c.bitwiseXOR(F.lit((0x9E3779B97F4A7C15 * (band + 1) & (1 << 64) - 1) - (1 << 63)))


def _key(hashes: Column, i: Column, band: int) -> Column:
    """Of the window that starts at place i (from 0): of one shingle where the text has no more. least() skips nulls."""
    return F.least(_permuted(band, F.get(hashes, i)), _permuted(band, F.get(hashes, i + 1)))


def _starts(hashes: Column) -> Column:
    return F.when(F.size(hashes) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(F.size(hashes) - 2, F.lit(0))))


def scan(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` and license found in it: id, ``license``, ``containment`` (of the best place), ``start_word`` (the first
    word, from 0, of the window that led to it; the first of equals), ``n_places`` (windows that led to a verified place).

    ``templates``: ``license``, ``notice``. Null and empty texts, and texts or notices of fewer than five words, match nothing. Rows with
    null or repeated ids stand for themselves; a repeated notice counts once per license. Empty tables give no rows. Other columns are
    not looked at.
    """
    templates = notices(docs.sparkSession) if templates is None else templates
    prepared = templates.where("license is not null").select("license", _words(F.col("notice")).alias("w")).distinct().select(
        "license", F.size("w").alias("length"), F.array_distinct(_shingles(F.col("w"))).alias("own"), _hashes(F.col("w")).alias("h")).where("size(own) > 0")
    keys = prepared.select("license", "length", "own", F.explode(let(F.col("h"), lambda h: F.flatten(F.transform(_starts(h), lambda i: F.array(
        *[F.struct(F.lit(b).alias("band"), _key(h, i, b).alias("key")) for b in range(BANDS)]))))).alias("k")).select("license", "length", "own", "k.band", "k.key").distinct()
    # a bounded table: the keys and the templates behind them
    known = keys.limit(MAX_KEYS + 1).collect()
    if len(known) > MAX_KEYS:
        raise ValueError(f"templates have more than {MAX_KEYS} keys: scan with a part of them at a time")
    longest = max((r["length"] for r in known), default=0)
    of_band = [sorted({r["key"] for r in known if r["band"] == b}) for b in range(BANDS)]

    def meets(h: Column, i: Column) -> Column:
        out = F.lit(False)
        for b in range(BANDS):
            out = out | _key(h, i, b).isin(of_band[b])
        return out

    def places(w: Column) -> Column:
        """The windows that meet a template in a band: place, keys, and the words around."""
        def near(i: Column) -> Column:
            first = F.greatest(i - longest, F.lit(0))
            return F.slice(w, first + 1, i + 1 + SHINGLE + F.lit(longest) - first)

        def found(h: Column) -> Column:
            return F.transform(F.filter(_starts(h), lambda i: meets(h, i)), lambda i: F.struct(
                i.alias("at"), F.array(*[_key(h, i, b) for b in range(BANDS)]).alias("keys"), F.least(i, F.lit(longest)).alias("offset"), near(i).alias("near")))

        return let(_hashes(w), found)

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), let(_words(F.col(text_col)), places).alias("places"))
    hits = rows.select("id", "row", F.explode("places").alias("p")).select("id", "row", "p.at", "p.offset", "p.near", F.posexplode("p.keys").alias("b", "k"))
    found = hits.join(F.broadcast(keys), (F.col("b") == F.col("band")) & (F.col("k") == F.col("key")))
    # as far before and behind the window as the template is long
    start = F.greatest(F.col("offset") - F.col("length"), F.lit(0))
    region = F.slice("near", start + 1, F.col("offset") - start + 1 + SHINGLE + F.col("length"))
    share = F.size(F.array_intersect(F.col("own"), _shingles(region))) / F.size("own")
    verified = found.select("id", "row", "license", "at", share.alias("containment")).where(F.col("containment") >= similarity)
    best = verified.groupBy("id", "row", "license", "at").agg(F.max("containment").alias("containment"))
    return best.groupBy("id", "row", "license").agg(
        F.max("containment").alias("containment"), F.min_by("at", F.struct(-F.col("containment"), F.col("at"))).cast("long").alias("start_word"),
        F.count(F.lit(1)).alias("n_places")).drop("row").withColumnRenamed("id", id_col)
