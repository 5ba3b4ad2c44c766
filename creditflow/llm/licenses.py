"""Licence scan by MinHash bands over text windows (DataFrame functions only).

Texts are lowered and cut into shingles of five words.  Templates with fewer
than ``LONG`` shingles are retrieved by windows of one shingle, longer ones by
windows of ``SPAN`` shingles: the template's start at every shingle, the
text's overlap and start at every ``STRIDE``-th.  A window has four bands of one
row each: least and greatest value of two hash functions over its shingles.

Windows with a Jaccard similarity J share a band with probability
``1 - (1 - J) ** 4``.  A verbatim template of ``LONG`` shingles holds two text
windows or more with J = 1: it is always retrieved.  Where each window keeps
80 % of its shingles (J = 0.67), one window is found with probability 0.988 and
one of the two with over 0.999.  A window of one shingle is found if that shingle is
intact, so a short template with a containment over 0 always is.

Retrieved pairs are verified: ``percent`` of the template's distinct
shingles, compared as text, must occur in the document.

Defined results: null and empty texts match nothing.  Templates of fewer than
five words have no shingle and match nothing.  Rows that repeat match each;
templates that repeat an id are joined under it, the best one counts.  Extra
columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.llm.cuts import Cuts, let, text_key
from creditflow.llm.decontamination import WINDOW, _words, shingles

LONG = 16
SPAN = 8
STRIDE = 4
PERCENT = 80

#: Notices as they stand in files, by SPDX identifier.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES), "license_id string, text string")


def _bands(shingles: Column, stride: int) -> Column:
    """The four band values of every window of SPAN shingles, the number of the band mixed in."""
    def bands(hashes: Column, number: int) -> Column:
        starts = F.when(F.size(hashes) >= SPAN, F.sequence(F.lit(1), F.size(hashes) - (SPAN - 1), F.lit(stride))).otherwise(F.array().cast("array<int>"))
        pairs = F.transform(starts, lambda i: let(F.slice(hashes, i, SPAN), lambda w: F.array(
            F.xxhash64(F.array_min(w), F.lit(number)), F.xxhash64(F.array_max(w), F.lit(number + 1)))))
        return F.array_distinct(F.flatten(pairs))

    second = F.transform(shingles, lambda h: F.xxhash64(h, F.lit(2)))
    return F.concat(let(shingles, lambda h: bands(h, 0)), let(second, lambda h: bands(h, 2)))


def _shingle_texts(words: Column) -> Column:
    def texts(w: Column) -> Column:
        starts = F.when(F.size(w) >= WINDOW, F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, WINDOW), " ")))

    return let(words, texts)


def scan_licenses(docs: DataFrame, templates: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, license_id, n_shingles, n_shared of each licence found in a document."""
    cuts = Cuts()
    templates = templates.select("license_id", "text", _words(F.lower("text")).alias("words")).where(F.size("words") >= WINDOW)
    templates = templates.withColumns({"template": F.xxhash64("license_id", "text"), "shingles": shingles(F.col("words")), "texts": _shingle_texts(F.col("words"))})
    templates = cuts.write(templates)
    long = F.size("shingles") >= LONG
    keys = templates.select("template", F.explode(F.when(long, _bands(F.col("shingles"), 1)).otherwise(F.col("shingles"))).alias("band"))
    keys = cuts.write(keys.distinct())

    docs = docs.select("doc_id", text_key().alias("text_key"), "text")
    shingled = docs.select("doc_id", "text_key", let(_words(F.lower("text")), shingles).alias("shingles"))
    bands = shingled.select("doc_id", "text_key", F.explode(F.concat(F.col("shingles"), _bands(F.col("shingles"), STRIDE))).alias("band"))
    near = cuts.write(bands.join(keys, "band").select(F.col("doc_id").alias("near_id"), F.col("text_key").alias("near_key"), "template").distinct())

    own = near.join(templates.select("template", "license_id", "texts"), "template")
    both = own.join(docs, F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("text_key") == F.col("near_key")))
    counted = both.select("doc_id", "text_key", "license_id", F.size("texts").alias("n_shingles"),
                          F.size(F.array_intersect("texts", _shingle_texts(_words(F.lower("text"))))).alias("n_shared"))
    share = F.struct(F.col("n_shared") / F.col("n_shingles"), "n_shared")
    held = counted.where(F.lit(100) * F.col("n_shared") >= F.lit(percent) * F.col("n_shingles"))
    return held.groupBy("doc_id", "text_key", "license_id").agg(F.max_by("n_shingles", share).alias("n_shingles"), F.max_by("n_shared", share).alias("n_shared"))
