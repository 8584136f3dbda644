"""License scans: MinHash bands over overlapping text windows, verified by shingle containment.

Templates and texts are words (lower-cased, runs of letters, digits, dots and hyphens) in shingles
of five. Templates of similar length share a window length; windows of that many shingles slide
over the whole text by an eighth of it, so the best window holds nearly all of a planted template.
Each window gets BANDS MinHash values, one value a band. At the lowest similarity that a window
with containment THRESHOLD can have (`least_similarity`, about 0.5), a window and its template
miss each other in every band with probability (1 - 0.5) ** 20, one in a million. Candidates are
verified: the share of the template's distinct shingles in the window and one step around it must
be at least 0.8.

Windows that hold no shingle of any template have similarity 0 and cannot share a MinHash value
but by a hash collision that verification rejects, so their signatures are not computed. That
test and the signatures use the templates' shingle hashes: a bounded set, checked on entry.

Nulls and empty texts match nothing; templates under five words are refused. Null ids are kept as
null. Repeated rows are reported once each, as are ties between templates. No template or no
document: an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.staging import compute_once

WORDS, THRESHOLD, BANDS = 5, 0.8, 20
# The template shingles are part of every task's plan; more than this many need a join instead.
MAX_TEMPLATE_SHINGLES = 20_000

# Short public license notices and the opening text of common licenses.
TEMPLATES = (
    ("Apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("MIT-line", "Released under the MIT License."),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0-short", "This project is licensed under the Apache License 2.0."),
    ("MIT-short", "This project is licensed under the MIT License."),
    ("MIT-plain", "Licensed under the MIT License."),
    ("BSD-3-line", "This project is licensed under the BSD 3-Clause License."),
    ("BSD-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-disclaimer", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("GPL-2.0-line", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("CC-BY-4.0-short", "This content is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-short", "This content is licensed under CC BY-SA 4.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words(text: Column) -> Column:
    """Lower-cased words; sentence punctuation is dropped, dots and hyphens inside words stay."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}.\-]+|\.(?![\p{L}\p{N}])", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def with_shingles(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Replaces a text column by the 64-bit hashes of all its runs of WORDS words, in order.

    Words are hashed once; a shingle mixes five word hashes.
    """
    hashed = compute_once(rows, {"_h": F.transform(words(F.col(text)), lambda w: F.xxhash64(w))}).drop(text)
    runs = F.size("_h") - (WORDS - 1)
    at = F.when(runs > 0, F.sequence(F.lit(0), runs - 1)).otherwise(F.array().cast("array<int>"))
    return compute_once(hashed, {name: F.transform(at, lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WORDS)]))}).drop("_h")


def least_similarity(shingles: int, window: int, step: int, threshold: float = THRESHOLD) -> float:
    """Jaccard similarity that the best window has at least, if the text holds `threshold` of the template.

    The best window loses at most half a step at its ends.
    """
    common = max(threshold * shingles - step / 2, 1)
    return min(1.0, common / (window + shingles - common))


def _window(shingles: int) -> tuple[int, int]:
    """Window length and step for a template: lengths grow by a quarter, so few lengths serve all."""
    length = 1
    while length < shingles:
        length = max(length + 1, length * 5 // 4)
    return length, max(1, length // 8)


def _minhashes(hashes: Column) -> Column:
    """(band, value) of a set of shingle hashes: per band the least of its own hash of them."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*[F.struct(F.lit(b).alias("band"), least(b).alias("value")) for b in range(BANDS)])


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> list[Row]:
    """license, shingles, length, step of each template; a bounded list."""
    listed = spark.createDataFrame(list(templates), "license string, text string")
    rows = with_shingles(listed, "text", "shingles").select("license", F.array_distinct("shingles").alias("shingles")).collect()
    if short := [r.license for r in rows if not r.shingles]:
        raise ValueError(f"templates under {WORDS} words: {short}")
    if sum(len(r.shingles) for r in rows) > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"more than {MAX_TEMPLATE_SHINGLES} template shingles; scan in several runs")
    return [Row(license=r.license, shingles=r.shingles, length=n, step=s) for r in rows for n, s in [_window(len(r.shingles))]]


def _windows(length: int, step: int) -> Column:
    """Windows of one length that hold a marked place: length, start, their shingles, and those around.

    Windows start at multiples of `step`; in a text shorter than a window there is one.
    """
    starts = F.array_distinct(F.flatten(F.transform("_places", lambda p: F.sequence(
        F.floor(F.greatest(p - length + step, F.lit(0)) / step).cast("int"), F.floor(p / step).cast("int"),
    ))))
    return F.transform(starts, lambda k: F.struct(
        F.lit(length).alias("length"), (k * step).alias("start"),
        F.slice("_all", k * step + 1, F.lit(length)).alias("shingles"),
        F.slice("_all", F.greatest(k * step - step, F.lit(0)) + 1, F.lit(length + 2 * step)).alias("around"),
    ))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, containment, word_start, word_end: one row per document and license.

    containment is the largest over the document's windows, each taken with one step on either
    side; the words are those of the first such stretch.
    """
    spark = docs.sparkSession
    result = "doc_id long, license string, containment double, word_start int, word_end int"
    if not templates:
        return spark.createDataFrame([], result)
    known = template_table(spark, templates)
    every = sorted({h for r in known for h in r.shingles})
    scales = sorted({(r.length, r.step) for r in known})
    rows = with_shingles(docs.select("doc_id", "text"), "text", "_all")
    # Places of template shingles; most texts have none and end here.
    marked = F.filter(F.transform("_all", lambda h, i: F.when(h.isin(every), i)), lambda i: i.isNotNull())
    rows = compute_once(rows, {"_places": marked}).where("size(_places) > 0")
    windows = rows.select("doc_id", F.explode(F.concat(*[_windows(*s) for s in scales])).alias("w"))
    bands = windows.select("doc_id", "w.length", "w.start", "w.around", F.explode(_minhashes(F.col("w.shingles"))).alias("b"))
    listed = spark.createDataFrame([tuple(r) for r in known], "license string, shingles array<long>, length int, step int")
    theirs = listed.select("license", "step", F.col("length").alias("_length"), F.explode(_minhashes(F.col("shingles"))).alias("t"), "shingles")
    hit = (F.col("length") == F.col("_length")) & (F.col("b.band") == F.col("t.band")) & (F.col("b.value") == F.col("t.value"))
    # The templates are bounded by MAX_TEMPLATE_SHINGLES; candidates need no shuffle.
    candidates = bands.join(F.broadcast(theirs), hit)
    share = F.size(F.array_intersect("shingles", "around")) / F.size("shingles")
    first = F.greatest(F.col("start") - F.col("step"), F.lit(0))
    found = candidates.select("doc_id", "license", share.alias("containment"), first.alias("word_start"), (first + F.size("around") + (WORDS - 1)).alias("word_end"))
    best = F.max_by(F.struct("word_start", "word_end"), F.struct("containment", -F.col("word_start")))
    found = found.where(F.col("containment") >= threshold).groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), best.alias("at"))
    return found.select("doc_id", "license", "containment", "at.word_start", "at.word_end")
