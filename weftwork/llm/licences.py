"""Licence scans: MinHash bands over overlapping windows of a text retrieve templates, exact shingle containment confirms.

A template of m shingles belongs to the class of the least power of two s >= m; texts are cut into windows of 2 s shingles
every s, so that each passage of a template's length lies whole in one window. Windows are sketched over the shingles that
any template has, all others can match nothing: a window that holds 80 % of a template then resembles it by 0.19 at
least, however many other templates stand there too, and one of 64 one-row bands agrees with a probability over 0.999998
(1 - 0.81 ^ 64). DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm.common import document_key, small, stored, word_array

BANDS = 64
SIZE = 5
BROADCAST_ROWS = 1_000_000

# The notices and licence texts to look for, as published.
TEMPLATES = [
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("mit-notice", "Released under the MIT License."),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("gpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
]


def default_templates(spark: SparkSession) -> DataFrame:
    """licence, text: the texts above."""
    return spark.createDataFrame(TEMPLATES, "licence string, text string")


def _shingles(words, k):
    """(at, h) of the runs of k words, an array; ``at`` counts from 0."""
    starts = F.sequence(F.lit(0), F.size(words) - k)
    runs = F.transform(starts, lambda i: F.struct(i.alias("at"), F.concat_ws(" ", F.slice(words, i + 1, k)).alias("h")))
    return F.when(F.size(words) >= k, runs)


def template_shingles(templates: DataFrame) -> DataFrame:
    """licence, k (words in a shingle: five, or all of a shorter template), h, m (distinct shingles), s (the class), stored."""
    words = templates.select("licence", word_array(F.col("text")).alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(SIZE))
    each = words.withColumn("k", k).select("licence", "k", F.explode(_shingles(F.col("w"), F.col("k"))).alias("x")).select("licence", "k", F.xxhash64("k", "x.h").alias("h")).distinct()
    sizes = each.groupBy("licence").agg(F.count("*").alias("m"))
    return stored(each.join(sizes, "licence").withColumn("s", F.pow(F.lit(2), F.ceil(F.log2("m"))).cast("long")))


def _sketch(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group and band: the smallest of the shingles under the band's own hash."""
    lows = [F.min(F.xxhash64("h", F.lit(i))).alias(f"b{i}") for i in range(BANDS)]
    bands = F.posexplode(F.array(*[f"b{i}" for i in range(BANDS)])).alias("band", "low")
    return df.groupBy(*keys).agg(*lows).select(*keys, bands)


def _hits(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """_id, _text, at, h of all shingles of the documents that a template has, stored. Repeated documents count once."""
    words = docs.select(*document_key(), word_array(F.col("text")).alias("w"))
    ahead = [F.col("w"), *[F.slice("w", F.lit(i + 1), F.greatest(F.size("w") - i, F.lit(0))) for i in range(1, SIZE)]]
    zipped = F.arrays_zip(*ahead).cast(f"array<struct<{', '.join(f'w{i}: string' for i in range(SIZE))}>>")
    runs = words.select("_id", "_text", F.posexplode(zipped).alias("at", "r")).select("_id", "_text", "at", "r.*")
    sizes = [r.k for r in shingles.select("k").distinct().orderBy("k").collect()]  # five numbers at most
    hashed = [F.when(F.col(f"w{k - 1}").isNotNull(), F.xxhash64(F.lit(k), F.concat_ws(" ", *[f"w{i}" for i in range(k)]))) for k in sizes]
    rows = runs.select("_id", "_text", "at", hashed[0].alias("h") if len(hashed) == 1 else F.explode(F.array(*hashed)).alias("h")) if sizes else runs.select("_id", "_text", "at", F.lit(0).cast("long").alias("h"))
    return stored(rows.join(small(stored(shingles.select("h").distinct()), BROADCAST_ROWS), "h").distinct())


def scan(docs: DataFrame, templates: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, licence, containment, first_word, windows: one row for each document (doc_id, text) and template found in it.

    Words are runs of letters, digits and everything beyond ASCII, lower-cased A-Z; shingles are five words, or all words
    of a shorter template. A template (licence, text) is found where a window holds ``percent`` of its distinct shingles;
    ``containment`` is the largest share, ``first_word`` the first matching word (from 0), ``windows`` how many hold it.
    Null and wordless texts and templates match nothing. Repeated rows of one doc_id and text count once; a null doc_id
    is reported as null. Empty tables give no rows. Other columns are ignored, whatever their names.
    """
    shingles = template_shingles(templates)
    hits = _hits(docs, shingles)
    classes = [F.lit(r.s) for r in shingles.select("s").distinct().orderBy("s").collect()]  # powers of two: sixty at most
    each = hits.withColumn("s", F.explode(F.array(*classes) if classes else F.array().cast("array<long>")))
    places = each.select("_id", "_text", "at", "h", "s", F.explode(F.array(F.floor(F.col("at") / F.col("s")), F.floor(F.col("at") / F.col("s")) - 1)).alias("window"))
    key = ["_id", "_text", "s", "window"]
    asked = small(stored(_sketch(shingles, ["licence", "m", "s"])), BROADCAST_ROWS)
    likely = _sketch(places, key).join(asked, ["s", "band", "low"]).select(*key, "licence", "m").distinct()
    near = likely.alias("l").join(places.alias("p"), F.expr("l._id <=> p._id AND l._text = p._text AND l.s = p.s AND l.window = p.window")).select("l.*", "p.at", "p.h")
    shared = near.join(small(stored(shingles.select("licence", "h")), BROADCAST_ROWS), ["licence", "h"])
    held = shared.groupBy(*key, "licence", "m").agg(F.count_distinct("h").alias("n"), F.min("at").alias("first")).where(F.col("n") * 100 >= F.col("m") * percent)
    found = held.groupBy("_id", "_text", "licence").agg(F.max(F.col("n") / F.col("m")).alias("containment"), F.min("first").cast("long").alias("first_word"), F.count("*").alias("windows"))
    return found.select(F.col("_id").alias("doc_id"), "licence", "containment", "first_word", "windows")
