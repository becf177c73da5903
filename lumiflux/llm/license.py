"""License scans with DataFrame functions only: MinHash bands retrieve templates, exact containment verifies them.

Words are [a-z0-9]+ after lower-casing A-Z; a shingle is SHINGLE words (all of a shorter text). Texts and templates are
cut into overlapping windows of WINDOW shingles; a text's begin at every STRIDE-th shingle, a template's at each.
A window has BANDS bands of one MinHash value, the least of its shingles' XXH64 under the band's own seed. Two windows of
likeness J agree in some band with probability 1 - (1 - J)^BANDS. A notice of one to three shingles shares all of them
with one window of a text (its likeness to it is a third at the least), and is missed with (2/3)^24 = 0.00006. A longer
notice that stands whole has a window that equals one of the text's, and is never missed. Where a notice was changed so
that only single shingles are left (a likeness of 1/5), each is missed with (4/5)^24 = 0.0047, and each is one chance more.

For a retrieved template the different ones of its shingles that stand in the text near the window (within twice its own
length to either side) are counted exactly; CONTAINMENT of them or more is a match. Shingles scattered over a text
farther than that are no notice. Templates are a table (name, text), without one the list below; retrieval is a join
with their bands, broadcast in parts of a checked size. The text itself is never shuffled.

Defined results: null and empty texts match nothing; each template counts once a document; repeated rows match alike,
and rows that share a doc_id but not the text are told apart by its hash; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lumiflux.llm.common import materialise, with_text

SHINGLE, WINDOW, STRIDE, BANDS, CONTAINMENT = 5, 3, 2, 24, 0.8
#: Shingles of templates that are broadcast at a time: some 24 rows of 24 bytes each.
INDEX = 40_000

# Public license notices.
TEMPLATES = {
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "0bsd": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "bsd-3-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "bsl-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following.',
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "mit-line": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0))


def bound(value: Column, body) -> Column:
    """body(value) with the value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(text: Column) -> Column:
    """64-bit hashes of a text's shingles, in order; none of a text without words."""

    def run(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(SHINGLE))))
        return F.when(F.size(w) >= SHINGLE, each).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(F.transform(w, lambda x: x.cast("string")), " ")))).otherwise(F.array().cast("array<long>"))

    return bound(F.transform(words(text), lambda w: F.xxhash64(w)), run)


def with_shingles(df: DataFrame) -> DataFrame:
    return df.withColumn("__h", shingles(F.col("text"))).drop("text")


def with_bands(df: DataFrame, starts: Column) -> DataFrame:
    """A row a band of each window: at, its first shingle in __h, and value, its MinHash under the band's permutation."""
    cut = df.withColumn("at", F.explode(starts))
    parts = [F.get(F.col("__h"), F.col("at") + j) for j in range(WINDOW)]
    cut = cut.select("*", *(p.alias(f"__{j}") for j, p in enumerate(parts)))
    each = cut.withColumn("band", F.explode(F.array(*(F.lit(b) for b in range(BANDS)))))
    value = F.least(*(F.when(F.col(f"__{j}").isNotNull(), F.xxhash64(F.col(f"__{j}"), F.col("band"))) for j in range(WINDOW)))
    return each.withColumn("value", value).drop("band", *(f"__{j}" for j in range(WINDOW)))


def templates(spark) -> DataFrame:
    """The fixed list as a table: name, text."""
    return spark.createDataFrame(sorted(TEMPLATES.items()), "name string, text string")


def matches(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, text_hash, name, containment: each template that a document holds. known has name and text; a template
    without words or name is none, and of repeated names each text is a form of its own."""
    notices = with_shingles((templates(docs.sparkSession) if known is None else known.select("name", "text")).where("name is not null and text is not null").distinct()).where(F.size("__h") > 0)
    index = with_bands(notices.withColumn("hashes", F.col("__h")), F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("__h") - WINDOW))).select("name", "hashes", F.col("value").alias("known")).distinct()
    # Bands hash differently, so equal values are of one band but by an accident, which the verification drops. What is
    # broadcast has about INDEX shingles at a time: a longer list is taken in parts, each with a scan of its own.
    parts = int(-(-(notices.agg(F.sum(F.size("__h"))).first()[0] or 0) // INDEX)) or 1
    index = materialise(index.withColumn("part", F.pmod(F.xxhash64("name", "hashes"), F.lit(parts))), "license-index")
    own = with_bands(with_shingles(with_text(docs).withColumn("text_hash", F.xxhash64("text"))), F.when(F.size("__h") > 0, F.sequence(F.lit(0), F.size("__h") - 1, F.lit(STRIDE))))
    found = reduce(DataFrame.unionByName, (_verified(own, index.where(F.col("part") == i)) for i in range(parts)))
    return found.groupBy("doc_id", "text_hash", "name").agg(F.max("containment").alias("containment"))


def _verified(own: DataFrame, index: DataFrame) -> DataFrame:
    values = index.select("name", F.xxhash64("name", "hashes").alias("tid"), "known")
    notices = index.select(F.xxhash64("name", "hashes").alias("tid"), "hashes").distinct()
    found = own.join(F.broadcast(values), F.col("value") == F.col("known")).join(F.broadcast(notices), "tid")
    # A window names each of its templates once: the bands that agree are one retrieval.
    reach = 2 * F.size("hashes") + WINDOW
    first = F.greatest(F.lit(0), F.col("at") - reach)
    around = F.slice("__h", first + 1, F.col("at") - first + reach)
    share = F.size(F.array_intersect(F.col("hashes"), around)) / F.size(F.array_distinct("hashes"))
    return found.select("doc_id", "text_hash", "name", share.alias("containment")).where(F.col("containment") >= CONTAINMENT)


def report(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """A row a document: doc_id, n_licenses, licenses (names in order, comma-joined)."""
    names = F.sort_array(F.collect_set("name"))
    per = matches(docs, known).groupBy("doc_id", "text_hash").agg(names.alias("names")).withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    rows = with_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"))
    joined = rows.join(per, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    return joined.select("doc_id", F.when(F.col("names").isNotNull(), F.size("names")).otherwise(0).cast("long").alias("n_licenses"), F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"))


def _sql() -> str:
    values = ", ".join("('{}', '{}')".format(n, " ".join(re.findall("[a-z0-9]+", t.lower()))) for n, t in sorted(TEMPLATES.items()))
    return f"""
WITH t AS (SELECT name, string_split(words, ' ') AS w FROM (VALUES {values}) AS v(name, words)),
ts AS (SELECT DISTINCT name, array_to_string(list_slice(w, s, s + {SHINGLE - 1}), ' ') AS g FROM (SELECT name, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS s FROM t)),
size AS (SELECT name, count(*) AS n FROM ts GROUP BY name),
len AS (SELECT name, greatest(len(w) - {SHINGLE - 1}, 1) AS k FROM t),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z0-9]+') AS w FROM documents),
ds AS (SELECT r, s - 1 AS p, array_to_string(list_slice(w, s, s + {SHINGLE - 1}), ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
hit AS (SELECT r, name, p, g FROM ds JOIN ts USING (g)),
win AS (SELECT DISTINCT r, name, a FROM (SELECT r, name, unnest(range(greatest(0, p - {WINDOW - 1}), p + 1)) AS a FROM hit) WHERE a % {STRIDE} = 0),
near AS (SELECT win.r, win.name, a, count(DISTINCT g) AS c FROM win JOIN hit ON win.r = hit.r AND win.name = hit.name JOIN len ON len.name = win.name
  WHERE p >= a - 2 * k - {WINDOW} AND p < a + 2 * k + {WINDOW} GROUP BY ALL),
ok AS (SELECT DISTINCT r, name FROM near JOIN size USING (name) WHERE c::DOUBLE / n >= {CONTAINMENT}),
per AS (SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM ok GROUP BY r)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(names, '') AS licenses FROM d LEFT JOIN per USING (r)
"""


SQL = _sql()
