"""License scans: MinHash bands over text windows retrieve templates, exact shingle containment verifies them.

A template of m five-word shingles is looked for in windows of m shingles, laid every max(1, m // 8). A
window that holds four fifths of a template at the nearest place has a Jaccard similarity of at least 0.6
with it, so that 16 bands of 2 rows miss it with a probability of (1 - 0.6**2)**16 < 0.1 %; a verbatim copy
(0.88 and more) is missed with one below 1e-10.

A window's minimum can equal the template's under one of the functions only if the window holds the very
shingle that has the template's minimum. So every window of the grid that holds such a key shingle is laid,
once, from the first one that it holds; no other window can agree with the template in a band. DataFrame
functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS, BANDS, ROWS, CONTAINMENT = 5, 16, 2, 0.8
MAX_KEYS = 200_000  # of the catalogue; beyond it the key join shuffles

# Public notices and licence passages.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-licensed": "This project is licensed under the MIT License",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1-notice": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0-notice": "Licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "BSD-style-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "ISC-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "Apache-2.0-copyright-grant": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    "GPL-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "GPL-no-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Unlicense-dedication": "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value taken once: the optimiser would write it out at each use, also within loops."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case; none: an empty array."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """A 64-bit hash of each five-word shingle, in order; none below five words."""

    def hashed(w: Column) -> Column:
        found = F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WORDS))))
        return F.when(F.size(w) >= WORDS, found).otherwise(F.array().cast("array<bigint>"))

    return bound(words, hashed)


def signature(window: Column) -> Column:
    return bound(window, lambda w: F.transform(F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)), lambda j: F.array_min(F.transform(w, lambda h: F.xxhash64(h, j)))))


def band_hit(a: Column, b: Column) -> Column:
    """Whether two signatures agree in all rows of some band."""
    return bound(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda e: F.exists(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.forall(F.slice(e, k * ROWS + 1, ROWS), lambda x: x)))


def band_keys(window: Column, mins: Column) -> Column:
    """Whether a window holds all key shingles of some band; without them it can't agree with the template in that band."""
    has = lambda w, j: F.array_contains(w, F.get(mins, j))
    return bound(F.array_intersect(window, mins), lambda w: F.exists(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.forall(F.sequence(k * ROWS, k * ROWS + ROWS - 1), lambda j: has(w, j))))


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    """license_id, hashes (distinct shingles in order), size, step, signature. Templates below five words are refused."""
    items = TEMPLATES if templates is None else templates
    rows = F.explode(F.map_from_entries(F.array(*(F.struct(F.lit(k), F.lit(v)) for k, v in items.items()))) if items else F.create_map().cast("map<string,string>"))
    found = spark.range(1).select(rows.alias("license_id", "template"))
    found = found.select("license_id", words_of(F.col("template")).alias("words")).select("license_id", shingle_hashes(F.col("words")).alias("all"))
    found = found.select("license_id", F.array_distinct("all").alias("hashes"), F.size("all").alias("size"), F.when(F.size("all") == 0, F.raise_error(F.concat(F.lit("template below five words: "), F.col("license_id")))).otherwise(F.greatest(F.lit(1), F.expr("size(all) div 8"))).alias("step"))
    return found.withColumn("signature", signature(F.col("hashes")))


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document and license found: doc_id, license_id, containment, n_windows, first_word.

    containment is the greatest share of the template's distinct shingles in one window, widened by a step on
    either side; rows of 0.8 or more are returned. A null, empty or shorter text gives none. Rows that repeat
    an id are taken together; a null id is an id of its own. A very long text costs its shingles, and what lies around
    each key that it holds. Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    least = lambda j: F.array_min(F.transform("hashes", lambda h: F.struct(F.xxhash64(h, j).alias("hash"), h.alias("h"))))["h"]
    mins = F.transform(F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)), least)
    known = known.withColumn("mins", mins)
    keys = known.select("*", F.explode(F.array_distinct("mins")).alias("key"))
    reach = F.col("size") + F.col("step")  # a window that holds the key lies within so many places of it, and so does its margin
    literal = keys.groupBy("key").agg(F.max(reach).alias("reach")).collect()  # of the catalogue, not of the data
    small = len(literal) <= MAX_KEYS
    # exploding one array is a barrier: the shingles are hashed once, not again in the filter
    shingles = F.explode(F.array(shingle_hashes(words_of(F.col(text_column)))))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), shingles.alias("shingles"))

    def around(i: Column, reach: Column) -> list[Column]:
        """The shingles that far around a hit, and the place of the first: a hit carries these, not the whole text's."""
        low = F.greatest(F.lit(0), i - reach)
        return [low.alias("low"), F.slice("shingles", low + 1, 2 * reach + 1).alias("near")]

    if small:
        wanted = F.array(*(F.lit(r.key) for r in literal)).cast("array<bigint>")
        reaches = F.create_map(*(x for r in literal for x in (F.lit(r.key), F.lit(r.reach)))) if literal else F.create_map().cast("map<bigint,int>")
        rows = rows.where(F.arrays_overlap("shingles", wanted))
        hit = lambda h, i: bound(F.element_at(reaches, h), lambda r: F.struct(i.alias("i"), h.alias("key"), *around(i, r)))
        at = bound(F.array_intersect("shingles", wanted), lambda present: F.filter(F.transform("shingles", lambda h, i: F.when(F.array_contains(present, h), hit(h, i))), lambda x: x.isNotNull()))
        laid = rows.select("doc_id", F.explode(at).alias("hit")).select("doc_id", "hit.*").join(F.broadcast(keys), "key")
    else:
        hits = rows.select("doc_id", "shingles", F.posexplode("shingles").alias("i", "key"))
        laid = hits.join(keys, "key").select("*", *around(F.col("i"), reach)).drop("shingles")
    # the windows that hold this key and none of the licence's keys before it
    part = lambda start, n: F.slice("near", start - F.col("low") + 1, n)
    first = F.greatest(F.lit(0), F.col("i") - F.col("size") + 1)
    last = F.coalesce(F.array_max(F.transform(part(first, F.col("i") - first), lambda h, k: F.when(F.array_contains("mins", h), k))), F.lit(-1))
    start = F.explode(F.expr("filter(transform(sequence(0, (i - first) div step + 1), k -> step * ((first + step - 1) div step + k)), s -> s <= i)"))
    laid = laid.withColumn("first", first + last + 1).withColumn("start", start).withColumn("window", part(F.col("start"), F.col("size")))
    near = laid.where(band_keys(F.col("window"), F.col("mins"))).where(band_hit(signature(F.col("window")), F.col("signature")))
    low = F.greatest(F.lit(0), F.col("start") - F.col("step"))
    wide = part(low, F.col("start") + F.col("size") + F.col("step") - low)
    share = F.size(F.array_intersect("hashes", wide)) / F.size("hashes")
    exact = near.select("doc_id", "license_id", "start", share.alias("containment")).where(F.col("containment") >= CONTAINMENT)
    return exact.groupBy("doc_id", "license_id").agg(F.max("containment").alias("containment"), F.count_distinct("start").alias("n_windows"), F.min("start").cast("long").alias("first_word"))
