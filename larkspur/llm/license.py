"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Words are lower-cased runs without ASCII punctuation or space; a shingle is five words, named by its 64-bit hash. Templates
of n shingles are looked for in windows of w shingles, w the smallest power of two with n <= 3w/4, that start at every
multiple of w/4, so some window holds any occurrence whole. ``BANDS`` bands of one coordinate each make collisions likely: a
window that holds 75 % of a template has a Jaccard similarity of 0.25 or more with it, so all bands miss with probability
below 0.75**32 = 0.0001 (copies of a whole template: below 1e-7).

A band of window and template collides exactly if the template's least shingle of that coordinate occurs in the window and is
least there too. So only windows around occurrences of such shingles are cut out, once for each text and window, and hashed; nothing
else can collide, and no window leaves its task. Each window length has its own windows, so a short notice never carries the wide
window of a whole licence text.

Templates are a parameter, held by the driver; they are broadcast in groups of at most ``GROUP`` templates and ``GROUP_SHINGLES``
shingles, one pass over the texts for each group.

Edge cases: null or empty texts, and texts under five words, match nothing. Repeated rows of a document give one row. A null
doc_id is reported as such. Templates under five words are refused, as is more than one template of a name. Of equally good
windows the first counts. Other columns are ignored; an empty table gives an empty result, and so does an empty list of templates.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS, BANDS, CONTAINMENT_PERCENT = 5, 32, 75
#: Templates and their shingles that are looked for, and broadcast, at a time.
GROUP, GROUP_SHINGLES = 1000, 1 << 20
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The wording of public licence notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd-redistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


# The wording of whole public licence texts.
TEMPLATES += [
    (
        "bsd-2-clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "zlib-text",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ),
]


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(templates, "license_id string, text string")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for a row."""
    return F.get(F.transform(F.array(value), body), 0)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SEPARATORS), "")


def _shingles(words: Column) -> Column:
    last = F.size(words) - SHINGLE_WORDS
    hashed = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE_WORDS)]))
    return F.when(last >= 0, hashed).otherwise(F.array().cast("array<bigint>"))


def shingles(text: Column) -> Column:
    """64-bit hashes of the five-word shingles, in order."""
    return _let(_words(text), _shingles)


def window_of(n: int) -> int:
    """Window length for a template of n shingles."""
    w = 2
    while n > 3 * w // 4:
        w *= 2
    return w


_RESULT = "license_id string, matched long, n_template long, containment double, window_start long"


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = CONTAINMENT_PERCENT, bands: int = BANDS) -> DataFrame:
    """id, license_id, matched (template shingles in the best window), n_template, containment and window_start (in shingles,
    of the first best window) for every template that some window of the text holds to ``percent``."""
    held = templates.select("license_id", shingles(F.col("text")).alias("items")).orderBy("license_id").collect()
    if any(not r["items"] for r in held):
        raise ValueError(f"a template has fewer than {SHINGLE_WORDS} words")
    if len({r.license_id for r in held}) < len(held):
        raise ValueError("two templates have one name")
    found = docs.select(F.col(id_col).alias("id")).limit(0).selectExpr("id", *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in (x.split() for x in _RESULT.split(", "))])
    for group in _groups([(r.license_id, sorted(set(r["items"])), window_of(len(r["items"]))) for r in held]):
        found = found.unionByName(_scan_group(docs, group, id_col, text_col, percent, bands))
    return found.withColumnRenamed("id", id_col)


def _groups(templates: list[tuple]) -> Iterator[list[tuple]]:
    group, size = [], 0
    for t in templates:
        if group and (len(group) == GROUP or size + len(t[1]) > GROUP_SHINGLES):
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t[1])
    if group:
        yield group


def _scan_group(docs: DataFrame, group: list[tuple[str, list[int], int]], id_col: str, text_col: str, percent: int, bands: int) -> DataFrame:
    """:func:`scan` for one group of templates (name, shingles, window length)."""
    spark = docs.sparkSession
    table = spark.createDataFrame([(k, *t, len(t[1])) for k, t in enumerate(group)], "t int, license_id string, items array<bigint>, w int, n_template bigint")
    coordinate = F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")
    by_band = table.select("t", "w", "items", coordinate).withColumn("least", F.array_min(F.transform("items", lambda x: F.struct(F.xxhash64(x, "band").alias("h"), x.alias("x")))))
    keys = by_band.select(F.col("least.x").alias("item"), "w", "t", "band", F.col("least.h").alias("least")).collect()  # GROUP * bands at most
    wanted = {w: sorted({r.item for r in keys if r.w == w}) for w in sorted({r.w for r in keys})}
    every = sorted({r.item for r in keys})

    def cut(hashes: Column, places: Column, w: int) -> Column:
        """All windows of ``w`` shingles that hold a shingle wanted for that length, each once."""
        stride = max(1, w // 4)
        mine = F.filter(places, lambda i: F.get(hashes, i).isin(wanted[w]))
        around = lambda i: F.sequence(F.greatest(F.ceil((i - w + 1) / stride).cast("int"), F.lit(0)), F.floor(i / stride).cast("int"))
        starts = F.array_distinct(F.flatten(F.transform(mine, lambda i: F.transform(around(i), lambda k: k * stride))))
        return F.transform(starts, lambda at: F.struct(F.lit(w).alias("w"), at.alias("start"), F.slice(hashes, at + 1, w).alias("window")))

    def windows(hashes: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.get(hashes, i).isin(every))
        some = _let(places, lambda p: F.flatten(F.array(*[cut(hashes, p, w) for w in wanted])))
        return F.when(F.size(hashes) > 0, some).otherwise(F.slice(some, 1, 0))

    met = docs.select(F.col(id_col).alias("id"), F.explode(_let(shingles(F.col(text_col)), windows)).alias("m")).select("id", "m.*")
    # The wanted shingles of a window name the templates and bands that may collide; a band does if no shingle of the window comes first.
    asked = met.select("id", "w", "start", "window", F.explode(F.array_distinct(F.filter("window", lambda x: x.isin(every)))).alias("item"))
    by_item = spark.createDataFrame(keys, "item bigint, w int, t int, band int, least bigint").groupBy("item", "w").agg(F.collect_list(F.struct("t", "band", "least")).alias("keys"))
    hit = asked.join(F.broadcast(by_item), ["item", "w"]).withColumn("keys", F.filter("keys", lambda k: ~F.exists("window", lambda x: F.xxhash64(x, k["band"]) < k["least"])))
    collided = hit.select("id", "start", "window", F.explode(F.array_distinct(F.transform("keys", lambda k: k["t"]))).alias("t"))
    sized = table.select("t", "license_id", "items", "n_template")
    checked = collided.join(F.broadcast(sized), "t").select("id", "license_id", "start", "n_template", F.size(F.array_intersect("window", "items")).cast("long").alias("matched"))
    good = checked.where(F.col("matched") * 100 >= F.col("n_template") * percent)
    best = good.groupBy("id", "license_id", "n_template").agg(F.max("matched").alias("matched"), F.min_by("start", F.struct(-F.col("matched"), "start")).alias("window_start"))
    return best.select("id", "license_id", "matched", "n_template", (F.col("matched") / F.col("n_template")).alias("containment"), F.col("window_start").cast("long").alias("window_start"))
