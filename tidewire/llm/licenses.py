"""License scan: MinHash bands over overlapping windows of a text retrieve templates, exact containment verifies them.

DataFrame functions only. Words are lowered runs of letters, digits and points; a shingle is a hash of three words. The
templates are a table of texts of any length. A template and a text are cut into windows of ``WIDE`` shingles, one at
every shingle; a template of fewer shingles is one window, and texts have windows of its width, too. Of each window the
least values of ``ROWS`` hash functions are one of ``BANDS`` bands, so two windows that share the part J of their
shingles meet with probability 1 - (1 - J ** ROWS) ** BANDS: equal ones always, at J = 3/5 with 0.83.

Every window that begins with a shingle of some template and holds at least half of such ones is hashed; a window with
less can't share half of its shingles with a template's. So near windows, with words changed or lines moved inside them,
reach the bands as well as equal ones. A bit mask tells the templates' shingles: each has ``MARKS`` bits in it of
``MASK_BITS``, so one in 60,000 others passes (more only if ``MOST_BITS`` are too few), which costs work, not results.
A template of which ``LEAST`` is left has four shingles in a row left, as runs of three with one lost between them would
leave 3/4: where those stand together in the text, it is met for certain, and elsewhere by its many near windows.

A template is found if its exact containment, the share of its distinct shingles in the stretch of three of its lengths
around a window that met, is at least ``LEAST``. Only rows and places go through the join of bands; texts join again
for those that met. Defined results: a null or empty text has no match; every row is scanned by itself, also where ids
repeat or are null; a template without words is never found.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.sources.shared_folder import written

WIDE, BANDS, ROWS, LEAST = 4, 4, 2, 0.8
MASK_BITS, MOST_BITS, MARKS = 64, 1 << 24, 4

# Texts by which well-known licenses are declared or granted.
TEMPLATES = {
    "apache-2.0/line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0/notice": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License",
    "mit/line": "Released under the MIT License",
    "mit/line-2": "Licensed under the MIT License",
    "mit/grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "gpl-3.0/line": "This work is licensed under the GNU General Public License, version 3",
    "gpl/notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl/notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "bsd/grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc/grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0/notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense/grant": "This is free and unencumbered software released into the public domain",
    "cc-by-nc-4.0/line": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0/line": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0/line": "Licensed under CC BY-SA 4.0",
    "cc-by/long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "all-rights-reserved": "All rights reserved",
    "mit/full": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-2-clause/full": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY
THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "zlib/full": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of
this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software. 3. This notice may not be removed or altered from any source distribution.""",
}


def shingled(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with the hashes of every three words in a row; of all words, if they are fewer; null without words.

    Words come first as a column of their own: within the lambda they would be split anew for every word.
    """
    words = F.transform(F.split(F.lower(text), "[^\\p{L}\\p{N}.]+"), lambda w: F.rtrim(w, F.lit(".")))
    words = df.withColumn("_words", F.array_remove(words, ""))
    w = F.col("_words")
    several = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    return words.withColumn(name, F.when(F.size(w) >= 3, several).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))).drop("_words")


def _bands(window: Column, width: Column) -> Column:
    """One key for each band: the least hashes of the window's shingles by its functions."""

    def least(f: int) -> Column:
        return F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.lit(f))))

    return F.array(*(F.xxhash64(width, F.lit(b), *(least(b * ROWS + r) for r in range(ROWS))) for b in range(BANDS)))


def _mask(known: DataFrame) -> tuple[Column, int]:
    """Bits of the templates' shingles as an array of 64-bit words, and their number; ``MOST_BITS`` bound what the driver gets."""
    total = known.agg(F.sum(F.size("t_shingles"))).first()[0]
    bits = min(MOST_BITS, 1 << max(10, math.ceil(math.log2(MASK_BITS * total))))
    marked = known.select(F.explode("t_shingles").alias("x")).select(F.explode(F.array(*_marks(F.col("x"), bits))).alias("bit"))
    words = np.zeros(bits // 64, np.int64)
    for r in marked.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("set")).collect():
        words[r["word"]] = r["set"]
    return F.lit(words), bits


def _marks(shingle: Column, bits: int) -> list[Column]:
    """The bits of a shingle in the mask, from different parts of its hash."""
    return [F.pmod(F.shiftright(shingle, 13 * i), F.lit(bits)) for i in range(MARKS)]


def scan(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(doc_id, license, containment, word) of every template found in a text: the best containment and where it first has it.

    ``templates``: names and texts, or a table (license, text) of them.
    """
    spark = docs.sparkSession
    if not isinstance(templates, DataFrame):
        templates = spark.createDataFrame(list((TEMPLATES if templates is None else templates).items()), "license string, text string")
    known = written(shingled(templates.select("license", "text"), F.col("text"), "t_shingles").where("t_shingles is not null").select("license", "t_shingles"), "templates")
    widths = [r["w"] for r in known.select(F.least(F.size("t_shingles"), F.lit(WIDE)).alias("w")).distinct().collect()]
    if not widths:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).alias("word")).limit(0)
    width = F.least(F.size("t_shingles"), F.lit(WIDE))
    cut = known.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("t_shingles") - width + 1)))
    # Tables of their own: broadcast by their size on disk, or joined by shuffle if they are large.
    bands = written(cut.select("license", F.size("t_shingles").alias("long"), F.explode(_bands(F.slice("t_shingles", F.col("at"), width), width)).alias("band")).distinct(), "bands")

    mask, bits = _mask(known)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = shingled(texts, F.col("text"), "s").select("doc_id", "s")
    is_set = lambda bit: F.bit_get(F.get(mask, F.shiftright(bit, 6).cast("int")), (bit % 64).cast("int")) == 1
    known_bit = lambda x: reduce(lambda a, b: a & b, map(is_set, _marks(x, bits)))
    # The row's number keeps filters, and with them the work above, from being repeated below this point.
    hits = texts.select("doc_id", "s", F.array_compact(F.transform("s", lambda x, i: F.when(known_bit(x), i))).alias("hits"), F.monotonically_increasing_id().alias("row"))
    near = lambda w: F.filter("hits", lambda p, i: F.coalesce(F.get("hits", i + (w + 1) // 2 - 1) <= p + w - 1, F.lit(False)))
    placed_by = lambda w: F.transform(near(w), lambda p: F.struct(p.alias("start"), F.lit(w).alias("width")))
    windows = F.concat(*map(placed_by, sorted(widths)))
    hits = written(hits.where("size(hits) > 0").select("row", "doc_id", "s", windows.alias("windows")).where("size(windows) > 0"), "hits")
    placed = hits.select("row", "s", F.explode("windows").alias("w"))
    keyed = placed.select("row", F.col("w.start").alias("start"), F.explode(_bands(F.slice("s", F.col("w.start") + 1, F.col("w.width")), F.col("w.width"))).alias("band"))
    # Of each template's length one stretch is looked at once.
    met = keyed.join(bands, "band").select("row", "license", F.floor(F.col("start") / F.col("long")).cast("int").alias("stretch")).distinct()
    found = met.join(hits.select("row", "doc_id", "s"), "row").join(known, "license")
    long = F.size("t_shingles")
    begin = F.greatest((F.col("stretch") - 1) * long, F.lit(0))
    found = found.select("row", "doc_id", "license", "t_shingles", begin.alias("begin"), F.slice("s", begin + 1, (F.col("stretch") + 2) * long - begin).alias("region"))
    inside = F.size(F.array_intersect("t_shingles", "region")) / F.size(F.array_distinct("t_shingles"))
    first = F.array_min(F.transform("t_shingles", lambda t: F.nullif(F.array_position("region", t), F.lit(0).cast("bigint"))))
    checked = found.select("row", "doc_id", "license", inside.alias("containment"), (F.col("begin") + first - 1).cast("int").alias("word"))
    return checked.where(F.col("containment") >= least).groupBy("row", "doc_id", "license").agg(F.max("containment").alias("containment"), F.min_by("word", F.struct(-F.col("containment"), "word")).alias("word")).drop("row")
