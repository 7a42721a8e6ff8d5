"""Licence scan: TF-IDF cosine of headers and licence files to templates, then directory inheritance.

Every line, every block of lines between blank ones and the whole of each text
are compared with templates as sparse vectors of term frequency times inverse
document frequency. Frequencies of the templates' terms are counted over all
files; a term that no template has weighs as one that no file has. As a unit's
terms outside the templates add to its length alone, its cosine is at most the
root of its share of template terms, which leaves few units to compare; texts
are read once. A file without a licence of its own takes that of the nearest
directory above it that has a licence file. DataFrame functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import sized, written

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""

_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

#: One-line notices, file headers and full texts by which works state their licences, with SPDX names.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", f"{_BSD2}\n\n{_BSD_END}"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License."),
    ("BSD-3-Clause", f"{_BSD2}\n\n{_BSD3}\n\n{_BSD_END}"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", _ISC),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", _MIT),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
#: Terms that say nothing about a licence.
COMMON = ("a", "an", "and", "are", "as", "be", "for", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "with")
THRESHOLD = 0.6
#: A file with this share of its words in its licence unit is its directory's licence file.
FILE_SHARE = 0.1
#: What lies between terms.
NO_TERM = r"[^a-z0-9]+"
#: Parts of a text, by the pattern between them.
LINE, BLOCK = r"\n", r"\n[ \t\r]*\n"

Templates = tuple[tuple[str, str], ...]


def template_terms(templates: Templates) -> list[tuple[int, str, str, int]]:
    """(number, licence, term, count) of the templates; they are a short list that the driver holds."""
    rows = []
    for i, (licence, notice) in enumerate(templates):
        terms = [t for t in re.split(NO_TERM, notice.lower()) if t and t not in COMMON]
        rows += [(i, licence, t, terms.count(t)) for t in sorted(set(terms))]
    return rows


def _terms(unit: Column) -> Column:
    return F.filter(F.split(F.lower(unit), NO_TERM), lambda t: (t != "") & ~t.isin(*COMMON))


def _squares(terms: Column) -> Column:
    """Sum of the squared counts of the terms of a sorted array."""
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).cast("long").alias("sum"))

    def step(s: Column, t: Column) -> Column:
        run = F.when(s["last"] == t, s["run"] + 1).otherwise(1)
        return F.struct(t.alias("last"), run.alias("run"), (s["sum"] + 2 * run - 1).alias("sum"))

    return F.aggregate(F.array_sort(terms), start, step, lambda s: s["sum"])


def _words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[ \t\r\n]+"), lambda w: w != ""))


def _within_reach(unit: Column, known: list[str], threshold: float) -> Column:
    """Whether a unit's share of template terms allows a cosine of ``threshold``; any weights of the terms are at most equal."""

    def share(terms: Column) -> Column:
        mine, other = F.filter(terms, lambda t: t.isin(*known)), F.filter(terms, lambda t: ~t.isin(*known))
        return F.when(F.size(mine) == 0, False).otherwise(_squares(mine) * (1 - threshold**2) >= _squares(other) * threshold**2)

    # a one-element array binds the terms, which are worked out once
    return F.transform(F.array(_terms(unit)), share)[0]


def unit_licences(units: DataFrame, frequency: DataFrame, n_files: Column | int, templates: Templates, threshold: float = THRESHOLD) -> DataFrame:
    """``units`` (unit), each once, to (unit, licence, score) of the nearest template; ties to the first licence by name.

    ``frequency`` has term and df, the number of files that a template's term is in.
    """
    spark = units.sparkSession
    total = F.lit(n_files)
    top = F.log(1 + total) + 1
    idf = F.log((1 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1
    rows = spark.createDataFrame(template_terms(templates), "number int, licence string, term string, n int")
    weighed = rows.join(F.broadcast(frequency), "term", "left").select("number", "licence", "term", (F.col("n") * idf).alias("v"), idf.alias("idf"))
    norms = weighed.groupBy("number").agg(F.sqrt(F.sum(F.col("v") ** 2)).alias("norm"))
    # a template has a few hundred terms at most
    notice = weighed.join(norms, "number").select("number", "licence", "term", "idf", (F.col("v") / F.col("norm")).alias("v"))
    counts = units.select("unit", F.explode(_terms(F.col("unit"))).alias("term")).groupBy("unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = counts.join(F.broadcast(notice.select("term", "idf").distinct()), "term", "left").select("unit", "term", (F.col("tf") * F.coalesce("idf", top)).alias("w"))
    length = known.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("length"))
    dots = known.join(F.broadcast(notice.drop("idf")), "term").groupBy("unit", "number", "licence").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = dots.join(length, "unit").select("unit", "licence", F.round(F.col("dot") / F.col("length"), 9).alias("score"))
    best = cosine.groupBy("unit").agg(F.min(F.struct(-F.col("score"), "licence")).alias("b"))
    return best.select("unit", F.col("b.licence").alias("licence"), (-F.col("b.col1")).alias("score")).where(F.col("score") >= threshold)


def scan_licenses(files: DataFrame, path: str, text: str, templates: Templates = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``files`` without text, with licence, score and origin.

    The whole text is looked at. A file's own licence is that of its best unit,
    the longer one of equals; origin is own, inherited (from the nearest
    directory above, its own first; '' is above relative paths) or none. Of
    several licence files in a directory the first path holds. Repeated paths
    share the best licence of any. A null path has no directory, and a null or
    empty text no licence; rows of null paths keep their own. Columns of these
    names are replaced.
    """
    names = ("licence", "score", "origin")
    rest = [c for c in files.columns if c not in (*names, text)]
    known = sorted({t for _, _, t, _ in template_terms(templates)})
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    parts = F.array_distinct(F.concat(F.split(own, LINE), F.split(own, BLOCK), F.array(own)))
    none = F.array().cast("array<string>")

    def looked_at(terms: Column) -> Column:
        """Template terms of the text, its units within reach and its number of words; a text without such terms has no units."""
        units = F.when(F.size(terms) > 0, F.filter(parts, lambda u: _within_reach(u, known, threshold))).otherwise(none)
        return F.transform(F.array(units), lambda u: F.struct(terms.alias("terms"), u.alias("units"), F.when(F.size(u) > 0, _words(own)).alias("words")))[0]

    rows = files.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)],
        F.col(f"`{path}`").cast("string").alias("path"),
        F.monotonically_increasing_id().alias("row"),
        F.transform(F.array(F.array_intersect(F.split(F.lower(own), NO_TERM), F.array(*map(F.lit, known)))), looked_at)[0].alias("l"),
    )
    rows = written(rows.select("*", "l.*").drop("l"), "files")
    n_files = rows.count()
    frequency = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    found = rows.where(F.size("units") > 0).select("row", "path", "words", F.explode("units").alias("unit"))
    matched = sized(written(unit_licences(found.select("unit").distinct(), frequency, n_files, templates, threshold), "matched"))
    # a null path is a file by itself
    key = F.coalesce(F.concat(F.lit("p"), "path"), F.col("row").cast("string"))
    best = found.join(matched, "unit").groupBy(key.alias("file")).agg(
        F.first("path").alias("path"), F.min(F.struct(-F.col("score"), -F.length("unit"), "licence", "unit")).alias("b"), F.max("words").alias("words")
    )
    best = best.select("file", "path", F.col("b.licence").alias("own"), (-F.col("b.col1")).alias("own_score"), (_words(F.col("b.unit")) >= FILE_SHARE * F.col("words")).alias("is_file"))
    best = written(best, "own")
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    by_dir = best.where("is_file and path is not null").withColumn("dir", parent).groupBy("dir").agg(F.min_by(F.struct("own", "own_score"), "path").alias("l"))
    # directories above each directory that has files; far fewer than files
    dirs = rows.where("path is not null").select(parent.alias("dir")).distinct()
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, F.lit(1), k), "/").alias("up")))
    above = dirs.select("dir", F.explode(F.array_distinct(F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("up"))), above))).alias("a"))
    nearest = above.select("dir", "a.depth", F.col("a.up").alias("up")).join(by_dir.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max_by("l", "depth").alias("l"))
    slim = rows.drop("units", "terms", "words").withColumns({"dir": F.when(F.col("path").isNotNull(), parent), "file": key})
    out = slim.join(best.select("file", "own", "own_score"), "file", "left").join(nearest, "dir", "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("l").isNotNull(), "inherited").otherwise("none")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.coalesce("own", "l.own").alias("licence"), F.coalesce("own_score", "l.own_score").alias("score"), origin.alias("origin"))
