"""Licences of files: TF-IDF cosine of notices to templates, then inheritance down the folders; Spark columns only.

A notice is a maximal run of neighbouring lines, anywhere in the whole text, each with at
least half of its words in the vocabulary of the templates, that holds a licence word. Every
notice, and the whole text of a file named like a licence file, is compared with every
template: both are sparse vectors of term counts times inverse template frequency, joined on
terms. The best template at or above the threshold is the file's own licence. A licence file
speaks for its folder; a file without a licence of its own takes that of the nearest folder
above it that has one, found by joining folder paths.

The templates are constants (one-line notices, standard headers, and texts of long licences), so
broadcasting their terms is bounded. Ancestors are resolved
once for each distinct folder, not for each file; files join their folder with Spark's
splitting of skewed keys.

Defined cases: NULL text has no notice; NULL path has no folder and inherits nothing; ties of
score go to the template first in order, ties of licence files in a folder to the better
score, then to the licence first in order; rows that agree in path and text are one file
given twice and get the same answer; an empty table gives an empty result; columns of any
other name pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm import tables

#: Least cosine of a match.
THRESHOLD = 0.5
#: Least share of a line's words that the templates use.
FAMILIAR = 0.5

# Names of licences and the wording by which they are declared.
NOTICES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License. Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal public domain dedication."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Licensed under the ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. The Unlicense."),
]
TEMPLATES = [(i, name, text) for i, (name, text) in enumerate(NOTICES + [(name, f"SPDX-License-Identifier: {name}") for name in sorted({n for n, _ in NOTICES})])]
TRIGGERS = ["license", "licence", "licensed", "licensing", "unlicense", "licenses", "copyright", "spdx-license-identifier", "permission"]
TERM = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(UPPER, LOWER)
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.-][^/]*)?$"
MAY_HOLD = r"(?i)licen[cs]|copyright|permission"


def _gnu(subject: str, name: str, version: str, later: bool = True) -> list[str]:
    """The standard header of a GNU licence: its first paragraph, which holds name and version, and the whole of it."""
    grant = f"This {subject} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation"
    grant += f", either version {version} of the License, or (at your option) any later version." if later else f", version {version} of the License."
    rest = (f"This {subject} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
            f"See the GNU {name} for more details.")
    copy = f"You should have received a copy of the GNU {name} along with this {subject}."
    return [grant, f"{grant} {rest}", f"{grant} {rest} {copy} If not, see https://www.gnu.org/licenses/."]


_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_3 = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = (' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS '
            "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, "
            "BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
            "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT_END = (' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_END = (' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE '
            "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_MIT, _ISC = (next(text for name, text in NOTICES if name == x and "Permission" in text) for x in ("MIT", "ISC"))
_CC = {"CC-BY-4.0": "Attribution", "CC-BY-NC-4.0": "Attribution-NonCommercial", "CC-BY-SA-4.0": "Attribution-ShareAlike"}
_GNU = {"AGPL-3.0": ("program", "Affero General Public License", "3"), "GPL-2.0": ("program", "General Public License", "2"), "GPL-3.0": ("program", "General Public License", "3"),
        "LGPL-2.1": ("library", "Lesser General Public License", "2.1"), "LGPL-3.0": ("library", "Lesser General Public License", "3")}
#: Standard headers and short licence texts, which siblings have almost in common.
HEADERS = [
    *[(name, text) for name, own in _GNU.items() for later in (True, False) for text in _gnu(*own, later)],
    *[(name, f"SPDX-License-Identifier: {name}-{form}") for name in _GNU for form in ("only", "or-later")],
    ("LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1"), ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("BSD-2-Clause", _BSD), ("BSD-2-Clause", _BSD + _BSD_END), ("BSD-3-Clause", _BSD + _BSD_3), ("BSD-3-Clause", _BSD + _BSD_3 + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MIT", _MIT + _MIT_END), ("ISC", _ISC + _ISC_END),
    *[(name, f"This work is licensed under the Creative Commons {kind} 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/{name[3:-4].lower()}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.")
      for name, kind in _CC.items()],
    *[(name, f"Creative Commons {kind} 4.0 International Public License") for name, kind in _CC.items()],
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
TEXTS = Path(__file__).parent / "license_texts"


def all_templates() -> list[tuple[int, str, str]]:
    """TEMPLATES, then the headers, then the texts of long licences (by file name); TEMPLATES alone give idf and the vocabulary."""
    more = HEADERS + [(x.stem, x.read_text("utf-8")) for x in sorted(TEXTS.glob("*.txt"))]
    return TEMPLATES + [(len(TEMPLATES) + i, name, text) for i, (name, text) in enumerate(more)]


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({TERM})"), F.lit(1))


def _rare() -> Column:
    """Weight of a term that none of TEMPLATES has."""
    return F.log(F.lit((1 + len(TEMPLATES)) / 1.0)) + 1


def template_terms(spark: SparkSession) -> DataFrame:
    """template, license, term, weight (tf x idf) and norm: some thousand rows."""
    # A relation of the driver's, as text of this length does not belong into plans.
    rows = [(i, name, term, tf) for i, name, text in all_templates() for term, tf in Counter(re.findall(TERM, text.translate(_LOWERED))).items()]
    table = pa.table(dict(zip(("template", "license", "term", "tf"), zip(*rows, strict=True), strict=True)), pa.schema([("template", pa.int32()), ("license", pa.string()), ("term", pa.string()), ("tf", pa.int64())]))
    counts = spark.createDataFrame(table)
    idf = counts.where(F.col("template") < len(TEMPLATES)).groupBy("term").agg((F.log((1 + F.lit(len(TEMPLATES))) / (1 + F.count("*"))) + 1).alias("idf"))
    weighted = counts.join(idf, "term", "left").withColumn("idf", F.coalesce("idf", _rare())).withColumn("weight", F.col("tf") * F.col("idf"))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return weighted.join(norms, "template").select("template", "license", "term", "idf", "weight", "norm")


def vocabulary() -> list[str]:
    return sorted({x for _, _, text in TEMPLATES for x in re.findall(TERM, text.lower())})


def _uid() -> Column:
    return F.xxhash64("path", F.coalesce(F.col("text").cast("string"), F.lit("")))


def notices(files: DataFrame) -> DataFrame:
    """uid (of path and text), notice (number in the file; -1 for a whole licence file) and terms."""
    rows = files.select(_uid().alias("uid"), F.col("path").rlike(LICENSE_FILE).alias("whole"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("text").rlike(MAY_HOLD))
    lines = rows.select("uid", F.posexplode(F.split("text", "\n", -1)).alias("line", "body")).select("uid", "line", terms(F.col("body")).alias("terms"))
    known = F.array(*[F.lit(w) for w in vocabulary()])
    distinct = F.array_distinct("terms")
    lines = lines.where((F.size("terms") > 0) & (F.size(F.array_intersect(distinct, known)) >= FAMILIAR * F.size(distinct)))
    # Rows that agree in path and text share a uid; of each line one is kept, or their ranks would not be those of one file.
    lines = lines.distinct()
    # Neighbouring lines differ from their rank by the same number.
    ranked = lines.withColumn("run", F.col("line") - F.row_number().over(Window.partitionBy("uid").orderBy("line")))
    runs = ranked.groupBy("uid", "run").agg(F.min("line").alias("notice"), F.flatten(F.collect_list("terms")).alias("terms"))
    triggers = F.array(*[F.lit(w) for w in TRIGGERS])
    found = runs.where(F.arrays_overlap("terms", triggers)).select("uid", F.col("notice").cast("int").alias("notice"), "terms")
    return found.unionByName(rows.where("whole").select("uid", F.lit(-1).alias("notice"), terms(F.col("text")).alias("terms")))


def matches(files: DataFrame) -> DataFrame:
    """uid, notice, license and score: of each notice the best template, if it reaches the threshold."""
    spark = files.sparkSession
    words = template_terms(spark)
    found = notices(files).distinct().select("uid", "notice", F.explode("terms").alias("term")).groupBy("uid", "notice", "term").agg(F.count("*").alias("tf"))
    idf = words.select("term", "idf").distinct()
    # Terms of no template count in the norm with the weight of a term that no template has.
    weighted = found.join(F.broadcast(idf), "term", "left").withColumn("own", F.col("tf") * F.coalesce("idf", _rare())).drop("idf")
    norms = weighted.groupBy("uid", "notice").agg(F.sqrt(F.sum(F.col("own") * F.col("own"))).alias("own_norm"))
    dots = weighted.join(F.broadcast(words), "term").groupBy("uid", "notice", "template", "license", "norm").agg(F.sum(F.col("own") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, ["uid", "notice"]).withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("own_norm")), 6))
    best = scored.groupBy("uid", "notice").agg(F.max(F.struct("score", (-F.col("template")).alias("first"), "license")).alias("best"))
    return best.where(F.col("best.score") >= THRESHOLD).select("uid", "notice", "best.license", "best.score", (-F.col("best.first")).alias("template"))


def folder(path: Column) -> Column:
    """The path without its last part; '' at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame) -> DataFrame:
    """All rows and columns of `files` (path, text, ...) with own_license, own_score, license, folder_of_license."""
    uid, key, best, place, at, up = (tables.free(files.columns, x) for x in ("own uid", "uid", "best", "own folder", "folder", "up"))
    found = matches(files)
    own = found.groupBy(F.col("uid").alias(key)).agg(F.max(F.struct("score", (-F.col("template")).alias("first"), "license")).alias(best))
    named = files.withColumn(uid, _uid()).join(own, F.col(uid) == F.col(key), "left").withColumn(place, folder(F.col("path")))

    speaks = named.where(F.col("path").rlike(LICENSE_FILE) & F.col(best).isNotNull())
    holders = speaks.select(F.col(place).alias("above"), F.col(f"{best}.score").alias("score"), F.col(f"{best}.license").alias("license")).groupBy("above").agg(
        F.min(F.struct((-F.col("score")).alias("rank"), "license")).alias("x")).select("above", F.col("x.license").alias("license"))
    parts = F.split("dir", "/")
    # '' and every folder on the way down to `dir`, itself included, with its depth.
    way = F.transform(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts))), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    dirs = named.where(F.col(place).isNotNull()).select(F.col(place).alias("dir")).distinct()
    above = dirs.select("dir", F.explode(way).alias("x")).select("dir", "x.depth", "x.above")
    nearest = above.join(holders, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "license")).alias(up)).withColumnRenamed("dir", at)
    out = named.join(nearest, F.col(place) == F.col(at), "left")
    license = F.coalesce(F.col(f"{best}.license"), F.col(f"{up}.license"))
    given = F.when(F.col(best).isNull(), F.col(f"{up}.above"))
    kept = [F.col(f"`{c}`") for c in tables.others(files.columns, ["own_license", "own_score", "license", "folder_of_license"])]
    return out.select(*kept, F.col(f"{best}.license").alias("own_license"), F.col(f"{best}.score").alias("own_score"), license.alias("license"), given.alias("folder_of_license"))


def as_files(docs: DataFrame) -> DataFrame:
    """doc_id, path and text: documents as a tree of sources, shelves of 64, and files.

    The first document of a shelf is its licence file, every 64th of those that of its source.
    """
    shelf = F.floor(F.col("doc_id") / 64)
    name = (
        F.when(F.col("doc_id") % 4096 == 0, F.concat("source", F.lit("/LICENSE")))
        .when(F.col("doc_id") % 64 == 0, F.concat("source", F.lit("/"), shelf.cast("string"), F.lit("/LICENSE.txt")))
        .otherwise(F.concat("source", F.lit("/"), shelf.cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    )
    return docs.select("doc_id", name.alias("path"), "text")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(as_files(tables.read(spark, sf_dir, "documents"))).select("doc_id", "path", "own_license", "own_score", "license", "folder_of_license")


def _sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def cut(column: str) -> str:
        return f"regexp_extract_all(translate({column}, '{UPPER}', '{LOWER}'), '{TERM}')"

    values = ", ".join(f"({i}, {quoted(name)}, {quoted(text)})" for i, name, text in TEMPLATES)
    known = "[" + ", ".join(map(quoted, vocabulary())) + "]"
    triggers = "[" + ", ".join(map(quoted, TRIGGERS)) + "]"
    is_file = f"regexp_matches(path, '{LICENSE_FILE}')"
    n = len(TEMPLATES)
    return f"""
WITH file AS (
  SELECT doc_id, text, CASE WHEN doc_id % 4096 = 0 THEN source || '/LICENSE'
    WHEN doc_id % 64 = 0 THEN source || '/' || CAST(doc_id // 64 AS VARCHAR) || '/LICENSE.txt'
    ELSE source || '/' || CAST(doc_id // 64 AS VARCHAR) || '/' || CAST(doc_id AS VARCHAR) || '.txt' END AS path FROM documents),
template AS (SELECT * FROM (VALUES {values}) AS t(template, license, text)),
tf AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({cut('text')}) AS term FROM template) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + {n}) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term),
weight AS (SELECT template, license, term, tf * idf AS weight FROM tf JOIN idf USING (term)),
norm AS (SELECT template, sqrt(sum(weight * weight)) AS norm FROM weight GROUP BY template),
line AS (
  SELECT doc_id, unnest(range(len(bodies))) AS line, {cut('unnest(bodies)')} AS terms
  FROM (SELECT doc_id, string_split(text, chr(10)) AS bodies FROM file WHERE regexp_matches(text, '{MAY_HOLD}'))),
known AS (SELECT * FROM line WHERE len(terms) > 0 AND len(list_intersect(list_distinct(terms), {known})) >= {FAMILIAR} * len(list_distinct(terms))),
run AS (SELECT doc_id, min(line) AS notice, flatten(list(terms)) AS terms FROM (
  SELECT *, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS run FROM known) GROUP BY doc_id, run),
notice AS (
  SELECT doc_id, notice, terms FROM run WHERE list_has_any(terms, {triggers})
  UNION ALL SELECT doc_id, -1, {cut('text')} FROM file WHERE {is_file} AND regexp_matches(text, '{MAY_HOLD}')),
own AS (
  SELECT doc_id, notice, term, count(*) * coalesce(any_value(idf), ln(1.0 + {n}) + 1) AS own
  FROM (SELECT doc_id, notice, unnest(terms) AS term FROM notice) LEFT JOIN idf USING (term) GROUP BY ALL),
own_norm AS (SELECT doc_id, notice, sqrt(sum(own * own)) AS own_norm FROM own GROUP BY ALL),
score AS (
  SELECT doc_id, notice, template, license, round(dot / (norm * own_norm), 6) AS score FROM (
    SELECT doc_id, notice, template, license, sum(own * weight) AS dot FROM own JOIN weight USING (term) GROUP BY ALL)
  JOIN norm USING (template) JOIN own_norm USING (doc_id, notice)),
best AS (SELECT * FROM score WHERE score >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, template) = 1),
named AS (SELECT f.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, license, score FROM file AS f LEFT JOIN best ON best.doc_id = f.doc_id),
holder AS (SELECT dir AS above, license AS given FROM named WHERE license IS NOT NULL AND {is_file} QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
way AS (SELECT DISTINCT dir, unnest(range(CASE WHEN dir = '' THEN 1 ELSE len(string_split(dir, '/')) + 1 END)) AS depth FROM named),
nearest AS (
  SELECT dir, above, given FROM (SELECT dir, depth, CASE WHEN depth = 0 THEN '' ELSE array_to_string(list_slice(string_split(dir, '/'), 1, depth), '/') END AS above FROM way)
  JOIN holder USING (above) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY depth DESC) = 1)
SELECT doc_id, path, license AS own_license, score AS own_score, coalesce(license, given) AS license, CASE WHEN license IS NULL THEN above END AS folder_of_license
FROM named LEFT JOIN nearest ON nearest.dir = named.dir
"""


QUERIES = {"op10_license_scan": op10_license_scan}
ORACLES = {"op10_license_scan": _sql()}
