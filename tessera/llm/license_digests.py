"""License scans by canonical digests (operator 10).

A text is brought to a canonical form: lower case, everything but letters, digits and line
ends as one blank, copyright lines dropped, equivalent spellings made one; its digest is then
hash-joined with the digests of known licence texts.  Entire texts are compared, and, since
documents quote notices, so are their paragraphs and their lines, each as an entire text.
The known texts are a fixed list (whole licences from ``licenses/``, their paragraphs, short texts
with and without title) with notices made from names and phrases by rule, so the broadcast side has a fixed size.  One pass over the documents; only digests that matched and
one row per document are shuffled.

Defined cases: null and empty texts, and texts of copyright lines alone, have the digest of
the empty text and no licence; a unit that occurs again counts again; equal rows are separate
rows; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import whole

# Equivalent spellings, first form to second.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"),
    ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("defence", "defense"),
    ("endeavour", "endeavor"), ("favour", "favor"), ("fulfil", "fulfill"), ("honour", "honor"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"),
    ("licences", "licenses"), ("licenced", "licensed"), ("merchantibility", "merchantability"), ("modelling", "modeling"),
    ("organisation", "organization"), ("owner", "holder"), ("owners", "holders"), ("practise", "practice"),
    ("programme", "program"), ("recognise", "recognize"), ("sublicence", "sublicense"), ("whilst", "while"),
    ("wilful", "willful"), ("https", "http"),
)

# Licence names in notices, by identifier.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "MIT": ("MIT License", "MIT Licence", "MIT"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-clause BSD license", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-clause BSD license", "BSD-3-Clause"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "EPL-2.0"),
    "ISC": ("ISC License", "ISC"),
    "Zlib": ("zlib License", "Zlib"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}

#: Phrases around a name.
PHRASES = (
    "{}", "The {}", "Licensed under {}", "Licensed under the {}", "This work is licensed under {}",
    "This work is licensed under the {}", "This work is licensed under a {}", "This file is licensed under the {}",
    "Released under the {}", "Distributed under the {}", "Published under the {}", "License: {}",
    "SPDX-License-Identifier: {}",
)

# Short licence texts and notices.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to
alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
}


#: Whole licences as they are published, shipped as data, by identifier.
FILES = Path(__file__).with_name("licenses")
#: Shorter paragraphs (headings, say) are no notices of their own.
CLAUSE = 60


def whole_texts() -> list[tuple[str, str]]:
    """(text, identifier) of whole licences, short ones also with their titles and without clause numbers."""
    files = [(f.read_text(encoding="utf-8"), f.stem) for f in sorted(FILES.glob("*.txt"))]
    found = [(text, known) for known, text in TEXTS.items()] + files
    for text, known in [x for x in found if len(x[0]) < 3000 and x[1] != "Apache-2.0"]:
        names = dict.fromkeys((*NAMES.get(known, ()), known, f"{known} License"))
        titles = [t for n in names for t in (n, f"The {n}", f"{n} ({known})", f"The {n} ({known})")]
        bare = re.sub(r"(?m)^ *[0-9]\. *", "", text)
        for own in dict.fromkeys((text, bare)):
            found += [(own, known), *((f"{t}\n\n{own}", known) for t in titles)]
    return list(dict.fromkeys(found))


def clauses() -> list[tuple[str, str]]:
    """(text, identifier) of the paragraphs and numbered clauses that stand in one licence only."""
    of: dict[str, tuple[str, set[str]]] = {}
    for text, known in [*((re.sub(r"(?m)([.:])$", r"\1\n", t), k) for k, t in TEXTS.items() if k != "Apache-2.0"),
                        *((f.read_text(encoding="utf-8"), f.stem) for f in sorted(FILES.glob("*.txt")))]:
        for part in re.split(r"\n\s*\n", text):
            if len(" ".join(part.split())) >= CLAUSE:
                key = " ".join(re.findall(r"\w+", part.lower()))
                of.setdefault(key, (part, set()))[1].add(known)
    return [(part, next(iter(known))) for part, known in of.values() if len(known) == 1]


def registry() -> list[tuple[str, str]]:
    """(text, identifier) of everything known; the first identifier of a text holds."""
    made = [(phrase.format(name), known) for known, names in NAMES.items() for name in (*names, known) for phrase in PHRASES]
    return whole_texts() + made + clauses()


def _plain(text: Column) -> Column:
    """Lower case, one blank for all but letters, digits and line ends, one spelling."""
    t = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")
    same = t
    for a, b in EQUIVALENT:
        same = F.regexp_replace(same, rf"\b{a}\b", b)
    return F.when(t.rlike(r"\b(" + "|".join(a for a, _ in EQUIVALENT) + r")\b"), same).otherwise(t)


COPYRIGHT = r"^(copyright|all rights reserved|c [0-9]{4})( |$)"


def _joined(plain: Column) -> Column:
    lines = F.transform(F.split(plain, "\n"), lambda x: F.btrim(x, F.lit(" ")))
    return F.array_join(F.filter(lines, lambda x: (x != "") & ~x.rlike(COPYRIGHT)), " ")


def canonical(text: Column) -> Column:
    return F.element_at(F.transform(F.array(_plain(whole(text))), _joined), 1)


def digest(canon: Column) -> Column:
    return F.sha2(canon.cast("binary"), 256)


def known_digests(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(registry())], "i int, text string, license string")
    return (rows.select("i", "license", digest(canonical(F.col("text"))).alias("unit"))
            .groupBy("unit").agg(F.min_by("license", "i").alias("license")))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, digest of the whole text, license (of the whole text, else null), notices
    (identifiers of its paragraphs and lines, sorted) and n_notices."""

    def units(plain: Column) -> Column:
        parts = F.concat(F.split(plain, r"\n *(?:\n *)+"), F.split(plain, "\n"))
        parts = F.filter(F.array_distinct(F.transform(parts, _joined)), lambda x: x != "")
        return F.concat(F.array(F.struct(F.lit(True).alias("all"), digest(_joined(plain)).alias("unit"))),
                        F.transform(parts, lambda x: F.struct(F.lit(False).alias("all"), digest(x).alias("unit"))))

    numbered = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text")).withColumn(
        "_row", F.monotonically_increasing_id())   # read once, so a row has one number
    found = numbered.select("doc_id", "_row", F.explode(
        F.element_at(F.transform(F.array(_plain(F.col("text"))), units), 1)).alias("u"))
    found = found.select("doc_id", "_row", "u.all", "u.unit").join(
        F.broadcast(known_digests(docs.sparkSession)), "unit", "left")   # a fixed list
    found = found.filter(F.col("all") | F.col("license").isNotNull())
    quoted = F.array_sort(F.collect_set(F.when(~F.col("all"), F.col("license"))))
    return found.groupBy("_row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.max(F.when(F.col("all"), F.col("unit"))).alias("digest"),
        F.max(F.when(F.col("all"), F.col("license"))).alias("license"), quoted.alias("notices")).select(
        "doc_id", "digest", "license", F.array_join("notices", ",").alias("notices"),
        F.size("notices").cast("long").alias("n_notices"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The same scan in DuckDB."""
    def plain(t: str) -> str:
        t = rf"regexp_replace(lower({t}), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
        for a, b in EQUIVALENT:
            t = rf"regexp_replace({t}, '\b{a}\b', '{b}', 'g')"
        return t

    def joined(t: str) -> str:
        return (rf"array_to_string(list_filter(list_transform(string_split({t}, chr(10)), lambda x: trim(x, ' ')), "
                rf"lambda x: x <> '' AND NOT regexp_matches(x, '{COPYRIGHT}')), ' ')")

    values = ", ".join(f"({i}, {_quoted(t)}, {_quoted(k)})" for i, (t, k) in enumerate(registry()))
    return rf"""
WITH known AS (
  SELECT sha256({joined('p')}) AS unit, arg_min(license, i) AS license
  FROM (SELECT i, license, {plain('t')} AS p FROM (VALUES {values}) v(i, t, license)) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, {plain("coalesce(text, '')")} AS p FROM documents),
units AS (
  SELECT DISTINCT r, {joined('q')} AS u FROM (
    SELECT r, unnest(list_concat(regexp_split_to_array(p, '\n *(?:\n *)+'), string_split(p, chr(10)))) AS q FROM docs)),
found AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(DISTINCT license) AS n
  FROM units JOIN known ON unit = sha256(u) WHERE u <> '' GROUP BY r)
SELECT doc_id, sha256({joined('p')}) AS digest, known.license AS license, coalesce(notices, '') AS notices,
       coalesce(n, 0) AS n_notices
FROM docs LEFT JOIN found USING (r) LEFT JOIN known ON unit = sha256({joined('p')})"""
