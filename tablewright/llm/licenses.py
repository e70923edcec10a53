"""License scan: texts and lines brought to a canonical form, and their digests looked up among known licenses.

The canonical form folds case, punctuation, white space and spellings that license matching treats as equal, and
leaves out copyright lines. Only whole units are compared: a document as a whole, and each of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: spellings that count as the same, after case and punctuation are folded
SPELLINGS = (
    ("licenc", "licens"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"), ("per cent", "percent"), ("organis", "organiz"),
    ("authoris", "authoriz"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("merchantable", "merchantability"),
)
# a line that is a copyright notice and no more, in canonical form (© is `copyright`, (c) is `c`): signs with a year, two
# signs with a name, the word with a name that ends as names of holders do, or a tag. Repeats are bounded, so that no
# text makes the matcher recurse deeply, and there is no look-ahead, so that SQL has the same rule
_HOLDERS = (
    "authors?|contributors?|developers?|maintainers?|team|foundation|project|group|community|inc|incorporated|ltd|limited|"
    "llc|corp|corporation|company|gmbh|others")
_SIGNS = "(?:portions )?(?:copyright|c)(?: (?:copyright|c)){0,3}"
_TAG = "spdx filecopyrighttext"
_RESERVED = "(?: all rights reserved)?"
NOTICE_LINE = "(?m)^ ?(?:" + "|".join((
    f"(?:{_SIGNS}|{_TAG})(?: [^ \\n]+){{0,15}} (?:[0-9]{{4}}|year|yyyy)(?: [^ \\n]+){{0,15}}",
    "(?:portions )?(?:copyright (?:c|copyright)|c copyright)(?: [^ \\n]+){1,15}",
    f"(?:portions )?copyright(?: [^ \\n]+){{0,8}} (?:{_HOLDERS})(?: [0-9]{{4}}){{0,4}}{_RESERVED}",
    f"{_TAG}(?: [^ \\n]+){{0,30}}", "all rights reserved")) + ") ?$"
# words that show that such a line goes on as, or is, a sentence
_PROSE = (
    "is|are|was|were|be|been|has|have|had|you|your|may|must|shall|can|cannot|will|would|should|this|that|these|those|it|its|"
    "any|all copies|under|law|laws|act|acts|notice|notices|holder|holders|statement|statements|licen[a-z]+|infring[a-z]+|"
    "protect[a-z]+|belongs|granted|grant|permi[a-z]+|terms|subject|conditions|list|above|below|following|copy|copies|in|to|"
    "with|without|not|if|as|on|from|which|who|whose|when|where|see|please|use|used|using|code|file|files")
SENTENCE = f"(?m)^( ?(?:{_SIGNS}|{_TAG})(?: [^ \\n]+){{0,31}}? (?:{_PROSE})(?: |$))"
KEPT = "!"  # stands before such lines meanwhile; canonical text has no signs

# fixed values: short licenses and notices in full
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THREE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n"
     + _ISC_TAIL), ("0BSD", _ISC_GRANT + ".\n" + _ISC_TAIL),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-3-Clause", _BSD_HEAD + _BSD_THREE + _BSD_TAIL),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Licensed under CC0 1.0."),
)
# fixed values: digests of the complete texts of longer licenses, as digest(canonical_lines(text)) gives them
WHOLE_TEXTS = (
    ("Apache-2.0", "6074c3536c43b739207170b87d1681477d0f07374ed3d862ba461334cce848e3"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "452eaadd998b06b62a51be424c021eea5228803a2773e147818b9cd429a60d64"),
    ("GFDL-1.3", "c6db6132e3f9cfc574a0348860b9e8a36b70ab711ca7ec85d9c61871c2d90e55"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "adb7fb6d47e56eddbad6d40db0fb0594da80125158b142b6f277043527dfe039"),
    ("MPL-2.0", "419995aed8099dedbfe429cfc03b01996e846d46c89a474dabd1ba9610b1d4f2"),
)
MOST_KNOWN = 100_000  # digests sent to all executors; more are joined by a shuffle


def canonical_lines(text: Column) -> Column:
    """The text, line breaks kept, with all else but letters and digits as single spaces and copyright lines empty."""
    text = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit(" and ")))
    text = F.regexp_replace(F.replace(text, F.lit("©"), F.lit(" copyright ")), r"[^\p{L}\p{N}\n]+", " ")
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.regexp_replace(F.regexp_replace(text, SENTENCE, KEPT + "$1"), NOTICE_LINE, "")
    return F.replace(text, F.lit(KEPT), F.lit(""))


def digest(lines: Column) -> Column:
    """The digest of a unit in canonical lines: line breaks count as spaces; null if nothing is left."""
    unit = F.trim(F.regexp_replace(lines, r"[ \n]+", " "))
    return F.when(unit != "", F.sha2(unit, 256))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """digest and license_id of each known text; a text known under several names keeps the first by name.

    `known` has license_id and text; without it, KNOWN and WHOLE_TEXTS count.
    """
    whole = WHOLE_TEXTS if known is None else ()
    known = KNOWN if known is None else known
    if not isinstance(known, DataFrame):
        known = spark.createDataFrame(list(known), "license_id string, text string")
    rows = known.select(digest(canonical_lines(F.col("text"))).alias("digest"), "license_id")
    if whole:
        rows = rows.unionByName(spark.createDataFrame(list(whole), "license_id string, digest string"))
    return rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest, license_id, n_lines, n_notices, notices for every row of `docs`; `known` as of known_digests.

    license_id is the license whose whole text the document is, else null. n_lines counts lines that keep a letter or
    digit, n_notices those among them that are a known text as a whole, and notices lists their licenses by name,
    sorted. Null and empty texts have no digest and no lines. Rows that repeat get a row each; a doc_id with several
    texts keeps the result of each text. Columns other than doc_id and text are ignored.
    """
    few = known.limit(MOST_KNOWN + 1).count() <= MOST_KNOWN
    known = F.broadcast(known) if few else known
    lines, mark = F.col("lines"), F.xxhash64("text").alias("mark")
    units = docs.select("doc_id", mark, canonical_lines(F.col("text")).alias("lines"))
    whole = units.select(
        "doc_id", "mark", digest(lines).alias("digest"),
        F.regexp_count(lines, F.lit(r"(?m)^.*[^ \n]")).cast("long").alias("n_lines"))
    single = units.select("doc_id", "mark", F.explode(F.split(lines, "\n")).alias("line"))
    single = single.select("doc_id", "mark", digest(F.col("line")).alias("digest"))
    notices = (
        single.join(known, "digest").groupBy("doc_id", "mark", "license_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("doc_id", "mark").agg(
            F.sum("n").alias("n"), F.sort_array(F.collect_set("license_id")).alias("names")))
    rows = whole.join(known, "digest", "left")
    # a doc_id and text that occur in several rows have counted their lines together
    copies = docs.groupBy("doc_id", mark).agg(F.count(F.lit(1)).alias("copies"))
    notices = notices.alias("x").join(
        copies.alias("c"), F.col("x.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("x.mark") == F.col("c.mark"))
    ).select(F.col("x.doc_id").alias("key"), F.col("x.mark").alias("key_mark"),
             (F.col("n") / F.col("copies")).cast("long").alias("n"), "names")
    joined = rows.join(notices, F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("mark") == F.col("key_mark")), "left")
    return joined.select(
        "doc_id", "digest", "license_id", "n_lines", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("notices"))
