"""Licence scan by canonical digest.

A text is reduced to a canonical form (ASCII case folded, copyright lines
dropped, equivalent spellings made one, punctuation and runs of white space
made one blank) and its SHA-256 is hash-joined to the digests of known licence
texts.  A line is a copyright line if the word or sign it starts with is
followed by what names a year or holder: body text that happens to be wrapped
before the word "copyright" stays.  Two units are looked up: the whole text (``licence``) and each of its
lines (``notices``), since source files carry a licence as a notice line.

Only built-in functions are used.  The known texts are a fixed table; their
digests are computed by the same expressions.
"""

from __future__ import annotations

from functools import reduce
from importlib.resources import files
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm.common import LOWER, UPPER

# Licence id and text (public licence texts and their usual notice lines).
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
]
BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
BSD_CLAUSES = ["""Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
""", """Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
""", """Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""]
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _more() -> list[tuple[str, str]]:
    """Whole texts: MIT, ISC and BSD under their usual titles, BSD clauses
    numbered or not, and the files of ``texts``; Apache-2.0 also without its
    appendix.  Texts with copyright lines of their own also on one line."""
    out = []
    for licence, title, others in (("MIT", "MIT License", ["", "The MIT License", "The MIT License (MIT)"]),
                                   ("ISC", "ISC License", ["", "The ISC License"])):
        body = next(t for i, t in KNOWN if i == licence and t.startswith(f"{title}\n\n"))[len(title):]
        out += [(licence, other + body) for other in others]
    for n, licence in ((2, "BSD-2-Clause"), (3, "BSD-3-Clause")):
        for mark in ("{}. ", "* "):
            body = "".join([BSD_HEAD, *[f"\n{mark.format(k)}{c}" for k, c in enumerate(BSD_CLAUSES[:n], 1)], BSD_TAIL])
            out += [(licence, title + body) for title in ("", f"BSD {n}-Clause License\n\n", f"The {n}-Clause BSD License\n\n")]
    for file in sorted(files("pagelake.llm").joinpath("texts").iterdir(), key=lambda f: f.name):
        licence, text = file.name.removesuffix(".txt"), file.read_text("utf-8")
        out += [(licence, text), (licence, " ".join(text.split()))]
        if licence == "Apache-2.0":
            out.append((licence, text[:text.index("END OF TERMS AND CONDITIONS") + 27]))
    return out


KNOWN += _more()
# Spellings that mean the same, after case folding; whole words only.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"),
    ("organisation", "organization"), ("favour", "favor"), ("merchantibility", "merchantability"),
    ("noncommercial", "non commercial"), ("copyright holder", "copyright owner"),
]
# A line that starts so is a copyright line.  Both Java and RE2 read these.
YEAR = "(?:19|20)[0-9]{2}"
COPYRIGHT = "(?:" + "|".join([
    f"copyright[\\t :,]*(?:\\(c\\)|©|{YEAR}|[<\\[{{]|by[\\t ])",
    f"copyright[\\t ][^\\n]*[\\t ,(-]{YEAR}(?:[^0-9a-z\\n]|(?m:$))",
    "copyright[\\t ][^\\n]*(?:authors|inc|ltd|llc|gmbh|foundation|affiliates|corporation|corp)[^0-9a-z\\n]*(?m:$)",
    f"\\(c\\)[\\t ,]*(?:copyright|©|{YEAR}|[<\\[{{]|by[\\t ])",
    f"\\(c\\)[^\\n]*[\\t ,(-]{YEAR}(?:[^0-9a-z\\n]|(?m:$))",
    "\\(c\\)[\\t ]*(?:[^\\n\\t ]*[^\\n\\t .,;:]|[^\\n]*[\\t ](?:inc|ltd|llc|corp)[.]?)[\\t ]*(?m:$)",
    "©", "all rights reserved[^0-9a-z\\n]*(?m:$)"]) + ")"
PUNCTUATION = "[^0-9a-z\\x{80}-\\x{10FFFF}]+"
LEAD = "[\\t #*/;%-]*"


def canonical(text: Column) -> Column:
    """Canonical form of a text; null stays null."""
    out = F.translate(text, UPPER, LOWER)
    # (?d): only "\n" ends a line for $, as in RE2
    out = F.regexp_replace(out, f"(?d)(?:^|\\n){LEAD}{COPYRIGHT}[^\\n]*", "\n")
    # two blanks around every word, so that neighbouring spellings don't share one
    out = F.concat(F.lit(" "), F.regexp_replace(out, PUNCTUATION, "  "), F.lit(" "))
    for other, usual in SPELLINGS:
        out = F.replace(out, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {usual.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(form: Column) -> Column:
    return F.sha2(form, 256)


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """(``digest``, ``licence``, ``anchor``) of known (id, text) pairs; the
    smallest id for texts of one form.  ``anchor`` is a word of the form, a
    long one that many forms share if there is one; null without ASCII words."""
    rows = spark.createDataFrame(list(KNOWN if known is None else known), "licence string, text string")
    forms = rows.select(canonical(F.col("text")).alias("form"), "licence").groupBy("form").agg(F.min("licence").alias("licence"))
    words = forms.select("form", F.explode(F.array_distinct(F.split("form", " "))).alias("word")).where(F.col("word").rlike("^[0-9a-z]+$"))
    shared = words.groupBy("word").agg(F.struct(F.length("word") >= 7, F.count(F.lit(1)), F.col("word")).alias("rank"))
    anchors = words.join(shared, "word").groupBy("form").agg(F.max("rank")["word"].alias("anchor"))
    return forms.join(anchors, "form", "left").select(digest(F.col("form")).alias("digest"), "licence", "anchor")


def may_match(text: Column, anchors: list[str]) -> Column:
    """Whether ``text`` holds one of ``anchors`` in any spelling.  A text whose
    form is known holds its anchor, so nothing that matches is left out."""
    spelt = set(anchors)
    for other, usual in SPELLINGS:
        if spelt & set(usual.split()):
            spelt |= set(other.split())
    low = F.lower(text)
    return reduce(or_, [F.contains(low, F.lit(word)) for word in sorted(spelt)], F.lit(False))


def scan_licences(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``digest`` (canonical, of the whole
    text), ``licence`` (the known licence that the whole text is, or null),
    ``notices`` (known licences of its lines, distinct, ascending, joined by
    ``|``; empty if none), ``n_notices`` (its lines that match).

    Null text counts as empty; the empty form matches nothing.  Rows with
    equal or null ids keep rows of their own.  Other columns are ignored,
    whatever their names; an empty table gives no rows.  Both joins are hash
    equi-joins on digests; Spark broadcasts the known table only while it
    measures under its own threshold.  Frequent digests don't matter: the
    known side has one row per digest, and matches are counted per document
    with partial aggregation.
    """
    if known is None:
        known = known_digests(docs.sparkSession)
    known = known.where(F.col("digest") != F.sha2(F.lit(""), 256))
    # one word per known text at most; without anchors every line is looked up
    anchors = [r.anchor for r in known.select("anchor").distinct().collect()] if "anchor" in known.columns else [None]
    candidate = (lambda c: F.lit(True)) if None in anchors else (lambda c: may_match(c, anchors))
    known = known.select("digest", "licence")
    base = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("_text", F.xxhash64("text"))
    whole = base.select("doc_id", "_text", digest(canonical(F.col("text"))).alias("digest")) \
        .join(known, "digest", "left")
    lines = base.where(candidate(F.col("text"))) \
        .select("doc_id", "_text", F.posexplode(F.split("text", "\n")).alias("_n", "_line")) \
        .where((F.col("_line") != "") & candidate(F.col("_line"))) \
        .select("doc_id", "_text", "_n", F.coalesce(digest(canonical(F.col("_line"))), F.lit("")).alias("digest"))
    hits = lines.join(known, "digest").groupBy("doc_id", "_text", "_n").agg(F.min("licence").alias("licence"))
    found = hits.groupBy("doc_id", "_text").agg(
        F.concat_ws("|", F.sort_array(F.collect_set("licence"))).alias("notices"),
        F.count(F.lit(1)).alias("n_notices")).withColumnsRenamed({"doc_id": "_id", "_text": "_t"})
    joined = whole.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_t")), "left")
    return joined.select("doc_id", "digest", "licence", F.coalesce("notices", F.lit("")).alias("notices"),
                         F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"))
