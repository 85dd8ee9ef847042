"""License scans: canonical digests of entire texts, joined to known licences.

A text is made canonical the same way on both sides: lower case, copyright lines
dropped, every run of other characters than a-z and 0-9 becomes one space, and
words with an equivalent spelling take one form.  The digest of the result is
hash-joined to the digests of the known licences, so a text matches only as a
whole.  The texts scanned in a document are the entire document and, for
documents that carry a licence next to other matter, each of its lines and each
of its paragraphs (runs of lines between blank ones) as an entire text of its own.

The known licences are a parameter: a list of (name, text).  The list below holds
the entire texts of ``license_texts.py`` with and without their titles, and the
usual one-line notices; the join broadcasts it because its length is known
(``len(known)`` rows).  A text or notice worded otherwise is not found.

Only DataFrame functions are used.  Lines are looked up where the document is
read; a document's hits are merged by a partially aggregated ``groupBy`` on a row
number, so rows of equal id stay apart.

Defined results: a null, empty or word-free text has no digest and matches
nothing; repeated rows are scanned each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import license_texts
from ledgerflow.llm.common import setup

# Spellings that count as equal (canonical form second).
EQUIVALENT = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
              ("organisation", "organization"), ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"),
              ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("centre", "center"),
              ("initialise", "initialize"), ("merchantibility", "merchantability"), ("redistributions", "redistribution"),
              ("wilful", "willful"), ("percent", "per cent"), ("http", "https"))

# Texts of known licences and of the notices that stand for one.
MIT_TEXT = """MIT License

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
SOFTWARE.
"""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""
CC_TERMS = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
CC_VERSIONS = (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic"))
GNU = (("GPL", "General Public License", "1.0"), ("GPL", "General Public License", "2.0"), ("GPL", "General Public License", "3.0"),
       ("LGPL", "Library General Public License", "2.0"), ("LGPL", "Lesser General Public License", "2.1"),
       ("LGPL", "Lesser General Public License", "3.0"), ("AGPL", "Affero General Public License", "3.0"))
LATER = (" or later", " or any later version")


def _gnu(short: str, spoken: str, version: str) -> list:
    name, v = f"{short}-{version}", version.removesuffix(".0")
    said = tuple(f"GNU {spoken} {x}{n}" for n in dict.fromkeys((v, version)) for x in ("version ", "v", ""))
    said += tuple(f"{s} {x}{v}" for s in (f"GNU {short}", short) for x in ("version ", "v")) + (f"GNU {short}v{v}", f"{short}v{v}", f"{short} {version}")
    return [(name, (name, f"{name}-only"), said), (f"{name}-or-later", (f"{name}-or-later", f"{name}+"), tuple(x + y for x in said for y in LATER))]


# Fixed values: (name, SPDX identifiers, the words a notice names it by).
NAMED = (
    ("MIT", ("MIT",), ("MIT", "Expat")),
    ("ISC", ("ISC",), ("ISC",)),
    ("Apache-2.0", ("Apache-2.0",), ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache Software License 2.0",
                                     "Apache Software License, Version 2.0", "Apache 2.0", "Apache v2", "Apache 2", "Apache v2.0")),
    ("BSD-3-Clause", ("BSD-3-Clause",), ("3-Clause BSD", "BSD 3-Clause", "New BSD", "Modified BSD", "three-clause BSD")),
    ("BSD-2-Clause", ("BSD-2-Clause",), ("2-Clause BSD", "BSD 2-Clause", "Simplified BSD", "FreeBSD", "two-clause BSD")),
    *((f"MPL-{v}", (f"MPL-{v}",), (f"Mozilla Public License, version {v}", f"Mozilla Public License, v. {v}", f"Mozilla Public License {v}",
                                   f"Mozilla Public License v{v}", f"MPL {v}", f"MPL v{v}")) for v in ("1.1", "2.0")),
    *(x for g in GNU for x in _gnu(*g)),
    ("CC0-1.0", ("CC0-1.0",), ("CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "Creative Commons CC0 1.0 Universal")),
    *((f"CC-{c}-{v}", (f"CC-{c}-{v}",), (f"CC {c} {v}", f"CC {c} {v} {area}", f"Creative Commons {c} {v}", f"Creative Commons {n} {v}", f"Creative Commons {n} {v} {area}"))
      for c, n in CC_TERMS for v, area in CC_VERSIONS),
    # Without a version.
    *((f"CC-{c}", (), (f"CC {c}", f"Creative Commons {c}", f"Creative Commons {n}")) for c, n in CC_TERMS),
)
FORMS = ("Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under",
         "This project is licensed under", "This software is licensed under", "This document is licensed under")


def notices(named=NAMED) -> list[tuple[str, str]]:
    """``(license, line)`` of the usual one-line notices of the named licences."""
    out = {}
    for name, ids, spoken in named:
        lines = [f"SPDX-License-Identifier: {i}" for i in ids]
        for s in spoken:
            # "GNU General Public License v3" names it in full, "MIT" or "CC BY 4.0" may have "License" after it.
            said = (s,) if "License" in s or "later" in s else (s, f"{s} License")
            lines += [f"License: {s}"] + [f"{f} {a}{x}." for f in FORMS for x in said for a in ("", "a " if s.startswith("Creative") else "the ")]
        out |= {x: name for x in lines if x not in out}
    return [(n, x) for x, n in out.items()]


KNOWN = (
    ("MIT", MIT_TEXT),
    ("ISC", ISC_TEXT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    *(("MIT", MIT_TEXT.replace("MIT License", t, 1)) for t in license_texts.MIT_TITLES),
    *(("ISC", f"{t}\n\n{ISC_TEXT}") for t in license_texts.ISC_TITLES),
    *(("BSD-2-Clause", t) for t in license_texts.bsd(2)),
    *(("BSD-3-Clause", t) for t in license_texts.bsd(3)),
    *license_texts.published(),
    *notices(),
)

#: A copyright line: "copyright" with a year or sign, a sign alone, or the usual closing words.
COPYRIGHT_LINE = r"^[^a-z0-9\n]*(?:copyright[^a-z0-9\n][^\n]*(?:[0-9]{4}|\(c\)|©)[^\n]*|copyright[^a-z0-9\n]*(?:\(c\)|©)[^\n]*|(?:\(c\)|©)[^\n]*|all rights reserved[^\n]*)$"
PARAGRAPH_BREAK = r"\n[ \t\r]*(?:\n[ \t\r]*)+"


def canonical(text: Column) -> Column:
    """The canonical form of a text; null without a word.  Only A-Z are lower-cased:
    nothing beyond a-z and 0-9 is kept anyway."""
    c = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    c = F.regexp_replace(c, "(?md)" + COPYRIGHT_LINE, " ")
    c = F.concat(F.lit(" "), F.regexp_replace(c, "[^a-z0-9]+", " "), F.lit(" "))
    for a, b in EQUIVALENT:
        c = F.replace(c, F.lit(f" {a} "), F.lit(f" {b} "))
    return F.when(F.trim(c) != "", F.trim(c))


def digest(text: Column) -> Column:
    return F.md5(canonical(text).cast("binary"))


def known_digests(spark, known=KNOWN) -> DataFrame:
    """``(digest, license)`` of the known texts; of texts with one digest the first name counts."""
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(known)], "i int, license string, known_text string")
    rows = rows.select("i", "license", digest(F.col("known_text")).alias("known"))
    return rows.groupBy("known").agg(F.min(F.struct("i", "license"))["license"].alias("license"))


def _part(entire: bool):
    return lambda p: F.struct(F.lit(entire).alias("entire"), p.alias("part"))


def scan(docs: DataFrame, known=KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, license, notices, n_notices)`` of every document: the digest
    of its entire text, the licence that text is, and the sorted names of the
    licences that one of its lines or paragraphs is, with the number of such parts."""
    setup(docs.sparkSession)
    text = F.col("text")
    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = F.transform(F.filter(F.split(text, PARAGRAPH_BREAK), lambda p: p.contains("\n")), _part(False))
    lines = F.transform(F.split(text, "\n"), _part(False))
    entire = F.array(_part(True)(text))
    parts = F.when(text.rlike(PARAGRAPH_BREAK), F.concat(entire, lines, parts)).when(
        text.contains("\n"), F.concat(entire, lines)).otherwise(entire)
    units = whole.select("row", "doc_id", F.explode(parts).alias("u")).select("row", "doc_id", "u.entire", digest(F.col("u.part")).alias("d"))
    hits = units.join(F.broadcast(known_digests(docs.sparkSession, known)), F.col("d") == F.col("known"), "left")
    return hits.groupBy("row", "doc_id").agg(
        F.max(F.when(F.col("entire"), F.col("d"))).alias("digest"), F.max(F.when(F.col("entire"), F.col("license"))).alias("license"),
        F.sort_array(F.collect_set(F.when(~F.col("entire"), F.col("license")))).alias("names"),
        F.count(F.when(~F.col("entire"), F.col("license"))).alias("n_notices")).select(
        "doc_id", "digest", "license", F.concat_ws(",", "names").alias("notices"), "n_notices")
