"""Licence scan by canonical digest.

A text is lower-cased, its copyright statements are taken out (lines, also behind a comment mark, of
"copyright" with a sign, a year or a holder, not licence wording that is wrapped before "copyright
notice"), equivalent spellings become one, every run
of other characters than letters and digits becomes one space, and the SHA-256 of what is left is
joined to the digests of known licences.  Whole texts are looked up among licence texts; each whole
line, as a text of its own, among the usual one-line notices.

Edge cases: a null text has no digest, licence or notice; an empty one has the digest of the
empty text; repeated rows come back each; a null key is kept; other columns are not read; an
empty table gives no row.
"""

from __future__ import annotations

import json
import pkgutil
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.llm.text_stats import let

# ---- fixed values: public licence texts, notices and equivalent spellings

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ZERO_BSD = _ISC.replace(
    ", provided that the above copyright notice and this permission notice appear in all copies", "")

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: licence and text; a title line may stand before each
TEXTS = [(name, title + text) for name, text, titles in (
    ("MIT", _MIT, ("", "MIT License\n\n", "The MIT License (MIT)\n\n")),
    ("ISC", _ISC, ("", "ISC License\n\n")),
    ("0BSD", _ZERO_BSD, ("", "BSD Zero Clause License\n\n", "Zero-Clause BSD\n\n")),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL, ("", "BSD 2-Clause License\n\n")),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL, ("", "BSD 3-Clause License\n\n")),
) for title in titles]

_ISC_AND = _ISC.replace("modify, and/or distribute", "modify, and distribute")

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE_LINK = "\n\nFor more information, please refer to <%s://unlicense.org%s>"

#: file in ``licenses`` and the licence it holds; GPL and the like name no "only" or "or later" in their text
_FILES = {"Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
          "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1",
          "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "Artistic": "Artistic-1.0-Perl",
          "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3"}
#: what follows the terms and is often left out
_APPENDIX = re.compile(r"\n[ \t]*(END OF TERMS AND CONDITIONS|APPENDIX:|Appendix: How to Apply|How to Apply These Terms|"
                       r"ADDENDUM: How to use|Exhibit A - )", re.I)


def common_texts() -> list[tuple[str, str]]:
    """The licences of ``TEXTS`` and the longer ones, whole, and cut at each part after the terms."""
    out = list(TEXTS) + [("ISC", title + _ISC_AND) for title in ("", "ISC License\n\n")]
    for tail in ("", *(_UNLICENSE_LINK % (h, e) for h in ("http", "https") for e in ("", "/"))):
        out += [("Unlicense", title + _UNLICENSE + tail) for title in ("", "The Unlicense\n\n")]
    for file, name in _FILES.items():
        whole = pkgutil.get_data("cadastre.llm", f"licenses/{file}.txt").decode()
        out.append((name, whole))
        for found in _APPENDIX.finditer(whole):
            out += [(name, whole[:found.start()]), (name, whole[:found.end()])]
    return out


#: a line without one of these words is no notice
_NOTICE_WORD = r"(?i)licen|\b(?:released|distributed|available|provided|published|shared|open.sourced|covered|governed) (?:to you )?(?:under|by|with)\b"
#: what may stand before the name of a licence in a notice, in canonical form
_NOTICE_HEAD = (r"^(?:spdx license identifier |license |licensed |(?:(?:this|the|all|our)(?: [\p{L}\p{N}]+){1,4} (?:is|are) )?"
                r"(?:free software )?(?:(?:dual )?licensed|released|distributed|available|made available|provided|published|"
                r"shared|open sourced|covered|governed)(?: to you)? (?:under|by|with) )"
                r"(?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?")


def license_names() -> dict[str, str]:
    """Names of licences in canonical form, as notices write them, and the licence."""
    out: dict[str, str] = {}

    def add(name: str, *forms: str) -> None:
        for form in forms:
            for end in ("", " license"):
                out.setdefault(form + end, name)

    def versions(v: str) -> list[str]:
        short = v.removesuffix(".0")
        return [f"{lead}{x.replace('.', ' ')}" for x in dict.fromkeys((v, short)) for lead in (" version ", " ", " v", " v ")] \
            + [x.replace(".", " ") for x in (f"v{v}", f"v{short}")]

    add("MIT", "mit", "expat", "mit expat")
    add("ISC", "isc")
    add("0BSD", "0bsd", "zero clause bsd", "bsd zero clause", "bsd 0 clause")
    for n, word, kind in (("2", "two", "simplified"), ("3", "three", "new")):
        add(f"BSD-{n}-Clause", f"bsd {n} clause", f"{n} clause bsd", f"{word} clause bsd", f"bsd {word} clause",
            f"{kind} bsd", *(["revised bsd", "modified bsd", "bsd 3 clause new"] if n == "3" else ["freebsd"]))
    add("Unlicense", "unlicense")
    add("CC0-1.0", "cc0", "cc0 1 0", "cc0 1 0 universal", "creative commons zero", "creative commons cc0",
        "creative commons cc0 1 0", "creative commons zero v1 0 universal", "creative commons cc0 1 0 universal")
    for v in versions("2.0"):
        add("Apache-2.0", f"apache{v}", f"apache license{v}", f"apache software license{v}", f"asl{v}", f"apl{v}")
        add("MPL-2.0", f"mozilla public license{v}", f"mpl{v}")
    for v in versions("1.1"):
        add("MPL-1.1", f"mozilla public license{v}", f"mpl{v}")
    for family, named, known in (("GPL", ("general public license", "gpl"), ("1.0", "2.0", "3.0")),
                                 ("LGPL", ("lesser general public license", "library general public license", "lgpl"),
                                  ("2.0", "2.1", "3.0")),
                                 ("AGPL", ("affero general public license", "agpl"), ("1.0", "3.0")),
                                 ("GFDL", ("free documentation license", "gfdl", "fdl"), ("1.1", "1.2", "1.3"))):
        for number in known:
            for v in versions(number):
                for form in named:
                    for full in (f"{form}{v}", f"gnu {form}{v}"):
                        add(f"{family}-{number}-only", full, f"{full} only")
                        add(f"{family}-{number}-or-later", *(f"{full} {x}" for x in (
                            "or later", "or any later version", "or at your option any later version",
                            "or later version", "or newer")))
    parts = {"by": "attribution", "nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}
    for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"):
        long = " ".join(parts[x] for x in kind.split())
        spaced = long.replace("noncommercial", "non commercial").replace("sharealike", "share alike") \
            .replace("noderivatives", "no derivatives")
        for number in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            v = number.replace(".", " ")
            for form in (f"cc {kind}", f"creative commons {kind}", f"creative commons {long}",
                         f"creative commons {spaced}"):
                for end in ("", " international", " unported", " generic"):
                    add(f"CC-{kind.upper().replace(' ', '-')}-{number}", f"{form} {v}{end}", f"{form} v{v}{end}",
                        f"{form} license {v}{end}")
    return out


#: licence and one-line notice, word for word; further notices are a general head and one of ``license_names``
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]

#: spelling and what it stands for, in canonical form, whole words
SPELLINGS = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
             ("sub license", "sublicense"), ("non infringement", "noninfringement"),
             ("merchantibility", "merchantability"), ("favour", "favor"), ("organisation", "organization"),
             ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders")]

#: what may stand before a statement in a comment
_MARK = r"[ \t]*(?:(?:#+|/{2,}|/?\*+|-{2,}|;+|%+|!+|<!--|\(\*|rem\b|dnl\b|\.\.)[ \t]*)?"
#: words after "copyright" that belong to the wording of a licence and name no holder
_WORDING = ("notices?|holders?|owners?|owned|owns|laws?|licen[cs]es?|licen[cs]ed|licensors?|statements?|disclaimers?|"
            "permissions?|interests?|rights?|infringements?|protections?|treaty|treaties|acts?|status|doctrines?|"
            "and|or|in|on|of|the|to|for|is|are|as|at|with|within|under|that|this|which|may|shall|will|must|"
            "can|be|has|have|if|from|applies|applicable|any|over|restrictions?|terms|conditions|ownership|"
            "assignments?|claims?|warranty|warranties|lines?|information|material|works?|text|years?|file|"
            "attributions?|legends?|headers?|messages?|not|does|it|its|but|nor|then|when|where|also|"
            "exceptions?|limitations?|subsists?|was|were|such|other|these|those|policy|issues?|free")
_YEAR = r"(?:19|20)\d\d\b"
#: a line that states who holds the copyright, in lower case
_STATEMENT = (r"(^|[\r\n])" + _MARK + r"(?:(?:©|&copy;)|\(c\)(?=[^\r\n]*(?:\b" + _YEAR + r"|copyright))"
              r"|(?:portions[ \t]+)?copyrights?[ \t:,]*(?:by[ \t]+)?(?:\(c\)|©|&copy;|<|\[|\{|" + _YEAR
              + r"|(?!(?:" + _WORDING + r")\b)\p{L}+)"
              r")[^\r\n]*|(^|[\r\n])" + _MARK + r"all rights reserved\b[ \t.]*")
#: the statement of the SQL form, which takes every line that begins so
_COPYRIGHT = r"(^|\n)[ \t]*(copyright[ \t:]|\(c\)|©|all rights reserved)[^\n]*"
_OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The text without the differences that do not make another licence."""
    result = F.regexp_replace(F.regexp_replace(F.lower(text), _STATEMENT, "\n"), _OTHER, " ")
    result = F.concat(F.lit(" "), F.trim(result), F.lit(" "))
    for spelling, usual in SPELLINGS:
        result = F.replace(result, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return F.trim(result)


def _known(spark: SparkSession, table: list[tuple[str, str]], first: list[tuple[str, str]]) -> DataFrame:
    """Digest and name of each text; those of ``first`` go before the others."""
    rows = F.from_json(F.lit(json.dumps([{"late": late, "name": name, "text": text} for late, some in
                                         ((0, first), (1, table)) for name, text in some])),
                       "array<struct<late:int,name:string,text:string>>")
    return (spark.range(1).select(F.inline(rows))
            .select("late", "name", F.sha2(canonical(F.col("text")), 256).alias("known"))
            .groupBy("known").agg(F.min(F.struct("late", "name"))["name"].alias("name")))


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
         licenses: list[tuple[str, str]] | None = None, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row: key, digest, license of the whole text, notices (licences of its lines, sorted).

    ``licenses`` and ``notices``: name and text of further licences and one-line notices; both are
    looked up beside ``common_texts``, ``NOTICES`` and ``license_names``, and go before them.
    """
    spark = docs.sparkSession
    # tables of a few hundred rows
    texts = _known(spark, common_texts(), licenses or [])
    lines = {r["known"]: r["name"] for r in _known(spark, NOTICES, notices or []).collect()}
    pairs = F.map_from_entries(F.array(*(F.struct(F.lit(k), F.lit(v)) for k, v in sorted(lines.items()))))
    names = F.from_json(F.lit(json.dumps(license_names())), "map<string,string>")
    every = bool(notices)  # these need not hold one of the usual words

    def notice(line: Column) -> Column:
        rest = F.regexp_replace(line, _NOTICE_HEAD, "")
        return F.coalesce(pairs[F.sha2(line, 256)], F.when(rest != line, names[rest]))

    def named(whole: Column) -> Column:
        short = F.split(whole, "\n")
        if not every:
            short = F.filter(short, lambda x: x.rlike(_NOTICE_WORD))
        return F.array_join(F.array_sort(F.array_distinct(F.filter(
            F.transform(short, lambda x: let(canonical(x), notice)),
            lambda x: x.isNotNull()))), ",")

    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    digested = picked.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest"),
                             named(F.col("text")).alias("notices"))
    return (digested.join(F.broadcast(texts), F.col("digest") == F.col("known"), "left")
            .select(F.col("doc_id").alias(key), "digest", F.col("name").alias("license"), "notices"))


def oracle_sql() -> str:
    """The same scan of ``documents`` in DuckDB."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canon(x: str) -> str:
        r = (f"regexp_replace(regexp_replace(lower({x}), {quoted(_COPYRIGHT)}, chr(10), 'g'), "
             f"{quoted(_OTHER)}, ' ', 'g')")
        r = f"' ' || trim({r}) || ' '"
        for a, b in SPELLINGS:
            r = f"replace({r}, {quoted(f' {a} ')}, {quoted(f' {b} ')})"
        return f"trim({r})"

    def known(table: list[tuple[str, str]]) -> str:
        values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in table)
        return (f"SELECT sha256({canon('t')}) AS known, min(n) AS name FROM (VALUES {values}) AS v(n, t) "
                "GROUP BY 1")

    return f"""
WITH texts AS ({known(TEXTS)}), notices AS ({known(NOTICES)}),
d AS (SELECT doc_id, text, sha256({canon('text')}) AS digest FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
found AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices
          FROM l JOIN notices ON known = sha256({canon('line')})
          WHERE regexp_matches(line, '(?i)licen') GROUP BY doc_id)
SELECT d.doc_id, d.digest, texts.name AS license,
       CASE WHEN d.text IS NOT NULL THEN coalesce(found.notices, '') END AS notices
FROM d LEFT JOIN texts ON d.digest = texts.known LEFT JOIN found ON d.doc_id = found.doc_id
"""
