"""Licence scan: canonical digests of whole texts and of their lines, hash-joined to known licences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Spellings that licence-matching guidelines treat as equal.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("noninfringement", "non-infringement"), ("https:", "http:"),
    ("copyright owner", "copyright holder"), ("per cent", "percent"), ("whilst", "while"), ("favour", "favor"), ("honour", "honor"),
    ("organisation", "organization"), ("authoris", "authoriz"), ("initialis", "initializ"), ("judgement", "judgment"), ("merchantibility", "merchantability"),
]

_PERMISSION = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_AUTHOR = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."

# Whole licences, as published, and one-line notices that refer to one.
_FIRST = [
    ("MIT", "MIT License\n\nCopyright (c) <year> <holders>\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n" + _PERMISSION),
    ("ISC", "ISC License\n\nCopyright <year> <holder>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AUTHOR),
    ("0BSD", "BSD Zero Clause License\n\nCopyright (c) <year> <holder>\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _AUTHOR),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
]

# Headings that short licences are published under, after which the copyright line or the text follows.
HEADINGS = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License"],
    "Zlib": ["zlib License", "The zlib License"],
    "Unlicense": ["The Unlicense"],
}

_GNU = [("GPL", "GNU General Public License", "1.0 2.0 3.0"), ("LGPL", "GNU Lesser General Public License", "2.1 3.0"), ("LGPL", "GNU Library General Public License", "2.0"), ("AGPL", "GNU Affero General Public License", "3.0"), ("GFDL", "GNU Free Documentation License", "1.2 1.3")]
_CC = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]


def _names() -> Iterator[tuple[str, str]]:
    """Each licence with the names that notices give it."""
    for license, headings in HEADINGS.items():
        yield from ((license, re.sub(r"(?i)^the | \(MIT\)", "", h)) for h in headings)
    for license, full in (("Apache-2.0", "Apache License"), ("MPL-1.1", "Mozilla Public License"), ("MPL-2.0", "Mozilla Public License"), ("Artistic-1.0", "Artistic License")):
        short, version = license.split("-")
        yield from ((license, name) for name in (f"{short} {version}", f"{short} License {version}", f"{full} {version}", f"{full}, Version {version}", f"{full} v{version}"))
    for short, full, versions in _GNU:
        for version in versions.split():
            for v in dict.fromkeys([version, version.removesuffix(".0")]):
                yield from ((f"{short}-{version}", name) for base in (full, short, f"GNU {short}") for name in (f"{base}, version {v}", f"{base} v{v}", f"{base}v{v}"))
    for short, full in _CC:
        for version, where in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            yield from ((f"CC-{short}-{version}", name) for name in (f"CC {short} {version}", f"Creative Commons {full} {version}", f"Creative Commons {full} {version} {where}"))
    yield from (("CC0-1.0", name) for name in ("CC0 1.0", "CC0 1.0 Universal"))


def _notices() -> Iterator[tuple[str, str]]:
    names = list(_names())
    for license in dict.fromkeys(license for license, _ in names):
        ids = [license, *(f"{license}-{which}" for which in ("only", "or-later") if "GPL" in license or "GFDL" in license)]
        yield from ((license, f"{tag}: {own}") for own in ids for tag in ("SPDX-License-Identifier", "License"))
    for license, name in names:
        for what in [name, f"the {name}"] + ([] if "License" in name else [f"the {name} License", f"a {name} License"]):
            for subject in ("", "This work is ", "This project is ", "This software is ", "This file is "):
                yield from ((license, f"{subject}{verb} under {what}.") for verb in ("licensed", "released", "distributed"))


def _unwrapped(text: str) -> str:
    """Each paragraph in one line; lines of copyright alone stay lines."""
    return re.sub(r"(?i)((?:^|\n)[ \t]*copyright \([^\n]*\n)|([^\n])\n(?!\n|[ \t]*copyright \()[ \t]*", lambda m: m[1] or m[2] + " ", text)


def _wholes() -> Iterator[tuple[str, str]]:
    """Whole texts with and without heading and appendix, in the published lines and unwrapped."""
    published = [(license, text.split("\n\n", 1)[1]) for license, text in _FIRST[:3]]
    for file in sorted(files("sitegrade.llm").joinpath("license_texts").iterdir(), key=lambda f: f.name):
        published.append((file.name.removesuffix(".txt").split("--")[0], file.read_text(encoding="utf-8")))
    for license, text in published:
        end = re.search(r"\n[ \t]*END OF TERMS AND CONDITIONS[^\n]*\n", text)
        bodies = [text, text[: end.end()], text[: end.start()]] if end else [text]
        if license == "Unlicense":
            bodies.append(text.split("For more information")[0] + "For more information, please refer to <https://unlicense.org>")
        for body in bodies:
            for head in ("", *(f"{h}\n\n" for h in HEADINGS.get(license, []))):
                yield license, head + body
                yield license, head + _unwrapped(body)


KNOWN = [*_FIRST, *dict.fromkeys([*_wholes(), *_notices()])]

_COPYRIGHT = r"(^|\n)[ \t#*/;-]*(copyright|\(c\)|©)[^\n]*"
_RIGHTS = r"all rights reserved\.?"
_PUNCTUATION = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f‘’“”–—…]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_lines(text: Column) -> Column:
    """The lines of a text, without blank and copyright lines, in one case, spelling and spacing, without punctuation."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, _COPYRIGHT, "\n")
    out = F.regexp_replace(out, _RIGHTS, "")
    for spelling, usual in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(usual))
    out = F.regexp_replace(out, _PUNCTUATION, " ")
    lines = F.transform(F.split(out, "\n"), lambda line: F.btrim(line))
    return F.filter(lines, lambda line: line != "")


def canonical_text(lines: Column) -> Column:
    return F.array_join(lines, " ")


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """``digest, license`` of known texts, pairs or a table of ``license, text``; of two licences with one canonical text the smaller name stays."""
    texts = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "license string, text string")
    digest = F.sha2(canonical_text(canonical_lines(F.col("text"))), 256)
    return texts.select("license", digest.alias("digest")).groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Licences of each document: ``doc_id, digest, license, n_notices, notices, n_rows``.

    The whole text and each of its lines are made canonical and looked up by
    digest.  ``license`` is the licence that the whole text is, ``notices`` the
    names, in order and joined by commas, of those whose whole text is one of
    its lines, ``n_notices`` the number of such lines.  Nothing shorter than a
    line is matched, so a text that talks about a licence is not taken for it.

    Rows that share id and canonical lines give one row, with their number in
    ``n_rows``; a null id is an id of its own.  Null texts count as empty: empty
    texts, and texts of copyright lines alone, have the digest of the empty
    string and no licence unless ``known`` lists one.  No rows, no result; other
    columns are not read.
    """
    lines = canonical_lines(F.col("text"))
    whole = F.struct(F.lit(True).alias("whole"), canonical_text(F.col("lines")).alias("unit"))
    each = F.transform("lines", lambda line: F.struct(F.lit(False).alias("whole"), line.alias("unit")))
    units = (
        docs.select("doc_id", lines.alias("lines"))
        .select("doc_id", F.sha2(F.array_join("lines", "\n"), 256).alias("key"), F.explode(F.concat(F.array(whole), each)).alias("u"))
        .select("doc_id", "key", "u.whole", F.sha2("u.unit", 256).alias("digest"))
    )
    found = units.join(known, "digest", "left")
    notice = ~F.col("whole") & F.col("license").isNotNull()
    return (
        found.groupBy("doc_id", "key")
        .agg(
            F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
            F.max(F.when(F.col("whole"), F.col("license"))).alias("license"),
            F.sum(F.when(notice, 1).otherwise(0)).alias("lines"),
            F.array_join(F.sort_array(F.collect_set(F.when(notice, F.col("license")))), ",").alias("notices"),
            F.sum(F.when(F.col("whole"), 1).otherwise(0)).alias("n_rows"),
        )
        .select("doc_id", "digest", "license", F.expr("lines div n_rows").alias("n_notices"), "notices", "n_rows")
    )


def _sql_canonical(text: str) -> str:
    out = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    out = f"regexp_replace({out}, '{_COPYRIGHT}', chr(10), 'g')"
    out = f"regexp_replace({out}, '{_RIGHTS}', '', 'g')"
    for spelling, usual in SPELLINGS:
        out = f"replace({out}, '{spelling}', '{usual}')"
    out = f"regexp_replace({out}, '{_PUNCTUATION}', ' ', 'g')"
    return f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"


def oracle() -> str:
    known = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN)
    return f"""
WITH known_lines AS (SELECT license, {_sql_canonical("t")} AS l FROM (VALUES {known}) AS k(license, t)),
known AS (SELECT sha256(array_to_string(l, ' ')) AS digest, min(license) AS license FROM known_lines GROUP BY 1),
docs AS (SELECT doc_id, {_sql_canonical("text")} AS l FROM documents),
wholes AS (SELECT doc_id, array_to_string(l, chr(10)) AS k, sha256(coalesce(array_to_string(l, ' '), '')) AS digest, count(*) AS n_rows, any_value(l) AS l FROM docs GROUP BY ALL),
hits AS (SELECT w.doc_id, w.k, count(*) AS n, string_agg(DISTINCT known.license, ',' ORDER BY known.license) AS names
  FROM (SELECT doc_id, k, unnest(l) AS line FROM wholes) w JOIN known ON sha256(w.line) = known.digest GROUP BY 1, 2)
SELECT w.doc_id, w.digest, known.license, coalesce(h.n, 0) AS n_notices, coalesce(h.names, '') AS notices, w.n_rows
FROM wholes w LEFT JOIN known USING (digest) LEFT JOIN hits h ON h.doc_id IS NOT DISTINCT FROM w.doc_id AND h.k = w.k
"""
