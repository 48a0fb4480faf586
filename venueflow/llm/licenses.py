"""License scans by canonical digest.

A text is normalised (lower case, copyright lines dropped, equivalent spellings unified, punctuation
and layout gone) and hashed. Entire texts are joined by digest to known licenses; so are single
lines, to known one-line notices. Everything is Column expressions, and the same normalisation is
written out for DuckDB.

Defined results: a null text counts as an empty one, whose digest is that of nothing and never
matches; very long texts are hashed whole; repeated rows and null ids are handled row by row; an
empty table gives an empty one.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COPYRIGHT_LINE = (
    r"^[\x20\x09*#/;-]*(copyright[\x20\x09]*(\(c\)|©|[0-9]{4}|\[|<|:)|copyright[\x20\x09]+by|\(c\)[0-9]{4}|\(c\)[\x20\x09](?!you[\x20\x09])|©|all rights reserved"
    r"|copyright[\x20\x09]+the[\x20\x09][^,;:]*[\x20\x09](authors|contributors|developers|project|team|foundation)\b[\x20\x09.]*(all rights reserved\.?)?[\x20\x09]*$)"
)
# Equivalent spellings (fixed values), applied in this order to lower-case text.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("https://", "http://"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"), ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"), ("per cent", "percent"), ("copyright holder(s)", "copyright holders"), ("(s)", "s"),
)
NOTICE_HINT = "licen|public domain|cc0"  # every known notice holds one of these

# Known one-line notices and license texts (fixed values).
NOTICES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC0-1.0": ("This work is in the public domain (CC0 1.0).",),
}
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
LICENSES = {
    "MIT": (
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        f"Software.\n\n{_WARRANTY}"
    ),
    "ISC": (
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        f"{_ISC_WARRANTY}"
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        f"granted.\n\n{_ISC_WARRANTY}"
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source "
        "distribution."
    ),
}


_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BSD = {
    "BSD-2-Clause": f"BSD 2-Clause License\n\n{_BSD_HEAD}{_BSD_WARRANTY}",
    "BSD-3-Clause": f"BSD 3-Clause License\n\n{_BSD_HEAD}{_BSD_THIRD}{_BSD_WARRANTY}",
}
# Long texts as files: the license named, and the file under license_texts.
FILES = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}


def _untitled(texts: dict[str, str]) -> list[tuple[str, str, str]]:
    """(kind, license, text) of whole texts, with and without their title line."""
    rows = []
    for name, text in texts.items():
        rows.append(("license", name, text))
        title, _, rest = text.partition("\n\n")
        if title.endswith("License"):
            rows.append(("license", name, rest))
    return rows


def known() -> list[tuple[str, str, str]]:
    """(kind, license, text) of everything known; licenses with and without their title line."""
    folder = Path(__file__).parent / "license_texts"
    files = []
    for name, file in FILES.items():
        text = (folder / file).read_text(encoding="utf-8")
        files.append(("license", name, text))
        terms, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        if end:  # often given without the advice on how to apply them
            files.append(("license", name, terms + end))
    notices = [("notice", name, text) for name, texts in NOTICES.items() for text in texts]
    return notices + _untitled(LICENSES) + _untitled(BSD) + files


def canonical(text: Column) -> Column:
    """The normalised text: words of letters, digits and dots inside numbers, one blank between them."""
    lines = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), lambda x: ~x.rlike(COPYRIGHT_LINE))
    out = F.array_join(lines, " ")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(out, r"[^a-z0-9]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_table(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """(kind, digest, license): a few rows, from the fixed tables above and the whole texts of ``more(license, text)``."""
    df = spark.createDataFrame(known(), "kind string, license string, text string")
    if more is not None:
        fixed = df.select(digest(F.col("text")).alias("fixed_digest")).distinct()
        added = more.filter(F.col("license").isNotNull() & (canonical(F.col("text")) != "")).select(F.lit("license").alias("kind"), "license", "text")
        # One license a digest: the fixed texts first, then the smallest name.
        added = added.join(fixed, digest(F.col("text")) == fixed["fixed_digest"], "left_anti")
        df = df.union(added.groupBy("kind", digest(F.col("text")).alias("d")).agg(F.min_by("text", "license").alias("text"), F.min("license").alias("license")).select("kind", "license", "text"))
    return df.select("kind", digest(F.col("text")).alias("known_digest"), "license").distinct()


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: DataFrame | None = None) -> DataFrame:
    """doc_id, digest, license (of the entire text, or null) and notices (licenses named by entire lines, joined by commas).

    ``more(license, text)`` adds whole license texts to the known ones.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    table = known_table(spark, more)
    licenses = table.filter("kind = 'license'").select("known_digest", "license")
    notices = table.filter("kind = 'notice'").agg(F.map_from_entries(F.collect_list(F.struct("known_digest", "license"))).alias("by_digest")).first()["by_digest"]
    by_digest = F.create_map(*[F.lit(x) for pair in sorted(notices.items()) for x in pair])
    hinted = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: F.lower(x).rlike(NOTICE_HINT))
    named = F.array_sort(F.array_distinct(F.array_compact(F.transform(hinted, lambda x: F.element_at(by_digest, digest(x))))))
    rows = rows.select("doc_id", digest(F.col("text")).alias("digest"), F.array_join(named, ",").alias("notices"))
    # The fixed digests are a few dozen rows; a caller's table may be of any size.
    joined = rows.join(F.broadcast(licenses) if more is None else licenses, rows["digest"] == licenses["known_digest"], "left")
    return joined.select("doc_id", "digest", "license", "notices")


def sql() -> str:
    """The same scan for DuckDB."""

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    # DuckDB has no lookahead: "(c) you" is stated as a second pattern, and lines that match both are
    # copyright lines only if the rest of the rule takes them.
    you = r"\(c\)[\x20\x09](?!you[\x20\x09])"
    plain, rest = COPYRIGHT_LINE.replace(you, r"\(c\)[\x20\x09]"), COPYRIGHT_LINE.replace(you + "|", "")
    # Java's "$" also matches before a last carriage return.
    plain, rest = (x.replace("$)", r"\r?$)") for x in (plain, rest))
    spared = r"^[\x20\x09*#/;-]*\(c\)[\x20\x09]you[\x20\x09]"

    def dropped(line: str) -> str:
        return f"(regexp_matches({line}, {q(plain)}) AND (NOT regexp_matches({line}, {q(spared)}) OR regexp_matches({line}, {q(rest)})))"

    def norm(expr: str) -> str:
        out = f"array_to_string(list_filter(string_split(lower(coalesce({expr}, '')), chr(10)), lambda l: NOT {dropped('l')}), ' ')"
        for old, new in SPELLINGS:
            out = f"replace({out}, {q(old)}, {q(new)})"
        return f"sha256(trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g')))"

    values = ", ".join(f"({q(kind)}, {q(name)}, {q(text)})" for kind, name, text in known())
    return f"""
    WITH k AS (SELECT DISTINCT kind, name, {norm("body")} AS digest FROM (VALUES {values}) AS v(kind, name, body)),
    d AS (SELECT doc_id, text, {norm("text")} AS digest FROM documents),
    l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
    n AS (SELECT doc_id, string_agg(DISTINCT k.name, ',' ORDER BY k.name) AS notices
          FROM (SELECT doc_id, {norm("line")} AS digest FROM l WHERE regexp_matches(lower(line), '{NOTICE_HINT}')) x
          JOIN k ON k.kind = 'notice' AND k.digest = x.digest GROUP BY doc_id)
    SELECT d.doc_id, d.digest, k.name AS license, coalesce(n.notices, '') AS notices
    FROM d LEFT JOIN k ON k.kind = 'license' AND k.digest = d.digest LEFT JOIN n ON n.doc_id = d.doc_id
    """
