"""Licence scan by canonical digests (DataFrame functions only).

A text is made canonical line by line: lower case, letters and digits only, equivalent spellings made one, copyright
notices left out. The digests of whole texts, of their blocks (between blank lines) and of single lines are hash-joined
to the digests of the known licence texts, which go through the same functions.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest registry (characters of licence text) whose digests are broadcast; a larger one is joined by a shuffle.
BROADCAST_CHARS = 256 << 20

# Equivalent spellings, as the licence list matching guidelines have them (a part); none has words of two lines.
SPELLINGS = (
    ("licence", "license"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"),
    ("centre", "center"), ("favour", "favor"), ("fulfil ", "fulfill "), ("judgement", "judgment"), ("labour", "labor"),
    ("organisation", "organization"), ("recognise", "recognize"), ("whilst", "while"), (" holder", " owner"),
    (" percent ", " per cent "), ("noncommercial", "non commercial"), ("http ", "https "),
)

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software."""
_MIT_NO_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
# Licence texts and usual one-line notices; known_texts() adds the files of license_texts.
KNOWN = (
    ("MIT", f"The MIT License\n\n{_MIT_GRANT}\n\n{_MIT_NO_WARRANTY}"),
    ("MIT", f"{_MIT_GRANT}\n\n{_MIT_NO_WARRANTY}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC),
    ("ISC", f"ISC License\n\n{_ISC}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)


# Titles that stand above a text, and first blocks of the notices that stand at the head of source files.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "License: MIT", "(The MIT License)", "The MIT License:", "Expat License"),
    "MIT-0": ("MIT No Attribution", "MIT No Attribution License", "MIT-0"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero Clause BSD License", "0BSD", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License", "BSD License", "The BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License", "BSD License", "The BSD License", "BSD-3-Clause"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License 1.0 (BSL-1.0)"),
    "Unlicense": ("The Unlicense", "Unlicense", "UNLICENSE"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License 2.0 (Apache)"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License 2.0 (MPL)"),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"),
}
#: Texts whose file begins with the title.
TITLED = ("Apache-2.0", "Artistic-1.0-Perl", "BSL-1.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0")
_FREE = "is free software{s} you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by the Free Software Foundation; either version {n} of the License, or (at your option) any later version."
HEADERS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *[(f"{short}-{v}", f"This {what} " + _FREE.format(s=";", name=name, n=n)) for short, name, versions in (
        ("GPL", "", (("2.0", "2"), ("3.0", "3"))), ("LGPL", "Lesser ", (("2.1", "2.1"), ("3.0", "3"))), ("AGPL", "Affero ", (("3.0", "3"),)))
        for v, n in versions for what in ("program", "library", "file")],
)


def known_texts() -> list[tuple[str, str]]:
    """(license_id, text): KNOWN and the files, each as it is, without its title, under its usual titles, and without what
    follows the end of its terms; BSD clauses also with bullets."""
    bodies = [("MIT", f"{_MIT_GRANT}\n\n{_MIT_NO_WARRANTY}"), ("ISC", _ISC)]
    bodies.append(("MIT-0", _MIT_GRANT.split(", subject to")[0] + ".\n\n" + _MIT_NO_WARRANTY))
    bodies.append(("0BSD", re.sub(r", provided that.*?copies\.", ".", _ISC, count=1, flags=re.S)))
    out = [*KNOWN, *HEADERS]
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        name, text = path.stem, path.read_text(encoding="utf-8").strip()
        out.append((name, text))
        body = re.split(r"\n[ \t]*\n", text, maxsplit=1)[1] if name in TITLED else text
        bodies.append((name, body))
        if name.startswith("BSD-"):
            bodies.append((name, re.sub(r"^\d\.", "*", body, flags=re.M)))
        ends = [m.end() for m in re.finditer(r"^.*END OF TERMS AND CONDITIONS.*$", text, re.M)]
        if ends:
            out.append((name, text[: ends[0]]))
            bodies.append((name, body[: ends[0] - len(text) + len(body)]))
    for name, body in bodies:
        out += [(name, body), *((name, f"{title}\n\n{body}") for title in TITLES.get(name, ()))]
    return out


#: Comment marks before a line's words; a bracket stays, as "(c)" begins a notice.
MARKS = r"^(?:\s*(?:@?rem|dnl)(?=\s|$))?[^\p{L}\p{N}(©]*"
# Words that follow "copyright" in the running text of licences, where a line may begin with it.
_RUNNING = (
    "act|and|are|as|at|by law|claims?|disclaimer|doctrines?|for|grants?|holders?|if|in|infringement|information|interests?|is|it|"
    "laws?|licen[cs]es?|licensing|line|lines|management|material|may|notices?|of|on|or|owners?|ownership|patent|permissions?|"
    "protection|resulting|rights?|shall|similar|statements?|status|term|terms|that|the (?:above|software|library|program|work)|this|to|treat(?:y|ies)|under|which|with|work"
)
#: A notice: copyright, (c) or the sign, and a year, a place for it or a holder.
NOTICE = (
    r"^(?:copyright[\s:]*(?:\(c\)|©|[<\[{]|(?:19|20)\d\d)|copyright:?\s+(?!(?:" + _RUNNING + r")(?![\p{L}\p{N}]))[\p{L}\p{N}]"
    r"|©|\(c\)\s*(?:copyright|[<\[{]|(?:19|20)\d\d)|all rights reserved[^\p{L}\p{N}]*$)"
)


def canonical(line: Column) -> Column:
    """A line's letters and digits in lower case, words apart by one blank; empty for a copyright notice. Comment marks go
    first."""
    own = F.regexp_replace(F.lower(line), MARKS, "")
    out = F.concat(F.lit(" "), F.regexp_replace(own, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    begins = own.startswith("copyright") | own.startswith("(c)") | own.startswith("©") | own.startswith("all rights reserved")
    return F.when(begins & own.rlike(NOTICE), "").otherwise(F.trim(out))


def digest(lines: Column) -> Column:
    """Of canonical lines; null if there are none."""
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, " "), 256))


def blocks_of(text: Column) -> Column:
    """The canonical lines of each block (between lines that are blank but for comment marks), without empty ones."""
    blocks = F.split(F.coalesce(text, F.lit("")), r"\r?\n[ \t/*#;%!-]*\r?\n")
    return F.transform(blocks, lambda b: F.filter(F.transform(F.split(b, r"\r?\n"), canonical), lambda x: x != ""))


def parts_of(blocks: Column) -> Column:
    """The distinct lines and whole blocks."""
    return F.array_distinct(F.concat(F.flatten(blocks), F.filter(F.transform(blocks, lambda b: F.array_join(b, " ")), lambda x: x != "")))


def registry(known: DataFrame) -> DataFrame:
    """(digest, license_id) of a table of (license_id, text); of several ids of a digest the smallest."""
    return (
        known.select("license_id", digest(F.flatten(blocks_of(F.col("text")))).alias("digest"))
        .where("digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))
    )


def default_known(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(known_texts(), "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, license_id (of the whole text, else null), part_licenses (sorted distinct
    licences of its blocks and lines), n_parts (distinct blocks and lines that are a licence), canonical_sha256 (null if nothing
    is left). Null text is empty. Rows of equal id and text have equal results; other columns are ignored."""
    known = known if known is not None else default_known(docs.sparkSession)
    wanted = registry(known)
    if (known.agg(F.sum(F.length("text"))).first()[0] or 0) <= BROADCAST_CHARS:
        wanted = F.broadcast(wanted)
    base = docs.select(F.col(id_col).alias("doc_id"), blocks_of(F.col(text_col)).alias("blocks"), F.monotonically_increasing_id().alias("row"))
    # one canonical pass: the whole text's digest (part is false) and those of its parts, which mostly end at the join
    parts = F.transform(parts_of(F.col("blocks")), lambda p: F.struct(F.lit(True).alias("part"), F.sha2(p, 256).alias("digest")))
    whole = F.array(F.struct(F.lit(False).alias("part"), digest(F.flatten("blocks")).alias("digest")))
    each = base.select("doc_id", "row", F.explode(F.concat(whole, parts)).alias("d")).select("doc_id", "row", "d.part", "d.digest")
    each = each.join(wanted, "digest", "left").where(~F.col("part") | F.col("license_id").isNotNull())
    own = F.struct("doc_id", F.col("digest").alias("canonical_sha256"), "license_id")
    out = (
        each.groupBy("row")
        .agg(F.max(F.when(~F.col("part"), own)).alias("own"), F.array_sort(F.collect_set(F.when(F.col("part"), F.col("license_id")))).alias("found"), F.count_if("part").alias("n"))
        .select("own.*", "found", "n")
    )
    return out.select(
        "doc_id", "license_id",
        F.coalesce("found", F.array().cast("array<string>")).alias("part_licenses"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_parts"),
        "canonical_sha256",
    )
