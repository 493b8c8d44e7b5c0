"""Licence scan by sentence rules: sentences become identifiers, sequences of identifiers are matched against ordered rules.

A text is cut into pieces at line feeds and at sentence marks followed by white space, each with its place in the text. A
sentence is a piece, or pieces of consecutive lines (none of them blank) that the line feeds of a wrapped text cut apart: the
pieces are joined where only together they are a known sentence or tell its version. A sentence is normalised (lower case; comment and list marks, punctuation and repeated white space become one blank; 'licence'
becomes 'license'; a leading 'see', 'it is', 'this file is' and the like is cut off by its pattern) and looked up: first among
fixed sentences, then among patterns with open places (years, holders, versions). The identifiers of a text, in order, with
at most GAP other lines between two (a wrapped sentence counts as one line), are matched against the rules from the longest to the shortest; an identifier is
used by one rule only. What no rule uses is reported as unmatched.

Every known sentence holds a word that starts with, or contains, one of CUES or matches CC, so texts and sentences without any are passed
over; the whole text is searched for them. Cues are parts of single words, so no mark or white space inside a sentence hides one. Nothing is shuffled and each text is handled by itself.

Defined cases: a null or empty text has no sentences; equal sentences are matched one by one, and `licenses` names each licence
once, sorted; repeated rows are scanned one by one; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUES = ("licens", "licenc", "copyright", "reserved", "warrant", "permission", "redistribut", "domain", "spdx", "creative", "gpl", "endorse", "liab")
# 'cc by', 'CC-BY', 'cc0' and the like, as they stand before they are normalised.
CC = r"(?<![^\W_])cc[\W_]*(?:by|0|zero)"
GAP = 3

# Sentences of public licences, normalised.
SENTENCES = {
    "all rights reserved": "rights-reserved",
    "licensed under the apache license version 2.0": "apache-2.0-grant",
    "licensed under the apache license version 2.0 the license": "apache-2.0-grant",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "released under the mit license": "mit-grant",
    "licensed under the mit license": "mit-grant",
    "this project is licensed under the mit license": "mit-grant",
    "the mit license": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-permission",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-permission",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied": "mit-warranty",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-permission",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc-permission",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-permission",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-warranty",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc-liability",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is dedicated to the public domain": "public-domain",
    "this program is distributed in the hope that it will be useful but without any warranty": "gnu-warranty",
}

# Sentences with open places, tried in this order.
PATTERNS = [
    (r"spdx license identifier:? (?P<v>[a-z0-9.+ -]+)", "spdx"),
    (r"(?:.* )?(?:licensed under|released under|terms of|distributed under|under) (?:the )?(?:gnu )?(?:lesser general public license|lgpl)(?: as published by the free software foundation)?(?: either)?(?: version | ?v)?(?P<v>[0-9.]+)?.*", "lgpl-grant"),
    (r"(?:.* )?(?:licensed under|released under|terms of|distributed under|under) (?:the )?(?:gnu )?(?:affero general public license|agpl)(?: as published by the free software foundation)?(?: either)?(?: version | ?v)?(?P<v>[0-9.]+)?.*", "agpl-grant"),
    (r"(?:.* )?(?:licensed under|released under|terms of|distributed under|under) (?:the )?(?:gnu general public license|gnu gpl|gpl)(?: as published by the free software foundation)?(?: either)?(?: version | ?v)?(?P<v>[0-9.]+)?.*", "gpl-grant"),
    (r"(?:.* )?(?:subject to|under) the terms of the mozilla public license v(?:ersion)? ?(?P<v>[0-9.]+).*", "mpl-grant"),
    (r"(?:.* )?(?:licensed under|released under|under|available under) (?:the |a )?(?:creative commons|cc)[ -]?(?P<v>by(?: nc)?(?: sa| nd)?|0|zero)(?: license)?(?: (?P<n>[0-9.]+))?.*", "cc-grant"),
    (r"(?:.* )?(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit license.*", "mit-grant"),
    (r"(?:.* )?(?:licensed|released|distributed|available) under (?:the )?apache license(?: version)? ?2(?:\.0)?.*", "apache-2.0-grant"),
    (r"(?:.* )?(?:licensed|released|distributed|available) under (?:the )?(?:(?P<v>[23]) clause )?bsd(?: (?P<n>[23]) clause)? license.*", "bsd-grant"),
    (r"neither the names? of .{1,100} nor the names of (?:its|their|the) contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-endorse"),
    (r"this software is provided by .{1,100} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed", "bsd-warranty"),
    (r"in no event shall .{1,100} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services", "bsd-liability"),
    (r"copyright (?:c )?(?:[0-9]{4}(?: [0-9]{4})*)?.{0,200}", "copyright"),
]

# Ordered rules: identifiers in this order make the licence. Longer rules come first.
RULES = [
    (("mit-title", "copyright", "mit-permission", "mit-notice", "mit-warranty", "mit-liability"), "MIT"),
    (("mit-permission", "mit-notice", "mit-warranty", "mit-liability"), "MIT"),
    (("bsd-permission", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty", "bsd-liability"), "BSD"),
    (("bsd-permission", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty"), "BSD"),
    (("bsd-permission", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD"),
    (("bsd-permission", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability"), "BSD"),
    (("bsd-permission", "bsd-source", "bsd-binary", "bsd-warranty"), "BSD"),
    (("apache-2.0-grant", "apache-compliance", "apache-copy", "apache-warranty", "apache-see"), "Apache-2.0"),
    (("isc-permission", "isc-warranty", "isc-liability"), "ISC"),
    (("isc-permission", "isc-warranty"), "ISC"),
    (("mit-title", "copyright", "mit-permission", "mit-notice", "mit-warranty"), "MIT"),
    (("mit-permission", "mit-notice", "mit-warranty"), "MIT"),
    (("bsd-permission", "bsd-source", "bsd-binary"), "BSD"),
    (("apache-2.0-grant", "apache-compliance", "apache-copy"), "Apache-2.0"),
    (("isc-permission", "mit-warranty"), "ISC"),
    (("gpl-grant", "gnu-warranty"), "GPL"),
    (("lgpl-grant", "gnu-warranty"), "LGPL"),
    (("agpl-grant", "gnu-warranty"), "AGPL"),
    (("copyright", "rights-reserved"), "Proprietary"),
    (("mit-permission", "mit-notice"), "MIT"),
    (("apache-2.0-grant",), "Apache-2.0"),
    (("mit-grant",), "MIT"),
    (("mit-title",), "MIT"),
    (("mit-permission",), "MIT"),
    (("bsd-permission",), "BSD"),
    (("bsd-grant",), "BSD"),
    (("isc-permission",), "ISC"),
    (("gpl-grant",), "GPL"),
    (("lgpl-grant",), "LGPL"),
    (("agpl-grant",), "AGPL"),
    (("mpl-grant",), "MPL"),
    (("cc-grant",), "CC"),
    (("spdx",), "SPDX"),
    (("unlicense",), "Unlicense"),
    (("public-domain",), "Public-Domain"),
    (("rights-reserved",), "Proprietary"),
]

_CUE = re.compile("|".join([*map(re.escape, CUES), CC]), re.IGNORECASE)
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?;](?=\s)|\n|$)")
_WORDLIKE = re.compile(r"[^\W_]")
_MARKS = re.compile(r"[^\w.+:]+|_")
_END = re.compile(r"(?<![0-9a-z])\.+|\.+(?![0-9])|:(?!\s)")
_COMPILED = [(re.compile(p), name) for p, name in PATTERNS]
# No wrapped sentence is longer once normalised: the longest fixed one, which leaves open places of patterns their room.
_LONGEST = max(map(len, SENTENCES))
_ORDERED = sorted(RULES, key=lambda r: -len(r[0]))


def normalised(sentence: str) -> str:
    lowered = _MARKS.sub(" ", sentence.lower().replace("licence", "license"))
    return " ".join(_END.sub(" ", lowered).replace(":", " ").split())


def _paragraphs(text: str):
    """Runs of lines with letters or digits, as lists of (line number, start, end)."""
    block = []
    for number, (start, end) in enumerate(_lines(text)):
        if _WORDLIKE.search(text, start, end):
            block.append((number, start, end))
        elif block:
            yield block
            block = []
    if block:
        yield block


def _pieces(text: str, block):
    """(line number, start, end, whether only the line feed ends it) of the pieces of a paragraph."""
    out = []
    for number, start, end in block:
        for m in _SENTENCE.finditer(text, start, end):
            if m.end() > m.start():
                out.append((number, m.start(), m.end(), m.end() == end and text[end - 1] not in ".!?;"))
    return out


def _wrapped(text: str, pieces, i: int, alone):
    """(last piece, identified) of the sentence that starts with piece i and runs over line feeds, or None.

    A fixed sentence counts whole, the longest one first. A pattern counts from the last piece that it needs; where it is known without
    the further lines, they only add its version.
    """
    fixed = loose = None
    size, j = len(normalised(text[pieces[i][1] : pieces[i][2]])), i
    while pieces[j][3] and j + 1 < len(pieces) and size <= _LONGEST:
        j += 1
        size += 1 + len(normalised(text[pieces[j][1] : pieces[j][2]]))
        if size > _LONGEST or not _CUE.search(text, pieces[i][1], pieces[j][2]):
            continue
        body = normalised(text[pieces[i][1] : pieces[j][2]])
        if body in SENTENCES:
            fixed = j, (SENTENCES[body], "")
            continue
        so_far = loose[1] if loose else alone
        if so_far and so_far[1]:
            continue
        known = identify(text[pieces[i][1] : pieces[j][2]])
        if known is None or known[0] == "spdx":
            continue  # a tag stands on one line
        if so_far is None:
            if identify(text[pieces[i + 1][1] : pieces[j][2]]) is None:
                loose = j, known
        elif known[0] == so_far[0] and known[1]:
            loose = j, known
    return fixed or loose


def sentences(text: str):
    """(number, start, end, identifier, detail) of every known sentence; numbers count lines, a wrapped sentence as one."""
    swallowed = 0
    for block in _paragraphs(text):
        if not _CUE.search(text, block[0][1], block[-1][2]):
            continue
        pieces, i = _pieces(text, block), 0
        while i < len(pieces):
            number, start, end, is_open = pieces[i]
            known = identify(text[start:end]) if _CUE.search(text, start, end) else None
            longer = _wrapped(text, pieces, i, known) if is_open else None
            last = i
            if longer:
                last, known = longer
            if known:
                yield number - swallowed, start, pieces[last][2], *known
            swallowed += pieces[last][0] - number
            i = last + 1


def _lines(text: str):
    start = 0
    while start <= len(text):
        end = text.find("\n", start)
        end = len(text) if end < 0 else end
        yield start, end
        start = end + 1


def identify(sentence: str) -> tuple[str, str] | None:
    """(identifier, detail) of a known sentence; the detail is a version or variant."""
    body = normalised(sentence)
    if body in SENTENCES:
        return SENTENCES[body], ""
    for pattern, name in _COMPILED:
        m = pattern.fullmatch(body)
        if m:
            groups = m.groupdict()
            detail = "-".join(x for x in (groups.get("v"), groups.get("n")) if x)
            return name, detail.strip(" .").replace(" ", "-")
    return None


def match(found: list[tuple[int, int, int, str, str]]) -> list[tuple[str, int, int]]:
    """(licence, start, end) for identified sentences (line number, start, end, identifier, detail), in the order of the text."""
    used = [False] * len(found)
    out = []
    for rule, licence in _ORDERED:
        for i, first in enumerate(found):
            if used[i] or first[3] != rule[0]:
                continue
            chosen = [i]
            for want in rule[1:]:
                j = chosen[-1] + 1
                while j < len(found) and (used[j] or found[j][3] != want) and found[j][0] - found[chosen[-1]][0] <= GAP:
                    j += 1
                if j == len(found) or used[j] or found[j][3] != want or found[j][0] - found[chosen[-1]][0] > GAP + 1:
                    break
                chosen.append(j)
            if len(chosen) < len(rule):
                continue
            for j in chosen:
                used[j] = True
            detail = next((found[j][4] for j in chosen if found[j][4]), "")
            name = detail.upper() if licence == "SPDX" else licence + (f"-{detail.upper()}" if detail else "")
            out.append((name, found[chosen[0]][1], found[chosen[-1]][2]))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def scan(text: str | None) -> tuple[list[str], list[tuple[str, int, int]], list[str]]:
    """Licences of one text (sorted, once each), the matches with their places, and identifiers that no rule used."""
    if not text or not _CUE.search(text):
        return [], [], []
    found = list(sentences(text))
    matches = match(found)
    covered = {(s, e) for _, s, e in matches}
    loose = [f[3] for f in found if not any(s <= f[1] and f[2] <= e for s, e in covered)]
    return sorted({m[0] for m in matches}), matches, loose


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, licenses (array), matches (array of licence, start, end; places in code points), unmatched (identifiers)."""
    kind = pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            done = [scan(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([d[0] for d in done], pa.list_(pa.string())),
                    pa.array([[{"license": a, "start": b, "end": c} for a, b, c in d[1]] for d in done], pa.list_(kind)),
                    pa.array([d[2] for d in done], pa.list_(pa.string())),
                ],
                ["doc_id", "licenses", "matches", "unmatched"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, licenses array<string>, matches array<struct<license: string, start: int, end: int>>, unmatched array<string>"
    )
