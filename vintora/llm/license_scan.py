"""Licence scan by sentence rules.

Texts are cut into sentences, sentences are normalised (lower case, no quotes, comment marks and white
space between words taken as one space) and mapped to the identifiers of known licence sentences: a
sentence that is one of them is found by its digest; one that holds some, with other words around them
or a version number inside, by patterns. The identifiers of a document, in order, are then matched
against an ordered list of rules: a rule is a sequence of identifiers and names a licence; longer
sequences stand before shorter ones, so that a full licence text is not taken for the mention of
another. Between two of a rule's sentences up to ``GAP`` others may stand, such as clauses that are not
in the table. Identifiers that no rule takes are reported as they are, since a text with half a licence
needs a look.

Every document is scanned whole inside its own task; there is no shuffle.

Defined results: null and empty texts, and rows without a known sentence, have no licence and empty
lists. Repeated rows get equal results, rows with a null id are scanned too. A sentence that holds
several known ones, or one several times, counts as each, in order of appearance. Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licences, normalised; {version} stands for a number.
SENTENCES = {
    "MIT-grant": "permission is hereby granted, free of charge, to any person obtaining a copy",
    "MIT-notice": "the above copyright notice and this permission notice shall be included in all",
    "MIT-asis": "the software is provided as is, without warranty of any kind",
    "MIT-liability": "in no event shall the authors or copyright holders be liable",
    "MIT-mention": "under the mit license",
    "BSD-grant": "redistribution and use in source and binary forms, with or without modification,"
                 " are permitted",
    "BSD-source": "redistributions of source code must retain the above copyright notice",
    "BSD-binary": "redistributions in binary form must reproduce the above copyright notice",
    "BSD-advertising": "all advertising materials mentioning features or use of this software must",
    "BSD-endorse": "neither the name of",
    "BSD-asis": "this software is provided by the copyright holders and contributors as is",
    "BSD-mention": "under the bsd license",
    "BSD-clauses": "under the bsd {version}-clause license",
    "Apache-mention": "licensed under the apache license, version {version}",
    "Apache-use": "you may not use this file except in compliance with the license",
    "Apache-copy": "you may obtain a copy of the license at",
    "Apache-asis": "distributed under the license is distributed on an as is basis",
    "GPL-later": "under the terms of the gnu general public license as published by the free"
                 " software foundation, either version {version} of the license, or at your option"
                 " any later version",
    "GPL-warranty": "this program is distributed in the hope that it will be useful",
    "GPL-copy": "you should have received a copy of the gnu general public license",
    "GPL-mention": "licensed under the gnu general public license, version {version}",
    "LGPL-mention": "licensed under the gnu lesser general public license, version {version}",
    "AGPL-mention": "licensed under the gnu affero general public license, version {version}",
    "MPL-mention": "subject to the terms of the mozilla public license, v. {version}",
    "ISC-grant": "permission to use, copy, modify, and/or distribute this software for any purpose"
                 " with or without fee is hereby granted",
    "ISC-asis": "the software is provided as is and the author disclaims all warranties",
    "ISC-notice": "provided that the above copyright notice and this permission notice appear in all"
                  " copies",
    "X11-endorse": "except as contained in this notice, the name of",
    "OpenSSL-product": "this product includes software developed by the openssl project",
    "Zlib-asis": "this software is provided as-is, without any express or implied warranty",
    "Zlib-grant": "permission is granted to anyone to use this software for any purpose, including"
                  " commercial applications, and to alter it and redistribute it freely",
    "Zlib-origin": "the origin of this software must not be misrepresented",
    "Zlib-altered": "altered source versions must be plainly marked as such",
    "Zlib-notice": "this notice may not be removed or altered from any source distribution",
    "BSL-mention": "distributed under the boost software license, version {version}",
    "BSL-grant": "permission is hereby granted, free of charge, to any person or organization"
                 " obtaining a copy of the software and accompanying documentation",
    "BSL-notice": "the copyright notices in the software and this entire statement, including the"
                  " above license grant",
    "GPL-title": "gnu general public license version {version}",
    "GPL-preamble": "the gnu general public license is a free, copyleft license for software and"
                    " other kinds of works",
    "FSF-verbatim": "everyone is permitted to copy and distribute verbatim copies of this license"
                    " document, but changing it is not allowed",
    "GPL-only": "under the terms of the gnu general public license as published by the free"
                " software foundation, version {version}",
    "LGPL-later": "under the terms of the gnu lesser general public license as published by the free"
                  " software foundation, either version {version} of the license, or at your option"
                  " any later version",
    "LGPL-warranty": "this library is distributed in the hope that it will be useful",
    "LGPL-copy": "you should have received a copy of the gnu lesser general public license",
    "LGPL-text": "this version of the gnu lesser general public license incorporates the terms and"
                 " conditions of version {version} of the gnu general public license",
    "AGPL-later": "under the terms of the gnu affero general public license as published by the free"
                  " software foundation, either version {version} of the license, or at your option"
                  " any later version",
    "AGPL-copy": "you should have received a copy of the gnu affero general public license",
    "AGPL-preamble": "the gnu affero general public license is a free, copyleft license for software"
                     " and other kinds of works",
    "MPL-copy": "if a copy of the mpl was not distributed with this file, you can obtain one at",
    "EPL-terms": "made available under the terms of the eclipse public license {version}",
    "EPL-v": "made available under the terms of the eclipse public license v{version}",
    "EPL-mention": "under the eclipse public license, version {version}",
    "CDDL-terms": "subject to the terms of the common development and distribution license",
    "EUPL-mention": "licensed under the eupl, version {version}",
    "Artistic-mention": "under the artistic license {version}",
    "Artistic-preamble": "this license establishes the terms under which a given free software"
                         " package may be copied, modified, distributed, and/or redistributed",
    "Unlicense-grant": "this is free and unencumbered software released into the public domain",
    "Unlicense-anyone": "anyone is free to copy, modify, publish, use, compile, sell, or distribute"
                        " this software",
    "Unlicense-dedicate": "in jurisdictions that recognize copyright laws, the author or authors of"
                          " this software dedicate any and all copyright interest in the software",
    "CC-BY-NC-SA-text": "under a creative commons attribution-noncommercial-sharealike {version}",
    "CC-BY-NC-ND-text": "under a creative commons attribution-noncommercial-noderivatives {version}",
    "CC-BY-NC-text": "under a creative commons attribution-noncommercial {version}",
    "CC-BY-SA-text": "under a creative commons attribution-sharealike {version}",
    "CC-BY-ND-text": "under a creative commons attribution-noderivatives {version}",
    "CC-BY-text": "under a creative commons attribution {version}",
    "CC-firm": "creative commons corporation is not a law firm and does not provide legal services",
    "CC0-waiver": "waived all copyright and related or neighboring rights to",
    "CC-BY-NC-SA-mention": "under cc by-nc-sa {version}",
    "CC-BY-NC-ND-mention": "under cc by-nc-nd {version}",
    "CC-BY-NC-mention": "under cc by-nc {version}",
    "CC-BY-SA-mention": "under cc by-sa {version}",
    "CC-BY-ND-mention": "under cc by-nd {version}",
    "CC-BY-mention": "under cc by {version}",
    "CC0-mention": "under cc0 {version}",
}

# Licences as sequences of the identifiers above, most specific first; a question
# mark makes a sentence optional, the number found replaces {version}.
RULES = [
    ("BSD-4-Clause", "BSD-grant BSD-source BSD-binary BSD-advertising BSD-endorse BSD-asis"),
    ("BSD-3-Clause", "BSD-grant BSD-source BSD-binary BSD-endorse BSD-asis"),
    ("BSD-2-Clause", "BSD-grant BSD-source BSD-binary BSD-asis"),
    ("X11", "MIT-grant MIT-notice MIT-asis MIT-liability? X11-endorse"),
    ("MIT", "MIT-mention? MIT-grant MIT-notice MIT-asis MIT-liability?"),
    ("BSL-{version}", "BSL-mention BSL-grant? BSL-notice? MIT-asis? MIT-liability?"),
    ("BSL", "BSL-grant BSL-notice? MIT-asis? MIT-liability?"),
    ("Zlib", "Zlib-asis? Zlib-grant Zlib-origin? Zlib-altered? Zlib-notice?"),
    ("Apache-{version}", "Apache-mention Apache-use Apache-copy Apache-asis"),
    ("Apache-{version}", "Apache-mention Apache-use? Apache-copy?"),
    ("GPL-{version}-or-later", "GPL-later GPL-warranty? GPL-copy?"),
    ("LGPL-{version}-or-later", "LGPL-later LGPL-warranty? GPL-warranty? LGPL-copy?"),
    ("AGPL-{version}-or-later", "AGPL-later GPL-warranty? AGPL-copy?"),
    ("GPL-{version}-only", "GPL-only GPL-warranty? GPL-copy?"),
    ("LGPL-{version}", "FSF-verbatim? LGPL-text"),
    ("AGPL", "FSF-verbatim? AGPL-preamble"),
    ("GPL-{version}", "GPL-title FSF-verbatim? GPL-preamble?"),
    ("GPL", "FSF-verbatim? GPL-preamble"),
    ("ISC", "ISC-grant ISC-notice? ISC-asis?"),
    ("Unlicense", "Unlicense-grant Unlicense-anyone? Unlicense-dedicate? MIT-asis? MIT-liability?"),
    ("MPL-{version}", "MPL-mention MPL-copy"),
    ("EPL-{version}", "EPL-terms"),
    ("EPL-{version}", "EPL-v"),
    ("EPL-{version}", "EPL-mention"),
    ("CDDL", "CDDL-terms"),
    ("EUPL-{version}", "EUPL-mention"),
    ("Artistic-{version}", "Artistic-mention Artistic-preamble?"),
    ("Artistic", "FSF-verbatim? Artistic-preamble"),
    ("OpenSSL", "OpenSSL-product"),
    ("LGPL-{version}", "LGPL-mention"),
    ("AGPL-{version}", "AGPL-mention"),
    ("GPL-{version}", "GPL-mention"),
    ("MPL-{version}", "MPL-mention"),
    ("BSD-{version}-Clause", "BSD-clauses"),
    ("BSD", "BSD-mention"),
    ("MIT", "MIT-mention"),
    ("CC-BY-NC-SA-{version}", "CC-BY-NC-SA-mention"),
    ("CC-BY-NC-ND-{version}", "CC-BY-NC-ND-mention"),
    ("CC-BY-NC-{version}", "CC-BY-NC-mention"),
    ("CC-BY-SA-{version}", "CC-BY-SA-mention"),
    ("CC-BY-ND-{version}", "CC-BY-ND-mention"),
    ("CC-BY-{version}", "CC-BY-mention"),
    ("CC0-{version}", "CC0-mention"),
    ("CC0", "CC0-waiver"),
    ("CC-BY-NC-SA-{version}", "CC-BY-NC-SA-text"),
    ("CC-BY-NC-ND-{version}", "CC-BY-NC-ND-text"),
    ("CC-BY-NC-{version}", "CC-BY-NC-text"),
    ("CC-BY-SA-{version}", "CC-BY-SA-text"),
    ("CC-BY-ND-{version}", "CC-BY-ND-text"),
    ("CC-BY-{version}", "CC-BY-text"),
]
GAP = 25

# Every known sentence holds one of these or begins a Creative Commons name.
KEYWORDS = ("licen", "permission", "redistribut", "copyright", "warrant", "neither", "advertising",
            "hope", "unencumbered", "misrepresented", "plainly marked", "be removed", "free to copy",
            "of the mpl", "the eupl", "openssl", "as contained in", "commons")
_COMMONS = re.compile(r"(?<![a-z])cc[\s0]")
# White space and comment marks between words; quotes are dropped.
_GAP = re.compile(r"[\s*#/|()]+")
_QUOTES = str.maketrans("", "", "\"'`\u201c\u201d\u2018\u2019")
# The point of "v. 2.0" ends no sentence.
_END = re.compile(r"(?<!\s[vV])[.!?](?=\s|$)|\n\s*\n")


class Found(NamedTuple):
    name: str
    version: str
    first: int
    last: int
    number: int         # of the sentence


class Licence(NamedTuple):
    licence: str
    first: int
    last: int


def patterns() -> dict[str, re.Pattern]:
    out = {}
    for name, sentence in SENTENCES.items():
        before, mark, after = sentence.partition("{version}")
        text = re.escape(_tidy(before)) + (r"(?P<version>\d+(?:\.\d+)*)" + re.escape(_tidy(after))
                                           if mark else "")
        out[name] = re.compile(r"(?<![a-z])" + text + r"(?![a-z])")
    return out


def _digest(plain: str) -> int:
    return xxhash.xxh3_64_intdigest(plain.strip(" .!?,"))


def digests() -> dict[int, str]:
    """The known sentences that have no number in them, by digest."""
    return {_digest(_tidy(sentence)): name for name, sentence in SENTENCES.items()
            if "{version}" not in sentence}


def _tidy(text: str) -> str:
    return _GAP.sub(" ", text.lower().translate(_QUOTES).replace(";", ","))


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Character spans of the sentences of a text."""
    at = 0
    for end in _END.finditer(text):
        yield at, end.end()
        at = end.end()
    if at < len(text):
        yield at, len(text)


def _candidate(low: str) -> bool:
    return any(word in low for word in KEYWORDS) or ("cc" in low and bool(_COMMONS.search(low)))


def identified(text: str, known: dict[str, re.Pattern], whole: dict[int, str]) -> list[Found]:
    """The known sentences of a text, in order."""
    if not _candidate(text.lower()):
        return []
    out = []
    for number, (first, last) in enumerate(sentences(text)):
        part = text[first:last].lower()
        if not _candidate(part):
            continue
        plain = _tidy(part)
        name = whole.get(_digest(plain))
        if name is not None:
            out.append(Found(name, "", first, last, number))
            continue
        hits = sorted((m.start(), -m.end(), name, m.groupdict().get("version") or "")
                      for name, pattern in known.items() for m in pattern.finditer(plain))
        till = -1
        for start, end, name, version in hits:
            # A sentence inside a longer one is not another one.
            if start >= till:
                out.append(Found(name, version, first, last, number))
                till = -end
    return out


def matched(found: list[Found]) -> tuple[list[Licence], list[str]]:
    """(licences in order, identifiers that no rule took)."""
    licences, rest, at = [], [], 0
    while at < len(found):
        for name, sequence in RULES:
            end, version = at, ""
            for part in sequence.split():
                near = end == at or end < len(found) and found[end].number - found[end - 1].number <= GAP + 1
                if near and end < len(found) and found[end].name == part.rstrip("?"):
                    version = version or found[end].version
                    end += 1
                elif not part.endswith("?"):
                    end = at
                    break
            if end > at:
                licences.append(Licence(name.replace("{version}", version), found[at].first,
                                        found[end - 1].last))
                at = end
                break
        else:
            rest.append(found[at].name)
            at += 1
    return licences, rest


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, licences, spans, unmatched) of every document: the distinct licences in order of
    the alphabet, where each was found (first, last: characters), and sentences of none."""
    @F.pandas_udf("licences array<string>, spans array<struct<licence string, first int, last int>>, "
                  "unmatched array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, whole = patterns(), digests()
        for text in batches:
            rows = [matched(identified(t, known, whole)) if t else ([], []) for t in text]
            yield pd.DataFrame({
                "licences": [sorted({x.licence for x in licences}) for licences, _ in rows],
                "spans": [[x._asdict() for x in licences] for licences, _ in rows],
                "unmatched": [rest for _, rest in rows]})
    return docs.select("doc_id", run("text").alias("_found")).select("doc_id", "_found.*")
