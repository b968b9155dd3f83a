"""Licence recognition by sentences: known sentences become identifiers, rules match their sequences.

1. A text is cut into sentences: at line ends and after `.`, `;`, `:`, `!` or `?` before a space. A second
   cut joins the lines of a paragraph first, so that wrapped sentences are found as well.
2. A sentence is normalised: lower case, comment marks and punctuation dropped (a dot inside a number
   stays), `licence` spelled `license`. The normalised sentence is looked up among the known ones;
   a few of them have a blank for a name or a year and are looked up by pattern.
3. The identifiers found, in order, are matched against the rules, in order of precedence: a rule
   takes the earliest place where its identifiers follow one another, with at most `GAP` other known
   sentences between them; what a rule took is gone for the later ones.

The tables are of fixed size and travel with the code; texts without any cue word are not cut at all.

Cases: null and empty texts have no sentences; repeated rows give repeated results; null doc_ids are
passed on; an empty table gives an empty result; other columns are ignored; texts are used whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from farelake.llm.common import keyed, rekeyed

#: Known sentences, normalised. The wording of the licences and of their usual notices.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2.0",
    "apache-notice-the": "licensed under the apache license version 2.0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license mit",
    "mit-heading": "mit license",
    "mit-heading-the": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-notice": "use of this source code is governed by a bsd-style license that can be found in the license file",
    "gpl-free": "this program is free software",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl3-later": "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-later": "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "mpl2-notice": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "cc-by-notice": "licensed under cc by 4.0",
    "cc-by-sa-notice": "licensed under cc by-sa 4.0",
    "cc-by-nc-notice": "licensed under cc by-nc 4.0",
    "cc-by-nd-notice": "licensed under cc by-nd 4.0",
    "cc0-notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "bsd-third": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-advert": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "isc-grant-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",
    "zlib-asis": "this software is provided as-is without any express or implied warranty",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-origin": "the origin of this software must not be misrepresented",
    "bsl-title": "boost software license version 1.0 august 17th 2003",
    "bsl-notice": "distributed under the boost software license version 1.0",
    "bsl-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third-parties to whom the software is furnished to do so all subject to the following",
    "epl2-title": "eclipse public license v 2.0",
    "epl1-title": "eclipse public license v 1.0",
    "epl2-notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org/legal/epl-2.0",
    "apache-title": "apache license",
    "apache-date": "version 2.0 january 2004",
    "mpl2-title": "mozilla public license version 2.0",
    "cc0-title": "cc0 1.0 universal",
    "artistic2-title": "the artistic license 2.0",
    "wtfpl-title": "do what the fuck you want to public license",
    "gpl-apply": "how to apply these terms to your new programs",
    "lgpl-apply": "how to apply these terms to your new libraries",
}

#: The GNU licences: identifier, name in their notices, and the versions with the date below the title.
GNU = [
    ("GPL", "gnu general public license", {"2": "version 2 june 1991", "3": "version 3 29 june 2007"}),
    ("LGPL", "gnu lesser general public license", {"2.1": "version 2.1 february 1999", "3": "version 3 29 june 2007"}),
    ("LGPL", "gnu library general public license", {"2": "version 2 june 1991"}),
    ("AGPL", "gnu affero general public license", {"3": "version 3 19 november 2007"}),
]
TERMS = "{} it and/or modify it under the terms of the {} as published by the free software foundation"
LATER = "either version {} of the license or at your option any later version"
#: Both halves of a notice, for a semicolon between them, and the halves joined, for a comma.
for _, _name, _versions in GNU:
    _key = _name.split()[1]
    SENTENCES[f"{_key}-title"] = _name
    SENTENCES[f"{_key}-terms"] = TERMS.format("you can redistribute", _name)
    for _v, _date in _versions.items():
        SENTENCES |= {_date.replace(" ", "-"): _date, f"later-{_v}": LATER.format(_v)}
        SENTENCES |= {f"only-{_v}": f"version {_v} of the license", f"plain-{_v}": f"version {_v}"}
        for _kind, _half in (("later", LATER.format(_v)), ("only", f"version {_v} of the license"), ("plain", f"version {_v}")):
            if (_whole := f"{SENTENCES[f'{_key}-terms']} {_half}") not in SENTENCES.values():
                SENTENCES[f"{_key}-{_kind}-{_v}"] = _whole

ENDORSE = "be used to endorse or promote products derived from this software without specific prior written permission"
#: Known sentences with a blank.
PATTERNS = {
    "gpl-free": r"(?:\S+ ){1,8}is free software",
    "gpl-hope": r"(?:\S+ ){1,8}is distributed in the hope that it will be useful but without any warranty",
    # A name as "Inc." ends a sentence, so the first half may be missing.
    "bsd-third": rf"(?:neither (?:the )?names? of (?:\S+ )+?)?nor (?:the )?names? of (?:\S+ )+?may {ENDORSE}"
    rf"|(?:the )?names? of (?:\S+ )+?may not {ENDORSE}",
    "copyright": r"(?:copyright|\(c\)|©)(?: \(c\)| ©)? .*\S",
    "rights": r"all rights reserved",
}
#: An expression of identifiers, as the text spells it.
SPDX = re.compile(r"spdx-license-identifier:\s*(\(?[\w.+-]+\)?(?:\s+(?:and|or|with)\s+\(?[\w.+-]+\)?)*)", re.I)

#: Names of licences in notices of the form "... is licensed under the <name>", normalised. Fixed values.
NAMES = {
    "Apache-2.0": r"apache(?: software)?(?: license)?(?: version| v)?[ -]?v?2(?:\.0)?(?: license)?",
    "MIT": r"mit(?:/expat)?(?: license)?|expat license",
    "BSD-3-Clause": r"(?:bsd 3-clause|3-clause bsd|bsd-3-clause|new bsd|modified bsd|revised bsd)(?: license)?",
    "BSD-2-Clause": r"(?:bsd 2-clause|2-clause bsd|bsd-2-clause|simplified bsd)(?: license)?",
    "ISC": r"isc license",
    "MPL-2.0": r"mozilla public license(?: version)? v?\.? ?2\.0|mpl[ -]v?2\.0",
    "EPL-2.0": r"eclipse public license(?: version| -)? v?2\.0",
    "Unlicense": r"unlicense",
    "CC0-1.0": r"(?:creative commons )?cc0(?: 1\.0)?(?: universal)?(?: license| public domain dedication)?",
}
for _code, _words in (
    ("BY", "attribution"),
    ("BY-SA", "attribution[- ]sharealike"),
    ("BY-NC", "attribution[- ]noncommercial"),
    ("BY-ND", "attribution[- ]noderivatives"),
    ("BY-NC-SA", "attribution[- ]noncommercial[- ]sharealike"),
    ("BY-NC-ND", "attribution[- ]noncommercial[- ]noderivatives"),
):
    for _version in ("4.0", "3.0"):
        _number = _version.replace(".", r"\.")
        NAMES[f"CC-{_code}-{_version}"] = (
            rf"(?:creative commons {_words}|(?:creative commons )?cc[ -]{_code.lower()})[ -]{_number}"
            r"(?: international| unported)?(?: public)?(?: license)?"
        )
for _short, _long, _numbers in (
    ("GPL", "gnu general public license|gnu gpl|gpl", "23"),
    ("LGPL", "gnu lesser general public license|gnu lgpl|lgpl", "23"),
    ("AGPL", "gnu affero general public license|gnu agpl|agpl", "3"),
):
    for _version in _numbers:
        _number = {"LGPL2": r"2\.1"}.get(_short + _version, rf"{_version}(?:\.0)?")
        _shown = {"LGPL2": "2.1"}.get(_short + _version, f"{_version}.0")
        _body = rf"(?:{_long})(?: license)?[ -]?(?:version |v\.? ?)?{_number}"
        NAMES[f"{_short}-{_shown}-or-later"] = rf"{_body}(?:\+| or(?: at your option)?(?: any)? later(?: version)?)"
        NAMES[f"{_short}-{_shown}-only"] = rf"{_body}(?: only)?(?: license)?"

#: Any work, but no denial of it, then how it is given, then a name.
GIVEN = re.compile(
    r"(?:(?!(?:not|never|nor|neither|cannot|no|without|isn|aren)\b)\S+ )*?"
    r"(?:licensed|released|distributed|published|provided|available|offered|shared|covered)(?: to you)?(?: freely)? "
    r"(?:under|subject to|by)(?: the| an?)?(?: terms(?: and conditions)? of(?: the| an?)?)? (?P<name>.+)"
)
NAMED = [(f"notice-{licence}", re.compile(rf"(?:{pattern})(?: terms)?")) for licence, pattern in NAMES.items()]

#: Licence (or none) and the identifiers that show it, in order of precedence.
RULES: list[tuple[str | None, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-notice-the", "apache-comply", "apache-copy", "apache-asis", "apache-see")),
    ("MIT", ("mit-grant", "mit-keep", "mit-asis")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-third")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-third")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-later")),
    ("Apache-2.0", ("apache-notice-the", "apache-comply")),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-notice-the",)),
    ("MIT", ("mit-heading", "mit-grant", "mit-keep", "mit-asis")),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-heading",)),
    ("MIT", ("mit-heading-the",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-notice",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-2.0-only", ("gpl2-notice",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("Unlicense", ("unlicense-free",)),
    ("ISC", ("isc-grant-and",)),
    ("0BSD", ("0bsd-grant",)),
    ("Zlib", ("zlib-asis", "zlib-grant", "zlib-origin")),
    ("Zlib", ("zlib-grant", "zlib-origin")),
    ("BSL-1.0", ("bsl-title", "bsl-grant")),
    ("BSL-1.0", ("bsl-grant",)),
    ("BSL-1.0", ("bsl-notice",)),
    ("BSL-1.0", ("bsl-title",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("EPL-2.0", ("epl2-title",)),
    ("EPL-1.0", ("epl1-title",)),
    ("Apache-2.0", ("apache-title", "apache-date")),
    ("MPL-2.0", ("mpl2-title",)),
    ("CC0-1.0", ("cc0-title",)),
    ("Artistic-2.0", ("artistic2-title",)),
    ("WTFPL", ("wtfpl-title",)),
]
KNOWN = {sentence: name for name, sentence in SENTENCES.items()}


def gnu_rules() -> list[tuple[str | None, tuple[str, ...]]]:
    """Notices of the GNU licences, with and without their first and last sentences, and titles of full texts.

    The sample notice at the end of a full text shows no licence.
    """
    rules = []
    for licence, name, versions in GNU:
        key = name.split()[1]
        see = {"general": "gpl-see", "lesser": "lgpl-see"}.get(key, "gpl-see")
        for version, date in versions.items():
            number = version if "." in version else f"{version}.0"
            terms = SENTENCES[f"{key}-terms"]
            for half, suffix in ((LATER.format(version), "or-later"), (f"version {version} of the license", "only"), (f"version {version}", "only")):
                for body in ((KNOWN[f"{terms} {half}"],), (f"{key}-terms", KNOWN[half])):
                    rules += [(None, (apply, "gpl-free", *body)) for apply in ("gpl-apply", "lgpl-apply")]
                    for rule in (("gpl-free", *body, "gpl-hope", see), ("gpl-free", *body), body):
                        rules.append((f"{licence}-{number}-{suffix}", rule))
            rules.append((f"{licence}-{number}-only", (f"{key}-title", KNOWN[date])))
    return sorted(rules, key=lambda rule: -len(rule[1]))


SAMPLES = [rule for rule in gnu_rules() if rule[0] is None]
RULES = SAMPLES + RULES + [rule for rule in gnu_rules() if rule[0] and rule not in RULES]
#: Notices with a blank for the work come last.
NOTICES: list[tuple[str | None, tuple[str, ...]]] = [(licence, (f"notice-{licence}",)) for licence in NAMES]
GAP = 3

#: Every known sentence and pattern has one of these words; words, as a line may end between two of them.
CUE = re.compile(
    r"licen[sc]e|copyright|permission|redistribut|warrant|domain|unencumbered|\(c\)|©|software|reserved|contributors"
    r"|universal|version|how to apply|advertising|subject|released|available|published|\bunder\b",
    re.I,
)
SENTENCE_END = re.compile(r"(?<=[.;:!?])(?<!identifier:)(?<!\bv\.)\s+", re.I)
LINE = re.compile(r"[^\n]+")
PARAGRAPH = re.compile(r"[^\n]+(?:\n[^\n\S]*[^\n\s][^\n]*)*")
COMMENT = re.compile(r"^\s*(?:/\*+|\*+/?|//+|#+|;+|--+|%+|<!--|dnl\b|rem\b)\s?", re.I | re.M)
DROPPED = re.compile(r"[^\w\s./()©-]+|(?<!\w)[./-]+|[./-]+(?!\w)|[()](?<!\(c\))(?!c\))")
BLANKS = [(name, re.compile(pattern)) for name, pattern in PATTERNS.items()]


def normalised(sentence: str) -> str:
    """Lower-case words joined by single spaces."""
    plain = COMMENT.sub("", sentence).lower().replace("licence", "license").replace("v. 2.0", "v.2.0")
    return " ".join(DROPPED.sub(" ", plain).split()).replace("v.2.0", "v. 2.0")


def identify(sentence: str) -> str | None:
    """Identifier of a sentence, if it is known."""
    words = normalised(sentence)
    if words in KNOWN:
        return KNOWN[words]
    if spdx := SPDX.search(sentence):
        # As the text spells it, without brackets around the whole.
        found = " ".join(spdx[1].split())
        return f"spdx:{found[1:-1] if found[0] == '(' and found.find(')') == len(found) - 1 else found}"
    for name, pattern in BLANKS:
        if pattern.fullmatch(words):
            return name
    if given := GIVEN.fullmatch(words):
        for name, pattern in NAMED:
            if pattern.fullmatch(given["name"]):
                return name
    return None


def cut(text: str, block: re.Pattern) -> Iterator[tuple[int, int]]:
    """Start and end of every sentence inside the blocks of a text."""
    for found in block.finditer(text):
        start = found.start()
        for end in SENTENCE_END.finditer(text, found.start(), found.end()):
            yield start, end.start()
            start = end.end()
        if start < found.end():
            yield start, found.end()


def sentences(text: str) -> list[tuple[int, int, str]]:
    """Known sentences of a text as (start, end, identifier), in order, none overlapping."""
    if not CUE.search(text):
        return []
    found = []
    for block in (LINE, PARAGRAPH):
        for start, end in cut(text, block):
            if CUE.search(text, start, end) or block is PARAGRAPH:
                name = identify(text[start:end])
                # A copyright line ends with its line, however many words it has.
                if name and not (name == "copyright" and "\n" in text[start:end]):
                    found.append((start, end, name))
    out: list[tuple[int, int, str]] = []
    for start, end, name in sorted(set(found), key=lambda f: (f[0], -f[1])):
        if not out or start >= out[-1][1]:
            out.append((start, end, name))
    return out


def match(names: list[str]) -> list[tuple[int, int, str]]:
    """(first, last, licence) of the rules that a sequence of identifiers meets, in order of place."""
    free = [True] * len(names)
    taken = []

    def follow(rule: tuple[str, ...], at: int) -> list[int]:
        places = [at]
        for wanted in rule[1:]:
            near = range(places[-1] + 1, min(places[-1] + 2 + GAP, len(names)))
            step = next((i for i in near if free[i] and names[i] == wanted), None)
            if step is None:
                return []
            places.append(step)
        return places

    for licence, rule in RULES + NOTICES:
        for at, name in enumerate(names):
            if free[at] and name == rule[0] and (places := follow(rule, at)):
                for i in places:
                    free[i] = False
                if licence:
                    taken.append((places[0], places[-1], licence))
    for at, name in enumerate(names):
        if name.startswith("spdx:"):
            taken.append((at, at, name[5:]))
    return sorted(taken)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, `sentences` (start, end and name of each) and `licences` (first and last sentence, name)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known = [sentences(text or "") for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "sentences": [[{"start": a, "end": b, "name": n} for a, b, n in found] for found in known],
                    "licences": [
                        [{"first": a, "last": b, "name": n} for a, b, n in match([f[2] for f in found])] for found in known
                    ],
                }
            )

    schema = (
        "doc_id string, sentences array<struct<start:int,end:int,name:string>>, "
        "licences array<struct<first:int,last:int,name:string>>"
    )
    return rekeyed(keyed(docs).mapInPandas(run, schema), docs)
