"""License statements by ordered signature rules behind a keyword prefilter."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import as_bytes, kept_in_worker, small

# The phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Public license families as label, words of which each of its names holds one, name (a
# pattern over words), versions with a label of their own. Words are lower case and joined by one space;
# dots have become spaces.
FAMILIES: list[tuple[str, str, str, tuple[str, ...]]] = [
    ("mit", "mit", r"(?:the )?mit(?: x11)?", ()),
    ("x11", "x11", r"(?:the )?x11", ()),
    ("isc", "isc", r"(?:the )?isc", ()),
    ("apache", "apache", r"(?:the )?apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("agpl", "affero agpl", r"(?:the )?(?:gnu )?(?:affero general public|agpl)", ("1 0", "3 0")),
    ("lgpl", "lesser library lgpl", r"(?:the )?(?:gnu )?(?:lesser general public|library general public|lgpl)", ("2 0", "2 1", "3 0")),
    ("gpl", "general gpl", r"(?:the )?(?:gnu )?(?:general public|gpl)", ("1 0", "2 0", "3 0")),
    ("fdl", "documentation fdl", r"(?:the )?(?:gnu )?(?:free documentation|fdl)", ("1 1", "1 2", "1 3")),
    ("bsd", "berkeley bsd", r"(?:the )?(?:berkeley software distribution|bsd)", ()),
    ("bsd-2", "bsd freebsd", r"(?:the )?(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", ()),
    ("bsd-3", "bsd", r"(?:the )?(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", ()),
    ("mpl", "mozilla mpl", r"(?:the )?(?:mozilla public|mpl)", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse epl", r"(?:the )?(?:eclipse public|epl)", ("1 0", "2 0")),
    ("cddl", "development cddl", r"(?:the )?(?:common development and distribution|cddl)", ("1 0", "1 1")),
    ("cpl", "common cpl", r"(?:the )?(?:common public|cpl)", ("1 0",)),
    ("eupl", "european eupl", r"(?:the )?(?:european union public|eupl)", ("1 1", "1 2")),
    ("artistic", "artistic", r"(?:the )?artistic", ("1 0", "2 0")),
    ("zlib", "zlib", r"(?:the )?zlib(?: libpng)?", ()),
    ("boost", "boost bsl", r"(?:the )?(?:boost software|bsl)", ("1 0",)),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "fuck wtfpl", r"(?:the )?(?:do what the fuck you want to public|wtfpl)", ("2 0",)),
    ("python", "python psf", r"(?:the )?(?:python software foundation|psf)", ("2 0",)),
    ("php", "php", r"(?:the )?php", ("3 0", "3 01")),
    ("postgresql", "postgresql", r"(?:the )?postgresql", ()),
    ("openssl", "openssl", r"(?:the )?openssl", ()),
    ("ofl", "font ofl", r"(?:the )?(?:sil )?(?:open font|ofl)", ("1 0", "1 1")),
    ("odbl", "database odbl", r"(?:the )?(?:open database|odbl)", ("1 0",)),
    ("odc-by", "commons", r"(?:the )?open data commons attribution", ("1 0",)),
    ("pddl", "dedication pddl", r"(?:the )?(?:public domain dedication and|pddl)", ("1 0",)),
    ("openrail", "rail openrail", r"(?:the )?(?:creativeml )?open ?rail(?: m)?", ("1 0",)),
    ("sspl", "server sspl", r"(?:the )?(?:server side public|sspl)", ("1 0",)),
    ("elastic", "elastic", r"(?:the )?elastic", ("1 0", "2 0")),
    ("ms-pl", "microsoft", r"(?:the )?microsoft public", ()),
    ("ms-rl", "reciprocal", r"(?:the )?microsoft reciprocal", ()),
    ("cecill", "cecill", r"(?:the )?cecill", ("1 0", "2 0", "2 1")),
    ("upl", "universal", r"(?:the )?universal permissive", ("1 0",)),
    ("cc0", "zero cc0", r"(?:creative commons zero|creative commons cc0|cc0|cc zero)", ("1 0",)),
    ("cc-by-nc-nd", "creative cc", r"(?:creative commons|cc)(?: attribution| by)(?: noncommercial| non commercial| nc)(?: no ?derivatives| no ?derivs| nd)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "creative cc", r"(?:creative commons|cc)(?: attribution| by)(?: noncommercial| non commercial| nc)(?: share ?alike| sa)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "creative cc", r"(?:creative commons|cc)(?: attribution| by)(?: noncommercial| non commercial| nc)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "creative cc", r"(?:creative commons|cc)(?: attribution| by)(?: no ?derivatives| no ?derivs| nd)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "creative cc", r"(?:creative commons|cc)(?: attribution| by)(?: share ?alike| sa)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "creative cc", r"(?:creative commons|cc)(?: attribution| by)", ("2 0", "2 5", "3 0", "4 0")),
]

# Statements in the words of public licenses and of common notices, as label, priority, words
# that the statement cannot do without, pattern.
STATEMENTS: list[tuple[str, int, str, str]] = [
    ("mit", 70, "permission charge", r"permission is hereby granted free of charge to any person obtaining a copy(?: of this software)?"),
    ("mit", 70, "substantial portions", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit", 65, "sublicense merge", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("mit", 60, "noninfringement merchantability", r"warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", 60, "holders claim", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", 72, "contained advertising", r"except as contained in this notice the names? of (?:[^ ]+ ){1,8}?shall not be used in advertising or otherwise to promote the sale"),
    ("ncsa", 80, "deal merge", r"to deal with the software without restriction including without limitation the rights to use copy modify merge"),
    ("ncsa", 72, "disclaimers redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("isc", 70, "permission fee", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee"),
    ("isc", 65, "disclaims regard", r"the author disclaims all warranties with regard to this software"),
    ("0bsd", 80, "permission fee provided", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("hpnd", 70, "permission documentation", r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose"),
    ("bsd", 70, "redistribution binary", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 70, "redistributions retain", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 70, "redistributions reproduce", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 60, "regents", r"this software is provided by the regents and contributors as is"),
    ("bsd", 60, "contributors holders", r"this software is provided by the copyright holders and contributors as is"),
    ("bsd", 60, "exemplary consequential", r"be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd-3", 75, "neither endorse", r"neither the names? of (?:[^ ]+ ){1,12}?nor the names of (?:its|the|their) contributors may be used to endorse or promote products"),
    ("bsd-4", 75, "advertising acknowledgement", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("zlib", 70, "provided implied", r"this software is provided as is without any express or implied warranty"),
    ("zlib", 75, "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", 75, "altered plainly", r"altered source versions must be plainly marked as such"),
    ("zlib", 70, "altered removed", r"this notice may not be removed or altered from any source distribution"),
    ("zlib", 65, "held arising", r"in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("apache", 70, "compliance", r"you may not use this file except in compliance with the license"),
    ("apache", 70, "basis writing", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache", 75, "asf", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2.0", 90, "apache org", r"(?:www )?apache org licenses license 2 0"),
    ("apache-2.0", 85, "asl", r"(?:the )?asl 2 0"),
    ("apache-1.1", 70, "apache developed", r"this product includes software developed by the apache (?:software foundation|group)"),
    ("apache", 60, "patent terminate", r"any patent licenses granted to you under this license for that work shall terminate"),
    ("gpl", 75, "redistribute modify gnu", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 76, "redistribute modify gnu", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", 76, "redistribute modify affero", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", 60, "verbatim copies", r"everyone is permitted to copy and distribute verbatim copies of this license"),
    ("gpl", 65, "redistribute free", r"this program is free software you can redistribute it"),
    ("lgpl", 65, "redistribute library", r"this library is free software you can redistribute it"),
    ("gpl", 72, "received gnu general", r"you should have received a copy of the gnu general public license"),
    ("lgpl", 72, "received gnu", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("agpl", 72, "received affero", r"you should have received a copy of the gnu affero general public license"),
    ("gpl", 72, "details gnu general", r"see the gnu general public license for more details"),
    ("lgpl", 72, "details gnu", r"see the gnu (?:lesser|library) general public license for more details"),
    ("agpl", 72, "details affero", r"see the gnu affero general public license for more details"),
    ("gpl", 50, "copyleft", r"(?:strong )?copyleft licen[cs]e"),
    ("gpl-2.0", 88, "gnu org", r"gnu org (?:licenses )?(?:old licenses )?gpl 2 0"),
    ("gpl-3.0", 88, "gnu org", r"gnu org (?:licenses )?gpl 3 0"),
    ("lgpl-2.1", 88, "gnu org", r"gnu org (?:licenses )?(?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", 88, "gnu org", r"gnu org (?:licenses )?lgpl 3 0"),
    ("agpl-3.0", 88, "gnu org", r"gnu org (?:licenses )?agpl 3 0"),
    ("fdl-1.3", 88, "gnu org", r"gnu org (?:licenses )?fdl 1 3"),
    ("gpl-exception", 75, "statically dynamically", r"linking (?:this library|[^ ]+) statically or dynamically with other modules is making a combined work"),
    ("gpl-exception", 75, "gcc exception", r"gcc runtime library exception"),
    ("gpl-exception", 75, "classpath exception", r"(?:subject to the )?classpath exception"),
    ("fdl", 75, "documentation permission", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("fdl", 60, "invariant sections", r"with no invariant sections"),
    ("mpl-2.0", 92, "mozilla", r"this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0"),
    ("mpl-1.1", 92, "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl", 75, "mpl distributed", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-2.0", 88, "mozilla org", r"mozilla org mpl 2 0"),
    ("epl-1.0", 92, "accompanying eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v|version )1 0"),
    ("epl-2.0", 92, "accompanying eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0"),
    ("epl-1.0", 88, "eclipse org", r"eclipse org (?:legal|org documents) epl v10(?: html)?"),
    ("epl-2.0", 88, "eclipse org", r"eclipse org legal epl 2 0"),
    ("cddl", 75, "contents development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("boost", 80, "organization accompanying", r"free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("boost-1.0", 85, "boost org", r"boost org license 1 0(?: txt)?"),
    ("unlicense", 85, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 75, "anyone compile", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", 85, "unlicense org", r"refer to https? unlicense org"),
    ("wtfpl", 75, "fuck", r"you just do what the fuck you want to"),
    ("beerware", 80, "stuff retain", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("json", 85, "evil good", r"the software shall be used for good not evil"),
    ("blessing", 80, "evil good", r"may you do good and not evil"),
    ("cc0", 60, "waived neighboring", r"(?:has|have) waived all copyright and related (?:or|and) neighboring rights"),
    ("cc0", 60, "extent possible law", r"to the extent possible under law"),
    ("cc0-1.0", 88, "creativecommons zero", r"creativecommons org publicdomain zero 1 0"),
    ("cc0", 40, "rights reserved no", r"no rights reserved"),
    ("creative-commons", 30, "commons creative", r"(?:under|by) (?:a|the|an) creative commons(?: licen[cs]e)?"),
    ("creative-commons", 30, "rights reserved some", r"some rights reserved"),
    ("public-domain", 70, "creativecommons mark", r"creativecommons org publicdomain mark 1 0"),
    ("public-domain", 50, "domain public", r"(?:dedicated|released|placed|put) (?:in|to|into) the public domain"),
    ("public-domain", 40, "domain public", r"this (?:work|text|page|document|file) is in the public domain"),
    ("public-domain", 60, "government work", r"(?:is )?a work of the (?:united states|u s|us) government"),
    ("public-domain", 60, "copyright code", r"the authors? (?:hereby )?disclaims? copyright to this source code"),
    ("ofl-1.1", 92, "font sil", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl", 75, "font components", r"neither the font software nor any of its individual components"),
    ("ofl", 70, "reserved font", r"with reserved font names?"),
    ("ofl", 80, "scripts sil", r"scripts sil org ofl"),
    ("artistic", 70, "perl itself", r"(?:under )?the same terms as perl itself"),
    ("ruby", 75, "bsdl", r"under either the terms of the 2 clause bsdl"),
    ("ruby", 60, "ruby terms", r"under the same terms as ruby"),
    ("python", 75, "psf licensee", r"psf (?:is making python|hereby grants licensee) (?:[^ ]+ ){0,6}?(?:available to licensee|royalty free)"),
    ("php-3.01", 92, "php subject", r"this source file is subject to version 3 01 of the php license"),
    ("openssl", 75, "openssl developed", r"this product includes software developed by the openssl project"),
    ("ssleay", 75, "cryptographic written", r"this product includes cryptographic software written by eric young"),
    ("postgresql", 75, "california party", r"in no event shall the university of california be liable to any party"),
    ("curl", 70, "advertising holder", r"the name of a copyright holder shall not be used in advertising"),
    ("ijg", 80, "jpeg independent", r"(?:based in part on )?the work of the independent jpeg group"),
    ("freetype", 80, "freetype portions", r"portions of this software are copyright (?:[^ ]+ ){0,3}?the freetype project"),
    ("freetype", 75, "freetype", r"(?:the )?freetype (?:project )?licen[cs]e"),
    ("libpng", 75, "libpng", r"(?:the )?libpng licen[cs]e"),
    ("info-zip", 75, "zip info", r"(?:the )?info zip licen[cs]e"),
    ("imagemagick", 75, "imagemagick", r"(?:the )?imagemagick licen[cs]e"),
    ("unicode", 75, "unicode", r"unicode licen[cs]e(?: agreement| v3)?"),
    ("w3c", 75, "w3c", r"w3c (?:software|document)(?: and document)? (?:notice and )?licen[cs]e"),
    ("vim", 60, "charityware", r"vim is charityware"),
    ("vim", 75, "vim", r"(?:the )?vim licen[cs]e"),
    ("afl", 75, "academic", r"academic free licen[cs]e"),
    ("osl", 75, "open software", r"(?:the )?open software licen[cs]e"),
    ("apsl", 75, "apple", r"apple public source licen[cs]e"),
    ("ipl", 75, "ibm", r"ibm public licen[cs]e"),
    ("lucent", 75, "lucent", r"lucent public licen[cs]e"),
    ("sun", 75, "sun", r"sun (?:public|industry standards source) licen[cs]e"),
    ("intel", 75, "intel", r"intel open source licen[cs]e"),
    ("nokia", 75, "nokia", r"nokia open source licen[cs]e"),
    ("sybase", 75, "sybase", r"sybase open watcom public licen[cs]e"),
    ("reciprocal", 75, "reciprocal", r"reciprocal public licen[cs]e"),
    ("blue-oak-1.0", 85, "oak blue", r"blue oak model licen[cs]e(?: 1 0 0)?"),
    ("mulan-2.0", 85, "mulan", r"mulan (?:psl|permissive software licen[cs]e)(?: version| v)? ?2"),
    ("busl-1.1", 85, "business source", r"business source licen[cs]e(?: version)? 1 1"),
    ("polyform", 75, "polyform", r"polyform (?:noncommercial|small business|shield|perimeter) licen[cs]e"),
    ("commons-clause", 85, "clause commons", r"commons clause licen[cs]e condition"),
    ("commons-clause", 75, "grant sell", r"the license does not grant to you the right to sell the software"),
    ("elastic-2.0", 85, "hosted managed", r"you may not provide the software to third parties as a hosted or managed service"),
    ("sspl-1.0", 85, "functionality modified", r"make the functionality of the program or a modified version available to third parties as a service"),
    ("cecill", 80, "cecill french", r"governed by the cecill(?: [abc])? licen[cs]e under french law"),
    ("odbl-1.0", 88, "opendatacommons odbl", r"opendatacommons org licenses odbl 1 0"),
    ("odc-by-1.0", 88, "opendatacommons by", r"opendatacommons org licenses by 1 0"),
    ("pddl-1.0", 88, "opendatacommons pddl", r"opendatacommons org licenses pddl 1 0"),
    ("openrail", 60, "restrictions paragraph", r"use based restrictions as referenced in paragraph 5"),
    ("llama", 85, "llama community", r"llama [234](?: [0-9])? community licen[cs]e(?: agreement)?"),
    ("gemma", 85, "gemma terms", r"gemma terms of use"),
    ("proprietary", 75, "copying medium", r"unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    ("proprietary", 40, "proprietary confidential", r"proprietary and confidential"),
    ("proprietary", 60, "trade secret", r"is protected by trade secret or copyright law"),
    ("proprietary", 50, "reproduced prior written", r"may (?:not )?be reproduced (?:[^ ]+ ){0,12}?without (?:the )?(?:express )?prior written (?:permission|consent)"),
    ("noncommercial", 40, "only for", r"for non ?commercial (?:use|purposes) only"),
    ("noncommercial", 40, "academic only", r"for academic (?:and research )?(?:use|purposes) only"),
    ("noncommercial", 30, "personal only", r"for personal use only"),
    ("all-rights-reserved", 20, "rights reserved all", r"all rights reserved"),
    ("copyright", 10, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
]

_LICENSE = r" licen[cs]e"
_SEPARATORS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


@dataclass(frozen=True)
class Rule:
    """A signature: of two overlapping detections the higher priority wins if it contains the other.

    A text must have a word of each of the `gates` before the pattern is tried.
    """

    label: str
    priority: int
    gates: tuple[frozenset[bytes], ...]
    pattern: re.Pattern


def _version(words: str) -> str:
    """A pattern for a version written 2 0: the last part may be left out where it is 0."""
    return rf"(?: version| v| ver)?(?: |(?<= v)){_number(words)}"


def _number(words: str) -> str:
    major, minor = words.split()
    return f"{major}(?: {minor})?" if minor == "0" else words


@cache
def rules() -> tuple[Rule, ...]:
    """All signatures in order of priority: the written forms of each family and version, and the statements."""
    out = []

    def add(label: str, priority: int, pattern: str, *gates: str) -> None:
        coded = re.compile(rf"(?<= )(?:{pattern})(?= )".encode())
        out.append(Rule(label, priority, tuple(frozenset(g.encode().split()) for g in gates), coded))

    named, given = "license licence", "licensed licenced"
    for label, keys, name, versions in FAMILIES:
        for version in versions:
            own, at = f"{label}-{version.replace(' ', '.')}", _version(version)
            major = version.split()[0]
            number = f"{major} v{major}"
            later = r" or(?: at your option)?(?: any)? later(?: versions?)?"
            notice = (
                rf"{name}{_LICENSE} as published by the free software foundation(?: either)? version {_number(version)}"
                r"(?: of the licen[cs]e)?"
            )
            add(f"{own}-or-later", 102, rf"spdx licen[cs]e identifier {name}{at} or later", "spdx", keys)
            add(f"{own}-only", 102, rf"spdx licen[cs]e identifier {name}{at} only", "spdx", keys)
            add(own, 100, rf"spdx licen[cs]e identifier {name}{at}", "spdx", keys, number)
            add(f"{own}-or-later", 98, rf"{notice}{later}", "foundation", keys, major, "later")
            add(own, 97, notice, "foundation", keys, major)
            add(f"{own}-or-later", 95, rf"{name}(?:{_LICENSE})?{at}(?:{_LICENSE})?{later}", keys, number, "later")
            add(own, 90, rf"licen[cs]ed under (?:the terms of )?(?:a |an )?{name}(?:{_LICENSE})?{at}", given, keys, number)
            add(own, 85, rf"{name}(?:{_LICENSE})?{at}{_LICENSE}", keys, named, number)
            add(own, 80, rf"{name}{_LICENSE}{at}", keys, named, number)
            if label.isalpha():
                add(own, 78, rf"(?:the )?(?:gnu )?{label}v{_number(version)}", f"{label}v{major}")
            if label.startswith("cc-by"):
                add(own, 88, rf"creativecommons org licenses {label[3:].replace('-', ' ')} {version}", "creativecommons")
        add(label, 75, rf"spdx licen[cs]e identifier {name}", "spdx", keys)
        add(label, 65, rf"(?:released|distributed|available|licen[cs]ed) under (?:the terms of )?(?:a |an )?{name}", keys, "under")
        add(label, 55, rf"under the terms of (?:a |an )?{name}{_LICENSE}", keys, "terms")
        add(label, 50, rf"{name}{_LICENSE}", keys, named)
        add(label, 45, rf"{name} open source{_LICENSE}", keys, named)
    for label, priority, words, pattern in STATEMENTS:
        add(label, priority, pattern, *words.split())
    return tuple(sorted(out, key=lambda r: (-r.priority, r.label, r.pattern.pattern)))


@dataclass(frozen=True)
class Detection:
    first: int
    end: int
    label: str
    priority: int


def suppress(found: list[Detection]) -> list[Detection]:
    """Detections that lie in no other of at least their priority, by start; of equal ones the first.

    Priorities are swept from the highest, each in the order of starts: a detection lies in an earlier one
    if the furthest end so far, or among the higher ones that start no later, is not before its own.
    """
    kept: list[Detection] = []
    starts: list[int] = []
    reach: list[int] = []
    ordered = sorted(found, key=lambda d: (-d.priority, d.first, -d.end, d.label))
    for _, same in groupby(ordered, key=lambda d: d.priority):
        end = -1
        before = len(kept)
        for d in same:
            above = bisect_right(starts, d.first)
            if d.end > end and not (above and reach[above - 1] >= d.end):
                kept.append(d)
            end = max(end, d.end)
        if len(kept) > before:
            kept.sort(key=lambda d: d.first)
            starts = [d.first for d in kept]
            reach = list(accumulate((d.end for d in kept), max))
    return sorted(kept, key=lambda d: (d.first, d.end))


class Scanner:
    """The rules by the words that open them."""

    def __init__(self):
        self.rules = rules()
        self.opens: dict[bytes, list[int]] = {}
        for number, rule in enumerate(self.rules):
            for word in rule.gates[0]:
                self.opens.setdefault(word, []).append(number)
        self.words = frozenset(w for r in self.rules for g in r.gates for w in g) | {b"license"}
        self.base = [
            (re.compile(rf"(?<= )(?={phrase} )".encode()), label) for phrase, label in BASE_PHRASES.items()
        ]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[Detection]]:
        """Places of the base phrases as (word, label), and the detections that remain."""
        seen = self.words.intersection(words)
        tried = {number for w in seen for number in self.opens.get(w, ())}
        tried = [r for r in map(self.rules.__getitem__, sorted(tried)) if not any(map(seen.isdisjoint, r.gates))]
        if not tried and b"license" not in seen:
            return [], []
        line = b" " + b" ".join(words) + b" "
        blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20)

        def places(pattern: re.Pattern) -> tuple[list[int], list[int]]:
            """First words and numbers of words of all matches."""
            spans = [(m.start(), m[0].count(b" ") + 1) for m in pattern.finditer(line)]
            if not spans:
                return [], []
            at, sizes = zip(*spans, strict=True)
            return (np.searchsorted(blanks, at) - 1).tolist(), list(sizes)

        base = [(i, label) for pattern, label in self.base for i in places(pattern)[0]] if b"license" in seen else []
        found = [
            Detection(first, first + size, rule.label, rule.priority)
            for rule in tried
            for first, size in zip(*places(rule.pattern), strict=True)
        ]
        return base, suppress(found)


_DETECTIONS = "array<struct<first: long, words: long, label: string, priority: int>>"
_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    f"labels string, score double, detections {_DETECTIONS}"
)


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """License statements in each whole text, one row per document.

    Words are runs of ASCII digits, ASCII letters (A-Z in lower case) and all other characters beyond
    ASCII. n_base counts the places of BASE_PHRASES, first_word and last_word are their smallest and
    largest start (NULL without any). `detections` are the signatures found, without those that lie in
    one of at least their priority. `labels` joins base labels and those of detections; `score` is 1
    less the chance that all are wrong, where a detection of priority p is right with p / 110. NULL and
    empty texts have no words. No rule is tried on a text without its keywords. Rows of equal doc_id are
    scanned each for itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept_in_worker(("license rules",), Scanner)
        for batch in small(batches):
            rows = []
            for value in as_bytes(batch.column(1)):
                words = (value or b"").lower().translate(_SEPARATORS).split()
                base, found = scanner.scan(words)
                wrong = 0.5 if base else 1.0
                for d in found:
                    wrong *= 1 - d.priority / 110
                starts = [i for i, _ in base]
                names = {label for _, label in base}
                rows.append(
                    {
                        "n_words": len(words),
                        "n_base": len(base),
                        "first_word": min(starts, default=None),
                        "last_word": max(starts, default=None),
                        "base_labels": ",".join(sorted(names)),
                        "labels": ",".join(sorted(names | {d.label for d in found})),
                        "score": 1 - wrong,
                        "detections": [
                            {"first": d.first, "words": d.end - d.first, "label": d.label, "priority": d.priority}
                            for d in found
                        ],
                    }
                )
            if rows:
                table = pa.RecordBatch.from_pylist(rows, schema=_arrow_schema())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *table.columns], names=["doc_id", *table.schema.names]
                )

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, _SCHEMA)


def _arrow_schema() -> pa.Schema:
    whole, words = pa.int64(), pa.string()
    detection = pa.struct(
        [("first", whole), ("words", whole), ("label", words), ("priority", pa.int32())]
    )
    return pa.schema(
        [
            ("n_words", whole),
            ("n_base", whole),
            ("first_word", whole),
            ("last_word", whole),
            ("base_labels", words),
            ("labels", words),
            ("score", pa.float64()),
            ("detections", pa.list_(detection)),
        ]
    )
