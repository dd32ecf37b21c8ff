"""License scan with ordered signature rules.

A text is read as words (runs of letters and digits, A-Z in lower case) joined by single
spaces, and every rule is a regular expression over that line, anchored at word edges.  One
Aho-Corasick pass finds which of the rules' keywords occur; only rules whose keyword does are
run.  Each detection is an interval of words with its rule's priority; one that lies inside an
accepted detection of higher priority, or of equal priority and greater length (then earlier
rule), is suppressed.  Partly overlapping detections both stay.

The base phrases are counted apart, at every place, and are never suppressed.  The score is one
minus the product of one minus strength over the distinct labels found, a label's strength
being its best priority in percent (base phrases: `BASE_STRENGTH`).

Defined cases: null is the empty text: no words, no labels, score 0; repeated rows get equal
results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from heliovane.llm.common import columns, folded_words, map_texts

# The phrases whose places are counted, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
BASE_STRENGTH = 60

NAMED, GRANTED, CITED, QUOTED, TAGGED = 40, 60, 70, 85, 95

#: Label | keywords, one of which every match holds | how the license is called | how its identifier reads, as words.
NAMES = """
gpl-1.0 | gnu general public license | gnu general public license (?:version|v) ?1 | gpl 1 0(?: only| or later)?
gpl-2.0 | gnu general public license / gnu gpl | gnu (?:general public license|gpl),? (?:version |v ?)2 | gpl 2 0(?: only| or later)?
gpl-3.0 | gnu general public license / gnu gpl | gnu (?:general public license|gpl) (?:version |v ?)3 | gpl 3 0(?: only| or later)?
gplv2 | gplv2 | gplv2 | gplv2
gplv3 | gplv3 | gplv3 | gplv3
gpl-linking | gnu general public license with | gnu general public license with (?:linking|classpath|font) exception | gpl 2 0 with [a-z]+ exception
lgpl | gnu lesser / gnu library | gnu (?:lesser|library) general public license | lgpl
lgpl-2.0 | gnu library general public license | gnu library general public license (?:version |v ?)2 | lgpl 2 0(?: only| or later)?
lgpl-2.1 | gnu lesser general public license | gnu lesser general public license (?:version |v ?)2 1 | lgpl 2 1(?: only| or later)?
lgpl-3.0 | gnu lesser general public license | gnu lesser general public license (?:version |v ?)3 | lgpl 3 0(?: only| or later)?
agpl | gnu affero general public license | gnu affero general public license | agpl
agpl-1.0 | affero general public license | affero general public license (?:version |v ?)1 | agpl 1 0(?: only| or later)?
agpl-3.0 | gnu affero general public license | gnu affero general public license (?:version |v ?)3 | agpl 3 0(?: only| or later)?
gfdl | gnu free documentation license | gnu free documentation license | gfdl
gfdl-1.2 | gnu free documentation license | gnu free documentation license (?:version |v ?)1 2 | gfdl 1 2(?: only| or later)?
gfdl-1.3 | gnu free documentation license | gnu free documentation license (?:version |v ?)1 3 | gfdl 1 3(?: only| or later)?
apache-1.0 | apache | apache (?:software )?license (?:version |v ?)1 0 | apache 1 0
apache-1.1 | apache | apache (?:software )?license (?:version |v ?)1 1 | apache 1 1
apache-2.0 | apache | apache (?:software )?license(?: version| v)? ?2(?: 0)? | apache 2 0
mit | mit license / mit licence | mit (?:license|licence) | mit
mit-0 | mit no attribution | mit no attribution(?: license)? | mit 0
expat | expat license | expat license | expat
x11 | x11 license / mit x11 | (?:mit )?x11 license | x11
bsd | bsd | bsd (?:style )?license | bsd
bsd-0-clause | zero clause bsd license | zero clause bsd license | 0bsd
bsd-1-clause | bsd 1 clause license | bsd 1 clause license | bsd 1 clause
bsd-2-clause | bsd 2 clause / simplified bsd / freebsd / 2 clause bsd | (?:bsd 2 clause|simplified bsd|freebsd|2 clause bsd) license | bsd 2 clause
bsd-3-clause | bsd 3 clause / new bsd / modified bsd / revised bsd / 3 clause bsd | (?:bsd 3 clause|new bsd|modified bsd|revised bsd|3 clause bsd) license | bsd 3 clause
bsd-3-clause-clear | clear bsd license | clear bsd license | bsd 3 clause clear
bsd-4-clause | bsd 4 clause / original bsd / 4 clause bsd | (?:bsd 4 clause|original bsd|4 clause bsd) license | bsd 4 clause
isc | isc license | isc license | isc
mpl | mozilla public license | mozilla public license | mpl
mpl-1.0 | mozilla public license | mozilla public license (?:version |v ?)1 0 | mpl 1 0
mpl-1.1 | mozilla public license | mozilla public license (?:version |v ?)1 1 | mpl 1 1
mpl-2.0 | mozilla public license | mozilla public license (?:version |v ?)2 0 | mpl 2 0
epl-1.0 | eclipse public license | eclipse public license(?: version| v)? ?1 0 | epl 1 0
epl-2.0 | eclipse public license | eclipse public license(?: version| v)? ?2 0 | epl 2 0
edl-1.0 | eclipse distribution license | eclipse distribution license | edl 1 0
cddl-1.0 | common development and distribution license | common development and distribution license(?: version| v)?(?: ?1 0)? | cddl 1 0
cddl-1.1 | common development and distribution license | common development and distribution license(?: version| v)? ?1 1 | cddl 1 1
cpl-1.0 | common public license | common public license | cpl 1 0
cpal-1.0 | common public attribution license | common public attribution license | cpal 1 0
ipl-1.0 | ibm public license | ibm public license | ipl 1 0
eupl-1.1 | european union public | european union public licen[cs]e (?:version |v ?)1 1 | eupl 1 1
eupl-1.2 | european union public | european union public licen[cs]e (?:version |v ?)1 2 | eupl 1 2
cecill | cecill | cecill (?:free software )?license(?: agreement)? | cecill(?: [abc12])?(?: [01])?
osl-3.0 | open software license | open software license | osl 3 0
afl-3.0 | academic free license | academic free license | afl 3 0
artistic-1.0 | artistic license | artistic license(?: version)? ?1 0 | artistic 1 0
artistic-2.0 | artistic license | artistic license(?: version)? ?2 0 | artistic 2 0
perl | same terms as perl itself | same terms as perl itself | artistic 1 0 perl
python-2.0 | python software foundation license | python software foundation license | (?:python|psf) 2 0
php-3.0 | php license | php license | php 3 0[01]?
ruby | ruby license | ruby license | ruby
zlib | zlib | zlib (?:libpng )?license | zlib
libpng | libpng license | libpng license | libpng 2 0
openssl | openssl license | openssl license | openssl
curl | curl license | curl license | curl
postgresql | postgresql license | postgresql license | postgresql
boost-1.0 | boost software license | boost software license | bsl 1 0
unlicense | the unlicense | the unlicense | unlicense
wtfpl | do what the fuck you want to public license | do what the fuck you want to public license | wtfpl
beerware | beer | beer ?ware license | beerware
cc0-1.0 | cc0 / creative commons zero | (?:cc0|creative commons zero)(?: 1 0)?(?: universal)? | cc0 1 0
cc-by-1.0 | cc by / creative commons attribution | (?:creative commons attribution|cc by) 1 0 | cc by 1 0
cc-by-2.0 | cc by / creative commons attribution | (?:creative commons attribution|cc by) 2 [05] | cc by 2 [05]
cc-by-3.0 | cc by / creative commons attribution | (?:creative commons attribution|cc by) 3 0 | cc by 3 0
cc-by-4.0 | cc by / creative commons attribution | (?:creative commons attribution|cc by) 4 0 | cc by 4 0
cc-by-sa | cc by / creative commons attribution | (?:creative commons attribution share ?alike|cc by sa)(?: [1-4] [05])? | cc by sa [1-4] [05]
cc-by-nc | cc by / creative commons attribution | (?:creative commons attribution non ?commercial|cc by nc)(?: [1-4] [05])? | cc by nc [1-4] [05]
cc-by-nd | cc by / creative commons attribution | (?:creative commons attribution no ?deriv(?:ative)?s?|cc by nd)(?: [1-4] [05])? | cc by nd [1-4] [05]
cc-by-nc-sa | cc by / creative commons attribution | (?:creative commons attribution non ?commercial share ?alike|cc by nc sa)(?: [1-4] [05])? | cc by nc sa [1-4] [05]
cc-by-nc-nd | cc by / creative commons attribution | (?:creative commons attribution non ?commercial no ?deriv(?:ative)?s?|cc by nc nd)(?: [1-4] [05])? | cc by nc nd [1-4] [05]
odbl-1.0 | open database / open data commons | open (?:data commons open )?database license | odbl 1 0
odc-by-1.0 | open data commons attribution license | open data commons attribution license | odc by 1 0
pddl-1.0 | public domain dedication and license | public domain dedication and license | pddl 1 0
ofl-1.1 | open font license / sil open font | (?:sil )?open font license | ofl 1 1
w3c | w3c software | w3c software (?:notice and )?(?:document )?license | w3c
ms-pl | microsoft public license | microsoft public license | ms pl
ms-rl | microsoft reciprocal license | microsoft reciprocal license | ms rl
upl-1.0 | universal permissive license | universal permissive license | upl 1 0
ncsa | ncsa open source / university of illinois | (?:university of illinois )?ncsa open source license | ncsa
qpl-1.0 | q public license | q public license | qpl 1 0
sspl-1.0 | server side public license | server side public license | sspl 1 0
busl-1.1 | business source license | business source license | busl 1 1
elastic-2.0 | elastic license | elastic license(?: 2 0)? | elastic 2 0
polyform | polyform | polyform (?:noncommercial|strict|small business|shield) license | polyform [a-z]+ 1 0 0
openrail | openrail / open rail / bigscience / creativeml / bloom | (?:bigscience |creativeml )?(?:bloom )?open ?rail(?: m| ms?)? license | openrail
llama | llama | llama [23] community license(?: agreement)? | llama[23]
vim | vim license | vim license | vim
zpl-2.1 | zope public license | zope public license | zpl 2 1
ntp | ntp license | ntp license | ntp
hpnd | historical permission notice and disclaimer | historical permission notice and disclaimer | hpnd
unicode-dfs | unicode license agreement | unicode license agreement | unicode dfs 2016
"""

#: Label | priority | keywords | sentences from license texts and notices, as words.
QUOTES = """
gpl | 85 | free software foundation | under the terms of the gnu (?:[a-z]+ )?general public license as published by the free software foundation
gpl-or-later | 85 | at your option | either version [123](?: 0)? of the license or at your option any later version
gpl | 70 | gnu general public license | see the gnu (?:lesser |affero )?general public license for more details
gpl | 70 | gnu general public license | you should have received a copy of the gnu (?:lesser |affero )?general public license
gpl | 70 | gnu org licenses | gnu org licenses(?: (?:old licenses )?(?:l|a)?gpl(?: [123](?: [01])?)?)?
gpl | 85 | everyone is permitted | everyone is permitted to copy and distribute verbatim copies of this license document
apache-2.0 | 85 | you may not use this file | you may not use this file except in compliance with the license
apache-2.0 | 85 | apache license | licensed under the apache license version 2 0
apache | 70 | apache org licenses | apache org licenses(?: license 2 0)?
apache-2.0 | 85 | contributor license agreements | licensed to the apache software foundation asf under one or more contributor license agreements
apache-2.0 | 70 | as is basis | distributed on an as is basis without warranties or conditions of any kind
mit | 85 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
mit | 85 | to deal in the software | to deal in the software without restriction
mit | 70 | above copyright notice | the above copyright notice and this permission notice shall be included in all copies
mit | 70 | opensource org licenses | opensource org licenses mit(?: license)?
bsd | 85 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | 70 | endorse or promote | may be used to endorse or promote products derived from this software
bsd-4-clause | 85 | all advertising materials | all advertising materials mentioning features or use of this software must display
bsd | 70 | opensource org licenses | opensource org licenses bsd(?: [234] clause| license)?
isc | 85 | for any purpose with or without fee | permission to use copy modify and or distribute this software for any purpose with or without fee
mpl-2.0 | 85 | source code form | this source code form is subject to the terms of the mozilla public license
mpl | 70 | mozilla org mpl | mozilla org mpl(?: 2 0)?
epl | 85 | eclipse public license | made available under the terms of the eclipse public license
epl | 70 | eclipse org legal | eclipse org (?:legal epl v ?[12]0|org documents epl)
boost-1.0 | 85 | boost software license | distributed under the boost software license version 1 0
boost-1.0 | 70 | boost org license | boost org license 1 0
zlib | 85 | this software is provided as is | this software is provided as is without any express or implied warranty in no event will the authors
zlib | 70 | must not be misrepresented | the origin of this software must not be misrepresented
unlicense | 85 | unencumbered software | this is free and unencumbered software released into the public domain
creative-commons | 70 | creative commons | (?:this work is )?licensed under a creative commons
creative-commons | 70 | creativecommons org | creativecommons org (?:licenses|publicdomain) (?:by|zero|mark)(?: (?:nc|nd|sa))*(?: [1-4] [05])?
cc0-1.0 | 85 | waived all copyright | waived all copyright and related or neighboring rights
public-domain | 60 | public domain | (?:placed|dedicated|released) (?:in|into|to) the public domain
all-rights | 40 | all rights reserved | all rights reserved
copyright | 40 | copyright | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*
proprietary | 60 | proprietary | (?:proprietary and confidential|confidential and proprietary)
proprietary | 70 | is strictly prohibited | unauthorized copying of this (?:file|software)(?: via any medium)? is strictly prohibited
eula | 60 | end user license agreement | end user license agreement
non-commercial | 60 | research use only / commercial use only / noncommercial use only / personal use only | for (?:non ?commercial|personal|research) use only
ofl-1.1 | 85 | open font license | this font software is licensed under the sil open font license
w3c | 70 | w3c | w3c software notice and license
odbl-1.0 | 85 | open database license | made available under the open database license
"""

_UNDER = "(?:licensed|released|distributed|available|provided|published|covered|dual licensed) under (?:the )?(?:terms of )?(?:the )?"
_TAG = "spdx license identifier "


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: re.Pattern


def _rule(label: str, priority: int, keywords: str, pattern: str) -> Rule:
    return Rule(label, priority, tuple(f" {k.strip()}" for k in keywords.split("/")), re.compile(f"(?<= )(?:{pattern})(?= )"))


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules in order: three forms for each name, then the quoted sentences."""
    out = []
    for line in NAMES.strip().splitlines():
        label, keywords, name, tag = (part.strip() for part in line.split(" | "))
        out.append(_rule(label, NAMED, keywords, name))
        out.append(_rule(label, GRANTED, keywords, _UNDER + f"(?:{name})"))
        out.append(_rule(label, TAGGED, _TAG, _TAG + f"(?:{tag})"))
    for line in QUOTES.strip().splitlines():
        label, priority, keywords, pattern = (part.strip() for part in line.split(" | ", 3))
        out.append(_rule(label, int(priority), keywords, pattern))
    return out


def accepted(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The detections (priority, start, end, rule) that no accepted one contains."""
    kept: list[tuple[int, int, int, int]] = []
    for priority in sorted({f[0] for f in found}, reverse=True):
        starts = np.array([k[1] for k in kept], np.int64)
        order = np.argsort(starts, kind="stable")
        starts = starts[order]
        reach = np.maximum.accumulate(np.array([k[2] for k in kept], np.int64)[order]) if kept else np.zeros(0, np.int64)
        furthest = -1
        for one in sorted((f for f in found if f[0] == priority), key=lambda f: (f[1], -f[2], f[3])):
            at = int(np.searchsorted(starts, one[1], "right")) - 1
            if one[2] > furthest and not (at >= 0 and reach[at] >= one[2]):
                kept.append(one)
            furthest = max(furthest, one[2])
    return sorted(kept, key=lambda k: (k[1], k[2], k[3]))


class Scanner:
    """The rules with their keyword automaton."""

    def __init__(self):
        self.rules, by_keyword = rules(), {}
        for i, rule in enumerate(self.rules):
            for keyword in rule.keywords:
                by_keyword.setdefault(keyword, []).append(i)
        for phrase in BASE:
            by_keyword.setdefault(f" {phrase}", [])
        self.automaton = ahocorasick.Automaton()
        for keyword, which in by_keyword.items():
            self.automaton.add_word(keyword, (keyword, which))
        self.automaton.make_automaton()
        self.base = {phrase: re.compile(f"(?<= ){phrase}(?= )") for phrase in BASE}

    def scan(self, raw: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, detections."""
        words = folded_words(raw)
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        hits = {keyword: which for _, (keyword, which) in self.automaton.iter(line)}
        if not hits:
            return len(words), 0, None, None, "", "", 0.0, []

        starts = np.cumsum([1, *[len(w) + 1 for w in words]])  # where each word begins in the line

        def word(at: int) -> int:
            return int(np.searchsorted(starts, at, "right")) - 1

        base = sorted((m.start(), BASE[p]) for p in BASE if f" {p}" in hits for m in self.base[p].finditer(line))
        found = []
        for i in sorted({i for which in hits.values() for i in which}):
            rule = self.rules[i]
            found += [(rule.priority, *m.span(), i) for m in rule.pattern.finditer(line)]
        kept = accepted(found)
        labels: dict[str, int] = {label: BASE_STRENGTH for _, label in base}
        for priority, _, _, i in kept:
            labels[self.rules[i].label] = max(priority, labels.get(self.rules[i].label, 0))
        score = 1 - float(np.prod([1 - s / 100 for _, s in sorted(labels.items())])) if labels else 0.0
        spans = [{"label": self.rules[i].label, "first_word": word(a), "n_words": word(b - 1) - word(a) + 1, "priority": p} for p, a, b, i in kept]
        ends = (word(base[0][0]), word(base[-1][0])) if base else (None, None)
        return len(words), len(base), *ends, ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), score, spans


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner()


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Per document: doc_id, counts and places of base phrases, labels, score, detections."""
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("priority", pa.int32())])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span))

    def start():
        known = _scanner()

        def make(raws: Iterable[bytes]) -> list[pa.Array]:
            return columns(map(known.scan, raws), *kinds)

        return make

    ddl = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,first_word:long,n_words:long,priority:int>>"
    return map_texts(docs, key, text, start, ddl, carry)
