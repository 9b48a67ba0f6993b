"""Signature rules for licence detection, as data.

A rule is ``label | priority | keyword | pattern``.  Patterns are regular
expressions over normalised text: lower-case words with one space between
them, so punctuation and line ends need no mention ("GPL-3.0" reads
"gpl 3 0").  The keyword is a word part that every match contains; a text
without it is never tried.  Higher priorities win where detections overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


#: Word parts that most notices hold; see ``gate``.
STEMS = ("licen", "copyright", "copyleft", "domain", "gpl", "cc", "warrant", "redistribut", "permission", "spdx",
         "unlicen", "permitted", "rights", "merchantab")

#: The phrases of the base labels.
BASE = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}

#: Written by hand: names, notices and sentences that tell a licence.
HAND = r"""
mit | 70 | mit | (?:the )?mit licen[cs]e
mit | 72 | mit | (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
mit | 60 | mit | mit licensed
mit | 60 | mit | licen[cs]e mit
mit | 60 | mit | mit x11 licen[cs]e
mit | 60 | expat | expat licen[cs]e
mit | 85 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 75 | merchantab | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit | 74 | permission | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit-0 | 86 | mit | mit no attribution
x11 | 70 | x11 | x11 licen[cs]e
isc | 70 | isc | (?:the )?isc licen[cs]e
isc | 84 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | 86 | bsd | (?:bsd zero clause licen[cs]e|0bsd)
0bsd | 85 | zero | zero clause bsd(?: licen[cs]e)?
bsd | 50 | bsd | (?:the )?bsd licen[cs]e
bsd | 52 | bsd | bsd style licen[cs]e
bsd | 52 | bsd | licensed under (?:the )?(?:terms of )?(?:the )?bsd
bsd-2-clause | 80 | bsd | (?:the )?(?:bsd 2 clause|2 clause bsd|two clause bsd|bsd two clause)(?: licen[cs]e)?
bsd-2-clause | 78 | bsd | (?:simplified|freebsd) (?:bsd )?licen[cs]e
bsd-3-clause | 80 | bsd | (?:the )?(?:bsd 3 clause|3 clause bsd|three clause bsd|bsd three clause)(?: licen[cs]e)?
bsd-3-clause | 78 | bsd | (?:new|modified|revised) bsd licen[cs]e
bsd-4-clause | 80 | bsd | (?:the )?(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[cs]e)?
bsd-1-clause | 80 | bsd | (?:bsd 1 clause|1 clause bsd)(?: licen[cs]e)?
bsd | 66 | redistribut | redistribution and use in source and binary forms with or without modification are permitted
bsd | 64 | redistribut | redistributions of source code must retain the above copyright notice
bsd | 64 | redistribut | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | 76 | endorse | neither the name of .{1,120}? nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 82 | advertis | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
gpl | 50 | gnu | (?:the )?gnu general public licen[cs]e
gpl | 45 | general | general public licen[cs]e
gpl | 55 | gpl | (?:gnu )?gpl(?: licen[cs]e| licensed)?
gpl | 48 | copyleft | copyleft licen[cs]e
gpl | 58 | gnu | you should have received a copy of the gnu general public licen[cs]e
gpl | 57 | redistribut | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl | 56 | merchantab | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
lgpl | 62 | gnu | (?:the )?gnu (?:lesser|library) general public licen[cs]e
lgpl | 56 | general | (?:lesser|library) general public licen[cs]e
lgpl | 58 | lgpl | (?:gnu )?lgpl
agpl | 64 | affero | (?:the )?(?:gnu )?affero general public licen[cs]e
agpl | 60 | agpl | (?:gnu )?agpl
gfdl | 60 | gnu | (?:the )?gnu free documentation licen[cs]e
gfdl | 60 | gfdl | gfdl
gcc-exception | 80 | gcc | gcc runtime library exception
classpath-exception | 80 | classpath | classpath exception
font-exception | 80 | font | gpl font exception
linking-exception | 78 | linking | (?:special )?linking exception
apache | 50 | apache | (?:the )?apache licen[cs]e
apache | 52 | apache | apache software licen[cs]e
apache | 54 | apache | licensed under (?:the )?(?:terms of )?(?:the )?apache
apache | 54 | apache | licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements
apache-2.0 | 84 | apache | licensed under the apache licen[cs]e version 2 0 the licen[cs]e you may not use this file except in compliance with the licen[cs]e
apache-2.0 | 82 | apache | you may obtain a copy of the licen[cs]e at (?:https? )?www apache org licenses licen[cs]e 2 0
apache-2.0 | 74 | unless | unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis
mpl | 55 | mozilla | (?:the )?mozilla public licen[cs]e
mpl | 55 | mpl | mpl
mpl-2.0 | 82 | mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
epl | 55 | eclipse | (?:the )?eclipse public licen[cs]e
edl-1.0 | 75 | eclipse | (?:the )?eclipse distribution licen[cs]e(?: v| version)?(?: 1 0)?
cpl-1.0 | 70 | common | common public licen[cs]e(?: version)?(?: 1 0)?
ipl-1.0 | 75 | ibm | ibm public licen[cs]e(?: version)?(?: 1 0)?
cddl | 60 | common | common development and distribution licen[cs]e
cddl | 58 | cddl | cddl
cecill | 60 | cecill | cecill(?: free software)?(?: licen[cs]e)?
cecill-b | 72 | cecill | cecill b(?: licen[cs]e)?
cecill-c | 72 | cecill | cecill c(?: licen[cs]e)?
eupl | 60 | european | european union public licen[cs]e
eupl | 58 | eupl | eupl
bsl-1.0 | 76 | boost | (?:the )?boost software licen[cs]e(?: version)?(?: 1 0)?
bsl-1.0 | 84 | transmit | this licen[cs]e the software to use reproduce display distribute execute and transmit the software
busl-1.1 | 78 | business | business source licen[cs]e(?: version)?(?: 1 1)?
sspl-1.0 | 78 | server | server side public licen[cs]e(?: version)?(?: 1)?
elastic-2.0 | 78 | elastic | elastic licen[cs]e(?: version)?(?: 2 0)?
polyform-noncommercial | 78 | polyform | polyform noncommercial licen[cs]e
polyform-shield | 78 | polyform | polyform shield licen[cs]e
commons-clause | 76 | commons | commons clause(?: licen[cs]e)?(?: condition)?
artistic | 55 | artistic | (?:the )?(?:perl )?artistic licen[cs]e
artistic-2.0 | 76 | artistic | (?:the )?artistic licen[cs]e (?:version )?2 0
artistic-1.0 | 76 | artistic | (?:the )?artistic licen[cs]e (?:version )?1 0
perl | 60 | perl | (?:under )?the same terms as perl(?: itself)?
psf-2.0 | 74 | python | python software foundation licen[cs]e(?: version)?(?: 2)?
python-2.0 | 74 | python | python licen[cs]e(?: version)?(?: 2 0)?
php-3.01 | 76 | php | php licen[cs]e(?: version)? 3 01
php | 60 | php | (?:the )?php licen[cs]e
ruby | 70 | ruby | ruby licen[cs]e
zlib | 74 | zlib | (?:the )?zlib(?: libpng)? licen[cs]e
zlib | 84 | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
libpng | 72 | libpng | libpng licen[cs]e
openssl | 74 | openssl | openssl licen[cs]e
ssleay | 74 | ssleay | (?:original )?ssleay licen[cs]e
curl | 74 | curl | curl licen[cs]e
ijg | 74 | jpeg | independent jpeg group(?: s)? (?:software|licen[cs]e)
icu | 74 | icu | icu licen[cs]e
unicode | 74 | unicode | unicode (?:inc )?licen[cs]e agreement
ofl-1.1 | 82 | sil | sil open font licen[cs]e (?:version )?1 1
ofl-1.0 | 82 | sil | sil open font licen[cs]e (?:version )?1 0
ofl | 70 | font | (?:sil )?open font licen[cs]e
ofl | 62 | reserved | with reserved font name
vim | 72 | vim | vim licen[cs]e
wtfpl | 76 | wtfpl | wtfpl
wtfpl | 80 | fuck | do what the fuck you want to public licen[cs]e
beerware | 76 | beer | (?:the )?beer ?ware licen[cs]e
unlicense | 80 | unlicense | (?:the )?unlicense
unlicense | 86 | unencumbered | this is free and unencumbered software released into the public domain
public-domain | 60 | domain | (?:in|into|to) the public domain
public-domain | 50 | domain | public domain(?: dedication| software| work)?
public-domain | 66 | domain | (?:dedicated|released|placed) (?:to|into|in) the public domain
cc0 | 72 | cc0 | (?:creative commons )?cc0(?: universal)?
cc0-1.0 | 84 | cc0 | (?:creative commons )?cc0 1 0(?: universal)?(?: public domain dedication)?
cc0-1.0 | 84 | publicdomain | creativecommons org publicdomain zero 1 0
cc-pdm-1.0 | 84 | publicdomain | creativecommons org publicdomain mark 1 0
cc-pdm-1.0 | 80 | domain | public domain mark(?: 1 0)?
cc | 50 | creative | creative commons(?: licen[cs]e| licensed)?
ncsa | 76 | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e
upl-1.0 | 76 | universal | universal permissive licen[cs]e(?: version| v)?(?: 1 0)?
ms-pl | 76 | microsoft | microsoft public licen[cs]e
ms-rl | 76 | microsoft | microsoft reciprocal licen[cs]e
ms-lpl | 76 | microsoft | microsoft limited public licen[cs]e
apsl-2.0 | 76 | apple | apple public source licen[cs]e(?: version)?(?: 2 0)?
nposl-3.0 | 78 | non | non profit open software licen[cs]e(?: version)?(?: 3 0)?
osl | 60 | open | open software licen[cs]e
afl | 60 | academic | academic free licen[cs]e
ecl-2.0 | 76 | educational | educational community licen[cs]e(?: version)?(?: 2 0)?
odbl-1.0 | 78 | database | open (?:data commons )?open database licen[cs]e|open database licen[cs]e(?: v)?(?: 1 0)?
odc-by-1.0 | 78 | commons | open data commons attribution licen[cs]e
pddl-1.0 | 78 | commons | open data commons public domain dedication and licen[cs]e
cdla-permissive | 78 | community | community data licen[cs]e agreement permissive
cdla-sharing | 78 | community | community data licen[cs]e agreement sharing
ogl-uk | 74 | government | open government licen[cs]e
etalab-2.0 | 74 | etalab | (?:etalab )?(?:open licence|licence ouverte)(?: etalab)?(?: 2 0)?
dl-de-by-2.0 | 78 | datenlizenz | datenlizenz deutschland namensnennung(?: version)?(?: 2 0)?
openrail | 74 | openrail | (?:creativeml |bigscience )?open ?rail(?: m| plus plus)?(?: licen[cs]e)?
rail | 72 | responsible | responsible ai licen[cs]e
llama-community | 78 | llama | llama (?:[0-9] )*community licen[cs]e(?: agreement)?
gemma-terms | 78 | gemma | gemma terms of use
hippocratic | 76 | hippocratic | hippocratic licen[cs]e
json | 80 | evil | the software shall be used for good not evil
json | 72 | json | json licen[cs]e
fair | 72 | fair | fair licen[cs]e
w3c | 74 | w3c | w3c software (?:and document )?(?:notice and )?licen[cs]e
sleepycat | 74 | sleepycat | (?:the )?sleepycat licen[cs]e
qpl-1.0 | 74 | q | (?:the )?q public licen[cs]e(?: version)?(?: 1 0)?
lppl | 74 | latex | latex project public licen[cs]e
tcl | 72 | tcl | tcl tk licen[cs]e
zpl | 72 | zope | zope public licen[cs]e
watcom-1.0 | 74 | watcom | sybase open watcom public licen[cs]e
nasa-1.3 | 74 | nasa | nasa open source agreement
mulan-psl-2.0 | 78 | mulan | mulan (?:psl|permissive software licen[cs]e)(?: v| version)?(?: ?2)?
blueoak-1.0.0 | 78 | blue | blue oak model licen[cs]e
eudatagram | 72 | datagrid | eu datagrid software licen[cs]e
sgi-b-2.0 | 74 | sgi | sgi free software licen[cs]e b
intel | 70 | intel | intel open source licen[cs]e
nokia | 70 | nokia | nokia open source licen[cs]e
sun-public | 70 | sun | sun public licen[cs]e
oracle-bcl | 70 | oracle | oracle binary code licen[cs]e
ofl-reserved | 40 | reserved | reserved font names?
all-rights-reserved | 40 | reserved | all rights reserved
proprietary | 45 | proprietary | proprietary (?:and confidential|licen[cs]e|software)
proprietary | 44 | confidential | confidential and proprietary
no-redistribution | 48 | redistribut | (?:may not be|not to be|no) redistribut(?:ed|ion)
non-commercial | 46 | commercial | (?:for )?non ?commercial (?:use|purposes?)(?: only)?
research-only | 46 | research | (?:for )?research (?:use|purposes) only
evaluation-only | 46 | evaluation | (?:for )?evaluation purposes only
commercial | 44 | commercial | commercial licen[cs]e
eula | 46 | end | end user licen[cs]e agreement
freeware | 44 | freeware | freeware licen[cs]e
shareware | 44 | shareware | shareware licen[cs]e
copyright-notice | 30 | copyright | copyright (?:c )?(?:19|20)[0-9][0-9]
permission-required | 40 | permission | without (?:the )?(?:prior )?(?:express )?written permission
used-with-permission | 40 | permission | (?:used|reproduced|reprinted) (?:with|by) permission
warranty-disclaimer | 25 | warrant | without warrant(?:y|ies) of any kind
warranty-disclaimer | 25 | warrant | (?:no|any) express or implied warrant(?:y|ies)
as-is | 24 | warrant | provided as is without (?:any )?(?:express or implied )?warrant(?:y|ies)
license-file | 20 | licen | see (?:the )?licen[cs]e(?: file| txt| md)? for (?:more )?(?:details|information|terms)
license-reference | 18 | licen | licen[cs]e agreement
"""

#: SPDX identifiers that a "SPDX-License-Identifier" tag or a package field may name.
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 "
    "Beerware BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 "
    "CC-BY-NC-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 "
    "EUPL-1.1 EUPL-1.2 GFDL-1.3-only GPL-1.0-only GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC "
    "LGPL-2.0-only LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 "
    "MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PostgreSQL Python-2.0 Ruby SSPL-1.0 Unlicense UPL-1.0 Vim W3C WTFPL "
    "X11 Zlib ZPL-2.1").split()

#: Licences with numbered versions: label, keyword, names as patterns, versions.
VERSIONED = (
    ("gpl", "gpl", "(?:gnu )?gpl", "1 2 3"),
    ("gpl", "general", "(?:the )?(?:gnu )?general public licen[cs]e", "1 2 3"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "2.0 2.1 3"),
    ("lgpl", "general", "(?:the )?(?:gnu )?(?:lesser|library) general public licen[cs]e", "2.0 2.1 3"),
    ("agpl", "agpl", "(?:gnu )?agpl", "1 3"),
    ("agpl", "affero", "(?:the )?(?:gnu )?affero general public licen[cs]e", "1 3"),
    ("gfdl", "documentation", "(?:the )?gnu free documentation licen[cs]e", "1.1 1.2 1.3"),
    ("apache", "apache", "(?:the )?apache(?: software)? licen[cs]e", "1.0 1.1 2.0"),
    ("apache", "apache", "apache", "1.1 2.0"),
    ("mpl", "mozilla", "(?:the )?mozilla public licen[cs]e", "1.0 1.1 2.0"),
    ("mpl", "mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", "(?:the )?eclipse public licen[cs]e", "1.0 2.0"),
    ("epl", "epl", "epl", "1.0 2.0"),
    ("cddl", "common", "common development and distribution licen[cs]e", "1.0 1.1"),
    ("eupl", "european", "european union public licen[cs]e", "1.0 1.1 1.2"),
    ("osl", "open", "open software licen[cs]e", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", "academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
    ("cecill", "cecill", "cecill(?: licen[cs]e)?", "1.0 1.1 2.0 2.1"),
    ("lppl", "latex", "latex project public licen[cs]e", "1.0 1.1 1.2 1.3"),
    ("zpl", "zope", "zope public licen[cs]e", "1.1 2.0 2.1"),
    ("ogl-uk", "government", "open government licen[cs]e", "1.0 2.0 3.0"),
)

#: Creative Commons kinds: short words, long words.
CREATIVE_COMMONS = (
    ("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?deriv(?:s|atives)"),
    ("by nc", "attribution non ?commercial"), ("by nc sa", "attribution non ?commercial share ?alike"),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:s|atives)"))
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def _spoken(version: str) -> str:
    """A version as words; a last ".0" may be left out."""
    head, _, tail = version.partition(".")
    return f"{head}(?: 0)?" if tail in ("", "0") else f"{head} {tail}"


def _families() -> Iterator[Rule]:
    for label, keyword, name, versions in VERSIONED:
        for version in versions.split():
            said, full = _spoken(version), label + "-" + (version if "." in version else version + ".0")
            yield Rule(full, 90, keyword, rf"{name}(?: as published by the free software foundation)?(?: either)? (?:version|v|ver|release) ?{said}")
            yield Rule(full, 88, keyword, rf"{name} ?v?{said}")
            yield Rule(full + "-or-later", 94, keyword, rf"{name}(?: as published by the free software foundation)?(?: either)? ?(?:version |v ?)?{said}(?: of the licen[cs]e)? or (?:at your option )?(?:any )?(?:later|newer)(?: version)?")
    for short, long in CREATIVE_COMMONS:
        label = "cc-" + short.replace(" ", "-")
        yield Rule(label, 66, "cc", rf"(?:creative commons )?cc {short}")
        yield Rule(label, 64, "creative", rf"creative commons {long}")
        yield Rule(label, 70, "creativecommons", rf"creativecommons org licenses {short}")
        for version in CC_VERSIONS:
            said, full = version.replace(".", " "), f"{label}-{version}"
            yield Rule(full, 92, "cc", rf"(?:creative commons )?cc {short} {said}")
            yield Rule(full, 90, "creative", rf"creative commons {long} {said}(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?")
            yield Rule(full, 94, "creativecommons", rf"creativecommons org licenses {short} {said}")
    for name in SPDX:
        words = " ".join(name.lower().replace("-", " ").replace(".", " ").split())
        yield Rule(name.lower(), 100, "spdx", rf"spdx licen[cs]e identifier {words}")


def _written() -> Iterator[Rule]:
    for line in HAND.strip().splitlines():
        label, priority, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        yield Rule(label, int(priority), keyword, pattern)


def all_rules() -> list[Rule]:
    """Every rule in its fixed order, base phrases first."""
    base = [Rule(label, 50, phrase.split()[0], phrase) for label, phrase in BASE.items()]
    return [*base, *_written(), *_families()]


def _always(pattern: str) -> list[str]:
    """Word parts that every match of a pattern holds (not all of them: groups, classes and escapes are passed over)."""
    left = re.sub(r"\\[pP]\{[^}]*\}|\\.", "\n", pattern)
    left = re.sub(r"\[[^\]]*\]", "\n", left)
    left, n = re.sub(r"\n(?:[?*+]|\{[^}]*\})+", "\n", left), 1
    while n:
        left, n = re.subn(r"\([^()]*\)(?:[?*+]|\{[^}]*\})*", "\n", left)
    if "|" in left:
        return []
    return re.findall(r"[a-z0-9]+", re.sub(r".(?:[?*]|\{[^}]*\})[?+]?", "\n", left))


def gate(rules: Sequence[Rule]) -> list[str]:
    """Word parts of which every text with a match of a rule or a base phrase holds one.

    A match holds its rule's keyword and the fixed words of its pattern.  One
    of ``STEMS`` in these stands for the rule; otherwise it is the keyword, or
    the longest word where the keyword is short and so stands in most texts.
    """
    parts = set()
    for keyword, pattern in [(r.keyword, r.pattern) for r in rules] + [(p.split()[0], p) for p in BASE.values()]:
        known = [keyword, *_always(pattern)]
        stem = next((s for s in STEMS if any(s in k for k in known)), None)
        parts.add(stem or (keyword if len(keyword) > 3 else max(known, key=len)))
    return sorted(p for p in parts if not any(q != p and q in p for q in parts))
