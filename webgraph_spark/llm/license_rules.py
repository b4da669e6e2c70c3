"""Signature rules of licences, written over lower-case words joined by single spaces.

A rule is (label, form, keyword, pattern). The keyword is a literal that begins a word of every match; it is looked for
first. Forms differ in how sure they are and in what suppresses what: see ``FORMS``.
"""

from __future__ import annotations

from typing import NamedTuple

# form: (priority, confidence). A detection inside one of higher or equal priority is suppressed.
FORMS = {
    "spdx": (4, 1.0),
    "text": (4, 0.95),
    "grant": (3, 0.9),
    "link": (3, 0.85),
    "title": (2, 0.7),
    "mention": (1, 0.5),
}


class Rule(NamedTuple):
    label: str
    form: str
    keyword: str
    pattern: str


# The phrases of the base labels.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

# label | keyword | name as it stands in prose | SPDX identifier in words, or - for another name of the family before
FAMILIES = """
mit | mit | (?:the )?mit licen[sc]e | mit
mit | expat | (?:the )?expat licen[sc]e | -
mit | x11 | (?:the )?x11 licen[sc]e | -
mit-0 | attribution | mit no attribution(?: licen[sc]e)? | mit 0
apache-2.0 | apache | apache (?:software )?licen[sc]e (?:version |v )?v?2(?: 0)? | apache 2 0
apache-1.1 | apache | apache (?:software )?licen[sc]e (?:version |v )?v?1 1 | apache 1 1
apache-1.0 | apache | apache (?:software )?licen[sc]e (?:version |v )?v?1 0 | apache 1 0
gpl-1.0 | gnu | gnu (?:general public licen[sc]e|gpl) (?:version |v )?v?1(?: 0)? | gpl 1 0(?: only| or later)?
gpl-2.0 | gnu | gnu (?:general public licen[sc]e|gpl) (?:version |v )?v?2(?: 0)? | gpl 2 0(?: only| or later)?
gpl-3.0 | gnu | gnu (?:general public licen[sc]e|gpl) (?:version |v )?v?3(?: 0)? | gpl 3 0(?: only| or later)?
lgpl-2.0 | gnu | gnu (?:library|lesser) general public licen[sc]e (?:version |v )?v?2 0 | lgpl 2 0(?: only| or later)?
lgpl-2.1 | gnu | gnu (?:library|lesser) general public licen[sc]e (?:version |v )?v?2 1 | lgpl 2 1(?: only| or later)?
lgpl-3.0 | gnu | gnu (?:library|lesser) general public licen[sc]e (?:version |v )?v?3(?: 0)? | lgpl 3 0(?: only| or later)?
agpl-3.0 | affero | (?:gnu )?affero general public licen[sc]e (?:version |v )?v?3(?: 0)? | agpl 3 0(?: only| or later)?
agpl-1.0 | affero | affero general public licen[sc]e (?:version |v )?v?1(?: 0)? | agpl 1 0(?: only| or later)?
gfdl-1.1 | documentation | gnu free documentation licen[sc]e (?:version |v )?v?1 1 | gfdl 1 1(?: only| or later)?
gfdl-1.2 | documentation | gnu free documentation licen[sc]e (?:version |v )?v?1 2 | gfdl 1 2(?: only| or later)?
gfdl-1.3 | documentation | gnu free documentation licen[sc]e (?:version |v )?v?1 3 | gfdl 1 3(?: only| or later)?
bsd-1-clause | bsd | (?:bsd )?(?:1|one) clause bsd licen[sc]e | bsd 1 clause
bsd-2-clause | bsd | (?:simplified|freebsd|(?:2|two) clause) bsd licen[sc]e | bsd 2 clause
bsd-3-clause | bsd | (?:new|modified|revised|(?:3|three) clause) bsd licen[sc]e | bsd 3 clause
bsd-4-clause | bsd | (?:original|old|(?:4|four) clause) bsd licen[sc]e | bsd 4 clause
0bsd | bsd | (?:zero|0) clause bsd(?: licen[sc]e)? | 0bsd
isc | isc | isc licen[sc]e | isc
mpl-1.0 | mozilla | mozilla public licen[sc]e (?:version |v )?v?1 0 | mpl 1 0
mpl-1.1 | mozilla | mozilla public licen[sc]e (?:version |v )?v?1 1 | mpl 1 1
mpl-2.0 | mozilla | mozilla public licen[sc]e (?:version |v )?v?2 0 | mpl 2 0
epl-1.0 | eclipse | eclipse public licen[sc]e (?:version |v )?v?1 0 | epl 1 0
epl-2.0 | eclipse | eclipse public licen[sc]e (?:version |v )?v?2 0 | epl 2 0
cddl-1.0 | distribution | common development and distribution licen[sc]e (?:version |v )?v?1 0 | cddl 1 0
cddl-1.1 | distribution | common development and distribution licen[sc]e (?:version |v )?v?1 1 | cddl 1 1
cpl-1.0 | common | common public licen[sc]e (?:version |v )?v?1 0 | cpl 1 0
eupl-1.1 | european | european union public licen[sc]e (?:version |v )?v?1 1 | eupl 1 1
eupl-1.2 | european | european union public licen[sc]e (?:version |v )?v?1 2 | eupl 1 2
artistic-1.0 | artistic | artistic licen[sc]e (?:version |v )?v?1 0 | artistic 1 0
artistic-2.0 | artistic | artistic licen[sc]e (?:version |v )?v?2 0 | artistic 2 0
boost-1.0 | boost | boost software licen[sc]e(?: (?:version |v )?v?1 0)? | bsl 1 0
bsl-1.1 | business | business source licen[sc]e(?: (?:version |v )?v?1 1)? | busl 1 1
zlib | zlib | zlib(?: libpng)? licen[sc]e | zlib
libpng | libpng | libpng licen[sc]e | libpng 2 0
unlicense | unlicense | the unlicense | unlicense
wtfpl | wtfpl | wtfpl(?: licen[sc]e)? | wtfpl
postgresql | postgresql | postgresql licen[sc]e | postgresql
python-2.0 | python | python software foundation licen[sc]e(?: version 2)? | psf 2 0
php-3.0 | php | php licen[sc]e (?:version |v )?v?3 0 | php 3 0
php-3.01 | php | php licen[sc]e (?:version |v )?v?3 01 | php 3 01
ruby | ruby | ruby(?: s)? licen[sc]e | ruby
openssl | openssl | openssl licen[sc]e | openssl
ofl-1.1 | font | (?:sil )?open font licen[sc]e(?: (?:version |v )?v?1 1)? | ofl 1 1
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[sc]e | ncsa
upl-1.0 | universal | universal permissive licen[sc]e(?: (?:version |v )?v?1 0)? | upl 1 0
ms-pl | microsoft | microsoft public licen[sc]e | ms pl
ms-rl | microsoft | microsoft reciprocal licen[sc]e | ms rl
osl-3.0 | open | open software licen[sc]e (?:version |v )?v?3 0 | osl 3 0
afl-3.0 | academic | academic free licen[sc]e (?:version |v )?v?3 0 | afl 3 0
sspl-1.0 | server | server side public licen[sc]e(?: (?:version |v )?v?1)? | sspl 1 0
elastic-2.0 | elastic | elastic licen[sc]e (?:version |v )?v?2(?: 0)? | elastic 2 0
odbl-1.0 | database | (?:odc )?open database licen[sc]e(?: (?:version |v )?v?1 0)? | odbl 1 0
odc-by-1.0 | attribution | open data commons attribution licen[sc]e(?: (?:version |v )?v?1 0)? | odc by 1 0
pddl-1.0 | dedication | public domain dedication and licen[sc]e | pddl 1 0
cdla-permissive | community | community data licen[sc]e agreement permissive | cdla permissive (?:1|2) 0
cdla-sharing | community | community data licen[sc]e agreement sharing | cdla sharing 1 0
ogl-3.0 | government | open government licen[sc]e(?: (?:version |v )?v?3 0)? | ogl uk 3 0
vim | vim | vim licen[sc]e | vim
blueoak-1.0 | oak | blue oak model licen[sc]e(?: 1 0 0)? | blueoak 1 0 0
ecl-2.0 | educational | educational community licen[sc]e (?:version |v )?v?2 0 | ecl 2 0
lppl-1.3 | latex | latex project public licen[sc]e(?: (?:version |v )?v?1 3[a-c]?)? | lppl 1 3[a-c]?
qpl-1.0 | q | q public licen[sc]e(?: (?:version |v )?v?1 0)? | qpl 1 0
cecill-2.1 | cecill | cecill (?:free software )?licen[sc]e(?: agreement)?(?: (?:version |v )?v?2 1)? | cecill 2 1
mulan-2.0 | mulan | mulan permissive software licen[sc]e(?: (?:version |v )?v?2)? | mulanpsl 2 0
openrail | rail | (?:creativeml )?open rail(?: m| s)?(?: licen[sc]e)? | openrail
"""

# Creative Commons: element words and their label; every version of every kind is a family.
CREATIVE = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nc": "attribution non ?commercial",
    "by nd": "attribution no ?deriv(?:ative)?s(?: works)?",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s(?: works)?",
}
VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

# label | keyword | words of the licence itself
TEXTS = """
mit | granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | copies | the above copyright notice and this permission notice shall be included in all copies
isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee
bsd-2-clause | redistributions | redistributions of source code must retain the above copyright notice
bsd-2-clause | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | endorse | neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
apache-2.0 | apache | you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2.0 | compliance | you may not use this file except in compliance with the license
gpl-2.0 | redistribute | you can redistribute it and or modify it under the terms of the gnu general public license (?:[^ ]+ ){0,8}version 2
gpl-3.0 | redistribute | you can redistribute it and or modify it under the terms of the gnu general public license (?:[^ ]+ ){0,8}version 3
lgpl-2.1 | redistribute | modify it under the terms of the gnu lesser general public license (?:[^ ]+ ){0,8}version 2 1 (?:[^ ]+ ){0,12}redistribute
gpl | warranty | without any warranty without even the implied warranty of merchantability
gpl | received | you should have received a copy of the gnu general public license
lgpl | received | you should have received a copy of the gnu lesser general public license
agpl-3.0 | affero | you should have received a copy of the gnu affero general public license
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
unlicense | public | this is free and unencumbered software released into the public domain
zlib | altered | altered source versions must be plainly marked as such
wtfpl | want | do what the fuck you want to public license
boost-1.0 | boost | distributed under the boost software license version 1 0
cc0-1.0 | dedicated | the person who associated a work with this deed has dedicated the work to the public domain
public-domain | public | (?:released|dedicated|placed) (?:in|in to|into|to) the public domain
public-domain | public | this work is in the public domain
proprietary | proprietary | proprietary and confidential
proprietary | unauthorized | unauthorized copying of this (?:file|work|material) (?:[^ ]+ ){0,6}strictly prohibited
proprietary | permission | may not be reproduced (?:[^ ]+ ){0,12}without (?:[^ ]+ ){0,4}written permission
proprietary | license | end user license agreement
proprietary | reserved | copyright (?:[^ ]+ ){1,8}all rights reserved
as-is | warranties | provided as is without warrant(?:y|ies) of any kind (?:[^ ]+ ){0,12}warranties
"""

# label | keyword | words of an address
LINKS = """
mit | opensource | opensource org licenses mit
apache-2.0 | apache | apache org licenses license 2 0
bsd-2-clause | opensource | opensource org licenses bsd 2 clause
bsd-3-clause | opensource | opensource org licenses bsd 3 clause
isc | opensource | opensource org licenses isc
mpl-2.0 | mozilla | mozilla org mpl 2 0
epl-2.0 | eclipse | eclipse org legal epl (?:v20|2 0)
gpl | gnu | gnu org licenses gpl
gpl-2.0 | gnu | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | gnu | gnu org licenses gpl 3 0
lgpl | gnu | gnu org licenses lgpl
lgpl-2.1 | gnu | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 | gnu | gnu org licenses lgpl 3 0
agpl-3.0 | gnu | gnu org licenses agpl 3 0
gfdl | gnu | gnu org licenses fdl
unlicense | unlicense | unlicense org
wtfpl | wtfpl | wtfpl net
ofl-1.1 | sil | scripts sil org ofl
odbl-1.0 | opendatacommons | opendatacommons org licenses odbl
odc-by-1.0 | opendatacommons | opendatacommons org licenses by
pddl-1.0 | opendatacommons | opendatacommons org licenses pddl
boost-1.0 | boost | boost org license 1 0
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
public-domain | creativecommons | creativecommons org publicdomain mark 1 0
ogl-3.0 | nationalarchives | nationalarchives gov uk doc open government licence
"""

# label | keyword | what names a family without its version
MENTIONS = """
gpl | gpl | gpl(?:v?[1-3])?
gpl | gnu | gnu general public licen[sc]e
lgpl | lgpl | lgpl(?:v?[23])?
lgpl | lesser | gnu lesser general public licen[sc]e
agpl | agpl | agpl(?:v?3)?
agpl | affero | affero general public licen[sc]e
apache | apache | apache licen[sc]e
bsd | bsd | bsd (?:style )?licen[sc]e
mpl | mozilla | mozilla public licen[sc]e
epl | eclipse | eclipse public licen[sc]e
artistic | artistic | artistic licen[sc]e
creative-commons | creative | creative commons
cc0-1.0 | cc0 | cc0(?: 1 0)?
gfdl | documentation | free documentation licen[sc]e
eula | eula | eula
copyright | copyright | copyright (?:c )?(?:19|20)[0-9][0-9]
"""

GRANT = (
    "(?:licen[sc]ed|released|distributed|available|published|provided|shared|redistributed) "
    "(?:[^ ]+ ){0,3}?under (?:[^ ]+ ){0,4}?"
)


def _lines(block: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" | ")] for line in block.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules in order; an earlier rule wins where two find the same words with the same priority."""
    found = []
    for label, keyword, name, identifier in _lines(FAMILIES):
        if identifier != "-":
            found.append(Rule(label, "spdx", "spdx", f"spdx licen[sc]e identifier {identifier}"))
        found += [
            Rule(label, "grant", keyword, GRANT + name),
            Rule(label, "title", keyword, name),
        ]
    for elements, name in CREATIVE.items():
        short = elements.replace(" ", "-")
        for version in VERSIONS:
            label = f"cc-{short}-{version.replace(' ', '.')}"
            full = f"creative commons {name}(?: licen[sc]e)? (?:version )?{version}"
            found += [
                Rule(label, "spdx", "spdx", f"spdx licen[sc]e identifier cc {elements} {version}"),
                Rule(label, "link", "creativecommons", f"creativecommons org licenses {elements} {version}"),
                Rule(label, "grant", "cc", f"{GRANT}cc {elements} {version}"),
                Rule(label, "grant", "creative", GRANT + full),
                Rule(label, "title", "cc", f"cc {elements} {version}"),
                Rule(label, "title", "creative", full),
            ]
        found.append(Rule(f"cc-{short}", "mention", "cc", f"cc {elements}"))
    for form, block in (("text", TEXTS), ("link", LINKS), ("mention", MENTIONS)):
        found += [Rule(label, form, keyword, pattern) for label, keyword, pattern in _lines(block)]
    return found
