"""Signature rules for licence scans.

Rules match a text's words, lower-cased and joined by single spaces, so marks never matter ("GPL-2.0" reads "gpl 2 0").
A rule is tried only on texts that hold all its keywords; every alternative of its pattern must hold them too, so a rule
whose alternatives share no telling word is split over lines. Of two detections, one that lies within the other's words
gives way unless its priority is higher.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    weight: float
    keywords: frozenset[str]
    pattern: re.Pattern[bytes]


# The phrases that every scan counts.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# label | words that must be present | how texts name the licence | its short identifier, where no line above has it
FAMILIES = """
mit | mit | mit(?: x11)? licen[cs]e | mit
mit | expat | expat(?: x11)? licen[cs]e
mit-0 | mit | mit no attribution(?: licen[cs]e)? | mit 0
x11 | x11 | x11 licen[cs]e | x11
apache-1.1 | apache | apache (?:software )?licen[cs]e (?:version |v)?1 1 | apache 1 1
apache-2.0 | apache | apache (?:software )?licen[cs]e (?:version |v)?2(?: 0)? | apache 2 0
apache | apache | apache (?:software )?licen[cs]e | apache
gpl-1.0 | gnu | gnu (?:general public licen[cs]e|gpl) (?:version |v)?1(?: 0)? | gpl 1 0(?: only| or later)?
gpl-2.0 | gnu | gnu (?:general public licen[cs]e|gpl) (?:version |v)?2(?: 0)? | gpl 2 0(?: only| or later)?
gpl-3.0 | gnu | gnu (?:general public licen[cs]e|gpl) (?:version |v)?3(?: 0)? | gpl 3 0(?: only| or later)?
gpl | public | (?:gnu )?general public licen[cs]e | gpl
gpl | gpl | gnu gpl | gpl
gpl-2.0 | gplv2 | gplv2 | gplv2
gpl-3.0 | gplv3 | gplv3 | gplv3
lgpl-2.0 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v)?2(?: 0)? | lgpl 2 0(?: only| or later)?
lgpl-2.0 | library | (?:gnu )?library general public licen[cs]e (?:version |v)?2(?: 0)?
lgpl-2.1 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v)?2 1 | lgpl 2 1(?: only| or later)?
lgpl-3.0 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v)?3(?: 0)? | lgpl 3 0(?: only| or later)?
lgpl | lesser | (?:gnu )?lesser general public licen[cs]e | lgpl
lgpl | library | (?:gnu )?library general public licen[cs]e | lgpl
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e (?:version |v)?3(?: 0)? | agpl 3 0(?: only| or later)?
agpl | affero | (?:gnu )?affero general public licen[cs]e | agpl
gfdl | documentation | (?:gnu )?free documentation licen[cs]e | gfdl 1 [123](?: only| or later)?
bsd-2-clause | bsd | (?:simplified|2 clause|freebsd) bsd licen[cs]e | bsd 2 clause
bsd-3-clause | bsd | (?:new|modified|revised|3 clause) bsd licen[cs]e | bsd 3 clause
bsd-4-clause | bsd | (?:original|4 clause) bsd licen[cs]e | bsd 4 clause
0bsd | bsd | zero clause bsd(?: licen[cs]e)? | 0bsd
bsd | bsd | bsd(?: style)? licen[cs]e | bsd
isc | isc | isc licen[cs]e | isc
mpl-1.1 | mozilla | mozilla public licen[cs]e (?:version |v)?1 1 | mpl 1 1
mpl-2.0 | mozilla | mozilla public licen[cs]e (?:version |v)?2(?: 0)? | mpl 2 0
mpl | mozilla | mozilla public licen[cs]e | mpl
epl-1.0 | eclipse | eclipse public licen[cs]e (?:version |v)?1(?: 0)? | epl 1 0
epl-2.0 | eclipse | eclipse public licen[cs]e (?:version |v)?2(?: 0)? | epl 2 0
epl | eclipse | eclipse public licen[cs]e | epl
edl | eclipse | eclipse distribution licen[cs]e | edl
eupl | european | european union public licen[cs]e | eupl 1 [12]
cddl | development | common development and distribution licen[cs]e | cddl 1 [01]
cpl | common | common public licen[cs]e | cpl 1 0
cpal | attribution | common public attribution licen[cs]e | cpal 1 0
artistic-2.0 | artistic | artistic licen[cs]e (?:version |v)?2(?: 0)? | artistic 2 0
artistic | artistic | artistic licen[cs]e | artistic 1 0
zlib | zlib | zlib(?: libpng)? licen[cs]e | zlib
libpng | libpng | libpng licen[cs]e | libpng
bsl-1.0 | boost | boost software licen[cs]e | bsl 1 0
busl-1.1 | business | business source licen[cs]e | busl 1 1
unlicense | unlicense | (?:the )?unlicense | unlicense
wtfpl | wtfpl | wtfpl | wtfpl
cc0-1.0 | cc0 | cc0 (?:1 0 )?(?:universal|public domain dedication) | cc0 1 0
cc-by-4.0 | attribution | creative commons attribution (?:4 0 )?(?:international )?licen[cs]e | cc by 4 0
cc-by-3.0 | attribution | creative commons attribution 3 0(?: unported)? | cc by 3 0
cc-by-sa-4.0 | sharealike | creative commons attribution sharealike(?: 4 0)?(?: international)? | cc by sa 4 0
cc-by-sa-3.0 | sharealike | creative commons attribution sharealike 3 0 | cc by sa 3 0
cc-by-nc | noncommercial | creative commons attribution noncommercial | cc by nc [34] 0
cc-by-nd | noderivatives | creative commons attribution noderivatives | cc by nd [34] 0
cc-by-nc-sa | noncommercial | creative commons attribution noncommercial sharealike | cc by nc sa [34] 0
cc-by-nc-nd | noncommercial | creative commons attribution noncommercial noderivatives | cc by nc nd [34] 0
cc | creative | creative commons licen[cs]e | cc
odbl | database | open (?:data commons )?(?:open )?database licen[cs]e | odbl 1 0
odc-by | commons | open data commons attribution licen[cs]e | odc by 1 0
pddl | dedication | public domain dedication and licen[cs]e | pddl 1 0
psf-2.0 | python | python software foundation licen[cs]e | psf 2 0
python-2.0 | python | python licen[cs]e | python 2 0
php-3.01 | php | php licen[cs]e | php 3 0?1
ruby | ruby | ruby licen[cs]e | ruby
openssl | openssl | openssl licen[cs]e | openssl
curl | curl | curl licen[cs]e | curl
postgresql | postgresql | postgresql licen[cs]e | postgresql
tcl | tcl | tcl(?: tk)? licen[cs]e | tcl
vim | vim | vim licen[cs]e | vim
w3c | w3c | w3c software (?:notice and )?licen[cs]e | w3c
ofl-1.1 | font | (?:sil )?open font licen[cs]e | ofl 1 1
ecl-2.0 | educational | educational community licen[cs]e | ecl 2 0
afl-3.0 | academic | academic free licen[cs]e | afl [123] [012]
osl-3.0 | open | open software licen[cs]e | osl [123] [01]
ms-pl | microsoft | microsoft public licen[cs]e | ms pl
ms-rl | microsoft | microsoft reciprocal licen[cs]e | ms rl
ncsa | illinois | university of illinois ncsa open source licen[cs]e | ncsa
upl-1.0 | universal | universal permissive licen[cs]e | upl 1 0
sspl-1.0 | server | server side public licen[cs]e | sspl 1 0
elastic-2.0 | elastic | elastic licen[cs]e(?: 2 0)? | elastic 2 0
mulan-psl | mulan | mulan permissive software licen[cs]e | mulanpsl [12] 0
cecill | cecill | cecill(?: [abc])?(?: free software)? licen[cs]e | cecill [12] [01]
qpl | public | q public licen[cs]e | qpl 1 0
ipl | ibm | ibm public licen[cs]e | ipl 1 0
npl | netscape | netscape public licen[cs]e | npl 1 [01]
spl | sun | sun public licen[cs]e | spl 1 0
apsl | apple | apple public source licen[cs]e | apsl [12] 0
rpl | reciprocal | reciprocal public licen[cs]e | rpl 1 [15]
blueoak-1.0 | blue | blue oak model licen[cs]e | blueoak 1 0 0
json | json | json licen[cs]e | json
beerware | beerware | beerware licen[cs]e | beerware
openrail | rail | (?:creativeml )?open rail(?: m)?(?: licen[cs]e)? | openrail
"""

# label | words that must be present | words of the licence's own text
BODIES = """
mit | hereby granted | permission is hereby granted free of charge to any person obtaining a copy
mit | substantial | the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit | noninfringement | warranties of merchantability fitness for a particular purpose and noninfringement
bsd | redistribution binary | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse promote | may be used to endorse or promote products derived from this software
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software
apache-2.0 | warranties conditions | distributed on an as is basis without warranties or conditions of any kind
apache-2.0 | compliance | you may not use this file except in compliance with the licen[cs]e
gpl | redistribute modify | this program is free software you can redistribute it and or modify it
gpl | hope useful | distributed in the hope that it will be useful but without any warranty
lgpl | library redistribute | this library is free software you can redistribute it and or modify it
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e
isc | permission fee | permission to use copy modify and or distribute this software for any purpose with or without fee
zlib | origin misrepresented | the origin of this software must not be misrepresented
unlicense | unencumbered | this is free and unencumbered software released into the public domain
bsl-1.0 | boost | distributed under the boost software licen[cs]e
wtfpl | fuck want | do what the fuck you want to
public-domain | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
proprietary | rights reserved | all rights reserved
proprietary | confidential proprietary | (?:confidential and proprietary|proprietary and confidential)
proprietary | redistribution prohibited | redistribution (?:of this \\w+ )?is (?:strictly )?prohibited
proprietary | copying prohibited | copying (?:of this \\w+ )?is (?:strictly )?prohibited
"""


def _rule(label: str, priority: int, weight: float, keywords: str, pattern: str) -> Rule:
    return Rule(label, priority, weight, frozenset(keywords.split()),
                re.compile(f"(?<![^ ])(?:{pattern})(?![^ ])".encode()))


def rules() -> list[Rule]:
    """Every rule, in order: of detections with equal words and priority the earlier rule's stays."""
    found = []
    for line in filter(None, FAMILIES.splitlines()):
        label, words, name, *short = (part.strip() for part in line.split(" | "))
        found += [
            *(_rule(label, 9, 0.99, "spdx identifier", f"spdx licen[cs]e identifier {s}") for s in short),
            _rule(label, 7, 0.95, f"{words} under",
                  f"(?:licensed|released|distributed|available|provided|published|covered) under (?:the )?"
                  f"(?:terms (?:and conditions )?of )?(?:the )?(?:{name})"),
            _rule(label, 5, 0.8, words, name),
        ]
    for line in filter(None, BODIES.splitlines()):
        label, words, body = (part.strip() for part in line.split(" | "))
        found.append(_rule(label, 3, 0.3 if label == "proprietary" else 0.7, words, body))
    return found
