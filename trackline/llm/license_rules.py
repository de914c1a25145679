"""Signature rules of the license scan, in order.

Rules are regular expressions over a text's words, lower-cased and joined by one
space (``Version 2.0`` is ``version 2 0``).  A rule names keywords, one of which
stands in every match; where every match holds ``license`` (or ``licence``), that is
the word it is looked for at, else a keyword is.  No match reaches further than
``licenses.AROUND`` words from there.  An empty label marks text that looks like a
license and is none.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    weight: float
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False

    @property
    def anchors(self) -> tuple[str, ...]:
        """The words at which the rule is looked for."""
        if self.base:
            return ("license",)
        return LICENSE if _always(self.pattern, "licen[cs]e") else self.keywords


LICENSE = ("license", "licence")


def _always(pattern: str, part: str) -> bool:
    """Whether ``part`` stands in everything ``pattern`` matches; groups are settled from the inside out."""
    while group := re.search(r"\((?:\?:)?([^()]*)\)(\?|\{0,\d+\}\??)?", pattern):
        body, may_lack = group.groups()
        kept = part if not may_lack and all(part in x for x in body.split("|")) else ""
        pattern = pattern[:group.start()] + kept + pattern[group.end():]
    return all(part in x for x in pattern.split("|"))


#: Phrases whose every place is counted, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

GENERIC, NAMED, NOTICE, TEXT, TAG, NOT_ONE = range(6)  # priorities
WEIGHTS = {GENERIC: 0.5, NAMED: 0.7, NOTICE: 0.9, TEXT: 0.95, TAG: 0.99, NOT_ONE: 0.0}

#: Label, gating words, how the license is named in prose, its identifier in a tag.
NAMES = """
0bsd            | bsd             | (?:bsd zero clause|zero clause bsd|0 clause bsd)(?: licen[cs]e)?               | 0bsd
afl-3.0         | academic        | academic free licen[cs]e(?: version)? v?3(?: 0)?                               | afl 3 0
afl-2.1         | academic        | academic free licen[cs]e(?: version)? v?2 1                                    | afl 2 1
agpl-3.0        | affero          | (?:gnu )?affero general public licen[cs]e(?:(?: version)? v?3(?: 0)?)?         | agpl 3 0(?: only| or later)?
agpl-1.0        | affero          | affero general public licen[cs]e(?: version)? v?1(?: 0)?                       | agpl 1 0(?: only| or later)?
agpl-short      | agplv3 agpl agpl3 | (?:gnu )?agpl ?v?3(?: 0)?                                                      | agplv3
apache-1.0      | apache          | apache(?: software)? licen[cs]e(?: version)? v?1 0                             | apache 1 0
apache-1.1      | apache          | apache(?: software)? licen[cs]e(?: version)? v?1 1                             | apache 1 1
apache-2.0      | apache          | apache(?: software)? licen[cs]e(?: version)? v?2(?: 0)?                        | apache 2 0
apache-short    | apache          | apache v?2 0                                                                   | asl 2 0
apsl-2.0        | apple           | apple public source licen[cs]e(?:(?: version)? v?2 0)?                         | apsl 2 0
artistic-1.0    | artistic        | (?:perl )?artistic licen[cs]e(?: version)? v?1 0                               | artistic 1 0(?: perl| cl8)?
artistic-2.0    | artistic        | (?:perl )?artistic licen[cs]e(?: version)? v?2(?: 0)?                          | artistic 2 0
artistic        | artistic        | (?:perl )?artistic licen[cs]e                                                  | artistic
beerware        | beerware beer   | (?:the )?beer ?ware licen[cs]e                                                 | beerware
blueoak-1.0.0   | oak             | blue oak model licen[cs]e(?: 1 0 0)?                                           | blueoak 1 0 0
bsd-1-clause    | bsd             | (?:1|one) clause bsd(?: licen[cs]e)?                                           | bsd 1 clause
bsd-2-clause    | bsd             | (?:(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd bsd)(?: licen[cs]e)? | bsd 2 clause(?: patent| views)?
bsd-3-clause    | bsd             | (?:(?:3|three) clause bsd|bsd (?:3|three) clause|new bsd|modified bsd|revised bsd)(?: licen[cs]e)? | bsd 3 clause(?: clear| lbnl)?
bsd-4-clause    | bsd             | (?:(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd)(?: licen[cs]e)?   | bsd 4 clause(?: uc)?
bsd             | bsd             | bsd (?:style )?licen[cs]e                                                      | bsd
bsl-1.0         | boost           | boost software licen[cs]e(?:(?: version)? v?1 0)?                              | bsl 1 0
busl-1.1        | business        | business source licen[cs]e(?:(?: version)? v?1 1)?                             | busl 1 1
bzip2-1.0.6     | bzip2           | bzip2(?: and libbzip2)? licen[cs]e                                             | bzip2 1 0 6
cc0-1.0         | cc0             | (?:creative commons )?cc0(?: 1 0)?(?: universal)?                              | cc0 1 0
cc-by-1.0       | cc              | cc by 1 0                                                                      | cc by 1 0
cc-by-2.0       | cc              | cc by 2 [05]                                                                   | cc by 2 [05]
cc-by-3.0       | cc              | cc by 3 0                                                                      | cc by 3 0
cc-by-4.0       | cc              | cc by 4 0                                                                      | cc by 4 0
cc-by-sa-2.0    | cc              | cc by sa 2 [05]                                                                | cc by sa 2 [05]
cc-by-sa-3.0    | cc              | cc by sa 3 0                                                                   | cc by sa 3 0
cc-by-sa-4.0    | cc              | cc by sa 4 0                                                                   | cc by sa 4 0
cc-by-nc-2.0    | cc              | cc by nc 2 [05]                                                                | cc by nc 2 [05]
cc-by-nc-3.0    | cc              | cc by nc 3 0                                                                   | cc by nc 3 0
cc-by-nc-4.0    | cc              | cc by nc 4 0                                                                   | cc by nc 4 0
cc-by-nc-sa-3.0 | cc              | cc by nc sa 3 0                                                                | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc              | cc by nc sa 4 0                                                                | cc by nc sa 4 0
cc-by-nc-nd-3.0 | cc              | cc by nc nd 3 0                                                                | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc              | cc by nc nd 4 0                                                                | cc by nc nd 4 0
cc-by-nd-3.0    | cc              | cc by nd 3 0                                                                   | cc by nd 3 0
cc-by-nd-4.0    | cc              | cc by nd 4 0                                                                   | cc by nd 4 0
cc-by-long      | commons         | creative commons attribution(?: \\d 0)?(?: international| unported| generic)?(?: licen[cs]e)? | cc by
cc-by-sa-long   | commons         | creative commons attribution share ?alike(?: \\d 0)?(?: international| unported| generic)?(?: licen[cs]e)? | cc by sa
cc-by-nc-long   | commons         | creative commons attribution non ?commercial(?: \\d 0)?(?: international| unported| generic)?(?: licen[cs]e)? | cc by nc
cc-by-nc-sa-long | commons        | creative commons attribution non ?commercial share ?alike(?: \\d 0)?(?: international| unported| generic)?(?: licen[cs]e)? | cc by nc sa
cc-by-nc-nd-long | commons        | creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: \\d 0)?(?: international| unported| generic)?(?: licen[cs]e)? | cc by nc nd
cc-by-nd-long   | commons         | creative commons attribution no ?deriv(?:s|atives)(?: \\d 0)?(?: international| unported| generic)?(?: licen[cs]e)? | cc by nd
cddl-1.0        | license licence cddl | (?:common development and distribution licen[cs]e|cddl)(?:(?: version)? v?1 0)? | cddl 1 0
cddl-1.1        | license licence cddl | (?:common development and distribution licen[cs]e|cddl)(?: version)? v?1 1     | cddl 1 1
cecill-2.1      | cecill          | cecill(?: free software)?(?: licen[cs]e)?(?:(?: agreement)?(?: version)? v?2 [01])? | cecill 2 [01]
cecill-b        | cecill          | cecill b(?: licen[cs]e)?                                                       | cecill b
cecill-c        | cecill          | cecill c(?: licen[cs]e)?                                                       | cecill c
cpl-1.0         | common          | common public licen[cs]e(?:(?: version)? v?1 0)?                               | cpl 1 0
cpal-1.0        | attribution     | common public attribution licen[cs]e(?:(?: version)? v?1 0)?                   | cpal 1 0
ecl-2.0         | educational     | educational community licen[cs]e(?:(?: version)? v?2 0)?                       | ecl 2 0
efl-2.0         | eiffel          | eiffel forum licen[cs]e(?:(?: version)? v?2)?                                  | efl 2 0
elastic-2.0     | elastic         | elastic licen[cs]e(?:(?: version)? v?2(?: 0)?)?                                | elastic 2 0
epl-1.0         | eclipse         | eclipse public licen[cs]e(?: version)? v?1 0                           | epl 1 0
epl-2.0         | eclipse         | eclipse public licen[cs]e(?: version)? v?2(?: 0)?                      | epl 2 0
epl             | eclipse         | eclipse public licen[cs]e                                                      | epl
edl-1.0         | eclipse         | eclipse distribution licen[cs]e(?:(?: version)? v?1 0)?                        | edl 1 0
eupl-1.1        | license licence eupl | (?:european union public licen[cs]e|eupl)(?: version)? v?1 1                   | eupl 1 1
eupl-1.2        | license licence eupl | (?:european union public licen[cs]e|eupl)(?: version)? v?1 2                   | eupl 1 2
gfdl-1.2        | documentation   | (?:gnu )?free documentation licen[cs]e(?: version)? v?1 2                      | gfdl 1 2(?: only| or later)?
gfdl-1.3        | documentation   | (?:gnu )?free documentation licen[cs]e(?:(?: version)? v?1 3)?                 | gfdl 1 3(?: only| or later)?
gpl-1.0         | general         | (?:gnu )?general public licen[cs]e(?: version)? v?1(?: 0)?                     | gpl 1 0(?: only| or later)?
gpl-2.0         | general         | (?:gnu )?general public licen[cs]e(?: version)? v?2(?: 0)?                     | gpl 2 0(?: only)?
gpl-2.0-plus    | general         | (?:gnu )?general public licen[cs]e(?: [^ ]+){0,8} version 2(?: of the licen[cs]e)? or(?: at your option)? any later version | gpl 2 0 or later
gpl-3.0         | general         | (?:gnu )?general public licen[cs]e(?: version)? v?3(?: 0)?                     | gpl 3 0(?: only)?
gpl-3.0-plus    | general         | (?:gnu )?general public licen[cs]e(?: [^ ]+){0,8} version 3(?: of the licen[cs]e)? or(?: at your option)? any later version | gpl 3 0 or later
gpl             | general         | gnu general public licen[cs]e                                                  | gpl
gpl-2.0-short   | gplv2 gpl gpl2  | (?:gnu )?gpl ?v?2(?: 0)?                                                       | gplv2
gpl-3.0-short   | gplv3 gpl gpl3  | (?:gnu )?gpl ?v?3(?: 0)?                                                       | gplv3
hpnd            | disclaimer      | historical permission notice and disclaimer                                    | hpnd
icu             | icu             | icu licen[cs]e                                                                 | icu
ijg             | jpeg            | independent jpeg group licen[cs]e                                              | ijg
imagemagick     | imagemagick     | imagemagick licen[cs]e                                                         | imagemagick
intel           | intel           | intel open source licen[cs]e                                                   | intel
ipl-1.0         | ibm             | ibm public licen[cs]e(?:(?: version)? v?1 0)?                                  | ipl 1 0
isc             | isc             | isc licen[cs]e                                                                 | isc
json            | json            | json licen[cs]e                                                                | json
lgpl-2.0        | library         | (?:gnu )?library general public licen[cs]e(?:(?: version)? v?2(?: 0)?)?        | lgpl 2 0(?: only| or later)?
lgpl-2.1        | lesser          | (?:gnu )?lesser general public licen[cs]e(?: version)? v?2 1                   | lgpl 2 1(?: only| or later)?
lgpl-3.0        | lesser          | (?:gnu )?lesser general public licen[cs]e(?: version)? v?3(?: 0)?              | lgpl 3 0(?: only| or later)?
lgpl            | lesser          | (?:gnu )?lesser general public licen[cs]e                                      | lgpl
lgpl-short      | lgpl lgplv2 lgplv3 lgpl2 lgpl3 | (?:gnu )?lgpl ?v?[23](?: [01])?                                             | lgplv[23]
libpng          | libpng          | libpng licen[cs]e(?: version 2)?                                               | libpng(?: 2 0)?
libtiff         | libtiff         | libtiff licen[cs]e                                                             | libtiff
lppl-1.3c       | latex           | latex project public licen[cs]e(?:(?: version)? v?1 3[ac]?)?                   | lppl 1 3[ac]
mirOS           | miros           | miros licen[cs]e                                                               | miros
mit             | mit             | (?:the )?mit(?: x11)? licen[cs]e                                               | mit
mit-expat       | expat           | expat licen[cs]e                                                               | expat
mit-0           | mit             | mit no attribution(?: licen[cs]e)?                                             | mit 0
mit-x11         | x11             | (?:mit )?x11 licen[cs]e                                                        | x11
mpl-1.0         | mozilla         | mozilla public licen[cs]e(?: version)? v?1 0                                   | mpl 1 0
mpl-1.1         | mozilla         | mozilla public licen[cs]e(?: version)? v?1 1                                   | mpl 1 1
mpl-2.0         | mozilla         | mozilla public licen[cs]e(?: version)? v?2(?: 0)?                              | mpl 2 0(?: no copyleft exception)?
mpl             | mozilla         | mozilla public licen[cs]e                                                      | mpl
ms-pl           | microsoft       | microsoft public licen[cs]e                                                    | ms pl
ms-rl           | microsoft       | microsoft reciprocal licen[cs]e                                                | ms rl
mulanpsl-2.0    | mulan           | mulan permissive software licen[cs]e(?: v?2)?                                  | mulanpsl 2 0
ncsa            | illinois        | university of illinois ncsa open source licen[cs]e                             | ncsa
nasa-1.3        | nasa            | nasa open source agreement(?: 1 3)?                                            | nasa 1 3
npl-1.1         | netscape        | netscape public licen[cs]e(?:(?: version)? v?1 [01])?                          | npl 1 [01]
odbl-1.0        | database        | open database licen[cs]e(?: v?1 0)?                                            | odbl 1 0
odc-by-1.0      | commons         | open data commons attribution licen[cs]e(?: v?1 0)?                            | odc by 1 0
pddl-1.0        | dedication      | public domain dedication and licen[cs]e                                        | pddl 1 0
ofl-1.1         | sil             | sil open font licen[cs]e(?:(?: version)? v?1 [01])?                            | ofl 1 [01]
openldap        | openldap        | openldap public licen[cs]e(?:(?: version)? v?2 \\d)?                           | oldap 2 \\d
openssl         | openssl         | openssl licen[cs]e                                                             | openssl
osl-3.0         | open            | open software licen[cs]e(?:(?: version)? v?3 0)?                               | osl 3 0
php-3.01        | php             | php licen[cs]e(?:(?: version)? v?3 01)?                                        | php 3 01
postgresql      | postgresql      | postgresql licen[cs]e                                                          | postgresql
psf-2.0         | python psf      | (?:python software foundation|psf) licen[cs]e(?:(?: agreement)?(?: version)? v?2)? | psf 2 0
python          | python          | python licen[cs]e                                                              | python 2 0
qpl-1.0         | public          | q public licen[cs]e(?:(?: version)? v?1 0)?                                    | qpl 1 0
rpl-1.5         | reciprocal      | reciprocal public licen[cs]e(?: v?1 5)?                                        | rpl 1 5
ruby            | ruby            | ruby licen[cs]e                                                                | ruby
sleepycat       | sleepycat       | sleepycat licen[cs]e                                                           | sleepycat
sspl-1.0        | server          | server side public licen[cs]e(?:(?: version)? v?1(?: 0)?)?                     | sspl 1 0
unicode         | unicode         | unicode(?: data files and software)? licen[cs]e                                | unicode (?:3 0|dfs 2016)
unlicense       | unlicense       | (?:the )?unlicense                                                             | unlicense
upl-1.0         | universal       | universal permissive licen[cs]e(?: v?1 0)?                                     | upl 1 0
vim             | vim             | vim licen[cs]e                                                                 | vim
w3c             | w3c             | w3c software(?: notice)?(?: and)? licen[cs]e                                   | w3c
watcom-1.0      | watcom          | sybase open watcom public licen[cs]e                                           | watcom 1 0
wtfpl           | wtfpl           | (?:wtfpl(?: licen[cs]e)?|do what the fuck you want to public licen[cs]e wtfpl) | wtfpl
zlib            | zlib            | zlib(?: libpng)? licen[cs]e                                                    | zlib
zpl-2.1         | zope            | zope public licen[cs]e(?:(?: version)? v?2 [01])?                              | zpl 2 [01]
"""

#: Label, gating words, sentences of license texts and file headers.
TEXTS = """
mit             | hereby          | permission is hereby granted free of charge to any person obtaining a copy of this software
mit             | sublicense      | without limitation the rights to use copy modify merge publish distribute sublicense and or sell
mit             | substantial     | shall be included in all copies or substantial portions of the software
mit             | noninfringement | fitness for a particular purpose and noninfringement
isc             | hereby          | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd            | hereby          | permission to use copy modify and distribute this software and its documentation for any purpose(?: and)?(?: without fee)? is hereby granted
bsd             | redistribution  | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause    | endorse         | neither the name of(?: [^ ]+){1,8} nor the names of its contributors may be used to endorse
bsd-4-clause    | advertising     | all advertising materials mentioning features or use of this software must display
bsd             | redistributions | redistributions of source code must retain the above copyright notice
bsd             | redistributions | redistributions in binary form must reproduce the above copyright notice
apache-2.0      | compliance      | you may not use this file except in compliance with the licen[cs]e
apache-2.0      | apache          | (?:https? )?www apache org licenses licen[cs]e 2 0
apache-2.0      | contributor     | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
gpl             | redistribute    | this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl             | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
gpl             | gnu             | you should have received a copy of the gnu general public licen[cs]e
gpl             | gnu             | (?:https? )?www gnu org licenses gpl(?: \\d 0)?
lgpl            | redistribute    | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e
lgpl            | gnu             | (?:https? )?www gnu org licenses lgpl(?: \\d [01])?
agpl-3.0        | gnu             | (?:https? )?www gnu org licenses agpl(?: 3 0)?
agpl-3.0        | affero          | you should have received a copy of the gnu affero general public licen[cs]e
mpl-2.0         | mozilla         | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-2.0         | mozilla         | (?:https? )?mozilla org mpl 2 0
mpl-1.1         | mozilla         | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl-1.0         | eclipse         | (?:https? )?www eclipse org legal epl v10
epl-2.0         | eclipse         | (?:https? )?www eclipse org legal epl 2 0
cddl-1.0        | development     | subject to the terms of the common development and distribution licen[cs]e
zlib            | misrepresented  | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib            | warranty        | this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense       | unencumbered    | this is free and unencumbered software released into the public domain
wtfpl           | fuck            | everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document(?: [^ ]+){0,12} do what the fuck you want
beerware        | beer            | you can do whatever you want with this stuff(?: [^ ]+){0,14} you can buy me a beer
bsl-1.0         | boost           | (?:https? )?www boost org licen[cs]e 1 0 txt
cc0-1.0         | creativecommons | (?:https? )?creativecommons org publicdomain zero 1 0
cc-by           | creativecommons | (?:https? )?(?:www )?creativecommons org licenses by \\d [05]
cc-by-sa        | creativecommons | (?:https? )?(?:www )?creativecommons org licenses by sa \\d [05]
cc-by-nc        | creativecommons | (?:https? )?(?:www )?creativecommons org licenses by nc \\d [05]
cc-by-nc-sa     | creativecommons | (?:https? )?(?:www )?creativecommons org licenses by nc sa \\d [05]
cc-by-nc-nd     | creativecommons | (?:https? )?(?:www )?creativecommons org licenses by nc nd \\d [05]
cc-by-nd        | creativecommons | (?:https? )?(?:www )?creativecommons org licenses by nd \\d [05]
ofl-1.1         | reserved        | with reserved font name
json            | evil            | the software shall be used for good not evil
public-domain   | domain          | (?:released|placed|dedicated|is)(?: [^ ]+){0,3} (?:into|in|to) the public domain
public-domain   | dedicate        | dedicate any and all copyright interest in the software to the public domain
proprietary     | reserved        | all rights reserved(?: [^ ]+){0,4} (?:confidential|proprietary)
proprietary     | confidential    | (?:proprietary and confidential|confidential and proprietary)
proprietary     | eula            | end user licen[cs]e agreement eula
proprietary     | license licence | end user licen[cs]e agreement
"""

#: Gating words and texts that name a license and are none.
NONE_AT_ALL = """
license licence   | (?:driver|drivers|driver s|driving|fishing|hunting|marriage|liquor|business|pilot|pilots|pilot s|gun|radio|dog|tv|television|taxi|medical|nursing|teaching|poetic|artistic) licen[cs]e (?:number|plate|holder|application|exam|test|office|fee|renewal)s?
license licence   | (?:driver|drivers|driver s|driving|fishing|hunting|marriage|liquor|pilot s|gun|dog|tv|television|taxi|nursing) licen[cs]e
license licence   | licen[cs]e plates?
license licence   | (?:not|never) (?:licensed|released|distributed|available) under(?: [^ ]+){0,3} (?:mit|apache|bsd|isc|zlib|gnu general public|mozilla public|artistic|boost software) licen[cs]e
license licence   | (?:incompatible|not compatible) with(?: [^ ]+){0,3} (?:mit|apache|bsd|isc|zlib|gnu general public|mozilla public|artistic|boost software) licen[cs]e
license licence   | (?:unlike|instead of|rather than)(?: the| an?)? (?:mit|apache|bsd|isc|zlib|gnu general public|mozilla public|artistic|boost software) licen[cs]e
gpl gpl0 gpl1 gpl2 gpl3 gpl4 gpl5 gpl6 gpl7 gpl8 gpl9 gplv0 gplv1 gplv2 gplv3 gplv4 gplv5 gplv6 gplv7 gplv8 gplv9 | (?:unlike|instead of|rather than|not under)(?: the)? (?:gnu )?gpl(?: v?\\d|v?\\d)?
cc                | cc by (?:email|mail|fax|phone)
"""

#: Gating words and texts that name the existence of some license.
SOME = """
unknown           | licensed        | licensed under(?: [^ ]+){0,4}
unknown           | licensed        | licensed to you under
unknown           | license licence | see(?: the)? licen[cs]e(?: file)?(?: for| in)
unknown           | license licence | subject to the (?:licen[cs]e|terms of the licen[cs]e)
unknown           | license licence | licen[cs]e (?:agreement|terms|notice|header|text|file)
unknown           | licenses        | third party licenses
unknown           | spdx            | spdx licen[cs]e identifier [^ ]+
"""


def _columns(table: str, n: int) -> list[list[str]]:
    """Cells of a table; a bar with blanks on both sides parts columns."""
    return [[cell.strip() for cell in line.split(" | ", n - 1)] for line in table.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules in order; an earlier one wins where everything else is equal."""
    out = [Rule("", NOT_ONE, WEIGHTS[NOT_ONE], tuple(words.split()), pattern.replace("\\\\", "\\"))
           for words, pattern in _columns(NONE_AT_ALL, 2)]
    named = []
    for line in NAMES.strip().splitlines():
        label, words, rest = (x.strip() for x in line.split(" | ", 2))
        pattern, tag = (x.strip().replace("\\\\", "\\") for x in rest.rsplit(" | ", 1))
        named.append((label.lower(), tuple(words.split()), pattern, tag))
    out += [Rule(label, TAG, WEIGHTS[TAG], ("spdx",), f"spdx licen[cs]e identifier(?: [^ ]+){{0,8}}? {tag}") for label, _, _, tag in named]
    out += [Rule(label, TEXT, WEIGHTS[TEXT], tuple(words.split()), pattern.replace("\\\\", "\\")) for label, words, pattern in _columns(TEXTS, 3)]
    under = "(?:licensed|released|distributed|available|published|provided|redistributed|covered)(?: [^ ]+){0,3} (?:under|by|with)(?: [^ ]+){0,5} "
    out += [Rule(label, NOTICE, WEIGHTS[NOTICE], words, f"{under}(?:{pattern})") for label, words, pattern, _ in named]
    out += [Rule(label, NAMED, WEIGHTS[NAMED], words, pattern) for label, words, pattern, _ in named]
    out += [Rule(label, GENERIC, WEIGHTS[GENERIC], (phrase.split()[0],), phrase, True) for phrase, label in BASE.items()]
    out += [Rule(label, GENERIC, WEIGHTS[GENERIC], tuple(words.split()), pattern.replace("\\\\", "\\")) for label, words, pattern in _columns(SOME, 3)]
    return out
